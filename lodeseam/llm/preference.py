"""Preference formatting: the common turns of two conversations once as prompt, then both completions.

A turn is rendered as its role and text between marks. The turns that the chosen and the rejected conversation have in
common from the start are the prompt; the rest of each is its completion. A completion's mask lists runs of characters as
``length x flag``; flag 1 marks what is learned, the text and end mark of assistant turns.

DataFrame operations only. A conversation becomes one row, so it must fit into one.

Defined cases: rows with a null conv_id belong to no conversation; null roles and texts are
empty; turns come in the order of (turn, role, text), null turns first; repeated rows are one turn;
equal conversations are all prompt with empty completions, and a conversation that is the start of the
other has one; pairs that name a missing conversation give nothing; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation as (role, text), in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_set(turn)).alias("turns"))
    return whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                        .alias("turns"))


def same_opening(conversations: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): of conversations with the same first turn the one of smallest id is
    chosen over each of the others."""
    first = conversations.select("conv_id", F.col("turns")[0]["role"].alias("role"), F.col("turns")[0]["text"].alias("text"))
    chosen = first.groupBy("role", "text").agg(F.min("conv_id").alias("chosen_id"), F.count("*").alias("n")).where("n > 1")
    return (first.join(chosen, ["role", "text"]).where("conv_id <> chosen_id")
            .select("chosen_id", F.col("conv_id").alias("rejected_id")))


def neighbours(conversations: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): each even id with the next, where both conversations exist."""
    ids = conversations.select(F.col("conv_id").alias("chosen_id")).where("chosen_id % 2 = 0")
    after = conversations.select(F.col("conv_id").alias("rejected_id"), (F.col("conv_id") - 1).alias("chosen_id"))
    return ids.join(after, "chosen_id").select("chosen_id", "rejected_id")


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    def run(n: Column, flag: int) -> Column:
        return F.concat(n.cast("string"), F.lit(f"x{flag}"))

    def of_turn(t: Column) -> Column:
        head, body = F.length(t["role"]) + len(START) + 1, F.length(t["text"]) + len(END)
        return F.when(t["role"] == LEARNED, F.concat(run(head, 0), F.lit(","), run(body, 1))).otherwise(run(head + body, 0))
    return F.array_join(F.transform(turns, of_turn), ",")


def completions(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask)."""
    def turns(id_name: str, name: str) -> DataFrame:
        return conversations.select(F.col("conv_id").alias(id_name), F.col("turns").alias(name))
    both = (pairs.select("chosen_id", "rejected_id").join(turns("rejected_id", "b"), "rejected_id")
            .join(turns("chosen_id", "a"), "chosen_id"))
    differs = F.array_position(F.zip_with("a", "b", lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    both = both.withColumn("n", F.when(differs > 0, differs - 1).otherwise(F.least(F.size("a"), F.size("b"))).cast("int"))

    def rest(c: str) -> Column:
        return F.slice(c, F.col("n") + 1, F.size(c))
    return both.select(
        "chosen_id", "rejected_id", F.col("n").alias("n_prompt_turns"), _rendered(F.slice("a", F.lit(1), F.col("n"))).alias("prompt"),
        _rendered(rest("a")).alias("chosen"), _mask(rest("a")).alias("chosen_mask"),
        _rendered(rest("b")).alias("rejected"), _mask(rest("b")).alias("rejected_mask"))


SQL = r"""
with turns as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
               from conversations where conv_id is not null),
conv as (select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, text) as turns
         from turns group by conv_id),
opened as (select *, min(conv_id) over (partition by turns[1].role, turns[1].text) as chosen_id from conv),
pairs as (select chosen_id, conv_id as rejected_id from opened where conv_id <> chosen_id
          union select x.conv_id, y.conv_id from conv x join conv y on y.conv_id = x.conv_id + 1 where x.conv_id % 2 = 0),
both_ as (select chosen_id, rejected_id, c.turns as a, r.turns as b
          from pairs join conv c on c.conv_id = chosen_id join conv r on r.conv_id = rejected_id),
cut as (select *, coalesce(list_min([i for i in range(1, least(len(a), len(b)) + 1)
                                     if a[i].role <> b[i].role or a[i].text <> b[i].text]) - 1,
                           least(len(a), len(b))) as n from both_),
parts as (select chosen_id, rejected_id, n, a[1:n] as p, a[n + 1:] as c, b[n + 1:] as r from cut)
select chosen_id, rejected_id, cast(n as integer) as n_prompt_turns,
  coalesce(array_to_string(['<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) for t in p], ''), '') as prompt,
  coalesce(array_to_string(['<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) for t in c], ''), '') as chosen,
  coalesce(array_to_string([case when t.role = 'assistant' then (length(t.role) + 13) || 'x0,' || (length(t.text) + 11) || 'x1'
                        else (length(t.role) + length(t.text) + 24) || 'x0' end for t in c], ','), '') as chosen_mask,
  coalesce(array_to_string(['<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) for t in r], ''), '') as rejected,
  coalesce(array_to_string([case when t.role = 'assistant' then (length(t.role) + 13) || 'x0,' || (length(t.text) + 11) || 'x1'
                        else (length(t.role) + length(t.text) + 24) || 'x0' end for t in r], ','), '') as rejected_mask
from parts
"""
