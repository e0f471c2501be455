"""Column roles, search parameters and variable rules.

Only :mod:`lodeseam.sources.tables` looks at :class:`Roles`; past ingest every table uses the
canonical names ``key acct tag amt gloss nloss ts checkpoint timestamp``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

COUNT, AMOUNT = "target_cnt", "target_amt"

# The names of the rankings.
RANKINGS = {
    "target_catch": ("target_catch",),
    "target_rate": ("target_rate",),
    "fscore": ("pattr_fscore",),
    "pattr_score": ("pattr_score",),
    "target_rate+pattr_score": ("target_rate", "pattr_score"),
    "fscore+pattr_score": ("pattr_fscore", "pattr_score"),
    "target_catch+pattr_score": ("target_catch", "pattr_score"),
}


@dataclass(frozen=True)
class Roles:
    """Which source column plays which role; ``None`` means the role is absent."""

    key: str = "key"
    acct: str = "acct"
    tag: str = "tag"
    amt: str | None = None
    gloss: str | None = None
    nloss: str | None = None
    ts: str | None = None
    counter_acct: str | None = None

    def mapping(self) -> dict[str, str]:
        """canonical name -> source column, for the roles that are configured."""
        return {name: col for name, col in vars(self).items() if col}


@dataclass(frozen=True)
class SearchParams:
    eval_metric: str = COUNT
    min_support: float = 0.03
    eval_cutoff: float = 0.6
    dedup_cutoff: float = 0.01
    rank_priority: str = "target_rate+pattr_score"
    concentration_cutoff: float = 0.3
    lvl_limit: int = 4
    min_block_size: float = 0.01
    overlap: float = 0.5
    mode: str = "itemsets"       # how conditions combine: exact item sets, or greedy walks
    # The next four leave things out, so they are off unless asked for.
    recent_rows: int | None = None      # profile only so many rows of a (key, checkpoint)
    top_values: int | None = None       # look at so many values of a string variable
    walk_seeds: int | None = None       # start walks at so many nodes of a component
    long_list: int | None = None        # a key holding more patterns than this is shortened ...
    per_checkpoint: int = 3             # ... to this many of each checkpoint
    weight_floor: float = 0.01
    lift: float = 1.0            # > 1 raises the univariate rate gates
    coverage_cap: float | None = None   # share of a variable's catch one value bin may hold
    best_first: bool = False     # merge string values by rate instead of by size
    discrete_max: int = 0        # numeric variables with at most this many values use equality
    strip_quotes: bool = False   # also drop quote characters from string values
    include_nodes_edges: bool = False   # the wider walk search: every node and edge as well
    search_scope: str = "single"

    def __post_init__(self):
        if self.eval_metric not in (COUNT, AMOUNT):
            raise ValueError(f"eval_metric must be {COUNT!r} or {AMOUNT!r}")
        if self.mode not in ("itemsets", "walk"):
            raise ValueError("mode must be 'itemsets' or 'walk'")
        if self.search_scope not in ("single", "dual"):
            raise ValueError("search_scope must be 'single' or 'dual'")
        if self.rank_priority not in RANKINGS:
            raise ValueError(f"rank_priority must be one of {sorted(RANKINGS)}")

    def with_lift_rules(self) -> "SearchParams":
        """The stricter variant: lift gates, capped bins, best-first order, discrete numbers."""
        return replace(self, lift=1.3, coverage_cap=0.8, best_first=True, discrete_max=5,
                       per_checkpoint=10, strip_quotes=True)


@dataclass(frozen=True)
class Feature:
    """One row of the feature configuration after role and scope expansion."""

    checkpoint: str
    variable: str
    type: str                    # string | numeric | bool
    priority: int = 3
    cp_priority: int = 3


# String values that never make a condition.
IGNORE_VALUES = (
    "NO_MISMATCH", "BEACON_MISSING_ELEMENT", "NORMAL", "NON_GIB", "NON_BOGUS", "CITY_MATCH",
    "VALID_PHONE", "SHIP_NAME_MATCH_BILL_NAME", "FULL_MATCH", "SHIP_NAME_MATCH_ACCOUNT_NAME",
    "STATE_MATCH", "REASONABLE_HOPPING", "NO_HOPPING", "OTHER", "COUNTRY_MATCH",
    "MATCH_COUNTRY", "MATCH_CITY", "MATCH_STATE", "NO_DATA", "CONS_TIMEZONE", "NO_RCVR_ID",
    "06_normal", "NO_FRAUDNET_DATA", "REGION_MATCH", "NEUTRAL", "FULL_CTRY_MATCH", "NULL",
    "NO_PHONE_INFO", "NO_RADD_DATA", "FULL_NAME_MATCH", "GOOD", "RCVR_IS_NOT_PEEKED",
    "CONS_COUNTER_PARTY", "YOUNG_RCVR", "NO_FRAUDNET_OR_MAGNES", "0",
    "NEUTRAL_PROB_COLLUSION", "NO_BOT_RISK", "MOBILE_FRAUDNET",
    "NO_NEW_CTRY_MATCH_MULT_CTRY_ACCT", "NO_NEW_CTRY_MATCH_SINGLE_CTRY_ACCT",
)
# Booleans whose condition is "is false".
FALSE_VARS = (
    "RI_address_zip_matched", "GEO_IP_COUNTRY_MATCH", "U1_name_email_matched",
    "SN_is_IP_country_match",
)
# Cuts by variable name, and the names searched in one direction only.
FIXED_CUTS = (("days|tof|sdof", (1, 7, 30, 90, 180, 360, 720)),)
UP_NAMES = ("score|lifetimetotsntsum|usd_amount|badrate|loss_ratio|grph_rbb|grph_cnt_bad|"
            "bad_cnt|restr_ratio|cnt_all")
DOWN_NAMES = "days|tof|sdof"
# Checkpoints that get role copies in single scope, role suffixes in dual scope,
# checkpoint kinds counted as one activity, and string values read as missing.
ROLE_COPY_CHECKPOINTS = "DisputeLifecycleAdjudication|DisputeLifecycleInitiation"
KEY_TYPE_SUFFIX = {"sender": "_send", "receiver": "_recv",
                   "partner_sender": "_send", "partner_receiver": "_recv"}
KEY_VALUE_SUFFIX = {"sender": "@sndr", "receiver": "@rcvr"}
ALIAS_CHECKPOINTS = (frozenset({"Login", "RiskLiteLogin"}),)
MISSING_WORDS = ("NULL", "UNKNOWN", "None")
# Weight of a priority class in the interpretability score.
PRIORITY_SCORE = {1: 0.5, 2: 0.2, 3: 0.1}


@dataclass(frozen=True)
class VariableRules:
    ignore_values: tuple[str, ...] = IGNORE_VALUES
    false_vars: tuple[str, ...] = FALSE_VARS
    fixed_cuts: tuple[tuple[str, tuple[float, ...]], ...] = FIXED_CUTS
    up_names: str = UP_NAMES
    down_names: str = DOWN_NAMES
