"""Derived features of asset tables, applied where the asset and its columns exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLIS_PER_DAY = 86_400_000

# The asset kinds and their fields.
_S, _L, _N = "string", "bigint", "double"
ASSETS: dict[str, dict[str, str]] = {
    "BankAccount": {"routingNumber": _S, "creationTime": _L, "lastModifiedTime": _L,
                    "baNumberHmac": _S, "bankName": _S, "wuserAchId": _S},
    "Phone": {"phoneNumber": _S, "lastModifiedTime": _L, "creationTime": _L},
    "VID": {"vid": _S, "lastModifiedTime": _L, "creationTime": _L},
    "DocumentID": {"lastModifiedTime": _L, "creationTime": _L, "docIdVal": _S,
                   "docIssuerId": _S, "issuerCntryCode": _S, "issuerJursdctn": _S,
                   "docType": _S, "docSubtype": _S, "isPartial": _S},
    "Email": {"emailAddress": _S, "lastModifiedTime": _S, "creationTime": _L, "domain": _S},
    "Address": {"address": _S, "lastModifiedTime": _L, "creationTime": _L},
    "XLinkVertex": {"xLinkVertexID": _S, "lastModifiedTime": _L, "creationTime": _L},
    "IP": {"lastModifiedTime": _L, "ipNumer": _S, "creationTime": _L, "city": _S,
           "latitude": _N, "isp": _S, "ipAddress": _S, "countryCode": _S, "domain": _S,
           "region": _S, "longitude": _N},
    "Supercookie": {"superCookie": _S, "lastModifiedTime": _L, "creationTime": _L},
    "URL": {"url": _S, "domain": _S, "tpd": _S, "siteStatus": _S, "firstUsed": _L,
            "lastUsed": _L, "lastModifiedTime": _L, "creationTime": _L},
    "CC": {"ccNumber": _S, "ccType": _S, "lastModifiedTime": _L, "creationTime": _L},
    "AppGuid": {"appGuid": _S, "appId": _S, "appVersion": _S, "appFirstInstallTime": _L,
                "appLastUpdateTime": _L, "operatingSystemName": _S,
                "systemVersionNumber": _S, "browserVersionNumber": _S, "browserName": _S,
                "browserHash": _S, "cloudIdentifier": _S, "baseServiceSetId": _S,
                "linkerId": _S, "totalStorageSpace": _N, "webMid": _S,
                "networkOperator": _S, "simOperatorName": _S, "timezone": _S},
    "FPTI_VID": {"id": _S, "lastModifiedTime": _L, "creationTime": _L},
    "PPAccount": {"accountCreationTimestamp": _L, "accountLanguage": _S,
                  "consumerSegment": _S, "country": _S, "firstName": _S,
                  "firstBuyingTimestamp": _L, "lastName": _S, "lifetimeTotSntSum": _N,
                  "userGroup": _S},
}
# Day counts, output name -> (source field, asset kinds).
_TIMED = tuple(kind for kind in ASSETS if kind != "PPAccount")
DAYS_SINCE: dict[str, tuple[str, tuple[str, ...]]] = {
    "daysFromCreTs": ("creationTime", _TIMED),
    "daysFromLastModTs": ("lastModifiedTime", _TIMED),
    "daysFromFirstUse": ("firstUsed", ("URL",)),
    "daysFromLastUse": ("lastUsed", ("URL",)),
    "daysFromInstallTs": ("appFirstInstallTime", ("AppGuid",)),
    "daysFromLastUpdtTs": ("appLastUpdateTime", ("AppGuid",)),
    "daysFromAcctCreTs": ("accountCreationTimestamp", ("PPAccount",)),
    "daysFromFirstBuy": ("firstBuyingTimestamp", ("PPAccount",)),
}


def asset_schema(kind: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in ASSETS[kind].items()))


def ip_prefix(ip: Column, octets: int) -> Column:
    """Leading octets; null where the address does not start with them."""
    found = F.regexp_extract(ip, r"^\d+" + r"\.\d+" * (octets - 1), 0)
    return F.when(found != "", found)


def days_since(pit: Column, then: Column) -> Column:
    """Whole days between two epoch-millis values, truncated toward zero."""
    return ((pit.cast("bigint") - then.cast("bigint")) / MILLIS_PER_DAY).cast("int")


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def expand_asset(df: DataFrame, kind: str) -> DataFrame:
    """Add the derived features this asset kind has and whose columns are present."""
    have, added = set(df.columns), {}
    if kind == "IP" and "ipAddress" in have:
        added.update(IP3=ip_prefix(F.col("ipAddress"), 3), IP2=ip_prefix(F.col("ipAddress"), 2))
    for name, (source, kinds) in DAYS_SINCE.items():
        if kind in kinds and {"pit", source} <= have:
            added[name] = days_since(F.col("pit"), F.col(source))
    if kind == "PPAccount" and {"firstName", "lastName"} <= have:
        added["fullName"] = full_name(F.col("firstName"), F.col("lastName"))
    return df.withColumns(added) if added else df
