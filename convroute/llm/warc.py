"""Resolution of WARC not-modified revisits (operator 7).

A revisit record of a 304 response has no payload: it says that what an earlier response of the same URL gave still
holds.  Each revisit is joined to the latest full response (status 200) of its canonical URL with an earlier date,
the larger record id deciding among equal dates.  Its validators are then checked: entity tags by weak comparison
where both records have one, else dates of last modification.  If they agree the revisit becomes a full record with
the payload of the response and its headers, updated by those headers of the 304 that may update a stored response.

The as-of join runs on narrow columns in two levels: inside blocks of ``block_seconds`` a window finds the latest
response before each revisit, and one row per URL and block carries the last response over to later blocks.  So a
URL that is captured all the time is as many groups as it has blocks.  Payloads are shuffled once, to the revisits
found, by response; a response that very many revisits name is split by Spark's skew join.

States: ``resolved``, ``mismatch`` (validators differ), ``unchecked`` (no validator in common), ``no_response``
(none earlier, or no URL).  Only ``resolved`` rows have a payload.  Null headers are none.  Repeated revisit rows
are resolved each; repeated response rows are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header fields of a 304 that never update a stored response (fixed values): those about the message itself.
NEVER_MERGED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authentication-info",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)

BLOCK_SECONDS = 86_400


def canonical_url(url: str | Column) -> Column:
    """Host in lower case without www. and default port, path without closing slash, query; no scheme or fragment."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    plain = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(plain, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    rest = F.regexp_replace(F.regexp_extract(plain, "^[^/?]*(.*)$", 1), "^([^?]*)/(\\?|$)", "$1$2")
    return F.concat(host, rest)


def _first(headers: str, name: str) -> Column:
    """The first value of a field; headers are array<struct<name, value>>."""
    own = F.filter(F.coalesce(headers, _no_headers()), lambda h: F.lower(h["name"]) == name)
    return F.when(F.size(own) > 0, F.trim(own[0]["value"]))


def _no_headers() -> Column:
    return F.array().cast("array<struct<name:string,value:string>>")


def merged_headers(stored: str, update: str) -> Column:
    """Stored fields, those that the update names replaced by the update's own. Names are compared without case."""
    update_of, stored_of = F.coalesce(update, _no_headers()), F.coalesce(stored, _no_headers())
    # Fields that the 304 lists as its connection's own do not count either.
    own = F.transform(F.split(F.lower(F.coalesce(_first(update, "connection"), F.lit(""))), ","), F.trim)
    permitted = F.filter(
        update_of, lambda h: ~F.lower(h["name"]).isin(*NEVER_MERGED) & ~F.array_contains(own, F.lower(h["name"]))
    )
    replaced = F.transform(permitted, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored_of, lambda h: ~F.array_contains(replaced, F.lower(h["name"]))), permitted)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit: (record_id, url, canonical, date, state, response_id, headers, payload).

    ``records`` has record_id, url, date (seconds), record_type (response or revisit), status, headers
    (array<struct<name, value>>) and payload.
    """
    known = records.select(
        "record_id", "url", canonical_url("url").alias("canonical"), "date", "record_type", "status", "headers", "payload"
    )
    full = (F.col("record_type") == "response") & (F.col("status") == 200)
    known = known.where((F.col("record_type") == "revisit") | (full & F.col("canonical").isNotNull() & F.col("date").isNotNull()))
    narrow = known.select(
        "record_id", "url", "canonical", "date", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("headers")).alias("headers"),
        _first("headers", "etag").alias("etag"),
        _first("headers", "last-modified").alias("modified"),
        # Rows without a URL match nothing; they are spread.
        F.when(F.col("canonical").isNull(), F.xxhash64("record_id"))
        .otherwise(F.floor(F.col("date") / block_seconds)).alias("block"),
    )
    response = F.when(
        F.col("record_type") == "response",
        F.struct("date", "record_id", "etag", "modified"),
    )
    inside = Window.partitionBy("canonical", "block").orderBy("date").rangeBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("canonical").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        narrow.where("canonical is not null")
        .groupBy("canonical", "block")
        .agg(F.max(response).alias("last"))
        .select("canonical", "block", F.max("last").over(earlier).alias("carried"))
    )
    revisits = (
        narrow.withColumn("own", F.max(response).over(inside))
        .where("record_type = 'revisit'")
        .join(carried, ["canonical", "block"], "left")
        .withColumn("found", F.when(F.col("canonical").isNotNull() & F.col("date").isNotNull(), F.coalesce("own", "carried")))
    )
    tags = F.col("etag").isNotNull() & F.col("found.etag").isNotNull()
    dates = F.col("modified").isNotNull() & F.col("found.modified").isNotNull()
    same = F.when(tags, _weak(F.col("etag")) == _weak(F.col("found.etag"))).when(
        dates, F.col("modified") == F.col("found.modified")
    )
    judged = revisits.select(
        "record_id", "url", "canonical", "date", "headers",
        F.when(F.col("found").isNull(), "no_response").when(same.isNull(), "unchecked")
        .when(same, "resolved").otherwise("mismatch").alias("state"),
        F.col("found.record_id").alias("response_id"),
        F.when(same, F.col("found.date")).alias("response_date"),
    )
    payloads = (
        known.where(full)
        .groupBy(
            F.col("canonical").alias("of"), F.col("date").alias("response_date"), F.col("record_id").alias("response")
        )
        .agg(F.max(F.struct("payload", F.col("headers").alias("stored"))).alias("body"))
    )
    key = (
        (F.col("of") == F.col("canonical"))
        & (payloads["response_date"] == judged["response_date"])
        & F.col("response").eqNullSafe(F.col("response_id"))
    )
    resolved = F.col("state") == "resolved"
    return judged.join(payloads, key, "left").select(
        "record_id", "url", "canonical", judged["date"], "state", "response_id",
        F.when(resolved, merged_headers("body.stored", "headers")).alias("headers"),
        F.when(resolved, F.col("body.payload")).alias("payload"),
    )
