"""Parse classifier replies and repair their indexes, batch by batch and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute.config import LABELS

FALLBACK_LABEL = "order_inquiry"

# JSON schema of a reply, for classifiers that can be held to one.
REPLY_SCHEMA = {
    "type": "array",
    "items": {
        "type": "object",
        "properties": {
            "i": {"type": "integer"},
            "label": {"type": "string", "enum": list(LABELS)},
            "conf": {"type": "string", "enum": ["high", "low"]},
        },
        "required": ["i", "label", "conf"],
    },
}
ITEM_TYPE = "array<struct<i:bigint,label:string,conf:string>>"


def _index(item: Column) -> Column:
    """An item's index: whole numbers as they are, fractions cut, digit strings read, all else null."""
    value = F.variant_get(item, "$.i", "variant")
    kind = F.schema_of_variant(value)
    digits = F.translate(
        F.regexp_replace(F.try_variant_get(item, "$.i", "string"), r"^[\s\p{Z}]+|(?<![\s\p{Z}])[\s\p{Z}]+\z", ""),
        "٠١٢٣٤٥٦٧٨٩",
        "0123456789",
    )
    digits = F.when(digits.rlike(r"^[+-]?\d+(_\d+)*\z"), F.regexp_replace(digits, "_", ""))
    return (
        F.when(kind == "STRING", digits.try_cast("bigint"))
        .when(kind == "BIGINT", F.try_variant_get(item, "$.i", "bigint"))
        .when(kind == "BOOLEAN", F.try_variant_get(item, "$.i", "boolean").cast("bigint"))
        .when(
            kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
            F.try_variant_get(item, "$.i", "double").try_cast("bigint"),
        )
    )


def _item(item: Column) -> Column:
    conf = F.variant_get(item, "$.conf", "variant")
    return F.struct(
        _index(item).alias("i"),
        F.try_variant_get(item, "$.label", "string").alias("label"),
        F.when(conf.isNull(), "low").otherwise(F.try_variant_get(item, "$.conf", "string")).alias("conf"),
    )


def parse_replies(replies: DataFrame) -> DataFrame:
    """Add ``parsed`` (is the body JSON at all), ``is_list`` and ``items``.

    A body that is JSON but no array counts as a reply without items.
    """
    document = F.try_parse_json("body")
    kind = F.schema_of_variant(F.col("__document"))
    elements = F.when(F.col("is_list"), F.col("__document").cast("array<variant>"))
    return (
        replies.withColumn("__document", document)
        .withColumn("parsed", F.col("__document").isNotNull())
        .withColumn("is_list", F.coalesce(kind.startswith("ARRAY"), F.lit(False)))
        .withColumn(
            "items", F.coalesce(F.transform(elements, _item), F.array().cast(ITEM_TYPE))
        )
        .drop("__document")
    )


def merge_replies(parsed: DataFrame, source: str = "api") -> DataFrame:
    """One row per message of every batch whose reply could be parsed.

    Of several items with one index the last counts.  A message whose index is absent, or whose label is
    unknown, gets the fallback label with low confidence and ``missing`` set.  The lookup runs inside the
    batch's own row, so replies are not joined back to messages.
    """

    def outcome(member: Column, position: Column) -> Column:
        hit = F.try_element_at(
            F.filter("items", lambda it: it["i"] == position.cast("bigint")), F.lit(-1)
        )
        known = F.coalesce(hit["label"].isin(*LABELS), F.lit(False))
        return F.struct(
            member.alias("member"),
            F.when(known, hit["label"]).otherwise(FALLBACK_LABEL).alias("label"),
            F.when(known, hit["conf"]).otherwise("low").alias("confidence"),
            (~known).alias("missing"),
        )

    rows = parsed.where("parsed").select("batch", F.explode(F.transform("members", outcome)).alias("row"))
    return rows.select(
        "row.member.*",
        "row.label",
        "row.confidence",
        F.lit(source).alias("source"),
        F.when(F.col("row.missing"), "api_missing_index").otherwise("api_classified").alias("reason"),
        "batch",
        "row.missing",
    )


def reply_quality(parsed: DataFrame) -> DataFrame:
    """Counts that show how well replies keep to the schema: one row."""
    known = lambda it: F.coalesce(it["label"].isin(*LABELS), F.lit(False))
    listed_conf = lambda it: F.coalesce(it["conf"].isin("high", "low"), F.lit(False))
    in_range = lambda it: F.coalesce(it["i"].between(0, F.col("n_messages") - 1), F.lit(False))
    counted = {
        "items": F.size("items"),
        "unknown_label": F.size(F.filter("items", lambda it: ~known(it))),
        "unlisted_conf": F.size(F.filter("items", lambda it: ~listed_conf(it))),
        "bad_index": F.size(F.filter("items", lambda it: ~in_range(it))),
    }
    return parsed.select("parsed", "is_list", "n_messages", *[c.alias(k) for k, c in counted.items()]).agg(
        F.count("*").alias("batches"),
        F.count_if(~F.col("parsed")).alias("failed_batches"),
        F.count_if(F.col("parsed") & ~F.col("is_list")).alias("not_a_list"),
        F.coalesce(F.sum("n_messages"), F.lit(0)).alias("messages"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in counted],
    )
