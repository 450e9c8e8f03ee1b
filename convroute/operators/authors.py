"""Author classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convroute.config import BRAND, BRAND_LABEL, CUSTOMER


def customers(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("author") == CUSTOMER)


def brands(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("author") == BRAND)


def brand_rows(messages: DataFrame) -> DataFrame:
    """Brand-authored messages with their constant label."""
    return brands(messages).withColumns(
        {
            "label": F.lit(BRAND_LABEL),
            "confidence": F.lit("n/a"),
            "source": F.lit("rule"),
            "reason": F.lit("brand_authored_not_a_customer_intent"),
        }
    )


def author_counts(messages: DataFrame) -> DataFrame:
    """Messages per author class; authors that are neither customer nor brand get no label later."""
    return messages.where(F.col("author").isin(CUSTOMER, BRAND)).groupBy("author").agg(
        F.count("*").alias("n_messages")
    )
