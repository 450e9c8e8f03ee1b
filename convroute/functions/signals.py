"""The twelve boolean signals of a message."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.functions import text as tx

_SEARCHED = tx.Searched("__lower", "__latin", "__arabic", "__beyond_ascii")
_ORDER_NUMBER = "__order_number"


def with_signals(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the signal columns of ``lexicon.SIGNALS``, read from the column named ``text``.

    Values that several signals read are computed in projections of their own.  The projection with the
    signals holds higher-order functions, so Spark compiles it apart from its neighbours and with one
    method per signal, which the JVM can compile in turn; as part of one whole-stage method the same
    chains took 2.5 times as long on short messages.

    The signals then pass through a one-row generator.  A filter on a label would otherwise be pushed below
    that projection with all signals copied into it, and every text would be searched twice.
    """

    def has(terms) -> Column:
        return tx.any_term(_SEARCHED, terms)

    def has_unnegated(terms) -> Column:
        return tx.any_unnegated_term(_SEARCHED, terms)

    def has_as_written(terms) -> Column:
        return tx.any_term(replace(_SEARCHED, text=text), terms)

    raw = F.col(text)
    order_number = F.col(_ORDER_NUMBER)
    declining = has(lx.DECLINING_TERMS)
    signals = {
        "is_risk": has(lx.RISK_TERMS),
        "is_spam_pattern": has(lx.SPAM_TERMS),
        "has_bare_url": has(lx.URL_TERMS) & ~(order_number | has(lx.PHOTO_TERMS)),
        "has_refund": has(lx.REFUND_TERMS),
        "has_negative_keyword": has_unnegated(lx.NEGATIVE_TERMS) | has_as_written(lx.NEGATIVE_EMOJI),
        "has_positive_keyword": (has_unnegated(lx.POSITIVE_TERMS) | has_as_written(lx.POSITIVE_EMOJI)) & ~declining,
        "is_declining": declining,
        "has_tracking": order_number | has(lx.TRACKING_TERMS),
        "has_reservation": has(lx.RESERVATION_TERMS),
        "has_cancel": has(lx.CANCEL_TERMS),
        "has_question": has_as_written(lx.QUESTION_MARKS),
        "has_booking_detail": raw.rlike(lx.PHONE) | (F.contains(raw, F.lit("@")) & raw.rlike(lx.EMAIL)),
    }
    tests = tx.Searched.inline(_SEARCHED.text)
    helpers = {
        _SEARCHED.latin: F.expr(tests.latin),
        _SEARCHED.arabic: F.expr(tests.arabic),
        _SEARCHED.beyond_ascii: F.expr(tests.beyond_ascii),
    }
    prepared = df.withColumn(_SEARCHED.text, F.lower(raw)).withColumns(helpers)
    # Few texts hold a part of an order number, so most skip the pattern.
    prepared = prepared.withColumn(_ORDER_NUMBER, has(lx.ORDER_NUMBER_TERMS) & raw.rlike(lx.ORDER_NUMBER))
    prepared = prepared.select(*df.columns, *[column.alias(f"__{name}") for name, column in signals.items()])
    packed = F.struct(*[F.col(f"__{name}").alias(name) for name in signals])
    return prepared.select(*df.columns, F.inline(F.array(packed)))
