"""Ordered rule cascades: the first rule whose condition holds decides the outcome."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.config import RoutingConfig
from convroute.functions import text as tx

@dataclass(frozen=True)
class Rule:
    """One rule.  ``label`` None leaves the message undecided, for the next stage.

    With ``scored`` the sentiment score is appended to the reason.
    """

    when: Column
    label: str | None
    confidence: str
    reason: str
    scored: bool = False


def undecided(when: Column, reason: str) -> Rule:
    return Rule(when, None, "low", reason)


def decided(when: Column, label: str, reason: str, confidence: str = "high", scored: bool = False) -> Rule:
    return Rule(when, label, confidence, reason, scored)


class Cascade:
    """Rules in order.  ``number`` says which one holds first; the outcome is looked up by that number.

    Keep the number in a column of its own: the three parts of the outcome are then array lookups instead
    of three copies of the whole chain.
    """

    def __init__(self, rules: list[Rule], otherwise: str):
        self.rules = [*rules, undecided(F.lit(True), otherwise)]

    def number(self) -> Column:
        chain = F.when(self.rules[0].when, 0)
        for n, rule in enumerate(self.rules[1:-1], 1):
            chain = chain.when(rule.when, n)
        return chain.otherwise(len(self.rules) - 1)

    def label(self, number: Column) -> Column:
        return F.nullif(self._lookup([r.label or "" for r in self.rules], number), F.lit(""))

    def confidence(self, number: Column) -> Column:
        return self._lookup([r.confidence for r in self.rules], number)

    def reason(self, number: Column, score: Column | None = None) -> Column:
        reason = self._lookup([r.reason for r in self.rules], number)
        scored = [n for n, r in enumerate(self.rules) if r.scored]
        if not scored:
            return reason
        return F.when(number.isin(scored), F.concat(reason, tx.two_decimals(score))).otherwise(reason)

    @staticmethod
    def _lookup(values: list[str], number: Column) -> Column:
        return F.get(tx.strings(values), number)


def router_rules(text: Column, config: RoutingConfig) -> Cascade:
    """Stage 1: rules over the signal columns and the text alone."""
    risk, spam, bare_url, refund, negative, positive, _, tracking, reservation, cancel, question, booking = (
        F.col(name) for name in lx.SIGNALS
    )
    chars = F.length(text)
    return Cascade(
        [
            undecided(tx.is_blank(text), "empty_message"),
            undecided(risk, "risk_trigger_escalated_to_api"),
            decided(spam, "spam", "spam_keyword"),
            undecided(bare_url, "url_no_context_escalated"),
            undecided(refund & positive, "conflicting_refund_and_positive"),
            undecided(negative & positive, "conflicting_negative_and_positive"),
            decided(refund, "refund_request", "refund_keyword"),
            decided((tracking | reservation | cancel) & ~negative, "order_inquiry", "tracking_or_reservation_keyword"),
            decided(negative, "complaint", "negative_keyword_or_emoji"),
            decided(
                positive & ~question & (chars < config.compliment_max_chars),
                "compliment",
                "positive_keyword_or_emoji",
            ),
            decided(question, "order_inquiry", "question_no_negative_signal"),
            decided(
                ~positive & (chars < config.booking_max_chars) & booking,
                "order_inquiry",
                "booking_detail_pattern",
                confidence="low",
            ),
        ],
        otherwise="no_confident_signal",
    )


def sentiment_rules(sentiment: Column, score: Column, config: RoutingConfig) -> Cascade:
    """Stage 2: rules over the signal columns and a sentiment score.

    A refund word decides here even next to a positive one, which stage 1 leaves open as a conflict.
    """
    risk, spam, bare_url, refund, _, _, declining, tracking, reservation, cancel, question, _ = (
        F.col(name) for name in lx.SIGNALS
    )
    is_negative = sentiment == "negative"
    is_positive = sentiment == "positive"

    return Cascade(
        [
            undecided(risk | spam | bare_url, "stage1_signal_escalated"),
            decided(refund, "refund_request", "refund_keyword_stage2"),
            decided((tracking | reservation | cancel) & ~is_negative, "order_inquiry", "tracking_keyword_stage2"),
            decided(
                is_negative & (score >= config.negative_threshold), "complaint", "sentiment_negative_", scored=True
            ),
            decided(
                is_positive & (score >= config.positive_threshold) & ~question & ~declining,
                "compliment",
                "sentiment_positive_",
                scored=True,
            ),
            decided(~is_negative & question, "order_inquiry", "question_stage2"),
        ],
        otherwise="sentiment_inconclusive",
    )


def standin_label(text: str = "text") -> Column:
    """Offline stand-in for the batch classifier: a label from two term tests on the named column."""
    lower = tx.Searched.inline(f"lower({text})")
    chain = F
    for label, terms in lx.STANDIN_RULES:
        chain = chain.when(tx.any_term(lower, terms), label)
    return chain.otherwise(lx.STANDIN_DEFAULT)


def normalised_sentiment(raw_label: Column) -> Column:
    """Map a model's own sentiment label to positive, negative or neutral."""
    lower = F.lower(raw_label)
    return (
        F.when(F.contains(lower, F.lit("pos")), "positive")
        .when(F.contains(lower, F.lit("neg")), "negative")
        .otherwise("neutral")
    )
