"""Text tests as native column expressions.

Term lists are matched with OR-chains of ``contains``; Java regex alternations were 3 to 4 times slower.
Terms of a script that the text does not hold are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from convroute import lexicon as lx


def strings(values: Sequence[str]) -> Column:
    """A constant array, sent to the JVM as one literal that the optimizer folds."""
    return F.split(F.lit("\n".join(values)), "\n")


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(values: Sequence[str]) -> str:
    return "array(" + ", ".join(map(_literal, values)) + ")"


@dataclass(frozen=True)
class Searched:
    """A lower-cased text and cheap tests of what it holds, all as SQL expressions or column names."""

    text: str
    latin: str
    arabic: str
    beyond_ascii: str

    @classmethod
    def inline(cls, text: str) -> Searched:
        """Tests are false for a null text, so that its terms are not tried."""
        beyond_ascii = f"coalesce(octet_length({text}) <> length({text}), false)"
        # Most texts without Arabic letters are settled by the length test alone.
        return cls(
            text,
            f"coalesce(rlike({text}, '[a-z]'), false)",
            f"({beyond_ascii} AND rlike({text}, '[؀-ۿ]'))",
            beyond_ascii,
        )

    def guard(self, term: str) -> str:
        """What has to hold for ``term`` to occur at all."""
        if re.search("[a-z]", term):
            return self.latin
        if re.search("[؀-ۿ]", term):
            return self.arabic
        return "true" if term.isascii() else self.beyond_ascii


def is_blank(text: Column) -> Column:
    """True when nothing but (Unicode) white space is there."""
    return ~text.rlike(lx.NON_BLANK)


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends.

    The look-behind lets a match begin at the first blank of a run only, so long inner runs cost linear time.
    """
    blank = f"[{lx.SPACE_CLASS}]"
    return F.regexp_replace(text, rf"^{blank}+|(?<!{blank}){blank}+\z", "")


def _any(searched: Searched, terms: Sequence[str], confirm: Callable[[Sequence[str]], str] | None = None) -> Column:
    """Does any term occur, and does ``confirm`` hold for its group?  A group shares one guard."""
    groups: dict[str, list[str]] = {}
    for term in terms:
        groups.setdefault(searched.guard(term), []).append(term)
    parts = []
    for guard, group in groups.items():
        occurs = " OR ".join(f"contains({searched.text}, {_literal(t)})" for t in group)
        parts.append(f"({guard} AND ({occurs})" + (f" AND {confirm(group)})" if confirm else ")"))
    return F.expr("(" + " OR ".join(parts) + ")")


def any_term(searched: Searched, terms: Sequence[str]) -> Column:
    """Does any term occur anywhere in the text?  Substring test, no word boundaries."""
    return _any(searched, terms)


def any_unnegated_term(searched: Searched, terms: Sequence[str]) -> Column:
    """Does any term occur whose *first* occurrence has no negation marker closely before it?

    The marker must lie wholly within the ``NEGATION_WINDOW`` characters before the term.  Terms are
    looked at one by one only in texts that hold some term of the group.
    """
    text, window = searched.text, lx.NEGATION_WINDOW
    at = f"instr({text}, t)"
    before = f"substring({text}, greatest(1, {at} - {window}), least({window}, {at} - 1))"
    negated = f"exists({_array(lx.NEGATION_MARKERS)}, m -> contains({before}, m))"
    return _any(
        searched, terms, lambda group: f"exists({_array(group)}, t -> contains({text}, t) AND NOT {negated})"
    )


def two_decimals(score: Column) -> Column:
    """Format a score with two decimals, rounding its exact binary value half to even.

    ``format_string('%.2f')`` rounds the shortest decimal form instead: 0.845 would give 0.85 although
    the stored double lies below it.  A double between 1/16 and 1 times 2^56 is a whole number, so long
    arithmetic decides ties exactly; the top score of three classes is never below 1/3.
    """
    hundredfold = (score * F.lit(float(2**56))).cast("bigint") * F.lit(100)
    cents = F.shiftright(hundredfold, 56)
    rest = hundredfold.bitwiseAND(F.lit(2**56 - 1))
    round_up = (rest > 2**55) | ((rest == 2**55) & (cents % 2 == 1))
    rounded = (cents + round_up.cast("bigint")) / F.lit(100)
    exact = score.between(0.0625, 1.0)
    return F.format_string("%.2f", F.when(exact, rounded).otherwise(score))
