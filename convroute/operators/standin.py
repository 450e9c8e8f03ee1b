"""Offline stand-in for a batch classifier, for dry runs and tests."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.functions.rules import standin_label
from convroute.operators.requests import CHARS_PER_TOKEN, OUTPUT_TOKENS_PER_MESSAGE, Reply
from convroute.operators.stages import is_undecided


def _label(text: str) -> str:
    lower = text.lower()
    return next((label for label, terms in lx.STANDIN_RULES if any(t in lower for t in terms)), lx.STANDIN_DEFAULT)


def offline_classifier() -> Callable[[str, Sequence[str]], Reply]:
    """A classifier factory that answers without any model."""

    def classify(prompt: str, texts: Sequence[str]) -> Reply:
        body = json.dumps([{"i": i, "label": _label(t), "conf": "low"} for i, t in enumerate(texts)])
        return Reply(body, len(prompt) // CHARS_PER_TOKEN, len(texts) * OUTPUT_TOKENS_PER_MESSAGE)

    return classify


def fill_with_standin(staged: DataFrame) -> DataFrame:
    """Label what is still undecided by the stand-in's rules, in place and without batches."""
    open_row = is_undecided()
    filled = {
        "label": F.when(open_row, standin_label()).otherwise(F.col("label")),
        "confidence": F.when(open_row, "low").otherwise(F.col("confidence")),
        "source": F.when(open_row, "api").otherwise(F.col("source")),
        "reason": F.when(open_row, "api_classified").otherwise(F.col("reason")),
    }
    return staged.withColumns(filled)
