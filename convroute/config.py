"""Settings of a run: label domain, precedence, thresholds, batching, prices and budget."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from enum import Enum

# --- Fixed values: label, confidence and source domains, prices -----------------------------------

LABELS = (
    "refund_request",
    "complaint",
    "order_inquiry",
    "compliment",
    "spam",
    "urgent_escalation",
)
BRAND_LABEL = "brand_message"

DOCUMENTED_ORDER = (
    "urgent_escalation",
    "spam",
    "refund_request",
    "order_inquiry",
    "complaint",
    "compliment",
)

PRICES_USD_PER_1M = (
    ("gemini-3.5-flash-lite", "0.30", "2.50"),
    ("gemini-3.5-flash", "0.75", "4.50"),
    ("gemini-2.5-flash-lite", "0.10", "0.40"),
    ("gemini-2.5-flash", "0.30", "2.50"),
)
DEFAULT_PRICE = ("0.10", "0.40")
FIRST_PASS_MODEL = "gemini-3.5-flash-lite"
REFINE_MODEL = "gemini-3.5-flash"

CUSTOMER = "customer"
BRAND = "brand"


class Precedence(Enum):
    """Order in which a thread's labels compete for the thread's primary label.

    ``DOCUMENTED`` is the published order; ``LABEL_ORDER`` ranks by position in ``LABELS``, which puts
    ``urgent_escalation`` last.  Both are offered because the two disagree in practice.
    """

    DOCUMENTED = DOCUMENTED_ORDER
    LABEL_ORDER = LABELS


@dataclass(frozen=True)
class RoutingConfig:
    precedence: Precedence = Precedence.DOCUMENTED
    positive_threshold: float = 0.70
    negative_threshold: float = 0.70
    compliment_max_chars: int = 200
    booking_max_chars: int = 80
    context_turns: int = 2
    batch_size: int = 25
    max_message_chars: int = 1200
    first_pass_model: str = FIRST_PASS_MODEL
    refine_model: str = REFINE_MODEL
    prices: tuple[tuple[str, str, str], ...] = PRICES_USD_PER_1M
    default_price: tuple[str, str] = DEFAULT_PRICE
    budget_usd: str = "0.50"
    # Messages of one thread that share a window task; longer threads are split into such chunks.
    chunk_turns: int = 4096
    # Classifier calls of one task: tasks grow with the batches, and a lost task repeats so many calls at most.
    # How many run at once is the cluster's or the classifier's to limit.
    calls_per_task: int = 100
    # Batches of the first slice, before any real cost is known, and of any later slice.
    first_slice: int = 8
    most_slice: int = 100_000
    # Buckets of merged parts of the result log, and how many new slices are merged at once.
    log_buckets: int = 64
    slices_to_merge: int = 32
    # How often a failed batch is asked again by the incremental form.
    attempts: int = 3
    # Free text that callers change when their classifier or its instructions change.
    classifier_version: str = "1"

    def fingerprint(self, model: str, source: str = "api") -> str:
        """Identity of who was asked and how; log rows made under another one are not reused."""
        asked = {
            "model": model,
            "source": source,
            "batch_size": self.batch_size,
            "context_turns": self.context_turns,
            "max_message_chars": self.max_message_chars,
            "classifier_version": self.classifier_version,
        }
        return hashlib.sha256(json.dumps(asked, sort_keys=True).encode()).hexdigest()
