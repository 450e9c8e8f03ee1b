"""Random strings against a plain restatement of the rules."""

import random
import re
import time

from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.functions import text as tx
from convroute.functions.signals import with_signals

# The patterns that the signals test.
ORDER = re.compile(r"#\s?\d{3,}|\b\d{3,}\s?(?:رقم|order)\b", re.I)
URL = re.compile(r"https?://|www\.", re.I)
PHONE = re.compile(r"\+?\d[\d\-\s]{7,}\d")
EMAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")


# Signal: (terms, emoji and patterns any of which sets it, whether negation undoes a term, what undoes it all).
_ORDERED = (ORDER,)
SIGNALS = {
    "is_risk": (lx.RISK_TERMS, (), (), False, ()),
    "is_spam_pattern": (lx.SPAM_TERMS, (), (), False, ()),
    "has_bare_url": ((), (), (URL,), False, (_ORDERED, lx.PHOTO_TERMS)),
    "has_refund": (lx.REFUND_TERMS, (), (), False, ()),
    "has_negative_keyword": (lx.NEGATIVE_TERMS, lx.NEGATIVE_EMOJI, (), True, ()),
    "has_positive_keyword": (lx.POSITIVE_TERMS, lx.POSITIVE_EMOJI, (), True, (lx.DECLINING_TERMS,)),
    "is_declining": (lx.DECLINING_TERMS, (), (), False, ()),
    "has_tracking": (lx.TRACKING_TERMS, (), _ORDERED, False, ()),
    "has_reservation": (lx.RESERVATION_TERMS, (), (), False, ()),
    "has_cancel": (lx.CANCEL_TERMS, (), (), False, ()),
    "has_question": ((), lx.QUESTION_MARKS, (), False, ()),
    "has_booking_detail": ((), (), (PHONE, EMAIL), False, ()),
}


def occurs(what, text, negatable=False):
    """Whether a pattern, or a term in lower case and not negated at its first place, is in the text."""
    if isinstance(what, re.Pattern):
        return what.search(text) is not None
    before, found, _ = text.lower().partition(what)
    return bool(found) and not (negatable and any(m in before[-20:] for m in lx.NEGATION_MARKERS))


def restated(text):
    out = {}
    for signal, (terms, emoji, patterns, negatable, undone_by) in SIGNALS.items():
        hit = any(occurs(t, text, negatable) for t in terms) or any(e in text for e in emoji)
        hit = hit or any(occurs(p, text) for p in patterns)
        out[signal] = hit and not any(occurs(w, text) for group in undone_by for w in group)
    return out


FRAGMENTS = (
    lx.RISK_TERMS + lx.SPAM_TERMS + lx.REFUND_TERMS + lx.CANCEL_TERMS + lx.TRACKING_TERMS + lx.RESERVATION_TERMS
    + lx.NEGATIVE_TERMS * 2 + lx.POSITIVE_TERMS * 2 + lx.DECLINING_TERMS + lx.PHOTO_TERMS + lx.NEGATIVE_EMOJI
    + lx.POSITIVE_EMOJI + lx.NEGATION_MARKERS * 3 + lx.QUESTION_MARKS
    + ("http://", "HTTPS://", "www.", "WWW.", "#", "12", "345", "١٢٣", "order", "ORDER", "رقم", "@", ".", "+", "-",
       "_", " ", "  ", "\n", "\u00a0", "\t", "a", "é", "x" * 9, "x" * 18, "\u2764", "\ufe0f", "0501234567", "Z")
)


def random_texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        parts = [rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 9))]
        parts = [p.upper() if rng.random() < 0.1 else p[: rng.randint(1, len(p))] if rng.random() < 0.1 else p for p in parts]
        yield rng.choice(("", " "))  .join(parts)


def test_signals_match_restatement(spark):
    texts = list(random_texts(20_000, seed=7))
    df = spark.createDataFrame(list(enumerate(texts)), "n long, text string").repartition(8)
    wrong = []
    for r in with_signals(df).toLocalIterator():
        want = restated(texts[r["n"]])
        got = {s: r[s] for s in lx.SIGNALS}
        if got != want:
            wrong.append((texts[r["n"]], {k: (got[k], want[k]) for k in want if got[k] != want[k]}))
    assert not wrong, wrong[:5]


def test_strip_and_blank(spark):
    rng = random.Random(3)
    alphabet = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2003\u2028\u2029\u202f\u205f\u3000\u200bab#م"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(5_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", tx.strip(F.col("text")).alias("s"), tx.is_blank(F.col("text")).alias("b")).collect():
        assert r["s"] == r["text"].strip(), repr(r["text"])
        assert r["b"] == (not r["text"].strip()), repr(r["text"])


def test_strip_takes_linear_time(spark):
    inner = "a" + " " * 200_000 + "b"
    df = spark.createDataFrame([(f"  {inner}\t",)], "text string")
    began = time.perf_counter()
    assert df.select(tx.strip(F.col("text"))).first()[0] == inner
    assert time.perf_counter() - began < 10


def test_two_decimals(spark):
    rng = random.Random(5)
    scores = [k / 1000 for k in range(63, 1001)] + [rng.uniform(0.07, 1) for _ in range(5_000)]
    scores += [0.845, 0.125, 0.375, 0.625, 0.875, 1.0, 0.995, 0.7]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    for r in df.select("s", tx.two_decimals(F.col("s")).alias("t")).collect():
        assert r["t"] == f"{r['s']:.2f}", r["s"]
