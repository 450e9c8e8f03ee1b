"""Byte-level BPE over whole corpora: texts cut where tokens never cross, values kept for frequent pieces.

No token of the vocabulary reaches from a non-blank character to a blank after it, whatever follows, so a text
may be cut before every blank that follows a non-blank.  Each such unit (mostly one blank and one word) has the
same tokens alone as in its text, so values of units are kept in a bounded table and joined per text.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import chain
from operator import sub

import ahocorasick
import numpy as np
import tiktoken
from tokenizers import Tokenizer

SPECIAL = "<|endoftext|>"

#: White space of Unicode, as the tokenizer's own pattern understands it (fixed values).
WHITE = frozenset(
    [chr(c) for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    + [chr(c) for c in range(0x2000, 0x200B)]
)

#: The vocabulary's pre-token pattern spelt out for characters below U+0250, where classes are settled; texts with
#: others are left to the library's own splitter (fixed value).
_LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
_NUMBERS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
_BLANKS = "\\t-\\r \\x85\\xa0"
SETTLED = "\u0250"
PRETOKENS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)

#: Contractions that have a shorter prefix which splits into two pre-tokens.
LONG_CONTRACTIONS = frozenset(("'re", "'ve", "'ll"))

#: Bounds of the tables each Python worker keeps: entries of each half, their characters, and pairs of tokens.
KEPT_UNITS = 300_000
KEPT_PRETOKENS = 250_000
KEPT_LENGTH = 48
KEPT_PAIRS = 500_000


class UnitValues:
    """Bytes per text, joined from bytes per unit.

    ``compute`` turns a list of units into one bytes value each.  Short units are kept in two tables of at most
    ``KEPT_UNITS`` entries: a unit found in the older one moves to the newer one, and when that is full it becomes the
    older one.  So frequent units stay, and what is dropped costs time but never changes a value.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable[bytes]]):
        self._compute = compute
        self._after_blank: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self._after_blank) > KEPT_UNITS:
            self._older, self._after_blank = self._after_blank, {}
        chunks = [text.split(" ") for text in texts]
        missing: set[str] = set()
        for words in chunks:
            missing.update(set(words).difference(self._after_blank))
        if self._older:
            for word in missing.intersection(self._older):
                self._after_blank[word] = self._older[word]
            missing.difference_update(self._after_blank)
        fresh = [word for word in missing if word and word[-1] not in WHITE and len(word) <= KEPT_LENGTH]
        self._after_blank.update(zip(fresh, self._compute([" " + word for word in fresh]), strict=True))
        return [self._join(words) for words in chunks]

    def _join(self, words: list[str]) -> bytes:
        parts = list(map(self._after_blank.get, words))
        parts[0] = None
        others: list[str] = []
        places: list[int] = []
        unit: list[str] = []
        for place in (i for i, part in enumerate(parts) if part is None):
            # A unit goes on while it ends in white space; the word after it then loses its own value.
            if parts[place] is not None:
                continue
            unit, at = [words[place]], place
            while (not words[at] or words[at][-1] in WHITE) and at + 1 < len(words):
                at += 1
                unit.append(words[at])
                parts[at] = b""
            text = " ".join(unit)
            others.append(" " + text if place else text)
            places.append(place)
        for place, value in zip(places, self._compute(others), strict=True):
            parts[place] = value
        return b"".join(parts)


def bytes_of_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: itself if printable, else counted from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts, as the ``tokenizers`` library gives them for the vocabulary file.

    Texts of settled characters go through the faster ``tiktoken`` with ranks taken from the same file, which gives
    the same ids (tests compare them); others, and texts with very long pieces, go through ``tokenizers`` itself.
    """

    LONG_PIECE = 2000

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = bytes_of_symbols()
        ranks = {bytes(byte[c] for c in token): number for token, number in vocabulary.items()}
        special = {SPECIAL: self._library.token_to_id(SPECIAL)}
        self._fast = tiktoken.Encoding("vocabulary", pat_str=PRETOKENS.pattern, mergeable_ranks=ranks, special_tokens=special)
        self.size = self._library.get_vocab_size(with_added_tokens=True)

    def token(self, number: int) -> str:
        return self._library.id_to_token(number) or ""

    def ids(self, text: str) -> np.ndarray:
        settled = (
            max(text, default="") < SETTLED
            and max(map(len, text.split(" "))) < self.LONG_PIECE
            and " " * self.LONG_PIECE not in text
        )
        if settled:
            return self._fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)


class PrefixCounts:
    """Exact number of tokens of every prefix of a text, by dynamic programming over its bytes.

    For each prefix there is exactly one token that can end its encoding.  Of the vocabulary tokens that end
    there (found by one automaton), it is the one that may follow the last token of the prefix before it, and
    the count is one more than that prefix's.  Two tokens may stand side by side if encoding their bytes
    together gives just these two.  Values are increments, one signed byte for each byte of text: their running
    sum is the count at each prefix.
    """

    def __init__(self, path: str):
        self._pre_tokens = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte = bytes_of_symbols()
        raw = {token: bytes(byte[c] for c in token).decode("latin-1") for token in model["vocab"]}
        self._automaton = ahocorasick.Automaton()
        for token, number in model["vocab"].items():
            self._automaton.add_word(raw[token], (len(raw[token]), number))
        self._automaton.make_automaton()
        self._merged: dict[tuple[int, int], int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = model["vocab"][left], model["vocab"][right]
            whole = model["vocab"][left + right]
            self._merged[pair] = whole
            self._halves[whole] = pair
        self._beside: dict[tuple[int, int], bool] = {}
        # Pre-tokens stand alone and beside signs, so their counts are kept too, in two tables like the units.
        self._known: dict[str, list[int]] = {}
        self._older: dict[str, list[int]] = {}

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens before both are complete.

        Merges run by rank, which is the token number.  Both tokens are taken apart again, latest merge first,
        and each pair that met at the border must not merge sooner than what was taken apart last; of equal
        ranks the one further left runs first.
        """
        before = len(self._merged) + 256
        while True:
            joined = self._merged.get((left, right))
            if joined is not None and joined < before:
                return False
            if left > right and left in self._halves:
                before, left = left, self._halves[left][1]
            elif right in self._halves:
                before, right = right + 1, self._halves[right][0]
            else:
                return True

    def _split(self, text: str) -> list[str]:
        if max(text, default="") < SETTLED:
            return PRETOKENS.findall(text)
        return [text[start:end] for _, (start, end) in self._pre_tokens(text)]

    def _counts(self, token: str) -> list[int]:
        """Counts at each byte of one pre-token."""
        known = self._known.get(token)
        if known is not None:
            return known
        known = self._older.get(token)
        if known is None:
            known = self._walk(token)
        if len(token) <= KEPT_LENGTH:
            if len(self._known) > KEPT_PRETOKENS:
                self._older, self._known = self._known, {}
            self._known[token] = known
        return known

    def _walk(self, token: str) -> list[int]:
        """The dynamic programme over one pre-token."""
        last: list[int] = []
        counts: list[int] = []
        beside, done = self._beside, 0
        known, add_last, add_count = beside.get, last.append, counts.append
        raw = token if token.isascii() else token.encode().decode("latin-1")
        for end, (length, number) in self._automaton.iter(raw):
            if end < done:
                continue
            start = end - length
            if start >= 0:
                pair = last[start], number
                good = known(pair)
                if good is None:
                    if len(beside) > KEPT_PAIRS:
                        beside.clear()
                    good = beside[pair] = self._stay_apart(*pair)
                if not good:
                    continue
                add_count(counts[start] + 1)
            else:
                add_count(1)
            add_last(number)
            done += 1
        if token in LONG_CONTRACTIONS:
            counts[1] = 2
        return counts

    def _ordinary(self, text: str) -> list[int]:
        """Counts at each byte of a text without special tokens."""
        tokens = self._split(text)
        if len(tokens) == 1:
            return self._counts(tokens[0])
        out: list[int] = []
        base, run_base, blanks = 0, 0, ""
        for token in tokens:
            counts = self._counts(token)
            added = [base + c for c in counts] if base else counts
            if blanks and token[0] in WHITE:
                # A prefix that ends here ends in one undivided run of white space.
                width = len(token[0].encode())
                run = self._counts(blanks + token[0])
                added = [base - run_base + c for c in run[-width:]] + added[width:]
            out += added
            run_base = counts[-1]
            base += run_base
            blanks = token if token[-1] in WHITE else ""
        return out

    def counts(self, text: str) -> list[int]:
        """Token count of the prefix that ends with each byte of ``text``."""
        out: list[int] = []
        base = 0
        parts = text.split(SPECIAL)
        for i, part in enumerate(parts):
            open_end = self._ordinary(part + SPECIAL[:-1] if i + 1 < len(parts) else part)
            inside = len(part.encode())
            out += [base + c for c in open_end]
            base += open_end[inside - 1] if inside else 0
            if i + 1 < len(parts):
                base += 1
                out.append(base)
        return out

    def increments(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if text[:1] == " " and text.isascii() and text[1:].isalpha():
                counts = self._counts(text)  # one pre-token
            else:
                counts = self._ordinary(text) if SPECIAL not in text else self.counts(text)
            # Less the count before; map stops with the shorter one.
            out.append(array("b", map(sub, counts, chain((0,), counts))).tobytes())
        return out
