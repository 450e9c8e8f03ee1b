"""Spelling variants by the bit-sliced index, against brute force."""

import random
import re
import zlib
from collections import Counter

import odd_rows
import pytest

from convroute.llm import spelling
from convroute.llm.spelling import PositionIndex, SpellingConfig

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = SpellingConfig(shard_words=30, cell_members=20, cell_queries=7)


def edits(word, alphabet):
    cut = {word[:i] + word[i + 1 :] for i in range(len(word))}
    put = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    swap = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in alphabet}
    return (cut | put | swap) - {word}


def brute(counts, factor=10):
    """Rows of (word, n, n_near, form, form_n, root) for a vocabulary."""
    alphabet = set("".join(counts))
    rows, form = {}, {}
    for word, n in counts.items():
        if len(word) < 1000:
            near = edits(word, alphabet) & counts.keys()
        else:
            near = {o for o in counts if o != word and abs(len(o) - len(word)) < 2 and len(o) > 1000 and word in edits(o, alphabet)}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best and counts[best] >= factor * n else None
        rows[word] = n, len(near)
    def root(word):
        return root(form[word]) if form[word] else word
    return sorted((w, n, k, form[w], counts[form[w]] if form[w] else None, root(w)) for w, (n, k) in rows.items())


def words_of(rows, one_in=31):
    out = []
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out.append(run)
    return out


def found(words, config=SpellingConfig()):
    got = spelling.variants(words, config)
    return sorted(tuple(r) for r in got.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("config", [SpellingConfig(), SMALL])
def test_vocabulary(spark, config):
    rng = random.Random(7)
    roots = ["".join(rng.choice("abcéÿ") for _ in range(rng.randint(7, 10))) for _ in range(60)]
    counts = Counter()
    for word in roots:
        counts[word] = rng.choice((2, 30, 400))
        for near in rng.sample(sorted(edits(word, "abcéÿ")), 12):
            if len(near) >= 7:
                counts[near] = rng.choice((2, 3, 40))
            for further in rng.sample(sorted(edits(near, "ab")), 2):
                if len(further) >= 7:
                    counts[further] = 2
    counts |= {"abcabcab": 5000, "abcabcabc": 300, "abcabcabca": 20, "abcabcabcab": 2}  # a chain of forms
    counts |= {"tttttta": 20, "ttttttb": 20, "tttttt" + "c": 2}  # a tie
    counts |= {"qqq" + "".join(rng.choice("qr") for _ in range(8)): rng.randint(2, 50) for _ in range(300)}  # one beginning
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert found(df, config) == brute(counts)


@pytest.mark.parametrize("config", [SpellingConfig(), SMALL])
def test_odd_rows(spark, config):
    rows = [(r[0], r[1]) for r in odd_rows.rows()]
    rows += [(40, "x" * 5001 + " " + "x" * 5000 + "É " + "x" * 5000), (41, "x" * 5001 + " " + "x" * 5000 + "É "), (42, "X" * 5000)]
    df = spark.createDataFrame([(*r, 1, 1, "w") for r in rows], "doc_id long, text string, n int, id int, word string").repartition(3)
    words = spelling.with_slips(spelling.runs(df), 31)
    want = Counter(words_of(rows))
    assert Counter(r.word for r in words.collect()) == want
    counts = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    assert found(spelling.vocabulary(words), config) == brute(counts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert found(spelling.vocabulary(spelling.with_slips(spelling.runs(df), 31))) == []


def test_bitsets():
    """Bits of every position, and near members of both kinds, for more members than one word of bits holds."""
    rng = random.Random(9)
    members = sorted({"".join(rng.choice("abç") for _ in range(rng.randint(7, 9))) for _ in range(400)})
    index = PositionIndex(members, 3)
    for position in (0, 4, 8, 9):
        bits = index.at(position)
        for number, letter in enumerate(index.letters):
            want = sum(1 << i for i, m in enumerate(members) if m[position : position + 1] == chr(letter))
            assert int.from_bytes(bits[number].tobytes(), "little") == want
    queries = [m for m in members if len(m) == 8] + ["aaaaaaaa", "zzzzzzzz"]
    for query, same, other in zip(queries, *index.near(queries), strict=True):
        near = edits(query, "abçz")
        for bits, alike in ((same, True), (other, False)):
            want = sum(1 << i for i, m in enumerate(members) if m in near and (m[:3] == query[:3]) == alike)
            assert int.from_bytes(bits.tobytes(), "little") == want
