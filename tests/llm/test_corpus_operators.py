"""Operators against brute force on odd rows, and on empty tables."""

import hashlib
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import odd_rows
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from convroute.llm import (
    chat,
    decontaminate,
    embeddings,
    packing,
    quality,
    registry,
    simhash,
    substrings,
    token_counts,
    toxicity,
    warc,
)
from convroute.llm.byte_bpe import Encoder, PrefixCounts
from convroute.llm.components import smallest_reachable
from convroute.llm.tables import row_keys
from convroute.llm.words import blank_separated, run_hashes, split_words, word_hashes

VOCABULARY = registry.VOCABULARY


@pytest.fixture(scope="module")
def documents(spark):
    return odd_rows.documents(spark).cache()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def pairs():
    return [(row[0], row[1]) for row in odd_rows.rows()]


def counted(rows):
    return Counter(map(repr, rows))


# --- Substring dedup ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "config",
    [
        substrings.WindowConfig(),
        substrings.WindowConfig(window=5, minimiser=2, bucket_rows=2, longest=7, counted_rows=3),
        substrings.WindowConfig(window=4, minimiser=4, bucket_rows=1, counted_rows=1),
    ],
)
def test_substrings(documents, config):
    few = documents.where("text is null or length(text) < 100000") if config.window < 35 else documents
    got = substrings.remove_repeats(few, config, carry=("source", "k1")).collect()
    rows = [r for r in odd_rows.rows() if config.window == 35 or r[1] is None or len(r[1]) < 100_000]
    want = brute.kept_words([r[1] for r in rows], config.window)
    assert counted(tuple(r) for r in got) == counted((r[0], r[3], 7, *w) for r, w in zip(rows, want))
    again = substrings.remove_repeats(few, config, untouched=True).where("n_removed = 0")
    assert counted(again.select("doc_id", "kept_text").collect()) == counted(
        few.sparkSession.createDataFrame(
            [(r[0], r[1]) for r, w in zip(rows, want) if not w[1]], "doc_id long, kept_text string"
        ).collect()
    )


def test_split_buckets_see_each_other(spark):
    """One passage in many contexts: its buckets are split into many parts, and so is a pair across parts."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(45)]
    texts = [" ".join([word() for _ in range(9)] + passage + [word() for _ in range(9)]) for _ in range(40)]
    texts += [" ".join([word() for _ in range(30)] + passage[:36])] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substrings.remove_repeats(df, substrings.WindowConfig(bucket_rows=3, counted_rows=2)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == dict(enumerate(brute.kept_words(texts, 35)))


# --- Embeddings -----------------------------------------------------------------------------------


def test_embeddings_odd_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 8))
    vectors = [list(map(float, v)) for v in base]
    vectors += [list(map(float, v + 0.02 * rng.normal(size=8))) for v in base[:6]]
    vectors += [vectors[0], [2 * c for c in vectors[1]], [1e-200 * c for c in vectors[2]], [-c for c in vectors[3]]]
    vectors += [None, [], [0.0] * 8, [None] * 8, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 2.0], [1.0, 2.0]]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)] + [(0, vectors[0], 1, "x"), (None, vectors[5], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, point int, id string")
    got = embeddings.near_duplicates(df).collect()

    def linked(i, j):
        x, y = rows[i][1], rows[j][1]
        return x is not None and y is not None and brute.cosine(x, y) >= 0.95

    label = brute.components(len(rows), linked)
    names = defaultdict(list)
    for i, row in enumerate(rows):
        if row[0] is not None:
            names[label[i]].append(row[0])
    want = [
        (row[0], sum(linked(i, j) for j in range(len(rows)) if j != i), min(names[label[i]], default=None))
        for i, row in enumerate(rows)
    ]
    assert counted(tuple(r) for r in got) == counted(want)


def test_embeddings_recall_at_the_threshold(spark):
    """Pairs of cosine 0.95 to 0.97 in random directions, where the search is hardest; small cells."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1)[:, None] * x
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = rng.uniform(0.9501, 0.97, len(x))[:, None]
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * noise])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    config = embeddings.QuantiserConfig(cell_members=40, cell_queries=100)
    got = embeddings.near_duplicates(df, config).toPandas().set_index("vec_id").sort_index()
    exact = (both / np.linalg.norm(both, axis=1)[:, None]) @ both.T >= 0.95
    links = exact.sum(1) - 1
    assert (got.n_links <= links).all()
    assert got.n_links.sum() >= 0.98 * links.sum()


@pytest.mark.parametrize("kind", ["rank 4", "rank 8", "hot cluster"])
def test_embeddings_find_every_link_in_many_lists(spark, kind):
    """Vectors of few or correlated dimensions, where partners lie far across the borders of 64 lists."""
    rng = np.random.default_rng(9)
    if kind == "hot cluster":
        spread = rng.normal(size=(5, 64)) / 8
        x = rng.normal(size=(4096, 64)) / 8
        x[:1365] = x[0] + 0.3 * rng.normal(size=(1365, 5)) @ spread
    else:
        rank = int(kind[-1])
        x = rng.normal(size=(4096, rank)) @ rng.normal(size=(rank, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    config = embeddings.QuantiserConfig(cell_members=300, cell_queries=1000)
    got = embeddings.near_duplicates(df, config).toPandas().set_index("vec_id").sort_index()
    units = x / np.linalg.norm(x, axis=1)[:, None]
    links = (units @ units.T >= 0.95).sum(1) - 1
    assert links.sum() > 1000 and (got.n_links == links).all()


def test_one_hot_group_of_vectors(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    vectors = [centre + 0.01 * rng.normal(size=64) for _ in range(300)] + list(rng.normal(size=(100, 64)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    config = embeddings.QuantiserConfig(cell_members=50, cell_queries=64)
    got = embeddings.near_duplicates(df, config).toPandas().set_index("vec_id").sort_index()
    assert (got.n_links[:300] == 299).all() and (got.component_id[:300] == 0).all()
    assert (got.n_links[300:] == 0).all() and (got.component_id[300:] == got.index[300:]).all()


# --- Token counts and packing ---------------------------------------------------------------------


def test_every_prefix_count(library):
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "'s", "'re", "'ll", "'", "re", "12", "é", "!", "<|endoftext|>", "<|endo",
             "\t", " ", "日本", "Thnt", ".", "\r\n", "́", "\U0001f600", "՘"]
    counter = PrefixCounts(VOCABULARY)
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 10)))
        counts, end = counter.counts(text), 0
        for i, char in enumerate(text):
            end += len(char.encode())
            want = len(library.encode(text[: i + 1], add_special_tokens=False).ids)
            assert counts[end - 1] == want, (text, i)
        assert len(counts) == end


def test_token_counts(documents, library):
    found = token_counts.prefix_counts(documents, VOCABULARY).cache()
    want = [
        (i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in pairs()
    ]
    assert counted(tuple(r) for r in found.select("doc_id", "n_bytes", "n_tokens").collect()) == counted(want)


def test_budget_questions(documents, library):
    text = odd_rows.texts()[8]
    row = documents.where(F.col("text") == text).limit(1)
    found = token_counts.prefix_counts(row, VOCABULARY).crossJoin(row.select("text"))
    budget = 50
    answers = found.select(
        token_counts.within_budget(budget)("prefix_increments", "text").alias("cut"),
        token_counts.tokens_before("prefix_increments", F.lit(20)).alias("before"),
    ).first()
    encode = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert answers["before"] == encode(text[:20])
    assert answers["cut"] == max(i for i in range(len(text) + 1) if encode(text[:i]) <= budget)


def test_encoder_equals_the_library(library):
    encoder = Encoder(VOCABULARY)
    odd = [t or "" for t in odd_rows.texts()] + [" " * 5000 + "a", "ab" * 3000, "".join(map(chr, range(0x250)))]
    odd += [f"a{chr(c)}1!{chr(c)}{chr(c)}b {chr(c)}" for c in range(0x250)]
    for text in odd:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("config", [packing.PackingConfig(), packing.PackingConfig(length=16, grid=4, block_tokens=64)])
def test_packing(documents, library, config):
    rows = packing.pack(documents, VOCABULARY, config).collect()
    # A document is found by its tokens: rows share ids.
    streams = Counter(
        (i, np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, t in pairs()
    )
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
        assert len(row.ids) == 4 * row.length > 0
    built, got = {}, Counter()
    padding = 0
    for sequence in sorted(sequences):
        place = 0
        for row in sorted(sequences[sequence], key=lambda r: r.offset):
            assert row.offset == place
            place += row.length
            if row.start == 0:
                built[row.doc_id] = b""
            assert len(built[row.doc_id]) == 4 * row.start
            built[row.doc_id] += row.ids
            if row.start + row.length == row.doc_tokens:
                got[row.doc_id, built.pop(row.doc_id)] += 1
        assert place <= config.length
        padding += 0 if place & (place - 1) == 0 else config.length - place
    assert got == streams and not built
    assert padding <= 0.05 * sum(r.length for r in rows)


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(6)
    for _ in range(60):
        places = np.cumsum(rng.integers(1, 4, 18))
        penalties = rng.integers(0, 6, len(places))
        length = 8
        stops = [0, *places.tolist()]
        best = [0.0]
        for j in range(1, len(stops)):
            reached = [i for i in range(j) if stops[j] - stops[i] <= length]
            best.append(min(best[i] + length - (stops[j] - stops[i]) + penalties[j - 1] for i in reached))
        cuts = packing.best_cuts(places, penalties, length)
        ends = [0, *[int(places[c]) for c in cuts]]
        sizes = np.diff(ends)
        assert (sizes <= length).all() and stops[-1] - ends[-1] < length
        assert sum(length - sizes) + sum(penalties[cuts]) == best[stops.index(ends[-1])]
        # What is left leads the next block, so it costs nothing yet.
        assert best[stops.index(ends[-1])] == min(b for s, b in zip(stops, best) if stops[-1] - s < length)


# --- Classifiers ----------------------------------------------------------------------------------


def toy(spark, n=240):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(5))
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        words = [word() for _ in range(40)]
        if bad:
            words[rng.randrange(40)] = "vile" + word()[:2]
        rows.append((i, " ".join(w.upper() + "!!" if i % 3 == 0 else w for w in words), int(bad), int(i % 3 > 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, module, label):
    rows = toy(spark)
    learn = rows.where("doc_id % 5 > 0").select("doc_id", label)
    config = toxicity.FtrlConfig(l1=1.0) if module is toxicity else quality.SupportConfig()
    model = module.fit(rows, learn, label, config)
    assert_same = module.fit(rows.repartition(5), learn.repartition(3), label, config)
    found = module.score(rows, model, config).join(rows.where("doc_id % 5 = 0"), "doc_id").collect()
    assert found == module.score(rows, assert_same, config).join(rows.where("doc_id % 5 = 0"), "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in found)
    assert sum((r.score >= 0.5) == bool(r[label]) for r in found) >= 0.9 * len(found)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_odd_rows(spark, documents, module, label):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(20)] + [(None, 1, 0), (3, None, None), (3, 0, 1), (3, 1, 0)],
        "doc_id long, toxic int, quality int",
    )
    for known in (labels, labels.limit(0), labels.where(f"{label} = 1")):
        model = module.fit(documents, known, label)
        scores = module.score(documents, model).collect()
        assert counted(r[0] for r in scores) == counted(i for i, _ in pairs())
        assert all(r.score is not None and 0 <= r.score <= 1 for r in scores)
    assert module.score(documents.limit(0), model).collect() == []


# --- Chat -----------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(7)
    parts = [*chat.CONTROLS, "\\", "<", "[", "s>", "a", " ", "é", "|", "<|endoftext|>", "\n", "INST]"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
    roles = ["user", "assistant", "system", "tool", "</s>", ""]
    rows = [(c, t, rng.choice(roles), text(), c) for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " * 30, 0) for t in range(400)]
    rows += [(None, 0, None, None, 0), (None, None, "assistant", "first", 0), (7, 99, "user", "tie", 0), (7, 99, "user", "tie", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids int")
    config = chat.ChatConfig(VOCABULARY, chunk_tokens=500)
    ordered = defaultdict(list)
    for c, t, role, body, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        ordered[c].append((role or "", body or ""))
    formatted = chat.format_conversations(df, config).cache()
    turns = defaultdict(list)
    for row in sorted(chat.read_turns(formatted, config).collect(), key=lambda r: (r.chunk, r.place)):
        turns[row.conv_id].append((row.role, row.text))
    assert turns == ordered
    assert formatted.where("chunk > 0").count() > 0
    for row in chat.digests(formatted, config).collect():
        turns = ordered[row.conv_id]
        said = "".join(body for role, body in turns if role == "assistant")
        whole = "".join(f"{role}\n{body}\n" for role, body in turns)
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(df.limit(0), config), config).collect() == []


def test_escaping_leaves_no_control_string():
    rng = random.Random(2)
    parts = [*chat.CONTROLS, "\\", "<", "[", "s>", "INST]", "a"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(6))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(control in escaped for control in chat.CONTROLS)
    chat.escape("<s>" * 100_000)  # linear


# --- SimHash --------------------------------------------------------------------------------------


def test_simhash_odd_rows(documents):
    got = simhash.near_duplicates(documents).select("doc_id", simhash.as_hex("fingerprint"), "component_id").collect()
    rows = pairs()
    prints = [brute.fingerprint(t) for _, t in rows]
    label = brute.components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    names = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            names[label[i]].append(key)
    want = [(rows[i][0], f"{prints[i]:016x}", min(names[label[i]], default=None)) for i in range(len(rows))]
    assert counted(tuple(r) for r in got) == counted(want)
    kept = simhash.one_of_each_group(documents)
    assert kept.columns == documents.columns
    # The smallest id of each group stays; a group without ids keeps one row.
    assert counted(r.doc_id for r in kept.collect()) == counted(min(names[g], default=None) for g in set(label))


def test_trees_find_every_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 800).astype(np.uint64)
    near = [base[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) for _ in range(5)]
    points = np.unique(np.concatenate([base, *near]))
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    want = {(i, j) for i, j in zip(*np.nonzero(close)) if i < j}
    tree, shards = simhash.shared_tree(points[::3], 50, 3)
    assert shards > 8
    got = set()
    for _, own, guests in simhash.routes(tree, points, 3):
        # Guests in three parts, as large shards have them.
        for part in range(3):
            for x, y in simhash.linked_pairs(points, own, guests[part::3], 3, 32, within=part == 0):
                got |= {(min(p), max(p)) for p in zip(x.tolist(), y.tolist())}
    assert got == want


def test_simhash_shards_agree_with_one(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    one = simhash.near_duplicates(df)
    many = simhash.near_duplicates(df, simhash.SimHashConfig(shard_points=10, guest_points=6, leaf_points=4))
    assert counted(one.collect()) == counted(many.collect())


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(5000, 5000), (1150, 999)]
    random.Random(3).shuffle(links)
    got = smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(301)} | {i: 999 for i in [999, 1000, *range(1001, 1201)]}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_unsettled_components_fail(spark, monkeypatch):
    monkeypatch.setattr("convroute.llm.components.MOST_ROUNDS", 2)
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled after 2 rounds"):
        smallest_reachable(links)


# --- Decontamination ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "config", [decontaminate.IndexConfig(), decontaminate.IndexConfig(window=3, block_words=50, phrases_per_block=4)]
)
def test_contamination(spark, documents, config):
    texts = odd_rows.texts()
    long = texts[12].split()
    items = [
        (1, " ".join(long[100:140])), (2, " ".join(long[300:305]).upper()), (3, texts[5]), (3, texts[5]), (4, None), (5, ""),
        (None, texts[6]), (6, "ha, ha! ha"), (7, "never found in any text"), (8, " ".join(long[110:150])),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    few = documents.where("text is null or length(text) < 100000")
    got = decontaminate.contamination(few, benchmark, config).select("doc_id", "n_words", "n_hit", "items").collect()
    rows = [(i, t) for i, t in pairs() if t is None or len(t) < 100_000]
    want = brute.contamination([t for _, t in rows], items, config.window)
    assert counted(tuple(r) for r in got) == counted((i, *w) for (i, _), w in zip(rows, want))
    kept = decontaminate.without_contaminated(few, benchmark, config)
    clean = [i for (i, _), (n, hit, _) in zip(rows, want) if not (hit and 20 * hit >= n)]
    assert kept.columns == few.columns and counted(r.doc_id for r in kept.collect()) == counted(clean)


def test_near_matches(spark):
    df = spark.createDataFrame(
        [(1, "alpha x beta y gamma"), (2, "alpha beta"), (3, "gamma z z z z z z z beta alpha")], "doc_id long, text string"
    )
    terms, phrases = decontaminate.query_set([(9, "gamma beta alpha")], 13)
    index = decontaminate.build_index(df, terms)
    counts = decontaminate.term_counts(index, len(terms))
    near = lambda slack: {r.key for r in decontaminate.search(index, phrases, counts, slack).collect() if r["items"]}
    assert near(4) == {1} and near(9) == {1, 3} and near(1) == set()
    assert not any(r["items"] for r in decontaminate.search(index, phrases, counts).collect())


# --- WARC -----------------------------------------------------------------------------------------


def test_revisits(spark):
    h = lambda **fields: [(k.replace("_", "-"), v) for k, v in fields.items()]
    rows = [
        (1, "HTTP://www.A.com:80/x/", 100, "response", 200, h(ETag='"a"', Age="9", Content_Type="t"), "old"),
        (2, "https://a.com/x", 200_000, "response", 200, h(ETag='"b"', Age="9", Set_Cookie="1"), "new"),
        (2, "https://a.com/x", 200_000, "response", 200, h(ETag='"b"', Age="9", Set_Cookie="1"), "new"),  # repeated
        (3, "https://a.com/x", 200_000, "response", 404, h(ETag='"c"'), "gone"),
        (10, "http://a.com/x#top", 150, "revisit", 304, h(etag='W/"a"', age="10", Content_Type="none"), None),
        (11, "http://a.com/x", 100, "revisit", 304, h(etag='"a"'), None),  # none earlier
        (12, "http://a.com/x", 900_000, "revisit", 304, h(ETag='"b"', SET_COOKIE="2", Connection="X", x="1"), None),
        (13, "http://a.com/x", 900_000, "revisit", 304, h(ETag='"a"'), None),
        (14, "http://a.com/x", 900_000, "revisit", 304, None, None),
        (14, "http://a.com/x", 900_000, "revisit", 304, None, None),
        (15, None, 900_000, "revisit", 304, h(ETag='"a"'), None),
        (16, "http://a.com/x", None, "revisit", 304, h(ETag='"a"'), None),
        (None, "http://a.com/X", 900_000, "revisit", 304, h(ETag='"a"'), None),
    ]
    schema = (
        "record_id long, url string, date long, record_type string, status int, "
        "headers array<struct<name:string,value:string>>, payload string, block int, found int, etag int"
    )
    df = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], schema.replace(", etag int", ", etag int"))
    got = warc.resolve_revisits(df).collect()
    states = counted((r.record_id, r.state, r.response_id, r.payload) for r in got)
    assert states == counted(
        [
            (10, "resolved", 1, "old"), (11, "no_response", None, None), (12, "resolved", 2, "new"),
            (13, "mismatch", 2, None), (14, "unchecked", 2, None), (14, "unchecked", 2, None),
            (15, "no_response", None, None), (16, "no_response", None, None), (None, "no_response", None, None),
        ]
    )
    headers = {r.record_id: sorted((h.name.lower(), h.value) for h in r.headers) for r in got if r.headers}
    assert headers[10] == [("age", "10"), ("content-type", "t"), ("etag", 'W/"a"')]
    assert headers[12] == [("age", "9"), ("etag", '"b"'), ("set-cookie", "2")]
    assert warc.resolve_revisits(df.limit(0)).collect() == []
    # Blocks of any width give the same rows.
    assert counted(warc.resolve_revisits(df, block_seconds=7).collect()) == counted(got)


# --- Empty tables ---------------------------------------------------------------------------------


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    assert substrings.remove_repeats(none).collect() == []
    assert token_counts.prefix_counts(none, VOCABULARY).collect() == []
    assert packing.pack(none, VOCABULARY).collect() == []
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_of_each_group(none).collect() == []
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, no_items).collect() == []
    assert all(r.n_hit == 0 for r in decontaminate.contamination(documents, no_items).collect())
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(vectors).collect() == []


# --- Hashes and keys ------------------------------------------------------------------------------


def thue_morse():
    """Two words that collide under every polynomial hash modulo a power of two."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomials_confuse(spark):
    one, other = thue_morse()
    around = [" ".join(f"{c}{i}" for i in range(17)) for c in "wv"]
    rows = [(1, f"{around[0]} {one} {around[1]}"), (2, f"{around[0]} {other} {around[1]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in substrings.remove_repeats(df).collect()] == [0, 0]
    items = spark.createDataFrame([(7, one)], "item_id long, text string")
    found = {r.doc_id: r.n_hit for r in decontaminate.contamination(df, items).collect()}
    assert found == {1: 1, 2: 0}


def test_hashes_of_runs():
    texts = ["a b c a b c", "x" * 100 + " a b c", "é ab", "", "ab é" + " c" * 9, "x" * 64 + " " + "x" * 65]
    words = split_words(pa.array(texts), blank_separated(lower=False))
    plain = [w for t in texts for w in t.split()]
    for which in (0, 1):
        hashes = word_hashes(words, which)
        for length in (1, 2, 3, 5, 7, 12):
            runs = run_hashes(hashes, length).tolist()
            names = [tuple(plain[i : i + length]) for i in range(len(plain) - length + 1)]
            assert len(runs) == len(names) and len(set(runs)) == len(set(names)) == len(set(zip(runs, names)))
    assert len(run_hashes(word_hashes(words)[:3], 4)) == 0


def test_row_keys_are_two_hashes(spark):
    rows = [(None, "a"), (None, None), (1, None), (1, "a"), (1, "")]
    df = spark.createDataFrame(rows, "id long, text string").withColumns(row_keys("id", "text"))
    found = df.withColumn("derived", F.xxhash64("text", F.lit(1))).collect()
    assert len({r.k1 for r in found}) == len({r.k2 for r in found}) == len(rows)
    # Chained from the first key, the second would follow from it whenever all other columns are null.
    for columns in (("id", "text"), ("text",)):
        again = df.select(*[k.alias(n) for n, k in row_keys(*columns).items()]).collect()
        steps = spark.createDataFrame([(r.k1,) for r in again], "k long").select(F.xxhash64("k", F.lit(1)), F.xxhash64(F.lit(1), "k"))
        assert not {r.k2 for r in again} & {x for row in steps.collect() for x in row}


def test_packing_behind_a_coalesced_task(spark):
    df = spark.createDataFrame([(i, "some words to pack " * (i % 70)) for i in range(400)], "doc_id long, text string")
    rows = packing.pack(df.repartition(4), VOCABULARY).coalesce(1).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    assert max(sizes.values()) <= 1024


def test_packing_cuts_at_boundaries(spark, sf_small):
    """No window ends inside a sentence if a boundary was within a tenth of it, and padding stays small."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").coalesce(1)
    encoder, ends_sentence = packing._encoder(VOCABULARY)
    windows = defaultdict(list)
    for r in packing.pack(docs, VOCABULARY).collect():
        border = ends_sentence[np.frombuffer(r.ids, "<u4")]
        border[-1] |= r.start + r.length == r.doc_tokens
        windows[r.sequence_id].append((r.offset, border))
    borders = [np.concatenate([b for _, b in sorted(w, key=lambda x: x[0])]) for w in windows.values()]
    full = [b for b in borders if len(b) & (len(b) - 1) or len(b) == 1024]
    assert len(full) > 100
    assert sum(not b[-1] and b[-102:].any() for b in full) <= 0.02 * len(full)
    assert sum(not b[-1] for b in full) <= 0.1 * len(full)
    assert sum(1024 - len(b) for b in full) <= 0.05 * 1024 * len(full)


def test_blocks_of_texts_without_words(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).coalesce(1)
    terms, _ = decontaminate.query_set([(1, "a b")], 13)
    index = decontaminate.build_index(df, terms, decontaminate.IndexConfig(block_words=1000))
    assert max(len(r["keys"]) for r in index.collect()) <= 2000
