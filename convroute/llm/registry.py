"""Registered queries of the subpackage: each takes (spark, sf_dir) and works on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convroute.llm import (
    chat,
    decontaminate,
    embeddings,
    hard_negatives,
    packing,
    quality,
    run_index,
    simhash,
    spelling,
    substrings,
    token_counts,
    toxicity,
    warc,
)
from convroute.llm.ngrams import remainder
from convroute.llm.tables import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CHAT = chat.ChatConfig(VOCABULARY)
TOKEN_LIMIT = 512
TOXIC_FROM = 0.5
GOOD_FROM = 0.7
SLIPS_ONE_IN = 31


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_counts(table(spark, sf_dir, "documents"), VOCABULARY)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def toxicity_scores(spark: SparkSession, documents: DataFrame, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, carried columns) of ``documents``, fitted on their labelled rows that are not held out."""
    learn = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.fit(documents, learn.select("doc_id", "toxic"), "toxic")
    return toxicity.score(documents, model, carry=carry)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(spark, table(spark, sf_dir, "documents"), sf_dir)
    return scores.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_conversations(conversations, CHAT), CHAT)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of every page: a response, and revisits that agree by tag, by date, by nothing, or come too early."""
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    modified = F.concat(F.lit("day "), F.floor(F.col("page_id") / 7).cast("string"))

    def named(**values: Column | str) -> Column:
        return F.array(
            *[
                F.struct(F.lit(name.replace("_", "-")).alias("name"), (F.lit(v) if isinstance(v, str) else v).alias("value"))
                for name, v in values.items()
            ]
        )

    stored = named(
        ETag=tag, Last_Modified=modified, Content_Type="text/html", Content_Length=F.length("html").cast("string"),
        Cache_Control="max-age=60", Age="1",
    )
    by_tag = named(etag=F.concat(F.lit("W/"), tag), cache_control="max-age=600", content_length="0", connection="x-hop",
                   x_hop="1", x_served="cache")
    by_date = named(Last_Modified=modified, Date="later", Content_Type="none")
    other = named(ETag='"other"', Last_Modified=modified)
    bare = named(Date="later")
    captures = [
        (0, 0, "response", 200, stored), (1, 40, "revisit", 304, by_tag), (2, 90_000, "revisit", 304, by_date),
        (3, 50, "revisit", 304, other), (4, 60, "revisit", 304, bare), (5, -1, "revisit", 304, by_tag),
    ]
    each = F.explode(
        F.array(
            *[
                F.struct(
                    (F.col("page_id") * 8 + k).alias("record_id"), (F.col("page_id") * 10 + after).alias("date"),
                    F.lit(kind).alias("record_type"), F.lit(status).alias("status"), headers.alias("headers"),
                )
                for k, after, kind, status, headers in captures
            ]
        )
    )
    pages = table(spark, sf_dir, "pages").select("url", "html", each.alias("c"))
    return pages.select(
        "url", "c.*", F.when(F.col("c.record_type") == "response", F.col("html")).alias("payload")
    )


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc_records(spark, sf_dir))
    lines = F.transform("headers", lambda h: F.concat(F.lower(h["name"]), F.lit(": "), h["value"]))
    return found.select(
        "record_id", "canonical", "date", "state", "response_id",
        F.array_join(F.array_sort(lines), "; ").alias("headers"),
        F.sha2("payload", 256).alias("payload_sha256"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learn = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    scores = quality.score(documents, quality.fit(documents, learn.select("doc_id", "quality"), "quality"))
    return scores.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def piece_rows(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_rows(packing.pack(table(spark, sf_dir, "documents"), VOCABULARY))


def op11_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_index.remove_earlier_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", changed)
    return hard_negatives.hard_negatives(rows, anchors=F.col("id") % 50 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.with_slips(spelling.runs(table(spark, sf_dir, "documents")), SLIPS_ONE_IN)
    return spelling.variants(spelling.vocabulary(words))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_simhash": op6_simhash,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_run_index": op11_run_index,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling": op13_spelling,
}

OP2_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN least USING (vec_id) LEFT JOIN degrees USING (vec_id)
"""

# The texts here hold no control strings but those of conversation -1, of which each is escaped by one character.
OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length(text) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4
                    ELSE 23 + length(role) END
                    + CASE WHEN conv_id = -1 THEN 3 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP7_SQL = r"""
WITH p AS (
  SELECT page_id, html, '"' || md5(html) || '"' AS tag, 'day ' || (page_id // 7) AS modified,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u
  FROM pages
), c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')
            || regexp_replace(regexp_extract(u, '^[^/?]*(.*)$', 1), '^([^?]*)/(\?|$)', '\1\2') AS canonical
  FROM p
), r AS (
  SELECT page_id * 8 + k AS record_id, canonical, page_id * 10 + dt AS date, k, tag, modified, html
  FROM c, (VALUES (0, 0), (1, 40), (2, 90000), (3, 50), (4, 60), (5, -1)) AS x(k, dt)
), m AS (
  SELECT v.record_id, v.canonical, v.date, v.k, v.tag, v.modified,
         arg_max(f, (f.date, f.record_id)) FILTER (f.record_id IS NOT NULL) AS f
  FROM r v LEFT JOIN r f ON f.k = 0 AND f.canonical = v.canonical AND f.date < v.date
  WHERE v.k > 0 GROUP BY ALL
), s AS (
  SELECT *, CASE WHEN f IS NULL THEN 'no_response' WHEN k = 3 THEN 'mismatch' WHEN k = 4 THEN 'unchecked'
                 WHEN k = 2 THEN CASE WHEN modified = f.modified THEN 'resolved' ELSE 'mismatch' END
                 WHEN tag = f.tag THEN 'resolved' ELSE 'mismatch' END AS state
  FROM m
)
SELECT record_id, canonical, date, state, f.record_id AS response_id,
       CASE WHEN state = 'resolved' THEN array_to_string(list_sort(
         ['content-type: text/html', 'content-length: ' || length(f.html), 'age: 1'] || CASE WHEN k = 2
           THEN ['etag: ' || f.tag, 'last-modified: ' || modified, 'cache-control: max-age=60', 'date: later']
           ELSE ['etag: W/' || tag, 'last-modified: ' || f.modified, 'cache-control: max-age=600', 'x-served: cache']
         END), '; ') END AS headers,
       CASE WHEN state = 'resolved' THEN sha256(f.html) END AS payload_sha256
FROM s
"""

OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY x) AS n FROM places) WHERE n > 1
), removed AS (
  SELECT r, count(*) AS n, list(p) AS ps FROM gone GROUP BY r
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p)
  GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""

# Windows of 13 words are compared as text, one row per place.
OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT r, i, n, item_id FROM places JOIN windows USING (n, x)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

# Texts as hexadecimal digits, two for each byte.
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(length(hex(encode(coalesce(text, '')))) // 2 AS BIGINT) AS n
  FROM documents
), places AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS x FROM (SELECT *, unnest(range(n - 99)) AS p FROM d WHERE n >= 100)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY x ORDER BY doc_id, p) AS k FROM places)
  WHERE k > 1
), marked AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS opens
  FROM later
), numbered AS (
  SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked
), spans AS (
  SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
), sums AS (
  SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed FROM spans GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(from_hex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

# The checksum runs over the bytes of id and run; numbers of runs are found by position, one row for each.
OP13_SQL = r"""
WITH RECURSIVE step(b, k, v) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) AS t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM step WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8
), found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), runs AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM found GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(
           list_transform(range(0, strlen(id || ':' || run)),
                          lambda i: CAST('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2) AS BIGINT)),
           lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295), 4294967295) AS h
  FROM runs, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest, n
  FROM (SELECT *, unnest(range(length(word))) AS i FROM v)
), near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cuts c JOIN v ON c.rest = v.word
  UNION SELECT v.word, c.word FROM cuts c JOIN v ON c.rest = v.word
), best AS (
  SELECT near.word, count(*) AS n_near, max(n) AS form_n FROM near JOIN v ON v.word = other GROUP BY near.word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)
), named AS (
  SELECT f.*, (SELECT min(other) FROM near JOIN v ON v.word = other WHERE near.word = f.word AND v.n = f.form_n) AS form
  FROM forms f
), follow(word, root) AS (
  SELECT word, word FROM named
  UNION ALL SELECT follow.word, named.form FROM follow JOIN named ON named.word = follow.root WHERE named.form IS NOT NULL
)
SELECT named.word, named.n, named.n_near, named.form, named.form_n, root
FROM named JOIN follow USING (word) JOIN named ends ON ends.word = root WHERE ends.form IS NULL
"""

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_embedding_dedup": OP2_SQL,
    "op5_chat_formatting": OP5_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_run_index": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_spelling": OP13_SQL,
}
