"""SQL twins of the registered queries, for an independent engine.

Written from the rules, not from the Spark expressions: term lists become OR-chains of ``contains``,
negation uses ``instr`` and ``substr``, patterns use RE2 forms without look-around.
"""

from __future__ import annotations

from convroute import lexicon as lx
from convroute.config import DOCUMENTED_ORDER, LABELS
from convroute.plans.sample import PHRASES, PLATFORMS, RAW_SENTIMENTS, SENTIMENTS

SPACE = r"\s\x0b\p{Z}\x{85}\x{1c}-\x{1f}"
WORD = r"\p{L}\p{N}_"
ORDER = (
    rf"(?i)#[{SPACE}]?\p{{Nd}}{{3,}}"
    rf"|(?:^|[^{WORD}])\p{{Nd}}{{3,}}[{SPACE}]?(?:رقم|order)(?:$|[^{WORD}])"
)
URL = r"(?i)https?://|www\."
PHONE = rf"\+?\p{{Nd}}[\p{{Nd}}\-{SPACE}]{{7,}}\p{{Nd}}"
EMAIL = rf"[{WORD}.+-]+@[{WORD}-]+\.[{WORD}.-]+"


def _s(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_s(v) for v in values) + "]"


def _any(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, {_s(t)})" for t in terms) + ")"


def _unnegated(terms) -> str:
    parts = []
    for t in terms:
        at = f"instr(tl, {_s(t)})"
        before = f"substr(tl, greatest(1, {at} - 20), least(20, {at} - 1))"
        parts.append(f"CASE WHEN contains(tl, {_s(t)}) THEN NOT {_any(before, lx.NEGATION_MARKERS)} ELSE false END")
    return "(" + " OR ".join(parts) + ")"


def _signals(source: str, keep: str) -> str:
    """Two steps: helper columns, then the twelve signals."""
    order = f"regexp_matches(text, {_s(ORDER)})"
    declining = _any("tl", lx.DECLINING_TERMS)
    return f"""
      SELECT {keep},
        {_any("tl", lx.RISK_TERMS)} AS is_risk,
        {_any("tl", lx.SPAM_TERMS)} AS is_spam_pattern,
        regexp_matches(text, {_s(URL)}) AND NOT (ordered OR {_any("tl", lx.PHOTO_TERMS)}) AS has_bare_url,
        {_any("tl", lx.REFUND_TERMS)} AS has_refund,
        {_unnegated(lx.NEGATIVE_TERMS)} OR {_any("text", lx.NEGATIVE_EMOJI)} AS has_negative_keyword,
        ({_unnegated(lx.POSITIVE_TERMS)} OR {_any("text", lx.POSITIVE_EMOJI)}) AND NOT {declining}
          AS has_positive_keyword,
        {declining} AS is_declining,
        {_any("tl", lx.TRACKING_TERMS)} OR ordered AS has_tracking,
        {_any("tl", lx.RESERVATION_TERMS)} AS has_reservation,
        {_any("tl", lx.CANCEL_TERMS)} AS has_cancel,
        contains(text, '?') OR contains(text, '؟') AS has_question,
        regexp_matches(text, {_s(PHONE)}) OR regexp_matches(text, {_s(EMAIL)}) AS has_booking_detail
      FROM (SELECT *, lower(text) AS tl, {order} AS ordered FROM {source})"""


MESSAGES = f"""
  SELECT conv_id || ':' || turn AS id, conv_id AS thread_idx, conv_id % 90 AS seed_id, turn AS turn_index,
    ({_list(PLATFORMS)})[conv_id % 5 + 1] AS platform,
    CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'brand' ELSE role END AS author,
    CASE WHEN role <> 'user' THEN text
         WHEN (conv_id + turn) % 2 = 0 THEN phrase
         ELSE text || ' ' || phrase END AS text,
    'cust_' || (conv_id % 90) AS customer_name,
    ({_list(SENTIMENTS)})[(conv_id * 5 + turn * 3) % 3 + 1] AS sentiment,
    ((conv_id * 37 + turn * 101) % 100) / 100.0::DOUBLE AS score
  FROM (SELECT *, ({_list(PHRASES)})[(conv_id * 7 + turn * 13) % {len(PHRASES)} + 1] AS phrase FROM conversations)"""

_MESSAGE_KEEP = "id, thread_idx, seed_id, turn_index, platform, author, text, customer_name, sentiment, score"

ROUTER = f"""
  SELECT *,
    CASE
      WHEN NOT regexp_matches(text, {_s(f"[^{SPACE}]")}) THEN 'empty_message'
      WHEN is_risk THEN 'risk_trigger_escalated_to_api'
      WHEN is_spam_pattern THEN 'spam_keyword'
      WHEN has_bare_url THEN 'url_no_context_escalated'
      WHEN has_refund AND has_positive_keyword THEN 'conflicting_refund_and_positive'
      WHEN has_negative_keyword AND has_positive_keyword THEN 'conflicting_negative_and_positive'
      WHEN has_refund THEN 'refund_keyword'
      WHEN (has_tracking OR has_reservation OR has_cancel) AND NOT has_negative_keyword
        THEN 'tracking_or_reservation_keyword'
      WHEN has_negative_keyword THEN 'negative_keyword_or_emoji'
      WHEN has_positive_keyword AND NOT has_question AND length(text) < 200 THEN 'positive_keyword_or_emoji'
      WHEN has_question THEN 'question_no_negative_signal'
      WHEN NOT has_positive_keyword AND length(text) < 80 AND has_booking_detail THEN 'booking_detail_pattern'
      ELSE 'no_confident_signal'
    END AS router_reason
  FROM sig WHERE author = 'customer'"""

ROUTED = """
  SELECT *,
    CASE router_reason
      WHEN 'spam_keyword' THEN 'spam'
      WHEN 'refund_keyword' THEN 'refund_request'
      WHEN 'tracking_or_reservation_keyword' THEN 'order_inquiry'
      WHEN 'negative_keyword_or_emoji' THEN 'complaint'
      WHEN 'positive_keyword_or_emoji' THEN 'compliment'
      WHEN 'question_no_negative_signal' THEN 'order_inquiry'
      WHEN 'booking_detail_pattern' THEN 'order_inquiry'
    END AS router_label
  FROM router"""

STAGE2 = """
  SELECT *,
    CASE
      WHEN is_risk OR is_spam_pattern OR has_bare_url THEN NULL
      WHEN has_refund THEN 'refund_request'
      WHEN (has_tracking OR has_reservation OR has_cancel) AND sentiment <> 'negative' THEN 'order_inquiry'
      WHEN sentiment = 'negative' AND score >= 0.70 THEN 'complaint'
      WHEN sentiment = 'positive' AND score >= 0.70 AND NOT has_question AND NOT is_declining THEN 'compliment'
      WHEN sentiment <> 'negative' AND has_question THEN 'order_inquiry'
    END AS stage2_label,
    CASE
      WHEN is_risk OR is_spam_pattern OR has_bare_url THEN 'stage1_signal_escalated'
      WHEN has_refund THEN 'refund_keyword_stage2'
      WHEN (has_tracking OR has_reservation OR has_cancel) AND sentiment <> 'negative' THEN 'tracking_keyword_stage2'
      WHEN sentiment = 'negative' AND score >= 0.70 THEN 'sentiment_negative_' || printf('%.2f', score)
      WHEN sentiment = 'positive' AND score >= 0.70 AND NOT has_question AND NOT is_declining
        THEN 'sentiment_positive_' || printf('%.2f', score)
      WHEN sentiment <> 'negative' AND has_question THEN 'question_stage2'
      ELSE 'sentiment_inconclusive'
    END AS sentiment_reason
  FROM routed WHERE router_label IS NULL"""

STANDIN = f"""CASE WHEN {_any("lower(text)", lx.STANDIN_REFUND_TERMS)} THEN 'refund_request'
    WHEN {_any("lower(text)", lx.STANDIN_COMPLAINT_TERMS)} THEN 'complaint' ELSE 'order_inquiry' END"""

# Result rows of each stage: router, sentiment, brand rule, stand-in.
PARTS = {
    "router_rows": """SELECT id, router_label AS label,
        CASE WHEN router_reason = 'booking_detail_pattern' THEN 'low' ELSE 'high' END AS confidence,
        'router' AS source, router_reason AS reason FROM routed WHERE router_label IS NOT NULL""",
    "sentiment_rows": """SELECT id, stage2_label AS label, 'high' AS confidence, 'sentiment' AS source,
        sentiment_reason AS reason FROM stage2 WHERE stage2_label IS NOT NULL""",
    "brand": """SELECT id, 'brand_message' AS label, 'n/a' AS confidence, 'rule' AS source,
        'brand_authored_not_a_customer_intent' AS reason FROM msg WHERE author = 'brand'""",
    "standin": f"""SELECT id, {STANDIN} AS label, 'low' AS confidence, 'api' AS source,
        'api_classified' AS reason FROM stage2 WHERE stage2_label IS NULL""",
}
LOCAL_ROWS = "SELECT * FROM router_rows UNION ALL SELECT * FROM sentiment_rows UNION ALL SELECT * FROM brand"
FINAL = f"{LOCAL_ROWS} UNION ALL SELECT * FROM standin"

CONTEXT = """
  SELECT *, concat_ws(' | ', lag(line, 2) OVER w, lag(line, 1) OVER w) AS joined, least(turn_index, 2) AS n_context
  FROM (SELECT *, author || ': ' || coalesce(text, 'None') AS line FROM msg)
  WINDOW w AS (PARTITION BY thread_idx ORDER BY turn_index)"""
BLOCK = "CASE WHEN n_context = 0 THEN '(first message in thread)' ELSE joined END"


def _with(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after the common steps it needs, in dependency order."""
    steps = {
        "msg": MESSAGES,
        "sig": _signals("msg", _MESSAGE_KEEP),
        "router": ROUTER,
        "routed": ROUTED,
        "stage2": STAGE2,
        **PARTS,
        "final": FINAL,
        "ctx": CONTEXT,
    }
    order = list(steps)
    wanted = order[: max((order.index(n) for n in names if n != "ctx"), default=0) + 1]
    if "ctx" in names:
        wanted = wanted + ["ctx"]
    ctes = [f"{n} AS MATERIALIZED ({steps[n]})" for n in wanted]
    ctes += [f"{n} AS MATERIALIZED ({sql})" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _batched(open_rows: str) -> str:
    return f"""SELECT *, (pos // 25) AS batch, (pos % 25)::INTEGER AS local_i FROM (
        SELECT *, row_number() OVER (ORDER BY thread_idx, turn_index) - 1 AS pos FROM ({open_rows}))"""


OPEN = "SELECT id, thread_idx, turn_index, text FROM stage2 WHERE stage2_label IS NULL"
LOW = "SELECT m.id, thread_idx, turn_index, text FROM msg m JOIN final USING (id) WHERE confidence = 'low'"


def _prompts(batched: str) -> str:
    clean = rf"replace(regexp_replace(b.text, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), chr(10), ' ')"
    return f"""
      SELECT batch, count(*)::INTEGER AS n_messages,
        'Classify these ' || count(*) || ' messages:' || chr(10) || chr(10)
          || string_agg(line, chr(10) ORDER BY local_i) AS prompt
      FROM (SELECT b.batch, b.local_i, '[' || b.local_i || '] context: ' || {BLOCK} || chr(10) || '    message: '
              || CASE WHEN cut = '' THEN '(empty message)' ELSE cut END AS line
            FROM (SELECT *, substr({clean}, 1, 1200) AS cut FROM {batched} b) b JOIN ctx USING (id))
      GROUP BY batch"""


def _calls(prompts: str, model: str) -> str:
    return f"""SELECT batch, '{model}' AS model, length(prompt) // 4 AS tin, n_messages * 10 AS tout FROM {prompts}"""


_FIRST_BATCHES = {"batched": _batched(OPEN), "prompts": _prompts("batched")}
_PLAN = {
    **_FIRST_BATCHES,
    "calls": _calls("prompts", "gemini-3.5-flash-lite"),
    "costed": "SELECT batch, (tin * 30 + tout * 250)::BIGINT AS units FROM calls",
    "plan": """SELECT batch, units, coalesce(sum(units) OVER (ORDER BY batch
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM costed""",
}
# Costs in units of 1e-8 USD: prices per million tokens have two decimals.
_BUDGET_UNITS = 300_000

_LABEL_LIST = _list(LABELS)
_REPLIES = {
    "batched": _batched("SELECT id, thread_idx, turn_index, text FROM routed WHERE router_label IS NULL"),
    "sizes": "SELECT batch, count(*) AS n FROM batched GROUP BY batch",
    "good": f"""SELECT batch, '[' || string_agg('{{"i":' || local_i || ',"label":"'
        || ({_LABEL_LIST})[(batch + local_i) % 6 + 1] || '","conf":"'
        || CASE WHEN local_i % 2 = 0 THEN 'high' ELSE 'low' END || '"}}', ',' ORDER BY local_i) || ']' AS body
        FROM batched GROUP BY batch""",
    "replies": """SELECT batch, n, CASE batch % 6 WHEN 0 THEN body
        WHEN 1 THEN '[{"i":"1","label":"complaint"},{"x":3}]'
        WHEN 2 THEN '[{"i":0,"label":"spam","conf":"high"},{"i":0,"label":"bogus","conf":"high"}]'
        WHEN 3 THEN '[{"i":2.7,"label":"spam","conf":"maybe"}]'
        WHEN 4 THEN '{"i":0,"label":"spam","conf":"high"}'
        ELSE 'not json' END AS body FROM sizes JOIN good USING (batch)""",
    "lists": """SELECT batch, n, CASE WHEN json_valid(body) AND json_type(body) = 'ARRAY'
        THEN json_extract(body, '$[*]') END AS els, json_valid(body) AS parsed FROM replies""",
    "items": """SELECT batch, n, pos, trunc(try_cast(el->>'$.i' AS DOUBLE))::BIGINT AS i, el->>'$.label' AS label,
        coalesce(el->>'$.conf', 'low') AS conf
        FROM (SELECT batch, n, unnest(els) AS el, generate_subscripts(els, 1) AS pos FROM lists WHERE els IS NOT NULL)""",
    "chosen": "SELECT batch, i, max_by(label, pos) AS label, max_by(conf, pos) AS conf FROM items GROUP BY batch, i",
}
_KNOWN = "label IN (" + ", ".join(_s(x) for x in LABELS) + ")"


def _summary(order) -> str:
    ranks = _list(order)
    return f"""
      SELECT thread_idx, any_value(seed_id) AS seed_id, any_value(platform) AS platform,
        any_value(customer_name) AS customer_name, count(*) AS n_customer_messages,
        min_by(label, list_position({ranks}, label)) AS primary_label,
        array_to_string([({ranks})[x] FOR x IN list_sort(list(DISTINCT list_position({ranks}, label)))], ', ')
          AS all_labels_seen,
        CASE WHEN bool_or(confidence = 'low') THEN 'yes' ELSE '' END AS has_low_confidence_turn
      FROM msg JOIN final USING (id) WHERE author = 'customer' GROUP BY thread_idx"""


_LABEL_COLS = "id, label, confidence, source, reason"
_SIGNAL_COLS = ", ".join(lx.SIGNALS)
_OUTPUT = """SELECT m.id, thread_idx, seed_id, turn_index, platform, author AS "from", text,
    coalesce(label, '') AS label, coalesce(confidence, '') AS confidence, coalesce(source, '') AS source,
    coalesce(reason, '') AS reason FROM msg m LEFT JOIN final USING (id)"""


def queries() -> dict[str, str]:
    distribution = """SELECT label, count(*) AS n_messages, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent
        FROM final GROUP BY label"""
    coverage = """
      SELECT n_messages, n_customer, n_brand, router_decided, sentiment_decided, model_decided, labelled,
        low_confidence, n_customer - router_decided - sentiment_decided AS to_model,
        100.0::DOUBLE * router_decided / greatest(n_customer, 1) AS router_percent,
        100.0::DOUBLE * (n_customer - router_decided - sentiment_decided) / greatest(n_customer, 1) AS to_model_percent
      FROM (SELECT count(*) AS n_messages, count(*) FILTER (author = 'customer') AS n_customer,
          count(*) FILTER (author = 'brand') AS n_brand, count(*) FILTER (source = 'router') AS router_decided,
          count(*) FILTER (source = 'sentiment') AS sentiment_decided, count(*) FILTER (source = 'api') AS model_decided,
          count(label) AS labelled, count(*) FILTER (confidence = 'low') AS low_confidence
        FROM msg LEFT JOIN final USING (id))"""
    audit = """
      SELECT threads, distinct_seeds, shared_seeds, threads - distinct_seeds AS reused, rows_lost_by_seed_key,
        colliding_keys
      FROM (SELECT count(DISTINCT thread_idx) AS threads, count(DISTINCT seed_id) AS distinct_seeds FROM msg),
        (SELECT count(*) AS shared_seeds FROM (SELECT seed_id FROM msg GROUP BY seed_id
          HAVING count(DISTINCT thread_idx) > 1)),
        (SELECT (sum(c) - count(*))::BIGINT AS rows_lost_by_seed_key, count(*) FILTER (c > 1) AS colliding_keys
          FROM (SELECT count(*) AS c FROM msg GROUP BY seed_id, turn_index))"""
    scored = f"""
      SELECT id, (['negative', 'neutral', 'positive'])[n % 3 + 1] AS sentiment, (n * 37 % 100) / 100.0::DOUBLE AS score
      FROM (SELECT id, CASE WHEN regexp_matches(text, {_s(f"[^{SPACE}]")}) THEN length(text) ELSE 1 END AS n
            FROM routed WHERE router_label IS NULL)"""
    refined = f"""SELECT id, {STANDIN} AS label, 'low' AS confidence, 'api_refine' AS source,
        'api_classified' AS reason FROM msg JOIN final USING (id) WHERE final.confidence = 'low'"""
    flat = """
      SELECT id, thread_idx, seed_id, turn_index, platform, author, text, customer_name,
        CASE WHEN turn_index = 0 THEN '(first message in thread)'
          ELSE concat_ws(' | ', lag(line, 2) OVER w, lag(line, 1) OVER w) END AS context_block
      FROM (SELECT *, author || ': ' || coalesce(text, 'None') AS line FROM msg)
      WINDOW w AS (PARTITION BY thread_idx ORDER BY turn_index)"""
    positions = f"""
      SELECT concat(dense_rank() OVER (ORDER BY thread_idx) - 1, ':', turn_index) AS id, seed_id, platform, author,
        coalesce(text, '') AS text, customer_name, context_block FROM ({flat})"""
    ingest = """
      SELECT row_number() OVER (ORDER BY conv) - 1 AS thread_idx, seed_id, platform, customer_name, n_messages
      FROM (SELECT thread_idx AS conv, any_value(seed_id) AS seed_id, any_value(platform) AS platform,
        any_value(customer_name) AS customer_name, count(*)::INTEGER AS n_messages FROM msg GROUP BY 1)"""
    meter = """
      SELECT model, count(*) AS calls, sum(tin)::BIGINT AS in_tok, sum(tout)::BIGINT AS out_tok,
        (sum(CASE model WHEN 'gemini-3.5-flash' THEN tin * 75 + tout * 450 ELSE tin * 30 + tout * 250 END)::DOUBLE
          / 100000000) AS cost
      FROM (SELECT * FROM calls UNION ALL SELECT * FROM calls2) GROUP BY model"""
    second = {
        "batched2": _batched(LOW),
        "prompts2": _prompts("batched2"),
        "calls2": _calls("prompts2", "gemini-3.5-flash"),
    }
    merged = f"""
      SELECT id, batch, CASE WHEN {_KNOWN} THEN label ELSE 'order_inquiry' END AS label,
        CASE WHEN {_KNOWN} THEN conf ELSE 'low' END AS confidence, NOT coalesce({_KNOWN}, false) AS missing,
        CASE WHEN {_KNOWN} THEN 'api_classified' ELSE 'api_missing_index' END AS reason
      FROM batched JOIN (SELECT batch FROM lists WHERE parsed) USING (batch)
        LEFT JOIN chosen ON chosen.batch = batched.batch AND chosen.i = local_i""".replace(
        "SELECT id, batch,", "SELECT id, batched.batch AS batch,"
    )
    quality = f"""
      SELECT * FROM (SELECT count(*) AS batches, count(*) FILTER (NOT parsed) AS failed_batches,
          count(*) FILTER (parsed AND els IS NULL) AS not_a_list, coalesce(sum(n), 0)::BIGINT AS messages FROM lists),
        (SELECT count(*) AS items, count(*) FILTER (NOT coalesce({_KNOWN}, false)) AS unknown_label,
          count(*) FILTER (conf NOT IN ('high', 'low')) AS unlisted_conf,
          count(*) FILTER (NOT coalesce(i BETWEEN 0 AND n - 1, false)) AS bad_index FROM items)"""
    normalise = f"""
      SELECT id, raw_label, CASE WHEN contains(lower(raw_label), 'pos') THEN 'positive'
          WHEN contains(lower(raw_label), 'neg') THEN 'negative' ELSE 'neutral' END AS sentiment
      FROM (SELECT conv_id || ':' || turn AS id,
          ({_list(RAW_SENTIMENTS)})[(conv_id * 5 + turn * 3) % {len(RAW_SENTIMENTS)} + 1] AS raw_label
        FROM conversations)"""
    log = """SELECT id, thread_idx, seed_id, turn_index, platform, author AS frm, label, confidence, source, reason
        FROM msg JOIN final USING (id)"""
    local = f"SELECT {', '.join('m.id' if c == 'id' else c for c in _LABEL_COLS.split(', '))} FROM msg m LEFT JOIN local_rows USING (id)"

    return {
        "ingest_threads": _with(ingest, "msg"),
        "ingest_json_array": _with(positions, "msg"),
        "flatten_messages": _with(flat, "msg"),
        "read_result_log": _with(log, "final"),
        "result_log_rejects": _with(
            """SELECT CASE author WHEN 'customer' THEN '{"id": "' || id || '", "lab'
                WHEN 'brand' THEN '{"id": "' || id || '", "batch": "' || turn_index || 'x"}' ELSE 'id ' || id END AS line,
              CASE author WHEN 'customer' THEN 'cut off' WHEN 'brand' THEN 'wrong type: batch'
                ELSE 'not an object' END AS reason FROM msg""",
            "msg",
        ),
        "author_split": _with(
            "SELECT author, count(*) AS n_messages FROM msg WHERE author IN ('customer', 'brand') GROUP BY author", "msg"
        ),
        "first_n_threads": _with("SELECT id, thread_idx, author, text FROM msg WHERE thread_idx < 50", "msg"),
        "message_context": _with(f"SELECT id, n_context::INTEGER AS n_context, {BLOCK} AS context_block FROM ctx", "ctx"),
        "signals": _with(f"SELECT id, {_SIGNAL_COLS} FROM sig WHERE author = 'customer'", "sig"),
        "signals_documents": "WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents) "
        + _signals("docs", "doc_id"),
        "router_stage": _with(
            """SELECT id, router_label AS label, CASE WHEN router_label IS NULL
              OR router_reason = 'booking_detail_pattern' THEN 'low' ELSE 'high' END AS confidence,
              router_reason AS reason FROM routed""",
            "routed",
        ),
        "residual_after_router": _with(
            "SELECT id, text, router_reason FROM routed WHERE router_label IS NULL", "routed"
        ),
        "sentiment_scores": _with(scored, "routed"),
        "normalise_sentiment": normalise,
        "sentiment_stage": _with("SELECT id, stage2_label AS label, sentiment_reason AS reason FROM stage2", "stage2"),
        "residual_after_sentiment": _with(
            "SELECT id, router_reason, sentiment_reason FROM stage2 WHERE stage2_label IS NULL", "stage2"
        ),
        "brand_rows": _with(
            "SELECT id, platform, label, confidence, source, reason FROM brand JOIN msg USING (id)", "brand"
        ),
        "offline_model_labels": _with(f"SELECT {_LABEL_COLS} FROM standin", "standin"),
        "assign_batches": _with("SELECT id, batch, local_i FROM batched", "stage2", extra={"batched": _batched(OPEN)}),
        "batch_prompts": _with(
            "SELECT batch, n_messages, prompt FROM prompts", "stage2", "ctx", extra=_FIRST_BATCHES
        ),
        "batch_cost": _with(meter, "final", "ctx", extra={**_PLAN, **second}),
        "budget_plan": _with(
            f"""SELECT batch, units::DOUBLE / 100000000 AS cost, before::DOUBLE / 100000000 AS spent_before,
              before < {_BUDGET_UNITS} AS runs FROM plan""",
            "stage2", "ctx", extra=_PLAN,
        ),
        "model_stage": _with(
            "SELECT id, batch, label, confidence, source, reason FROM standin JOIN batched USING (id)",
            "standin", extra={"batched": _batched(OPEN)},
        ),
        "merge_responses": _with(merged, "routed", extra=_REPLIES),
        "response_quality": _with(quality, "routed", extra=_REPLIES),
        "resume_pending": _with(
            f"SELECT id, batch FROM batched WHERE batch IN (SELECT batch FROM plan WHERE before >= {_BUDGET_UNITS})",
            "stage2", "ctx", extra=_PLAN,
        ),
        "resume_compacted": _with(
            f"SELECT id, batch FROM batched WHERE batch IN (SELECT batch FROM plan WHERE before >= {_BUDGET_UNITS})",
            "stage2", "ctx", extra=_PLAN,
        ),
        "refine_candidates": _with("SELECT id, label, source, reason FROM final WHERE confidence = 'low'", "final"),
        "refine_pass": _with(refined, "final"),
        "all_results": _with(
            f"SELECT {_LABEL_COLS}, CASE source WHEN 'api' THEN 1 ELSE 0 END AS pass_no FROM final", "final"
        ),
        "merge_last_wins": _with(
            f"SELECT {_LABEL_COLS} FROM final WHERE confidence <> 'low' UNION ALL SELECT * FROM refined",
            "final", extra={"refined": refined},
        ),
        "labels_output": _with(_OUTPUT, "final"),
        "labels_csv_roundtrip": _with(_OUTPUT, "final"),
        "stored_context": _with(f"SELECT id, n_context::INTEGER AS n_context, {BLOCK} AS context_block FROM ctx", "ctx"),
        "stored_labels": _with(_OUTPUT, "final"),
        "stored_summary": _with(_summary(DOCUMENTED_ORDER), "final"),
        "full_run": _with(_OUTPUT, "final"),
        "published_outputs": _with(_OUTPUT, "final"),
        "written_summary": _with(_summary(DOCUMENTED_ORDER), "final"),
        "thread_summary": _with(_summary(DOCUMENTED_ORDER), "final"),
        "thread_summary_label_order": _with(_summary(LABELS), "final"),
        "label_distribution": _with(distribution, "final"),
        "stage_coverage": _with(coverage, "final"),
        "written_label_distribution": _with(distribution, "final"),
        "written_stage_coverage": _with(coverage, "final"),
        "incremental_coverage": _with(
            coverage.replace("JOIN final", "JOIN local_rows"), "brand", extra={"local_rows": LOCAL_ROWS}
        ),
        "reason_breakdown": _with(
            "SELECT source, reason, count(*) AS n_messages FROM final GROUP BY source, reason", "final"
        ),
        "seed_collision_audit": _with(audit, "msg"),
        "incremental_context": _with(
            f"SELECT id, n_context::INTEGER AS n_context, {BLOCK} AS context_block FROM ctx", "ctx"
        ),
        "incremental_triage": _with(local, "brand", extra={"local_rows": LOCAL_ROWS}),
        "incremental_model_stage": _with(f"SELECT {_LABEL_COLS} FROM standin", "standin"),
        "incremental_corrections": _with(
            _summary(DOCUMENTED_ORDER).replace("JOIN final", "JOIN corrected"),
            "final",
            extra={
                "corrected": """SELECT id, CASE WHEN confidence = 'low' THEN 'complaint' ELSE label END AS label,
                    CASE WHEN confidence = 'low' THEN 'high' ELSE confidence END AS confidence FROM final"""
            },
        ),
        "incremental_thread_summary": _with(_summary(DOCUMENTED_ORDER), "final"),
    }
