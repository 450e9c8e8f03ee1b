"""The registered queries: each takes (spark, sf_dir), reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convroute import lexicon as lx
from convroute.config import BRAND, CUSTOMER, FIRST_PASS_MODEL, REFINE_MODEL, Precedence, RoutingConfig
from convroute.functions.rules import normalised_sentiment, standin_label
from convroute.functions.signals import with_signals
from convroute.operators import audits, authors, context, merge, numbering, requests, responses, rollup, stages
from convroute.operators.standin import fill_with_standin, offline_classifier
from convroute.plans import sample
from convroute.plans.run import local_stages, model_pass, run_routing
from convroute.sinks import keyed_log, message_store, tables
from convroute.sinks.result_log import append_slice, log_rows, write_json_log
from convroute.sources import threads as thread_source
from convroute.sources.result_log import read_json_log, read_json_log_rejects, read_log
from convroute.streaming import corrections, incremental
from convroute.workspace import Workspace

CONFIG = RoutingConfig()
FIRST_N_THREADS = 50
# A start of a stream whose files grow in number with the table takes them in so many micro-batches.
MICRO_BATCHES = 6
# A budget small enough that both sides of the stop occur on the test tables.
SMALL_BUDGET = replace(CONFIG, budget_usd="0.003")
# The stand-in costs nothing, so runs that ask it are not stopped, whatever the size of the table.
FREE = replace(CONFIG, prices=tuple((model, "0", "0") for model, *_ in CONFIG.prices), default_price=("0", "0"))


# --- Shared steps ---------------------------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.route(sample.messages(spark, sf_dir), CONFIG)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_stages(sample.messages(spark, sf_dir), CONFIG, scores=sample.scores(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final labels of the first pass, with the stand-in filling in place: one scan, no batches."""
    return fill_with_standin(_staged(spark, sf_dir))


def _open_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecided messages with their prior turns."""
    with_context = context.with_context(sample.messages(spark, sf_dir), CONFIG)
    staged = local_stages(with_context, CONFIG, scores=sample.scores(spark, sf_dir))
    return merge.undecided(staged)


def _number(open_rows: DataFrame, workspace: Workspace) -> DataFrame:
    """Store, then number: range partitioning samples its input, which would run the stages twice."""
    stored = workspace.save(open_rows, "open")
    return numbering.assign_batches(stored, CONFIG.batch_size, workspace)


def _batched(spark: SparkSession, sf_dir: str, workspace: Workspace) -> DataFrame:
    return _number(_open_with_context(spark, sf_dir), workspace)


def _requests(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return requests.build_requests(_batched(spark, sf_dir, Workspace(spark, name)), CONFIG)


def _calls(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Token estimates of the first pass, one row per batch."""
    estimated = requests.estimate_tokens(_requests(spark, sf_dir, name))
    return estimated.select(
        "batch", F.lit(FIRST_PASS_MODEL).alias("model"), "prompt_tokens", "output_tokens", "thinking_tokens"
    )


def _broken_replies(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Replies of all kinds to the batches of a run without the sentiment stage."""
    with_context = context.with_context(sample.messages(spark, sf_dir), CONFIG)
    undecided = merge.undecided(local_stages(with_context, CONFIG))
    batched = _number(undecided, Workspace(spark, name))
    return responses.parse_replies(sample.replies(requests.build_requests(batched, CONFIG)))


def _refined(labelled: DataFrame) -> DataFrame:
    return (
        merge.refine_candidates(labelled)
        .withColumns(
            {
                "label": standin_label(),
                "confidence": F.lit("low"),
                "source": F.lit("api_refine"),
                "reason": F.lit("api_classified"),
            }
        )
    )


# --- Sources --------------------------------------------------------------------------------------


def ingest_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "ingest")
    path = workspace.folder("json")
    sample.write_threads(sample.threads(sample.messages(spark, sf_dir)), path)
    read = thread_source.number_threads(thread_source.read_threads(spark, path), workspace)
    whole = read.groupBy("thread_idx", "seed_id", "platform", "customer_name")
    return whole.agg(F.sum(F.size("messages")).cast("int").alias("n_messages"))


def ingest_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "ingest-array")
    path = workspace.folder("json")
    sample.write_thread_arrays(sample.threads(sample.messages(spark, sf_dir)), path)
    read = thread_source.read_threads(spark, path, "json_array")
    flat = thread_source.flatten_threads(thread_source.number_threads(read, workspace), CONFIG)
    return flat.select(
        "id", "seed_id", "platform", "author", "text", "customer_name", context.context_block(F.col("context")).alias("context_block")
    )


def flatten_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = sample.threads(sample.messages(spark, sf_dir)).withColumnRenamed("conv_id", "thread_idx")
    flat = thread_source.flatten_threads(nested, CONFIG)
    return flat.withColumn("context_block", context.context_block(F.col("context"))).drop("context")


def read_result_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "log")
    path = workspace.folder("json")
    labelled = workspace.save(_labelled(spark, sf_dir), "labelled")
    write_json_log(log_rows(merge.results(labelled)), path)
    # What an interrupted writer leaves behind: a cut-off line and a blank one.
    unlabelled = labelled.where(F.col("label").isNull())
    damage = F.explode(F.array(F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "lab')), F.lit("")))
    unlabelled.select(damage.alias("value")).write.mode("append").text(path)
    return read_json_log(spark, path).drop("batch")


def result_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad lines of a log in which every message has left one beside its good line."""
    workspace = Workspace(spark, "rejects")
    path = workspace.folder("json")
    labelled = workspace.save(_labelled(spark, sf_dir), "labelled")
    write_json_log(log_rows(merge.results(labelled)), path)
    cut_off = F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "lab'))
    wrong_type = F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "batch": "'), F.col("turn_index"), F.lit('x"}'))
    damage = F.when(F.col("author") == CUSTOMER, cut_off).when(F.col("author") == BRAND, wrong_type)
    lines = F.explode(F.array(F.coalesce(damage, F.concat(F.lit("id "), F.col("id"))), F.lit("")))
    labelled.select(lines.alias("value")).write.mode("append").text(path)
    return read_json_log_rejects(spark, path).select("line", "reason")


def author_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return authors.author_counts(sample.messages(spark, sf_dir))


def first_n_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = thread_source.first_threads(sample.messages(spark, sf_dir), FIRST_N_THREADS)
    return kept.select("id", "thread_idx", "author", "text")


def _context_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "id", F.size("context").alias("n_context"), context.context_block(F.col("context")).alias("context_block")
    )


def message_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context_columns(context.with_context(sample.messages(spark, sf_dir), CONFIG))


STORE_BUCKETS = 16


def _store(spark: SparkSession, sf_dir: str, name: str) -> message_store.MessageStore:
    """Messages, from files in an order of their own, with their scores beside them."""
    path = Workspace(spark, name).folder("store")
    store = message_store.write_messages(sample.messages(spark, sf_dir), path, CONFIG, STORE_BUCKETS)
    return store.add("scores", sample.scores(spark, sf_dir))


def _stored_labels(store: message_store.MessageStore) -> DataFrame:
    """Context, scores, both stages and the stand-in's rows, all where the messages lie."""
    scored = store.attach(stages.route(store.with_context(CONFIG), CONFIG), "scores")
    staged = stages.without_signals(stages.apply_sentiment(scored, CONFIG))
    return merge.attach_labels(staged, fill_with_standin(merge.undecided(staged)), store.attach_rows)


def stored_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context_columns(_store(spark, sf_dir, "stored-context").with_context(CONFIG))


def stored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir, "stored-labels")
    with message_store.co_located(spark):
        return Workspace(spark, "labels").save(merge.labels_output(_stored_labels(store)), "labels")


def stored_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir, "stored-summary")
    with message_store.co_located(spark):
        return Workspace(spark, "summary").save(rollup.thread_summary(_stored_labels(store)), "thread_summary")


# --- Stage 1 and 2 --------------------------------------------------------------------------------


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_signals(authors.customers(sample.messages(spark, sf_dir))).select("id", *lx.SIGNALS)


def signals_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_signals(docs.withColumn("text", F.coalesce("text", F.lit("")))).drop("text")


def router_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return authors.customers(_routed(spark, sf_dir)).select(
        "id", "label", F.coalesce("confidence", F.lit("low")).alias("confidence"), F.col("router_reason").alias("reason")
    )


def residual_after_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.undecided(_routed(spark, sf_dir)).select("id", "text", "router_reason")


def sentiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = stages.score_texts(_routed(spark, sf_dir), sample.length_scorer)
    return scored.where(F.col("sentiment").isNotNull()).select("id", "sentiment", "score")


def normalise_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.raw_sentiments(spark, sf_dir)
    return raw.withColumn("sentiment", normalised_sentiment(F.col("raw_label")))


def sentiment_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = _staged(spark, sf_dir).where(F.col("sentiment_reason").isNotNull())
    return tried.select("id", "label", F.col("sentiment_reason").alias("reason"))


def residual_after_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.undecided(_staged(spark, sf_dir)).select("id", "router_reason", "sentiment_reason")


def brand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = authors.brand_rows(sample.messages(spark, sf_dir))
    return rows.select("id", "platform", "label", "confidence", "source", "reason")


# --- Model stage ----------------------------------------------------------------------------------


def offline_model_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_with_standin(merge.undecided(_staged(spark, sf_dir)))
    return rows.select("id", "label", "confidence", "source", "reason")


def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = merge.undecided(_staged(spark, sf_dir)).select("id", "thread_idx", "turn_index")
    batched = _number(staged, Workspace(spark, "batches"))
    return batched.select("id", "batch", "local_i")


def batch_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir, "prompts").select("batch", "n_messages", "prompt")


def batch_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both passes would cost by estimate, per model."""
    refine = merge.refine_candidates(
        fill_with_standin(
            local_stages(
                context.with_context(sample.messages(spark, sf_dir), CONFIG),
                CONFIG,
                scores=sample.scores(spark, sf_dir),
            )
        )
    )
    batched = _number(refine, Workspace(spark, "refine"))
    second = requests.estimate_tokens(requests.build_requests(batched, CONFIG)).select(
        "batch", F.lit(REFINE_MODEL).alias("model"), "prompt_tokens", "output_tokens", "thinking_tokens"
    )
    return requests.cost_meter(_calls(spark, sf_dir, "cost").unionByName(second), CONFIG)


def budget_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = requests.budget_plan(_calls(spark, sf_dir, "budget"), SMALL_BUDGET)
    return plan.select(
        "batch", F.col("cost").cast("double").alias("cost"), F.col("spent_before").cast("double").alias("spent_before"),
        "runs",
    )


def model_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "model")
    built = requests.build_requests(_batched(spark, sf_dir, workspace), CONFIG)
    called = requests.classify_requests(built, offline_classifier)
    stored = workspace.save(called, "replies", requests.ARROW_ROWS)
    rows = responses.merge_replies(responses.parse_replies(stored))
    return rows.select("id", "batch", "label", "confidence", "source", "reason")


def merge_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = responses.merge_replies(_broken_replies(spark, sf_dir, "merge"))
    return rows.select("id", "batch", "label", "confidence", "missing", "reason")


def response_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.reply_quality(_broken_replies(spark, sf_dir, "quality"))


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to ask after a run that its budget stopped."""
    workspace = Workspace(spark, "resume")
    fingerprint = SMALL_BUDGET.fingerprint(FIRST_PASS_MODEL)
    batched = workspace.save(_batched(spark, sf_dir, workspace), "batched-again")
    calls = requests.estimate_tokens(requests.build_requests(batched, CONFIG)).withColumn(
        "model", F.lit(FIRST_PASS_MODEL)
    )
    calls = calls.select("batch", "model", "prompt_tokens", "output_tokens", "thinking_tokens")
    ran = requests.budget_plan(calls, SMALL_BUDGET).where("runs").select("batch")
    finished = fill_with_standin(batched.join(ran, "batch", "left_semi"))
    log = workspace.folder("log")
    append_slice(requests.with_asked(finished, CONFIG), log, fingerprint, "stopped")
    # Rows of a run under other settings do not count as done.
    other = CONFIG.fingerprint(REFINE_MODEL)
    append_slice(requests.with_asked(fill_with_standin(batched), CONFIG), log, other, "other")
    asked = requests.with_asked(batched, CONFIG)
    return merge.pending(asked, read_log(spark, log), fingerprint).select("id", "batch")


def resume_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to ask, looked up in a log of many slices: most of them merged into runs, the last not yet."""
    workspace = Workspace(spark, "resume-compacted")
    fingerprint = SMALL_BUDGET.fingerprint(FIRST_PASS_MODEL)
    batched = workspace.save(_batched(spark, sf_dir, workspace), "batched-again")
    calls = requests.estimate_tokens(requests.build_requests(batched, CONFIG)).withColumn(
        "model", F.lit(FIRST_PASS_MODEL)
    )
    calls = calls.select("batch", "model", "prompt_tokens", "output_tokens", "thinking_tokens")
    ran = requests.budget_plan(calls, SMALL_BUDGET).where("runs").select("batch")
    answers = fill_with_standin(requests.with_asked(batched, CONFIG))
    finished = workspace.save(answers.join(ran, "batch", "left_semi"), "finished")
    log = workspace.folder("log")
    # Rows of a run under other settings do not count as done.
    append_slice(answers, log, CONFIG.fingerprint(REFINE_MODEL), "other")
    for part in range(4):
        append_slice(finished.where(F.col("batch") % 4 == part), log, fingerprint, f"stopped-{part}")
        if part in (1, 2):
            keyed_log.compact(spark, log, buckets=8, fanout=1)
    asked = requests.with_asked(batched, CONFIG)
    return keyed_log.pending(asked, log, fingerprint).select("id", "batch")


def refine_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.refine_candidates(_labelled(spark, sf_dir)).select("id", "label", "source", "reason")


def refine_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-confidence messages of the first pass through batches, classifier and log again."""
    workspace = Workspace(spark, "refine-pass")
    with_context = context.with_context(sample.messages(spark, sf_dir), CONFIG)
    labelled = fill_with_standin(local_stages(with_context, CONFIG, scores=sample.scores(spark, sf_dir)))
    done = model_pass(
        workspace.save(merge.refine_candidates(labelled), "candidates"), offline_classifier, FREE.refine_model,
        "api_refine", workspace.folder("log"), FREE, workspace,
    )
    return done.rows.select("id", "label", "confidence", "source", "reason")


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run, with classifier, slices and log, written and read back as its two datasets."""
    workspace = Workspace(spark, "full-run")
    messages = context.with_context(sample.messages(spark, sf_dir), CONFIG)
    run = run_routing(
        messages, offline_classifier, workspace.folder("log"), FREE, scores=sample.scores(spark, sf_dir)
    )
    out = workspace.folder("out")
    tables.write_outputs(run.labels, run.thread_summary, out)
    return spark.read.parquet(f"{out}/labels")


def written_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second dataset that ``write_outputs`` leaves."""
    labelled = Workspace(spark, "written").save(_labelled(spark, sf_dir), "labelled")
    out = Workspace(spark, "outputs").folder("out")
    tables.write_outputs(merge.labels_output(labelled), rollup.thread_summary(labelled), out)
    return spark.read.parquet(f"{out}/thread_summary")


def published_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that readers see after local stages, then final labels have been published."""
    workspace = Workspace(spark, "published")
    staged = workspace.save(_staged(spark, sf_dir), "staged")
    out = workspace.folder("out")
    for labelled in (staged, fill_with_standin(staged)):
        tables.publish_outputs(merge.labels_output(labelled), rollup.thread_summary(labelled), out)
    tables.drop_older_outputs(spark, out)
    return spark.read.parquet(f"{tables.current_outputs(spark, out)}/labels")


# --- Merged results -------------------------------------------------------------------------------


def all_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = Workspace(spark, "results").save(_staged(spark, sf_dir), "staged")
    model_rows = fill_with_standin(merge.undecided(staged))
    rows = merge.union_results(merge.results(staged), merge.results(model_rows))
    return rows.select("id", "label", "confidence", "source", "reason", "pass_no")


def merge_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = Workspace(spark, "merge").save(_labelled(spark, sf_dir), "labelled")
    rows = merge.latest(merge.results(labelled), merge.results(_refined(labelled)))
    return rows.select("id", "label", "confidence", "source", "reason")


def labels_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = Workspace(spark, "labels").save(_staged(spark, sf_dir), "staged")
    model_rows = fill_with_standin(merge.undecided(staged))
    return tables.in_corpus_order(merge.labels_output(merge.attach_labels(staged, model_rows)))


def labels_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = merge.labels_output(_labelled(spark, sf_dir))
    path = Workspace(spark, "csv").folder("labels")
    tables.write_csv(output, path)
    return tables.read_csv(spark, path, output.schema)


def thread_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.in_corpus_order(rollup.thread_summary(_labelled(spark, sf_dir), Precedence.DOCUMENTED))


def thread_summary_label_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.in_corpus_order(rollup.thread_summary(_labelled(spark, sf_dir), Precedence.LABEL_ORDER))


# --- Audits ---------------------------------------------------------------------------------------


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.label_distribution(_labelled(spark, sf_dir))


def stage_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.stage_coverage(_labelled(spark, sf_dir))


def reason_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.reason_breakdown(_labelled(spark, sf_dir))


def _counted_while_written(spark: SparkSession, sf_dir: str, name: str) -> audits.ReportCounts:
    counts = audits.ReportCounts()
    output = counts.observe(tables.in_corpus_order(_labelled(spark, sf_dir)))
    merge.labels_output(output).write.parquet(Workspace(spark, name).folder("labels"))
    return counts


def written_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report that the pass leaves which writes the sorted labels."""
    return _counted_while_written(spark, sf_dir, "counted-labels").label_distribution(spark)


def written_stage_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_while_written(spark, sf_dir, "counted-coverage").stage_coverage(spark)


def seed_collision_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.seed_collision_audit(sample.messages(spark, sf_dir))


# --- Incremental ----------------------------------------------------------------------------------


def incremental_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "stream-routing")
    out = workspace.folder("labels")
    arriving = incremental.read_stream(spark, f"{sf_dir}/conversations.parquet*", sample.CONVERSATION_SCHEMA)
    query = incremental.start_routing(
        sample.as_messages(arriving), out, workspace.folder("checkpoint"), CONFIG, sample.scores(spark, sf_dir)
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("id", "label", "confidence", "source", "reason")


def incremental_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the local stages from the counts of several micro-batches."""
    workspace = Workspace(spark, "stream-coverage")
    stored = workspace.save(sample.messages(spark, sf_dir).repartition(6, F.xxhash64("id")), "messages")
    arriving = incremental.read_stream(spark, workspace.folder("messages"), stored.schema, max_files=2)
    out = workspace.folder("out")
    query = incremental.start_reported_routing(
        arriving, out, workspace.folder("checkpoint"), CONFIG, sample.scores(spark, sf_dir)
    )
    query.awaitTermination()
    return audits.counted_coverage(incremental.read_report_counts(spark, out))


def incremental_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages dealt over files by hash, so that turns of a thread arrive in any order; two files for each trigger."""
    workspace = Workspace(spark, "stream-context")
    dealt = sample.messages(spark, sf_dir).repartition(6, F.xxhash64("id"))
    stored = workspace.save(dealt, "messages")
    arriving = incremental.read_stream(spark, workspace.folder("messages"), stored.schema, max_files=2)
    out = workspace.folder("with-context")
    incremental.start_context(arriving, out, workspace.folder("checkpoint"), CONFIG).awaitTermination()
    return _context_columns(spark.read.parquet(out))


def incremental_model_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "stream-model")
    stored = workspace.save(_open_with_context(spark, sf_dir), "open")
    arriving = incremental.read_stream(spark, workspace.folder("open"), stored.schema)
    log = workspace.folder("log")
    query = incremental.start_model_stage(
        arriving, offline_classifier, log, workspace.folder("checkpoint"), FREE
    )
    query.awaitTermination()
    return read_log(spark, log).select("id", "label", "confidence", "source", "reason")


def incremental_thread_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark, "stream-summary")
    stored = workspace.save(_labelled(spark, sf_dir), "labelled")
    arriving = incremental.read_stream(spark, workspace.folder("labelled"), stored.schema, max_files=1)
    partials = workspace.folder("partials")
    query = incremental.start_thread_summary(arriving, partials, workspace.folder("checkpoint"))
    query.awaitTermination()
    return incremental.read_thread_summary(spark, partials)


def incremental_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the first pass over several micro-batches, then a later pass that corrects all of low confidence."""
    workspace = Workspace(spark, "stream-corrections")
    folder, deltas = workspace.folder("labelled"), workspace.folder("deltas")
    first = workspace.save(_labelled(spark, sf_dir).withColumn("pass_no", F.lit(1)), "labelled")

    def advance() -> None:
        files = len(spark.read.schema(first.schema).parquet(folder).inputFiles())
        max_files = max(2, -(-files // MICRO_BATCHES))
        arriving = incremental.read_stream(spark, folder, first.schema, max_files=max_files)
        corrections.start_summary_with_corrections(
            arriving, deltas, workspace.folder("checkpoint"), F.col("pass_no"), CONFIG
        ).awaitTermination()

    advance()
    corrected = {"label": F.lit("complaint"), "confidence": F.lit("high"), "pass_no": F.lit(2)}
    # The folder is stored before it is appended to: what is read is a copy.
    again = workspace.save(first.where("confidence = 'low'").withColumns(corrected), "corrected")
    again.select(*first.columns).write.mode("append").parquet(folder)
    advance()
    return corrections.read_corrected_summary(spark, deltas)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        ingest_threads, ingest_json_array, flatten_messages, read_result_log, result_log_rejects, author_split, first_n_threads, message_context,
        stored_context, stored_labels, stored_summary,
        signals, signals_documents, router_stage, residual_after_router, sentiment_scores, normalise_sentiment,
        sentiment_stage, residual_after_sentiment, offline_model_labels, brand_rows, assign_batches, batch_prompts,
        batch_cost, budget_plan, model_stage, merge_responses, response_quality, resume_pending, resume_compacted, refine_candidates,
        refine_pass, full_run, written_summary, published_outputs, all_results, merge_last_wins, labels_output, labels_csv_roundtrip, thread_summary,
        thread_summary_label_order, label_distribution, stage_coverage, written_label_distribution, written_stage_coverage, reason_breakdown,
        seed_collision_audit, incremental_triage, incremental_coverage, incremental_context, incremental_model_stage, incremental_thread_summary,
        incremental_corrections,
    )
}
