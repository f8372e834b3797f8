"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole input tables.  Names and output columns match the SQL oracles in
`oracle.py` (the driver hashes values by column name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.compress import compress_extractive, compress_truncate, pack_chunks
from ..functions.detect import (
    calculate_target,
    detect_content_type,
    select_strategy,
    signal_scores,
    signal_window,
    type_from_filename,
    type_from_signals,
)
from ..functions.numeric import compression_pct, estimate_cost, price_lookup
from ..functions.text import estimate_tokens, normalize_lines
from ..operators.compare import compare_artifacts
from ..operators.metrics import benchmark, count_and_cost, resolve_price_table
from ..operators.optimize import optimize, prepare
from ..operators.runs import (
    compare_runs,
    fingerprint_expr,
    run_id_expr,
    stage_report,
)
from ..operators.reuse import run_distinct
from ..operators.rollup import corpus_rollup, read_sums, report, store_sums
from ..operators.summarize import max_tokens_expr, prompt_expr
from ..operators.sweep import Variant, sweep
from ..operators.token_store import by_family, count_missing, with_token_counts
from ..sources.files import decode_text
from ..sources.sinks import write_artifacts
from ..sources.tables import (
    conversations_corpus,
    documents_corpus,
    pages_corpus,
    split_rejects,
    spread,
    table,
    table_corpus,
    transcript_text,
)
from .pipeline import DEFAULT_RUN_TS, run_pipeline

# forced content type per row for the scoring queries (doc_id % 4)
FORCED_TYPES = ("transcript", "document", "email", "web_page")
# model names per row (doc_id % 15): every key, partial names, unknown names
MODEL_NAMES = (
    "gpt-4o", "gpt-4o-mini", "gpt-4-turbo", "gpt-3.5-turbo", "claude-3-opus",
    "claude-3-sonnet", "claude-3-haiku", "gemini-pro", "mistral-large", "mistral-small",
    "gpt-4", "gpt-4o-mini-2024-07-18", "claude-3", "", "unknown-x",
)
# header lines prefixed per row (doc_id % 6) to reach every content type
HEADER_VARIANTS = (
    "",
    "From: a\nSubject: b\n",
    "Speaker 1 [Ann]: 0:05 um okay\n",
    "import x def f class C\n",
    "bob: lol brb\n",
    "<html><div>https://x\n",
)
CHUNK_SIZE_SMALL = 100
CHUNK_SIZE_HIER = 300
BENCH_RATIOS = (0.3, 0.6, 0.9, 0.95)
SWEEP_CONFIGS = (
    ("default", C.DEFAULT_CONFIG),
    ("generous", C.DEFAULT_CONFIG.with_(target_ratio=0.9, max_output_tokens=8000)),
    ("tight", C.DEFAULT_CONFIG.with_(no_compress_threshold=200, truncate_threshold=1000,
                                     extractive_threshold=4000, target_ratio=0.2,
                                     max_output_tokens=1000)),
)

ARTIFACT_JOBS = {"default": C.DEFAULT_CONFIG, "half": C.DEFAULT_CONFIG.with_(target_ratio=0.5)}

_HIER = C.DEFAULT_CONFIG.with_(chunk_size=CHUNK_SIZE_HIER)
FORCED_VARIANTS = tuple(Variant(f"forced_{s}", _HIER, s) for s in ("truncate", "extractive", "hierarchical"))
SWEEP_MODELS = ("gpt-4o", "claude-3-haiku")


def _pick(key: Column, values) -> Column:
    """values[key % len(values)] as a CASE (literal list, may contain None)."""
    k = F.pmod(key, F.lit(len(values)))
    expr = None
    for i, v in enumerate(values):
        val = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(k == i, val) if expr is None else expr.when(k == i, val)
    return expr


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the normalized text and its token count."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.withColumn("norm_text", normalize_lines("text")).withColumn(
        "raw_tokens", estimate_tokens("norm_text")
    )


def _sha(c) -> Column:
    return F.sha2(c, 256)


# --- B. text projections ---------------------------------------------------

def normalize_documents(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select(
        "doc_id",
        F.length("text").alias("chars_extracted"),
        F.length("norm_text").alias("chars_normalized"),
        "raw_tokens",
        _sha("norm_text").alias("norm_sha"),
    )


def filename_types(spark, sf_dir):
    """OP08 on urls and on names made of a document's source, its first and its last characters."""
    pages = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("key"), F.col("url").alias("filename")
    )
    titles = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("key"),
        F.concat("source", F.lit("/"), F.substring("text", 1, 40), F.lit("."), F.substring("text", -3, 3)).alias("filename"))
    both = pages.unionByName(titles)
    return both.withColumn("name_type", type_from_filename(F.col("filename")))


def content_types(spark, sf_dir):
    d = _docs(spark, sf_dir)
    d = d.select(
        F.lit("documents").alias("origin"),
        F.col("doc_id").alias("key"),
        F.concat(_pick(F.col("doc_id"), HEADER_VARIANTS), F.col("norm_text")).alias("t"),
    )
    p = spread(table(spark, sf_dir, "pages")).select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("key"),
        normalize_lines("html").alias("t"),
    )
    both = d.unionByName(p).withColumn("s", signal_scores(signal_window(F.col("t"))))
    return both.select(
        "origin",
        "key",
        F.col("s.transcript").alias("s_transcript"),
        F.col("s.email").alias("s_email"),
        F.col("s.web_page").alias("s_web_page"),
        F.col("s.code").alias("s_code"),
        F.col("s.chat").alias("s_chat"),
        type_from_signals(F.col("s")).alias("content_type"),
    )


def strategy_routing(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select(
        "doc_id",
        "raw_tokens",
        select_strategy("raw_tokens").alias("strategy"),
        calculate_target("raw_tokens").alias("target_tokens"),
    )


# --- C. compression --------------------------------------------------------

def truncate_documents(spark, sf_dir):
    """Forced truncate on the normalized text and on a blank-line variant of
    the raw text (normalized text never has a paragraph break)."""
    d = _docs(spark, sf_dir)
    para = F.regexp_replace("text", "\n", "\n\n")
    v = d.select(
        "doc_id",
        F.inline_outer(F.array(
            F.struct(F.lit("normalized").alias("variant"), F.col("norm_text").alias("t")),
            F.struct(F.lit("paragraphs").alias("variant"), para.alias("t")),
        )),
    ).withColumn("target_tokens", calculate_target(estimate_tokens("t")))
    out = compress_truncate(F.col("t"), F.col("target_tokens"))
    return v.select(
        "doc_id", "variant", "target_tokens",
        F.length(out).alias("out_chars"),
        estimate_tokens(out).alias("out_tokens"),
        _sha(out).alias("out_sha"),
    )


def _forced_type(d):
    return d.withColumn("content_type", _pick(F.col("doc_id"), FORCED_TYPES))


def sentence_scores(spark, sf_dir):
    """Row form of the sentence table: one row per sentence with its score."""
    from ..operators.sentences import sentence_table

    d = _forced_type(_docs(spark, sf_dir))
    t = sentence_table(d, "norm_text", "content_type", ["doc_id"])
    return t.select("doc_id", "content_type", "idx", "score", "tok",
                    F.length("sentence").alias("sent_chars"))


def extractive_documents(spark, sf_dir):
    d = _forced_type(_docs(spark, sf_dir)).withColumn(
        "target_tokens", calculate_target("raw_tokens")
    )
    out = compress_extractive(F.col("norm_text"), F.col("target_tokens"), F.col("content_type"))
    return d.select(
        "doc_id", "content_type", "target_tokens",
        F.length(out).alias("out_chars"),
        estimate_tokens(out).alias("out_tokens"),
        _sha(out).alias("out_sha"),
    )


def prompt_table(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("content_type", detect_content_type("norm_text"))
    d = d.withColumn("target_tokens", calculate_target("raw_tokens"))
    p = prompt_expr(F.col("norm_text"), F.col("target_tokens"), F.col("content_type"))
    return d.select(
        "doc_id", "content_type", "target_tokens",
        max_tokens_expr(F.col("target_tokens")).alias("max_tokens"),
        F.length(p).alias("prompt_chars"),
        _sha(p).alias("prompt_sha"),
    )


def _para_variant(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.withColumn("t", F.regexp_replace("text", "\n", "\n\n"))


def chunk_table(spark, sf_dir):
    d = _para_variant(spark, sf_dir).withColumn("chunks", pack_chunks(F.col("t"), CHUNK_SIZE_SMALL))
    return d.select("doc_id", F.posexplode_outer("chunks").alias("chunk_no", "chunk")).select(
        "doc_id", "chunk_no",
        F.length("chunk").alias("chunk_chars"),
        estimate_tokens("chunk").alias("chunk_tokens"),
        _sha("chunk").alias("chunk_sha"),
    )


def hierarchical_documents(spark, sf_dir):
    d = _forced_type(_para_variant(spark, sf_dir)).select(
        F.col("doc_id").cast("string").alias("doc_key"), "doc_id", "content_type",
        F.col("t").alias("norm_text"),
    )
    d = d.withColumn("raw_tokens", estimate_tokens("norm_text")).withColumn(
        "strategy", F.lit("hierarchical")
    ).withColumn("target_tokens", calculate_target("raw_tokens"))
    out = optimize(d, "norm_text", C.DEFAULT_CONFIG, chunk_size=CHUNK_SIZE_HIER)
    return out.select(
        "doc_id", "content_type", "target_tokens",
        F.size(pack_chunks(F.col("norm_text"), CHUNK_SIZE_HIER)).alias("n_chunks"),
        F.col("compressed_chars").alias("out_chars"),
        F.col("compressed_tokens").alias("out_tokens"),
        _sha("compressed").alias("out_sha"),
    )


def optimize_documents(spark, sf_dir):
    d = _docs(spark, sf_dir)
    d = prepare(d, "norm_text", None)
    d = optimize(d, "norm_text", allow_hierarchical=False)
    return d.select(
        "doc_id", "content_type", "strategy", "target_tokens", "raw_tokens",
        "compressed_chars", "compressed_tokens", "compression_ratio", "cost_saved_input",
        _sha("compressed").alias("compressed_sha"),
    )


# --- D. metrics ------------------------------------------------------------

def _turns(spark, sf_dir) -> DataFrame:
    """conversations with the model of each turn: a full, partial or unknown name, some with the role behind it."""
    c = table(spark, sf_dir, "conversations")
    name = _pick(F.col("conv_id"), MODEL_NAMES)
    return c.withColumn("model", F.when(F.length("text") % 3 == 0, F.concat(name, F.lit("-"), F.col("role"))).otherwise(name))


def price_resolution(spark, sf_dir):
    """OP23 against the fixed price list, inside the row."""
    p = price_lookup(F.col("model"))
    return _turns(spark, sf_dir).select(
        "conv_id", "turn", "model",
        p["model_key"].alias("model_key"),
        p["input_per_1k"].alias("input_per_1k"),
        p["output_per_1k"].alias("output_per_1k"),
    )


def price_table(spark, sf_dir):
    """OP23 against a price table as large as the vocabulary of `documents`: every turn of `conversations`
    names its model by its first word, exactly, as a part of a key or around one."""
    words = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)))).alias("model_key"))
    prices = words.groupBy("model_key").agg(F.min("doc_id").alias("ordinal")).select(
        "model_key", "ordinal", (F.length("model_key") / 1000.0).alias("input_per_1k"))
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "text", F.regexp_extract("text", "[A-Za-z]+", 0).alias("model"))
    resolved = resolve_price_table(turns, prices).withColumnRenamed("model", "_model")
    out = turns.join(resolved, turns["model"].eqNullSafe(resolved["_model"]))
    return out.select("conv_id", "turn", "model", "model_key", "input_per_1k",
                      (estimate_tokens("text") / 1000.0 * F.col("input_per_1k")).alias("cost"))


def count_and_cost_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    c = c.withColumn("model", _pick(F.col("conv_id"), MODEL_NAMES))
    c = c.withColumn("is_input", F.col("role") != "assistant")
    return count_and_cost(c, "text", "model", "is_input").select(
        "conv_id", "turn", "role", "model", "is_input", "tokens", "cost"
    )


def benchmark_choice(spark, sf_dir):
    d = _docs(spark, sf_dir)
    ratio = F.element_at(F.array(*[F.lit(r) for r in BENCH_RATIOS]),
                         (F.pmod(F.col("doc_id"), F.lit(len(BENCH_RATIOS))) + 1).cast("int"))
    d = d.withColumn("target_ratio", ratio).withColumn(
        "target_tokens", calculate_target("raw_tokens", F.col("target_ratio"), 2000)
    )
    out = compress_truncate(F.col("norm_text"), F.col("target_tokens"))
    d = d.withColumn("optimized_tokens", estimate_tokens(out)).withColumn("model", F.lit(C.DEFAULT_MODEL))
    d = benchmark(d, "model", "raw_tokens", "optimized_tokens")
    return d.select(
        "doc_id", "target_ratio", "raw_tokens", "optimized_tokens",
        "benchmark_accuracy", "benchmark_strategy", "benchmark_cost",
    )


# models whose texts have counters of their own, and one without (its counts are estimates)
COUNTED_MODELS = ("gpt-4o", "claude-3-haiku", "mistral-large")
WORD_TOKENS = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0B\f\r]"
PIECE_TOKENS = r"[A-Za-z]{1,4}|[0-9]|[^A-Za-z0-9 \t\n\x0B\f\r]"
COUNTERS = {
    "gpt": lambda text: F.regexp_count(text, F.lit(WORD_TOKENS)),
    "claude": lambda text: F.regexp_count(text, F.lit(PIECE_TOKENS)),
}


def canonical_counts(spark, sf_dir):
    """OP07 through the store: raw and optimized counts of each run in one unit.

    A first pass counts every distinct text of the runs for its model, a second
    one over the same runs finds nothing left to count (new_counts).
    """
    import uuid

    from ..session import checkpoint_dir

    folder = f"{checkpoint_dir(spark).rstrip('/')}/counts-{uuid.uuid4().hex}"
    corpus = documents_corpus(spark, sf_dir).withColumn("model", _pick(F.col("doc_key").cast("bigint"), COUNTED_MODELS))
    run_pipeline(corpus).select(
        "doc_key", "model", "norm_text", "compressed", "raw_tokens", F.col("compressed_tokens").alias("optimized_tokens"),
    ).write.parquet(f"{folder}/runs")
    runs = spark.read.parquet(f"{folder}/runs")
    texts = runs.select("model", F.explode(F.array("norm_text", "compressed")).alias("text"))
    counter = by_family(COUNTERS)
    first = count_missing(texts, "text", f"{folder}/store", counter)
    again = count_missing(texts, "text", f"{folder}/store", counter)
    out = with_token_counts(runs, "norm_text", f"{folder}/store", "raw_tokens_canonical", as_of=first.seq)
    out = with_token_counts(out, "compressed", f"{folder}/store", "optimized_tokens_canonical", as_of=first.seq)
    out = benchmark(out, "model", "raw_tokens_canonical", "optimized_tokens_canonical")
    return out.select(
        F.col("doc_key").cast("bigint").alias("doc_id"), "model", "raw_tokens", "raw_tokens_canonical", "optimized_tokens",
        "optimized_tokens_canonical",
        compression_pct(F.col("optimized_tokens"), F.col("raw_tokens_canonical")).alias("compression_pct"),
        "benchmark_accuracy", "benchmark_strategy", F.lit(again.rows).cast("bigint").alias("new_counts"),
    )


# --- E. runs and corpus jobs -----------------------------------------------

def _run(spark, sf_dir, **kw):
    corpus = documents_corpus(spark, sf_dir)
    return run_pipeline(corpus, **kw)


def run_fingerprints(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    d = d.withColumn("model", _pick(F.col("doc_id"), [k for k, _, _ in C.MODEL_PRICES]))
    fp = fingerprint_expr(F.encode("text", "UTF-8"), F.col("model"))
    return d.select("doc_id", "model", fp.alias("fingerprint")).withColumn(
        "run_id", run_id_expr(F.col("fingerprint"), DEFAULT_RUN_TS)
    )


def stage_report_documents(spark, sf_dir):
    r = _run(spark, sf_dir, keep_text=False)
    return stage_report(r, ("doc_key",)).select(
        F.col("doc_key").cast("bigint").alias("doc_id"),
        "stage_no", "stage_name", "metric", "value", "value_text",
    )


def run_summary_documents(spark, sf_dir):
    r = _run(spark, sf_dir)
    return r.select(
        F.col("doc_key").cast("bigint").alias("doc_id"),
        "run_id", "raw_tokens",
        F.col("compressed_tokens").alias("optimized_tokens"),
        "compression_pct", "cost_raw", "cost_optimized", "cost_saved",
        "benchmark_accuracy", "benchmark_strategy",
        _sha(F.when(F.length("compressed") > C.PREVIEW_CHARS,
                    F.concat(F.col("compressed").substr(1, C.PREVIEW_CHARS), F.lit("...")))
             .otherwise(F.col("compressed"))).alias("preview_sha"),
    )


def corpus_rollup_documents(spark, sf_dir):
    r = _run(spark, sf_dir, keep_text=False).withColumn("doc_id", F.col("doc_key").cast("bigint"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    # labels grows with the corpus: a plain (shuffle / AQE-chosen) join, no hint
    j = r.join(labels, "doc_id", "left")
    out = corpus_rollup(j, ["strategy", "quality"])
    return out.select(
        "model", "strategy", "quality", "grouping_level", "documents",
        "raw_tokens", "optimized_tokens", "accepted", "cost_raw", "cost_optimized",
    )


def corpus_report(spark, sf_dir):
    """OP31: documents (in two batches), pages and conversations leave their sums, under three models; the
    report merges them over all levels of document type, content type and strategy."""
    import uuid

    from ..session import checkpoint_dir

    root = f"{checkpoint_dir(spark).rstrip('/')}/sums-{uuid.uuid4().hex}"
    docs = documents_corpus(spark, sf_dir)
    short = F.length("raw_text") < 1500
    for job, batch, corpus, model in (
        ("documents", "short", docs.where(short), "gpt-4o-mini"),
        ("documents", "long", docs.where(~short), "gpt-4o-mini"),
        ("pages", "", pages_corpus(spark, sf_dir), "gpt-4o"),
        ("conversations", "", conversations_corpus(spark, sf_dir), "claude-3-haiku"),
    ):
        store_sums(run_pipeline(corpus, model=model, keep_text=False), root, job, batch)
    return report(read_sums(spark, root))


def distinct_content(spark, sf_dir):
    """OP32: each content is run once; every document has its content's result and number of copies."""
    out = run_distinct(documents_corpus(spark, sf_dir, spread_scan=False),
                       ["fingerprint", "strategy", "compressed_tokens", "benchmark_strategy"])
    return out.select(
        F.col("doc_key").cast("bigint").alias("doc_id"), "fingerprint", "copies", "chars_extracted",
        "strategy", "compressed_tokens", "benchmark_strategy",
        (F.col("representative") == F.col("doc_key")).alias("computed"),
    )


def _price_lit(k, a, b):
    return F.struct(F.lit(k).alias("model_key"), F.lit(float(a)).alias("input_per_1k"),
                    F.lit(float(b)).alias("output_per_1k"))


def model_sweep(spark, sf_dir):
    """OP33 over models: per (document, model) costs; the cheapest model is
    found inside the row (no join, no shuffle)."""
    d = _docs(spark, sf_dir)
    d = prepare(d, "norm_text", None)
    d = optimize(d, "norm_text", allow_hierarchical=False).select("doc_id", "raw_tokens", "compressed_tokens")
    # the swept keys' prices are known on the driver: plain literals
    per = F.array(*[
        F.struct(
            estimate_cost(F.col("compressed_tokens"), 0, _price_lit(k, a, b)).alias("cost_optimized"),
            F.lit(k).alias("model"),
            estimate_cost(F.col("raw_tokens"), 0, _price_lit(k, a, b)).alias("cost_raw"),
        )
        for k, a, b in C.MODEL_PRICES
    ])
    d = d.withColumn("per", per).withColumn("best", F.array_min("per"))
    return d.select("doc_id", "raw_tokens", "compressed_tokens", "best", F.inline_outer("per")).select(
        "doc_id", "model", "raw_tokens", "compressed_tokens", "cost_raw", "cost_optimized",
        (F.col("cost_raw") - F.col("cost_optimized")).alias("cost_saved"),
        (F.col("model") == F.col("best.model")).alias("is_cheapest"),
    )


def config_sweep(spark, sf_dir):
    """OP33 over configurations, strategies routed by size."""
    d = _docs(spark, sf_dir).withColumn("content_type", detect_content_type("norm_text"))
    return sweep(d, [Variant(n, c) for n, c in SWEEP_CONFIGS]).drop("model")


def forced_sweep(spark, sf_dir):
    """OP33 over forced strategies, hierarchical among them, and two models."""
    d = _forced_type(_para_variant(spark, sf_dir)).withColumn("raw_tokens", estimate_tokens("t"))
    return sweep(d, FORCED_VARIANTS, SWEEP_MODELS, text_col="t")


COMPARE_FIELDS = ("strategy", "target_tokens", "compressed_tokens", "benchmark_strategy")


def compare_runs_documents(spark, sf_dir):
    """OP34 on two configurations: both are evaluated in one pass over the texts and stored, narrow, then compared."""
    import uuid

    from ..session import checkpoint_dir

    d = _docs(spark, sf_dir).withColumn("content_type", detect_content_type("norm_text"))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/compare-{uuid.uuid4().hex}"
    sweep(d, [Variant(n, c) for n, c in ARTIFACT_JOBS.items()]).write.partitionBy("config_name").parquet(folder)
    runs = spark.read.parquet(folder)
    a, b = (runs.where(F.col("config_name") == n) for n in ARTIFACT_JOBS)
    out = compare_runs(a, b, ["doc_id", "model"], COMPARE_FIELDS)
    return out.select("doc_id", "model", "status", "changed_fields")


def compare_artifacts_documents(spark, sf_dir):
    """OP34 on stored artifacts: the default job, the same job over shorter texts of a few documents, and
    the default job once more.  Checksums tell the parts that differ; equal jobs give no row."""
    import uuid

    from ..session import checkpoint_dir

    root = f"{checkpoint_dir(spark).rstrip('/')}/artifacts-{uuid.uuid4().hex}"
    corpus = documents_corpus(spark, sf_dir)
    cut = F.expr("CASE WHEN raw_text LIKE '%a.' THEN left(raw_text, length(raw_text) - 1) ELSE raw_text END")
    changed = corpus.withColumn("raw_text", cut).where("length(raw_text) > 200").withColumn("content", F.encode("raw_text", "UTF-8"))
    for job, rows in (("first", corpus), ("second", changed), ("again", corpus)):
        write_artifacts(run_pipeline(rows), root, job, "parquet")
    out = None
    for other in ("second", "again"):
        rows = compare_artifacts(spark, root, "first", root, other, fmt="parquet").rows
        rows = rows.select(F.lit(other).alias("other"), F.col("doc_key").cast("bigint").alias("doc_id"), "model", "status",
                           F.when(F.col("status") == "changed", F.col("changed_fields")).alias("changed_fields"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _corpus_run(corpus: DataFrame, key_name: str):
    r = run_pipeline(corpus, keep_text=False)
    return r.select(
        F.col("doc_key").cast("bigint").alias(key_name), "chars_normalized", "raw_tokens",
        "content_type", "strategy", "compressed_tokens", "benchmark_strategy",
    )


def transcript_corpus(spark, sf_dir):
    return _corpus_run(conversations_corpus(spark, sf_dir), "conv_id")


#: limits at which ordinary conversations are already long
PIECES = {"long_turns": 3, "long_chars": 400, "piece_turns": 2}


def transcript_parts(spark, sf_dir):
    """OP03 on long conversations: numbered by ranges, joined to pieces, pieces to rows."""
    t = transcript_text(table(spark, sf_dir, "conversations"), **PIECES)
    return t.select("conv_id", "part", "n_turns", F.length("text").alias("chars"), _sha("text").alias("text_sha"))


def page_corpus(spark, sf_dir):
    return _corpus_run(pages_corpus(spark, sf_dir), "page_id")


# byte sequences spliced into the UTF-8 text (length % 6) and what of them is text: some are ill-formed, some hold a real U+FFFD
SPLICES = (("", ""), ("ff", ""), ("e282", ""), ("c0af", ""), ("efbfbdff80", "\ufffd"), ("f09f98efbfbde2829f", "\ufffd\u209f"))


def decode_documents(spark, sf_dir):
    """OP02 on bytes derived from `documents`: ill-formed sequences are dropped, real U+FFFD beside them stay."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bad = F.unhex(_pick(F.length("text"), [b for b, _ in SPLICES]))
    content = F.concat(F.encode(F.col("text").substr(1, 5), "UTF-8"), bad,
                       F.encode(F.expr("substring(text, 6)"), "UTF-8"))
    out = decode_text(d.withColumn("content", content), "content", "raw_text")
    return out.select(
        "doc_id",
        F.length("raw_text").alias("chars_extracted"),
        _sha("raw_text").alias("text_sha"),
    )


def _widen(fn):
    """Integral outputs as BIGINT (code-point lengths and indexes are INT in
    Spark), so every query has one stable schema."""
    from functools import wraps

    from pyspark.sql import types as T

    @wraps(fn)
    def run(spark, sf_dir):
        df = fn(spark, sf_dir)
        small = (T.IntegerType, T.ShortType, T.ByteType)
        return df.select(*[
            F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, small) else F.col(f.name)
            for f in df.schema.fields
        ])

    return run


FILE_DOCS = 20
# a name for each rule, in their order, and names that no rule knows; the number of the file goes in
FILE_NAMES = ("a%d.py", "b%d.js", "c%d.ts", "d%d.java", "e%d.cpp", "f%d.go", "g%d.md", "h%d.txt", "i%d.doc", "j%d.pdf",
              "transcript %d", "Otter%d", "k%d.html", "m%d", "DATA%d.JSON", "transcript_%d.MD")


def file_roundtrip(spark, sf_dir):
    """OP01/OP02 end to end: documents are written as files of FILE_DOCS documents, whose names reach every
    rule for file names, read back as binary files, decoded and run, one run for each file."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources.files import read_files

    root = f"{checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(f"doc_id div {FILE_DOCS}").alias("file"))
    named = docs.withColumn("name", F.replace(_pick(F.col("file"), FILE_NAMES), F.lit("%d"), F.col("file").cast("string")))
    dealt = named.repartition("name").sortWithinPartitions("name", "doc_id")
    dealt.select("name", "text").write.partitionBy("name").text(root)
    runs = run_pipeline(read_files(spark, root, glob="*.txt", name_pattern="name=([^/]+)/"), keep_text=False)
    return runs.select(
        "filename", "file_size_bytes",
        "chars_normalized", "raw_tokens", "content_type", "strategy", "compressed_tokens",
        "benchmark_strategy",
    )


def artifact_roundtrip(spark, sf_dir):
    """OP04/OP30: two jobs of one run time and model write their records, one of
    them twice; every record of both is read back, nested and typed."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources.sinks import read_artifacts

    root = f"{checkpoint_dir(spark).rstrip('/')}/artifacts-{uuid.uuid4().hex}"
    for job in ("default", "half", "default"):
        write_artifacts(_run(spark, sf_dir, cfg=ARTIFACT_JOBS[job]), root, job)
    stage = F.col("stage_results")
    return read_artifacts(spark, root).select(
        F.col("doc_key").cast("bigint").alias("doc_id"), "job", "run_minute", "model", "run_id", "fingerprint",
        "content_type",
        stage["intake"]["metrics"]["file_size_bytes"].alias("file_size_bytes"),
        stage["parse"]["metrics"]["chars_extracted"].alias("chars_extracted"),
        stage["normalize"]["metrics"]["chars_normalized"].alias("chars_normalized"),
        stage["optimize"]["metrics"]["strategy"].alias("strategy"),
        stage["optimize"]["metrics"]["compression_pct"].alias("stage_compression_pct"),
        stage["cost_analysis"]["metrics"]["cost_saved"].alias("stage_cost_saved"),
        stage["benchmark"]["metrics"]["accuracy"].alias("stage_accuracy"),
        "summary.*",
        _sha("compressed_preview").alias("preview_sha"),
    )


def _padding(text: Column) -> Column:
    """text with long runs of blanks around it, inside its lines' ends and as blank lines."""
    wide = "\n" + " \t" * 200 + "\n" + " " * 200
    return F.concat(F.lit(" " * 5000), F.replace(text, F.lit("\n"), F.lit(wide)), F.lit("\n " * 2000))


def normalize_padded(spark, sf_dir):
    """OP05 on documents with long whitespace runs: the work stays linear."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    d = d.select("doc_id", _padding(F.col("text")).alias("padded"))
    d = d.withColumn("norm_text", normalize_lines("padded"))
    return d.select("doc_id", F.length("padded").alias("chars_extracted"),
                    F.length("norm_text").alias("chars_normalized"), _sha("norm_text").alias("norm_sha"))


def rejected_documents(spark, sf_dir):
    """Documents with some texts taken away: rejects are counted with their
    reason, the others run and are reported by strategy."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    d = d.withColumn("text", F.when(F.pmod("doc_id", F.lit(7)) != 3, F.col("text")))
    accepted, rejects = split_rejects(table_corpus(
        d, F.col("doc_id"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("text"), C.DEFAULT_DOC_TYPE))
    runs = run_pipeline(accepted, keep_text=False).groupBy("strategy").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("raw_tokens").alias("raw_tokens"))
    none = F.lit(None)
    return runs.select(F.lit("accepted").alias("status"), "strategy", "documents", "raw_tokens").unionByName(
        rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("documents")).select(
            F.col("reject_reason").alias("status"), none.cast("string").alias("strategy"), "documents",
            none.cast("bigint").alias("raw_tokens")))


LEAD_CHARS = 200


def _lead_summaries(requests):
    """Stands in for a model: the first characters of the content; a batch
    that holds a prompt whose length is a multiple of five raises."""
    import pandas as pd

    prompts = requests["prompt"].tolist()  # most calls are of a few requests: plain strings, no chain of Series
    if any(len(p) % 5 == 0 for p in prompts):
        raise ValueError("request refused")
    return pd.Series([p.partition("Content:\n")[2][:LEAD_CHARS] for p in prompts], dtype="object")


def _summarized(spark, sf_dir, strategy: str):
    import uuid

    from ..session import checkpoint_dir

    d = _forced_type(_para_variant(spark, sf_dir)).withColumnRenamed("t", "norm_text")
    d = d.withColumn("raw_tokens", estimate_tokens("norm_text")).withColumn("strategy", F.lit(strategy))
    d = d.withColumn("target_tokens", calculate_target("raw_tokens"))
    cache = f"{checkpoint_dir(spark).rstrip('/')}/summaries-{uuid.uuid4().hex}"
    out = optimize(d, "norm_text", summarizer=_lead_summaries, chunk_size=CHUNK_SIZE_HIER, cache_path=cache)
    return out.select("doc_id", "content_type", "target_tokens", "summary_status",
                      F.col("compressed_chars").alias("out_chars"), F.col("compressed_tokens").alias("out_tokens"),
                      _sha("compressed").alias("out_sha"))


def abstractive_callable(spark, sf_dir):
    """OP19 with a callable that refuses some requests."""
    return _summarized(spark, sf_dir, "abstractive")


def hierarchical_callable(spark, sf_dir):
    """OP21 with that callable: chunk summaries, merged, summarised again where too long."""
    return _summarized(spark, sf_dir, "hierarchical")


QUERIES = {
    "normalize_documents": normalize_documents,
    "filename_types": filename_types,
    "content_types": content_types,
    "strategy_routing": strategy_routing,
    "truncate_documents": truncate_documents,
    "sentence_scores": sentence_scores,
    "extractive_documents": extractive_documents,
    "prompt_table": prompt_table,
    "chunk_table": chunk_table,
    "hierarchical_documents": hierarchical_documents,
    "optimize_documents": optimize_documents,
    "price_resolution": price_resolution,
    "price_table": price_table,
    "count_and_cost": count_and_cost_turns,
    "benchmark_choice": benchmark_choice,
    "canonical_counts": canonical_counts,
    "run_fingerprints": run_fingerprints,
    "stage_report": stage_report_documents,
    "run_summary": run_summary_documents,
    "corpus_rollup": corpus_rollup_documents,
    "corpus_report": corpus_report,
    "distinct_content": distinct_content,
    "model_sweep": model_sweep,
    "config_sweep": config_sweep,
    "forced_sweep": forced_sweep,
    "compare_runs": compare_runs_documents,
    "compare_artifacts": compare_artifacts_documents,
    "transcript_corpus": transcript_corpus,
    "transcript_parts": transcript_parts,
    "page_corpus": page_corpus,
    "decode_text": decode_documents,
    "file_roundtrip": file_roundtrip,
    "artifact_roundtrip": artifact_roundtrip,
    "normalize_padded": normalize_padded,
    "rejected_documents": rejected_documents,
    "abstractive_callable": abstractive_callable,
    "hierarchical_callable": hierarchical_callable,
}

QUERIES = {k: _widen(v) for k, v in QUERIES.items()}
