"""Registered queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``.

Each one applies an operator with production parameters to its whole table and
derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import chat, cover_tree, duck_bpe, gru_toxicity, hyperminhash, license_index, line_crf, periodic_runs, pfor, qd_whitening, secret_ledger, suffix_ranks, winnowing
from touchline.llm.common import stored, table
from touchline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

QUALITY_THRESHOLD = 0.7
END_ID = 2
COMPONENTS = 16
TOXICITY_THRESHOLD = 0.5


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn

    return deco


@register("op1_line_crf")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    scored = line_crf.score(docs, model)
    return scored.select("doc_id", line_crf.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"), "n_lines", "n_bad_lines")


@register("op2_pfor")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pfor")
    pfor.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return pfor.read_documents(spark, path)


@register("op3_chat")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # the planted conversation of the contract
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    formatted = chat.format_conversations(rows.unionByName(extra))
    return chat.read_back(stored(formatted, "chat"))


@register("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = secret_ledger.Ledger(spark, scratch_path(spark, "ledger"))
    ledger.update(docs, "doc_id", "text")
    found = ledger.report(docs, "doc_id", "text")
    base = [r.kind for r in secret_ledger.BASE_RULES]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in base]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(listed(own), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@register("op5_licenses")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = license_index.Index(*license_index.word_counts(docs))
    return license_index.scan(docs, index).drop("places")


@register("op6_hyperminhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@register("op7_cover_tree")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


@register("op8_winnowing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        winnowing.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@register("op9_suffix_ranks")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_ranks.remove_repeats(table(spark, sf_dir, "documents"), 200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op10_duck_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duck_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op11_gru_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = gru_toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = gru_toxicity.score(docs, network)
    return scored.select("doc_id", gru_toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXICITY_THRESHOLD).cast("int").alias("predicted"))


@register("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


@register("op13_qd_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = qd_whitening.grid(table(spark, sf_dir, "embeddings"))
    models, fit = qd_whitening.fit_whitening(rows, COMPONENTS)
    error = qd_whitening.identity_error(fit, models)
    return qd_whitening.whiten(rows, models).withColumn("identity_error", F.lit(error))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL over the whole tables, where SQL can express a query."""
    from touchline.llm.oracle import ORACLE

    return dict(ORACLE)
