"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input. Every stage works on all documents that
its predecessor kept, and its decisions take effect.

1. quality: the line CRF scores every text; documents that it rejects go.
2. near_duplicates: HyperMinHash groups (five-word shingles, similarity 0.8 or
   more) of rows; one row of each group stays, that of the smallest id.
3. decontamination: documents of which a twentieth of the words or more stand in
   windows of benchmark items go.
4. secrets: spans found by the blob ledger are replaced by their kind.
5. tokens: byte-level BPE ids of every text, decoded again, as (doc_id,
   n_tokens, ids, decoded_sha256, exact: the ids give the text back).

All stages but the last return the columns of ``documents``. Decisions are on
rows: neither a null id nor an id that other texts share keeps a row from being
judged by its own text. Of repeated rows one stays, null ids come after all
others. Null texts are empty texts to every stage; texts without words are in no
group, so all of them pass stage 2.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import duck_bpe, hyperminhash, line_crf, secret_ledger, winnowing
from touchline.llm.common import release, stored, table
from touchline.session import scratch_path

QUALITY_THRESHOLD = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = line_crf.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return line_crf.accepted(docs, model, QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # ids may be null or repeated; written numbers name the rows
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = hyperminhash.near_duplicates(rows, doc_id="__row", shingle=5, percent=80)
    groups = stored(groups.select(F.col("doc_id").alias("__row"), "component_id"), "groups")
    # rows that tie in the id differ in their content or not at all
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(*docs.columns).alias("content"), "__row")
    first = groups.join(rows.select("__row", order.alias("order")), "__row").groupBy("component_id").agg(F.min("order").alias("first"))
    # only rows that go are shuffled to the texts
    gone = stored(groups.join(first.select("first.__row"), "__row", "left_anti").select("__row"), "duplicates")
    return rows.join(gone, "__row", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = winnowing.contaminated_words(docs, table(spark, sf_dir, "benchmark"))
    hit = found.where(winnowing.is_contaminated(F.col("n_hit"), F.col("n_words")))
    hit = stored(hit.select("doc_id", "text_hash").distinct(), "contaminated")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.xxhash64("d.text") == F.col("h.text_hash"))
    return docs.alias("d").join(hit.alias("h"), same, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = secret_ledger.Ledger(spark, scratch_path(spark, "ledger"))
    ledger.update(docs, "doc_id", "text")
    release(spark)  # the texts shuffled for the scan, before they are shuffled to their spans
    spans = ledger.spans()
    rows = docs.withColumn("__blob", secret_ledger.blob_of(F.col("text"))).join(spans.withColumnsRenamed({"blob": "__blob", "spans": "__spans"}), "__blob", "left")
    clean = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(secret_ledger.redact(F.col("text"), F.col("__spans")))
    rows = rows.withColumn("text", clean)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        rows = rows.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return duck_bpe.encode_checked(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: SQL can't express the classifier, the sketches' groups or the merges; the
#: stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
