"""Secret scans with an incremental blob ledger (DataFrame functions only).

Every historical version of every path is addressed by its content: the
SHA-256 of its text is the blob. The ledger (Parquet below one folder) records
which (blob, rule, rule version) triples were scanned and what was found. A run
scans only blobs with pairs the ledger lacks, each blob's text once however
many paths hold it, appends to the ledger and joins the findings back to all
paths. Raising a rule's version rescans that rule alone.

The span of a private key runs from its BEGIN line through its END line, or
through its base64 lines where the END line is missing.

Spans are in code points, end exclusive. Matches are leftmost and
non-overlapping by rule; those whose value is too short are dropped after
matching. Positions come from the lengths of the text between matches, summed
by a window over the matches of one blob and rule.

Defined results: null text is empty and has no findings; repeated rows and
paths all come back; null paths too; texts without findings come back with
empty lists; an empty table gives no rows. Only the path and text columns are
read. A ledger written by a run that failed half-way holds findings without
their scanned mark; the next run scans those blobs again and findings are read
back without duplicates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # whose length counts
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # greedy and leftmost: the same spans as [0-9a-f]+ of 32 or more
)
# A key from its BEGIN line on. With an END line, all up to it (a body has no
# dashes, header lines may); cut off before it, the base64 lines that follow.
# Line ends may be escaped, as in JSON. Every repeated group is possessive: Java
# runs them in a loop, and nothing is tried twice.
_NL = r"(?:[\r\n]|\\[rn])"
_HEADERS = rf"(?:(?:[\x20\t]|{_NL})*+[A-Za-z][A-Za-z0-9-]{{0,60}}+:[^\r\n\\]{{0,998}}+(?={_NL}))*+"
_QUAD = r"[A-Za-z0-9+/]"
_LINES = rf"(?:[\x20\t]*+{_NL}++[\x20\t]*+{_QUAD}{{40,}}+={{0,2}}+)"
_LAST = rf"(?:[\x20\t]*+{_NL}++[\x20\t]*+(?={_QUAD})(?:{_QUAD}{{4}}){{0,9}}+(?:{_QUAD}{{2}}==|{_QUAD}{{3}}=)?+(?=[\x20\t]*+(?:{_NL}|\z)))?+"
PEM = rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----(?:{_HEADERS}[^-]*+-----END [A-Z ]{{0,40}}PRIVATE KEY-----|{_HEADERS}{_LINES}++{_LAST})?+"
MORE_RULES = (
    Rule("private_key", PEM, version=2),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def find(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version, start, end) of ``blobs`` (blob, text, todo: keys of
    the rules to run)."""

    def hits(rule: Rule) -> Column:
        text = F.col("text")
        wanted = F.array_contains("todo", rule.key) & text.rlike(rule.pattern)
        found = F.arrays_zip(
            F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length).alias("size"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("value"),
        )
        return F.when(wanted, F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"), found.alias("found")))

    scanned = blobs.select("blob", F.explode(F.array_compact(F.array(*map(hits, rules)))).alias("h")).select("blob", "h.*")
    # the same blob under one path twice is scanned twice at most; it counts once
    rows = scanned.dropDuplicates(["blob", "kind"]).select("blob", "kind", "version", "least", F.posexplode("found").alias("i", "m"))
    at = Window.partitionBy("blob", "kind").orderBy("i")
    end = F.sum(F.col("m.gap") + F.coalesce("m.size", F.lit(0))).over(at)
    spans = rows.select("blob", "kind", "version", "least", "m", end.alias("end"))
    return spans.where("m.value >= least").select("blob", "kind", "version", (F.col("end") - F.col("m.size")).alias("start"), "end")


class Ledger:
    """Findings and scanned marks below one folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES) -> None:
        self.spark, self.rules = spark, rules
        self.findings_path, self.scanned_path = f"{path.rstrip('/')}/findings", f"{path.rstrip('/')}/scanned"

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read(self.scanned_path, "blob string, rules array<string>")

    def findings(self) -> DataFrame:
        """Findings of the ledger's present rule versions."""
        now = F.array(*[F.lit(r.key) for r in self.rules])
        rows = self._read(self.findings_path, "blob string, kind string, version int, start long, end long")
        return rows.where(F.array_contains(now, F.concat_ws("/", "kind", "version"))).dropDuplicates()

    def update(self, versions: DataFrame, path: str = "path", text: str = "text") -> None:
        """Scan what the ledger lacks and append it."""
        rows = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("blob", blob_of(F.col("text")))
        # one path speaks for a blob; only digests are shuffled for it
        blobs = rows.groupBy("blob").agg(F.min("path").alias("path"))
        done = self.scanned().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("rules"))
        every = F.array(*[F.lit(r.key) for r in self.rules])
        todo = F.array_except(every, F.coalesce("rules", F.array().cast("array<string>")))
        unseen = blobs.join(done, "blob", "left").select("blob", "path", todo.alias("todo")).where(F.size("todo") > 0)
        same = (F.col("r.blob") == F.col("u.blob")) & F.col("r.path").eqNullSafe(F.col("u.path"))
        texts = rows.alias("r").join(unseen.hint("shuffle_hash").alias("u"), same).select("r.blob", "r.text", "u.todo")
        find(texts, self.rules).write.mode("append").parquet(self.findings_path)
        unseen.select("blob", F.col("todo").alias("rules")).write.mode("append").parquet(self.scanned_path)

    def spans(self) -> DataFrame:
        """(blob, spans array<struct<start, kind_no, end, kind>>) of the blobs
        with findings, by start, then kind as listed."""
        number = F.coalesce(*[F.when(F.col("kind") == r.kind, F.lit(i)) for i, r in enumerate(self.rules)])
        return self.findings().groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", number.alias("kind_no"), "end", "kind"))).alias("spans"))

    def report(self, versions: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
        """(path, blob, spans array<struct<start, kind_no, end, kind>>) of every
        row of ``versions``."""
        rows = versions.select(F.col(path).alias("path"), blob_of(F.col(text).cast("string")).alias("blob"))
        return rows.join(self.spans(), "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by [kind]; a span that overlaps one
    before it goes into that one's replacement. ``spans`` as in ``report``."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))).alias("out"),
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(step["out"], F.substr(text, (step["at"] + 1).cast("int"), F.length(text))))
