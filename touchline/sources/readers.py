"""Readers for the domain inputs, always with an explicit schema.

Each reader returns a lazily evaluated DataFrame, so a later ``select`` or
``filter`` is pruned / pushed into the scan by Catalyst.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from touchline import schemas


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One parquet table of a test-data folder, optionally pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Headers of up to this many files are read one by one, beyond it by one job.
HEADERS_ONE_BY_ONE = 256


def _input_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    return [unquote(f) for f in spark.read.text(path).inputFiles()]


def _headers(spark: SparkSession, files: list[str], sep: str) -> dict[str, list[str]]:
    """The header cells of every file that has a line. A few files cost a tiny
    job each (their first lines are read), many files one pass over their lines."""
    lines = spark.read.option("header", True).option("sep", sep)
    if len(files) <= HEADERS_ONE_BY_ONE:
        with ThreadPoolExecutor(max_workers=16) as pool:
            return {f: h for f, h in zip(files, pool.map(lambda f: lines.csv(f).columns, files), strict=True) if h}
    text = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    first = text.where("start = 0").withColumn("line", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "line").alias("header"))
    cells = first.select("file", F.from_csv("header", F.lit(", ".join(f"c{i} string" for i in range(1000))), {"sep": sep}).alias("c")).select("file", F.array_compact(F.array("c.*")).alias("cells"))
    return {unquote(r.file): r.cells for r in cells.collect()}  # a row a file


def read_sales_csv(spark: SparkSession, path: str | list[str], schema: StructType = schemas.SALES, sep: str = "|") -> DataFrame:
    """Delimited sales files with a header line each; the columns of ``schema``
    are found by name in every file, in any order and among others, so files of
    one folder may be laid out differently. Files with one header are read
    together (their rows are parsed once, pruned and pushed down as usual). A
    file that lacks a column is an error that names it; files without any line
    have no rows."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in _headers(spark, _input_files(spark, path), sep).items():
        missing = [f.name for f in schema.fields if f.name not in header]
        if missing:
            raise ValueError(f"{file} has no column {', '.join(missing)}")
        by_header.setdefault(tuple(header), []).append(file)
    wanted = {f.name: f for f in schema.fields}
    parts = []
    for header, files in sorted(by_header.items()):
        placed = StructType([wanted.get(name, StructField(name, StringType())) for name in header])
        reader = spark.read.option("header", True).option("sep", sep).schema(placed)
        parts.append(reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(files).select(*schema.fieldNames()))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.EVENTS)


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.MATCHES)


def read_players(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.PLAYERS)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.SERIES)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """PNG (or any format the JVM decoder knows) files as ``image`` structs.

    Spark's image source decodes on the executors and returns pixel bytes in
    BGR(A) order with OpenCV mode 24 for 4-channel 8-bit images. A file that
    can't be decoded keeps its row, without pixels. Files in sub-folders are
    read as well; hidden ones (names that begin with ``_``) are not.
    """
    return spark.read.format("image").option("recursiveFileLookup", True).load(path)


CORRUPT = "_corrupt_record"


def _json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(file, line, row): every line that isn't blank with its attributes and, in
    ``row``'s last field, the line again if it can't be parsed. (The JSON source
    itself refuses plans that look at that field alone, such as a count.)"""
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    row = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    lines = spark.read.text(path).where("trim(value) <> ''")
    return lines.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"), row.alias("row"))


def read_metadata(spark: SparkSession, path: str, schema: StructType = schemas.IMAGE_META) -> DataFrame:
    """JSON-lines metadata; only the attributes in ``schema`` are parsed.
    Lines that can't be parsed are left to ``malformed_metadata``."""
    parsed = _json_lines(spark, path, schema).where(F.col(f"row.{CORRUPT}").isNull())
    return parsed.select(*[F.col("row").getField(f).alias(f) for f in schema.fieldNames()])


def malformed_metadata(spark: SparkSession, path: str, schema: StructType = schemas.IMAGE_META) -> DataFrame:
    """(file, line): the lines that ``read_metadata`` leaves out - broken JSON and
    values that don't fit their attribute's type."""
    return _json_lines(spark, path, schema).where(F.col(f"row.{CORRUPT}").isNotNull()).select("file", "line")
