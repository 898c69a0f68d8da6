"""Sales analytics: best group by a measure, its missing values and yearly totals.

Plan shape: the (large) sales rows are aggregated once to the small
``(group, year)`` grain, and the best group, its missing count and its yearly
totals are all answered from that aggregate: a group's years are kept beside its
total, so one scan and one aggregation by group serve both and no value travels
through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def released_between(df: DataFrame, lo: str, hi: str, date_col: str = "release_date") -> DataFrame:
    """Rows whose date lies in ``[lo, hi]`` (inclusive); null dates drop out.

    A ``between`` on a date column becomes two comparisons that the CSV and
    parquet readers accept as pushed filters.
    """
    d = F.col(date_col)
    return df.filter(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def _exact(df: DataFrame, measure: str) -> Column:
    """A total of ``measure``, exact for decimals (widened to 38 digits) and 2-decimal rounded otherwise."""
    dtype = df.schema[measure].dataType
    if isinstance(dtype, T.DecimalType):
        return F.col(measure).cast(T.DecimalType(38, dtype.scale))
    return F.round(measure, 2)


def group_year_grain(
    df: DataFrame, group: str, date_col: str, measures: Sequence[str], missing_of: str
) -> DataFrame:
    """Pre-aggregate to one row per (group, year): sums, titles, missing ``missing_of`` values.

    Rows without a group value are a group of their own.
    """
    return df.groupBy(F.col(group), F.year(date_col).alias("year")).agg(
        *[F.sum(m).alias(m) for m in measures],
        F.count(F.lit(1)).alias("titles"),
        F.count_if(F.col(missing_of).isNull()).alias("missing"),
    )


def best_of_grain(grain: DataFrame, group: str, measure: str) -> DataFrame:
    """One-row frame: the best group of a (group, year) grain by ``measure``,
    with the totals of every grain column."""
    values = [c for c in grain.columns if c not in (group, "year")]
    totals = grain.groupBy(group).agg(*[F.sum(c).alias(c) for c in values])
    return totals.orderBy(F.col(measure).desc_nulls_last(), F.col(group).asc()).limit(1)


def missing_measure_count(df: DataFrame, group: str, date_col: str, measure: str) -> DataFrame:
    """The best group by ``measure`` and how many of its rows lack ``measure``."""
    best = best_of_grain(group_year_grain(df, group, date_col, [measure], measure), group, measure)
    return best.select(group, "missing")


def yearly_totals(df: DataFrame, group: str, date_col: str, measures: Sequence[str]) -> DataFrame:
    """Per year, the totals of ``measures`` for the best group by ``measures[0]``, year ascending.

    The years of a group are kept beside its total (as many entries as years),
    so one scan and one aggregation by group serve both.
    """
    grain = group_year_grain(df, group, date_col, measures, measures[0])
    years = F.array_agg(F.struct("year", *measures)).alias("years")
    groups = grain.groupBy(group).agg(F.sum(measures[0]).alias("total"), years)
    best = groups.orderBy(F.col("total").desc_nulls_last(), F.col(group).asc()).limit(1)
    rows = best.select(F.inline("years"))
    return rows.select("year", *[_exact(df, m).alias(m) for m in measures]).orderBy("year")


def best_publisher(sales: DataFrame) -> DataFrame:
    """Publisher with the highest North-American sales, with that total."""
    grain = group_year_grain(sales, "publisher", "release_date", ["na_sales"], "na_sales")
    best = best_of_grain(grain, "publisher", "na_sales")
    return best.select("publisher", F.col("na_sales").cast(T.DecimalType(38, 2)).alias("na_total"))


def publisher_yearly_totals(sales: DataFrame) -> DataFrame:
    """Yearly NA and global totals of the best NA publisher (2 decimals)."""
    out = yearly_totals(sales, "publisher", "release_date", ["na_sales", "total_sales"])
    return out.select("year", F.col("na_sales").alias("na_total"), F.col("total_sales").alias("global_total"))
