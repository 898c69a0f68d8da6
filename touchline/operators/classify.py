"""Classifiers over the per-minute sensor series and their evaluation.

* Features: calendar labels from epoch seconds (``month``, ``hour``,
  ``dayofweek``), rows dropped only when a column of the case is missing.
* Split: a hash of the row key decides train/test, so the split is the same
  whatever the partitioning and survives recomputation after a lost executor
  (a row can never land in both parts).
* Models: a random forest grown by grouped histograms (``operators.forest``),
  which is the same for every layout of the input, and ``pyspark.ml`` naive Bayes
  on inputs scaled to the training part's range.
* Metrics: every custom measure is one aggregation over the predictions
  (no per-metric ``count`` actions, no RDD round trip to Python).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.calendar import calendar_columns
from touchline.operators import forest
from touchline.operators.forest import Forest
from touchline.plans.materialize import materialize
from touchline.plans.workers import ship_package

WEATHER = ("temperature", "humidity", "wind_speed")
POWER = ("power_tenants", "power_maintenance", "power_solar_panels")
ALL_SEVEN = WEATHER + POWER + ("electricity_price",)
PERIODS = {"month": 12, "hour": 24, "dayofweek": 7}


@dataclass(frozen=True)
class Case:
    """One experiment: predict ``label`` from ``inputs`` with ``classifier``."""

    label: str
    inputs: tuple[str, ...]
    classifier: str = "RandomForest"
    scaled: bool = False

    @property
    def period(self) -> int:
        return PERIODS[self.label]


MAIN_CASES = tuple(Case(label, inputs) for label in ("month", "hour") for inputs in (WEATHER, POWER, ALL_SEVEN))
EXTRA_INPUTS = ("power_tenants", "power_maintenance", "electricity_price")
EXTRA_CASES = (
    Case("dayofweek", EXTRA_INPUTS, "RandomForest", scaled=True),
    Case("dayofweek", EXTRA_INPUTS, "NaiveBayes", scaled=True),
)


LABEL_INDEX = "__label"
DRAWS = ("__train", "__weights", "__sample")
#: Smallest value of each label; model classes count from there.
FIRST_VALUE = {"month": 1, "hour": 0, "dayofweek": 1}


def with_calendar(series: DataFrame, time_col: str = "time", zone: str | None = None) -> DataFrame:
    """Add ``month``, ``hour`` and ``dayofweek`` computed from epoch seconds."""
    return series.withColumns(calendar_columns(time_col, zone))


def drop_incomplete(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Remove rows with a null or NaN in any of ``cols`` (and only those columns)."""
    return df.na.drop(subset=list(cols))


def assemble(df: DataFrame, cols: Sequence[str], output: str = "features") -> DataFrame:
    """Vector column of ``cols`` (``VectorAssembler``)."""
    return VectorAssembler(inputCols=list(cols), outputCol=output).transform(df)


def split_flag(key: str, train_fraction: float = 0.8, seed: int = 1) -> Column:
    """True for training rows: the first 32 bits of the MD5 of "key:seed" (null
    key: empty) modulo a million, below the fraction. Other engines can compute it."""
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1_000_000
    return bucket < round(train_fraction * 1_000_000)


def split_train_test(
    df: DataFrame, key: str = "time", train_fraction: float = 0.8, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Deterministic (train, test) split by a hash of ``key``."""
    flag = split_flag(key, train_fraction, seed)
    return df.filter(flag), df.filter(~flag)


def minmax_scaler(inputs: Sequence[str]) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="features"),
            MinMaxScaler(inputCol="features", outputCol="scaledFeatures"),
        ]
    )


def prepare(series: DataFrame, case: Case) -> DataFrame:
    """Calendar labels (as double, what ``pyspark.ml`` expects) and complete rows only."""
    data = with_calendar(series) if case.label not in series.columns else series
    data = data.withColumn(case.label, F.col(case.label).cast(T.DoubleType()))
    return drop_incomplete(data, list(case.inputs) + [case.label])


def fit_case(series: DataFrame, case: Case, seed: int = 1, key: str = "time") -> tuple[Forest | PipelineModel, DataFrame]:
    """Fit on the training part; return the model and its predictions on the test part.

    Models count classes from 0; predictions are label values again. A forest
    sees no difference between inputs and their min-max scaled values (scaling
    keeps their order, bins depend on nothing else), so it gets them unscaled.
    """
    return _fit_drawn(drawn(series, seed, key), case, seed, key)


def drawn(series: DataFrame, seed: int = 1, key: str = "time") -> DataFrame:
    """``series`` with what is drawn for each row by its key: the part it is in,
    its weight in every tree and its place in the sample for bins. None of it
    depends on the case, so cases can share it."""
    ship_package(series.sparkSession)
    draws = (split_flag(key, seed=seed), forest.packed_weights(F.col(key), forest.TREES, seed), forest.sample_digest(F.col(key)))
    return series.withColumns(dict(zip(DRAWS, draws, strict=True)))


def _fit_drawn(series: DataFrame, case: Case, seed: int, key: str) -> tuple[Forest | PipelineModel, DataFrame]:
    data = prepare(series, case)
    train, test = data.filter("__train"), data.filter("NOT __train").drop(*DRAWS)
    train = train.withColumn(LABEL_INDEX, F.col(case.label) - FIRST_VALUE.get(case.label, 0))
    if case.classifier == "RandomForest":
        model = forest.fit(train, case.inputs, LABEL_INDEX, case.period, key, seed=seed, weights=F.col("__weights"), digest=F.col("__sample"))
    elif case.classifier == "NaiveBayes":
        model = _fit_bayes(train, case)
    else:
        raise ValueError(f"unknown classifier {case.classifier!r}")
    back = F.col("prediction") + FIRST_VALUE.get(case.label, 0)
    return model, model.transform(test).withColumn("prediction", back)


def _fit_bayes(train: DataFrame, case: Case) -> PipelineModel:
    """Naive Bayes, on scaled inputs where the case asks for it. It refuses the
    negative values that a scaler gives below the training minimum, so the model
    raises inputs to that minimum first."""
    if not case.scaled:
        return Pipeline(stages=[VectorAssembler(inputCols=list(case.inputs), outputCol="features"), NaiveBayes(labelCol=LABEL_INDEX)]).fit(train)
    scaler = minmax_scaler(case.inputs).fit(train).stages[-1]
    raised = [f"greatest(`{c}`, {float(low)!r}D) AS `__{c}`" for c, low in zip(case.inputs, scaler.originalMin.toArray())]
    stages = [
        SQLTransformer(statement=f"SELECT *, {', '.join(raised)} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__{c}" for c in case.inputs], outputCol="features"),
        scaler,
    ]
    front = PipelineModel(stages)
    bayes = NaiveBayes(labelCol=LABEL_INDEX, featuresCol="scaledFeatures").fit(front.transform(train))
    return PipelineModel([*stages, bayes])


# ---------------------------------------------------------------- metrics


def builtin_accuracy(predictions: DataFrame, label: str) -> float:
    """Spark's own multiclass accuracy (a driver-side float, for cross-checks)."""
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    return evaluator.evaluate(predictions)


def cyclic_distance(prediction: Column, label: Column, period: int) -> Column:
    """Distance on a cycle of ``period`` values (12 -> 1 is one step for months)."""
    d = F.abs(prediction - label)
    return F.least(d, F.lit(period) - d)


def _share(cond: Column) -> Column:
    return F.try_divide(F.count_if(cond), F.count(F.lit(1))) * 100


def accuracy(predictions: DataFrame, label: str) -> DataFrame:
    """Fraction of exact predictions as a one-row DataFrame (``accuracy``)."""
    hit = F.col("prediction").cast("int") == F.col(label).cast("int")
    return predictions.agg(F.try_divide(F.count_if(hit), F.count(F.lit(1))).alias("accuracy"))


def cyclic_accuracy(predictions: DataFrame, label: str, period: int) -> DataFrame:
    """Percent of predictions exact, within one and within two steps on the cycle."""
    return predictions.agg(*_cyclic_measures(label, period))


def _cyclic_measures(label: str, period: int) -> list[Column]:
    d = cyclic_distance(F.col("prediction").cast("int"), F.col(label).cast("int"), period)
    return [
        F.round(_share(F.col("prediction").cast("int") == F.col(label).cast("int")), 2).alias("correct"),
        F.round(_share(d <= 1), 2).alias("within_one"),
        F.round(_share(d <= 2), 2).alias("within_two"),
    ]


def _true_probability(label: str) -> Column:
    """Probability the model gave to the true class (vector index = label minus
    its first value); 0 for a class it never saw."""
    index = F.col(label).cast("int") - FIRST_VALUE.get(label, 0)
    return F.coalesce(F.get(vector_to_array(F.col("probability")), index), F.lit(0.0))


def mean_true_probability(predictions: DataFrame, label: str) -> DataFrame:
    """Mean probability of the correct value over all predictions (4 decimals)."""
    return predictions.agg(F.round(F.avg(_true_probability(label)), 4).alias("avg_prob"))


def evaluate(predictions: DataFrame, label: str, period: int) -> DataFrame:
    """All custom measures in one aggregation."""
    return predictions.agg(
        *_cyclic_measures(label, period),
        F.round(F.avg(_true_probability(label)), 4).alias("avg_prob"),
    )


def _report_row(case: Case, predictions: DataFrame) -> DataFrame:
    return evaluate(predictions, case.label, case.period).select(
        F.lit(case.classifier).alias("classifier"),
        F.lit(",".join(case.inputs)).alias("input"),
        F.lit(case.label).alias("label"),
        "correct",
        "within_one",
        "within_two",
        "avg_prob",
    )


def run_cases(
    series: DataFrame, cases: Sequence[Case], seed: int = 1, key: str = "time", parallelism: int = 4
) -> DataFrame:
    """Fit and evaluate every case; one report row per case, in case order.

    The calendar columns and the draws are computed once and the input is cached
    for the fits. The cases are independent, so up to ``parallelism`` of them are
    fitted at the same time from driver threads (as ``pyspark.ml`` tuning
    does): a fit is a job a level, and concurrent fits fill the cores the others
    leave idle between jobs. The small report is checkpointed so
    the cache can be released.
    """
    from concurrent.futures import ThreadPoolExecutor

    base = drawn(with_calendar(series), seed, key).persist()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(lambda case: _fit_drawn(base, case, seed, key), cases))
        rows = [_report_row(case, predictions) for case, (_, predictions) in zip(cases, fitted)]
        report = rows[0]
        for r in rows[1:]:
            report = report.unionByName(r)
        return materialize(report)
    finally:
        base.unpersist()
