"""Calendar features, split, cyclic metrics and the classifier report."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from touchline.functions.calendar import calendar_columns
from touchline.operators import classify as CL
from touchline.operators import forest
from data_folders import SF_SMALL


def test_calendar_fields_in_utc_and_in_a_zone(spark):
    # 2023-11-14 22:13:20 UTC is a Tuesday; in Helsinki it is already Wednesday 00:13
    df = spark.createDataFrame([(1700000000,)], "time long")
    utc = df.select(*[c.alias(n) for n, c in calendar_columns("time").items()]).first()
    assert (utc.month, utc.hour, utc.dayofweek) == (11, 22, 3)
    hel = df.select(*[c.alias(n) for n, c in calendar_columns("time", "Europe/Helsinki").items()]).first()
    assert (hel.month, hel.hour, hel.dayofweek) == (11, 0, 4)


def test_calendar_does_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([(1700000000,)], "time long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(*[c.alias(n) for n, c in calendar_columns("time").items()]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (got.month, got.hour, got.dayofweek) == (11, 22, 3)


@pytest.mark.parametrize(
    "label,ok1,ok2",
    [(5, {4, 5, 6}, {3, 4, 5, 6, 7}), (1, {12, 1, 2}, {11, 12, 1, 2, 3}), (12, {11, 12, 1}, {10, 11, 12, 1, 2})],
)
def test_cyclic_neighbours_of_months(spark, label, ok1, ok2):
    rows = [(float(p), label) for p in range(1, 13)]
    df = spark.createDataFrame(rows, "prediction double, month int")
    d = CL.cyclic_distance(F.col("prediction").cast("int"), F.col("month"), 12)
    got = df.select("prediction", (d <= 1).alias("one"), (d <= 2).alias("two")).collect()
    assert {int(r.prediction) for r in got if r.one} == ok1
    assert {int(r.prediction) for r in got if r.two} == ok2


def test_metrics_on_fixed_predictions(spark):
    rows = [(0, 0.0), (0, 1.0), (23, 0.0), (5, 8.0)]
    probs = [[0.9] + [0.1 / 23] * 23, [0.2, 0.8] + [0.0] * 22, [0.5] + [0.0] * 22 + [0.5], [1 / 24] * 24]
    df = spark.createDataFrame([(h, p, pr) for (h, p), pr in zip(rows, probs)], "hour int, prediction double, probability array<double>")
    df = df.withColumn("probability", array_to_vector("probability"))
    m = CL.evaluate(df, "hour", 24).first()
    assert (m.correct, m.within_one, m.within_two) == (25.0, 75.0, 75.0)
    assert m.avg_prob == round((0.9 + 0.2 + 0.5 + 1 / 24) / 4, 4)
    assert CL.accuracy(df, "hour").first().accuracy == pytest.approx(CL.builtin_accuracy(df, "hour"))


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "time")
    train, test = CL.split_train_test(df)
    a = {r.time for r in train.collect()}
    b = {r.time for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 0.75 < len(a) / 5000 < 0.85
    again, _ = CL.split_train_test(df.repartition(7))
    assert {r.time for r in again.collect()} == a


def test_drop_incomplete_only_looks_at_given_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), 1.0), (2.0, 3.0)], "a double, b double")
    assert CL.drop_incomplete(df, ["a"]).count() == 2
    assert CL.drop_incomplete(df, ["a", "b"]).count() == 1


def test_custom_correct_equals_builtin_accuracy(spark):
    from touchline.sources import fixtures as fx

    case = CL.Case("hour", CL.POWER)
    _, pred = CL.fit_case(fx.power(spark, SF_SMALL), case)
    pred = pred.cache()
    m = CL.evaluate(pred, "hour", 24).first()
    assert m.correct == round(CL.builtin_accuracy(pred, "hour") * 100, 2)
    assert m.correct <= m.within_one <= m.within_two
    assert 0.0 <= m.avg_prob <= 1.0
    pred.unpersist()


def test_report_has_a_row_per_case(spark):
    from touchline.sources import fixtures as fx

    report = CL.run_cases(fx.power(spark, SF_SMALL), CL.MAIN_CASES[:1] + CL.EXTRA_CASES).collect()
    assert [(r.classifier, r.label) for r in report] == [
        ("RandomForest", "month"), ("RandomForest", "dayofweek"), ("NaiveBayes", "dayofweek")
    ]
    assert all(r.correct <= r.within_one <= r.within_two for r in report)


@pytest.mark.parametrize("classifier,scaled", [("RandomForest", False), ("NaiveBayes", True)])
def test_classes_that_do_not_begin_at_zero_are_learned(spark, classifier, scaled):
    rows = [(t, float(t % 3 == 0), float(t % 3 == 1), float(t % 3 == 2), t % 3 + 1) for t in range(600)]
    df = spark.createDataFrame(rows, "time long, a double, b double, c double, dayofweek int")
    _, got = CL.fit_case(df, CL.Case("dayofweek", ("a", "b", "c"), classifier=classifier, scaled=scaled))
    assert got.where("prediction <> dayofweek").count() == 0 and got.count() > 0


def test_forest_is_the_same_for_every_input_layout(spark):
    from touchline.sources import fixtures as fx

    series = fx.power(spark, SF_SMALL)
    answers = []
    for n in (1, 7, 64):
        model, got = CL.fit_case(series.repartition(n), CL.MAIN_CASES[0])
        answers.append((model.nodes(), {k: sorted(v.items()) for k, v in model.leaves.items()}, sorted((r.time, r.prediction, r.probability) for r in got.select("time", "prediction", "probability").collect())))
    assert answers[0] == answers[1] == answers[2]
    assert len(answers[0][0]) > 500  # 20 trees, five levels


def test_rows_weigh_as_in_a_bootstrap(spark):
    drawn = spark.range(20_000).select(F.posexplode(forest.row_weights(F.col("id"), 8, 1)).alias("tree", "w"))
    shares = {r.w: r["count"] / 160_000 for r in drawn.groupBy("w").count().collect()}
    for k, share in ((0, 0.3679), (1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert shares[k] == pytest.approx(share, abs=0.005)
    per_tree = drawn.groupBy("tree").agg(F.avg("w").alias("mean")).collect()
    assert all(abs(r["mean"] - 1) < 0.03 for r in per_tree) and len({r["mean"] for r in per_tree}) == 8


def test_a_tree_splits_where_the_gini_gain_is_greatest(spark):
    rows = [(i, float(i % 7), float(i % 13), int(i % 13 > 5) + int(i % 7 > 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")
    model = forest.fit(df, ["a", "b"], "y", 3, "k", trees=3, depth=2)
    weights = {r.k: r.w for r in df.select("k", forest.row_weights(F.col("k"), 3, 1).alias("w")).collect()}

    def gini(part):
        total = sum(w for _, w in part)
        return sum(sum(w for y, w in part if y == c) ** 2 for c in range(3)) / total

    for (tree, node), (f, b) in model.splits.items():
        inside = rows
        if node > 1:
            f0, b0 = model.splits[tree, node // 2]
            inside = [r for r in rows if (r[1 + f0] > model.cuts[f0][b0]) == bool(node % 2)]
        inside = [r for r in inside if weights[r[0]][tree]]
        best = max(
            (gini(left) + gini(right), -g, -i)
            for g in forest.node_features(tree, node, 2, 1)
            for i, cut in enumerate(model.cuts[g])
            for left, right in [([(r[3], weights[r[0]][tree]) for r in inside if r[1 + g] <= cut], [(r[3], weights[r[0]][tree]) for r in inside if r[1 + g] > cut])]
            if left and right
        )
        assert (-best[1], -best[2]) == (f, b)


def test_forest_without_rows_or_with_one_label(spark):
    schema = "k long, a double, y int"
    none = forest.fit(spark.createDataFrame([], schema), ["a"], "y", 3, "k", trees=2)
    one = forest.fit(spark.createDataFrame([(i, float(i), 1) for i in range(20)], schema), ["a"], "y", 3, "k", trees=2)
    df = spark.createDataFrame([(1, 5.0, 1)], schema)
    assert [list(m.transform(df).first().probability) for m in (none, one)] == [[0.0] * 3, [0.0, 1.0, 0.0]]
    assert [m.transform(df).first().prediction for m in (none, one)] == [0.0, 1.0]
    assert not one.splits


def test_unseen_class_counts_as_probability_zero(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (5, [0.9, 0.1])], "hour int, p array<double>").withColumn("probability", array_to_vector("p"))
    assert CL.mean_true_probability(df, "hour").first().avg_prob == 0.45


def test_packed_weights_are_the_row_weights(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"))
    for trees in (6, 20):
        got = rows.select(forest.row_weights(F.col("k"), trees, 3).alias("w"), forest.packed_weights(F.col("k"), trees, 3).alias("p")).collect()
        assert all(list(r.p) == r.w for r in got)


def test_forest_rows_are_walked_without_interpreted_lambdas(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 13), i % 3) for i in range(300)], "k long, a double, b double, y int")
    model = forest.fit(df, ["a", "b"], "y", 3, "k", trees=4, depth=3)
    text = model.transform(df)._jdf.queryExecution().toString()
    assert "lambda" not in text and "ArrowEvalPython" in text


def test_rows_that_lack_an_input_on_their_way_get_no_prediction(spark):
    rows = [(i, float(i % 7), float(i % 13), int(i % 7 > 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")
    model = forest.fit(df, ["a", "b"], "y", 2, "k", trees=4, depth=3)
    odd = spark.createDataFrame([(1, 1.0, 2.0, 0), (2, None, None, 0), (3, float("nan"), float("nan"), 0)], df.schema)
    got = {r.k: r.prediction for r in model.transform(odd).select("k", "prediction").collect()}
    assert got == {1: 0.0, 2: None, 3: 1.0}
