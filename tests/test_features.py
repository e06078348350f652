import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohort_engine.config import RiskConfig
from cohort_engine.operators import features


def dated(df, conditions):
    return features.add_day_and_age(features.add_comorbidities(df, conditions))


def by_id(df, *columns):
    return {r.Enc_Id: tuple(r[c] for c in columns) for r in df.collect()}


def brute_force(rows, num_days, num_days_future, first=0):
    """Enc_Id -> (recent count, label) of the flag "reason is X"."""
    result = {}
    for i, (patient, day, _) in enumerate(rows):
        recent = label = 0
        for other, other_day, reason in rows:
            if other != patient or (reason or "") != "X":
                continue
            if day is None or other_day is None:
                gap_in = gap_out = day is None and other_day is None
            else:
                gap = (dt.date.fromisoformat(other_day) - dt.date.fromisoformat(day)).days
                gap_in = -num_days <= gap <= -1
                gap_out = first <= gap <= num_days_future
            recent += gap_in
            label |= gap_out
        result[f"e{i}"] = (recent, int(label))
    return result


def random_rows(n, seed, hot_share=0.0):
    draw = random.Random(seed)
    start = dt.date(2020, 1, 1)
    return [
        (
            "hot" if draw.random() < hot_share else f"p{draw.randrange(8)}",
            None
            if draw.random() < 0.05
            else str(start + dt.timedelta(days=draw.randrange(120))),
            draw.choice(["X", "Y", None]),
        )
        for _ in range(n)
    ]


def test_flags_are_substring_tests(encounters):
    df = encounters([("a", None, "Flu"), ("a", None, "Flu B"), ("a", None, "flu"), ("a", None, None)])
    flagged = features.add_comorbidities(df, ["Flu", "Flu B"])
    assert by_id(flagged, "comorbidity_0", "comorbidity_1") == {
        "e0": (1, 0), "e1": (1, 1), "e2": (0, 0), "e3": (0, 0),
    }
    assert dict(flagged.dtypes)["comorbidity_0"] == "int"


def test_day_age_calendar(encounters):
    df = encounters(
        [("a", "2020-03-01", None), ("b", "2019-12-31", None), ("b", None, None)],
        start=dt.date(2000, 1, 1),
    )
    out = features.add_calendar(features.add_day_and_age(df))
    assert by_id(out, "day", "patient_age", "START_YEAR", "START_MONTH", "ZIP") == {
        "e0": (61, 7365, 2020, 3, "2138"),
        "e1": (0, 7304, 2019, 12, "2138"),
        "e2": (None, None, None, None, "2138"),
    }
    assert {r.EARLIEST_TIME for r in out.collect()} == {dt.datetime(2019, 12, 31)}


def test_window_ends(encounters):
    rows = [
        ("a", "2020-01-01", "X"),
        ("a", "2020-03-31", None),  # 90 days later: sees it
        ("a", "2020-04-01", None),  # 91 days later: does not
        ("b", "2020-01-11", "X"),
        ("b", "2020-01-01", None),  # 10 days before: label 1
        ("b", "2019-12-31", None),  # 11 days before: label 0
        ("c", "2020-01-01", "X"),
        ("c", "2020-01-01", None),  # same day: not recent, but label 1
    ]
    df = dated(encounters(rows), ["X"])
    got = by_id(features.add_history(df, 1, 90, 10), "recent_0", "label")
    assert got == {
        "e0": (0, 1), "e1": (1, 0), "e2": (0, 0), "e3": (0, 1),
        "e4": (0, 1), "e5": (0, 0), "e6": (0, 1), "e7": (0, 1),
    }
    later = by_id(features.add_label(df, 10, exclude_current=True), "label")
    assert later["e6"] == later["e7"] == later["e3"] == (0,) and later["e4"] == (1,)


@pytest.mark.parametrize("seed,hot_share", [(1, 0.0), (2, 0.4)])
def test_history_equals_brute_force(encounters, seed, hot_share):
    rows = random_rows(300, seed, hot_share)
    df = dated(encounters(rows), ["X"])
    assert by_id(features.add_history(df, 1, 30, 5), "recent_0", "label") == brute_force(rows, 30, 5)


def test_history_equals_its_parts(encounters):
    df = dated(encounters(random_rows(200, 3)), ["X", "Y"])
    whole = by_id(features.add_history(df, 2, 20, 4), "recent_0", "recent_1", "label")
    parts = features.add_label(features.add_recent(df, 2, 20), 4)
    assert by_id(parts, "recent_0", "recent_1", "label") == whole
    assert parts.select("recent_0", "label").dtypes == [("recent_0", "bigint"), ("label", "int")]


def test_independent_of_partitioning(encounters):
    df = dated(encounters(random_rows(200, 4, 0.5)), ["X"])
    one = by_id(features.add_history(df.coalesce(1), 1, 20, 4), "recent_0", "label")
    many = by_id(features.add_history(df.repartition(7), 1, 20, 4), "recent_0", "label")
    assert one == many


def test_stretches_of_days_meet(encounters):
    start = dt.date(2000, 1, 1)
    ends = [0, features.STRETCH - 1, features.STRETCH, 2 * features.STRETCH + 3]
    days = [end + step for end in ends for step in (-40, -3, 0, 1, 2, 29)]
    rows = [
        (patient, str(start + dt.timedelta(days=d)), "X" if d % 2 == 0 else None)
        for patient in ("a", "b", None)
        for d in days
    ] + [("a", None, "X"), (None, None, None)]
    df = dated(encounters(rows), ["X"])
    got = by_id(features.add_history(df, 1, 30, 5), "recent_0", "label")
    assert got == brute_force(rows, 30, 5)
    earlier = df.withColumn("day", F.col("day") - features.STRETCH - 7)
    assert by_id(features.add_history(earlier, 1, 30, 5), "recent_0", "label") == got


def test_rows_of_a_patient_stay_together_on_their_way(spark, encounters):
    """What a patient's rows share is then compressed in the shuffle."""
    df = dated(encounters(random_rows(50, 5)), ["X"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features.add_history(df, 1, 30, 5)._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = [line for line in plan.toString().splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 1
    assert "history_stretch" in joins[0] and "history_day" not in joins[0]


def test_adding_again_replaces(encounters):
    df = dated(encounters(random_rows(50, 5)), ["X"])
    once = features.add_recent(df, 1, 20)
    twice = features.add_recent(once, 1, 20)
    assert twice.columns == once.columns
    assert by_id(twice, "recent_0") == by_id(once, "recent_0")


def test_moving_window_runs_over_days_not_encounters(encounters, spark):
    df = dated(encounters(random_rows(50, 6)), ["X", "Y"])
    plan = features.add_history(df, 2)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    assert len(windows) == 1
    below = next(line for line in lines[windows[0] + 1 :] if "Project" not in line)
    assert "Aggregate [PATIENT" in below


def test_build(encounters):
    df = encounters(random_rows(100, 7))
    config = RiskConfig("x", num_conditions=5, num_days=30, num_days_future=5)
    out = features.build(df, ["X", "Y"], config)
    assert {"comorbidity_0", "comorbidity_1", "recent_0", "recent_1", "label"} <= set(out.columns)
    assert "recent_2" not in out.columns and out.count() == 100
    with pytest.warns(UserWarning, match="label is made from"):
        features.build(df, ["Y", "X"], config)
    with pytest.raises(ValueError, match="no comorbid"):
        features.build(df, [], config)


def labelled(spark, zeros, ones):
    return spark.range(zeros + ones).select(
        F.col("id").cast("string").alias("Enc_Id"),
        F.when(F.col("id") < zeros, 0).otherwise(1).alias("label"),
    )


@pytest.mark.parametrize("zeros,ones", [(200, 20), (20, 200), (50, 0), (0, 50)])
def test_balance_exact(spark, zeros, ones):
    balanced = features.balance(labelled(spark, zeros, ones))
    sizes = {r.label: r["count"] for r in features.label_distribution(balanced).collect()}
    assert sizes.get(1, 0) == ones and sizes.get(0, 0) == min(zeros, ones)


def test_balance_fraction(spark):
    balanced = features.balance(labelled(spark, 4000, 400), mode="fraction", seed=1)
    sizes = {r.label: r["count"] for r in features.label_distribution(balanced).collect()}
    assert sizes[1] == 400 and 300 < sizes[0] < 500
    with pytest.raises(ValueError):
        features.balance(balanced, mode="none")


def test_balance_does_not_shuffle_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    labelled(spark, 100, 10).withColumn("payload", F.lit("x")).write.parquet(path)
    balanced = features.balance(spark.read.parquet(path))
    plan = balanced._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Sort" not in main
    assert balanced.count() == 20


def test_rows_meet_their_history_without_what_follows_from_them(spark, encounters):
    """Flags and dates are made again after the join, so that the shuffle lacks them."""
    df = encounters([("a", "2020-01-01", "X"), ("a", "2020-01-03", None), (None, None, "X y")])
    built = features.build(df, ["X"], RiskConfig("x", 1))
    assert built.columns == [
        *df.columns, "comorbidity_0", "EARLIEST_TIME", "day", "patient_age", "START_YEAR",
        "START_MONTH", "recent_0", "label",
    ]
    assert by_id(built, "comorbidity_0", "day", "recent_0", "label", "ZIP") == {
        "e0": (1, 0, 0, 1, "2138"), "e1": (0, 2, 1, 0, "2138"), "e2": (1, None, 1, 1, "2138"),
    }
    plan = built._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        plan = plan.children().apply(0)
    left = plan.children().apply(0).output().mkString(" ")
    assert "comorbidity" not in left and "START_YEAR" not in left and "Enc_Id" in left
