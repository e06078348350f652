"""Shapes that the physical plans must keep."""

import pytest
from pyspark.sql import functions as F

from cohort_engine.config import RiskConfig
from cohort_engine.operators import cohorts, stats
from cohort_engine.plans import risk
from cohort_engine.session import scratch_dir


@pytest.fixture(scope="module")
def wide(spark):
    path = scratch_dir(spark, "wide")
    (
        spark.range(3000)
        .select(
            F.col("id").cast("string").alias("Enc_Id"),
            # one patient has a third of the encounters
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("p"), F.col("id") % 200))
            .alias("PATIENT"),
            F.timestamp_seconds(F.col("id") * 40_000).alias("START_TIME"),
            F.to_date(F.lit("1950-01-01")).alias("BIRTHDATE"),
            F.lit("visit").alias("DESCRIPTION"),
            F.concat(F.lit("reason "), F.col("id") % 7 % 5).alias("REASONDESCRIPTION"),
            F.lit("02138").alias("ZIP"),
            F.lit("x").alias("payload"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [
        line.split("ReadSchema: ")[1] for line in physical(df).splitlines() if "ReadSchema" in line
    ]


def test_no_cross_joins(wide):
    for df in (
        risk.encounter_features(wide, RiskConfig("reason 3", 4)),
        cohorts.case_control(wide, "reason 3"),
        cohorts.controls(wide, cohorts.cases(wide, "reason 3")),
    ):
        assert "NestedLoopJoin" not in physical(df) and "Cartesian" not in physical(df)


def test_only_needed_columns_are_read(wide):
    pair = "struct<PATIENT:string,REASONDESCRIPTION:string>"
    assert set(scans(stats.comorbid_conditions(wide, "reason 3"))) == {pair}
    assert set(scans(cohorts.case_control(wide, "reason 3"))) == {pair}
    assert scans(stats.top_conditions(wide, 5)) == ["struct<REASONDESCRIPTION:string>"]


def test_counts_are_combined_before_the_shuffle(wide):
    plan = physical(stats.patient_counts(wide))
    assert plan.count("HashAggregate") == 4 and plan.count("Exchange") == 2


def test_top_needs_no_global_sort(wide):
    plan = physical(stats.top_conditions(wide, 5))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_case_control_scans_once(wide):
    df = cohorts.case_control(wide, "reason 3")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


def test_nothing_is_broadcast_beyond_the_threshold(spark, wide):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = risk.encounter_features(wide, RiskConfig("reason 3", 4))
        broadcasts = [
            line for line in physical(features).splitlines() if "BroadcastExchange" in line
        ]
        # only the one-row histogram edge of the control selection
        assert len(broadcasts) == len(
            [line for line in physical(features).splitlines() if "BroadcastHashJoin [bucket" in line]
        )
        assert features.count() > 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_patient_gives_no_hot_window(spark, wide):
    """The patient with 1,000 encounters enters the window with one row per day."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = (
            risk.encounter_features(wide, RiskConfig("reason 3", 4))
            ._jdf.queryExecution().optimizedPlan().toString().splitlines()
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    (by_patient,) = [i for i, line in enumerate(lines) if "Window [" in line and "PATIENT" in line]
    assert "Aggregate [PATIENT" in lines[by_patient + 1]


def passes(spark, wide, operator):
    """How often the rows of ``wide`` are read for the result of an operator."""
    rows = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            rows.add(len(frame))
            yield frame

    operator(wide.mapInPandas(counted, wide.schema)).collect()
    return rows.value / wide.count()


def test_controls_read_the_encounters_as_often_as_case_control(spark, wide):
    controls = passes(spark, wide, lambda df: cohorts.controls(df, "reason 3"))
    both = passes(spark, wide, lambda df: cohorts.case_control(df, "reason 3"))
    assert controls == both == 1


def test_features_read_the_wide_table_twice(spark, wide, tmp_path):
    root = wide.inputFiles()[0].rsplit("/", 1)[0]
    built = risk.encounter_features(wide, RiskConfig("reason 3", 4), storage=str(tmp_path / "s"))
    assert root not in "".join(built.inputFiles())
    assert (tmp_path / "s" / "qualified_encounters").exists()
