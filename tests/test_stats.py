import math

import pytest

from cohort_engine.config import DashboardConfig
from cohort_engine.operators import stats
from cohort_engine.plans.dashboard import association, dashboard

ROWS = [
    ("a", "2020-01-01", "Flu"),
    ("a", "2020-01-02", "Flu"),
    ("a", "2020-01-03", "Cough"),
    ("a", "2020-01-03", "Ache"),
    ("b", "2020-01-01", "Flu B"),
    ("b", "2020-01-01", "Cough"),
    ("c", "2020-01-01", "Cough"),
    ("c", "2020-01-01", None),
]


def counts(df):
    return [(r.REASONDESCRIPTION, r["count"]) for r in df.collect()]


def test_counts(encounters):
    df = encounters(ROWS)
    assert sorted(counts(stats.condition_counts(df))) == [
        ("Ache", 1), ("Cough", 3), ("Flu", 2), ("Flu B", 1),
    ]
    assert sorted(counts(stats.patient_counts(df))) == [
        ("Ache", 1), ("Cough", 3), ("Flu", 1), ("Flu B", 1),
    ]
    assert sorted(counts(stats.condition_counts(df, ["flu", "ache"]))) == [
        ("Ache", 1), ("Flu", 2), ("Flu B", 1),
    ]


def test_top_breaks_ties_by_name(encounters):
    df = encounters(ROWS)
    assert counts(stats.top_conditions(df, 3)) == [("Cough", 3), ("Flu", 2), ("Ache", 1)]
    assert counts(stats.top_conditions(df, 2, by="patients")) == [("Cough", 3), ("Ache", 1)]
    with pytest.raises(ValueError):
        stats.top_conditions(df, 2, by="weight")


def test_comorbid_conditions(encounters):
    df = encounters(ROWS)
    assert counts(stats.comorbid_conditions(df, "flu", 10)) == [("Cough", 2), ("Ache", 1)]
    assert counts(stats.comorbid_conditions(df, "flu", 10, exclude_index=False)) == [
        ("Cough", 2), ("Ache", 1), ("Flu", 1), ("Flu B", 1),
    ]
    assert counts(stats.comorbid_conditions(df, "nothing", 10)) == []


def test_co_occurrence_and_contingency(encounters, spark):
    df = encounters(ROWS)
    patients = spark.createDataFrame([(p,) for p in "abcd"], "PATIENT string")
    pairs = stats.co_occurrence(patients, df, "flu", "ache")
    assert sorted(map(tuple, pairs.collect())) == [
        ("a", "flu", "ache"), ("b", "flu", "none"), ("c", "none", "none"), ("d", "none", "none"),
    ]
    cells = stats.contingency(pairs, "flu", "ache")
    assert {(r.first, r.second): r.patients for r in cells.collect()} == {
        ("flu", "ache"): 1, ("flu", "none"): 1, ("none", "ache"): 0, ("none", "none"): 2,
    }


def table(spark, n11, n12, n21, n22):
    return spark.createDataFrame(
        [("x", "y", n11), ("x", "none", n12), ("none", "y", n21), ("none", "none", n22)],
        "first string, second string, patients bigint",
    )


def test_chi_square_known_values(spark):
    row = stats.chi_square(table(spark, 90, 10, 20, 15)).first()
    assert row.statistic == pytest.approx(16.43572402597403, rel=1e-12)
    assert row.p_value == pytest.approx(5.032775944459793e-05, rel=1e-9)
    assert (row.df, row.verdict) == (1, "significant")
    plain = stats.chi_square(table(spark, 90, 10, 20, 15), correction=False).first()
    assert plain.statistic == pytest.approx(18.5494, abs=1e-4)


def test_chi_square_equals_sum_over_cells(spark):
    n11, n12, n21, n22 = 237, 364, 340, 559
    total, expected = n11 + n12 + n21 + n22, 0.0
    for observed, row, column in (
        (n11, n11 + n12, n11 + n21), (n12, n11 + n12, n12 + n22),
        (n21, n21 + n22, n11 + n21), (n22, n21 + n22, n12 + n22),
    ):
        e = row * column / total
        expected += (abs(observed - e) - 0.5) ** 2 / e
    got = stats.chi_square(table(spark, n11, n12, n21, n22)).first()
    assert got.statistic == pytest.approx(expected, rel=1e-12)
    assert got.p_value == pytest.approx(math.erfc(math.sqrt(expected / 2)), rel=1e-12)
    turned = stats.chi_square(table(spark, n11, n21, n12, n22)).first()
    assert turned.statistic == pytest.approx(got.statistic, rel=1e-12)


def test_correction_never_overshoots(spark):
    assert stats.chi_square(table(spark, 2, 2, 2, 2)).first().statistic == 0.0


def test_verdicts(spark):
    assert stats.chi_square(table(spark, 9000, 10, 20, 9000)).first().verdict == "highly significant"
    assert stats.chi_square(table(spark, 5, 5, 5, 6)).first().verdict == "not significant"
    row = stats.chi_square(table(spark, 0, 0, 5, 6)).first()
    assert (row.statistic, row.p_value, row.verdict) == (None, None, "not testable")


def test_dashboard(encounters, spark):
    df = encounters(ROWS)
    patients = spark.createDataFrame([(p,) for p in "abcd"], "PATIENT string")
    config = DashboardConfig(num_conditions=1, first_condition="flu", second_condition="cough")
    reports = dashboard(df, patients, config)
    assert {name: report.count() for name, report in reports.items()} == {
        "top_by_encounters": 1, "top_by_patients": 1, "selected_conditions": 3,
        "comorbid_conditions": 1, "association": 1,
    }
    assert association(df, patients, "flu", "nothing").first().verdict == "not testable"


def test_small_and_tiny_p_values(spark):
    from cohort_engine.functions.significance import chi_square_log_p, chi_square_p_value

    values = [0.0, 1e-9, 0.1, 1.0, 3.84, 7.9, 8.1, 50.0, 700.0, 1400.0, 1e5, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", chi_square_log_p("x").alias("l"), chi_square_p_value("x").alias("p")).collect()
    for r in rows:
        if r.x is None:
            assert r.l is None and r.p is None
            continue
        z = math.sqrt(max(r.x, 0) / 2)
        p = math.erfc(z)
        if p > 1e-300:
            assert math.isclose(r.l, math.log(p), rel_tol=1e-11, abs_tol=1e-15)
            assert math.isclose(r.p, p, rel_tol=1e-10)
        else:  # the first terms of the asymptotic series
            series = 1 - 1 / (2 * z * z) + 3 / (2 * z * z) ** 2 - 15 / (2 * z * z) ** 3
            expected = -z * z - math.log(z * math.sqrt(math.pi)) + math.log(series)
            assert math.isclose(r.l, expected, rel_tol=1e-9)


def test_comorbid_conditions_of_pairs_shuffle_no_pairs(spark, encounters, tmp_path):
    rows = [("a", None, "Flu"), ("a", None, "Flu"), ("a", None, "Ache"), ("b", None, "Flu"),
            ("b", None, None), (None, None, "Flu"), (None, None, "Cough"), ("c", None, "Ache")]
    df = encounters(rows)
    df.select("PATIENT", "REASONDESCRIPTION").distinct().write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    found = stats.comorbid_conditions(pairs, "flu", 10, exclude_index=False, paired=True)
    assert found.collect() == stats.comorbid_conditions(df, "flu", 10, exclude_index=False).collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(PATIENT" in plan  # the patients of the cases
    assert not any(
        "hashpartitioning(PATIENT" in line and "REASONDESCRIPTION" in line
        for line in plan.splitlines()
    )
