from cohort_engine.operators import cohorts

ROWS = [
    ("a", "2020-01-01", "Drug overdose"),
    ("a", "2020-01-02", "drug overdose again"),
    ("b", "2020-01-01", "pain"),
    ("c", "2020-01-01", None),
    ("d", "2020-01-01", "DRUG OVERDOSE"),
    ("e", "2020-01-01", "pain"),
    ("f", "2020-01-01", "pain"),
]


def ids(df):
    return sorted(r.PATIENT for r in df.collect())


def test_cases_and_others_partition_all_patients(encounters):
    df = encounters(ROWS)
    cases = cohorts.cases(df, "drug overdose")
    assert ids(cases) == ["a", "d"]
    assert ids(cohorts.non_cases(df, cases)) == ["b", "c", "e", "f"]
    assert {r.is_positive for r in cases.collect()} == {True}


def test_controls_as_many_as_cases(encounters):
    df = encounters(ROWS)
    cases = cohorts.cases(df, "drug overdose")
    found = cohorts.controls(df, cases)
    assert found.count() == 2 and set(ids(found)) <= {"b", "c", "e", "f"}
    assert cohorts.controls(df, cases, n=3).count() == 3
    assert {r.is_positive for r in found.collect()} == {False}


def test_fewer_possible_controls_than_cases(encounters):
    df = encounters(ROWS)
    cases = cohorts.cases(df, "pain")  # 3 cases, 3 others
    assert cohorts.controls(df, cases, n=50).count() == 3


def test_case_control_equals_its_parts(encounters):
    df = encounters(ROWS)
    for condition in ("drug overdose", "pain", "nobody has this"):
        for seed in (None, 5):
            cases = cohorts.cases(df, condition)
            parts = cases.unionByName(cohorts.controls(df, cases, seed=seed))
            whole = cohorts.case_control(df, condition, seed=seed)
            assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_qualified_encounters(encounters, spark):
    df = encounters(ROWS)
    blank = df.filter("PATIENT = 'b'").drop("DESCRIPTION").selectExpr(
        "*", "CAST(NULL AS STRING) AS DESCRIPTION"
    )
    cohort = spark.createDataFrame([("a", True), ("b", False)], "PATIENT string, is_positive boolean")
    found = cohorts.qualified_encounters(df.unionByName(blank), cohort)
    assert sorted((r.PATIENT, r.is_positive) for r in found.collect()) == [
        ("a", True), ("a", True), ("b", False),
    ]
