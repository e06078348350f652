import hashlib

import pytest

from cohort_engine.operators import curation


def sha1(text):
    return hashlib.sha1(text.encode()).hexdigest()


def test_renames_skip_missing_columns(spark):
    raw = spark.createDataFrame([("o1", "General", "02101")], "Id string, NAME string, ZIP string")
    curated = curation.curate_organizations(raw)
    assert curated.columns == ["ORGANIZATION", "Org_Name", "PROVIDER_ZIP"]


def test_all_renames(spark):
    def renamed(curate, *columns):
        schema = ", ".join(f"{c} string" for c in columns)
        return curate(spark.createDataFrame([], schema)).columns

    assert renamed(curation.curate_encounters, "Id", "START", "END", "PROVIDER", "CODE") == [
        "Enc_Id", "START_TIME", "END_TIME", "ORGANIZATION", "CODE",
    ]
    assert renamed(curation.curate_providers, "Id", "NAME") == ["PROVIDER", "Provider_Name"]
    assert renamed(curation.curate_patients, "Id", "ZIP") == ["PATIENT", "ZIP"]
    assert renamed(
        curation.curate_organizations, "Id", "NAME", "ADDRESS", "CITY", "STATE", "ZIP", "GENDER"
    ) == [
        "ORGANIZATION", "Org_Name", "PROVIDER_ADDRESS", "PROVIDER_CITY", "PROVIDER_STATE",
        "PROVIDER_ZIP", "PROVIDER_GENDER",
    ]


def test_obfuscate(spark):
    df = spark.createDataFrame([("a", "", None, 7)], "a string, b string, c string, d int")
    row = curation.obfuscate(df, ["a", "b", "c", "d"]).first()
    assert (row.a, row.b, row.c, row.d) == (sha1("a"), sha1(""), None, sha1("7"))
    assert curation.obfuscate(df, ["a"], salt="s-").first().a == sha1("s-a")
    assert curation.obfuscate(df, []).first() == df.first()


def test_obfuscate_names_missing_columns(spark):
    df = spark.createDataFrame([("a",)], "a string")
    with pytest.raises(ValueError, match="SSN"):
        curation.obfuscate(df, ["a", "SSN"])


def test_wide_join_is_inner(spark):
    enc = spark.createDataFrame(
        [("e1", "p1", "o1"), ("e2", "p1", "o9"), ("e3", "p9", "o1"), ("e4", None, "o1")],
        "Enc_Id string, PATIENT string, ORGANIZATION string",
    )
    pat = spark.createDataFrame([("p1", "x")], "PATIENT string, RACE string")
    org = spark.createDataFrame([("o1", "y")], "ORGANIZATION string, Org_Name string")
    wide = curation.patient_encounters(enc, pat, org)
    assert sorted(wide.columns) == ["Enc_Id", "ORGANIZATION", "Org_Name", "PATIENT", "RACE"]
    assert [r.Enc_Id for r in wide.collect()] == ["e1"]


def test_wide_join_names_clashing_column(spark):
    enc = spark.createDataFrame([], "PATIENT string, ORGANIZATION string, City string")
    pat = spark.createDataFrame([], "PATIENT string, CITY string")
    org = spark.createDataFrame([], "ORGANIZATION string")
    with pytest.raises(ValueError, match="CITY"):
        curation.patient_encounters(enc, pat, org)


def test_patients_are_joined_after_organizations_that_are_not_broadcast(spark, tmp_path):
    encounters = spark.createDataFrame(
        [("e1", "p1", "o1"), ("e2", "p1", "o2"), ("e3", "p2", "o1"), ("e4", None, "o1")],
        "Enc_Id string, PATIENT string, ORGANIZATION string",
    )
    # A key that comes twice gives two rows.
    patients = spark.createDataFrame([("p1", 1), ("p2", 2), ("p2", 3)], "PATIENT string, ZIP int")
    places = spark.createDataFrame([("o1", "a"), (None, "b")], "ORGANIZATION string, `O.Name` string")
    places.write.parquet(f"{tmp_path}/places")
    places = spark.read.parquet(f"{tmp_path}/places")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def found():
        wide = curation.patient_encounters(encounters, patients, places)
        assert wide.columns == ["ORGANIZATION", "PATIENT", "Enc_Id", "ZIP", "O.Name"]
        assert sorted(map(tuple, wide.collect())) == [
            ("o1", "p1", "e1", 1, "a"), ("o1", "p2", "e3", 2, "a"), ("o1", "p2", "e3", 3, "a"),
        ]
        plan = wide._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in plan.splitlines() if "Join Inner" in line][0]

    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "PATIENT" in found()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        assert "ORGANIZATION" in found()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_columns_by_orders_are_those_of_the_wide_table(spark, tmp_path):
    from verification import binding

    at = "timestamp'1996-03-01'"
    tables = {
        "lineitem": "SELECT CAST(o AS BIGINT) l_orderkey, CAST(n AS INT) l_linenumber, o % 2 l_partkey,"
        f" o % 3 l_suppkey, {at} l_shipdate, 1.5D l_extendedprice, 'A' l_returnflag"
        " FROM VALUES (1, 1), (1, 2), (2, 1), (2, 1), (3, 1), (NULL, 1) AS v(o, n)",
        "orders": "SELECT o o_orderkey, c o_custkey, '5-LOW' o_orderpriority"
        " FROM VALUES (1, 7), (2, 7), (2, 8), (3, NULL), (NULL, 7) AS v(o, c)",
        "part": "SELECT p p_partkey, 'red bolt' p_name, 'PROMO' p_type"
        " FROM VALUES (0), (1), (1), (NULL) AS v(p)",
        "customer": "SELECT c c_custkey, 'x' c_name, 3 c_nationkey, 'MACHINERY' c_mktsegment"
        " FROM VALUES (7), (8), (8), (NULL) AS v(c)",
        "supplier": "SELECT s s_suppkey, 'y' s_name, 3 s_nationkey FROM VALUES (1), (2), (2) AS v(s)",
        "nation": "SELECT 3 n_nationkey, 'Z' n_name",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    columns = ["Enc_Id", "PATIENT", "BIRTHDATE", "RACE", "ZIP", "REASONDESCRIPTION", "PROVIDER_ZIP"]
    places = binding.organizations(spark, str(tmp_path))
    wide = binding.patient_encounters(spark, str(tmp_path)).select(*columns)
    some = binding.encounter_columns(spark, str(tmp_path), columns, places)
    assert some.columns == columns
    key = lambda r: tuple(map(str, r))
    assert sorted(some.collect(), key=key) == sorted(wide.collect(), key=key)
    assert wide.count() > 5
