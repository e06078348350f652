"""What the queries of the study move and store, on tables made here."""

import datetime as dt

import pytest

from cohort_engine.operators import curation
from cohort_engine.sources.io import read_tables
from verification import binding, queries


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(1995, 1, 2)
    made = {
        "part": (
            "p_partkey long, p_name string, p_type string",
            [(1, "red widget", "PROMO"), (2, "hot ring", "SMALL"), (3, None, None)],
        ),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderpriority string",
            [(10, 5, "1-URGENT"), (11, None, None)],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
            " l_extendedprice double, l_returnflag string, l_shipdate timestamp",
            [
                (10, 1, 7, 1, 2.5, "A", day),
                (10, 1, 7, 2, 2.5, "N", day),
                (11, 2, 7, 1, None, "R", day),
                (10, 2, 7, 4, 1.0, None, None),
                (10, 3, 7, 5, 1.0, "R", day),
                (None, 2, 7, 6, 1.0, "R", day),
            ],
        ),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_reasons_of_encounters(spark, tables):
    rows = binding.raw_encounters(spark, tables).collect()
    assert {r.Id: (r.REASONDESCRIPTION, r.DESCRIPTION) for r in rows} == {
        "10-1-1-7-1995-01-02": ("red widget", None),
        "10-2-1-7-1995-01-02": (None, None),
        "11-1-2-7-1995-01-02": ("hot ring", "SMALL"),
        "10-4-2-7": (None, "SMALL"),
        "10-5-3-7-1995-01-02": (None, None),
    }


def test_lines_go_to_orders_without_what_makes_their_reason(spark, tables):
    plan = binding.raw_encounters(spark, tables)._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        plan = plan.children().apply(0)
    sides = [plan.children().apply(i).output().mkString(" ") for i in range(2)]
    (lines,) = [s for s in sides if "l_orderkey" in s]
    assert "reason" in lines and "p_name" not in lines and "l_returnflag" not in lines


@pytest.mark.parametrize(
    "query, needed, spared",
    [
        ("balanced_training_set", {"PATIENT"}, {"COST", "RACE"}),
        ("training_set", {"COST", "RACE"}, set()),
    ],
)
def test_encounters_are_joined_and_features_stored_as_needed(
    spark, monkeypatch, query, needed, spared
):
    asked, kept = [], {}
    stored = queries._stored

    def encounters(spark, sf_dir, columns):
        asked.extend(columns)
        return spark.sql(
            "SELECT cast(id AS string) AS Enc_Id, id % 20 AS PATIENT,"
            " timestamp_seconds(id * 90000) AS START_TIME, date'1950-01-01' AS BIRTHDATE,"
            " 'visit' AS DESCRIPTION, if(id % 7 = 0 AND id % 20 < 9, 'red widget', 'ring')"
            " AS REASONDESCRIPTION, 1L AS ZIP, 'x' AS ENCOUNTERCLASS, 1.0D AS COST,"
            " 2L AS PROVIDER_ZIP, 'r' AS RACE, 'F' AS GENDER FROM range(400)"
        ).select(*columns)

    def noted(spark, df, name):
        kept[name] = stored(spark, df, name)
        return kept[name]

    monkeypatch.setattr(queries, "_encounters", encounters)
    monkeypatch.setattr(queries, "_stored", noted)
    monkeypatch.setattr(queries, "CONFIG", queries.RiskConfig("red widget", num_conditions=2))
    names = queries.ml.feature_names(2)
    monkeypatch.setattr(queries, "_NAMES", names)
    monkeypatch.setattr(queries._training_rows, "__defaults__", (names,))
    monkeypatch.setattr(queries._balanced_rows, "__defaults__", (names,))
    found = getattr(queries, query)(spark, "")
    assert found.count() > 0 and needed <= set(asked) and not spared & set(asked)
    features = kept["encounter_features"]
    assert features.columns == found.columns
    assert all(f.endswith(".zstd.parquet") for f in features.inputFiles())


def test_ids_and_ends_are_made_after_the_patients_are_joined(spark, tables):
    spark.createDataFrame(
        [(5, "c5", 3, "MACHINERY")],
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    ).write.parquet(f"{tables}/customer.parquet")
    spark.createDataFrame(
        [(7, "s7", 3)], "s_suppkey long, s_name string, s_nationkey int"
    ).write.parquet(f"{tables}/supplier.parquet")
    spark.createDataFrame([(3, "N3")], "n_nationkey int, n_name string").write.parquet(
        f"{tables}/nation.parquet"
    )
    wide = binding.patient_encounters(spark, tables)
    raw = curation.curate_encounters(binding.raw_encounters(spark, tables))
    ours = [c for c in raw.columns if c not in ("ORGANIZATION", "PATIENT")]
    assert wide.columns[: len(ours) + 2] == ["ORGANIZATION", "PATIENT", *ours]
    by_patient = raw.filter("PATIENT = 5").select(*ours)
    assert wide.select(*ours).exceptAll(by_patient).count() == 0 < wide.count() == by_patient.count()
    plan = wide._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        assert plan.children().size() == 1
        plan = plan.children().apply(0)
    moved = " ".join(plan.children().apply(i).output().mkString(" ") for i in range(2))
    assert "l_linenumber" in moved and "Enc_Id" not in moved and "END_TIME" not in moved


def test_raw_files_are_compressed(spark):
    raw = spark.sql(
        "SELECT cast(id AS string) AS Id, id / 4 AS COST, if(id = 3, null, 'é \"x\", y') AS REASONDESCRIPTION"
        " FROM range(50)"
    )
    folder = queries._written_csv(spark, {"encounters": raw})
    table = read_tables(spark, folder)["encounters"]
    assert all(f.endswith(".csv.gz") for f in table.inputFiles())
    assert table.exceptAll(raw).count() == raw.exceptAll(table).count() == 0
