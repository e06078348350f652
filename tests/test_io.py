import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from cohort_engine.sources import io


def test_discover_tables(spark, csv_folder):
    found = io.discover_tables(spark, csv_folder + "/")
    assert found == {
        name: f"{csv_folder}/{name}.csv"
        for name in ("encounters", "organizations", "patients", "providers")
    }
    assert io.discover_tables(spark, "file://" + csv_folder).keys() == found.keys()


def test_read_declared_types(spark, csv_folder):
    tables = io.read_tables(spark, csv_folder)
    encounters = {r.Id: r for r in tables["encounters"].collect()}
    assert len(encounters) == 4
    assert dict(tables["encounters"].dtypes)["START"] == "timestamp"
    assert (encounters["e1"].COST, encounters["e2"].COST) == (10.5, None)
    patients = {r.Id: r for r in tables["patients"].collect()}
    assert patients["p1"].ZIP == "02138"
    assert patients["p1"].BIRTHDATE == dt.date(1970, 1, 31)
    assert patients["p2"].BIRTHDATE is None


def test_read_inferred_types(spark, csv_folder):
    patients = io.read_tables(spark, csv_folder, infer_schema=True)["patients"]
    assert {r.ZIP for r in patients.collect()} == {2138, 10001, 2139}


def test_csv_scan_reads_only_needed_columns(spark, csv_folder):
    df = io.read_tables(spark, csv_folder)["encounters"].select("PATIENT")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<PATIENT:string>" in plan


def test_save_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    io.save(df, path)
    with pytest.raises(AnalysisException):
        io.save(df, path)
    io.save(spark.range(5), path, mode="overwrite")
    assert io.load(spark, path).count() == io.load(spark, path, "parquet").count() == 5


def test_save_partitioned(spark, tmp_path):
    path = str(tmp_path / "t")
    io.save(spark.range(6).selectExpr("id", "id % 2 AS part"), path, partition_by=["part"])
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == ["part=0", "part=1"]


def test_save_features_adds_tags(spark, tmp_path):
    path = str(tmp_path / "f")
    for run in ("r1", "r2"):
        io.save_features(spark.range(2), path, {"experiment_id": "x", "run_id": run})
    rows = io.load(spark, path).collect()
    assert {(r.experiment_id, r.run_id) for r in rows} == {("x", "r2")} and len(rows) == 2


def test_row_counts(spark):
    counts = io.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(map(tuple, counts.collect())) == [("a", 3), ("b", 0)]


def test_register_external_and_drop(spark, tmp_path):
    path = str(tmp_path / "t")
    io.save(spark.range(4), path)
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    assert io.register_external(spark, "io_test", "numbers", path).count() == 4
    assert io.register_external(spark, "io_test", "numbers", path).count() == 4
    io.drop_table(spark, "io_test", "numbers")
    assert not spark.catalog.tableExists("io_test.numbers")
    assert io.load(spark, path).count() == 4


def test_literals():
    assert io.quoted("a`b") == "`a``b`"
    assert io.text_literal("it's \\ here") == "'it\\'s \\\\ here'"


def test_part_files_of_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "raw" / "t.csv"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("A,B\na0,b0\n")
    (folder / "part-1.csv").write_text("B,A\nb1,a1\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_tables(spark, str(tmp_path / "raw"))["t"].collect()


def test_unparsed_values_are_counted(spark, csv_folder):
    lost = {(r.table, r.column): r["values"] for r in io.unparsed_values(spark, csv_folder).collect()}
    assert lost == {("encounters", "COST"): 1, ("patients", "BIRTHDATE"): 1}


def test_rescued_values(spark, csv_folder):
    tables = io.read_tables(spark, csv_folder, rescue="rescued")
    encounters = {r.Id: r.rescued for r in tables["encounters"].collect()}
    assert encounters == {"e1": None, "e2": {"COST": "n/a"}, "e3": None, "e4": None}
    patients = {r.Id: r.rescued for r in tables["patients"].collect()}
    assert patients["p2"] == {"BIRTHDATE": "not a date"} and patients["p1"] is None
    assert {r.rescued for r in tables["providers"].collect()} == {None}
    with pytest.raises(ValueError, match="RACE already"):
        io.read_tables(spark, csv_folder, rescue="RACE")
