import hashlib

import pytest

from cohort_engine import CohortDataset
from cohort_engine.sources.schemas import ENTITIES


@pytest.fixture
def dataset(spark, tmp_path):
    made = CohortDataset(spark, "clinic_test", str(tmp_path / "lake"), pii=["SSN", "FIRST"])
    yield made
    made.drop_all_tables()


def test_refresh(dataset, csv_folder):
    dataset.refresh(csv_folder)
    assert dataset.encounters.count() == 4
    assert dataset.providers.columns == ["PROVIDER", "Provider_Name"]
    people = {r.PATIENT: r for r in dataset.patients.collect()}
    assert people["p1"].FIRST == hashlib.sha1(b"Ann").hexdigest()
    assert people["p1"].ADDRESS == "1 Main St"
    assert people["p2"].SSN is None
    # e4 belongs to an organization nobody knows
    wide = {r.Enc_Id: r for r in dataset.patient_encounters.collect()}
    assert sorted(wide) == ["e1", "e2", "e3"]
    assert wide["e1"].PROVIDER_ZIP == "02101" and wide["e1"].ZIP == "02138"


def test_refresh_again_replaces(dataset, csv_folder):
    dataset.refresh(csv_folder)
    dataset.refresh(csv_folder)
    assert dataset.encounters.count() == 4


def test_setter_overwrites(dataset, csv_folder):
    dataset.refresh(csv_folder)
    dataset.providers = dataset.patients.selectExpr("PATIENT AS PROVIDER")
    assert dataset.providers.count() == 3


def test_files_outlive_the_catalog(dataset, csv_folder, spark):
    dataset.refresh(csv_folder)
    dataset.drop_all_tables()
    assert not spark.catalog.databaseExists("clinic_test")
    dataset.register()
    assert dataset.patient_encounters.count() == 3
    assert spark.catalog.getDatabase("clinic_test").description


def test_purge(dataset, csv_folder, tmp_path):
    dataset.refresh(csv_folder)
    stale = tmp_path / "lake" / "stale"
    stale.mkdir()
    dataset.refresh(csv_folder)
    assert stale.exists()
    dataset.refresh(csv_folder, purge=True)
    assert not stale.exists() and dataset.encounters.count() == 4


def test_purge_refuses_the_root_folder(spark):
    with pytest.raises(ValueError):
        CohortDataset(spark, "x", "file:///").purge_storage()


def test_cluster_keeps_rows(dataset, csv_folder):
    dataset.refresh(csv_folder)
    before = sorted(map(str, dataset.patients.collect()))
    dataset.cluster("patients", ["BIRTHDATE", "ZIP", "GENDER", "RACE"], files=2)
    assert sorted(map(str, dataset.patients.collect())) == before
    dataset.cluster("patients", ["ZIP"])
    assert sorted(map(str, dataset.patients.collect())) == before
    dataset.patients = dataset.providers
    assert dataset.patients.count() == 1


def test_register_finds_the_clustered_files(dataset, csv_folder, spark):
    dataset.refresh(csv_folder)
    dataset.cluster("patients", ["ZIP", "RACE"], files=2)
    files = dataset.patients.inputFiles()
    dataset.drop_all_tables()
    dataset.register()
    assert dataset.patients.inputFiles() == files and "clustered" in files[0]
    dataset.refresh(csv_folder)
    dataset.drop_all_tables()
    dataset.register()
    assert "clustered" not in dataset.patients.inputFiles()[0]


def test_purge_refuses_to_delete_its_input(spark, dataset, csv_folder):
    import shutil

    inside = f"{dataset.root}/raw"
    shutil.copytree(csv_folder, inside)
    with pytest.raises(ValueError, match="refusing"):
        dataset.refresh(inside, purge=True)
    dataset.refresh(inside)
    assert dataset.encounters.count() == 4


def test_strict_refresh_names_what_does_not_parse(dataset, csv_folder):
    with pytest.raises(ValueError, match="encounters.COST 1.*patients.BIRTHDATE 1"):
        dataset.refresh(csv_folder, strict=True)


def test_a_refresh_that_fails_leaves_the_tables(dataset, csv_folder, tmp_path):
    import shutil

    dataset.refresh(csv_folder)
    before = sorted(map(str, dataset.patient_encounters.collect()))
    broken = tmp_path / "broken"
    shutil.copytree(csv_folder, broken)
    # Found only when the last of the part files is read.
    (broken / "encounters.csv" / "part-9.csv").write_text("A,B\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        dataset.refresh(str(broken))
    assert sorted(map(str, dataset.patient_encounters.collect())) == before
    # Names of the dimensions clash: found when the first tables are written already.
    (broken / "encounters.csv" / "part-9.csv").unlink()
    (broken / "organizations.csv").write_text("Id,NAME,RACE\no1,General,x\n")
    with pytest.raises(ValueError, match="rename one"):
        dataset.refresh(str(broken))
    assert sorted(map(str, dataset.patient_encounters.collect())) == before
    assert dataset.organizations.columns[1] == "Org_Name"


def test_register_finishes_what_was_interrupted(dataset, csv_folder, monkeypatch):
    dataset.refresh(csv_folder)
    old = dataset.patients.inputFiles()
    drop, calls = dataset.drop, []

    def stopping(entity):
        calls.append(entity)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        drop(entity)

    monkeypatch.setattr(dataset, "drop", stopping)
    with pytest.raises(RuntimeError):
        dataset.refresh(csv_folder)
    monkeypatch.undo()
    assert dataset.patients.inputFiles() == old
    dataset.register()
    assert dataset.patients.inputFiles() != old
    assert dataset.patient_encounters.count() == 3


def test_refreshed_tables_are_compact(spark, tmp_path, csv_folder):
    data = CohortDataset(spark, "compact_files", str(tmp_path / "lake"))
    data.refresh(csv_folder)
    for entity in ENTITIES:
        assert all(f.endswith(".zstd.parquet") for f in data.table(entity).inputFiles())
    data.drop_all_tables()
