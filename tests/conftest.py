import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers of the test session find the repository as well.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from cohort_engine.session import tune_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("cohort-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune_session(session)
    session.stop()


@pytest.fixture
def encounters(spark):
    """encounters([(patient, 'yyyy-mm-dd' or None, reason), ...]) -> DataFrame"""

    def make(rows, start=dt.date(1980, 1, 1)):
        schema = (
            "Enc_Id string, PATIENT string, START_TIME timestamp, BIRTHDATE date,"
            " DESCRIPTION string, REASONDESCRIPTION string, ZIP int"
        )
        data = [
            (
                f"e{i}",
                patient,
                None if day is None else dt.datetime.fromisoformat(day),
                start,
                "visit",
                reason,
                2138,
            )
            for i, (patient, day, reason) in enumerate(rows)
        ]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def csv_folder(tmp_path):
    """A folder of raw CSV tables; encounters in two part files."""
    folder = tmp_path / "raw data"
    (folder / "encounters.csv").mkdir(parents=True)
    (folder / "README.txt").write_text("not a table\n")
    (folder / "patients.csv").write_text(
        "Id,BIRTHDATE,SSN,FIRST,ADDRESS,RACE,GENDER,ZIP\n"
        "p1,1970-01-31,999-1,Ann,1 Main St,white,F,02138\n"
        "p2,not a date,,Bob,2 Main St,black,M,10001\n"
        "p3,1990-12-01,999-3,Cyd,3 Main St,asian,F,02139\n"
    )
    (folder / "organizations.csv").write_text(
        "Id,NAME,ADDRESS,CITY,STATE,ZIP\no1,General,9 High St,Boston,MA,02101\n"
    )
    (folder / "providers.csv").write_text("Id,NAME\nd1,Dr. One\n")
    header = "Id,START,END,PATIENT,PROVIDER,ENCOUNTERCLASS,COST,DESCRIPTION,REASONDESCRIPTION\n"
    (folder / "encounters.csv" / "part-0.csv").write_text(
        header
        + "e1,2020-01-01T10:00:00Z,2020-01-01T11:00:00Z,p1,o1,emergency,10.5,visit,Drug overdose\n"
        + "e2,2020-02-01T10:00:00Z,,p1,o1,ambulatory,n/a,visit,\n"
    )
    (folder / "encounters.csv" / "part-1.csv").write_text(
        header
        + "e3,2020-01-05T10:00:00Z,,p2,o1,ambulatory,20,visit,Chronic pain\n"
        + "e4,2020-01-06T10:00:00Z,,p3,unknown,ambulatory,20,visit,Chronic pain\n"
    )
    return str(folder)
