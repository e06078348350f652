"""From CSV files to risk scores, with a planted history effect."""

import datetime as dt
import random

import pytest

from cohort_engine import CohortDataset, RiskConfig
from cohort_engine.plans import risk


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("study")
    raw = folder / "csv"
    raw.mkdir()
    draw = random.Random(11)
    patients = [f"p{i}" for i in range(120)]
    (raw / "patients.csv").write_text(
        "Id,BIRTHDATE,FIRST,RACE,GENDER,ZIP\n"
        + "".join(
            f"{p},19{50 + i % 50}-05-05,N{i},{'rs'[i % 2]},{'FM'[i % 2]},0213{i % 4}\n"
            for i, p in enumerate(patients)
        )
    )
    (raw / "organizations.csv").write_text("Id,NAME,ZIP\no1,General,02101\no2,Other,02102\n")
    (raw / "providers.csv").write_text("Id,NAME\nd1,Dr. One\n")
    lines, start = [], dt.datetime(2019, 1, 1, 8)
    for i, p in enumerate(patients):
        reasons = ["Drug overdose", "Chronic pain", ""] if i % 2 else ["Chronic pain", "Flu", ""]
        for _ in range(12):
            day = start + dt.timedelta(days=draw.randrange(400))
            lines.append(
                f"e{len(lines)},{day.isoformat()}Z,,{p},o{1 + i % 2},ambulatory,"
                f"{draw.choice([10, 20, 30])},visit,{draw.choice(reasons)}\n"
            )
    (raw / "encounters.csv").write_text(
        "Id,START,END,PATIENT,PROVIDER,ENCOUNTERCLASS,COST,DESCRIPTION,REASONDESCRIPTION\n"
        + "".join(lines)
    )
    made = CohortDataset(spark, "study_test", str(folder / "lake"), pii=["FIRST"])
    made.refresh(str(raw))
    yield made
    made.drop_all_tables()


@pytest.fixture(scope="module")
def study(dataset):
    return risk.run_study(
        dataset, RiskConfig(num_conditions=3), n_evals=2, folds=2, tags={"experiment_id": "e1"}
    )


def test_features_are_stored_with_tags(spark, study):
    row = spark.read.parquet(study.features_path).first()
    assert row.experiment_id == "e1" and row.run_id == study.run_id


def test_training_set_is_balanced(dataset, spark, study):
    counts = spark.read.parquet(dataset.path("training_set")).groupBy("label").count()
    sizes = {r.label: r["count"] for r in counts.collect()}
    assert sizes[0] == sizes[1] > 0


def test_model_is_better_than_chance(study):
    assert study.model_name == "drug-overdose"
    assert study.accuracy > 0.7 and study.loss < -0.6


def test_runs_are_logged(dataset, spark, study):
    runs = {r.run_name: r for r in spark.read.parquet(dataset.path("runs")).collect()}
    assert runs["training"].metrics["accuracy"] == pytest.approx(study.accuracy)
    assert runs["training"].model == study.model_path
    assert runs["tuning"].params["condition"] == "drug overdose"


def test_scores(dataset, spark, study):
    scores = risk.score_study(dataset, study)
    assert scores.columns == ["PATIENT", "Enc_Id", "START_TIME", "risk_score"]
    assert scores.count() == spark.read.parquet(study.features_path).count()
    assert risk.score_study(dataset, study, limit=100).count() == 100


def test_label_can_skip_the_current_day(dataset):
    config = RiskConfig(num_conditions=3)
    both = risk.encounter_features(dataset.patient_encounters, config)
    later = risk.encounter_features(dataset.patient_encounters, config, exclude_current=True)
    assert both.filter("comorbidity_0 = 1 AND label = 0").count() == 0
    assert later.filter("comorbidity_0 = 1 AND label = 0").count() > 0


def test_config_is_checked():
    assert RiskConfig() == RiskConfig("drug overdose", 10, 90, 10)
    for wrong in ({"condition": ""}, {"num_conditions": 0}, {"num_days": 0}, {"num_days_future": -1}):
        with pytest.raises(ValueError):
            RiskConfig(**wrong)


def test_every_trial_is_logged(dataset, spark, study):
    runs = {r.run_name: r for r in spark.read.parquet(dataset.path("runs")).collect()}
    assert {"trial-0", "trial-1", "tuning", "training"} <= set(runs)
    losses = [runs[f"trial-{i}"].metrics["loss"] for i in range(2)]
    assert min(losses) == study.loss == runs["tuning"].metrics["loss"]
    assert "regParam" in runs["trial-0"].params
    assert {r.params["run_id"] for r in runs.values()} == {study.run_id}


def test_names_with_wildcards_flag_their_own_text(spark):
    rows = [
        ("e1", "p1", "sick a_b"),
        ("e2", "p1", "sick axb"),
        ("e3", "p1", "50% \\ x"),
        ("e4", "p1", "50 then \\ x"),
        ("e5", "p2", "well"),
    ]
    df = spark.createDataFrame(rows, "Enc_Id string, PATIENT string, REASONDESCRIPTION string")
    start, born = dt.datetime(2020, 1, 1), dt.date(1980, 1, 1)
    df = df.selectExpr(
        "*",
        f"TIMESTAMP '{start}' AS START_TIME",
        f"DATE '{born}' AS BIRTHDATE",
        "'visit' AS DESCRIPTION",
        "1 AS ZIP",
    )
    config = RiskConfig("sick", num_conditions=10)
    names = risk.comorbid_names(df, config)
    built = risk.encounter_features(df, config).collect()
    texts = {r[0]: r[2] for r in rows}
    assert len(names) == 4 and built
    for r in built:
        for i, name in enumerate(names):
            assert r[f"comorbidity_{i}"] == int(name in texts[r.Enc_Id])
