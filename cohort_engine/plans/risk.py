"""From stored encounters to risk scores."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame

from cohort_engine.config import RiskConfig
from cohort_engine.operators import cohorts, features, ml, stats
from cohort_engine.session import scratch_dir, tune_session
from cohort_engine.sources import models
from cohort_engine.sources.dataset import CohortDataset
from cohort_engine.sources.io import load, save, save_compact, save_features


def comorbid_names(encounters: DataFrame, config: RiskConfig, paired: bool = False) -> list[str]:
    """Names of the conditions that become features. Runs one job; at most
    ``config.num_conditions`` rows come to the driver. ``paired`` as in
    ``stats.comorbid_conditions``."""
    top = stats.comorbid_conditions(
        encounters, config.condition, config.num_conditions, exclude_index=False, paired=paired
    )
    return [row[cohorts.CONDITION] for row in top.collect()]


def stored_cohort(encounters: DataFrame, config: RiskConfig, path: str, fmt: str) -> DataFrame:
    """Cases and controls, written to ``path`` and read from there.

    ``encounters`` may as well be their distinct pairs of patient and condition.

    The features join the cohort three times. As a table it is made once, and Spark
    knows its size when it chooses how to join it. Sorted keys take fewer bytes, so that
    more patients fit below the threshold and whole encounters need not be shuffled to them.
    """
    cohort = cohorts.case_control(encounters, config.condition).sortWithinPartitions("PATIENT")
    save_compact(cohort, path, fmt)
    return load(encounters.sparkSession, path, fmt)


def encounter_features(
    encounters: DataFrame,
    config: RiskConfig,
    exclude_current: bool = False,
    cohort: DataFrame | None = None,
    storage: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Features and label of all encounters of cases and controls.

    ``encounters`` should be a stored table; it is read twice. The first pass stores its
    distinct pairs of patient and condition, from which the cohort and the names of the
    comorbid conditions follow; the second stores the encounters of the cohort, from
    which all features are made. ``storage`` is a folder for these tables, by default the
    scratch folder. Runs the jobs that store them and the one of ``comorbid_names``.
    """
    spark = encounters.sparkSession
    storage = storage or scratch_dir(spark, "features")

    def stored(df, name):
        save_compact(df, f"{storage}/{name}", fmt)
        return load(spark, f"{storage}/{name}", fmt)

    pairs = stored(
        encounters.select("PATIENT", cohorts.CONDITION).distinct(), "patient_conditions"
    )
    if cohort is None:
        cohort = stored_cohort(pairs, config, f"{storage}/cohort", fmt)
    qualified = stored(
        cohorts.qualified_encounters(encounters, cohort), "qualified_encounters"
    )
    return features.build(
        qualified,
        comorbid_names(pairs, config, paired=True),
        config,
        exclude_current=exclude_current,
        literal=True,
    )


@dataclass(frozen=True)
class Study:
    run_id: str
    features_path: str
    model_name: str
    model_version: str
    model_path: str
    params: dict
    loss: float
    accuracy: float


def run_study(
    dataset: CohortDataset,
    config: RiskConfig | None = None,
    n_evals: int = 32,
    folds: int = 5,
    balance_mode: str = "exact",
    tags: dict | None = None,
    **encoder_options,
) -> Study:
    """Build and store features, tune, train, store and log the model.

    Everything is below ``dataset.root``: patient_conditions, cohort,
    qualified_encounters, encounter_features, training_set, models and runs. The table of
    runs has a row for each trial, one for the best and one for the model.
    """
    config = config or RiskConfig()
    spark, run_id = tune_session(dataset.spark), uuid.uuid4().hex
    path, runs = dataset.path("encounter_features"), dataset.path("runs")
    save_features(
        encounter_features(
            dataset.patient_encounters, config, storage=dataset.root, fmt=dataset.fmt
        ),
        path,
        {**(tags or {}), "run_id": run_id},
        dataset.fmt,
    )
    stored = load(spark, path, dataset.fmt)
    flags = sum(1 for c in stored.columns if c.startswith("comorbidity_"))
    names = ml.feature_names(flags)
    rows = ml.training_set(
        features.balance(stored, mode=balance_mode, seed=43, stored=True), names, keep=["Enc_Id"]
    )
    save(rows, dataset.path("training_set"), dataset.fmt, "overwrite")
    return learn(
        load(spark, dataset.path("training_set"), dataset.fmt),
        names,
        config,
        dataset.path("models"),
        runs,
        path,
        run_id,
        n_evals,
        folds,
        **encoder_options,
    )


def learn(
    rows: DataFrame,
    names: Sequence[str],
    config: RiskConfig,
    models_path: str,
    runs_path: str,
    features_path: str = "",
    run_id: str | None = None,
    n_evals: int = 32,
    folds: int = 5,
    **encoder_options,
) -> Study:
    """Tune on the stored training set ``rows``, train the best model, store and log it.

    The table of runs gets a row for each trial, one for the best and one for the model
    with its cross-validated accuracy.
    """
    spark, run_id = rows.sparkSession, run_id or uuid.uuid4().hex
    tuned = ml.tune(rows, names, ml.search_space(n_evals), folds, **encoder_options)
    best = min(t["loss"] for t in tuned.trials)
    settings = {**asdict(config), "run_id": run_id}
    models.log_runs(
        spark,
        runs_path,
        [
            (
                f"trial-{i}",
                {**settings, **trial, **ml.params_to_lr(trial, trial["rows"])},
                {"loss": trial["loss"]},
                None,
            )
            for i, trial in enumerate(tuned.trials)
        ],
    )
    models.log_run(spark, runs_path, "tuning", {**settings, **tuned.best}, {"loss": best})
    model, accuracy = ml.train(rows, names, tuned.best, folds, **encoder_options)
    location = models.save_model(model, models_path, config.model_name, run_id)
    models.log_run(
        spark, runs_path, "training", {**settings, **tuned.best}, {"accuracy": accuracy}, location
    )
    return Study(
        run_id, features_path, config.model_name, run_id, location, tuned.best, best, accuracy
    )


def score_study(dataset: CohortDataset, study: Study, limit: int | None = None) -> DataFrame:
    """Risk scores of the stored encounters, by the stored model."""
    model = models.load_model(
        dataset.path("models"), study.model_name, study.model_version
    )
    return ml.score(model, load(dataset.spark, study.features_path, dataset.fmt), limit)
