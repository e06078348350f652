"""name -> query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.config import DashboardConfig, RiskConfig
from cohort_engine.operators import cohorts, curation, features, ml, stats
from cohort_engine.operators.sampling import take_by_hash
from cohort_engine.plans import dashboard, risk
from cohort_engine.session import scratch_dir, tune_session
from cohort_engine.sources import layout, models
from cohort_engine.sources.dataset import CohortDataset
from cohort_engine.sources.io import (
    load,
    read_tables,
    row_counts,
    save_compact,
    unparsed_values,
)
from cohort_engine.sources.schemas import ENTITIES
from verification import binding
from verification.binding import INDEX_CONDITION, SECOND_CONDITION

CONFIG = RiskConfig(condition=INDEX_CONDITION)


def _shown(df: DataFrame) -> DataFrame:
    """Dates and times as text, which every engine prints alike."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _stored(spark, df, name):
    """``df`` as a table of files: the analyses read their input several times."""
    path = scratch_dir(spark, name)
    save_compact(df, path)
    return load(spark, path, "parquet")


# What features and label are made of, and what is a feature as it is.
_SOURCES = (
    "Enc_Id", "PATIENT", "START_TIME", "BIRTHDATE", "DESCRIPTION", "REASONDESCRIPTION", "ZIP",
)
_PLAIN = ("ENCOUNTERCLASS", "COST", "PROVIDER_ZIP", "RACE", "GENDER")
_NAMES = ml.feature_names(CONFIG.num_conditions)


def _encounters(spark, sf_dir, columns=()):
    places = _stored(spark, binding.organizations(spark, sf_dir), "organizations")
    if columns:
        wide = binding.encounter_columns(spark, sf_dir, columns, places)
    else:
        wide = binding.patient_encounters(spark, sf_dir, places)
    return _stored(spark, wide, "patient_encounters")


def _flagged(spark, sf_dir, *columns):
    encounters = _encounters(spark, sf_dir, ["Enc_Id", "PATIENT", "REASONDESCRIPTION", *columns])
    return features.add_comorbidities(encounters, risk.comorbid_names(encounters, CONFIG))


def _features(spark, sf_dir, columns=()):
    return risk.encounter_features(_encounters(spark, sf_dir, columns), CONFIG)


def _stored_features(spark, sf_dir, columns):
    """``columns`` of the features of all encounters, which are read several times. What
    does not go into them is neither joined nor stored."""
    plain = [c for c in _PLAIN if c in columns]
    found = _features(spark, sf_dir, [*_SOURCES, *plain]).select(*columns)
    return _stored(spark, found, "encounter_features")


def _training_rows(spark, sf_dir, names=_NAMES):
    stored = _stored_features(spark, sf_dir, ["Enc_Id", *names, "label"])
    return _balanced_rows(stored, names)


def _balanced_rows(stored_features, names=_NAMES):
    balanced = features.balance(stored_features, stored=True)
    return ml.training_set(balanced, names, keep=["Enc_Id"])


def _clustered(spark, stored, columns):
    path = scratch_dir(spark, "clustered")
    layout.zorder_write(stored, columns, path)
    return _shown(load(spark, path, "parquet"))


def curate_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(binding.encounters(spark, sf_dir))


def curate_patients(spark, sf_dir):
    return _shown(curation.curate_patients(binding.raw_patients(spark, sf_dir)))


def curate_organizations(spark, sf_dir):
    return binding.organizations(spark, sf_dir)


def curate_providers(spark, sf_dir):
    return curation.curate_providers(binding.raw_providers(spark, sf_dir))


def deid_patients(spark, sf_dir):
    hidden = curation.obfuscate(binding.raw_patients(spark, sf_dir), curation.PII_COLUMNS)
    return hidden.select("Id", *curation.PII_COLUMNS)


def patient_encounters(spark, sf_dir):
    return _shown(binding.patient_encounters(spark, sf_dir))


def table_row_counts(spark, sf_dir):
    return row_counts(
        {
            "encounters": binding.encounters(spark, sf_dir),
            "organizations": binding.organizations(spark, sf_dir),
            "patient_encounters": binding.patient_encounters(spark, sf_dir),
            "patients": binding.patients(spark, sf_dir),
            "providers": curate_providers(spark, sf_dir),
        }
    )


def top_conditions_encounters(spark, sf_dir):
    return stats.top_conditions(binding.patient_encounters(spark, sf_dir), 20, by="encounters")


def top_conditions_patients(spark, sf_dir):
    return stats.top_conditions(binding.patient_encounters(spark, sf_dir), 20, by="patients")


def condition_counts_two(spark, sf_dir):
    return stats.condition_counts(
        binding.patient_encounters(spark, sf_dir), [INDEX_CONDITION, SECOND_CONDITION]
    )


def comorbid_excl_index(spark, sf_dir):
    return stats.comorbid_conditions(
        binding.patient_encounters(spark, sf_dir), INDEX_CONDITION, 20
    )


def comorbid_incl_index(spark, sf_dir):
    return stats.comorbid_conditions(
        binding.patient_encounters(spark, sf_dir), INDEX_CONDITION, 10, exclude_index=False
    )


def cases(spark, sf_dir):
    return cohorts.cases(binding.patient_encounters(spark, sf_dir), INDEX_CONDITION)


def non_cases(spark, sf_dir):
    encounters = binding.patient_encounters(spark, sf_dir)
    return cohorts.non_cases(encounters, cohorts.cases(encounters, INDEX_CONDITION))


def controls(spark, sf_dir):
    return cohorts.controls(binding.patient_encounters(spark, sf_dir), INDEX_CONDITION)


def case_control(spark, sf_dir):
    return cohorts.case_control(binding.patient_encounters(spark, sf_dir), INDEX_CONDITION)


def qualified_encounters(spark, sf_dir):
    encounters = binding.patient_encounters(spark, sf_dir)
    return _shown(
        cohorts.qualified_encounters(
            encounters, cohorts.case_control(encounters, INDEX_CONDITION)
        )
    )


def comorbidity_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        "Enc_Id", *[f"comorbidity_{i}" for i in range(CONFIG.num_conditions)]
    )


def day_and_age(spark, sf_dir):
    dated = features.add_day_and_age(binding.patient_encounters(spark, sf_dir))
    return _shown(dated.select("Enc_Id", "EARLIEST_TIME", "day", "patient_age"))


def calendar_features(spark, sf_dir):
    dated = features.add_calendar(binding.patient_encounters(spark, sf_dir))
    return dated.select("Enc_Id", "START_YEAR", "START_MONTH", "ZIP")


def recent_history(spark, sf_dir):
    n = CONFIG.num_conditions
    dated = features.add_day_and_age(_flagged(spark, sf_dir, "START_TIME", "BIRTHDATE"))
    return features.add_recent(dated, n, CONFIG.num_days).select(
        "Enc_Id", *[f"recent_{i}" for i in range(n)]
    )


def label_lookahead(spark, sf_dir):
    dated = features.add_day_and_age(_flagged(spark, sf_dir, "START_TIME", "BIRTHDATE"))
    return features.add_label(dated, CONFIG.num_days_future).select("Enc_Id", "label")


def label_next_days(spark, sf_dir):
    dated = features.add_day_and_age(_flagged(spark, sf_dir, "START_TIME", "BIRTHDATE"))
    labelled = features.add_label(dated, CONFIG.num_days_future, exclude_current=True)
    return labelled.select("Enc_Id", "label")


def encounter_features(spark, sf_dir):
    return _shown(_features(spark, sf_dir))


def label_distribution(spark, sf_dir):
    return features.label_distribution(_features(spark, sf_dir, _SOURCES))


def balanced_training_set(spark, sf_dir):
    stored = _stored_features(spark, sf_dir, ["Enc_Id", "PATIENT", "day", "label"])
    return features.balance(stored, stored=True)


def balanced_label_distribution(spark, sf_dir):
    stored = _stored_features(spark, sf_dir, ["Enc_Id", "label"])
    return features.label_distribution(features.balance(stored, stored=True))


def training_set(spark, sf_dir):
    return _training_rows(spark, sf_dir)


def first_encounters_by_hash(spark, sf_dir):
    encounters = binding.patient_encounters(spark, sf_dir)
    rows = take_by_hash(encounters, "Enc_Id", 100)
    return _shown(rows.select("Enc_Id", "PATIENT", "START_TIME"))


def co_occurrence(spark, sf_dir):
    return stats.co_occurrence(
        binding.patients(spark, sf_dir),
        binding.patient_encounters(spark, sf_dir),
        INDEX_CONDITION,
        SECOND_CONDITION,
    )


def contingency(spark, sf_dir):
    return stats.contingency(co_occurrence(spark, sf_dir), INDEX_CONDITION, SECOND_CONDITION)


def _association(spark, sf_dir, correction):
    return dashboard.association(
        binding.patient_encounters(spark, sf_dir),
        binding.patients(spark, sf_dir),
        INDEX_CONDITION,
        SECOND_CONDITION,
        correction,
    ).withColumns(
        {
            "statistic": F.round("statistic", 8),
            "p_value": F.round("p_value", 8),
            "log10_p": F.round("log10_p", 8),
        }
    )


def chi_square(spark, sf_dir):
    return _association(spark, sf_dir, correction=True)


def chi_square_uncorrected(spark, sf_dir):
    return _association(spark, sf_dir, correction=False)


def zorder_write(spark, sf_dir):
    return _clustered(
        spark,
        _encounters(spark, sf_dir),
        ["REASONDESCRIPTION", "START_TIME", "ZIP", "PATIENT"],
    )


def zorder_patients(spark, sf_dir):
    return _clustered(
        spark,
        _stored(spark, binding.patients(spark, sf_dir), "stored"),
        ["BIRTHDATE", "ZIP", "GENDER", "RACE"],
    )


def zorder_skipping(spark, sf_dir):
    """Whether a filter on any of the clustered columns has fewer files to read."""
    plain = _encounters(spark, sf_dir)
    ranges = {
        "REASONDESCRIPTION": (INDEX_CONDITION, INDEX_CONDITION),
        "START_TIME": (dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1)),
        "ZIP": (3, 4),
        "PATIENT": (100, 120),
    }
    path = scratch_dir(spark, "clustered")
    layout.zorder_write(plain, list(ranges), path, files=64)
    clustered = load(spark, path, "parquet")
    found = []
    for column, (low, high) in ranges.items():
        rows = clustered.agg(F.count_if(F.col(column).between(low, high)).alias("rows"))
        before = layout.files_to_read(plain, column, low, high)
        after = layout.files_to_read(clustered, column, low, high)
        shares = [F.try_divide(t["to_read"], t["files"]) for t in (before, after)]
        was = before.select(shares[0].alias("was")).scalar()
        now = after.select(shares[1].alias("now")).scalar()
        found.append(
            rows.select(F.lit(column).alias("column"), "rows", (now < 0.75 * was).alias("fewer_files"))
        )
    return reduce(DataFrame.unionByName, found)


def _written_csv(spark, tables):
    folder = scratch_dir(spark, "raw")
    for name, df in tables.items():
        df.write.csv(f"{folder}/{name}.csv", header=True, compression="gzip")
    return folder


def csv_round_trip(spark, sf_dir):
    """Encounters written as CSV and read with their declared types."""
    folder = _written_csv(spark, {"encounters": binding.raw_encounters(spark, sf_dir)})
    return _shown(read_tables(spark, folder)["encounters"])


def _spoiled_csv(spark, sf_dir):
    raw = binding.raw_encounters(spark, sf_dir)
    cost = F.when(F.col("PATIENT") % 7 == 0, "n/a").otherwise(F.col("COST").cast("string"))
    start = F.when(F.col("PROVIDER") % 50 == 0, F.concat(F.lit("day "), F.col("PATIENT").cast("string")))
    start = start.otherwise(F.col("START").cast("string"))
    return _written_csv(spark, {"encounters": raw.withColumns({"COST": cost, "START": start})})


def csv_unparsed(spark, sf_dir):
    """Values that don't parse are null, and kept in the rescue column."""
    table = read_tables(spark, _spoiled_csv(spark, sf_dir), rescue="rescued")["encounters"]
    return table.filter("rescued IS NOT NULL").select(
        "Id",
        "COST",
        F.col("START").isNull().alias("no_start"),
        F.col("rescued")["COST"].alias("cost_text"),
        F.col("rescued")["START"].alias("start_text"),
    )


def csv_unparsed_counts(spark, sf_dir):
    return unparsed_values(spark, _spoiled_csv(spark, sf_dir))


def _refreshed(spark, sf_dir):
    raw = {
        "encounters": binding.raw_encounters(spark, sf_dir),
        "organizations": binding.raw_organizations(spark, sf_dir),
        "patients": binding.raw_patients(spark, sf_dir),
        "providers": binding.raw_providers(spark, sf_dir),
    }
    root = scratch_dir(spark, "lake")
    name = "clinic_" + root.rsplit("-", 1)[1]
    data = CohortDataset(spark, name, root, pii=curation.PII_COLUMNS)
    data.refresh(_written_csv(spark, raw))
    return data


def refresh_tables(spark, sf_dir):
    """From CSV files to the tables of a database: the wide one, by the catalog."""
    wide = _refreshed(spark, sf_dir).patient_encounters
    return _shown(
        wide.select("Enc_Id", "PATIENT", "ORGANIZATION", "START_TIME", "COST", "FIRST", "ADDRESS",
                    "BIRTHDATE", "PROVIDER_CITY")
    )


def refresh_row_counts(spark, sf_dir):
    data = _refreshed(spark, sf_dir)
    return row_counts({entity: data.table(entity) for entity in ENTITIES})


def dashboard_reports(spark, sf_dir):
    """The dashboard's rankings as one table."""
    reports = dashboard.dashboard(
        binding.patient_encounters(spark, sf_dir),
        binding.patients(spark, sf_dir),
        DashboardConfig(first_condition=INDEX_CONDITION, second_condition=SECOND_CONDITION),
    )
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("report"), "REASONDESCRIPTION", "count")
            for name, df in reports.items()
            if "REASONDESCRIPTION" in df.columns
        ],
    )


def _learned(spark, sf_dir):
    kept = ["Enc_Id", "PATIENT", "START_TIME"]
    stored = _stored_features(spark, sf_dir, [*kept, *_NAMES, "label"])
    rows = _stored(spark, _balanced_rows(stored), "training_set")
    root = scratch_dir(spark, "study")
    study = risk.learn(rows, _NAMES, CONFIG, f"{root}/models", f"{root}/runs")
    return stored, study, root


def risk_scores(spark, sf_dir):
    """By the stored model of the best of all settings."""
    stored, study, root = _learned(spark, sf_dir)
    model = models.load_model(f"{root}/models", study.model_name, study.model_version)
    return _shown(ml.score(model, stored))


def run_log(spark, sf_dir):
    """What a study has logged: its trials, the best of them, and the model."""
    _, study, root = _learned(spark, sf_dir)
    runs = load(spark, f"{root}/runs", "parquet")
    least = runs.filter(F.col("run_name").startswith("trial-")).agg(F.min(F.col("metrics")["loss"]))
    loss, accuracy = F.col("metrics")["loss"], F.col("metrics")["accuracy"]
    return runs.select(
        "run_name",
        F.col("params")["rows"].cast("long").alias("rows"),
        loss.between(-1, 0).alias("has_loss"),
        F.when(F.col("run_name") == "tuning", loss == least.scalar()).alias("is_least"),
        accuracy.between(0.5, 1).alias("has_accuracy"),
        F.col("model").isNotNull().alias("has_model"),
    )


def tune_results(spark, sf_dir):
    rows = _stored(spark, _training_rows(spark, sf_dir), "training_set")
    return ml.tune(rows, _NAMES).to_frame(spark)


# Almost no penalty: with one categorical feature the fitted risk is the label rate.
_FREE = [{"tol": -14.0, "C": 25.0, "l1_ratio": -25.0}, {"tol": -14.0, "C": 20.0, "l1_ratio": -20.0}]


def _race_rows(spark, sf_dir):
    return _stored(spark, _training_rows(spark, sf_dir, ["RACE"]), "training_set")


def encoded_features(spark, sf_dir):
    rows = _stored(spark, _training_rows(spark, sf_dir), "training_set")
    return ml.encoded_features(rows, _NAMES, ["Enc_Id"])


def fold_counts(spark, sf_dir):
    split = ml.stratified_folds(_race_rows(spark, sf_dir), "label", "Enc_Id", 5)
    return split.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("count"))


def risk_of_group(spark, sf_dir):
    rows = _race_rows(spark, sf_dir)
    model, _ = ml.train(rows, ["RACE"], _FREE[0])
    risk = ml.score(model, rows, keep=["Enc_Id", "RACE"])
    return risk.withColumn("risk_score", F.round("risk_score", 3))


def tune_of_group(spark, sf_dir):
    tuned = ml.tune(_race_rows(spark, sf_dir), ["RACE"], _FREE)
    return tuned.to_frame(spark).select("trial", F.round("loss", 8).alias("loss"))


def chi_square_strong(spark, sf_dir):
    """Of two conditions of which one is part of the other; p is below 1e-10."""
    return (
        dashboard.association(
            binding.patient_encounters(spark, sf_dir),
            binding.patients(spark, sf_dir),
            INDEX_CONDITION,
            INDEX_CONDITION.split()[0],
            True,
        )
        .withColumns({"statistic": F.round("statistic", 6), "log10_p": F.round("log10_p", 6)})
        .drop("p_value")
    )


_QUERIES = (
    curate_encounters,
    curate_patients,
    curate_organizations,
    curate_providers,
    deid_patients,
    patient_encounters,
    table_row_counts,
    top_conditions_encounters,
    top_conditions_patients,
    condition_counts_two,
    comorbid_excl_index,
    comorbid_incl_index,
    cases,
    non_cases,
    controls,
    case_control,
    qualified_encounters,
    comorbidity_flags,
    day_and_age,
    calendar_features,
    recent_history,
    label_lookahead,
    label_next_days,
    encounter_features,
    label_distribution,
    balanced_training_set,
    balanced_label_distribution,
    training_set,
    first_encounters_by_hash,
    co_occurrence,
    contingency,
    chi_square,
    chi_square_uncorrected,
    zorder_write,
    zorder_patients,
    zorder_skipping,
    csv_round_trip,
    csv_unparsed,
    csv_unparsed_counts,
    refresh_tables,
    refresh_row_counts,
    dashboard_reports,
    risk_scores,
    run_log,
    tune_results,
    encoded_features,
    fold_counts,
    risk_of_group,
    tune_of_group,
    chi_square_strong,
)


def _tuned(query):
    return lambda spark, sf_dir: query(tune_session(spark), sf_dir)


QUERIES = {query.__name__: _tuned(query) for query in _QUERIES}
