import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohort_engine.operators import ml, sweep
from cohort_engine.operators.sweep import Setting, Sweep


@pytest.fixture(scope="module")
def data(spark):
    """Rows with sparse features, a number, a constant, and folds."""
    draw = F.abs(F.hash("id", F.lit(9))) % 100
    rows = spark.range(1500).select(
        F.col("id").cast("string").alias("Enc_Id"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("site"),
        F.concat(F.lit("c"), F.abs(F.hash("id", F.lit(3))) % 30).alias("code"),
        F.lit("k").alias("constant"),
        F.when(F.col("id") % 2 == 0, draw < 20).otherwise(draw < 85).cast("int").alias("label"),
    )
    names = ["site", "code", "constant"]
    split = ml.stratified_folds(rows, "label", "Enc_Id", 3)
    encoded = ml.fit_encoder(rows, ml.encoder(names)).transform(split)
    out = encoded.select("features", F.col("label").cast("double").alias("label"), "fold").cache()
    out.count()
    return out


SETTINGS = [
    Setting(fold, reg, ratio, 1e-8)
    for fold in (None, 2)
    for reg in (0.01, 0.0005)
    for ratio in (0.0, 0.6)
]


@pytest.fixture(scope="module")
def fits(data):
    run = Sweep(data)
    yield run.fit(SETTINGS, 3), run
    run.close()


def test_same_models_as_one_by_one(data, fits):
    for i, s in enumerate(SETTINGS):
        rows = data if s.fold is None else data.filter(F.col("fold") != s.fold)
        alone = LogisticRegression(
            regParam=s.reg, elasticNetParam=s.l1_ratio, tol=1e-10, standardization=False
        ).fit(rows)
        assert np.abs(fits[0].coefficients[i] - alone.coefficients.toArray()).max() < 2e-3
        assert abs(fits[0].intercepts[i] - alone.intercept) < 2e-3


def test_counts_equal_predictions(data, fits):
    settings = [s for s in SETTINGS if s.fold is not None]
    chosen = [i for i, s in enumerate(SETTINGS) if s.fold is not None]
    some = sweep.Fits(*(getattr(fits[0], f)[chosen] for f in ("coefficients", "intercepts", "steps")))
    counts = fits[1].count(some, settings)
    rows = data.collect()
    for i, s in enumerate(settings):
        guess = [
            (r.label, r.features.dot(some.coefficients[i]) + some.intercepts[i] > 0)
            for r in rows
            if r.fold == s.fold
        ]
        hits = sum(1 for label, g in guess if label == 1 and g)
        wrong = sum(1 for label, g in guess if (label == 1) != g)
        assert counts[i].tolist() == [hits, wrong, len(guess)]


def test_in_turns_and_summed_by_executors(data, fits, monkeypatch):
    """Few models at a time, sums over groups of tasks: the same models."""
    monkeypatch.setattr(sweep, "STATE_BYTES", 1)
    monkeypatch.setattr(sweep, "DIRECT_BYTES", 0)
    monkeypatch.setattr(sweep, "PIECE", 8)
    run = Sweep(data.repartition(7))
    some = run.fit(SETTINGS[3:5], 3)
    assert np.abs(some.coefficients - fits[0].coefficients[3:5]).max() < 1e-6
    run.close()


def test_dense_vectors_and_one_label(spark):
    rows = spark.range(60).select(
        array_to_vector(F.array((F.col("id") % 3).cast("double"), F.lit(0.0))).alias("features"),
        (F.col("id") % 3 == 1).cast("double").alias("label"),
        (F.col("id") % 2).cast("int").alias("fold"),
    )
    run = Sweep(rows)
    fits = run.fit([Setting(None, 0.0, 0.0, 1e-8)], 2)
    assert fits.coefficients.shape == (1, 2) and fits.coefficients[0, 1] == 0
    run.close()
    for label, sign in ((1.0, 1), (0.0, -1)):
        run = Sweep(rows.withColumn("label", F.lit(label)))
        fits = run.fit([Setting(0, 0.1, 0.5, 0.1)], 2)
        assert fits.intercepts[0] == sign * math.inf and not fits.coefficients.any()
        assert run.count(fits, [Setting(0, 0.1, 0.5, 0.1)])[0].tolist() == [30 * label, 0, 30]
        run.close()


def test_a_sweep_is_few_jobs(spark, data):
    """As many jobs for many models as for one, but for those that stop later."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(settings):
        run = Sweep(data)
        spark.sparkContext.setJobGroup(f"sweep-{len(settings)}", "")
        run.fit(settings, 3)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        run.close()
        return len(tracker.getJobIdsForGroup(f"sweep-{len(settings)}"))

    one = jobs([Setting(0, 0.01, 0.3, 0.05)])
    many = jobs([Setting(f, r, 0.3, 0.05) for f in range(3) for r in (0.01, 0.005, 0.02)])
    assert many <= 2 * one + 4
