import math

import pytest
from pyspark.sql import functions as F

from cohort_engine.operators import ml
from cohort_engine.sources import models

NAMES = ["site", "cost", "code"]


@pytest.fixture(scope="module")
def rows(spark):
    """Label 1 is likely at site B and unlikely at site A; cost and code are noise."""
    draw = F.abs(F.hash("id", F.lit(9))) % 100
    return (
        spark.range(1200)
        .select(
            F.col("id").cast("string").alias("Enc_Id"),
            F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("site"),
            (F.abs(F.hash("id")) % 40 / 2).alias("cost"),
            F.concat(F.lit("c"), F.abs(F.hash("id", F.lit(3))) % 30).alias("code"),
            F.when(F.col("id") % 2 == 0, draw < 20).otherwise(draw < 85).cast("int").alias("label"),
        )
        .cache()
    )


@pytest.fixture(scope="module")
def trained(rows):
    return ml.train(rows, NAMES, {"tol": -3.0, "C": 0.0, "l1_ratio": -3.0}, folds=3)


def test_training_set_drops_null_rows(spark):
    df = spark.createDataFrame(
        [("e1", "A", 1.0, 1), ("e2", None, 1.0, 0), ("e3", "A", None, 0), ("e4", "A", 1.0, None)],
        "Enc_Id string, site string, cost double, label int",
    )
    out = ml.training_set(df, ["site", "cost"], keep=["Enc_Id"])
    assert out.columns == ["Enc_Id", "site", "cost", "label"]
    assert [r.Enc_Id for r in out.collect()] == ["e1"]


def test_feature_names():
    assert ml.feature_names(2)[-4:] == ["recent_0", "recent_1", "comorbidity_0", "comorbidity_1"]
    assert len(ml.feature_names(10)) == 28


def test_encoder_sizes_and_unknown_values(spark, rows):
    fitted = ml.encoder(NAMES).fit(rows)
    known = fitted.transform(rows).select("features").first().features
    assert known.size == 2 + 40 + 30 and known.numNonzeros() == 3
    unknown = spark.createDataFrame([("Z", -1.0, None)], "site string, cost double, code string")
    assert fitted.transform(unknown).first().features.numNonzeros() == 0


SMALL = {"encodings": {"cost": "ranges", "code": "hashed"}, "buckets": 4, "hash_size": 16}


def test_encodings_are_declared(rows):
    stages = ml.encoder(NAMES, **SMALL)
    size = stages.fit(rows).transform(rows).select("features").first().features.size
    # site exactly, cost in 4 ranges (one more for nan), code hashed
    assert size in (2 + 4 + 16, 2 + 5 + 16, 2 + 6 + 16)
    with pytest.raises(ValueError, match="unknown encodings"):
        ml.encoder(NAMES, {"cost": "other"})


@pytest.mark.parametrize("n", [1_000, 1_000_000])
def test_stages_do_not_depend_on_the_size(spark, n):
    wide = spark.range(n).select(
        F.col("id").cast("double").alias("COST"), (F.col("id") % 3).cast("string").alias("RACE")
    )
    fitted = ml.fit_encoder(wide, ml.encoder(["COST", "RACE"]))
    assert [type(s).__name__ for s in fitted.stages] == [
        "StringIndexerModel",
        "OneHotEncoderModel",
        "SQLTransformer",
        "Bucketizer",
        "OneHotEncoderModel",
        "VectorAssembler",
    ]


def test_too_many_exact_values_are_an_error(rows, monkeypatch):
    monkeypatch.setattr(ml, "MAX_VOCABULARY", 10)
    with pytest.raises(ValueError, match="cost has 40 values"):
        ml.fit_encoder(rows, ml.encoder(NAMES))


def test_encoded_features(rows):
    out = {r.Enc_Id: r for r in ml.encoded_features(rows, NAMES, ["Enc_Id"]).collect()}
    order = sorted({str(r.cost) for r in rows.collect()})
    for r in rows.collect():
        assert out[r.Enc_Id].site == "AB".index(r.site)
        assert out[r.Enc_Id].cost == order.index(str(r.cost))


def test_folds_are_stratified(rows):
    counts = ml.stratified_folds(rows, "label", "Enc_Id", 5).groupBy("label", "fold").count()
    for label in (0, 1):
        sizes = [r["count"] for r in counts.filter(F.col("label") == label).collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 6


def test_one_positive_row(spark):
    few = spark.range(40).select(
        F.col("id").cast("string").alias("Enc_Id"),
        (F.col("id") % 4).cast("string").alias("site"),
        (F.col("id") == 7).cast("int").alias("label"),
    )
    result = ml.tune(few, ["site"], ml.search_space(1), folds=5)
    assert result.trials[0]["loss"] == 0


def test_missing_and_unseen_values_are_scored(spark, rows, tmp_path):
    model, _ = ml.train(rows, NAMES, ml.search_space(1)[0], folds=1, **SMALL)
    models.save_model(model, str(tmp_path), "small")
    unseen = spark.createDataFrame(
        [("A", None, None), (None, 1e9, "zzz"), ("Z", float("nan"), "")],
        "site string, cost double, code string",
    )
    scores = ml.score(models.load_model(str(tmp_path), "small"), unseen, keep=["site"]).collect()
    assert len(scores) == 3 and all(0 <= r.risk_score <= 1 for r in scores)


def test_search_space_is_seeded_and_bounded():
    space = ml.search_space(32, seed=123)
    assert space == ml.search_space(32, seed=123) != ml.search_space(32, seed=1)
    for name, (low, high) in ml.SEARCH_BOUNDS.items():
        assert all(low <= p[name] <= high for p in space)


def test_params_to_lr():
    lr = ml.params_to_lr({"tol": -2.0, "C": math.log(0.5), "l1_ratio": -1.0}, rows=100)
    assert lr["regParam"] == pytest.approx(1 / 50)
    assert lr["tol"] == pytest.approx(math.exp(-2)) and lr["standardization"] is False
    assert lr["elasticNetParam"] == pytest.approx(math.exp(-1))


def test_train_finds_planted_effect(trained, rows):
    model, accuracy = trained
    assert 0.75 < accuracy < 0.9
    risk = ml.score(model, rows, keep=["site"]).groupBy("site").agg(F.avg("risk_score").alias("r"))
    mean = {r.site: r.r for r in risk.collect()}
    assert mean["A"] < 0.35 and mean["B"] > 0.65


def test_score(trained, rows, tmp_path):
    model, _ = trained
    scores = ml.score(model, rows, keep=["Enc_Id"])
    assert scores.columns == ["Enc_Id", "risk_score"]
    values = {r.Enc_Id: r.risk_score for r in scores.collect()}
    assert len(values) == 1200 and all(0 <= v <= 1 for v in values.values())
    assert ml.score(model, rows, limit=7, keep=["Enc_Id"]).count() == 7
    path = models.save_model(model, str(tmp_path), "planted", 2)
    assert path.endswith("planted/v2")
    again = ml.score(models.load_model(str(tmp_path), "planted", 2), rows, keep=["Enc_Id"])
    assert {r.Enc_Id: r.risk_score for r in again.collect()} == values


def test_scoring_stays_in_the_jvm(trained, rows):
    plan = ml.score(trained[0], rows, keep=["Enc_Id"])._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString()


def test_tune(spark, rows):
    result = ml.tune(rows, NAMES, ml.search_space(2), folds=2)
    assert len(result.trials) == 2
    assert all(-1 <= t["loss"] < -0.7 for t in result.trials)
    best = min(result.trials, key=lambda t: t["loss"])
    assert result.best == {k: best[k] for k in ("tol", "C", "l1_ratio")}
    assert result.to_frame(spark).columns == ["trial", "tol", "C", "l1_ratio", "loss"]


def test_no_rows(rows):
    with pytest.raises(ValueError, match="no training rows"):
        ml.train(rows.filter(F.lit(False)), NAMES, ml.search_space(1)[0])


def test_log_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    models.log_run(spark, path, "tuning", {"C": -1.0}, {"loss": -0.5})
    models.log_run(spark, path, "training", {"C": -1.0}, {"accuracy": 0.9}, "m/v1")
    runs = {r.run_name: r for r in spark.read.parquet(path).collect()}
    assert runs["tuning"].metrics == {"loss": -0.5} and runs["tuning"].model is None
    assert runs["training"].params == {"C": "-1.0"} and runs["training"].model == "m/v1"
    assert runs["training"].logged_at is not None


def test_the_encoded_training_set_is_balanced_once(spark, monkeypatch):
    """The numbers and the rows come from a stored table, not each from the balance again."""
    from verification import queries

    names = ml.feature_names(queries.CONFIG.num_conditions)
    features = spark.range(20).select(
        F.concat(F.lit("e"), "id").alias("Enc_Id"),
        *[(F.col("id") % 3).alias(c) for c in names],
        (F.col("id") < 5).cast("int").alias("label"),
    )
    monkeypatch.setattr(queries, "_stored_features", lambda *_: features)
    found = queries.encoded_features(spark, "")
    assert "md5" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = found.collect()
    assert len(rows) == 10 and {r.RACE for r in rows} == {0, 1, 2}
