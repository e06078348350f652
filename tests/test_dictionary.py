import pytest
from pyspark.sql import functions as F

from cohort_engine.operators import dictionary, ml
from cohort_engine.sources import models


@pytest.fixture(scope="module")
def rows(spark):
    """Two thirds of the rows have the same code; the others have one of 3,000."""
    draw = F.abs(F.hash("id", F.lit(9))) % 100
    return (
        spark.range(9_000)
        .select(
            F.col("id").cast("string").alias("Enc_Id"),
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("a code"),
            F.when(F.col("id") % 50 > 0, F.col("id") % 20 / 4).alias("number"),
            (draw < F.when(F.col("id") % 3 > 0, 20).otherwise(80)).cast("int").alias("label"),
        )
        .cache()
    )


def test_numbers_are_dense_and_in_order(spark, rows):
    table = dictionary.value_numbers(rows, ["a code", "number"])
    for column in ("a code", "number"):
        found = table.filter(F.col("column") == column).orderBy("number").collect()
        values = sorted({str(r[0]) for r in rows.select(column).collect() if r[0] is not None})
        assert [r.value for r in found] == values
        assert [r.number for r in found] == list(range(len(values)))


def test_numbers_are_joined(spark, rows):
    table = dictionary.value_numbers(rows, ["a code", "number"])
    numbers = {(r["column"], r.value): r.number for r in table.collect()}
    out = dictionary.numbered(rows, table, ["a code", "number"])
    assert out.columns == [*rows.columns, "a code__number", "number__number"]
    for r in out.collect():
        assert r["a code__number"] == numbers["a code", r["a code"]]
        assert r["number__number"] == numbers.get(("number", str(r["number"])))
    other = spark.createDataFrame([("nobody",), (None,)], "`a code` string")
    assert {r[1] for r in dictionary.numbered(other, table, ["a code"]).collect()} == {None}


def test_empty_table(rows):
    assert dictionary.value_numbers(rows.limit(0), ["number"]).count() == 0


def test_more_values_than_fit_on_the_driver(rows, monkeypatch):
    """Exact features are counted, not collected; a dictionary takes any number."""
    monkeypatch.setattr(ml, "MAX_VOCABULARY", 1_000)
    fitted = []
    monkeypatch.setattr(ml.Pipeline, "fit", lambda *a: fitted.append(a))
    with pytest.raises(ValueError, match="a code has 3001 values"):
        ml.fit_encoder(rows, ml.encoder(["a code", "number"]))
    assert not fitted
    monkeypatch.undo()
    monkeypatch.setattr(ml, "MAX_VOCABULARY", 1_000)
    model = ml.fit_encoder(rows, ml.encoder(["a code", "number"], {"a code": "dictionary"}))
    vector = model.transform(rows).select("features").first().features
    # One more class for unknown codes.
    assert vector.size == 3_001 + 1 + 20 and vector.numNonzeros() >= 1
    encoded = ml.encoded_features(rows, ["a code"], ["Enc_Id"]).agg(F.max("a code"))
    assert encoded.first()[0] == 3_000


def test_a_model_with_a_dictionary_is_stored_and_scores(spark, rows, tmp_path):
    params = {"tol": -6.0, "C": 0.0, "l1_ratio": -3.0}
    names = ["a code", "number"]
    filled = rows.na.drop()
    model, accuracy = ml.train(filled, names, params, folds=2, encodings={"a code": "dictionary"})
    exact, same = ml.train(filled, names, params, folds=2, encodings={})
    assert abs(accuracy - same) < 0.01 and accuracy > 0.7
    models.save_model(model, str(tmp_path), "listed")
    loaded = models.load_model(str(tmp_path), "listed")
    unseen = spark.createDataFrame(
        [("u", "nobody", 1.0), ("h", "hot", 1.0)], "Enc_Id string, `a code` string, number double"
    )
    table = filled.select("Enc_Id", "a code", "number").limit(200).union(unseen)
    got = {r.Enc_Id: r.risk_score for r in ml.score(loaded, table, keep=["Enc_Id"]).collect()}
    want = {r.Enc_Id: r.risk_score for r in ml.score(exact, table, keep=["Enc_Id"]).collect()}
    assert got.keys() == want.keys() and len(got) == 202
    assert max(abs(got[i] - want[i]) for i in got) < 0.02
