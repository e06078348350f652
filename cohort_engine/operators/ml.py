"""Risk model: encoding, tuning, training and scoring as Spark ML jobs."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    FeatureHasher,
    OneHotEncoder,
    QuantileDiscretizer,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_engine.functions.hashing import hash_order
from cohort_engine.operators.dictionary import DictionaryEncoder, numbered, value_numbers
from cohort_engine.operators.sampling import take_by_hash
from cohort_engine.operators.sweep import Setting, Sweep
from cohort_engine.sources.io import quoted

# Feature columns besides the numbered ones.
ENCOUNTER_FEATURES = ("ENCOUNTERCLASS", "COST", "PROVIDER_ZIP", "START_YEAR")
PATIENT_FEATURES = ("RACE", "GENDER", "ZIP", "patient_age")

# How features are encoded unless the caller says otherwise; all others are exact.
ENCODINGS = {"COST": "ranges", "patient_age": "ranges"}

_KINDS = ("exact", "dictionary", "ranges", "hashed")

# An exact feature with more values than this is an error: they all live on the driver.
MAX_VOCABULARY = 1_000_000

# Bounds of the search, as logarithms of the parameters.
SEARCH_BOUNDS = {"tol": (-3.0, 0.0), "C": (-2.0, 0.0), "l1_ratio": (-3.0, -1.0)}


def feature_names(num_conditions: int) -> list[str]:
    return [
        *ENCOUNTER_FEATURES,
        *PATIENT_FEATURES,
        *[f"recent_{i}" for i in range(num_conditions)],
        *[f"comorbidity_{i}" for i in range(num_conditions)],
    ]


def training_set(
    df: DataFrame, features: Sequence[str], label: str = "label", keep: Sequence[str] = ()
) -> DataFrame:
    """Features and label of the rows in which none of them is null."""
    columns = [*features, label]
    return df.select(*keep, *columns).na.drop(subset=columns)


def encoder(
    features: Sequence[str],
    encodings: Mapping[str, str] | None = None,
    buckets: int = 256,
    hash_size: int = 1 << 18,
) -> Pipeline:
    """Unfitted stages which one-hot encode every feature, numbers included.

    ``encodings`` (default ``ENCODINGS``) says how; the number of rows or values never
    does:

    exact       a slot for each value; the values are brought to the driver
    dictionary  a slot for each value; the values stay in a table and are joined
    ranges      numbers in ``buckets`` quantile ranges
    hashed      values hashed to ``hash_size`` slots

    Features without an entry are exact. A value unknown at fitting time gives all zeros.
    """
    encodings = ENCODINGS if encodings is None else encodings
    kinds = {c: encodings.get(c, "exact") for c in features}
    if unknown := sorted(set(kinds.values()) - set(_KINDS)):
        raise ValueError(f"unknown encodings {unknown}")
    exact, listed, ranged, hashed = (
        [c for c in features if kinds[c] == kind] for kind in _KINDS
    )

    def named(columns, suffix):
        return [f"{c}__{suffix}" for c in columns]

    stages, parts = [], []
    if exact:
        # 'keep' adds a class for unknown values; dropLast drops just that one.
        stages += [
            StringIndexer(
                inputCols=exact,
                outputCols=named(exact, "index"),
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=named(exact, "index"), outputCols=named(exact, "onehot"), dropLast=True
            ),
        ]
        parts += named(exact, "onehot")
    if listed:
        stages += [
            DictionaryEncoder(columns=listed, suffix="__listed"),
            OneHotEncoder(
                inputCols=named(listed, "listed"),
                outputCols=named(listed, "onehot"),
                dropLast=False,
                handleInvalid="keep",
            ),
        ]
        parts += named(listed, "onehot")
    if ranged:
        # A missing number has a class of its own, as nan; null would stop the encoder.
        numbers = ", ".join(
            f"coalesce(CAST({quoted(c)} AS DOUBLE), double('NaN')) AS {quoted(f'{c}__number')}"
            for c in ranged
        )
        stages += [
            SQLTransformer(statement=f"SELECT *, {numbers} FROM __THIS__"),
            QuantileDiscretizer(
                inputCols=named(ranged, "number"),
                outputCols=named(ranged, "range"),
                numBuckets=buckets,
                handleInvalid="keep",
            ),
            OneHotEncoder(
                inputCols=named(ranged, "range"),
                outputCols=named(ranged, "onehot"),
                dropLast=False,
                handleInvalid="keep",
            ),
        ]
        parts += named(ranged, "onehot")
    if hashed:
        stages.append(
            FeatureHasher(
                inputCols=hashed,
                outputCol="hashed__onehot",
                numFeatures=hash_size,
                categoricalCols=hashed,
            )
        )
        parts.append("hashed__onehot")
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")])


def fit_encoder(df: DataFrame, stages: Pipeline) -> PipelineModel:
    """The fitted stages.

    Raises if an exact feature has too many values, which are counted before any of them is
    brought to the driver.
    """
    for stage in stages.getStages():
        if isinstance(stage, StringIndexer):
            _check_vocabulary(df, stage.getInputCols())
    return stages.fit(df)


def _check_vocabulary(df: DataFrame, columns: Sequence[str]) -> None:
    estimates = df.agg(*[F.approx_count_distinct(quoted(c)).alias(c) for c in columns]).first()
    # Those that may have too many are counted exactly.
    many = [c for c in columns if estimates[c] > MAX_VOCABULARY / 2]
    if not many:
        return
    pairs = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string")) for c in many]
    found = (
        df.select(F.inline(F.array(*pairs))).na.drop().distinct().groupBy("column").count()
    )
    counts = {row["column"]: row["count"] for row in found.collect()}
    for name in many:
        if counts.get(name, 0) > MAX_VOCABULARY:
            raise ValueError(
                f"{name} has {counts[name]} values; declare it as dictionary, ranges or hashed"
            )


def encoded_features(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and for each feature the number of its value, from 0; null for null.

    The numbers are joined from a stored table (see ``dictionary``), so that there may be any
    number of values. Runs the jobs that store it.
    """
    numbers = value_numbers(df, features)
    out = numbered(df.select(*keep, *features), numbers, features)
    return out.select(*keep, *[F.col(quoted(f"{c}__number")).cast("int").alias(c) for c in features])


def params_to_lr(params: dict[str, float], rows: int) -> dict:
    """Search parameters (logarithms) -> arguments of ``LogisticRegression``.

    C weighs the summed loss against the penalty, Spark's regParam the penalty
    against the mean loss: regParam = 1 / (C * rows), for the rows that are fitted.
    """
    return {
        "family": "binomial",
        "tol": math.exp(params["tol"]),
        "regParam": 1.0 / (math.exp(params["C"]) * max(rows, 1)),
        "elasticNetParam": math.exp(params["l1_ratio"]),
        "standardization": False,
    }


def search_space(n_evals: int = 32, seed: int = 123) -> list[dict[str, float]]:
    """Seeded uniform draws within ``SEARCH_BOUNDS``."""
    draw = random.Random(seed)
    return [
        {name: draw.uniform(*bounds) for name, bounds in SEARCH_BOUNDS.items()}
        for _ in range(n_evals)
    ]


@dataclass(frozen=True)
class TuneResult:
    """``trials``: the tried parameters with their loss and the rows of the training
    set; ``best``: the parameters of the lowest loss."""

    trials: list[dict[str, float]]

    @property
    def best(self) -> dict[str, float]:
        trial = min(self.trials, key=lambda t: t["loss"])
        return {name: trial[name] for name in SEARCH_BOUNDS}

    def to_frame(self, spark) -> DataFrame:
        rows = [
            (i, t["tol"], t["C"], t["l1_ratio"], t["loss"]) for i, t in enumerate(self.trials)
        ]
        return spark.createDataFrame(
            rows, "trial int, tol double, C double, l1_ratio double, loss double"
        )


def stratified_folds(
    df: DataFrame, label: str, key: str | Sequence[str], folds: int
) -> DataFrame:
    """``df`` with a column ``fold``: each label is spread evenly over the folds.

    Rows are ordered by md5 of ``key``. The histogram of its first four digits, at most
    65,536 rows for each label, says which part of the order a digit group lies in; the
    table of groups is broadcast.
    """
    group = F.substring(hash_order(key), 1, 4).alias("group")
    of_label = Window.partitionBy("of").orderBy("group")
    before = F.coalesce(
        F.sum("rows").over(of_label.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    total = F.sum("rows").over(Window.partitionBy("of"))
    groups = (
        df.groupBy(F.col(label).alias("of"), group)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("of", "group", F.floor(before * folds / total).cast("int").alias("fold"))
    )
    return df.join(
        F.broadcast(groups),
        (F.col(label) == F.col("of")) & (F.substring(hash_order(key), 1, 4) == F.col("group")),
    ).drop("of", "group")


def f1_of_ones(hits: int, wrong: int, rows: int) -> float:
    """F1 of label 1; 0 if there is neither a label nor a prediction of 1."""
    return 2 * hits / (2 * hits + wrong) if hits or wrong else 0.0


def accuracy(hits: int, wrong: int, rows: int) -> float:
    """Share of predictions that equal the label."""
    return 1 - wrong / rows


class _Folds:
    """An encoded training set in stratified folds."""

    def __init__(self, df, stages, label, key, folds, partitions):
        split = stratified_folds(df, label, key, folds)
        self.rows = {r.fold: r["count"] for r in split.groupBy("fold").count().collect()}
        self.total = sum(self.rows.values())
        if self.total == 0:
            raise ValueError("no training rows: is any label 1?")
        self.folds, self.partitions = folds, partitions
        self.encoder = fit_encoder(df, stages)
        self.data = self.encoder.transform(split).select(
            "features", F.col(label).cast("double").alias("label"), "fold"
        )

    def fit(self, params):
        """Model of all rows."""
        return LogisticRegression(**params_to_lr(params, self.total)).fit(self.data)

    def scores(self, space, metric):
        """Per parameter setting the metric on each fold, by a model of the others."""
        settings = []
        for params in space:
            for fold, rows in sorted(self.rows.items()):
                lr = params_to_lr(params, self.total - rows)
                settings.append(Setting(fold, lr["regParam"], lr["elasticNetParam"], lr["tol"]))
        sweep = Sweep(self.data, self.partitions)
        try:
            counts = sweep.count(sweep.fit(settings, self.folds), settings)
        finally:
            sweep.close()
        found = [metric(*map(int, row)) for row in counts]
        each = len(self.rows)
        return [found[i : i + each] for i in range(0, len(found), each)]


def tune(
    df: DataFrame,
    features: Sequence[str],
    space: Sequence[dict[str, float]] | None = None,
    folds: int = 5,
    label: str = "label",
    key: str | Sequence[str] = "Enc_Id",
    partitions: int | None = None,
    **encoder_options,
) -> TuneResult:
    """Try parameter settings; the loss is minus the worst F1 of label 1 over folds.

    ``df`` should be a stored table; it is encoded once. All settings are fitted on all
    folds at the same time, with one job for each step (see ``sweep``). A step costs a task
    for each partition; ``partitions`` packs the encoded rows of a small training set into
    so many.
    """
    space = search_space() if space is None else list(space)
    split = _Folds(df, encoder(features, **encoder_options), label, key, folds, partitions)
    scores = split.scores(space, f1_of_ones)
    return TuneResult(
        [{**p, "loss": -min(row), "rows": split.total} for p, row in zip(space, scores)]
    )


def train(
    df: DataFrame,
    features: Sequence[str],
    params: dict[str, float],
    folds: int = 5,
    label: str = "label",
    key: str | Sequence[str] = "Enc_Id",
    partitions: int | None = None,
    **encoder_options,
) -> tuple[PipelineModel, float]:
    """(model of all rows, mean accuracy over ``folds``; nan without folds)."""
    stages = encoder(features, **encoder_options)
    split = _Folds(df, stages, label, key, max(folds, 1), partitions)
    scores = split.scores([params], accuracy)[0] if folds > 1 else [math.nan]
    model = PipelineModel([*split.encoder.stages, split.fit(params)])
    return model, sum(scores) / len(scores)


def score(
    model: PipelineModel,
    df: DataFrame,
    limit: int | None = None,
    keep: Sequence[str] = ("PATIENT", "Enc_Id", "START_TIME"),
    key: str | Sequence[str] = "Enc_Id",
) -> DataFrame:
    """``keep`` and ``risk_score``, the probability of label 1; stays in the JVM.

    ``limit`` scores that many rows only, chosen by md5 of ``key``.
    """
    if limit is not None:
        df = take_by_hash(df, key, limit)
    risk = vector_to_array(F.col("probability"))[1]
    return model.transform(df).select(*keep, risk.alias("risk_score"))
