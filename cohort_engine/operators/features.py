"""Encounter features, look-back counts, look-ahead label, class balance."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_engine.config import RiskConfig
from cohort_engine.functions.hashing import hash_order
from cohort_engine.functions.text import contains_text
from cohort_engine.operators.cohorts import CONDITION
from cohort_engine.operators.sampling import hash_cutoff


# Days of a patient's rows that meet their history together.
STRETCH = 4096


def add_comorbidities(
    df: DataFrame, conditions: Sequence[str], literal: bool = False
) -> DataFrame:
    """0/1 flag ``comorbidity_i`` per condition: does the encounter mention it?

    Case-sensitive substring test, so "X" also flags "X with complications".
    """
    return df.withColumns(
        {
            f"comorbidity_{i}": F.coalesce(
                contains_text(CONDITION, c, literal).cast("int"), F.lit(0)
            )
            for i, c in enumerate(conditions)
        }
    )


def add_day_and_age(df: DataFrame) -> DataFrame:
    """EARLIEST_TIME of the data set, ``day`` since then, ``patient_age`` in days.

    Encounters without START_TIME do not take part in the minimum; their day is null.
    """
    return _dated(df, _earliest(df))


def add_calendar(df: DataFrame) -> DataFrame:
    """START_YEAR and START_MONTH; ZIP as text."""
    return df.withColumns(
        {
            "START_YEAR": F.year("START_TIME"),
            "START_MONTH": F.month("START_TIME"),
            "ZIP": F.col("ZIP").cast("string"),
        }
    )


def add_recent(df: DataFrame, n: int, num_days: int = 90) -> DataFrame:
    """``recent_i``: how often condition i (of ``n``) was met on the ``num_days``
    days before the encounter's day, same day excluded."""
    return _attach_history(df, _recent(n, num_days))


def add_label(
    df: DataFrame,
    num_days_future: int = 10,
    target: str = "comorbidity_0",
    exclude_current: bool = False,
) -> DataFrame:
    """``label``: 1 if ``target`` is met from the encounter's day up to
    ``num_days_future`` days later.

    The encounter's own day counts unless ``exclude_current``; then the window
    starts on the next day and the target flag of the row does not leak into it.
    """
    return _attach_history(df, _label(num_days_future, target, exclude_current))


def add_history(
    df: DataFrame,
    n: int,
    num_days: int = 90,
    num_days_future: int = 10,
    target: str = "comorbidity_0",
    exclude_current: bool = False,
) -> DataFrame:
    """``add_recent`` and ``add_label`` with a single shuffle of the encounters."""
    return _attach_history(
        df, {**_recent(n, num_days), **_label(num_days_future, target, exclude_current)}
    )


def build(
    df: DataFrame,
    conditions: Sequence[str],
    config: RiskConfig | None = None,
    target: str = "comorbidity_0",
    exclude_current: bool = False,
    literal: bool = False,
) -> DataFrame:
    """All features and the label for the encounters of a cohort.

    There are as many flags as conditions. ``literal`` takes their names as plain text,
    as names found in data are.
    """
    config = config or RiskConfig()
    conditions = list(conditions)
    if not conditions:
        raise ValueError("no comorbid conditions: nobody has the condition of interest")
    if target == "comorbidity_0" and config.condition.lower() not in conditions[0].lower():
        warnings.warn(
            f"the label is made from {conditions[0]!r}, which does not mention"
            f" {config.condition!r}; pass another target if that is not meant",
            stacklevel=2,
        )
    columns = {
        **_recent(len(conditions), config.num_days),
        **_label(config.num_days_future, target, exclude_current),
    }
    df = df.drop(*columns)
    earliest = _earliest(df)

    def with_features(rows):
        return add_calendar(_dated(add_comorbidities(rows, conditions, literal), earliest))

    # The rows are shuffled to their history as they are and with their day, the key; what
    # else follows from a row alone is made again afterwards.
    featured = with_features(df)
    timed = df.withColumn("day", F.datediff("START_TIME", earliest))
    joined = _join_history(timed, _history(featured, columns), columns)
    rows = with_features(joined.withColumnRenamed("day", "joined_day"))
    return rows.withColumn("day", F.col("joined_day")).select(*featured.columns, *columns)


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def balance(
    df: DataFrame,
    label: str = "label",
    key: str | Sequence[str] = "Enc_Id",
    mode: str = "exact",
    seed: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """All rows of label 1 and as many rows of label 0.

    ``exact`` picks label-0 rows by md5 of ``key``, which must identify a row; the
    rows are filtered against one scalar cutoff and never shuffled; ``df`` is read once
    for the cutoff and once for the rows. With ``stored``, label and key are read once more
    and the hashes of the rows are not shuffled (see ``hash_cutoff``). ``fraction``
    draws each label-0 row with the matching probability, after one job that counts
    the labels. Call either on stored features, since both read them again.
    """
    is_one, is_zero = F.col(label) == 1, F.col(label) == 0
    if mode == "exact":
        rows = df.filter(is_one | is_zero)
        cutoff = hash_cutoff(rows, key, seed=seed, among=is_zero, stored=stored)
        return df.filter(is_one | (is_zero & (hash_order(key, seed) <= cutoff)))
    if mode == "fraction":
        counted = df.agg(F.count_if(is_zero).alias("zeros"), F.count_if(is_one).alias("ones"))
        zeros, ones = counted.first()
        rate = min(1.0, ones / zeros) if zeros else 0.0
        return df.sampleBy(label, {0: rate, 1: 1.0}, seed)
    raise ValueError(f"mode must be 'exact' or 'fraction', not {mode!r}")


def _earliest(df: DataFrame) -> Column:
    return df.agg(F.min("START_TIME").alias("earliest")).scalar()


def _dated(df: DataFrame, earliest: Column) -> DataFrame:
    return df.withColumn("EARLIEST_TIME", earliest).withColumns(
        {
            "day": F.datediff("START_TIME", "EARLIEST_TIME"),
            "patient_age": F.datediff("START_TIME", "BIRTHDATE"),
        }
    )


def _recent(n, num_days):
    return {
        f"recent_{i}": (F.sum, f"comorbidity_{i}", (-num_days, -1)) for i in range(n)
    }


def _label(num_days_future, target, exclude_current):
    return {"label": (F.max, target, (1 if exclude_current else 0, num_days_future))}


def _attach_history(df: DataFrame, columns: dict) -> DataFrame:
    """Add moving aggregates over the days of each patient; no value gives 0.

    columns: name -> (aggregate, flag column, (first day, last day) of the window)
    """
    df = df.drop(*columns)  # as withColumn would replace them
    return _join_history(df, _history(df, columns), columns)


def _history(df: DataFrame, columns: dict) -> DataFrame:
    """(history_patient, history_day, moving aggregates) for days on which any is positive.

    The window runs over one row per patient and day, which partial aggregation
    makes of the encounters before they are shuffled. A patient is thus at most as
    long as the calendar, however many encounters fall on it.
    """
    daily = df.groupBy("PATIENT", "day").agg(
        *[
            aggregate(flag).alias(name) for name, (aggregate, flag, _) in columns.items()
        ]
    )
    by_day = Window.partitionBy("PATIENT").orderBy("day")
    return daily.select(
        F.col("PATIENT").alias("history_patient"),
        F.col("day").alias("history_day"),
        *[
            aggregate(name).over(by_day.rangeBetween(*frame)).alias(name)
            for name, (aggregate, _, frame) in columns.items()
        ],
    ).filter(_any_positive(columns))


def _join_history(df: DataFrame, moving: DataFrame, columns: dict) -> DataFrame:
    """Encounters with the history of their patient and day.

    The history of a patient's ``STRETCH`` days is one row, a map by day, so that rows of a
    patient stay together on their way: what they share takes few bytes of a compressed
    shuffle. AQE splits a hot patient's rows, and a map has at most ``STRETCH`` days.
    """
    day = F.col("history_day")
    stretches = moving.groupBy("history_patient", _stretch(day).alias("history_stretch")).agg(
        F.map_from_entries(
            F.collect_list(F.struct(_place(day), F.struct(*columns).alias("moving")))
        ).alias("history")
    )
    found = F.try_element_at("history", _place(F.col("day")))
    return df.join(
        stretches,
        F.col("PATIENT").eqNullSafe(F.col("history_patient"))
        & _stretch(F.col("day")).eqNullSafe(F.col("history_stretch")),
        "left",
    ).select(
        *[F.col(c) for c in df.columns],
        *[F.coalesce(found[name], F.lit(0)).alias(name) for name in columns],
    )


def _stretch(day: Column) -> Column:
    return F.floor(day / STRETCH)


def _place(day: Column) -> Column:
    """A day's number in its stretch; rows without a day have a stretch of their own."""
    return F.coalesce(F.pmod(day, F.lit(STRETCH)).cast("int"), F.lit(0)).alias("place")


def _any_positive(names) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(F.col(c), F.lit(0)) > 0 for c in names))
