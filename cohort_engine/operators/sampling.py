"""Exact, reproducible "n rows of the table" without sorting the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_engine.functions.hashing import hash_order

# Hex digits of a hash that one histogram tells apart: at most 65,536 buckets.
DIGITS = 4
# Histograms, one inside the bucket that the one before has chosen. What is left after
# them is ranked: of n keys about n / 16 ** (DIGITS * LEVELS).
LEVELS = 2
_BELOW_ALL, _ABOVE_ALL = "", "g"


def hash_cutoff(
    df: DataFrame,
    keys: str | Sequence[str],
    n: Column | int | None = None,
    seed: str | int | None = None,
    among: Column | None = None,
    stored: bool = False,
) -> Column:
    """Largest md5 among the ``n`` smallest of the rows ``among``, as a scalar subquery.

    Without ``n`` as many as there are rows for which ``among`` is false.

    ``df`` is read once: one map-side-combined aggregation counts the rows of each hash,
    those among and the others. All that follows reads its result (Spark reuses the
    exchange): a histogram by the first digits of the hash tells which bucket holds the n-th
    row, the next one does the same inside that bucket, and the hashes of the last bucket
    are ranked. No window sees more than the buckets of a histogram or the hashes of the
    last bucket.

    With ``stored``, ``df`` is a table of files of which it is cheaper to read the key columns
    twice than to shuffle the hash of each row: the first pass makes the first histogram, the
    second one counts the hashes inside the bucket it has chosen.
    """
    among = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    counted = df.select(hash_order(keys, seed).alias("h"), among.alias("among"))
    counts = F.count_if("among").alias("rows"), F.count_if(~F.col("among")).alias("others")
    hashed, counted = counted, counted.groupBy((_digits(1) if stored else F.col("h")).alias("h"))
    counted = counted.agg(*counts)
    # True for every row: it keeps both counts in all that reads them, so that these read
    # the same exchange.
    counted = counted.filter(F.col("rows") + F.col("others") > 0)
    if n is None:
        both = counted.groupBy().sum("rows", "others")
        n = both.select(F.coalesce(F.col("sum(others)"), F.lit(0)).alias("others")).scalar()
    n = F.lit(n) if isinstance(n, int) else n
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    inside = counted.select("h", "rows", F.lit(0).cast("long").alias("before"))
    for level in range(LEVELS):
        bucket = _digits(level + 1)
        edge = (
            inside.groupBy(bucket.alias("bucket"), "before")
            .sum("rows")
            .withColumnRenamed("sum(rows)", "rows")
            .withColumn("upto", F.col("before") + F.sum("rows").over(running))
            .filter(F.col("upto") >= n)
            .agg(F.min(F.struct("bucket", "rows", "upto")).alias("e"))
            .select(
                F.col("e.bucket").alias("bucket"),
                (F.col("e.upto") - F.col("e.rows")).alias("before"),
            )
        )
        # An aggregate without keys: one row.
        edge = F.broadcast(edge)
        if stored and level == 0:
            chosen = hashed.join(edge, bucket == F.col("bucket")).groupBy("h", "before")
            counted = inside = chosen.agg(counts[0])
        else:
            inside = counted.drop("before").join(edge, bucket == F.col("bucket"))
            inside = inside.select("h", "rows", "before")
    by_hash = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    return (
        inside.withColumn("upto", F.col("before") + F.sum("rows").over(by_hash))
        .filter(F.col("upto") - F.col("rows") < n)
        .agg(F.max("h").alias("h"))
        .select(
            F.coalesce(
                "h", F.when(n <= 0, F.lit(_BELOW_ALL)).otherwise(F.lit(_ABOVE_ALL))
            ).alias("cutoff")
        )
        .scalar()
    )


def _digits(levels: int) -> Column:
    return F.substring("h", 1, DIGITS * levels)


def take_by_hash(
    df: DataFrame, keys: str | Sequence[str], n: Column | int, seed: str | int | None = None
) -> DataFrame:
    """The ``n`` rows of ``df`` which come first in ``hash_order``, or all if fewer.

    The rows themselves are only filtered, never shuffled, sorted or sent to one
    task. ``keys`` must identify a row; rows that share all keys stay together, so
    the result may then exceed ``n`` by the copies of the last key.
    """
    n = F.lit(n) if isinstance(n, int) else n
    return df.filter(hash_order(keys, seed) <= hash_cutoff(df, keys, n, seed))


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery, to be used inside another plan."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()
