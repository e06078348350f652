"""Numbers for the values of columns, kept in a table instead of on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohort_engine.session import scratch_dir

# Bits of monotonically_increasing_id that count rows inside a partition.
_ROW_BITS = 33


def value_numbers(df: DataFrame, columns: Sequence[str], path: str | None = None) -> DataFrame:
    """(column, value, number): the values of each column as text, numbered from 0 in order.

    Null has no number. The distinct values are range-partitioned and sorted, and a value's
    number is its place in its partition plus what the partitions before it hold. The driver
    sees none of them. The table is stored at ``path``, a folder for each column, by default
    in the scratch folder. Runs jobs.
    """
    spark = df.sparkSession
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in columns
        ]
    )
    values = (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    )
    folder = scratch_dir(spark, "values")
    values.repartitionByRange("column", "value").sortWithinPartitions("column", "value").select(
        "column", "value", F.monotonically_increasing_id().alias("at")
    ).write.parquet(folder)
    sorted_values = spark.read.parquet(folder).select(
        "column",
        "value",
        F.shiftright("at", _ROW_BITS).alias("part"),
        F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("place"),
    )
    # A row for each partition, and below one for each column.
    before = F.sum("rows").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sorted_values.groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("part", F.coalesce(before, F.lit(0)).alias("before"))
    )
    placed = sorted_values.join(F.broadcast(offsets), "part").select(
        "column", "value", (F.col("before") + F.col("place")).alias("place")
    )
    first = placed.groupBy(F.col("column").alias("of")).agg(F.min("place").alias("first"))
    numbered = placed.join(F.broadcast(first), F.col("column") == F.col("of")).select(
        "column", "value", (F.col("place") - F.col("first")).alias("number")
    )
    path = path or scratch_dir(spark, "dictionary")
    numbered.write.partitionBy("column").mode("overwrite").parquet(path)
    return read_numbers(spark, path)


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``value_numbers`` has stored."""
    return spark.read.schema("value string, number long, column string").parquet(path)


def numbered(
    df: DataFrame, numbers: DataFrame, columns: Sequence[str], suffix: str = "__number"
) -> DataFrame:
    """``df`` with the number of each column's value; null where there is none.

    A left join for each column with its part of the table. Spark broadcasts small parts,
    whose size it knows, as each has a folder; AQE splits hot values of the others.
    """
    for column in columns:
        name = f"{column}{suffix}"
        part = numbers.filter(F.col("column") == column).select(
            F.col("value").alias(f"{name}__value"), F.col("number").alias(name)
        )
        df = df.join(
            part, F.col(f"`{column}`").cast("string") == F.col(f"`{name}__value`"), "left"
        ).drop(f"{name}__value")
    return df


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns to number", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "of the new columns", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "folder of the table of values", TypeConverters.toString)

    def _put(self, **values):
        for name, value in values.items():
            if value is not None:
                self._set(**{name: value})
        return self


class DictionaryEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the values of columns by a stored table; see ``value_numbers``."""

    def __init__(self, columns=None, suffix="__number", path=None):
        super().__init__()
        self._put(columns=columns, suffix=suffix, path=path)

    def _fit(self, dataset: DataFrame) -> DictionaryModel:
        spark = dataset.sparkSession
        path = self.getOrDefault("path") if self.isSet("path") else scratch_dir(spark, "dictionary")
        columns = self.getOrDefault("columns")
        value_numbers(dataset, columns, path)
        return DictionaryModel(columns, self.getOrDefault("suffix"), path)


class DictionaryModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the numbers as doubles; a value that the table lacks is as far as possible."""

    # Not a category of any encoder: it has a class of its own, or gives all zeros.
    UNKNOWN = float(2**31 - 1)

    def __init__(self, columns=None, suffix="__number", path=None):
        super().__init__()
        self._put(columns=columns, suffix=suffix, path=path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, suffix = self.getOrDefault("columns"), self.getOrDefault("suffix")
        table = read_numbers(dataset.sparkSession, self.getOrDefault("path"))
        out = numbered(dataset, table, columns, suffix)
        return out.withColumns(
            {
                f"{c}{suffix}": F.coalesce(
                    F.col(f"`{c}{suffix}`").cast("double"), F.lit(self.UNKNOWN)
                )
                for c in columns
            }
        )

    def copy_table(self, spark: SparkSession, path: str) -> None:
        """Store the table at ``path`` as well, and use that one from now on."""
        table = read_numbers(spark, self.getOrDefault("path"))
        table.write.partitionBy("column").mode("overwrite").parquet(path)
        self._put(path=path)
