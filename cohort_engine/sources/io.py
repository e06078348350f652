"""Files in, tables out."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.sources.schemas import RAW_TYPES

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def discover_tables(spark: SparkSession, path: str) -> dict[str, str]:
    """Table name -> path for the entries of a folder, without README.txt.

    An entry is a file ``name.csv`` or a folder ``name.csv`` of part files. Runs one
    listing job: file contents are not read, and the driver gets one row per entry.
    """
    root = path.rstrip("/")
    below = re.sub(SCHEME, "", root) + "/"
    inside = F.regexp_replace("path", SCHEME, "")
    entry = F.substring_index(
        F.substr(inside, F.instr(inside, below) + F.lit(len(below))), "/", 1
    )
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(entry.alias("entry"))
        .distinct()
        .filter(F.col("entry") != "README.txt")
        .collect()
    )
    tables = {}
    for name in sorted(row.entry for row in found):
        table = name.replace(".csv", "")
        if table in tables:
            raise ValueError(f"two entries for table {table} below {path}")
        tables[table] = f"{root}/{name}"
    return tables


def read_tables(
    spark: SparkSession,
    path: str,
    types: Mapping[str, Mapping[str, str]] | None = None,
    infer_schema: bool = False,
    rescue: str | None = None,
) -> dict[str, DataFrame]:
    """One DataFrame per CSV table of a folder, columns by header name.

    Declared columns are cast by name, a value that does not parse becomes null (see
    ``unparsed_values``), and all others stay text; that keeps leading zeros of codes.
    ``rescue`` names a column to add: a map from column to text with the values of the row
    that do not parse, null if all do, so that nothing of the files is lost.
    ``infer_schema`` lets Spark guess all types instead, at the cost of reading every
    file once more. Part files of a table must have the same header; reading one with
    another fails.
    """
    types = RAW_TYPES if types is None else types
    tables = {}
    for name, df in _raw_tables(spark, path, infer_schema).items():
        declared = {} if infer_schema else types.get(name, {})
        declared = {c: t for c, t in declared.items() if c in df.columns}
        if rescue is not None:
            if rescue in df.columns:
                raise ValueError(f"table {name} has a column {rescue} already")
            df = df.withColumn(rescue, _rescued(declared))
        tables[name] = df.withColumns({c: F.col(quoted(c)).try_cast(t) for c, t in declared.items()})
    return tables


def _lost(column: str, kind: str) -> Column:
    """Whether a value of a text column does not parse."""
    value = F.col(quoted(column))
    return value.isNotNull() & value.try_cast(kind).isNull()


def _rescued(declared: Mapping[str, str]) -> Column:
    found = F.filter(
        F.array(
            *[
                F.struct(F.lit(c).alias("key"), F.when(_lost(c, t), F.col(quoted(c))).alias("value"))
                for c, t in declared.items()
            ]
        ),
        lambda e: e["value"].isNotNull(),
    )
    if not declared:
        return F.lit(None).cast("map<string,string>")
    return F.when(F.size(found) > 0, F.map_from_entries(found))


def _raw_tables(spark, path, infer_schema=False):
    return {
        name: spark.read.csv(
            location, header=True, inferSchema=infer_schema, enforceSchema=False
        )
        for name, location in discover_tables(spark, path).items()
    }


def unparsed_values(
    spark: SparkSession, path: str, types: Mapping[str, Mapping[str, str]] | None = None
) -> DataFrame:
    """(table, column, values): how many values ``read_tables`` turns into null.

    A row for each declared column that has any; each table is aggregated once.
    """
    types = RAW_TYPES if types is None else types
    counts = []
    for name, df in _raw_tables(spark, path).items():
        declared = {c: t for c, t in types.get(name, {}).items() if c in df.columns}
        if declared:
            lost = [
                F.struct(
                    F.lit(c).alias("column"),
                    F.count_if(_lost(c, t)).alias("values"),
                )
                for c, t in declared.items()
            ]
            counts.append(
                df.agg(F.array(*lost).alias("lost"))
                .select(F.lit(name).alias("table"), F.explode("lost").alias("lost"))
                .select("table", "lost.*")
            )
    if not counts:
        return spark.createDataFrame([], "table string, column string, values long")
    return reduce(DataFrame.unionByName, counts).filter(F.col("values") > 0)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows), counted by one job for all tables."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in tables.items()
        ],
    )


def load(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read a path; without ``fmt`` in the session's default format."""
    return spark.read.load(path, format=fmt)


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] | None = None,
    compression: str | None = None,
) -> None:
    """Write to a path; by default fail if something is there."""
    options = {} if compression is None else {"compression": compression}
    df.write.save(
        path, format=fmt, mode=mode, partitionBy=list(partition_by or []) or None, **options
    )


def save_compact(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite an intermediate table, which is read a few times and then dropped. Ids in
    text take about half the bytes in zstd that they do in a format's default."""
    save(df, path, fmt, "overwrite", compression=compact_codec(fmt))


def compact_codec(fmt: str) -> str | None:
    """The codec that makes a format's files small; None for the format's default."""
    return "zstd" if fmt in ("parquet", "orc") else None


def save_features(
    df: DataFrame, path: str, tags: Mapping[str, str], fmt: str = "parquet"
) -> None:
    """Overwrite a feature table; every row carries ``tags``, such as run ids."""
    save(df.withColumns({k: F.lit(v) for k, v in tags.items()}), path, fmt, "overwrite")


def register_external(
    spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet"
) -> DataFrame:
    """Make the files at ``path`` known as table ``db.name``, unless it exists."""
    table = f"{db}.{name}"
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source=fmt)
    return spark.table(table)


def drop_table(spark: SparkSession, db: str, name: str) -> None:
    """Forget a table. Files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(db)}.{quoted(name)}")


def quoted(name: str) -> str:
    """``name`` as SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """``text`` as SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
