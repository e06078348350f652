"""Clustered file layout: similar rows of several columns in the same files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.functions.zcurve import cuts_of, sortable, z_value
from cohort_engine.sources.io import compact_codec, save

# Ranges of a column at most, as a power of 2, and the size of a quantile sketch, whose
# ranks are then right to about a part in a thousand.
MAX_BITS = 14
SKETCH = 4096


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    files: int | None = None,
    bits: int | None = None,
    sample_rows: int = 20_000,
    file_bytes: int = 256 << 20,
    seed: int = 17,
) -> DataFrame:
    """A stored table with the same rows, range-partitioned and sorted along a Z-curve.

    ``df`` must read one table, since it is read several times and rows are told apart
    by the file they come from. Columns of the key may be of any ordered type. One column
    needs no curve: the table is range-partitioned by it.

    Every column is cut into 2**bits ranges of about equal row counts; by default
    there are some more cells than files. The cuts of numbers, dates and times come from
    mergeable quantile sketches of all rows, those of texts from about ``sample_rows``
    sampled rows (or four for each range), which are ranked in Spark. Only the cuts come to
    the driver, fewer than 2**MAX_BITS for each column; they affect which file a row lands
    in and nothing else. Runs a job for the sketches, one more for text columns.

    ``files`` is the number of files to aim at. Without it there is one for every
    ``file_bytes`` of the table; where that is less than the shuffle partitions, AQE
    merges small ones.
    """
    needed = files or math.ceil(table_bytes(df) / file_bytes)
    if files is None and needed > _partitions(df):
        files = needed
    types = {f.name: f.dataType for f in df.schema.fields}
    keys = [sortable(c, types[c]) for c in columns]
    if len(columns) == 1:
        z = keys[0]
    else:
        bits = bits or min(MAX_BITS, bits_for(max(needed, _partitions(df)), len(columns)))
        z = z_value(keys, _cuts(df, keys, bits, max(sample_rows, 4 << bits), seed), bits)
    ranged = df.withColumns({"z_value": z, "z_tie": _tie(df)})
    count = [] if files is None else [files]
    return (
        ranged.repartitionByRange(*count, "z_value", "z_tie")
        .sortWithinPartitions("z_value")
        .drop("z_value", "z_tie")
    )


def zorder_write(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    files: int | None = None,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    **options,
) -> None:
    """Write ``zorder(df, columns, files)``; ``path`` must not be what ``df`` reads."""
    save(zorder(df, columns, files, **options), path, fmt, mode, compression=compact_codec(fmt))


def _partitions(df):
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def table_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as the optimizer has them."""
    statistics = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(statistics.sizeInBytes()))


def bits_for(files: int, dimensions: int) -> int:
    """Bits of each column that give some more cells than files."""
    wanted = math.ceil(math.log2(max(files, 1)) / dimensions) + 1
    return max(2, min(62 // dimensions, wanted))


def files_to_read(df: DataFrame, column: str, low, high) -> DataFrame:
    """One row (files, to_read): the files of a stored table, and those among them whose
    least and greatest value of ``column`` leave room for a row between ``low`` and ``high``.

    A filter on the column has to read the latter.
    """
    by_file = df.groupBy(F.input_file_name().alias("file")).agg(
        F.min(column).alias("least"), F.max(column).alias("most")
    )
    meets = (F.col("least") <= F.lit(high)) & (F.col("most") >= F.lit(low))
    return by_file.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.coalesce(meets, F.lit(False))).alias("to_read")
    )


def _cuts(df, keys: Sequence[Column], bits, sample_rows, seed):
    """For each key its cut points (lower bound, rank)."""
    named = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    kinds = {f.name: "text" if f.dataType == T.StringType() else _number(f.dataType)
             for f in named.schema.fields}
    ranks = F.array(*[F.lit(r / 2**bits) for r in range(1, 2**bits)])
    found = [F.count(F.lit(1)).alias("rows")]
    for name, kind in kinds.items():
        if kind != "text":
            value = F.col(name).cast(kind)
            value = F.when(~F.isnan(value), value) if kind == "double" else value
            found.append(_sketch(kind)(value, SKETCH).alias(name))
    row = named.agg(*found).select(
        "rows",
        *[
            F.when(_size(kind)(name) > 0, _quantile(kind)(name, ranks)).alias(name)
            for name, kind in kinds.items()
            if kind != "text"
        ],
    ).first()
    bounds = row.asDict()
    if "text" in kinds.values():
        bounds |= _text_bounds(named, [n for n, k in kinds.items() if k == "text"], bits,
                               min(1.0, sample_rows / max(row["rows"], 1)), seed)
    return [
        bounds[name] if kind == "text" else cuts_of(bounds[name] or [])
        for name, kind in kinds.items()
    ]


def _number(kind: T.DataType) -> str:
    return "double" if isinstance(kind, (T.DoubleType, T.FloatType)) else "bigint"


def _sketch(kind):
    return F.kll_sketch_agg_double if kind == "double" else F.kll_sketch_agg_bigint


def _size(kind):
    return F.kll_sketch_get_n_double if kind == "double" else F.kll_sketch_get_n_bigint


def _quantile(kind):
    return F.kll_sketch_get_quantile_double if kind == "double" else F.kll_sketch_get_quantile_bigint


def _text_bounds(named, names, bits, fraction, seed) -> dict[str, list[tuple[str, int]]]:
    """Cut points of text columns, by ranking a bounded sample."""
    long = named.sample(fraction=fraction, seed=seed).select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
        ).alias("pair")
    ).select("pair.*").filter("value IS NOT NULL")
    by_name = Window.partitionBy("name")
    place = F.row_number().over(by_name.orderBy("value")) - 1
    rows = F.count(F.lit(1)).over(by_name)
    ranged = long.withColumns({"place": place, "rows": rows})
    rank = F.floor(F.col("place") * 2**bits / F.col("rows"))
    # The first value whose place is not below rank * rows / 2**bits.
    cuts = (
        ranged.groupBy("name", rank.alias("rank"))
        .agg(F.min("value").alias("value"))
        .filter("rank > 0")
        .groupBy("name")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("cuts"))
    )
    out: dict[str, list] = {n: [] for n in names}
    for row in cuts.collect():
        # Of a value that fills several ranges the last rank.
        last = {c["value"]: int(c["rank"]) for c in row["cuts"]}
        out[row["name"]] = list(last.items())
    return out


def _tie(df) -> Column:
    # Splits a Z-value that many rows share over several files. The file block is
    # part of it, so that equal rows are split as well; recomputing a lost task
    # reads the same block and gives the same value. Maps have no hash.
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    # 24 bits split it far enough, and random bytes do not shrink on their way.
    mixed = F.xxhash64(
        F.input_file_name(), F.input_file_block_start(), *[F.col(c) for c in hashable]
    )
    return F.shiftright(mixed, 40).cast("int")
