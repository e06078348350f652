import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohort_engine.functions.zcurve import cuts_of, z_value
from cohort_engine.sources import layout
from cohort_engine.sources.io import load, save
from cohort_engine.sources.layout import bits_for, table_bytes, zorder, zorder_write


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "plain")
    df = spark.range(8000).select(
        F.col("id"),
        (F.hash("id") % 1000).alias("a"),
        F.concat(F.lit("p"), F.lpad(F.abs(F.hash("id", F.lit(1))) % 500, 4, "0")).alias("b"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.abs(F.hash("id", F.lit(2))) % 3000).alias("d"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.timestamp_seconds("id")).alias("t"),
    )
    save(df, path)
    return load(spark, path)


def spans(df, column):
    per_file = (
        df.groupBy(F.input_file_name().alias("f"))
        .agg((F.max(column) - F.min(column)).alias("span"))
        .agg(F.avg("span"))
    )
    return per_file.first()[0]


def test_same_rows_in_narrower_files(spark, stored, tmp_path):
    path = str(tmp_path / "clustered")
    zorder_write(stored, ["a", "b"], path, files=16)
    out = load(spark, path)
    assert out.columns == stored.columns
    assert out.exceptAll(stored).count() == stored.exceptAll(out).count() == 0
    number = F.substring("b", 2, 4).cast("int")
    assert spans(out, F.col("a")) < 0.6 * spans(stored, F.col("a"))
    assert spans(out.withColumn("n", number), F.col("n")) < 0.6 * spans(
        stored.withColumn("n", number), F.col("n")
    )


def test_clustered_files_are_compact(spark, stored, tmp_path):
    path = str(tmp_path / "clustered")
    zorder_write(stored, ["a", "b"], path)
    assert all(f.endswith(".zstd.parquet") for f in load(spark, path).inputFiles())
    tie = stored.select(layout._tie(stored).alias("tie"))
    assert tie.dtypes == [("tie", "int")] and tie.distinct().count() > 7_000


def test_all_key_types(spark, stored, tmp_path):
    path = str(tmp_path / "clustered")
    zorder_write(stored, ["d", "t", "b"], path, bits=3)
    assert load(spark, path).exceptAll(stored).count() == 0
    with pytest.raises(TypeError):
        zorder_write(stored.withColumn("m", F.array("a")), ["m"], path + "2")


def test_hot_value_is_split_over_files(spark, tmp_path):
    # two thirds of the rows are alike in the key, one third in every column
    plain, path = str(tmp_path / "plain"), str(tmp_path / "clustered")
    save(
        spark.range(0, 9000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"),
            F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id")).alias("v"),
        ),
        plain,
    )
    zorder_write(load(spark, plain), ["k"], path, files=8)
    sizes = [
        r["count"] for r in load(spark, path).groupBy(F.input_file_name()).count().collect()
    ]
    assert sum(sizes) == 9000 and max(sizes) < 2500


def test_cuts_of():
    assert cuts_of([2, 4, 6]) == [(2, 1), (4, 2), (6, 3)]
    assert cuts_of([5, 5, 5]) == [(5, 3)]
    assert cuts_of([]) == []


def test_cuts_come_from_sketches(spark):
    df = spark.range(40_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 10 > 0, F.col("id") / 7).otherwise(float("nan")).alias("x"),
        F.format_string("s%06d", "id").alias("t"),
        F.lit(None).cast("long").alias("none"),
        F.lit(3).cast("long").alias("same"),
    )
    keys = [F.col(c) for c in df.columns]
    n, x, t, none, same = layout._cuts(df, keys, 3, 8_000, 1)
    assert [r for _, r in n] == [r for _, r in x] == [r for _, r in t] == list(range(1, 8))
    for (number, rank), (text, _), (ratio, _) in zip(n, t, x):
        assert abs(number - rank * 5_000) < 200
        assert abs(int(text[1:]) - rank * 5_000) < 1_500
        assert abs(ratio * 7 - rank * 5_000) < 300
    assert none == [] and same == [(3, 7)]


def test_one_column_needs_no_curve(spark, stored, tmp_path):
    path = str(tmp_path / "ranged")
    zorder_write(stored, ["d"], path, files=10)
    out = load(spark, path)
    assert out.exceptAll(stored).count() == 0
    low, high = dt.date(2003, 1, 1), dt.date(2003, 2, 1)
    before = layout.files_to_read(stored, "d", low, high).first()
    after = layout.files_to_read(out, "d", low, high).first()
    assert before.to_read == before.files and after.files == 10 and after.to_read <= 2
    assert layout.files_to_read(out, "d", dt.date(1900, 1, 1), dt.date(1901, 1, 1)).first().to_read == 0


def test_z_value_interleaves(spark):
    df = spark.range(16).selectExpr("CAST(id % 4 AS INT) AS x", "CAST(id DIV 4 AS INT) AS y")
    cuts = [[(1, 1), (2, 2), (3, 3)]] * 2
    got = {
        (r.x, r.y): r.z
        for r in df.withColumn("z", z_value([F.col("x"), F.col("y")], cuts, 2)).collect()
    }
    assert got[1, 0] == 1 and got[0, 1] == 2 and got[3, 0] == 5 and got[3, 3] == 15
    assert sorted(got.values()) == list(range(16))
    with pytest.raises(ValueError):
        z_value([F.col("x")] * 8, [[]] * 8, 8)


@pytest.mark.parametrize("dimensions", [2, 4])
def test_more_cells_than_files_at_any_number(dimensions):
    for files in (10, 1_000, 800_000, 10**8):
        assert files < 2 ** (bits_for(files, dimensions) * dimensions) <= 2**62


def test_searched_ranks_equal_the_tree(spark, monkeypatch):
    from cohort_engine.functions import zcurve

    df = spark.range(500).select(
        F.when(F.col("id") % 7 > 0, F.abs(F.hash("id")) % 90).alias("n"),
        F.concat(F.lit("é'\""), F.col("id") % 40).alias("s"),
        (F.col("id") / 3).alias("x"),
    )
    rows = df.collect()
    columns = ["n", "s", "x"]
    values_of = {c: sorted(r[c] for r in rows if r[c] is not None) for c in columns}
    cuts = [cuts_of([v[k * len(v) // 16] for k in range(1, 16)]) for v in values_of.values()]

    def values():
        z = z_value([F.col(c) for c in columns], cuts, 4)
        return [r.z for r in df.select(z.alias("z")).collect()]

    tree = values()
    monkeypatch.setattr(zcurve, "TREE_BITS", 0)
    assert values() == tree and len(set(tree)) > 100


def test_files_by_bytes(spark, stored):
    size = table_bytes(stored)
    assert size > 10_000
    out = zorder(stored, ["a", "b"], file_bytes=size // 20)
    assert out.rdd.getNumPartitions() >= 20
