import numpy as np
import pytest

from cohort_engine.llm import vector_forest as forest

SCHEMA = "vec_id long, embedding array<float>, label int, row string, vector string, leaf int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "x", "y", 3) for i, v in rows], schema).repartition(3)


def brute(rows):
    """(vec_id, n_links, component_id) of each row."""
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
        v = np.asarray(v, np.float32).astype(np.float64) if ok else None
        units.append(None if v is None else v / np.linalg.norm(v))
    n = len(rows)
    links = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                links[i].append(j)
                links[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids) if ids else None))
    return out


def vectors(rng, clusters, dim=24):
    rows = []
    for size, noise in clusters:
        centre = rng.standard_normal(dim)
        for _ in range(size):
            v = centre + noise * np.linalg.norm(centre) / np.sqrt(dim) * rng.standard_normal(dim)
            rows.append((len(rows), v.astype(np.float32).tolist()))
    return rows


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def answers(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    return ordered((r["vec_id"], r["n_links"], r["component_id"]) for r in rows)


def test_mess(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, [(1, 0)] * 20 + [(6, 0.1), (5, 0.2), (9, 0.05)])
    base = rows[0][1]
    rows += [(100 + i, base) for i in range(7)]
    rows += [(200, [2 * x for x in base]), (201, [-x for x in base]), (202, base[:8])]
    rows += [(203, [1e30 * x for x in base]), (204, [1e-38 * x for x in base])]
    rows += [(300, None), (301, []), (302, [0.0] * 24), (303, [None, *base[1:]])]
    rows += [(304, [float("nan"), *base[1:]]), (305, [float("inf"), *base[1:]])]
    rows += [(None, base), (None, [0.0]), (0, base), (0, base), (306, [-0.0, 1.0]), (307, [0.0, 1.0])]
    assert answers(forest.near_vectors(frame(spark, rows))) == ordered(brute(rows))


@pytest.mark.parametrize("block", [2048, 16])
def test_rounds_and_tight_clusters(spark, block):
    """Several rounds of splits; a tight cluster that can't be split, in blocks."""
    rng = np.random.default_rng(5)
    rows = vectors(rng, [(1, 0)] * 500 + [(4, 0.15)] * 60 + [(150, 0.02), (30, 0.25)])
    got = answers(
        forest.near_vectors(frame(spark, rows), leaf=12, sample=400, block=block, trees=4)
    )
    expected = ordered(brute(rows))
    found, total = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert found <= total and found >= 0.97 * total
    assert all(a[1] <= b[1] for a, b in zip(got, expected, strict=True))
    assert sum(a == b for a, b in zip(got, expected, strict=True)) >= 0.95 * len(rows)


def test_doubles_and_empty(spark):
    schema = SCHEMA.replace("array<float>", "array<double>")
    rows = vectors(np.random.default_rng(6), [(1, 0), (4, 0.1)])
    rows += [(9, [1e200 * x for x in rows[0][1]])]
    got = answers(forest.near_vectors(frame(spark, rows, schema)))
    assert [r[1] for r in got] == [1, 3, 3, 3, 3, 1]
    assert forest.near_vectors(frame(spark, rows).filter("vec_id < 0")).collect() == []
    nothing = [(1, None), (2, [])]
    assert answers(forest.near_vectors(frame(spark, nothing))) == [(1, 0, 1), (2, 0, 2)]
