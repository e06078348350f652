"""Near-duplicate vectors by a forest of random-projection trees with spill.

Each tree splits the unit vectors again and again at the median of a random projection; a
vector close to the median goes to both sides. Vectors that share a leaf of any tree are
compared exactly, in doubles. The directions follow from (seed, tree, depth), so that only
thresholds have to be known; they are fitted on bounded samples, first of all vectors, then of
each leaf that is still too large, until none is or none can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.llm.common import stored
from cohort_engine.llm.components import components

THRESHOLD = 0.95
TREES = 6
# Vectors of a leaf at most, unless they are too close to be split.
LEAF = 256
# Vectors on which the thresholds of a tree or subtree are fitted at most; a node is split
# further in the same round while it holds FITTED of them.
SAMPLE = 20_000
FITTED = 64
# Spill on each side of a threshold, as a share of the standard deviation that the
# projected difference of two vectors at THRESHOLD has.
SPILL = 0.35
# A node whose larger side would keep more than this share of it is not split.
STUCK = 0.8
# Vectors of a block; the blocks of a leaf larger than that are compared pair by pair.
BLOCK = 2048
SEED = 13

# ---------------------------------------------------------------- trees


def _direction(tree: int, depth: int, dim: int) -> np.ndarray:
    v = np.random.default_rng((SEED, tree, depth, dim)).standard_normal(dim)
    return v / np.linalg.norm(v)


def _margin(dim: int, threshold: float) -> float:
    return SPILL * np.sqrt(2 * (1 - threshold) / dim)


def fit(
    units: np.ndarray, tree: int, root: int, levels: int, margin: float, fitted: int = FITTED
) -> dict[int, float]:
    """Thresholds by node below ``root`` (1 is a tree's root, 2v and 2v + 1 are v's children)."""
    thresholds: dict[int, float] = {}
    depth = root.bit_length() - 1
    now = {root: np.arange(len(units))}
    for level in range(depth, depth + levels):
        if not now or level > 50:
            break
        projected = units @ _direction(tree, level, units.shape[1])
        below: dict[int, np.ndarray] = {}
        for node, rows in now.items():
            if len(rows) < fitted:
                continue
            values = projected[rows]
            middle = float(np.median(values))
            left, right = values <= middle + margin, values > middle - margin
            if max(left.sum(), right.sum()) > STUCK * len(rows):
                continue
            thresholds[node] = middle
            below[2 * node], below[2 * node + 1] = rows[left], rows[right]
        now = below
    return thresholds


def descend(
    units: np.ndarray, tree: int, roots: np.ndarray, thresholds: dict[int, float], margin: float
) -> tuple[np.ndarray, np.ndarray]:
    """(place, leaf): the leaves that each vector reaches from its root."""
    places, nodes = np.arange(len(units)), roots.astype(np.int64)
    if not thresholds:
        return places, nodes
    known = np.array(sorted(thresholds), np.int64)
    middles = np.array([thresholds[v] for v in known.tolist()])
    done = []
    while len(places):
        at = np.minimum(np.searchsorted(known, nodes), len(known) - 1)
        inner = known[at] == nodes
        done.append((places[~inner], nodes[~inner]))
        places, nodes, middle = places[inner], nodes[inner], middles[at[inner]]
        if not len(places):
            break
        values = np.empty(len(places))
        depth = np.frexp(nodes.astype(np.float64))[1] - 1
        for level in np.unique(depth).tolist():
            here = depth == level
            direction = _direction(tree, level, units.shape[1])
            values[here] = units[places[here]] @ direction
        left, right = values <= middle + margin, values > middle - margin
        places = np.concatenate([places[left], places[right]])
        nodes = np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
    return np.concatenate([p for p, _ in done]), np.concatenate([v for _, v in done])


def _arrays(batch: pa.RecordBatch, wide: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, unit vectors) for each dimension."""
    kind = np.float64 if wide else np.float32
    column = batch.column("vector")
    sizes = np.array([len(v) for v in column.to_pylist()]) if batch.num_rows else np.zeros(0)
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        data = b"".join(column.take(pa.array(places)).to_pylist())
        v = np.frombuffer(data, kind).reshape(len(places), -1).astype(np.float64)
        # First by the largest component, so that no square over- or underflows.
        v /= np.abs(v).max(axis=1, keepdims=True)
        yield places, v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _places(rows, dim: int, tree, nodes) -> pa.RecordBatch:
    count = len(nodes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows, pa.int64()),
            pa.array(np.full(count, dim), pa.int32()),
            pa.array(np.broadcast_to(tree, count), pa.int32()),
            pa.array(nodes, pa.int64()),
        ],
        ["row", "dim", "tree", "node"],
    )


def _plant(forest, wide: bool, threshold: float):
    """Task: the nodes that vectors reach in each tree of the broadcast forest."""

    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            row = batch.column("row").to_numpy()
            for at, units in _arrays(batch, wide):
                dim = units.shape[1]
                roots = np.ones(len(at), np.int64)
                for tree, of_dim in enumerate(trees):
                    found, nodes = descend(
                        units, tree, roots, of_dim.get(dim, {}), _margin(dim, threshold)
                    )
                    yield _places(row[at[found]], dim, tree, nodes)

    return planted


def _regrow(wide: bool, threshold: float):
    """Group: thresholds below one node, fitted on a sample of its vectors."""

    def regrown(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        dim, tree, node = (batch.column(c)[0].as_py() for c in ("dim", "tree", "node"))
        leaf = int(batch.column("leaf_sample")[0].as_py())
        ((_, units),) = _arrays(batch, wide)
        found = fit(units, tree, node, 50, _margin(dim, threshold), leaf)
        keys = sorted(found)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "tree": pa.array([tree], pa.int32()),
                "node": pa.array([node], pa.int64()),
                "inner": pa.array([keys], pa.list_(pa.int64())),
                "middles": pa.array([[found[k] for k in keys]], pa.list_(pa.float64())),
            }
        )

    return regrown


def _route(wide: bool, threshold: float):
    """Task: the leaves of the subtree that comes with each vector."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, node = batch.column("row").to_numpy(), batch.column("node").to_numpy()
            tree = batch.column("tree").to_numpy()
            for at, units in _arrays(batch, wide):
                dim = units.shape[1]
                for t in np.unique(tree[at]).tolist():
                    mine = tree[at] == t
                    for v in np.unique(node[at[mine]]).tolist():
                        here = np.flatnonzero(mine & (node[at] == v))
                        one = int(at[here[0]])
                        inner = batch.column("inner")[one].as_py()
                        middles = batch.column("middles")[one].as_py()
                        found, nodes = descend(
                            units[here],
                            t,
                            np.full(len(here), v),
                            dict(zip(inner, middles, strict=True)),
                            _margin(dim, threshold),
                        )
                        yield _places(row[at[here[found]]], dim, t, nodes)

    return routed


def grow(
    vectors: DataFrame,
    wide: bool,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
) -> DataFrame:
    """(row, dim, tree, node): the leaves of each of ``vectors`` (row, vector), stored.

    Runs a job for each round of splits. Leaves hold at most ``leaf`` vectors, except those
    that can't be split, since their vectors are too close to each other. The driver gets
    about ``sample`` vectors in the first round, none in later ones.
    """
    spark = vectors.sparkSession
    count = vectors.count()
    rate = min(1.0, sample / max(1, count))
    drawn = vectors.filter(_drawn(0, F.lit(rate))).select("row", "vector").toArrow()
    forest: list[dict[int, dict[int, float]]] = [{} for _ in range(trees)]
    for batch in drawn.combine_chunks().to_batches():
        for _, units in _arrays(batch, wide):
            dim = units.shape[1]
            enough = max(FITTED, int(leaf * rate) + 1)
            for tree in range(trees):
                forest[tree][dim] = fit(units, tree, 1, 50, _margin(dim, threshold), enough)
    node = ["dim", "tree", "node"]
    schema = "row long, dim int, tree int, node long"
    shared = spark.sparkContext.broadcast(forest)
    places = stored(
        vectors.select("row", "vector").mapInArrow(_plant(shared, wide, threshold), schema),
        "places",
    )
    stuck, number = None, 0
    while True:
        number += 1
        large = places.groupBy(*node).count().filter(F.col("count") > leaf)
        if stuck is not None:
            large = large.join(stuck, node, "left_anti")
        large = stored(large, "large")
        if large.isEmpty():
            return places
        share = F.least(F.lit(1.0), F.lit(float(sample) / 8) / F.col("count"))
        chosen = stored(places.join(large, node).join(vectors, "row"), "chosen")
        subtrees = stored(
            chosen.filter(_drawn(number, share))
            .select(
                *node, "vector", F.greatest(F.lit(FITTED / 2), leaf * share).alias("leaf_sample")
            )
            .groupBy(*node)
            .applyInArrow(
                _regrow(wide, threshold),
                "dim int, tree int, node long, inner array<bigint>, middles array<double>",
            )
            .filter(F.size("inner") > 0),
            "subtrees",
        )
        gone = large.select(*node).join(subtrees, node, "left_anti")
        stuck = stored(gone if stuck is None else gone.unionByName(stuck), "stuck")
        moved = (
            chosen.join(subtrees, node)
            .select("row", *node, "vector", "inner", "middles")
            .mapInArrow(_route(wide, threshold), schema)
        )
        places = stored(places.join(subtrees, node, "left_anti").unionByName(moved), "places")


def _drawn(number: int, share):
    """A sample by hash, another one for each number."""
    return F.pmod(F.xxhash64("row", F.lit(number)), F.lit(1 << 30)) < share * (1 << 30)


# ---------------------------------------------------------------- within leaves


def _compare(wide: bool, threshold: float):
    """Group: links between the vectors of a leaf, or between two blocks of a large one.

    Of each pair that shares several leaves only the one with the smallest number counts, so
    that a vector's links may be added up over leaves. Emits a row for each linked vector,
    not for each pair: its links, and the smallest row it reaches by them.
    """

    def compared(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        leaf = batch.column("leaf")[0].as_py()
        crossing = batch.column("i")[0].as_py() != batch.column("j")[0].as_py()
        block = batch.column("block").to_numpy()
        row, copies = batch.column("row").to_numpy(), batch.column("copies").to_numpy()
        leaves = _padded(batch.column("leaves"))
        links = np.zeros(len(row), np.int64)
        rank = np.argsort(np.argsort(row))  # sets have the least row as root
        roots = np.arange(len(row))
        for at, units in _arrays(batch, wide):
            for first in range(0, len(at), 512):
                near = units[first : first + 512] @ units[first:].T >= threshold
                a, b = np.nonzero(near)
                a, b = at[a + first], at[b + first]
                good = (a < b) & (block[a] != block[b]) if crossing else a < b
                a, b = a[good], b[good]
                if not len(a):
                    continue
                before = np.zeros(len(a), bool)
                for c in range(leaves.shape[1]):
                    mine = leaves[a, c]
                    check = np.flatnonzero((mine < leaf) & ~before)
                    if len(check):
                        same = leaves[b[check]] == mine[check, None]
                        before[check] |= same.any(axis=1)
                a, b = a[~before], b[~before]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                _unite(roots, rank[a], rank[b])
        linked = links > 0
        by_rank = np.empty(len(row), np.int64)
        by_rank[rank] = row
        return pa.table(
            {
                "row": pa.array(row[linked], pa.int64()),
                "links": pa.array(links[linked], pa.int64()),
                "root": pa.array(by_rank[_root(roots)[rank[linked]]], pa.int64()),
            }
        )

    return compared


def _padded(lists: pa.Array) -> np.ndarray:
    """Lists as rows of a matrix; what is missing equals nothing and is never smaller."""
    sizes = np.asarray(lists.value_lengths())
    out = np.full((len(sizes), int(sizes.max(initial=0))), np.iinfo(np.int64).max)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = (
        lists.flatten().to_numpy()
    )
    return out


def _root(parent: np.ndarray) -> np.ndarray:
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of each pair; a set's root is its least member."""
    while True:
        parent[:] = _root(parent)
        x, y = parent[a], parent[b]
        differ = x != y
        if not differ.any():
            return
        low = np.minimum(x[differ], y[differ])
        np.minimum.at(parent, x[differ], low)
        np.minimum.at(parent, y[differ], low)


# ---------------------------------------------------------------- the operator


def _packed(wide: bool):
    kind = np.float64 if wide else np.float32

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("vector"):
                v = None
                if value.is_valid and len(value.values) and not value.values.null_count:
                    v = np.asarray(value.values, np.float64)
                    v = v if np.isfinite(v).all() and v.any() else None
                # -0.0 becomes 0.0
                out.append(None if v is None else (v + 0.0).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(out, pa.binary())],
                ["row", "id", "vector"],
            )

    return packed


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``.

    Two vectors are linked if they share a leaf and their cosine in doubles is at least
    ``threshold``; no pair below it is. ``n_links`` counts the rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` whether it is the row's own.
    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, not even equal ones; so do vectors of different dimensions. Ids must be integers; a null id is
    never the smallest and its row is kept only without other ids. Repeated rows are rows of
    their own. An empty table gives an empty result; other columns are not read.

    Equal vectors are grouped first and only their number goes on. Runs jobs; every step
    starts from a stored table. Each vector is shuffled once for each of its leaves.
    """
    element = vectors.select(F.col(f"`{vector_col}`")).schema[0].dataType.elementType
    wide = element.typeName() != "float"
    source = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    rows = stored(source.mapInArrow(_packed(wide), "row long, id long, vector binary"), "vectors")
    groups = stored(
        rows.filter(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.min("row").alias("row"), F.min("id").alias("id"), F.count("*").alias("copies")),
        "groups",
    )
    places = grow(groups.select("row", "vector"), wide, threshold, trees, leaf, sample)
    places = places.select("row", F.xxhash64("dim", "tree", "node").alias("leaf"))

    large = places.groupBy("leaf").count().filter(F.col("count") > block)
    large = large.select("leaf", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    placed = (
        places.groupBy("row")
        .agg(F.collect_list("leaf").alias("leaves"))
        .join(groups.select("row", "vector", "copies"), "row")
        .withColumn("leaf", F.explode("leaves"))
        .join(large, "leaf", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    found = stored(
        placed.select("leaf", "i", "j", "block", "row", "vector", "copies", "leaves")
        .groupBy("leaf", "i", "j")
        .applyInArrow(_compare(wide, threshold), "row long, links long, root long"),
        "links",
    )
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    edges = found.filter("row != root").select(F.col("row").alias("a"), F.col("root").alias("b"))
    roots = components(edges).withColumnsRenamed({"node": "row"})
    reached = (
        groups.join(links, "row", "left")
        .join(roots, "row", "left")
        .select(
            "row",
            "vector",
            "id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "row").alias("root"),
        )
    )
    reached = stored(reached.filter("n_links > 0"), "reached")
    least = reached.groupBy("root").agg(F.min("id").alias("component_id"))
    answers = reached.join(least, "root").select("vector", "n_links", "component_id")
    component = F.coalesce("component_id", "id")
    return rows.join(answers, "vector", "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
