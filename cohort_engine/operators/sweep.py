"""Many logistic regressions over the same rows, fitted side by side.

A sweep tries parameter settings on cross-validation folds: settings x folds models. Fitting
them one by one is a chain of small Spark jobs for each. Here one job evaluates all models
that are still being fitted: a task multiplies its rows with a matrix of a column for each
model, and the sums of its losses and gradients are added up over tasks. The steps between two
evaluations are taken for all models at once.

Each model minimises what ``pyspark.ml``'s ``LogisticRegression`` does for the same
parameters, by the same kind of steps (orthant-wise L-BFGS over features scaled to unit
deviation). With a small tolerance both end at the same coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a stored block, and rows that are multiplied at once.
BLOCK_ROWS = 8192
ROWS_AT_ONCE = 256
# Bytes of coefficients that are in flight at most: more models are fitted in turns.
STATE_BYTES = 256 << 20
# Bytes that tasks send to the driver at most; beyond it executors add them up first.
DIRECT_BYTES = 64 << 20
MAX_STEPS = 100
HISTORY = 10
# Over how many steps the loss has to change.
MEMORY = 20
PIECE = 256

_BLOCKS = (
    "labels binary, folds binary, sizes binary, places binary, values binary, width int"
)


@dataclass(frozen=True)
class Setting:
    """What one model is fitted with: the held-out fold (None: none) and parameters."""

    fold: int | None
    reg: float
    l1_ratio: float
    tol: float


@dataclass
class Fits:
    """Coefficients (a row for each model), intercepts, and steps taken."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    steps: np.ndarray


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(first, min(BLOCK_ROWS, batch.num_rows - first))
            places, values, sizes, width = [], [], [], 0
            for vector in part.column("features").to_pylist():
                value = np.asarray(vector["values"], np.float64)
                if vector["indices"] is None:  # dense
                    place = np.flatnonzero(value)
                    width, value = max(width, len(vector["values"])), value[place]
                else:
                    place = np.asarray(vector["indices"], np.int64)
                    width = max(width, vector["size"])
                places.append(place)
                values.append(value)
                sizes.append(len(place))
            columns = [
                part.column("label").to_numpy().astype(np.float64),
                part.column("fold").to_numpy().astype(np.int32),
                np.array(sizes, np.int32),
                np.concatenate(places).astype(np.int32),
                np.concatenate(values),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.tobytes()], pa.binary()) for c in columns]
                + [pa.array([width], pa.int32())],
                ["labels", "folds", "sizes", "places", "values", "width"],
            )


@dataclass
class _Rows:
    """Some rows of a block, in sparse form."""

    labels: np.ndarray
    folds: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The product of the rows with a matrix of a row for each feature."""
        out = np.zeros((len(self.labels), matrix.shape[1]))
        full = self.starts[1:] > self.starts[:-1]
        if full.any():
            parts = matrix[self.places] * self.values[:, None]
            out[full] = np.add.reduceat(parts, self.starts[:-1][full])
        return out

    def transposed_times(self, matrix: np.ndarray, out: np.ndarray) -> None:
        """Adds the product of the rows' transpose with a matrix to ``out``."""
        if not len(self.places):
            return
        order = np.argsort(self.places, kind="stable")
        sorted_places = self.places[order]
        first = np.flatnonzero(np.diff(sorted_places, prepend=-1))
        parts = matrix[self.owner[order]] * self.values[order, None]
        out[sorted_places[first]] += np.add.reduceat(parts, first)


def _rows_of(batch: pa.RecordBatch) -> Iterator[_Rows]:
    kinds = {
        "labels": np.float64, "folds": np.int32, "sizes": np.int32,
        "places": np.int32, "values": np.float64,
    }
    for i in range(batch.num_rows):
        labels, folds, sizes, places, values = (
            np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in kinds.items()
        )
        starts = np.append(0, np.cumsum(sizes))
        for first in range(0, len(labels), ROWS_AT_ONCE):
            last = min(first + ROWS_AT_ONCE, len(labels))
            low, high = starts[first], starts[last]
            yield _Rows(
                labels[first:last],
                folds[first:last],
                np.repeat(np.arange(last - first), sizes[first:last]),
                starts[first : last + 1] - low,
                places[low:high],
                values[low:high],
            )


def _pieces(totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A matrix as rows of numbered pieces; pieces of zeros are left out."""
    for number, first in enumerate(range(0, len(totals), PIECE)):
        part = totals[first : first + PIECE]
        if part.any():
            yield pa.RecordBatch.from_pydict(
                {"piece": pa.array([number], pa.int32()), "data": [part.tobytes()]}
            )


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(d.as_py(), np.float64) for d in table.column("data"))
    return pa.table({"piece": table.column("piece")[:1], "data": [total.tobytes()]})


class Sweep:
    """Encoded rows in folds, kept for any number of evaluations.

    ``encoded`` has ``features`` (a vector), ``label`` (0 or 1) and ``fold``.
    """

    def __init__(self, encoded: DataFrame, partitions: int | None = None):
        rows = encoded.select(
            F.unwrap_udt("features").alias("features"),
            F.col("label").cast("double").alias("label"),
            F.col("fold").cast("int").alias("fold"),
        )
        rows = rows.coalesce(partitions) if partitions else rows
        self.blocks = rows.mapInArrow(_pack, _BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
        self.width = self.blocks.agg(F.coalesce(F.max("width"), F.lit(0))).first()[0]
        self.parts = self.blocks.rdd.getNumPartitions()

    def close(self) -> None:
        self.blocks.unpersist()

    # ------------------------------------------------------------ jobs

    def _sum(self, task, rows: int, columns: int) -> np.ndarray:
        """Sum over tasks of the rows x columns matrices that ``task`` makes of its rows."""

        def run(batches):
            total = np.zeros((rows, columns))
            for batch in batches:
                for some in _rows_of(batch):
                    task(some, total)
            yield from _pieces(total)

        schema = "piece int, data binary"
        parts = self.blocks.mapInArrow(run, schema)
        if self.parts * rows * columns * 8 > DIRECT_BYTES:
            salt = F.pmod(F.spark_partition_id(), F.lit(int(self.parts**0.5) + 1))
            parts = (
                parts.withColumn("salt", salt)
                .groupBy("piece", "salt")
                .applyInArrow(_added, schema)
                .groupBy("piece")
                .applyInArrow(_added, schema)
            )
        out = np.zeros((rows, columns))
        for batch in parts.toArrow().to_batches():
            for piece, data in zip(batch.column("piece"), batch.column("data"), strict=True):
                first = piece.as_py() * PIECE
                part = np.frombuffer(data.as_py(), np.float64).reshape(-1, columns)
                out[first : first + len(part)] += part
        return out

    def _moments(self, folds: int) -> np.ndarray:
        """Of each fold: sums and sums of squares of each feature, then ones and rows."""

        def task(some, total):
            for fold in np.unique(some.folds):
                mine = (some.folds == fold)[some.owner]
                places, values = some.places[mine], some.values[mine]
                width = len(total) - 1
                total[:-1, 2 * fold] += np.bincount(places, values, width)
                total[:-1, 2 * fold + 1] += np.bincount(places, values**2, width)
                total[-1, 2 * fold] += some.labels[some.folds == fold].sum()
                total[-1, 2 * fold + 1] += (some.folds == fold).sum()

        return self._sum(task, self.width + 1, 2 * folds)

    def _evaluate(self, weights: np.ndarray, offsets: np.ndarray, held_out: np.ndarray):
        """(losses, gradients, residuals) of each model, summed over its rows."""
        shared = self.blocks.sparkSession.sparkContext.broadcast((weights, offsets, held_out))

        def task(some, total):
            weights, offsets, held_out = shared.value
            margin = some.times(weights) + offsets
            counts = some.folds[:, None] != held_out
            label = some.labels[:, None]
            total[-1] += ((np.logaddexp(0, margin) - label * margin) * counts).sum(axis=0)
            residual = (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - label) * counts
            total[-2] += residual.sum(axis=0)
            some.transposed_times(residual, total)

        total = self._sum(task, self.width + 2, weights.shape[1])
        shared.unpersist()
        return total[-1], total[:-2].T, total[-2]

    def count(self, fits: Fits, settings: Sequence[Setting]) -> np.ndarray:
        """Of each model on its held-out fold: hits of label 1, wrong answers, rows."""
        out = []
        for chosen in self._turns(len(settings)):
            shared = self.blocks.sparkSession.sparkContext.broadcast(
                (
                    np.ascontiguousarray(fits.coefficients[chosen].T),
                    fits.intercepts[chosen],
                    np.array([settings[i].fold for i in chosen]),
                )
            )

            def task(some, total, shared=shared):
                weights, intercepts, fold = shared.value
                guess = some.times(weights) + intercepts > 0
                mine = some.folds[:, None] == fold
                label = some.labels[:, None] == 1
                total[0] += (guess & label & mine).sum(axis=0)
                total[1] += ((guess != label) & mine).sum(axis=0)
                total[2] += mine.sum(axis=0)

            out.append(self._sum(task, 3, len(chosen)).T)
            shared.unpersist()
        return np.concatenate(out)

    # ------------------------------------------------------------ fitting

    def _turns(self, models: int) -> list[np.ndarray]:
        """Models in groups whose state fits in STATE_BYTES."""
        each = 8 * (self.width + 2) * (2 * HISTORY + 8)
        size = max(1, STATE_BYTES // each)
        return [np.arange(i, min(i + size, models)) for i in range(0, models, size)]

    def fit(self, settings: Sequence[Setting], folds: int) -> Fits:
        """One model for each setting, on the rows of all folds but the one held out."""
        moments = self._moments(folds)
        parts = [self._fit([settings[i] for i in t], moments) for t in self._turns(len(settings))]
        return Fits(*(np.concatenate([getattr(p, f) for p in parts]) for f in Fits.__annotations__))

    def _fit(self, settings: Sequence[Setting], moments: np.ndarray) -> Fits:
        k = len(settings)
        held_out = np.array([-1 if s.fold is None else s.fold for s in settings])
        whole = moments[:, 0::2].sum(axis=1), moments[:, 1::2].sum(axis=1)
        left = [
            tuple(w - (moments[:, 2 * f + j] if f >= 0 else 0) for j, w in enumerate(whole))
            for f in held_out
        ]
        sums, squares = (np.array([x[j][:-1] for x in left]) for j in (0, 1))
        ones, rows = (np.array([x[j][-1] for x in left]) for j in (0, 1))
        rows = np.maximum(rows, 1)
        means = sums / rows[:, None]
        variance = (squares / rows[:, None] - means**2) * (rows / np.maximum(rows - 1, 1))[:, None]
        deviation = np.sqrt(np.maximum(variance, 0))
        # A constant feature has no weight.
        scale = np.where(deviation > 1e-12, 1 / np.maximum(deviation, 1e-12), 0.0)
        reg, ratio, tol = (np.array([getattr(s, f) for s in settings]) for f in ("reg", "l1_ratio", "tol"))
        l1 = np.hstack([(reg * ratio)[:, None] * scale, np.zeros((k, 1))])
        l2 = np.hstack([(reg * (1 - ratio))[:, None] * scale**2, np.zeros((k, 1))])

        def evaluate(x, chosen):
            """Smooth losses and gradients at scaled coefficients with the intercept last."""
            weights = x[:, :-1] * scale[chosen]
            offsets = x[:, -1] - (weights * means[chosen]).sum(axis=1)
            loss, gradient, residual = self._evaluate(
                np.ascontiguousarray(weights.T), offsets, held_out[chosen]
            )
            gradient = (gradient - means[chosen] * residual[:, None]) * scale[chosen]
            n = rows[chosen]
            loss = loss / n + 0.5 * (l2[chosen] * x * x).sum(axis=1)
            gradient = np.hstack([gradient, residual[:, None]]) / n[:, None] + l2[chosen] * x
            return loss, gradient

        start = np.zeros((k, sums.shape[1] + 1))
        both = (ones > 0) & (ones < rows)
        share = np.where(both, ones / rows, 0.5)
        start[:, -1] = np.log(share / (1 - share))
        x, steps = _minimise(evaluate, start, l1, tol)
        coefficients = x[:, :-1] * scale
        intercepts = x[:, -1] - (coefficients * means).sum(axis=1)
        # Rows of one label only: nothing to learn, the answer is that label.
        coefficients[~both] = 0
        intercepts[~both] = np.where(ones[~both] > 0, np.inf, -np.inf)
        return Fits(coefficients, intercepts, steps)


def _with_l1(x, gradient, l1):
    """The gradient with the penalty: of the ones possible at zero the one nearest zero."""
    up, down = gradient + l1, gradient - l1
    at_zero = np.where(down > 0, down, np.where(up < 0, up, 0.0))
    return np.where(x == 0, at_zero, gradient + np.sign(x) * l1)


def _minimise(evaluate, start, l1, tol) -> tuple[np.ndarray, np.ndarray]:
    """Orthant-wise L-BFGS for all rows of ``start`` at once; (points, steps taken).

    ``evaluate(points, rows)`` gives the smooth losses and gradients of some of the rows. A
    row stops when the length of its gradient is below tol x its loss, or after MEMORY steps
    in which its loss has changed by less than tol x the first one.
    """
    k = len(start)
    x = start.copy()
    loss, gradient = evaluate(x, np.arange(k))
    loss = loss + (l1 * np.abs(x)).sum(axis=1)
    steep = _with_l1(x, gradient, l1)
    first, steps = loss.copy(), np.zeros(k, int)
    losses = [np.full(k, np.inf)]
    history: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    active = np.linalg.norm(steep, axis=1) > np.maximum(tol * loss, 1e-8)
    for step in range(MAX_STEPS):
        rows = np.flatnonzero(active)
        if not len(rows):
            break
        direction = -_inverse_times(history, steep[rows], rows)
        direction[direction * steep[rows] >= 0] = 0.0
        slope = (direction * steep[rows]).sum(axis=1)
        length = np.ones(len(rows))
        if step == 0:
            length = 0.05 / np.maximum(np.linalg.norm(gradient[rows], axis=1), 1e-300)
        shrink, orthant = (0.1 if step == 0 else 0.5), np.sign(x[rows])
        orthant = np.where(orthant == 0, np.sign(-steep[rows]), orthant)
        new_x, new_gradient = x[rows].copy(), gradient[rows].copy()
        new_loss = loss[rows].copy()
        pending, failed = np.arange(len(rows)), np.zeros(len(rows), bool)
        for attempt in range(20):
            point = x[rows[pending]] + length[pending, None] * direction[pending]
            penalised = l1[rows[pending]] > 0
            point[penalised & (np.sign(point) != orthant[pending])] = 0.0
            value, slopes = evaluate(point, rows[pending])
            value = value + (l1[rows[pending]] * np.abs(point)).sum(axis=1)
            slopes_in = (_with_l1(point, slopes, l1[rows[pending]]) * direction[pending]).sum(axis=1)
            low = value <= loss[rows[pending]] + 1e-4 * length[pending] * slope[pending]
            # Steps that are much too short grow, ones that lead too far shrink.
            short = low & (slopes_in < 0.9 * slope[pending])
            far = ~low | (slopes_in > -0.9 * slope[pending])
            done = ~(short | far) | (attempt == 19)
            new_x[pending[low]], new_gradient[pending[low]] = point[low], slopes[low]
            new_loss[pending[low]] = value[low]
            failed[pending] = ~low
            length[pending] *= np.where(short, 2.1, np.where(far, shrink, 1.0))
            pending = pending[~done]
            if not len(pending):
                break
        moved = np.zeros_like(x), np.zeros_like(x)
        moved[0][rows], moved[1][rows] = new_x - x[rows], new_gradient - gradient[rows]
        curvature = (moved[0] * moved[1]).sum(axis=1)
        history = [*history[-HISTORY + 1 :], (*moved, curvature)]
        x[rows], gradient[rows], loss[rows] = new_x, new_gradient, new_loss
        steep[rows] = _with_l1(new_x, new_gradient, l1[rows])
        steps[rows] += 1
        losses = [*losses[-MEMORY + 1 :], loss.copy()]
        still = np.abs(loss - np.max(losses, axis=0)) <= tol * first
        flat = np.linalg.norm(steep, axis=1) <= np.maximum(tol * loss, 1e-8)
        active &= ~(still | flat)
        active[rows[failed]] = False
    return x, steps


def _inverse_times(history, gradient, rows) -> np.ndarray:
    """The approximate inverse Hessian of each row times its gradient (two loops)."""
    out, kept = gradient.copy(), []
    for moved, change, curvature in reversed(history):
        s, y, c = moved[rows], change[rows], curvature[rows]
        share = np.where(c > 0, (s * out).sum(axis=1) / np.where(c > 0, c, 1), 0.0)
        out -= share[:, None] * y
        kept.append((s, y, c, share))
    if history:
        _, y, c, _ = kept[0]
        norm = (y * y).sum(axis=1)
        out *= np.where((c > 0) & (norm > 0), c / np.where(norm > 0, norm, 1), 1.0)[:, None]
    for s, y, c, share in reversed(kept):
        back = np.where(c > 0, (y * out).sum(axis=1) / np.where(c > 0, c, 1), 0.0)
        out += s * (share - back)[:, None] * (c > 0)[:, None]
    return out
