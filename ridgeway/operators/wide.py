"""Ridge and principal components of designs too wide for a Gram matrix.

Nothing of size p² is formed. One pass over the rows multiplies XᵀX by a block of
vectors: each task adds up its rows' share, and the shares are summed as packed rows.
All systems of a cross-validation (every penalty on every training set) go through
conjugate gradients together, so an iteration costs one pass for all of them; the
method stops when every residual is small and fails if that is not reached. The
systems share a preconditioner: the leading axes of a sketch, which two passes give,
so that the few directions that most columns share don't cost an iteration each.
One-hot columns are index lookups, never vectors.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.operators import partials
from ridgeway.operators.moments import Design, _task_column

TOLERANCE = 1e-10
MOST_PASSES = 500
# rows whose mean is the pivot
PIVOT_ROWS = 64
# vectors of a Krylov block beyond the axes asked for
SPARE_VECTORS = 8
# vectors of a sketch beyond the axes asked for, and axes of a preconditioner
SPARE_SKETCH = 32
PRECONDITIONER_AXES = 64
LEAST_AXIS = 1e-6


def _pivot(df: DataFrame, design: Design, label: str | None) -> np.ndarray:
    """Means of some rows over [1, features…, label], 0 for the 1 and for coded columns.

    Any number near the data serves: it changes rounding, never the result.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    named = [*design.numericals, *([label] if label else [])]
    arrays = [_task_column(c, types[c], False).alias(f"a{i}") for i, (c, _) in enumerate(design.arrays)]
    plain = F.array(*(F.col(c).cast("double") for c in named)).alias("plain")
    rows = df.select(*arrays, plain).limit(PIVOT_ROWS).collect()

    def mean(name: str, width: int) -> list[float]:
        values = [r[name] for r in rows if len(r[name]) == width]
        values = np.array(values, float).reshape(len(values), width)
        values = np.where(np.isfinite(values), values, np.nan)
        counts = np.maximum(1, np.isfinite(values).sum(axis=0))
        return (np.nansum(values, axis=0) / counts).tolist()

    wide = [x for i, (_, width) in enumerate(design.arrays) for x in mean(f"a{i}", width)]
    numbers = mean("plain", len(named))
    coded = [0.0] * (len(design.terms) - len(wide) - len(design.numericals))
    last = numbers[len(design.numericals) :]
    return np.array([0.0, *wide, *numbers[: len(design.numericals)], *coded, *last])


@dataclass(frozen=True)
class System:
    """A penalty, and the part that its training set leaves out (None: no part)."""

    alpha: float
    held_out: int | None


@dataclass(frozen=True)
class PartSums:
    """Sums over the rows of each part; features and label are taken about the pivot."""

    n: np.ndarray
    y: np.ndarray
    yy: np.ndarray
    x: np.ndarray
    xx: np.ndarray
    xy: np.ndarray

    def over(self, parts: np.ndarray) -> PartSums:
        return PartSums(*(v[parts].sum(axis=0) for v in (self.n, self.y, self.yy, self.x, self.xx, self.xy)))


class WideRows:
    """Rows with a ``part`` (folds, and -1 for test rows), as blocks of features and label."""

    def __init__(self, rows: DataFrame, design: Design, label: str):
        fields = {f.name: f for f in rows.schema.fields}
        rows = rows.filter(F.col(label).isNotNull())
        for c in (*(a for a, _ in design.arrays), *design.numericals):
            rows = rows.filter(F.col(c).isNotNull())
        layout = partials.BlockLayout(
            groups=(),
            arrays=design.arrays,
            scalars=design.numericals,
            ordinals=design.ordinals,
            categoricals=design.categoricals,
            label="_label",
            labels={c: tuple(design.labels[c]) for c in (*design.ordinals, *design.categoricals)},
            max_live=1,
            pivot=np.zeros(1),
        )
        pivot = _pivot(rows, design, label)
        dense = layout.dense_width
        self.layout = replace(layout, pivot=np.append(pivot[: dense - 1], pivot[-1]))
        self.pivot = pivot[1:]
        self.width = len(design.terms)
        wanted = [F.col("part").cast("int").alias("_part"), F.col(label).cast("double").alias("_label")]
        wanted += [_task_column(c, fields[c].dataType, c in layout.labels).alias(c) for c in design.columns]
        self.rows = rows.select(*wanted)
        parts = rows.select("part").distinct().collect()  # folds
        self.parts = np.array(sorted(r["part"] for r in parts), int)
        # passes over the rows so far that multiplied XᵀX
        self.products = 0

    def total(self, add: Callable[[np.ndarray, Block], None], size: int) -> np.ndarray:
        """What ``add`` gathers over all rows in an array of ``size`` numbers."""
        layout, parts = self.layout, self.parts

        def run(batches):
            gathered = np.zeros(size)
            for batch in partials.blocks(batches, layout.rows_per_block):
                batch = partials.complete(batch, layout)
                if batch.num_rows:
                    add(gathered, Block.of(batch, layout, parts))
            rows = np.zeros((-(-size // partials.CHUNK), partials.CHUNK))
            rows.ravel()[:size] = gathered
            for at in range(0, len(rows), partials.CHUNKS_PER_BATCH):
                part = rows[at : at + partials.CHUNKS_PER_BATCH]
                numbers = [pa.array(np.ascontiguousarray(part[:, j])) for j in range(partials.CHUNK)]
                chunk = pa.array(np.arange(at, at + len(part), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([chunk, *numbers], ["chunk", *names])

        names = [f"v{i}" for i in range(partials.CHUNK)]
        schema = "chunk int, " + ", ".join(f"{v} double" for v in names)
        summed = self.rows.mapInArrow(run, schema).groupBy("chunk").agg(*(F.sum(v).alias(v) for v in names))
        found = summed.toArrow()
        out = np.zeros((-(-size // partials.CHUNK), partials.CHUNK))
        out[found["chunk"].to_numpy()] = np.stack([found[v].to_numpy() for v in names], axis=1)
        return out.ravel()[:size]

    def sums(self) -> PartSums:
        k, p = len(self.parts), self.width

        def add(gathered: np.ndarray, block: Block) -> None:
            table = gathered.reshape(k, 3 + 3 * p)
            for i in range(k):
                here = block.rows(block.part == i)
                y = here.y
                table[i, :3] += len(y), y.sum(), y @ y
                linear = here.transposed(np.stack([np.ones(len(y)), y], axis=1))
                table[i, 3:] += np.concatenate([linear[:, 0], linear[:, 1], here.squares()])

        table = self.total(add, k * (3 + 3 * p)).reshape(k, 3 + 3 * p)
        x, xy, xx = (table[:, 3 + i * p : 3 + (i + 1) * p] for i in range(3))
        return PartSums(table[:, 0], table[:, 1], table[:, 2], x, xx, xy)

    def product(self, vectors: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """XᵀX·vectors, column s over the rows of the parts for which ``uses[part, s]``."""
        shape = vectors.shape
        self.products += 1

        def add(gathered: np.ndarray, block: Block) -> None:
            scores = block.times(vectors) * uses[block.part]
            gathered += block.transposed(scores).ravel()

        return self.total(add, vectors.size).reshape(shape)

    def squared_errors(self, slopes: np.ndarray, intercepts: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """Σ(y − ŷ)² of each model over the parts that ``uses[part, model]`` names."""

        def add(gathered: np.ndarray, block: Block) -> None:
            error = (block.y[:, None] - intercepts - block.times(slopes)) * uses[block.part]
            gathered += (error * error).sum(axis=0)

        return self.total(add, slopes.shape[1])


@dataclass(frozen=True)
class Block:
    """Some rows: numbers for the first features, slots for one-hot ones (-1: none)."""

    part: np.ndarray
    dense: np.ndarray
    slots: np.ndarray
    y: np.ndarray
    width: int

    @classmethod
    def of(cls, batch: pa.RecordBatch, layout: partials.BlockLayout, parts: np.ndarray) -> Block:
        dense = partials.dense_block(batch, layout)
        codes = partials.code_block(batch, layout)
        sizes = np.array([w - 1 for w in layout.slot_widths], np.int64)
        starts = layout.dense_width - 2 + np.cumsum(sizes) - sizes
        slots = np.where(codes < sizes, codes + starts, -1) if len(sizes) else codes
        part = np.searchsorted(parts, batch.column("_part").to_numpy())
        return cls(part, dense[:, 1:-1], slots, dense[:, -1], layout.dense_width - 2 + int(sizes.sum()))

    def rows(self, keep: np.ndarray) -> Block:
        return Block(self.part[keep], self.dense[keep], self.slots[keep], self.y[keep], self.width)

    def times(self, vectors: np.ndarray) -> np.ndarray:
        """X·vectors."""
        out = self.dense @ vectors[: self.dense.shape[1]]
        padded = np.vstack([vectors, np.zeros(vectors.shape[1])])  # slot -1
        for c in range(self.slots.shape[1]):
            out += padded[self.slots[:, c]]
        return out

    def transposed(self, scores: np.ndarray) -> np.ndarray:
        """Xᵀ·scores."""
        out = np.zeros((self.width + 1, scores.shape[1]))
        out[: self.dense.shape[1]] = self.dense.T @ scores
        size, k = out.shape
        for c in range(self.slots.shape[1]):
            at = (self.slots[:, c, None] % size * k + np.arange(k)).ravel()  # slot -1 is the last row
            out += np.bincount(at, weights=scores.ravel(), minlength=size * k).reshape(size, k)
        return out[:-1]

    def squares(self) -> np.ndarray:
        out = np.zeros(self.width + 1)
        out[: self.dense.shape[1]] = (self.dense**2).sum(axis=0)
        for c in range(self.slots.shape[1]):
            out += np.bincount(self.slots[:, c] % (self.width + 1), minlength=self.width + 1)
        return out[:-1]


# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scales(sums: PartSums, train: np.ndarray) -> np.ndarray:
    """1/sample deviation of each feature over the training parts, 0 where it does not vary."""
    whole = sums.over(train)
    spread = whole.xx - whole.x**2 / whole.n
    spread = np.where(spread > 1e-13 * whole.xx, spread, 0.0)
    return np.divide(np.sqrt(max(whole.n - 1, 0)), np.sqrt(spread), out=np.zeros_like(spread), where=spread > 0)


def solve(
    rows: WideRows,
    sums: PartSums,
    scale: np.ndarray,
    systems: Sequence[System],
    train: Sequence[int],
    axes: int = PRECONDITIONER_AXES,
    raw_penalty: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Slopes (one column per system) and intercepts, of features about the pivot.

    The penalty is on the slopes of the scaled features, or with ``raw_penalty`` on those
    of the features as they are. ``axes``: of the preconditioner, from all training rows;
    0 for the diagonal alone.
    """
    trained = np.isin(rows.parts, list(train))
    uses = np.stack([trained & (rows.parts != s.held_out) for s in systems], axis=1)
    alphas = np.array([s.alpha for s in systems])
    penalty = np.outer(scale**2 if raw_penalty else np.ones(len(scale)), alphas)
    over = [sums.over(u) for u in uses.T]
    n, y = np.array([o.n for o in over]), np.array([o.y for o in over])
    x = np.stack([o.x for o in over], axis=1)
    right = scale[:, None] * (np.stack([o.xy for o in over], axis=1) - x * y / n)

    def times(v: np.ndarray) -> np.ndarray:
        raw = scale[:, None] * v
        full = rows.product(raw, uses) - x * ((x * raw).sum(axis=0) / n)
        return scale[:, None] * full + penalty * v

    found, residual = np.zeros_like(right), right.copy()
    spread = scale[:, None] ** 2 * (np.stack([o.xx for o in over], axis=1) - x**2 / n)
    near = _preconditioner(rows, sums, scale, train, penalty, np.maximum(spread, 0.0) + penalty, axes)
    direction = near(residual)
    size = (residual * direction).sum(axis=0)
    goal = TOLERANCE * np.sqrt((right**2).sum(axis=0))
    for _ in range(MOST_PASSES):
        open_ = np.sqrt((residual**2).sum(axis=0)) > goal
        if not open_.any():
            break
        image = times(direction)
        curve = (direction * image).sum(axis=0)
        step = np.divide(size, curve, out=np.zeros_like(size), where=open_ & (curve > 0))
        found += step * direction
        residual -= step * image
        shifted = near(residual)
        new = (residual * shifted).sum(axis=0)
        direction = shifted + np.divide(new, size, out=np.zeros_like(size), where=size > 0) * direction
        size = new
    else:
        raise ArithmeticError(f"no convergence in {MOST_PASSES} passes")
    slopes = scale[:, None] * found
    return slopes, y / n - (x * slopes).sum(axis=0) / n


def _preconditioner(
    rows: WideRows,
    sums: PartSums,
    scale: np.ndarray,
    train: Sequence[int],
    penalty: np.ndarray,
    diagonal: np.ndarray,
    axes: int,
) -> Callable[[np.ndarray], np.ndarray]:
    """An inverse near that of every system: on the sketch's axes theirs, elsewhere that of the last axis."""
    if not axes:
        inverse = np.divide(1.0, diagonal, out=np.ones_like(diagonal), where=diagonal > 0)
        return lambda v: inverse * v
    found = sketched_axes(rows, sums, scale, train, min(axes, rows.width), spare=0)
    n = sums.over(np.isin(rows.parts, list(train))).n
    values = found.variances[:, None] * (n - 1) + np.median(penalty, axis=0)
    # what is far below the first axis is rounding as well
    values = np.maximum(values, np.where(values[0] > 0, LEAST_AXIS * values[0], 1.0))
    gain = values[-1] / values - 1.0
    return lambda v: (v + found.axes @ (gain * (found.axes.T @ v))) / values[-1]


@dataclass(frozen=True)
class Sketch:
    """Axes as columns, the variance along each, and how far at most it is from one of the matrix."""

    axes: np.ndarray
    variances: np.ndarray
    bounds: np.ndarray


def _covariance(rows: WideRows, sums: PartSums, scale: np.ndarray, train: Sequence[int]) -> Callable[[np.ndarray], np.ndarray]:
    """v ↦ C·v for the training rows' covariance of scaled features: one pass."""
    trained = np.isin(rows.parts, list(train))
    whole = sums.over(trained)

    def times(v: np.ndarray) -> np.ndarray:
        raw = scale[:, None] * v
        uses = np.repeat(trained[:, None], v.shape[1], axis=1)
        full = rows.product(raw, uses) - np.outer(whole.x, whole.x @ raw) / whole.n
        return scale[:, None] * full / max(whole.n - 1, 1)

    return times


def sketched_axes(
    rows: WideRows,
    sums: PartSums,
    scale: np.ndarray,
    train: Sequence[int],
    k: int,
    spare: int = SPARE_SKETCH,
    seed: int = 0,
) -> Sketch:
    """Up to k leading axes of the training rows' covariance, from two passes at any width.

    The first multiplies a seeded random block, whose image spans the leading axes nearly;
    the second multiplies the range's orthogonal basis and corrects: the axes are the best of
    that range, and ‖C·a − v·a‖ bounds how far v is from a variance of C. A covariance of
    rank up to k + ``spare`` is met exactly.
    """
    times = _covariance(rows, sums, scale, train)
    width = min(rows.width, k + spare)
    image = times(np.random.default_rng(seed).normal(size=(rows.width, width)))
    left, sizes, _ = np.linalg.svd(image, full_matrices=False)
    basis = left[:, sizes > 1e-13 * max(sizes.max(initial=0.0), 1e-300)]
    if not basis.shape[1]:  # nothing varies
        basis = np.eye(rows.width, min(k, rows.width))
    image = times(basis)
    values, inner = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    order = np.argsort(values)[::-1][:k]
    axes, values = basis @ inner[:, order], values[order]
    bounds = np.sqrt(((image @ inner[:, order] - axes * values) ** 2).sum(axis=0))
    leading = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return Sketch(axes * np.where(leading < 0, -1.0, 1.0), np.maximum(values, 0.0), bounds)


def principal_axes(
    rows: WideRows, sums: PartSums, scale: np.ndarray, train: Sequence[int], k: int, seed: int = 0
) -> np.ndarray:
    """The k leading axes of the training rows' correlation matrix, as columns (block Krylov)."""
    times = _covariance(rows, sums, scale, train)
    width = min(rows.width, k + SPARE_VECTORS)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(rows.width, width)))[0]
    space, images = np.zeros((rows.width, 0)), np.zeros((rows.width, 0))
    for _ in range(MOST_PASSES):
        image = times(block)
        space, images = np.hstack([space, block]), np.hstack([images, image])
        values, inner = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        order = np.argsort(values)[::-1][:k]
        axes, values = space @ inner[:, order], values[order]
        off = np.sqrt(((images @ inner[:, order] - axes * values) ** 2).sum(axis=0))
        if space.shape[1] >= rows.width or (off <= 1e-9 * values[0]).all():
            break
        rest = image - space @ (space.T @ image)
        rest -= space @ (space.T @ rest)
        left, sizes, _ = np.linalg.svd(rest, full_matrices=False)
        block = left[:, sizes > 1e-10 * max(values[0], 1e-300)][:, : rows.width - space.shape[1]]
        if not block.shape[1]:
            break
    else:
        raise ArithmeticError(f"no convergence in {MOST_PASSES} passes")
    leading = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return axes * np.where(leading < 0, -1.0, 1.0)


def projected(rows: WideRows, basis: np.ndarray, label: str, name: str = "scores") -> DataFrame:
    """part, label and the features times ``basis`` as one array; features are about the pivot."""
    layout, parts, offset = rows.layout, rows.parts, rows.pivot[-1]

    def run(batches):
        for batch in partials.blocks(batches, layout.rows_per_block):
            batch = partials.complete(batch, layout)
            if not batch.num_rows:
                continue
            block = Block.of(batch, layout, parts)
            scores = block.times(basis)
            bounds = pa.array(np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(bounds, pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[block.part].astype(np.int32)), pa.array(block.y + offset), lists], ["part", "y", name]
            )

    return rows.rows.mapInArrow(run, f"part int, y double, {name} array<double>").withColumnRenamed("y", label)
