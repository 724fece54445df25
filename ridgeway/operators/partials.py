"""Second moments inside a task (numpy on Arrow batches).

A task keeps one symmetric matrix per live group. Sums about zero are emitted
as rows of 64 numbers, which Spark adds up with a native aggregate. Co-moments
(products about the task's own means) are emitted as square tiles with the
means of their rows and columns, so that any two partials of a tile can be
merged without the rest of the matrix. One-hot columns never become dense:
their products are counts, taken with ``bincount`` on the codes, so a row costs
(columns)² steps and not (one-hot width)².
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

CHUNK = 64
# rows of a block, and what its numbers and their products' addresses may take
ROWS_PER_BLOCK = 32768
BLOCK_BYTES = 64 << 20
CHUNKS_PER_BATCH = 4096
# side of a tile of co-moments, and tiles that are handled at once
TILE = 16
TILES_PER_BATCH = 1024
# groups of fewer rows in a block are reduced together
ROWS_PER_GROUP = 64
# matrices of live groups that a task may hold, in bytes
LIVE_BYTES = 256 << 20


@dataclass(frozen=True)
class BlockLayout:
    """What a batch holds and where its columns stand in the matrix.

    The matrix is over ``[1, arrays…, scalars…, ordinals…, label | one-hot…]``.
    An ordinal contributes its label's rank; a categorical one slot per label
    and one last slot for null or unseen values. Both use ``labels``.
    """

    groups: tuple[str, ...]
    arrays: tuple[tuple[str, int], ...]
    scalars: tuple[str, ...]
    ordinals: tuple[str, ...]
    categoricals: tuple[str, ...]
    label: str | None
    labels: dict[str, tuple[str, ...]]
    max_live: int
    # what is taken off the dense columns before they are multiplied, 0 for the first
    pivot: np.ndarray

    @property
    def dense_width(self) -> int:
        arrays = sum(w for _, w in self.arrays)
        return 1 + arrays + len(self.scalars) + len(self.ordinals) + (self.label is not None)

    @property
    def slot_widths(self) -> list[int]:
        return [len(self.labels[c]) + 1 for c in self.categoricals]

    @property
    def rows_per_block(self) -> int:
        coded = len(self.categoricals)
        per_row = 8 * (2 * self.dense_width + 3 * coded)
        return max(1, min(ROWS_PER_BLOCK, BLOCK_BYTES // per_row))

    @property
    def size(self) -> int:
        return self.dense_width + sum(self.slot_widths)


def codes_of(column: pa.Array, labels: tuple[str, ...]) -> np.ndarray:
    """Rank of each value in ``labels``; null and unseen values get ``len(labels)``."""
    known = pa.array(labels, pa.string())
    if pa.types.is_integer(column.type):
        known = known.cast(column.type)
    found = pc.index_in(column, value_set=known)
    return pc.fill_null(found, len(labels)).to_numpy(zero_copy_only=False).astype(np.int64)


def matrix_of(column: pa.ListArray, name: str, width: int) -> np.ndarray:
    lengths = pc.list_value_length(column)
    if column.null_count or not pc.all(pc.equal(lengths, width)).as_py():
        raise ValueError(f"{name} must hold exactly {width} numbers in every row")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def complete(batch: pa.RecordBatch, layout: BlockLayout) -> pa.RecordBatch:
    """The rows whose vectors have no null inside; other nulls were filtered before."""
    for name, width in layout.arrays:
        column = batch.column(name)
        numbers = column.flatten()
        if numbers.null_count:
            missing = numbers.is_null().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy())
            keep = np.ones(len(column), bool)
            keep[rows[missing]] = False
            batch = batch.filter(pa.array(keep))
    return batch


def numbers_of(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def dense_block(batch: pa.RecordBatch, layout: BlockLayout) -> np.ndarray:
    block = np.empty((batch.num_rows, layout.dense_width))
    block[:, 0] = 1.0
    at = 1
    for name, width in layout.arrays:
        block[:, at : at + width] = matrix_of(batch.column(name), name, width)
        at += width
    for name in layout.scalars:
        block[:, at] = numbers_of(batch.column(name))
        at += 1
    for name in layout.ordinals:
        block[:, at] = codes_of(batch.column(name), layout.labels[name])
        at += 1
    if layout.label is not None:
        block[:, at] = numbers_of(batch.column(layout.label))
    block -= layout.pivot
    return block


def code_block(batch: pa.RecordBatch, layout: BlockLayout) -> np.ndarray:
    columns = [codes_of(batch.column(c), layout.labels[c]) for c in layout.categoricals]
    return np.stack(columns, axis=1) if columns else np.empty((batch.num_rows, 0), np.int64)


def add_rows(total: np.ndarray, dense: np.ndarray, codes: np.ndarray, widths: list[int]) -> None:
    """Add the rows' products to the lower triangle of ``total``."""
    d = dense.shape[1]
    total[:d, :d] += dense.T @ dense
    starts = np.concatenate([[0], np.cumsum(widths)[:-1]]).astype(np.int64) if widths else []
    slots = codes + starts if len(widths) else codes
    for c, (start, width) in enumerate(zip(starts, widths)):
        code = codes[:, c, None]
        here = slice(d + start, d + start + width)
        sums = np.bincount(
            (code * d + np.arange(d)).ravel(), weights=dense.ravel(), minlength=width * d
        )
        total[here, :d] += sums.reshape(width, d)
        reach = start + width
        counts = np.bincount(
            (code * reach + slots[:, : c + 1]).ravel(), minlength=width * reach
        )
        total[here, d : d + reach] += counts.reshape(width, reach)


def group_spans(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[tuple[tuple, np.ndarray | slice]]:
    """(group values, row positions) for the groups that occur in a batch."""
    codes, columns = np.zeros(batch.num_rows, np.int64), []
    for name in names:
        coded = batch.column(name).dictionary_encode(null_encoding="encode")
        columns.append(coded.dictionary.to_pylist())
        own = coded.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(codes * max(1, len(columns[-1])) + own, return_inverse=True)[1].ravel()
        columns = [*columns[:-1], (columns[-1], own)]
    if not batch.num_rows or not codes.any():
        return [(tuple(v[own[0]] for v, own in columns), slice(None))] if batch.num_rows else []
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(codes.max() + 2))
    spans = [order[a:b] for a, b in zip(bounds, bounds[1:])]
    return [(tuple(v[own[rows[0]]] for v, own in columns), rows) for rows in spans]


def packed_batches(group: tuple, total: np.ndarray, schema: pa.Schema):
    """The lower triangle, row by row, in rows of ``CHUNK`` numbers."""
    packed = total[np.tril_indices(len(total))]
    rows = np.zeros((-(-len(packed) // CHUNK), CHUNK))
    rows.ravel()[: len(packed)] = packed
    for at in range(0, len(rows), CHUNKS_PER_BATCH):
        part = rows[at : at + CHUNKS_PER_BATCH]
        groups = [pa.array([g] * len(part), schema.field(i).type) for i, g in enumerate(group)]
        chunks = pa.array(np.arange(at, at + len(part), dtype=np.int32))
        numbers = [pa.array(np.ascontiguousarray(part[:, j])) for j in range(CHUNK)]
        yield pa.RecordBatch.from_arrays([*groups, chunks, *numbers], schema=schema)


def blocks(batches, rows: int):
    """Arrow batches joined to blocks of ``rows`` rows, so that the products pay off."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield from cut(held, rows)
            held, count = [], 0
    if count:
        yield from cut(held, rows)


def cut(batches: list[pa.RecordBatch], rows: int):
    for batch in pa.Table.from_batches(batches).combine_chunks().to_batches():
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def partial_sums(layout: BlockLayout, schema: pa.Schema):
    """The function for ``mapInArrow``: batches in, packed partial sums out."""

    def run(batches):
        live: dict[tuple, np.ndarray] = {}
        widths = layout.slot_widths
        for batch in blocks(batches, layout.rows_per_block):
            batch = complete(batch, layout)
            if not batch.num_rows:
                continue
            dense, codes = dense_block(batch, layout), code_block(batch, layout)
            for group, rows in group_spans(batch, layout.groups):
                if group not in live and len(live) >= layout.max_live:
                    # sums are additive: what was emitted early is added later
                    for done, total in live.items():
                        yield from packed_batches(done, total, schema)
                    live.clear()
                if group not in live:
                    live[group] = np.zeros((layout.size, layout.size))
                add_rows(live[group], dense[rows], codes[rows], widths)
        for group, total in live.items():
            yield from packed_batches(group, total, schema)

    return run


class CoMoments:
    """n, means and products about the means of the rows met so far.

    One-hot slots stay counts, and sums of the dense columns over a slot's rows
    are about the dense means, until :meth:`whole` centres them too.
    """

    def __init__(self, d: int, widths: list[int]):
        self.d, self.widths = d, widths
        size = d + sum(widths)
        self.n, self.means, self.total = 0.0, np.zeros(self.d), np.zeros((size, size))

    def add(self, dense: np.ndarray, codes: np.ndarray) -> None:
        """Merge some rows: their products about their own means come first."""
        # less the first row, so that a column that does not vary is exactly 0
        away = dense - dense[0]
        middle = away.mean(axis=0)
        part = np.zeros_like(self.total)
        add_rows(part, away - middle, codes, self.widths)
        self.merge(float(len(dense)), dense[0], middle, part)

    def add_parts(self, n: np.ndarray, means: np.ndarray, inner: np.ndarray) -> None:
        """Merge rows that each stand for ``n`` rows with these means; ``inner`` are all their products."""
        away = means - means[0]
        middle = n @ away / n.sum()
        away -= middle
        self.merge(float(n.sum()), means[0], middle, inner + (n[:, None] * away).T @ away)

    def merge(self, n: float, first: np.ndarray, middle: np.ndarray, part: np.ndarray) -> None:
        """Merge products about the means ``first + middle`` of n rows."""
        d, share = self.d, n / (self.n + n)
        if self.n:
            gap = (first - self.means) + middle
            # sums over a slot's rows move with the means
            here, before = np.diag(part)[d:].copy(), np.diag(self.total)[d:].copy()
            part[d:, :d] += np.outer(here, gap * (1 - share)) - np.outer(before, gap * share)
            part[:d, :d] += np.outer(gap, gap) * (self.n * share)
            self.means = self.means + gap * share
        else:
            self.means = first + middle
        self.total += part
        self.n += n

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Means and products about them, slots included; the matrix is symmetric."""
        d = self.d
        counts = np.diag(self.total)[d:].copy()
        full = np.tril(self.total)
        full[d:, d:] -= np.tril(np.outer(counts, counts / self.n))
        full += np.tril(full, -1).T
        return np.concatenate([self.means, counts / self.n]), full


def tile_side(size: int) -> int:
    return max(1, min(TILE, size))


def tile_batches(group: tuple, found: CoMoments, schema: pa.Schema):
    """Rows (group…, bi, bj, n, mi, mj, v) of the tiles bi ≥ bj of one matrix."""
    means, full = found.whole()
    side = tile_side(len(means))
    blocks = -(-len(means) // side)
    padded = np.zeros((blocks * side, blocks * side))
    padded[: len(full), : len(full)] = full
    ends = np.zeros(blocks * side)
    ends[: len(means)] = means
    tiles = padded.reshape(blocks, side, blocks, side).swapaxes(1, 2)
    ends = ends.reshape(blocks, side)
    bi, bj = np.tril_indices(blocks)
    for at in range(0, len(bi), TILES_PER_BATCH):
        i, j = bi[at : at + TILES_PER_BATCH], bj[at : at + TILES_PER_BATCH]
        keys = [pa.array([g] * len(i), schema.field(k).type) for k, g in enumerate(group)]
        yield _tile_rows(keys, i, j, np.full(len(i), found.n), ends[i], ends[j], tiles[i, j].reshape(len(i), -1), schema)


def _tile_rows(keys: list[pa.Array], bi, bj, n, mi, mj, v, schema: pa.Schema) -> pa.RecordBatch:
    def lists(x: np.ndarray) -> pa.ListArray:
        bounds = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(x).ravel()))

    places = [pa.array(b.astype(np.int32)) for b in (bi, bj)]
    return pa.RecordBatch.from_arrays([*keys, *places, pa.array(n), lists(mi), lists(mj), lists(v)], schema=schema)


def partial_comoments(layout: BlockLayout, schema: pa.Schema):
    """The function for ``mapInArrow``: batches in, tiles of the task's co-moments out."""

    def run(batches):
        live: dict[tuple, CoMoments] = {}
        for batch in blocks(batches, layout.rows_per_block):
            batch = complete(batch, layout)
            if not batch.num_rows:
                continue
            dense, codes = dense_block(batch, layout)[:, 1:], code_block(batch, layout)
            spans = group_spans(batch, layout.groups)
            if codes.shape[1] == 0 and dense.shape[1] <= TILE and len(spans) * ROWS_PER_GROUP > len(dense):
                yield from small_groups(batch, layout.groups, dense, spans, schema)
                continue
            for group, rows in spans:
                if group not in live and len(live) >= layout.max_live:
                    # partials can be merged: what was emitted early is merged later
                    for done, found in live.items():
                        yield from tile_batches(done, found, schema)
                    live.clear()
                if group not in live:
                    live[group] = CoMoments(layout.dense_width - 1, layout.slot_widths)
                live[group].add(dense[rows], codes[rows])
        for group, found in live.items():
            yield from tile_batches(group, found, schema)

    return run


def small_groups(batch: pa.RecordBatch, names: tuple[str, ...], dense: np.ndarray, spans: list, schema: pa.Schema):
    """One tile for each group of a block, all at once: a row is a tile with n = 1 and no products."""
    order = np.concatenate([rows if isinstance(rows, np.ndarray) else np.arange(len(dense)) for _, rows in spans])
    sizes = [len(rows) if isinstance(rows, np.ndarray) else len(dense) for _, rows in spans]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):  # so many groups as have TILES_PER_BATCH rows, or one
        low = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, low + TILES_PER_BATCH, "right")))
        rows = order[low : int(ends[upto - 1])]
        starts = np.concatenate([[0], ends[at : upto - 1] - low]).astype(np.int64)
        x = dense[rows]
        n, mi, mj, v = merged_tiles(np.ones(len(rows)), x, x, np.zeros((len(rows), x.shape[1] ** 2)), starts)
        first = batch.select(list(names)).take(pa.array(rows[starts]))
        zeros = np.zeros(len(starts), np.int32)
        yield _tile_rows([first.column(k).cast(schema.field(k).type) for k in range(len(names))], zeros, zeros, n, mi, mj, v, schema)
        at = upto


def frequent_keys(keys: int, schema: pa.Schema):
    """The function for ``mapInArrow`` over rows (key…, number…): many rows of a key in a block become one.

    That one has their means and, in the struct ``_done``, a number of its own, n and their
    products. All other rows stay as they are, with a null there.
    """
    done_type = schema.field(len(schema) - 1).type

    def rows_of(batch: pa.RecordBatch, done: pa.Array) -> pa.RecordBatch:
        columns = [c.cast(schema.field(k).type) for k, c in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays([*columns, done], schema=schema)

    def run(batches):
        made = TaskContext.get().partitionId() << 40
        for batch in blocks(batches, ROWS_PER_BLOCK):
            codes = np.zeros(batch.num_rows, np.int64)
            for k in range(keys):
                coded = batch.column(k).dictionary_encode(null_encoding="encode")
                own = coded.indices.to_numpy(zero_copy_only=False)
                codes = np.unique(codes * len(coded.dictionary) + own, return_inverse=True)[1].ravel()
            often = np.bincount(codes)[codes] >= ROWS_PER_GROUP
            few = batch.filter(pa.array(~often))
            if few.num_rows:
                yield rows_of(few, pa.nulls(few.num_rows, done_type))
            if not often.any():
                continue
            rows = np.flatnonzero(often)
            rows = rows[np.argsort(codes[rows], kind="stable")]
            starts = np.flatnonzero(np.diff(codes[rows], prepend=-1))
            x = np.stack([numbers_of(c) for c in batch.columns[keys:]], axis=1)[rows]
            n, means, _, v = merged_tiles(np.ones(len(rows)), x, x, np.zeros((len(rows), x.shape[1] ** 2)), starts)
            ids = np.arange(made, made + len(starts))
            made += len(starts)
            values = [pa.array(a, done_type.field(i).type) for i, a in enumerate((ids, n, list(v)))]
            first = batch.take(pa.array(rows[starts]))
            one = pa.RecordBatch.from_arrays(
                [*first.columns[:keys], *(pa.array(np.ascontiguousarray(m)) for m in means.T)], names=batch.schema.names
            )
            yield rows_of(one, pa.StructArray.from_arrays(values, fields=list(done_type)))

    return run


def join_partials(groups: tuple[str, ...], size: int, schema: pa.Schema):
    """The function for ``mapInArrow`` over rows (group…, n, mi, v, z) of a join.

    A row stands for n rows with means mi and products v in the first columns and the
    same z in the others: a partial as good as any.
    """

    def run(batches):
        live: dict[tuple, CoMoments] = {}
        for batch in blocks(batches, TILES_PER_BATCH):
            n = numbers_of(batch.column("n"))
            means, inner, fixed = (
                batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1) if len(n) else None
                for c in ("mi", "v", "z")
            )
            for group, rows in group_spans(batch, groups):
                whole = np.concatenate([means[rows], fixed[rows]], axis=1)
                d = means.shape[1]
                total = np.zeros((size, size))
                total[:d, :d] = inner[rows].sum(axis=0).reshape(d, d)
                if group not in live and len(live) * size * size * 8 >= LIVE_BYTES:
                    for done, found in live.items():
                        yield from tile_batches(done, found, schema)
                    live.clear()
                live.setdefault(group, CoMoments(size, [])).add_parts(n[rows], whole, total)
        for group, found in live.items():
            yield from tile_batches(group, found, schema)

    return run


def merged_tiles(n: np.ndarray, mi: np.ndarray, mj: np.ndarray, v: np.ndarray, starts: np.ndarray):
    """(n, mi, mj, v) of each run of tiles, runs beginning at ``starts``.

    Σ over partials of their products, plus n·(their mean − the mean)(…)ᵀ.
    """
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(n))))
    total = np.add.reduceat(n, starts)

    def gaps(means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = means - means[starts][run]
        middle = np.add.reduceat(n[:, None] * away, starts) / total[:, None]
        return means[starts] + middle, away - middle[run]

    (mean_i, away_i), (mean_j, away_j) = gaps(mi), gaps(mj)
    between = (n[:, None] * away_i)[:, :, None] * away_j[:, None, :]
    return total, mean_i, mean_j, np.add.reduceat(v + between.reshape(v.shape), starts)


def merge_tiles(keys: int, schema: pa.Schema):
    """The function for ``mapInArrow`` that merges tiles sorted by their first ``keys`` columns.

    One row per key is held, whatever the number of partials.
    """

    def arrays(table: pa.RecordBatch):
        n = table.column("n").to_numpy(zero_copy_only=False)
        lists = [table.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("mi", "mj", "v")]
        return n, *(x.reshape(len(n), -1) for x in lists)

    def run(batches):
        held: pa.RecordBatch | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, TILES_PER_BATCH):
                part = batch.slice(at, TILES_PER_BATCH)
                if held is not None:
                    part = pa.Table.from_batches([held, part.cast(schema)]).combine_chunks().to_batches()[0]
                starts = [0]
                if part.num_rows > 1:
                    changed = np.zeros(part.num_rows - 1, bool)
                    for k in range(keys):
                        codes = part.column(k).dictionary_encode(null_encoding="encode").indices
                        codes = codes.to_numpy(zero_copy_only=False)
                        changed |= codes[1:] != codes[:-1]
                    starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
                starts = np.asarray(starts, np.int64)
                done = merged_tiles(*arrays(part), starts)
                rows = part.take(pa.array(starts))
                places = (rows.column(k).to_numpy() for k in (keys - 2, keys - 1))
                found = _tile_rows([rows.column(k) for k in range(keys - 2)], *places, *done, schema)
                # the last key may go on
                held = found.slice(len(starts) - 1)
                if len(starts) > 1:
                    yield found.slice(0, len(starts) - 1)
        if held is not None:
            yield held

    return run
