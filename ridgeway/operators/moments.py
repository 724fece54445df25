"""Second moments Σzzᵀ of a table, z = [1, features, label], per group.

Everything a least-squares model needs (n, Σx, XᵀX, Xᵀy, yᵀy) is one additive
matrix per group, so folds can be added and subtracted, and neither the penalty
grid, nor standardisation, nor PCA needs another pass over the rows.

Two forms: co-moments (n, means, products about the means), which fits use, and
sums about zero. Co-moments of a group are those of its parts merged pairwise:
the parts' products, plus n·n'/(n+n') times the product of the mean
differences. Each part is about its own rows' means, so a column far from zero
keeps its digits in every group, wherever the other groups lie, and a column
that does not vary has a spread of exactly 0.

Two plans compute the same:

* few plain numeric columns: native aggregates, ``covar_pop`` (which Spark keeps
  about running means) or ``sum(a*b)`` per product;
* otherwise: numpy partials per task, then a merge of sorted tiles, or a native
  sum of packed rows.

In both, each task reduces its rows to fixed-size partials before the shuffle,
so a group that holds most of the rows costs no task more than another.

Both skip a row with a null among the numbers, vectors or the label (a null
ordinal or categorical is a value of its own), as a fit on the complete rows
does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ridgeway.operators import partials, solvers
from ridgeway.sources.stage import reused

# executors need not have this package installed
for module in (partials, solvers):
    cloudpickle.register_pickle_by_value(module)

# 12 columns make 91 sums; past 100 fields (spark.sql.codegen.maxFields) Spark
# gives up whole-stage code, and the numpy plan is faster
NATIVE_MAX_COLUMNS = 12
# 5 columns make 15 covariances of four buffers, 5 means and 10 bounds: 81 fields
NATIVE_MAX_CENTRED = 5
# the p×p matrix is solved on the driver; beyond it an iterative solver is used
MAX_WIDTH = 8192
# partial matrices that may reach the shuffle: some per core, or this volume
TASKS_PER_CORE = 4
PARTIAL_BYTES = 256 << 30
# more tasks than any scan has: no bound is needed
MANY_TASKS = 1_000_000
# packed sums that one collect may bring to the driver, and matrices it may hold
COLLECT_BYTES = 256 << 20
HELD_BYTES = 16 << 30


@dataclass(frozen=True)
class Design:
    """How the columns of a table become model features.

    ``arrays`` are (column, width) of fixed-width vectors, ``numericals`` plain
    numbers, ``ordinals`` columns replaced by their label's rank, and
    ``categoricals`` one-hot columns. ``labels`` holds the rank order of each
    ordinal and categorical; a null or unseen value ranks last as an ordinal
    and is all zeros as a categorical.
    """

    numericals: tuple[str, ...] = ()
    ordinals: tuple[str, ...] = ()
    categoricals: tuple[str, ...] = ()
    arrays: tuple[tuple[str, int], ...] = ()
    labels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @cached_property
    def terms(self) -> tuple[str, ...]:
        """Feature names in order."""
        wide = [f"{c}[{i}]" for c, w in self.arrays for i in range(w)]
        slots = [f"{c}={v}" for c in self.categoricals for v in self.labels[c]]
        return (*wide, *self.numericals, *self.ordinals, *slots)

    @property
    def columns(self) -> list[str]:
        return [*(c for c, _ in self.arrays), *self.numericals, *self.ordinals, *self.categoricals]


@dataclass(frozen=True)
class Moments:
    """Σzzᵀ over [1, features…] or [1, features…, label], kept about a pivot.

    Co-moments are the case where the pivot is the mean, so that row 0 is (n, 0, …).
    """

    terms: tuple[str, ...]
    about: np.ndarray
    has_label: bool = True
    # 0 for the leading 1
    pivot: np.ndarray | None = None

    @classmethod
    def of_comoments(
        cls, terms: tuple[str, ...], n: float, means: np.ndarray, centred: np.ndarray, has_label: bool = True
    ) -> Moments:
        about = np.zeros((len(means) + 1, len(means) + 1))
        about[0, 0], about[1:, 1:] = n, centred
        return cls(terms, about, has_label, np.append(0.0, means))

    def __add__(self, other: Moments) -> Moments:
        """Moments of the rows of both: about their common pivot, else about the mean of all."""
        return self._with(other, 1.0)

    def __sub__(self, other: Moments) -> Moments:
        """Moments of the rows that ``other`` leaves. Merging the other parts keeps more digits."""
        return self._with(other, -1.0)

    def _with(self, other: Moments, sign: float) -> Moments:
        if np.array_equal(self._offsets, other._offsets):
            return Moments(self.terms, self.about + sign * other.about, self.has_label, self.pivot)
        n = self.n + sign * other.n
        if not n:
            return Moments(self.terms, np.zeros_like(self.about), self.has_label, self.pivot)
        gap = other._middle - self._middle
        pivot = self._middle + gap * (sign * other.n / n)
        pivot[0] = 0.0
        return Moments(self.terms, self._moved(pivot) + sign * other._moved(pivot), self.has_label, pivot)

    def _moved(self, pivot: np.ndarray) -> np.ndarray:
        """The sums about another pivot."""
        gap = self._offsets - pivot
        shift = np.outer(gap, self.about[0])
        return self.about + shift + shift.T + np.outer(gap, gap) * self.about[0, 0]

    @property
    def _middle(self) -> np.ndarray:
        """Means, and 0 for the leading 1."""
        if not self.n:
            return self._offsets
        return self._offsets + np.append(0.0, self.about[0, 1:] / self.n)

    @property
    def _offsets(self) -> np.ndarray:
        return np.zeros(len(self.about)) if self.pivot is None else self.pivot

    @property
    def p(self) -> int:
        return len(self.terms)

    @property
    def n(self) -> float:
        return float(self.about[0, 0])

    @cached_property
    def matrix(self) -> np.ndarray:
        """The sums about zero."""
        return self.about if self.pivot is None else self._moved(np.zeros(len(self.about)))

    @property
    def gram(self) -> np.ndarray:
        """XᵀX with the intercept in row and column 0."""
        return self.matrix[: self.p + 1, : self.p + 1]

    @property
    def xty(self) -> np.ndarray:
        return self.matrix[: self.p + 1, -1]

    @cached_property
    def _centring(self) -> tuple[np.ndarray, np.ndarray]:
        if self.pivot is None:
            return solvers.centre(self.about)
        middle = self.about[0, 1:] / self.n
        return self.pivot[1:] + middle, self.about[1:, 1:] - self.n * np.outer(middle, middle)

    @property
    def means(self) -> np.ndarray:
        """Means of features (and label, last)."""
        return self._centring[0]

    @property
    def centred(self) -> np.ndarray:
        """Σ(z−z̄)(z−z̄)ᵀ over features (and label, last)."""
        return self._centring[1]

    @cached_property
    def covariance(self) -> np.ndarray:
        """Sample covariance of the features."""
        return self.centred[: self.p, : self.p] / (self.n - 1)

    @cached_property
    def std(self) -> np.ndarray:
        """Sample standard deviation of the features."""
        return np.sqrt(np.diag(self.covariance))


class MomentTable:
    """The (lazy) moments of every group: a table of the group and packed numbers.

    ``packed`` holds rows of 64 sums about zero (chunk, v), or with ``side`` tiles of
    co-moments (bi, bj, n, mi, mj, v) with the means of their rows and columns.
    """

    def __init__(
        self,
        packed: DataFrame,
        by: Sequence[str],
        terms: tuple[str, ...],
        has_label: bool,
        size: int | None = None,
        keep: np.ndarray | None = None,
        side: int | None = None,
    ):
        self.packed = packed
        self.by = list(by)
        self.terms = terms
        self.has_label = has_label
        self.side = side
        # side of the packed matrix, and which of its rows make the model's matrix
        self._size = size or len(terms) + has_label + (side is None)
        self._keep = keep

    def collect(self) -> dict[tuple, Moments]:
        """Moments per group value. A group is one matrix, whatever its rows.

        Only for groupings of known, small size (folds): more than the driver may
        hold is an error. For many groups use :meth:`entries` or the grouped
        solver. Wide matrices come one by one.
        """
        if not self.by:
            return self._fetch(self.packed)
        if 4 * self._size**2 * 8 <= COLLECT_BYTES:
            row = partials.CHUNK if self.side is None else self.side * (self.side + 2)
            most = max(1, COLLECT_BYTES // (8 * row))
            return self._fetch(self.packed.limit(most + 1), most)
        most = max(8, HELD_BYTES // (8 * self._size**2))
        with reused(self.packed) as packed:
            groups = packed.select(*self.by).distinct().limit(most + 1).collect()
            if len(groups) > most:
                raise ValueError(f"more than {most} matrices of side {self._size}")
            found: dict[tuple, Moments] = {}
            for group in groups:
                same = [F.col(c).eqNullSafe(F.lit(group[c])) for c in self.by]
                found |= self._fetch(packed.filter(reduce(and_, same)))
            return found

    def _fetch(self, packed: DataFrame, most: int | None = None) -> dict[tuple, Moments]:
        numbers = ["chunk", "v"] if self.side is None else ["bi", "bj", "n", "mi", "v"]
        fetched = packed.select(*self.by, *numbers).toArrow().combine_chunks()
        if most is not None and fetched.num_rows > most:
            raise ValueError(f"the groups hold more than {COLLECT_BYTES} bytes of sums")
        groups = list(zip(*(fetched.column(c).to_pylist() for c in self.by)))
        groups = groups or [()] * fetched.num_rows
        members: dict[tuple, list[int]] = {}
        for at, group in enumerate(groups):
            members.setdefault(group, []).append(at)
        one = self._summed if self.side is None else self._merged
        return {group: one(fetched.take(pa.array(rows))) for group, rows in members.items()}

    def _summed(self, rows: pa.Table) -> Moments:
        order = np.argsort(rows.column("chunk").to_numpy())
        packed = _flat(rows.column("v").take(pa.array(order)))
        size = self._size
        total = np.zeros((size, size))
        total[np.tril_indices(size)] = packed[: size * (size + 1) // 2]
        total = np.tril(total) + np.tril(total, -1).T
        if self._keep is not None:
            total = total[np.ix_(self._keep, self._keep)]
        return Moments(self.terms, total, self.has_label)

    def _merged(self, rows: pa.Table) -> Moments:
        bi, bj = (rows.column(c).to_numpy() for c in ("bi", "bj"))
        mi, v = (_flat(rows.column(c)).reshape(len(bi), -1) for c in ("mi", "v"))
        means, centred = solvers.tiled(bi, bj, mi, v, self._size)
        if self._keep is not None:
            means, centred = means[self._keep], centred[np.ix_(self._keep, self._keep)]
        return Moments.of_comoments(self.terms, float(rows.column("n")[0].as_py()), means, centred, self.has_label)

    def named(self, entries: DataFrame, intercept: str = "(intercept)", label: str = "y") -> DataFrame:
        """Entries with the names of their terms instead of positions."""
        names = [*([intercept] if self.side is None else []), *self.terms, *([label] if self.has_label else [])]
        # as many rows as the matrix has: a table that Spark broadcasts by its size
        known = entries.sparkSession.createDataFrame(list(enumerate(names)), "at int, term string")
        for side in ("i", "j"):
            term = known.select(F.col("at").alias(side), F.col("term").alias(f"term_{side}"))
            entries = entries.join(term, side)
        return entries.drop("i", "j")

    def entries(self) -> DataFrame:
        """(group…, i, j, value) of the upper triangle, i ≤ j. Stays distributed.

        Of sums about zero, where 0 is the intercept; or of co-moments, with the group's n
        beside each, where 0 is the first feature.
        """
        if self.side is not None:
            return self._tile_entries()
        size = self._size
        flat = self.packed.select(
            *self.by, "chunk", F.posexplode("v").alias("pos", "value")
        ).withColumn("k", F.col("chunk").cast("long") * F.lit(partials.CHUNK) + F.col("pos"))
        # the k-th packed entry stands in row j, the largest j with j(j+1)/2 <= k
        guess = F.floor((F.sqrt(8.0 * F.col("k") + 1.0) - 1.0) / 2.0).cast("long")
        start = lambda j: F.shiftright(j * (j + 1), 1)
        j = guess + F.when(start(guess + 1) <= F.col("k"), 1).when(
            start(guess) > F.col("k"), -1
        ).otherwise(0)
        found = (
            flat.filter(F.col("k") < size * (size + 1) // 2)
            .withColumn("j", j)
            .withColumn("i", F.col("k") - start(F.col("j")))
        )
        return self._placed(found).select(*self.by, "i", "j", "value")

    def _tile_entries(self) -> DataFrame:
        side, size = self.side, self._size
        flat = self.packed.select(*self.by, "bi", "bj", "n", F.posexplode("v").alias("pos", "value"))
        # a tile's rows are later than its columns
        later, earlier = F.col("bi") * side + F.floor(F.col("pos") / side), F.col("bj") * side + F.col("pos") % side
        found = flat.withColumns({"j": later, "i": earlier})
        found = found.filter((F.col("i") <= F.col("j")) & (F.col("j") < size))
        return self._placed(found).select(*self.by, "n", "i", "j", "value")

    def _placed(self, found: DataFrame) -> DataFrame:
        """Positions in the model's order, entries of unknown slots left out."""
        if self._keep is None:
            return found.withColumns({c: F.col(c).cast("int") for c in ("i", "j")})
        place = np.full(self._size, -1)
        place[self._keep] = np.arange(len(self._keep))
        table = F.lit(place)  # one literal, whatever the width
        at = [F.element_at(table, F.col(c).cast("int") + 1) for c in ("i", "j")]
        found = found.withColumns({"_a": at[0], "_b": at[1]}).filter("_a >= 0 and _b >= 0")
        return found.withColumns({"i": F.least("_a", "_b").cast("int"), "j": F.greatest("_a", "_b").cast("int")})


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def moments(
    df: DataFrame,
    design: Design,
    label: str | None = None,
    by: Sequence[str] = (),
    plan: str = "auto",
    centred: bool = True,
) -> MomentTable:
    """Moments over the complete rows of each group.

    ``plan`` is 'native', 'arrow' or 'auto'. ``centred``: co-moments, which keep all
    digits of fits; else sums about zero. Either is one pass without a job before it.
    """
    plain = not design.arrays and not design.ordinals and not design.categoricals
    width = len(design.terms)
    if width > MAX_WIDTH:
        raise ValueError(f"{width} features exceed {MAX_WIDTH}, the largest solvable Gram matrix")
    if plan == "auto":
        most = NATIVE_MAX_CENTRED if centred else NATIVE_MAX_COLUMNS
        plan = "native" if plain and len(design.numericals) + (label is not None) <= most else "arrow"
    if plan == "native" and not plain:
        raise ValueError("the native plan takes plain numeric columns only")
    whole = [c for c, _ in design.arrays] + [*design.numericals, *([label] if label else [])]
    if whole:
        df = df.filter(reduce(and_, (F.col(c).isNotNull() for c in whole)))
    if plan == "native":
        return (_native_centred if centred else _native)(df, design, label, by)
    return _arrow(df, design, label, by, centred)


def native_sums(columns: Sequence[str]) -> list[F.Column]:
    """``sum(a*b)`` for the lower triangle over [1, columns…], row by row."""
    z = [F.lit(1.0), *(F.col(c).cast("double") for c in columns)]
    return [F.sum(z[r] * z[c]) for r in range(len(z)) for c in range(r + 1)]


def _native_centred(df: DataFrame, design: Design, label: str | None, by: Sequence[str]) -> MomentTable:
    """One tile per group from Spark's covariances, which are merged as co-moments."""
    columns = [F.col(c).cast("double") for c in (*design.numericals, *([label] if label else []))]
    size = len(columns)
    pairs = [(r, c) for r in range(size) for c in range(r + 1)]
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        *(F.covar_pop(columns[r], columns[c]).alias(f"_s{r}_{c}") for r, c in pairs),
        *(F.avg(x).alias(f"_m{i}") for i, x in enumerate(columns)),
        *(F.min(x).alias(f"_low{i}") for i, x in enumerate(columns)),
        *(F.max(x).alias(f"_high{i}") for i, x in enumerate(columns)),
    )
    # running means of equal numbers differ in the last digit: only the bounds tell a constant
    same = [F.col(f"_low{i}") == F.col(f"_high{i}") for i in range(size)]
    means = F.array(*(F.when(same[i], F.col(f"_low{i}")).otherwise(F.col(f"_m{i}")) for i in range(size)))

    def product(r: int, c: int) -> F.Column:
        r, c = max(r, c), min(r, c)
        return F.when(same[r] | same[c], 0.0).otherwise(F.col("_n") * F.col(f"_s{r}_{c}"))

    v = F.array(*(product(r, c) for r in range(size) for c in range(size)))
    # an empty table without groups makes a row of nulls; as co-moments it is no row
    packed = wide.filter("_n > 0").select(
        *by, F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.col("_n").alias("n"), means.alias("mi"), means.alias("mj"), v.alias("v")
    )
    return MomentTable(packed, by, design.terms, label is not None, side=size)


def _native(df: DataFrame, design: Design, label: str | None, by: Sequence[str]) -> MomentTable:
    sums = native_sums([*design.numericals, *([label] if label else [])])
    wide = df.groupBy(*by).agg(*(s.alias(f"s{k}") for k, s in enumerate(sums)))
    # the sums of an empty table are null; as a matrix they are zero
    numbers = [F.coalesce(F.col(f"s{k}"), F.lit(0.0)) for k in range(len(sums))]
    step = partials.CHUNK
    numbers += [F.lit(0.0)] * (-len(numbers) % step)
    rows = F.array(*(F.array(*numbers[at : at + step]) for at in range(0, len(numbers), step)))
    packed = wide.select(*by, F.posexplode(rows).alias("chunk", "v"))
    return MomentTable(packed, by, design.terms, label is not None)


def _arrow(df: DataFrame, design: Design, label: str | None, by: Sequence[str], centred: bool) -> MomentTable:
    fields = {f.name: f for f in df.schema.fields}
    matrix_bytes = 8 * (len(design.terms) + len(design.categoricals) + 2) ** 2
    groups = tuple(f"_group{i}" for i in range(len(by)))
    layout = partials.BlockLayout(
        groups=groups,
        arrays=design.arrays,
        scalars=design.numericals,
        ordinals=design.ordinals,
        categoricals=design.categoricals,
        label="_label" if label else None,
        labels={c: tuple(design.labels[c]) for c in (*design.ordinals, *design.categoricals)},
        max_live=max(1, partials.LIVE_BYTES // matrix_bytes),
        pivot=np.zeros(1),
    )
    keep = _model_order(layout)
    wanted = [_group_column(b, fields[b].dataType).alias(g) for b, g in zip(by, groups)]
    if label:
        wanted.append(F.col(label).cast("double").alias("_label"))
    for c in design.columns:
        wanted.append(_task_column(c, fields[c].dataType, c in layout.labels).alias(c))
    rows = df.select(*wanted)

    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(TASKS_PER_CORE * cores, PARTIAL_BYTES // matrix_bytes)
    if tasks < MANY_TASKS:
        # a wide matrix costs the shuffle as much from a small task as from a large
        # one; this merges tasks without moving a row
        rows = rows.coalesce(tasks)
    if by and layout.max_live < 8:
        # wide matrices: meet one group after the other, so that few are live
        rows = rows.sortWithinPartitions(*groups)

    if centred:
        schema = _tile_schema([fields[b] for b in by], groups)
        tiles = rows.mapInArrow(partials.partial_comoments(layout, to_arrow_schema(schema)), schema)
        keep = None if keep is None else keep[1:] - 1
        return _merged_table(tiles, by, groups, schema, design.terms, label is not None, layout.size - 1, keep)
    keyed = [StructField(g, fields[b].dataType) for g, b in zip(groups, by)]
    named = [F.col(g).alias(b) for g, b in zip(groups, by)]
    value_names = [f"v{i}" for i in range(partials.CHUNK)]
    values = [StructField(v, DoubleType()) for v in value_names]
    schema = StructType([*keyed, StructField("chunk", IntegerType()), *values])
    summed = (
        rows.mapInArrow(partials.partial_sums(layout, to_arrow_schema(schema)), schema)
        .groupBy(*groups, "chunk")
        .agg(*(F.sum(v).alias(v) for v in value_names))
    )
    packed = summed.select(*named, "chunk", F.array(*value_names).alias("v"))
    return MomentTable(packed, by, design.terms, label is not None, layout.size, keep)


def _tile_schema(by: Sequence[StructField], groups: Sequence[str]) -> StructType:
    keyed = [StructField(g, b.dataType) for g, b in zip(groups, by)]
    places = [StructField(c, IntegerType()) for c in ("bi", "bj")]
    lists = [StructField(c, ArrayType(DoubleType())) for c in ("mi", "mj", "v")]
    return StructType([*keyed, *places, StructField("n", DoubleType()), *lists])


def _merged_table(
    tiles: DataFrame,
    by: Sequence[str],
    groups: Sequence[str],
    schema: StructType,
    terms: tuple[str, ...],
    has_label: bool,
    size: int,
    keep: np.ndarray | None,
) -> MomentTable:
    """The partial tiles of tasks, merged: tiles of one place meet sorted, one at a time."""
    keys = [*groups, "bi", "bj"]
    merged = (
        tiles.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(partials.merge_tiles(len(keys), to_arrow_schema(schema)), schema)
    )
    named = [F.col(g).alias(b) for g, b in zip(groups, by)]
    packed = merged.select(*named, "bi", "bj", "n", "mi", "mj", "v")
    return MomentTable(packed, by, terms, has_label, size, keep, partials.tile_side(size))


def moments_over_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    numericals: Sequence[str],
    label: str | None = None,
    by: Sequence[str] = (),
) -> MomentTable:
    """Co-moments of ``many ⋈ one`` without joining the rows of ``many``.

    They are reduced to (n, means, products) per key, which is what meets the rows of
    ``one``: their columns are the same in all n rows, so each pair is a partial like a
    task's. A column, label or group that both sides have is taken from ``many``. Keys
    may repeat in ``one``. What is shuffled of ``many`` are its rows, only the columns
    needed, as most keys have few in a task; a key with many is reduced before. More than
    ``NATIVE_MAX_CENTRED`` columns of ``many`` (or ``partials.TILE``) would make keys larger
    than their rows: then the tables are joined, as they are where a key is nested.
    """
    columns = [*numericals, *([label] if label else [])]
    ours = [c for c in columns if c in many.columns]
    theirs = [c for c in columns if c not in many.columns]
    nested = any(isinstance(f.dataType, ArrayType | StructType) for f in many.select(*on).schema)
    if len(ours) > min(partials.TILE, NATIVE_MAX_CENTRED) or nested:
        kept = [c for c in one.columns if c in on or c not in many.columns]
        return moments(many.join(one.select(*kept), list(on)), Design(numericals=tuple(numericals)), label, by)
    keys = [*on, *(b for b in by if b in many.columns and b not in on)]
    if ours:
        sums = _per_key(many, on, keys, ours)
    else:
        nothing = F.array().cast("array<double>")
        sums = many.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"))
        sums = sums.select(*keys, "n", nothing.alias("mi"), nothing.alias("v"))
    kept = [b for b in by if b not in keys]
    z = F.array(*(F.col(c).cast("double") for c in theirs)) if theirs else F.array().cast("array<double>")
    rows = one.filter(reduce(and_, (F.col(c).isNotNull() for c in (*on, *theirs))))
    joined = sums.select(*keys, "n", "mi", "v").join(rows.select(*on, *kept, z.alias("z")), list(on))
    groups = tuple(f"_group{i}" for i in range(len(by)))
    fields = {f.name: f for f in joined.schema.fields}
    named = [_group_column(b, fields[b].dataType).alias(g) for b, g in zip(by, groups)]
    schema = _tile_schema([fields[b] for b in by], groups)
    size = len(columns)
    task = partials.join_partials(groups, size, to_arrow_schema(schema))
    tiles = joined.select(*named, "n", "mi", "v", "z").mapInArrow(task, schema)
    # tiles hold the columns of ``many`` first
    at = {c: i for i, c in enumerate([*ours, *theirs])}
    keep = np.array([at[c] for c in columns])
    return _merged_table(tiles, by, groups, schema, tuple(numericals), label is not None, size, keep)


def _thinned(many: DataFrame, keys: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """(key…, _x0…, _done): complete rows, or (``_done`` not null) the sums of many rows of a key."""
    rows = many.filter(reduce(and_, (F.col(c).isNotNull() for c in numbers)))
    rows = rows.select(*keys, *(F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(numbers)))
    done = StructType([StructField("part", LongType()), StructField("n", DoubleType()), StructField("v", ArrayType(DoubleType()))])
    schema = StructType([*rows.schema.fields, StructField("_done", done)])
    return rows.mapInArrow(partials.frequent_keys(len(keys), to_arrow_schema(schema)), schema)


def _per_key(many: DataFrame, on: Sequence[str], keys: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """(key…, n, mi, v) of the rows that can be joined; a row for each key, and more for one with many rows.

    Rows are shuffled by ``on``, and aggregated and joined where they are then: sums of a few
    rows would be several times as large as those rows.
    """
    rows = many.filter(reduce(and_, (F.col(c).isNotNull() for c in on)))
    rows = _thinned(rows, keys, numbers).repartition(*on)
    design = Design(numericals=tuple(f"_x{i}" for i in range(len(numbers))))
    sums = moments(rows, design, by=[*keys, "_done"]).packed
    n = F.col("n") * F.coalesce(F.col("_done.n"), F.lit(1.0))
    return sums.select(*keys, n.alias("n"), "mi", F.coalesce(F.col("_done.v"), F.col("v")).alias("v"))


def _group_column(name: str, dtype) -> F.Column:
    """The group's value; -0.0 is 0.0, as it is to Spark's own grouping."""
    return F.col(name) + F.lit(0).cast(dtype) if isinstance(dtype, DoubleType | FloatType) else F.col(name)


def _task_column(name: str, dtype, coded: bool) -> F.Column:
    """The column as a task reads it: codes from integers or strings, else doubles."""
    if isinstance(dtype, VectorUDT):
        return vector_to_array(F.col(name))
    if isinstance(dtype, ArrayType):
        return F.col(name).cast("array<double>")
    if not coded:
        return F.col(name).cast("double")
    if isinstance(dtype, IntegralType | StringType):
        return F.col(name)
    return F.col(name).cast("string")


def _model_order(layout: partials.BlockLayout) -> np.ndarray | None:
    """Positions of [1, features…, label] in the task's matrix, unknown slots left out."""
    if not layout.categoricals:
        return None
    d = layout.dense_width
    features = list(range(1, d - (layout.label is not None)))
    at = d
    for width in layout.slot_widths:
        features += range(at, at + width - 1)
        at += width
    return np.array([0, *features, *([d - 1] if layout.label else [])])


def vector_sum(df: DataFrame, column: str) -> DataFrame:
    """(position, total): the elementwise sum of an array column of any widths.

    Tasks add up per position before the shuffle. A position that some rows do
    not have sums over those that do.
    """
    cells = df.select(F.posexplode(F.col(column).cast("array<double>")).alias("position", "x"))
    return cells.groupBy("position").agg(F.sum("x").alias("total"))


def row_widths(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(group…, n, width, least_width): rows, and the widest and narrowest vector of each group."""
    size = F.when(F.col(column).isNotNull(), F.size(column)).cast("long")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.max(size).alias("width"), F.min(size).alias("least_width")
    )
