from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ridgeway.operators import moments as ops
from ridgeway.operators.encode import fit_labels
from ridgeway.operators.moments import Design, moments

COLUMNS = ("a", "b", "c")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(5, 3, (500, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(0, 1, 500)
    fold = rng.integers(0, 4, 500)
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int")
    return df.repartition(3).cache(), x, y, fold


def expected(x, y):
    z = np.column_stack([np.ones(len(x)), x, y])
    return z.T @ z


@pytest.mark.parametrize("plan", ["native", "arrow"])
def test_both_plans_match_numpy(data, plan):
    df, x, y, fold = data
    found = moments(df, Design(numericals=COLUMNS), "y", by=["fold"], plan=plan).collect()
    assert sorted(found) == [(0,), (1,), (2,), (3,)]
    for (k,), m in found.items():
        assert np.allclose(m.matrix, expected(x[fold == k], y[fold == k]), rtol=1e-12)
        assert m.n == (fold == k).sum()


def test_folds_add_up(data):
    df, x, y, _ = data
    folds = moments(df, Design(numericals=COLUMNS), "y", by=["fold"]).collect().values()
    whole = moments(df, Design(numericals=COLUMNS), "y").collect()[()]
    assert np.allclose(sum(m.matrix for m in folds), whole.matrix, rtol=1e-12)
    first, *_ = folds
    assert np.allclose((whole - first).matrix, whole.matrix - first.matrix)


@pytest.mark.parametrize("partitions", [1, 2, 9])
def test_partitions_do_not_matter(data, partitions):
    df, x, y, _ = data
    design = Design(numericals=COLUMNS)
    m = moments(df.repartition(partitions), design, "y", plan="arrow").collect()[()]
    assert np.allclose(m.matrix, expected(x, y), rtol=1e-12)


@pytest.mark.parametrize("plan", ["native", "arrow"])
def test_entries_are_the_upper_triangle(data, plan):
    df, x, y, _ = data
    entries = moments(df, Design(numericals=COLUMNS), "y", plan=plan, centred=False).entries().collect()
    want = expected(x, y)
    assert len(entries) == 15
    for r in entries:
        assert r.i <= r.j and r.value == pytest.approx(want[r.i, r.j])


def test_wide_native_sums_span_chunks(data):
    df, x, y, _ = data
    wide = df.select("y", *(F.col("a") * i + F.col("b") for i in range(1, 13)))
    wide = wide.toDF("y", *(f"x{i}" for i in range(12)))
    design = Design(numericals=tuple(wide.columns[1:]))
    native = moments(wide, design, "y", plan="native", centred=False)
    arrow = moments(wide, design, "y", plan="arrow")
    assert native.packed.count() == 2
    assert np.allclose(native.collect()[()].matrix, arrow.collect()[()].matrix, rtol=1e-12)


def test_groups_of_any_type(spark):
    rows = [("u", 1, 1.0), ("u", 2, 2.0), (None, 1, 3.0), ("v", None, 4.0), ("v", None, 5.0)]
    df = spark.createDataFrame(rows, "g string, h int, a double")
    design = Design(numericals=("a",))
    for by in (["g"], ["h"], ["g", "h"], ["h", "g"]):
        native = moments(df, design, by=by, plan="native").collect()
        arrow = moments(df, design, by=by, plan="arrow").collect()
        assert native.keys() == arrow.keys()
        for k in native:
            assert np.allclose(native[k].matrix, arrow[k].matrix)


def test_vectors_and_arrays(spark):
    rows = [(Vectors.dense(1, 2), [1.0, 2.0], 3.0), (Vectors.sparse(2, [1], [4.0]), [0.0, 4.0], 5.0)]
    df = spark.createDataFrame(rows, ["v", "w", "y"])
    v = moments(df, Design(arrays=(("v", 2),)), "y").collect()[()]
    w = moments(df, Design(arrays=(("w", 2),)), "y").collect()[()]
    assert np.allclose(v.matrix, w.matrix)
    assert v.terms == ("v[0]", "v[1]")


def test_a_vector_of_another_width_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    with pytest.raises(Exception, match="exactly 2 numbers"):
        moments(df, Design(arrays=(("v", 2),))).collect()


def coded_frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = [
        (
            float(rng.normal()),
            None if rng.random() < 0.1 else f"s{rng.integers(0, 5)}",
            None if rng.random() < 0.1 else int(rng.integers(10, 14)),
            None if rng.random() < 0.1 else float(rng.integers(0, 3)) / 2,
            int(rng.integers(0, 3)),
            float(rng.normal()),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "x double, s string, i int, d double, part int, y double")


def dense_rows(rows, design):
    out = []
    for r in rows:
        values = [1.0, *(r[c] for c in design.numericals)]
        for c in design.ordinals:
            labels = design.labels[c]
            text = None if r[c] is None else str(r[c])
            values.append(float(labels.index(text)) if text in labels else float(len(labels)))
        for c in design.categoricals:
            text = None if r[c] is None else str(r[c])
            values += [1.0 if text == v else 0.0 for v in design.labels[c]]
        out.append([*values, r["y"]])
    return np.array(out)


@pytest.mark.parametrize("live_bytes, block_rows", [(1 << 20, 32768), (1, 32768), (1 << 20, 7)])
def test_one_hot_sums_match_dense_ones(spark, monkeypatch, live_bytes, block_rows):
    monkeypatch.setattr(ops.partials, "LIVE_BYTES", live_bytes)
    monkeypatch.setattr(ops.partials, "ROWS_PER_BLOCK", block_rows)
    df = coded_frame(spark).repartition(3)
    known = df.filter("s <> 's3' OR s IS NULL")  # s3 is unseen
    design = Design(("x",), ("i",), ("s", "d"), labels=fit_labels(known, ["s", "i", "d"]))
    found = moments(df, design, "y", by=["part"]).collect()
    for (part,), m in found.items():
        z = dense_rows(df.filter(F.col("part") == part).collect(), design)
        assert np.allclose(m.matrix, z.T @ z, rtol=1e-12)
        assert len(m.terms) == z.shape[1] - 2


def test_many_live_groups_are_emitted_early(spark, monkeypatch):
    monkeypatch.setattr(ops.partials, "LIVE_BYTES", 8 * 9 * 9)
    df = spark.range(1000).select((F.col("id") % 37).alias("g"), F.col("id").cast("double").alias("a"))
    found = moments(df, Design(numericals=("a",)), by=["g"], plan="arrow").collect()
    assert len(found) == 37
    for (g,), m in found.items():
        ids = np.arange(g, 1000, 37)
        assert m.n == len(ids) and m.matrix[1, 1] == pytest.approx((ids**2).sum())


def test_wide_sums_are_fetched_group_by_group(data, monkeypatch):
    df, x, y, fold = data
    design = Design(numericals=COLUMNS)
    at_once = moments(df, design, "y", by=["fold"], plan="arrow").collect()
    monkeypatch.setattr(ops, "COLLECT_BYTES", 1)
    one_by_one = moments(df, design, "y", by=["fold"], plan="arrow").collect()
    assert at_once.keys() == one_by_one.keys()
    for k in at_once:
        assert np.allclose(at_once[k].matrix, one_by_one[k].matrix, rtol=1e-13)


def test_wide_sums_merge_tasks(data, monkeypatch):
    df, x, y, _ = data
    monkeypatch.setattr(ops, "PARTIAL_BYTES", 1)
    monkeypatch.setattr(ops, "TASKS_PER_CORE", 1)
    m = moments(df.repartition(40), Design(numericals=COLUMNS), "y", plan="arrow")
    assert "Coalesce" in m.packed._jdf.queryExecution().executedPlan().toString()
    assert np.allclose(m.collect()[()].matrix, expected(x, y), rtol=1e-12)


def test_constant_columns_have_no_spread(spark):
    df = spark.range(1000).select(F.lit(5.1).alias("a"), F.col("id").cast("double").alias("b"), F.lit(3.3).alias("y"))
    m = moments(df, Design(numericals=("a", "b")), "y").collect()[()]
    assert m.std[0] == 0.0 and m.std[1] > 0
    assert m.centred[2, 2] == 0.0


def test_one_nan_marks_its_sums_only(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 3.0)], "a double, b double")
    for plan in ("native", "arrow"):
        m = moments(df, Design(numericals=("a", "b")), plan=plan).collect()[()]
        assert np.isnan(m.matrix[1, 1]) and m.matrix[2, 2] == 13.0


def test_too_wide_a_design_is_refused(spark, monkeypatch):
    monkeypatch.setattr(ops, "MAX_WIDTH", 2)
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    with pytest.raises(ValueError, match="exceed"):
        moments(df, Design(numericals=COLUMNS))


def test_vector_sum(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "v array<float>")
    assert [tuple(r) for r in ops.vector_sum(df, "v").orderBy("position").collect()] == [(0, 4.0), (1, 6.0)]


def test_blocks_hold_every_row_once():
    batches = [pa.RecordBatch.from_pydict({"v": list(range(a, a + n))}) for a, n in [(0, 3), (3, 1), (4, 9), (13, 2)]]
    for rows in (1, 4, 5, 100):
        found = list(ops.partials.blocks(iter(batches), rows))
        assert [v for b in found for v in b.column("v").to_pylist()] == list(range(15))
        assert max(b.num_rows for b in found) <= rows


@settings(max_examples=5, deadline=None)
@given(st.integers(1, 40), st.integers(1, 20), st.integers(1, 5))
def test_any_shape(spark, n, p, partitions):
    rng = np.random.default_rng(n * 100 + p)
    x = rng.normal(size=(n, p))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(partitions)
    m = moments(df, Design(arrays=(("v", p),))).collect()[()]
    z = np.column_stack([np.ones(n), x])
    assert np.allclose(m.matrix, z.T @ z)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_rows_with_nulls_are_skipped_by_both_plans(spark, by):
    rows = [(float(i % 7), float(i % 3), 2.0 * (i % 7) + 1, i % 2) for i in range(40)]
    rows += [(None, 1.0, 5.0, 0), (1.0, None, 5.0, 1), (1.0, 1.0, None, 0)]
    df = spark.createDataFrame(rows, "a double, b double, y double, g int").repartition(3)
    design, whole = Design(numericals=("a", "b")), df.dropna()
    want = moments(whole, design, "y", by=by, plan="native", centred=False).collect()
    for plan in ("native", "arrow"):
        found = moments(df, design, "y", by=by, plan=plan).collect()
        assert found.keys() == want.keys()
        for k, m in found.items():
            assert m.n == want[k].n and np.allclose(m.matrix, want[k].matrix, rtol=1e-12)


def test_vectors_with_a_null_inside_are_skipped(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1.0), ([None, 5.0], 2.0), (None, 3.0), ([3.0, 4.0], 4.0)], "v array<double>, y double")
    m = moments(df, Design(arrays=(("v", 2),)), "y").collect()[()]
    assert np.allclose(m.matrix, expected(np.array([[1.0, 2.0], [3.0, 4.0]]), np.array([1.0, 4.0])))


@pytest.mark.parametrize("plan", ["native", "arrow"])
def test_groups_by_timestamps_and_numbers(spark, plan):
    df = spark.sql("""SELECT timestamp_micros(1700000000000000 + id % 2) AS t, CAST(id % 3 AS DECIMAL(5, 2)) AS d,
                      id % 2 = 0 AS b, CAST(id AS DOUBLE) AS a FROM range(12)""")
    found = moments(df, Design(numericals=("a",)), by=["t", "d", "b"], plan=plan).collect()
    assert len(found) == 6 and all(m.n == 2 for m in found.values())


@pytest.mark.parametrize("plan", ["native", "arrow"])
def test_columns_far_from_zero_keep_their_spread(spark, plan):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 2.9, 3000)
    df = spark.createDataFrame([(float(1e9 + v), float(300 * v + 7)) for v in x], "a double, y double").repartition(4)
    m = moments(df, Design(numericals=("a",)), "y", plan=plan).collect()[()]
    assert m.centred[0, 1] / m.centred[0, 0] == pytest.approx(300, rel=1e-6)
    assert m.means[0] == pytest.approx(1e9, rel=1e-9)


def test_sums_and_comoments_are_the_same_moments(data):
    df, *_ = data
    a = moments(df, Design(numericals=COLUMNS), "y").collect()[()]
    b = moments(df, Design(numericals=COLUMNS), "y", centred=False).collect()[()]
    assert np.allclose(a.matrix, b.matrix, rtol=1e-12) and np.allclose(a.centred, b.centred, rtol=1e-9)
    assert np.allclose((a + b).matrix, 2 * b.matrix, rtol=1e-12)


def comoments(z):
    means = z.mean(axis=0)
    return means, (z - means).T @ (z - means)


@pytest.mark.parametrize("plan", ["native", "arrow"])
@pytest.mark.parametrize("by", [[], ["fold"]])
def test_entries_of_comoments(data, plan, by):
    df, x, y, fold = data
    table = moments(df, Design(numericals=COLUMNS), "y", by=by, plan=plan)
    rows = table.named(table.entries()).collect()
    assert len(rows) == 10 * (4 if by else 1)
    names = [*COLUMNS, "y"]
    for r in rows:
        here = fold == r.fold if by else slice(None)
        _, want = comoments(np.column_stack([x, y])[here])
        assert r.value == pytest.approx(want[names.index(r.term_i), names.index(r.term_j)], rel=1e-11)
        assert r.n == len(x[here])


@pytest.mark.parametrize("plan", ["native", "arrow"])
@pytest.mark.parametrize("tasks, rows", [(1, 7), (2, 98), (7, 343), (2, 322)])
def test_a_constant_has_no_spread_in_any_cut(spark, plan, tasks, rows):
    df = spark.range(0, rows, 1, tasks).select(
        F.lit(5.1).alias("a"), F.col("id").cast("double").alias("b"), F.lit(0.1).alias("y"), (F.col("id") % 3).alias("g")
    )
    for by in ([], ["g"]):
        for m in moments(df, Design(numericals=("a", "b")), "y", by=by, plan=plan).collect().values():
            assert m.centred[0].tolist() == [0.0, 0.0, 0.0] and m.centred[2].tolist() == [0.0, 0.0, 0.0]
            assert m.means[0] == 5.1 and m.means[2] == 0.1 and m.centred[1, 1] > 0


@pytest.mark.parametrize("plan", ["native", "arrow"])
def test_groups_far_apart_keep_their_spread(spark, plan):
    rng = np.random.default_rng(4)
    near, far = rng.normal(0, 1, 400), 1e9 + rng.integers(0, 1000, 400) / 128
    rows = [("a", float(v), float(3 * v)) for v in near] + [("b", float(v), float(3 * (v - 1e9))) for v in far]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    found = moments(df, Design(numericals=("x",)), "y", by=["g"], plan=plan).collect()
    for g, x in (("a", near), ("b", far)):
        want = ((x - x.mean()) ** 2).sum()
        # means at 1e9 are known to 1e-7
        assert found[(g,)].centred[0, 0] == pytest.approx(want, rel=1e-7)
        assert found[(g,)].centred[0, 1] == pytest.approx(3 * want, rel=1e-7)
    both = found[("a",)] + found[("b",)]
    assert both.n == 800 and both.means[0] == pytest.approx(np.concatenate([near, far]).mean(), rel=1e-12)


def test_one_pass_and_no_job_before_it(data, spark):
    df, *_ = data
    context = spark.sparkContext
    for plan in ("native", "arrow"):
        context.setJobGroup(f"moments-{plan}", "")
        table = moments(df, Design(numericals=COLUMNS), "y", by=["fold"], plan=plan)
        assert not context.statusTracker().getJobIdsForGroup(f"moments-{plan}")
        table.collect()
        assert len(context.statusTracker().getJobIdsForGroup(f"moments-{plan}")) <= 3
    context.setJobGroup("tests", "")


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6), st.integers(1, 40), st.integers(1, 5))
def test_merging_tiles_in_any_batches(seed, side, parts, keys):
    rng = np.random.default_rng(seed)
    level = float(rng.choice([0.0, 1e6]))
    rows = [level + rng.normal(size=(rng.integers(1, 5), side)) for _ in range(parts)]
    key = np.sort(rng.integers(0, keys, parts))
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    stats = [comoments(r) for r in rows]
    n = np.array([len(r) for r in rows], float)
    means = np.stack([m for m, _ in stats])
    done = ops.partials.merged_tiles(n, means, means, np.stack([c.ravel() for _, c in stats]), starts)
    for i, k in enumerate(key[starts]):
        whole = np.concatenate([r for r, mine in zip(rows, key) if mine == k])
        mean, want = comoments(whole)
        assert done[0][i] == len(whole) and np.allclose(done[1][i], mean)
        assert np.allclose(done[3][i].reshape(side, side), want, rtol=1e-8, atol=1e-8)


def test_many_small_groups_are_reduced_together(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 3).selectExpr("id % 700 AS g", "id * 1.5D AS a", "(id * 7919) % 101 + 1e7D AS b")
    few = moments(df, Design(numericals=("a",)), "b", by=["g"], plan="arrow").collect()
    monkeypatch.setattr(ops.partials, "ROWS_PER_GROUP", 0)
    one_by_one = moments(df, Design(numericals=("a",)), "b", by=["g"], plan="arrow").collect()
    assert few.keys() == one_by_one.keys() and len(few) == 700
    for k in few:
        assert np.allclose(few[k].centred, one_by_one[k].centred) and few[k].n == one_by_one[k].n


def joined_frames(spark, hot=False):
    rng = np.random.default_rng(8)
    keys = [1 if hot and i % 2 else int(k) for i, k in enumerate(rng.integers(0, 40, 900))]
    people = [(k if i % 50 else None, k % 3, float(1e6 + rng.normal()), None if i % 37 == 0 else float(rng.normal()), int(i % 2)) for i, k in enumerate(keys)]
    homes = [(k, k % 3, float(rng.normal()), None if k == 5 else float(k), "u" if k % 2 else None) for k in range(2, 60)]
    homes += [(7, 1, 2.5, 3.5, "u"), (None, 1, 1.0, 1.0, "u"), (1, 1, 0.5, 1.0, "v")]
    many = spark.createDataFrame(people, "k int, st int, x double, y double, sex int").repartition(4)
    return many, spark.createDataFrame(homes, "k int, st int, w double, z double, kind string").repartition(3)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("by", [[], ["kind"], ["sex"], ["kind", "sex"], ["k"]])
@pytest.mark.parametrize("numericals, label", [(("w", "x", "z"), "y"), (("x",), "z"), (("w",), None), (("x", "y"), None)])
def test_moments_over_a_join(spark, hot, by, numericals, label):
    many, one = joined_frames(spark, hot)
    want = moments(many.join(one, ["k", "st"]), Design(numericals=numericals), label, by=by).collect()
    found = ops.moments_over_join(many, one, ["k", "st"], numericals, label, by=by).collect()
    assert found.keys() == want.keys() and want
    for group, m in want.items():
        assert found[group].n == m.n and found[group].terms == m.terms
        assert np.allclose(found[group].means, m.means, rtol=1e-12) and np.allclose(found[group].centred, m.centred, rtol=1e-8, atol=1e-5)


def test_the_join_meets_one_row_per_key(spark):
    many, one = joined_frames(spark, hot=True)
    table = ops.moments_over_join(many, one, ["k", "st"], ["x", "w"], "y")
    plan = table.packed._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join Inner") :]
    assert "Aggregate" in join  # below the join, on the side of the many


def test_rows_of_rare_keys_are_shuffled_as_they_are(spark):
    many, one = joined_frames(spark)
    table = ops.moments_over_join(many, one, ["k", "st"], ["x", "w"], "y")
    plan = table.packed._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join Inner") :]
    # nothing is aggregated before the rows are shuffled, and keys with many rows are cut before
    assert join.index("Aggregate") < join.index("RepartitionByExpression [k") < join.index("MapInArrow")
    physical = table.packed._jdf.queryExecution().executedPlan().toString()
    assert all("covarpopulation" not in line for line in physical.splitlines() if "Exchange" in line)
    assert physical.count("Exchange hashpartitioning(k") <= 2


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 60_000, 1, 3).selectExpr(
        "if(id % 3 > 0, 7, id) AS k", "1e9D + id % 11 AS x", "if(id = 4, null, sqrt(id)) AS y"
    )
    few = ops._thinned(df, ["k"], ["x", "y"])
    assert few.filter("k = 7").count() <= 2 * 3 and few.filter("_done is null").count() == 20_000
    one = spark.createDataFrame([(7, "a"), (3, "b"), (6, "b")], "k long, kind string")
    found = ops.moments_over_join(df, one, ["k"], ["x"], "y", by=["kind"]).collect()
    hot = np.array([i for i in range(60_000) if i % 3 and i != 4])
    for kind, ids in (("a", hot), ("b", np.array([3, 6]))):
        x = np.stack([ids % 11, np.sqrt(ids)])
        mean, away = x.mean(axis=1), x - x.mean(axis=1, keepdims=True)
        size = np.sqrt((away**2).sum(axis=1))
        got = found[(kind,)]
        assert got.n == len(ids) and np.allclose(got.means - [1e9, 0], mean, rtol=0, atol=1e-6)
        assert np.allclose(got.centred / np.outer(size, size), away @ away.T / np.outer(size, size), rtol=0, atol=1e-7)


def test_more_columns_than_a_tile_are_joined(spark, monkeypatch):
    many, one = joined_frames(spark)
    want = ops.moments_over_join(many, one, ["k", "st"], ["x", "w"], "y").collect()[()]
    monkeypatch.setattr(ops.partials, "TILE", 1)
    found = ops.moments_over_join(many, one, ["k", "st"], ["x", "w"], "y").collect()[()]
    assert np.allclose(found.centred, want.centred, rtol=1e-8)


def test_too_many_groups_to_hold_are_refused(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").alias("g"), F.col("id").cast("double").alias("a"))
    monkeypatch.setattr(ops, "COLLECT_BYTES", 100 * 3 * 8)
    with pytest.raises(ValueError, match="more than"):
        moments(df, Design(numericals=("a",)), by=["g"]).collect()
    monkeypatch.setattr(ops, "COLLECT_BYTES", 1)
    monkeypatch.setattr(ops, "HELD_BYTES", 1)
    with pytest.raises(ValueError, match="more than 8"):
        moments(df, Design(numericals=("a",)), by=["g"]).collect()


def test_vector_sum_of_ragged_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([3.0, 4.0],), (None,), ([],)], "v array<double>")
    found = ops.vector_sum(df, "v").orderBy("position").collect()
    assert [tuple(r) for r in found] == [(0, 4.0), (1, 6.0), (2, 3.0)]
    assert tuple(ops.row_widths(df, "v").first()) == (4, 3, 0)
