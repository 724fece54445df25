from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ridgeway.operators.joins import join_checked, join_tables, union_by_name, with_position, zip_join
from ridgeway.operators.rows import drop_null_label, fill_nulls, non_null_counts
from ridgeway.sources.metrics_log import MetricsLog
from ridgeway.sources.stage import Scope, reused, shared_folder, staged
from ridgeway.sources.tables import read_mixed, read_parts, spread, write_parts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_are_one_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.1), (2, None, 1 / 3)], "i int, s string, x double")
    paths = [write_parts(df.filter(f"i = {i}"), f"{tmp_path}/{i}", "csv") for i in (1, 2)]
    assert sorted(read_parts(spark, paths, df.schema).collect()) == sorted(df.collect())
    assert read_parts(spark, paths).dtypes == [("i", "int"), ("s", "string"), ("x", "double")]


def test_a_part_with_other_columns_fails(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    path = write_parts(df, f"{tmp_path}/t", "csv")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_parts(spark, [path], "b int, a int").collect()


def test_label_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, 3.0)], "i int, y double").write.parquet(f"{tmp_path}/t")
    df = drop_null_label(spark.read.parquet(f"{tmp_path}/t"), "y")
    assert "PushedFilters: [IsNotNull(y)]" in plan(df)
    assert df.count() == 1


def test_fill_nulls_checks_types(spark):
    df = spark.createDataFrame([(None, None, "a")], "x double, i int, s string")
    assert fill_nulls(df, ["x", "i"]).first()[:2] == (0.0, 0)
    with pytest.raises(ValueError, match="not numeric"):
        fill_nulls(df, ["x", "s"])
    with pytest.raises(ValueError, match="missing"):
        fill_nulls(df, ["z"])


def test_non_null_counts_find_a_dead_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, dead string")
    assert {r.column_name: r.non_null for r in non_null_counts(df, df.columns).collect()} == {
        "a": 2,
        "dead": 0,
    }


def test_join_names_keys_once_and_drops_lonely_rows(spark):
    person = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (3, 1, 12)], "s int, p int, age int")
    house = spark.createDataFrame([(1, 1, 5), (2, 1, 6)], "s int, p int, rooms int")
    joined = join_tables(person, house, ["s", "p"])
    assert joined.columns == ["s", "p", "age", "rooms"]
    assert sorted(tuple(r) for r in joined.collect()) == [(1, 1, 10, 5), (1, 1, 11, 5)]


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert sorted(tuple(r) for r in union_by_name(a, b, a).collect()) == [
        (1, "x"),
        (1, "x"),
        (2, "y"),
    ]


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_follow_the_order(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(partitions)
    rows = with_position(df, [F.desc("k")]).collect()
    assert sorted((r.position, r.k) for r in rows) == [(i, 999 - i) for i in range(1000)]


def test_positions_leave_their_table_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = with_position(spark.range(10), ["id"])
    assert any(folder in f for f in df.inputFiles())


def test_zip_join_stops_at_the_shorter_side(spark):
    left = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    right = spark.createDataFrame([("z",), ("y",)], "b string")
    rows = zip_join(left, right, ["a"], ["b"]).collect()
    assert sorted((r.position, r.a, r.b) for r in rows) == [(0, 1, "y"), (1, 2, "z")]


def test_a_hot_key_is_split_by_the_adaptive_planner(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # a third of the rows have one key
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
        left = spark.range(0, 60000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
        right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = join_tables(left, right, ["k"])
        assert joined.agg(F.sum(F.col("w") - 2 * F.col("k"))).first()[0] == 0
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_spread_leaves_tables_with_enough_files_alone(spark, tmp_path):
    few, many = f"{tmp_path}/few", f"{tmp_path}/many"
    spark.range(100).coalesce(1).write.parquet(few)
    spark.range(100).repartition(8).write.parquet(many)
    assert "Exchange" in plan(spread(spark.read.parquet(few), ["id"]))
    assert "Exchange" not in plan(spread(spark.read.parquet(many), ["id"]))


def test_reused_frames_are_released(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError), reused(df) as kept:
        assert kept.is_cached
        raise RuntimeError
    assert not df.is_cached


def test_staged_tables_have_no_lineage(spark):
    df = spark.range(100).repartition(3)
    copy = staged(df, "copy")
    assert "Exchange" not in plan(copy)
    assert copy.dtypes == df.dtypes and copy.count() == 100


def test_metrics_log_appends(spark, tmp_path):
    log = MetricsLog(spark, f"{tmp_path}/log", run_id="r")
    log.add("fit", "alpha", 0.1)
    log.flush()
    log.add("score", "r2", None)
    log.flush()
    log.flush()
    rows = log.read().collect()
    assert sorted((r.run_id, r.step, r.metric, r.value) for r in rows) == [
        ("r", "fit", "alpha", 0.1),
        ("r", "score", "r2", None),
    ]
    assert all(r.elapsed_s >= 0 for r in rows)


def lines_of(path, name, text):
    folder = path / name
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text(text)
    return str(folder)


def test_files_that_disagree(spark, tmp_path):
    paths = [
        lines_of(tmp_path, "a", "id,x,name\n1,1.5,u\n2,,v\n3,many,w\nx,y,z\n"),
        lines_of(tmp_path, "b", "NAME,extra,Id\nu,9,4\n,9,5\nv,9,6,7\nw,9\n"),
        lines_of(tmp_path, "c", "id,x,name\n7,2.5,\"a, b\"\n"),
        lines_of(tmp_path, "d", "id,x,name\n"),
    ]
    found = read_mixed(spark, paths, "id long, x double, name string")
    rows = sorted((tuple(r) for r in found.rows.collect()), key=repr)
    assert rows == [(1, 1.5, "u"), (2, None, "v"), (4, None, "u"), (5, None, None), (7, 2.5, "a, b")]
    assert found.rows.columns == ["id", "x", "name"]
    bad = {(r.file.split("/")[-2], r.reason) for r in found.rejected.collect()}
    assert bad == {("a", "x"), ("a", "id,x"), ("b", "number of fields")} and found.rejected.count() == 4
    assert found.rejected.where("reason = 'x'").first().record == '{"id":"3","x":"many","name":"w"}'


def test_a_run_that_is_written_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for tries in range(2):
        log = MetricsLog(spark, path, run_id="7")
        log.add("load", "rows", 10 + tries)
        log.flush()
        log.add("score", "r2", None)
        log.flush()
    other = MetricsLog(spark, path, run_id="8")
    other.add("load", "rows", 1)
    other.flush()
    MetricsLog(spark, path).flush()
    rows = sorted((r.run_id, r.step, r.value) for r in other.read().collect())
    assert rows == [("7", "load", 11.0), ("7", "score", None), ("8", "load", 1.0)]


def test_a_scope_leaves_its_result_only(spark):
    files = lambda: set(os.listdir(shared_folder(spark).removeprefix("file:")))
    before = files()
    df = spark.range(10)
    with Scope(spark) as outer:
        with Scope(spark) as scope:
            found = scope.result(staged(df, "one").join(staged(df, "two"), "id"), "result")
        assert len(files() - before) == 1 and found.count() == 10
        staged(df, "three")
        kept = outer.result(found.limit(3), "last")
    assert [name.split("-")[0] for name in files() - before] == ["last"] and kept.count() == 3
    with pytest.raises(ZeroDivisionError), Scope(spark):
        staged(df, "four")
        1 / 0
    assert len(files() - before) == 1


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_a_checked_join_counts_without_a_job_of_its_own(spark, threshold):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (2, "q"), (2, "r"), (9, "s"), (None, "t")], "k int, y string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined, met = join_checked(left, right, ["k"])
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, ["k"]).collect()))
        assert met.get == {"rows": 4, "unmatched": 2, "repeated": 2}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
