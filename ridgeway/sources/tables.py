"""Scans of part files and the modelling-table loader."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridgeway.operators.columns import drop_columns, drop_matching
from ridgeway.operators.joins import join_tables, union_by_name


def read_parts(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | str | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """One table from several part files.

    With a schema the files are read once. Without one, CSV types are inferred,
    which reads everything an extra time: do it once and keep the result with
    :func:`write_parts`.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            # the header decides nothing here, but a file whose columns stand in
            # another order must fail instead of filling the wrong columns
            reader = reader.option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))


class Parsed(NamedTuple):
    """What could be read, and what could not: (file, record, reason)."""

    rows: DataFrame
    rejected: DataFrame


def read_mixed(spark: SparkSession, paths: Sequence[str], schema: StructType | str) -> Parsed:
    """One table from CSV files that need not agree.

    Columns are found by the names in each file's own header, in any order and case; one
    that a file doesn't have is null there, and one that the schema doesn't name is
    ignored. A record that doesn't fit its header, or has a value that isn't of its
    column's type, is in ``rejected`` with the names of those columns; every record is in
    exactly one of both. Only headers are read beforehand; files of one header are one scan.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    files = spark.read.text(list(paths)).inputFiles()
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(files):
        header = spark.read.option("header", True).csv(file).columns
        by_header.setdefault(tuple(header), []).append(file)
    if not by_header:
        raise ValueError("no files")
    parts = [_parsed(spark, header, same, schema) for header, same in by_header.items()]
    whole = union_by_name(*parts)
    fits = F.col("_reason") == ""
    rows = whole.filter(fits).select(schema.names)
    return Parsed(rows, whole.filter(~fits).select(*(F.col(f"_{c}").alias(c) for c in ("file", "record", "reason"))))


def _parsed(spark: SparkSession, header: Sequence[str], files: Sequence[str], schema: StructType) -> DataFrame:
    """The schema's columns, and _file, _record and _reason ('' where the record fits)."""
    raw = [f"_c{i}" for i in range(len(header))]
    strings = StructType([StructField(c, StringType()) for c in (*raw, "_bad")])
    reader = spark.read.schema(strings).option("header", True).option("columnNameOfCorruptRecord", "_bad")
    # the header decides the order, so the reader need not check names; it must count all fields
    found = reader.option("enforceSchema", True).option("columnPruning", False).csv(list(files))
    place = {name.lower(): c for name, c in zip(header, raw)}
    columns, wrong = [], []
    for field in schema.fields:
        text = F.col(place[field.name.lower()]) if field.name.lower() in place else F.lit(None).cast("string")
        value = text.try_cast(field.dataType)
        columns.append(value.alias(field.name))
        wrong.append(F.when(text.isNotNull() & value.isNull(), F.lit(field.name)))
    named = [F.col(c).alias(name) for c, name in zip(raw, header)]
    record = F.coalesce(F.col("_bad"), F.to_json(F.struct(*named)))
    reason = F.when(F.col("_bad").isNotNull(), "number of fields").otherwise(F.array_join(F.array(*wrong), ","))
    return found.select(
        *columns, F.col("_metadata.file_path").alias("_file"), record.alias("_record"), reason.alias("_reason")
    )


def write_parts(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a table as part files and return the path."""
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def load_modelling_table(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    drop: Sequence[str] = (),
    drop_after_join: Sequence[str] = (),
    drop_patterns: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Prune two tables, join them, prune again.

    ``drop`` leaves both inputs before the join, ``drop_after_join`` and whole
    names matching ``drop_patterns`` leave the joined table. Columns in ``keep``
    survive every step (row keys that a later split needs).
    """
    kept = {c.lower() for c in keep}
    names = [c for c in drop if c.lower() not in kept]
    joined = join_tables(drop_columns(left, names), drop_columns(right, names), on)
    joined = drop_columns(joined, [c for c in drop_after_join if c.lower() not in kept])
    return drop_matching(joined, drop_patterns, keep=keep)


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Use all cores on a table that is stored in fewer files than there are cores.

    A file with one row group is read by one task, and without a later shuffle
    the whole plan would stay there. Large tables have files enough, and are
    returned as they are: no shuffle is added to them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    partitions = df.rdd.getNumPartitions()
    # a split without a row group's start is empty, so few files may fill fewer tasks;
    # of a large table the files are not even listed
    if partitions >= 8 * cores or (partitions >= cores and len(df.inputFiles()) >= cores):
        return df
    return df.repartition(cores, *keys)
