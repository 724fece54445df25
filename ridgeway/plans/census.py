"""The census person and housing tables: which columns go, and which part the rest play."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ridgeway.operators.columns import FeatureSpec, assign_roles
from ridgeway.sources.tables import load_modelling_table, read_parts

# fixed values: column names and name patterns of the 2013 survey files
LABEL = "PINCP"
SKIPPING = ("PERNP", "WAGP", "HINCP", "FINCP")
JOIN_KEYS = ("SERIALNO", "PUMA", "ST")
ROW_KEYS = ("SERIALNO", "SPORDER")
DROPPED = (
    *SKIPPING,
    "RT",
    "DIVISION",
    "REGION",
    "ADJINC",
    "ADJHSG",
    "WGTP",
    "PWGTP",
    "SPORDER",
    "VACS",
)
DROPPED_AFTER_JOIN = ("PUMA", "SERIALNO")
DROPPED_PATTERNS = (
    "(pwgtp)+?.+",
    "(wgtp)+?.+",
    "(?!FOD1P|FOD2P|FIBEROP|FULP|FPARC|FINCP)(F)+?.+(P)",
)
NUMERICALS = (
    "NP", "BDSP", "CONP", "ELEP", "FULP", "INSP", "MHP", "MRGP", "RMSP", "RNTP", "SMP", "VALP",
    "WATP", "GRNTP", "GRPIP", "GASP", "NOC", "NPF", "NRC", "OCPIP", "SMOCP", "AGEP", "INTP",
    "JWMNP", "OIP", "PAP", "RETP", "SEMP", "SSIP", "SSP", "WKHP", "POVPIP",
)
ORDINALS = (
    "AGS", "YBL", "MV", "TAXP", "CITWP", "DRAT", "JWRIP", "MARHT", "MARHYP", "SCHG", "SCHL",
    "WKW", "YOEP", "DECADE", "JWAP", "JWDP", "SFN",
)
PERSON_FILES = ("ss13pusa.csv", "ss13pusb.csv")
HOUSING_FILES = ("ss13husa.csv", "ss13husb.csv")


def modelling_table(person: DataFrame, housing: DataFrame) -> DataFrame:
    """Persons with their household's columns, weights and allocation flags removed.

    The row key stays, because the split is decided by it; it is no feature.
    """
    return load_modelling_table(
        person,
        housing.drop("SPORDER"),
        on=JOIN_KEYS,
        drop=DROPPED,
        drop_after_join=DROPPED_AFTER_JOIN,
        drop_patterns=DROPPED_PATTERNS,
        keep=ROW_KEYS,
    )


def census_schema(columns: Sequence[str]) -> StructType:
    """Types by name, so that no file is read to infer them.

    Keys are whole numbers, numericals and incomes doubles, everything else the
    string that stands in the file, as labels are compared as strings anyway.
    """
    keys, numbers = {*JOIN_KEYS, *ROW_KEYS}, {*NUMERICALS, LABEL, *SKIPPING}
    kinds = [LongType() if c in keys else DoubleType() if c in numbers else StringType() for c in columns]
    return StructType([StructField(c, kind) for c, kind in zip(columns, kinds)])


def _header_schema(spark: SparkSession, path: str) -> StructType:
    """The schema for a file's header line, which is all that is read."""
    return census_schema(spark.read.option("header", True).csv(path).columns)


def read_census(
    spark: SparkSession,
    folder: str,
    person_schema=None,
    housing_schema=None,
    person_files: Sequence[str] = PERSON_FILES,
    housing_files: Sequence[str] = HOUSING_FILES,
    fmt: str = "csv",
) -> DataFrame:
    """The modelling table from the survey's part files.

    Without schemas the columns of CSV files get their types by name.
    """
    if fmt == "csv":
        person_schema = person_schema or _header_schema(spark, f"{folder}/{person_files[0]}")
        housing_schema = housing_schema or _header_schema(spark, f"{folder}/{housing_files[0]}")
    person = read_parts(spark, [f"{folder}/{f}" for f in person_files], person_schema, fmt)
    housing = read_parts(spark, [f"{folder}/{f}" for f in housing_files], housing_schema, fmt)
    return modelling_table(person, housing)


def census_spec(df: DataFrame) -> FeatureSpec:
    """Roles of the modelling table's columns; what is not named is categorical."""
    return assign_roles(df.columns, LABEL, NUMERICALS, ORDINALS, SKIPPING, ROW_KEYS)
