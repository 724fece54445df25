"""Column pruning and column roles. Everything here works on the schema; no job runs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns by name; absent names are ignored."""
    return df.drop(*names)


def matching_columns(columns: Sequence[str], pattern: str) -> list[str]:
    """Columns whose whole name matches, ignoring case."""
    rx = re.compile(pattern, re.IGNORECASE)
    return [c for c in columns if rx.fullmatch(c)]


def drop_matching(df: DataFrame, patterns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns whose whole name matches any of the patterns."""
    kept = {c.lower() for c in keep}
    doomed = {c for p in patterns for c in matching_columns(df.columns, p)}
    return df.drop(*(c for c in df.columns if c in doomed and c.lower() not in kept))


@dataclass(frozen=True)
class FeatureSpec:
    """Which column plays which part in a model."""

    label: str
    numericals: tuple[str, ...] = ()
    ordinals: tuple[str, ...] = ()
    categoricals: tuple[str, ...] = ()
    skipping: tuple[str, ...] = ()
    keys: tuple[str, ...] = field(default=())

    @property
    def features(self) -> tuple[str, ...]:
        return self.numericals + self.ordinals + self.categoricals

    def roles(self) -> list[tuple[str, str]]:
        """(column, role) in declaration order."""
        groups = [
            ("key", self.keys),
            ("label", (self.label,)),
            ("skipping", self.skipping),
            ("numerical", self.numericals),
            ("ordinal", self.ordinals),
            ("categorical", self.categoricals),
        ]
        return [(c, role) for role, columns in groups for c in columns]

    def validate(self, columns: Sequence[str]) -> FeatureSpec:
        """Fail on a missing column, on a column with two roles, on a leak."""
        present = set(columns)
        used = (self.label, *self.features, *self.keys)
        missing = [c for c in used if c not in present]
        if missing:
            raise ValueError(f"columns missing from the table: {missing}")
        names = [c for c, role in self.roles() if role != "key"]
        twice = sorted({c for c in names if names.count(c) > 1})
        if twice:
            raise ValueError(f"columns with more than one role: {twice}")
        return self

    def with_ranks(self, ordinals: Sequence[str]) -> FeatureSpec:
        """These ordinals hold their ranks already and are plain numbers."""
        rest = tuple(c for c in self.ordinals if c not in ordinals)
        return replace(self, numericals=(*self.numericals, *ordinals), ordinals=rest)

    def with_categoricals(self, categoricals: Sequence[str]) -> FeatureSpec:
        return FeatureSpec(
            self.label, self.numericals, self.ordinals, tuple(categoricals), self.skipping, self.keys
        )


def assign_roles(
    columns: Sequence[str],
    label: str,
    numericals: Sequence[str],
    ordinals: Sequence[str],
    skipping: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> FeatureSpec:
    """Every column that is not named otherwise is categorical."""
    named = {label, *numericals, *ordinals, *skipping, *keys}
    rest = tuple(c for c in columns if c not in named)
    spec = FeatureSpec(label, tuple(numericals), tuple(ordinals), rest, tuple(skipping), tuple(keys))
    return spec.validate(columns)


def random_subset(columns: Sequence[str], k: int, seed: int = 0) -> list[str]:
    """``k`` columns drawn without replacement, the same for the same seed.

    Names are ranked by md5(seed-name), so the draw depends neither on the
    order of the columns nor on a language's random generator.
    """
    ranked = sorted(columns, key=lambda c: (hashlib.md5(f"{seed}-{c}".encode()).hexdigest(), c))
    return ranked[:k]
