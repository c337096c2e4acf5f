"""Declared tables: column types, keys, NOT NULL columns and named rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate. A NULL result is a violation unless ``null_ok``."""

    name: str
    predicate: str
    null_ok: bool = False

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(self.null_ok))


@dataclass(frozen=True)
class TableSpec:
    """What a table promises to its readers."""

    name: str
    columns: Mapping[str, str]
    keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    checks: tuple[Rule, ...] = ()

    def rules(self) -> list[Rule]:
        """NOT NULL columns first, then the CHECK rules, which must be true: NULL breaks them too."""
        return [*[Rule(f"{c}_not_null", f"`{c}` IS NOT NULL") for c in self.not_null], *self.checks]

    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in self.columns.items()))

    def conform(self, df: DataFrame) -> DataFrame:
        """The declared columns in the declared order and types; a bad cast raises."""
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in self.columns.items()])
