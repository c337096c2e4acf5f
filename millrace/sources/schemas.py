"""The schema of a folder, remembered beside it."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from millrace.sources import files


class SchemaMemory:
    """The schema of a folder, kept as numbered JSON files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _latest(self) -> str | None:
        kept = files.names(self.spark, self.path)
        return kept[-1] if kept else None

    def load(self) -> StructType:
        latest = self._latest()
        if latest is None:
            return StructType()
        return StructType.fromJson(json.loads(files.read_text(self.spark, f"{self.path}/{latest}")))

    def save(self, schema: StructType) -> None:
        latest = self._latest()
        number = int(latest.split(".")[0]) + 1 if latest else 0
        files.create_text(self.spark, f"{self.path}/{number:06d}.json", schema.json())

    def widen(self, schema: StructType) -> None:
        """Remember the columns that are new; a known one must have its type, whatever may be NULL in it."""
        known = self.load()
        kinds = {f.name: f.dataType.simpleString() for f in known.fields}
        for f in schema.fields:
            if kinds.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString():
                raise TypeError(f"{f.name} is {kinds[f.name]}, not {f.dataType.simpleString()}")
        new = [StructField(f.name, f.dataType) for f in schema.fields if f.name not in kinds]
        if new:
            self.save(StructType(known.fields + new))
