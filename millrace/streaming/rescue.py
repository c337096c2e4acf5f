"""Typed parsing of JSON text that loses nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

RESCUED = "_rescued_data"


def parse_with_rescue(df: DataFrame, text: str, schema: StructType, rescued: str = RESCUED) -> DataFrame:
    """Fields of the schema as columns; what does not fit goes to ``rescued`` as JSON.

    Rescued are values that do not fit their column's type (the column is then NULL) and
    fields the schema does not know. A line that is no JSON object is rescued whole,
    under the name ``_line``. Nothing to rescue gives NULL.
    """
    others = [c for c in df.columns if c != text]
    parsed = df.select(
        *others,
        F.col(text).alias("_text"),
        F.from_json(text, schema).alias("_typed"),
        F.from_json(text, "map<string,string>").alias("_raw"),
    )
    fitted = F.array_compact(
        F.array(*[F.when(F.col(f"_typed.`{f.name}`").isNotNull(), F.lit(f.name)) for f in schema.fields])
    ).cast("array<string>")
    left_over = F.map_filter("_raw", lambda k, v: v.isNotNull() & ~F.array_contains("_fitted", k))
    whole = F.to_json(F.create_map(F.lit("_line"), F.col("_text")))
    return (
        parsed.withColumn("_fitted", fitted)
        .withColumn("_left", left_over)
        .select(
            *[F.col(f"_typed.`{f.name}`").alias(f.name) for f in schema.fields],
            *others,
            F.when(F.col("_raw").isNull(), whole)
            .when(F.size("_left") > 0, F.to_json("_left"))
            .alias(rescued),
        )
    )


def unseen_fields(rescued: DataFrame, schema: StructType, column: str = RESCUED) -> StructType:
    """Fields in the rescued JSON that the schema does not have, with the narrowest type that fits all values.

    Only rows with rescued data are looked at, usually a few. Types are merged in Spark;
    one row comes back, with the fields that become columns.
    """
    known = F.array(*[F.lit(n) for n in [*schema.names, "_line"]])
    kept = rescued.filter(F.col(column).isNotNull())
    entries = kept.select(F.explode(F.from_json(column, "map<string,string>")).alias("name", "value"))
    value = F.col("value")
    kind = (
        F.when(F.every(value.isin("true", "false")), "boolean")
        .when(F.every(value.try_cast("bigint").isNotNull()), "long")
        .when(F.every(value.try_cast("double").isNotNull()), "double")
        .otherwise("string")
    )
    fits = entries.filter(~F.array_contains(known, F.col("name"))).groupBy("name").agg(kind.alias("kind"))
    merged = fits.agg(F.array_sort(F.collect_list(F.struct("name", "kind"))).alias("fields")).first()
    found = StructType()
    for field in merged.fields or []:
        found = found.add(field.name, field.kind)
    return found
