"""Market price documents in XML to one row per price point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The document kind that carries prices, its element names, its time format.
PUBLICATION = "Publication_MarketDocument"
START_FORMAT = "yyyy-MM-dd'T'HH:mm'Z'"
QUARTER_HOUR = "PT15M"
SERIES = "TimeSeries"
SERIES_SCHEMA = """
    `currency_Unit.name` string,
    `price_Measure_Unit.name` string,
    Period array<struct<
        timeInterval: struct<start: string>,
        resolution: string,
        Point: array<struct<position: int, `price.amount`: double>>
    >>
"""
DOCUMENT_SCHEMA = f"{SERIES} array<struct<{SERIES_SCHEMA}>>"
# The start tag of a series with attributes, and what is left of its end tag before the cut.
SERIES_START = rf"(?s)^.*<(?:[\w.-]+:)?{SERIES}\s[^>]*>"
SERIES_END = r"</(?:[\w.-]+:)?$"
# The first element after an XML declaration and comments, without its namespace prefix.
ROOT_TAG = r"^\s*(?:(?:<\?[\s\S]*?\?>|<!--[\s\S]*?-->)\s*)*<(?:[\w.-]+:)?([\w.-]+)"


def root_tag(document: Column | str) -> Column:
    return F.regexp_extract(document, ROOT_TAG, 1)


def price_points(df: DataFrame, document: str, keep: list[str] | None = None) -> DataFrame:
    """Explode TimeSeries, Period and Point of each document.

    A point lies ``position - 1`` steps after the start of its period; a step is 15
    minutes for ``PT15M``, otherwise an hour. Absent positions stay absent. Any namespace
    prefix will do. Documents of another kind, such as acknowledgements, give no rows.
    """
    keep = keep or []
    parsed = df.filter(root_tag(document) == PUBLICATION).select(
        *keep, F.from_xml(document, DOCUMENT_SCHEMA, {"ignoreNamespace": "true"}).alias("doc")
    )
    return _points(parsed.select(*keep, F.explode(f"doc.{SERIES}").alias("s")), keep)


def price_points_of_files(spark: SparkSession, path: str, keep_file: str | None = None) -> DataFrame:
    """``price_points`` of XML files, one document each, of any size.

    A file is cut behind every tag of a series, which Spark's text source does in parallel within a file, so
    a document larger than a task is read by many and no task holds more than a series. (The XML source
    with a row tag gives the same series but reads a file in one task.) The first element is looked up by
    file: series of documents of another kind are left out. With ``keep_file`` that column names the file.
    """
    pieces = spark.read.option("lineSep", f"{SERIES}>").option("recursiveFileLookup", True).text(path)
    pieces = pieces.select("value", F.col("_metadata.file_path").alias("_file"))
    publications = pieces.filter(root_tag("value") == PUBLICATION).select("_file").distinct()
    # the piece of a series is what lies before its end tag; with attributes its start tag is no cut and still there
    inside = F.regexp_replace(F.regexp_replace("value", SERIES_END, ""), SERIES_START, "")
    whole = F.concat(F.lit(f"<{SERIES}>"), inside, F.lit(f"</{SERIES}>"))
    series = pieces.filter(F.col("value").rlike(SERIES_END)).join(publications, "_file", "left_semi")
    parsed = series.select(F.col("_file").alias(keep_file or "_file"), F.from_xml(whole, SERIES_SCHEMA, {"ignoreNamespace": "true"}).alias("s"))
    return _points(parsed, [keep_file] if keep_file else [])


def _points(series: DataFrame, keep: list[str]) -> DataFrame:
    """One row per point of the series ``s``."""
    periods = series.select(
        *keep,
        F.col("s.`currency_Unit.name`").alias("currency"),
        F.col("s.`price_Measure_Unit.name`").alias("unit"),
        F.explode("s.Period").alias("p"),
    )
    points = periods.select(
        *keep,
        "currency",
        "unit",
        F.to_timestamp_ntz("p.timeInterval.start", F.lit(START_FORMAT)).alias("start"),
        F.when(F.col("p.resolution") == QUARTER_HOUR, 15).otherwise(60).alias("minutes"),
        F.explode("p.Point").alias("point"),
    )
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.col("minutes") * (F.col("point.position") - 1), F.lit(0))
    # a timestamp without zone as text, untouched by the session's zone
    text = F.translate((F.col("start") + step).cast("string"), " ", "T")
    return points.select(
        *keep,
        F.concat(text, F.lit("Z")).alias("timestamp_utc"),
        F.col("point.`price.amount`").alias("price"),
        "currency",
        "unit",
    )
