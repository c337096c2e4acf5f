"""File and message streams, rescued data, schema growth, reload, change capture, XML, CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from millrace.operators.quality import gate_report, require_gate
from millrace.session import fresh_folder, materialise
from millrace.sources.batches import BatchTable
from millrace.sources.messages import message_stream, parse_messages
from millrace.sources.price_documents import price_points, price_points_of_files
from millrace.sources.readers import read_csv, stream_files, stream_table, with_audit, with_provenance
from millrace.sources.writers import land_partitions, stream_to_files
from millrace.spec import Rule
from millrace.streaming.cdc import apply_changes_stream, clean_stream, current
from millrace.streaming.ingest import SchemaChanged, ingest_json, ingestion_audit
from millrace.streaming.reload import current_generation, safe_reload
from millrace.streaming.rescue import parse_with_rescue
from workload.inputs import table
from workload.registry import case

FILES_PER_TRIGGER = 100
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
EVENT_HINTS = (
    StructType()
    .add("event_id", LongType())
    .add("user_id", LongType())
    .add("event_type", StringType())
    .add("value", DoubleType())
    .add("ts", StringType())
)
EVENTS_SQL = f"select event_id, user_id, event_type, value, strftime(ts, {STAMP}) as ts from events"


def _event_text(spark, sf):
    """Events with the time as text, as they would stand in a landing file."""
    return table(spark, sf, "events").withColumns(
        {"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "zone": F.col("event_type"), "day": F.to_date("ts")}
    )


def _land(spark, sf, label, *columns):
    """JSON lines in one folder per zone and day."""
    path = fresh_folder(spark, label)
    land_partitions(_event_text(spark, sf).select(*columns, "zone", "day"), path, ["zone", "day"])
    return path


@case("select event_type as zone, strftime(ts, '%Y-%m-%d') as day, count(*) as n_rows from events group by 1, 2")
def landing_partitions(spark, sf):
    """The same slices landed twice: the second landing replaces the first."""
    path = _land(spark, sf, "landing", "event_id", "value")
    rows = _event_text(spark, sf).select("event_id", "value", "zone", "day")
    land_partitions(rows, path, ["zone", "day"])
    back = spark.read.schema("event_id bigint, value double, zone string, day string").json(path)
    return back.groupBy("zone", "day").agg(F.count(F.lit(1)).alias("n_rows"))


@case("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_scan(spark, sf):
    path = fresh_folder(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    back = read_csv(spark, path)
    return back.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


ENVELOPE_FIELDS = "k int"


def _envelopes(spark, sf):
    return table(spark, sf, "events").select(
        F.col("props").cast("binary").alias("value"),
        F.length("event_type").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


MESSAGES_SQL = f"""select cast(json_extract_string(props, '$.k') as int) as k, cast(length(event_type) as int) as partition,
    event_id as "offset", strftime(ts, {STAMP}) as enqueued_ts from events"""


@case(MESSAGES_SQL)
def json_payload_parse(spark, sf):
    return parse_messages(_envelopes(spark, sf), ENVELOPE_FIELDS)


@case(MESSAGES_SQL)
def message_stream_ingest(spark, sf):
    """Recorded envelopes as a stream, parsed and appended; run twice, the second adds nothing."""
    log, target, checkpoint = (fresh_folder(spark, n) for n in ("log", "messages", "checkpoint"))
    _envelopes(spark, sf).write.parquet(log)
    for _ in range(2):
        raw = message_stream(spark, {}, fmt="parquet", path=log)
        stream_to_files(parse_messages(raw, ENVELOPE_FIELDS), target, checkpoint).awaitTermination()
    loaded = spark.read.parquet(target)
    require_gate(
        gate_report(loaded, keys=["offset"], not_null=["offset", "k"], ranges=[Rule("k_range", "k BETWEEN 0 AND 99")])
    )
    return loaded


@case(
    """select event_id, k, rescued from (
        select event_id, case when event_type in ('view', 'error') then null else cast(json_extract_string(props, '$.k') as int) end as k,
               case event_type when 'view' then '{"k":"n/a"}' when 'click' then '{"site":"' || user_id || '"}'
                    when 'error' then '{"_line":"not json ' || event_id || '"}' end as rescued
        from events)"""
)
def json_rescue(spark, sf):
    """A wrong type in views, an unknown field in clicks, broken lines in errors."""
    text = (
        F.when(F.col("event_type") == "view", F.lit('{"k": "n/a"}'))
        .when(F.col("event_type") == "click", F.concat(F.expr("substr(props, 1, length(props) - 1)"), F.lit(', "site": "'), "user_id", F.lit('"}')))
        .when(F.col("event_type") == "error", F.concat(F.lit("not json "), "event_id"))
        .otherwise(F.col("props"))
    )
    lines = table(spark, sf, "events").select("event_id", text.alias("line"))
    parsed = parse_with_rescue(lines, "line", StructType().add("k", IntegerType()), "rescued")
    return parsed.select("event_id", "k", "rescued")


@case(EVENTS_SQL)
def file_stream_ingest(spark, sf):
    """JSON files to bronze; the second run finds nothing new."""
    landing = _land(spark, sf, "landing", *EVENT_HINTS.names)
    bronze = BatchTable(spark, fresh_folder(spark, "bronze"))
    state = fresh_folder(spark, "state")
    for _ in range(2):
        ingest_json(spark, landing, bronze, state, hints=EVENT_HINTS, files_per_trigger=FILES_PER_TRIGGER)
    return bronze.read().filter("source_file is not null and _rescued_data is null").select(*EVENT_HINTS.names)


@case(
    f"""select event_id, value, case when ts >= timestamp '2024-01-16' then user_id end as user_id,
        case when ts >= timestamp '2024-01-16' then event_type end as event_type from events"""
)
def stream_schema_evolution(spark, sf):
    """From mid month on the files carry two more fields; earlier rows hold NULL there."""
    landing, bronze, state = (fresh_folder(spark, n) for n in ("landing", "bronze", "state"))
    store = BatchTable(spark, bronze)
    events = _event_text(spark, sf)
    early = events.filter("day < date'2024-01-16'").select("event_id", "value", "day")
    late = events.filter("day >= date'2024-01-16'").select("event_id", "value", "user_id", "event_type", "day")
    for part in (early, late):
        land_partitions(part, landing, ["day"])
        ingest_json(spark, landing, store, state, files_per_trigger=FILES_PER_TRIGGER)
    return store.read().select("event_id", "value", "user_id", "event_type")


@case(
    """select 'first run' as run, true::varchar as stopped, cast(0 as bigint) as n_rows union all
    select 'second run', false::varchar, count(*) from events where value is not null"""
)
def stream_schema_stop(spark, sf):
    """Files with a field the schema does not have: the first run stops with nothing added, the second takes them."""
    landing, store, state = _land(spark, sf, "landing", *EVENT_HINTS.names), BatchTable(spark, fresh_folder(spark, "bronze")), fresh_folder(spark, "state")
    hints = StructType([f for f in EVENT_HINTS.fields if f.name != "value"])
    out = None
    for name in ("first run", "second run"):
        try:
            ingest_json(spark, landing, store, state, hints=hints, on_new_fields="stop", files_per_trigger=FILES_PER_TRIGGER)
            stopped = False
        except StreamingQueryException as error:
            stopped = SchemaChanged.__name__ in str(error)
        rows = store.read().filter("value is not null") if store.exists() else spark.range(0)
        row = rows.agg(F.lit(name).alias("run"), F.lit(stopped).alias("stopped"), F.count(F.lit(1)).alias("n_rows"))
        row = materialise(row, "run")
        out = row if out is None else out.unionByName(row)
    return out


@case("select count(*) as rows_before, count(*) as rows_after, count(distinct event_id) as unique_events from events")
def safe_full_reload(spark, sf):
    landing, root = _land(spark, sf, "landing", *EVENT_HINTS.names), fresh_folder(spark, "bronze")

    def ingest(generation):
        store = BatchTable(spark, generation.table)
        ingest_json(spark, landing, store, generation.state, hints=EVENT_HINTS, files_per_trigger=FILES_PER_TRIGGER)

    def read(generation):
        return BatchTable(spark, generation.table).read()

    ingest(current_generation(spark, root))
    before, after = safe_reload(spark, root, ingest, read)
    reloaded = read(current_generation(spark, root))
    return reloaded.agg(
        F.lit(before).cast("bigint").alias("rows_before"),
        F.lit(after).cast("bigint").alias("rows_after"),
        F.count_distinct("event_id").alias("unique_events"),
    )


@case(
    f"""select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n_rows, strftime(min(ts), {STAMP}) as first_ts,
        strftime(max(ts), {STAMP}) as last_ts from events group by 1"""
)
def ingestion_audit_by_day(spark, sf):
    bronze = table(spark, sf, "events").select(F.to_date("ts").alias("load_date"), F.col("ts").alias("ingestion_ts"))
    return ingestion_audit(bronze, ["load_date"])


@case("select 'events.parquet' as source_file, '2024-02-01' as load_date, count(*) as n_rows from events")
def provenance_and_audit(spark, sf):
    rows = with_audit(with_provenance(table(spark, sf, "events")), dt.datetime(2024, 2, 1))
    # a table that is a folder has part files below it
    name = F.when(F.col("source_path").contains("/events.parquet/"), "events.parquet").otherwise(F.col("source_file"))
    return rows.groupBy(name.alias("source_file"), "load_date").agg(F.count(F.lit(1)).alias("n_rows"))


@case(f"select event_id, strftime(ts, {STAMP}) as ts, user_id, event_type, value, props from events")
def table_stream_copy(spark, sf):
    target, checkpoint = fresh_folder(spark, "copy"), fresh_folder(spark, "checkpoint")
    # as a pattern it fits a folder of part files as well as one file
    path = f"{sf}/events.parque[t]"
    stream = stream_table(spark, path, table(spark, sf, "events").schema)
    stream_to_files(stream, target, checkpoint, trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(target)


TRIGGERS = {"once": {"once": True}, "processing time": {"processingTime": "1 second"}, "available now": {"availableNow": True}}


@case(" union all ".join(f"select '{name}' as trigger, count(*) as n_rows, count(distinct event_id) as events from events" for name in TRIGGERS))
def stream_triggers(spark, sf):
    """The same table copied under each trigger, exactly once."""
    out, schema = None, table(spark, sf, "events").schema
    for name, trigger in TRIGGERS.items():
        target, checkpoint = fresh_folder(spark, "copy"), fresh_folder(spark, "checkpoint")
        query = stream_to_files(stream_table(spark, f"{sf}/events.parque[t]", schema), target, checkpoint, trigger=trigger)
        if "processingTime" in trigger:
            query.processAllAvailable()
            query.stop()
        query.awaitTermination()
        counts = (F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("events"))
        row = spark.read.parquet(target).agg(F.lit(name).alias("trigger"), *counts)
        out = row if out is None else out.unionByName(row)
    return out


@case(
    f"""select user_id, event_id, strftime(ts, {STAMP}) as ts, event_type, cast(value as double) as value from events
    where event_type <> 'signup' and value > 0
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def stream_cdc_apply(spark, sf):
    """Latest event per user from daily files, in several batches; signups are dropped by a rule."""
    landing, target, checkpoint = (fresh_folder(spark, n) for n in ("changes", "latest", "checkpoint"))
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    land_partitions(events.withColumn("day", F.to_date("ts")), landing, ["day"], fmt="parquet")
    stream = stream_files(spark, landing, events.schema, fmt="parquet", files_per_trigger=20)
    cleaned = clean_stream(
        stream,
        {"value": "decimal(10,4)"},
        drop=[Rule("no_signup", "event_type <> 'signup'"), Rule("key_present", "user_id IS NOT NULL"), Rule("some", "value > 0")],
        fail=[Rule("value_positive", "value >= 0")],
    )
    store = BatchTable(spark, target)
    apply_changes_stream(cleaned, store, checkpoint=checkpoint)
    return current(store, ["user_id"], "ts")


@case(
    """select event_type, count(*) as n_rows, count(distinct event_id) as events, count(*) as handed_over,
           count(distinct event_id) as copied from events group by 1"""
)
def stream_pack_batches(spark, sf):
    """Daily files in small batches; they are packed between the runs of a stream that copies the table.

    What the table holds beside what the copy was handed: nothing is lost, and nothing packed comes twice.
    """
    landing, copy = fresh_folder(spark, "landing"), fresh_folder(spark, "copy")
    store, checkpoint, reading = BatchTable(spark, fresh_folder(spark, "bronze")), fresh_folder(spark, "state"), fresh_folder(spark, "state")
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")

    def append(batch, number):
        batch.write.mode("overwrite").parquet(f"{copy}/batch={number}")

    for part in ("ts < timestamp'2024-01-20'", "ts >= timestamp'2024-01-20'"):
        land_partitions(events.filter(part).withColumn("day", F.to_date("ts")), landing, ["day"], fmt="parquet")
        stream = stream_files(spark, landing, events.schema, fmt="parquet", files_per_trigger=3)
        apply_changes_stream(stream, store, checkpoint=checkpoint)
        store.drain("copy", reading, append)
        store.pack()
    store.drain("copy", reading, append)

    def per_type(df, rows, keys):
        return df.groupBy("event_type").agg(F.count(F.lit(1)).alias(rows), F.count_distinct("event_id").alias(keys))

    return per_type(store.read(), "n_rows", "events").join(per_type(spark.read.parquet(copy), "handed_over", "copied"), "event_type")


@case(
    """select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n_rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_ts,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_ts from events group by 1"""
)
def ingested_table_audit(spark, sf):
    """The audit of a table that ingest filled: rows and times by the day of the file they came in."""
    landing, bronze, state = _land(spark, sf, "landing", *EVENT_HINTS.names), BatchTable(spark, fresh_folder(spark, "bronze")), fresh_folder(spark, "state")
    ingest_json(spark, landing, bronze, state, hints=EVENT_HINTS, files_per_trigger=FILES_PER_TRIGGER)
    day = F.regexp_extract("source_path", "day=([0-9-]+)", 1).alias("load_date")
    rows = bronze.read().select(day, F.col("ts").cast("timestamp").alias("ts"))
    return ingestion_audit(rows, ["load_date"], "ts")


def _documents(spark, sf):
    """One market document per order, by status: quarter hours, hours, or an acknowledgement without prices.

    A document has four points; the third is left out for urgent orders. Those of high
    priority have a namespace prefix.
    """
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'Z'")
    price = F.col("o_totalprice").cast("decimal(12,2)")

    resolution = F.when(F.col("o_orderstatus") == "O", "PT15M").otherwise("PT60M")

    def document(p, name):
        """With a namespace prefix for every element, or none."""

        def point(position):
            body = F.concat(
                F.lit(f"<{p}Point><{p}position>{position}</{p}position><{p}price.amount>"),
                price + position,
                F.lit(f"</{p}price.amount></{p}Point>"),
            )
            return F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(body) if position == 3 else body

        return F.concat(
            F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<{p}Publication_MarketDocument {name}="urn:market:publication"><{p}TimeSeries>'),
            F.lit(f"<{p}currency_Unit.name>EUR</{p}currency_Unit.name><{p}price_Measure_Unit.name>MWH</{p}price_Measure_Unit.name>"),
            F.lit(f"<{p}Period><{p}timeInterval><{p}start>"), start, F.lit(f"</{p}start></{p}timeInterval><{p}resolution>"), resolution,
            F.lit(f"</{p}resolution>"), *[point(i) for i in (1, 2, 3, 4)],
            F.lit(f"</{p}Period></{p}TimeSeries></{p}Publication_MarketDocument>"),
        )

    publication = F.when(F.col("o_orderpriority") == "2-HIGH", document("m:", "xmlns:m")).otherwise(document("", "xmlns"))
    acknowledgement = F.lit('<Acknowledgement_MarketDocument xmlns="urn:market:acknowledgement"><Reason/></Acknowledgement_MarketDocument>')
    body = F.when(F.col("o_orderstatus") == "P", acknowledgement).otherwise(publication)
    return table(spark, sf, "orders").select("o_orderkey", body.alias("body"))


@case(
    """select o_orderkey, strftime(o_orderdate + to_minutes(cast((position - 1) * case when o_orderstatus = 'O' then 15 else 60 end as bigint)),
        '%Y-%m-%dT%H:%M:%SZ') as timestamp_utc, cast(cast(o_totalprice as decimal(12,2)) + position as double) as price,
        'EUR' as currency, 'MWH' as unit
    from orders, (select unnest([1, 2, 3, 4]) as position)
    where o_orderstatus <> 'P' and not (o_orderpriority = '1-URGENT' and position = 3)"""
)
def xml_points_explode(spark, sf):
    return price_points(_documents(spark, sf), "body", ["o_orderkey"])


@case(
    """select strftime(o_orderdate + to_minutes(cast((position - 1) * case when o_orderstatus = 'O' then 15 else 60 end as bigint)),
        '%Y-%m-%dT%H:%M:%SZ') as timestamp_utc, cast(cast(o_totalprice as decimal(12,2)) + position as double) as price,
        'EUR' as currency, 'MWH' as unit
    from orders, (select unnest([1, 2, 3, 4]) as position)
    where o_orderstatus <> 'P' and not (o_orderpriority = '1-URGENT' and position = 3)"""
)
def xml_files_explode(spark, sf):
    """The same documents put together in files: a series per order, a document per month, status and prefix."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    body = _documents(spark, sf).join(orders, "o_orderkey")
    prefix = F.when((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") != "P"), "m").otherwise("")
    doc = F.concat_ws("-", F.date_format("o_orderdate", "yyyy-MM"), "o_orderstatus", prefix).alias("doc")
    parts = [F.regexp_extract("body", r"(?s)^(.*?)(<(?:m:)?TimeSeries>.*TimeSeries>)(.*)$", k) for k in (1, 2, 3)]
    cut = body.select(doc, "o_orderkey", "body", *[p.alias(n) for p, n in zip(parts, ("head", "series", "foot"))])
    series = cut.filter("series <> ''").select("doc", F.col("o_orderkey").cast("long").alias("at"), F.col("series").alias("value"))
    whole = F.when(F.col("series") == "", F.col("body"))
    ends = cut.groupBy("doc").agg(F.min(F.coalesce(whole, "head")).alias("head"), F.min("foot").alias("foot"))
    both = [F.struct(F.lit(at).cast("long").alias("at"), F.col(c).alias("value")) for at, c in ((-1, "head"), (2**62, "foot"))]
    ends = ends.select("doc", F.explode(F.array(*both)).alias("e"))
    lines = series.unionByName(ends.select("doc", "e.*"))
    path = fresh_folder(spark, "documents")
    lines.repartition("doc").sortWithinPartitions("doc", "at").select("doc", "value").write.partitionBy("doc").text(path)
    return price_points_of_files(spark, path)
