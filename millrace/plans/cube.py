"""One stored cube that answers all questions of the dashboard, under any filter of its dimensions.

Averages cannot be averaged again, so the cube holds sums and counts, in whole units of the last
digit, at the grains that the questions need, all from one scan of the fact. A question takes
the coarsest grain that has its dimensions and filters, and sums up. The cube lies in slices of a zone
and a month; a changed slice of the fact rebuilds its own month only.
"""

from __future__ import annotations

import calendar
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.functions.decimals import from_units, half_up_mean, to_units
from millrace.operators.metrics import apply_filters
from millrace.session import materialise
from millrace.sources.slices import PREFIX, SliceTable

# From coarse to fine: every grain has the zone and the month of its slice.
GRAINS = (("bidding_zone", "month", "date"), ("bidding_zone", "month", "site_id", "hour"), ("bidding_zone", "month", "site_id", "date"))
MEASURES = {"kwh": ("avg_consumption_kwh", 2), "pue": ("avg_pue", 3), "cost": ("cost_per_hour", 2)}  # column of the fact, its digits
DIMENSIONS = ("bidding_zone", "month", "site_id", "date", "hour")
ROWS_PER_TASK = 500_000  # of the fact; a task keeps their groups of all grains in memory

Filters = Mapping[str, object] | None


def cube_schema() -> StructType:
    measures = ", ".join(f"{m} bigint, n_{m} bigint" for m in MEASURES)
    return StructType.fromDDL(f"grain int, bidding_zone string, month string, site_id string, date date, hour int, {measures}")


def build_cube(fact: DataFrame) -> DataFrame:
    """Sums in units and counts of every measure, at every grain; a dimension that a grain lacks is NULL.

    The fact should be stored, as its rows are counted first. They are dealt by site, so the groups of
    the fine grains are whole in one task, and no task has more of them than a table of any size gives.
    """
    tasks = max(fact.sparkSession.sparkContext.defaultParallelism, -(-fact.count() // ROWS_PER_TASK))
    rows = fact.repartition(tasks, "bidding_zone", "site_id").withColumn("month", F.date_format("date", "yyyy-MM"))
    units = [F.sum(to_units(F.col(c), digits)).alias(m) for m, (c, digits) in MEASURES.items()]
    counts = [F.count(c).alias(f"n_{m}") for m, (c, _) in MEASURES.items()]
    sets = [[F.col(c) for c in grain] for grain in GRAINS]
    grouped = rows.groupingSets(sets, *[F.col(c) for c in DIMENSIONS]).agg(F.grouping_id().alias("_id"), *units, *counts)
    # a bit of the id is set where the dimension is summed up
    ids = {sum(1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS) if d not in grain): k for k, grain in enumerate(GRAINS)}
    grain = F.create_map(*[F.lit(v) for pair in ids.items() for v in pair])[F.col("_id").cast("int")]
    return grouped.withColumn("grain", grain).select(*cube_schema().names)


class Cube:
    def __init__(self, spark: SparkSession, path: str):
        self.table = SliceTable(spark, path, cube_schema(), {"zone": F.col("bidding_zone"), "month": F.col("month")})

    def rebuild(self, fact: DataFrame) -> None:
        rows = materialise(build_cube(materialise(fact, "fact")), "cube")
        self.table.replace(rows, self.table.counts(rows))

    def refresh(self, fact: SliceTable, changed: Iterable[Row]) -> None:
        """The months of these slices of the fact anew; of the fact only their folders are read."""
        months = {(r[f"{PREFIX}zone"], r[f"{PREFIX}date"][:7]) for r in changed}
        days = []
        for zone, month in sorted(months):
            last = calendar.monthrange(*map(int, month.split("-")))[1]
            days += [Row(**{f"{PREFIX}zone": zone, f"{PREFIX}date": f"{month}-{d:02d}"}) for d in range(1, last + 1)]
        rows = materialise(build_cube(fact.read_slices(days)), "cube")
        own = [Row(**{f"{PREFIX}zone": zone, f"{PREFIX}month": month}) for zone, month in sorted(months)]
        self.table.put(rows, self.table.counts(rows), own)

    def query(self, dimensions: Sequence[str], measures: Mapping[str, Column], equal: Filters = None, derived: Mapping[str, Column] | None = None) -> DataFrame:
        """Group the coarsest grain that has what is asked for; ``derived`` are dimensions computed from it."""
        equal = {c: v for c, v in (equal or {}).items() if v is not None}
        needed = {*equal, *(d for d in dimensions if d not in (derived or {})), *(["date"] if derived else [])}
        grain = next((k for k, g in enumerate(GRAINS) if needed <= set(g)), None)
        if grain is None:
            raise ValueError(f"no grain has {sorted(needed)}")
        rows = apply_filters(self.table.read().filter(F.col("grain") == grain), equal).withColumns(dict(derived or {}))
        aggregates = [c.alias(n) for n, c in measures.items()]
        return rows.groupBy(*dimensions).agg(*aggregates) if dimensions else rows.agg(*aggregates)


def total(measure: str) -> Column:
    return from_units(F.sum(measure), MEASURES[measure][1], 20)


def mean(measure: str) -> Column:
    """Four digits more than the measure has, rounded once, half up."""
    digits = MEASURES[measure][1] + 4
    return half_up_mean(F.sum(measure) * 10**4, F.sum(f"n_{measure}"), digits, digits, 14)


def _counters(cube: Cube, equal: Filters) -> DataFrame:
    rows = cube.query([], {"total_cost": total("cost"), "avg_pue": mean("pue"), "latest_date": F.max("date")}, {"date": None, **(equal or {})}, {"day": F.col("date")})
    return rows.withColumn("latest_weekday", F.date_format("latest_date", "EEEE"))


# The questions of the dashboard, as ``plans.dashboard`` answers them from the fact.
WIDGETS: dict[str, Callable[[Cube, Filters], DataFrame]] = {
    "avg_kwh_by_site_hour": lambda cube, equal: cube.query(["site_id", "hour"], {"avg_kwh": mean("kwh")}, equal),
    "avg_pue_by_site_hour": lambda cube, equal: cube.query(["site_id", "hour"], {"avg_pue": mean("pue")}, equal),
    "total_cost_by_zone": lambda cube, equal: cube.query(["bidding_zone"], {"total_cost": total("cost")}, equal),
    "avg_cost_by_site_date": lambda cube, equal: cube.query(["site_id", "date"], {"avg_cost": mean("cost")}, equal),
    "total_cost_by_weekday": lambda cube, equal: cube.query(
        ["day_of_week_name"], {"total_cost": total("cost")}, equal, {"day_of_week_name": F.date_format("date", "EEEE")}
    ),
    "counters": _counters,
}


def widget(cube: Cube, name: str, equal: Filters = None) -> DataFrame:
    return WIDGETS[name](cube, equal)
