"""Near-real-time refresh: new document lines and changed headers mark days as touched, and touched days are rebuilt.

Days are rebuilt whole because distinct ticket counts cannot be added up from increments. A batch
that is replayed after a failure rebuilds the same days to the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cyclemart.operators.daily import placed_actuals
from cyclemart.operators.fact import placed_fact
from cyclemart.operators.goals import goal_days, placed_goals
from cyclemart.session import materialise
from cyclemart.sources.retail import ITEM_FILES, RetailSource
from cyclemart.sources.warehouse import Warehouse
from cyclemart.streaming.late import note_late

#: What a header says about its documents' rows in the fact.
HEADER_STATE = ("o_custkey", "o_orderstatus", "o_orderdate")
#: Headers as last seen, a table of the refresh beside those of the warehouse.
SEEN_HEADERS = "_headers_seen"
#: Most ranges of months that a rebuild scans one by one; beyond it the nearest are scanned as one.
MOST_RANGES = 6


def item_stream(spark: SparkSession, path: str, pattern: str = ITEM_FILES, files_per_batch: int | None = None) -> DataFrame:
    """New item files below ``path`` as a stream."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(path).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def touched_days(items: DataFrame, source: RetailSource) -> DataFrame:
    """Days that new items fall on: the order's day, or the shipping day of a return."""
    orders = source.table("orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    joined = items.select("l_orderkey", "l_returnflag", "l_shipdate").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    returned = (F.col("o_orderstatus") != "P") & (F.col("l_returnflag") == "R")
    day = F.to_date(F.when(returned, F.col("l_shipdate")).otherwise(F.col("o_orderdate")))
    return joined.select(day.alias("id_tempo")).distinct()


def header_days(before: DataFrame, after: DataFrame, source: RetailSource) -> DataFrame:
    """Days that differ between two states of the headers: the old and new day of each header that was added, changed
    or removed, and the shipping days of its returned items."""
    old = before.select("o_orderkey", F.struct(*HEADER_STATE).alias("old"))
    new = after.select("o_orderkey", F.struct(*HEADER_STATE).alias("new"))
    changed = materialise(
        old.join(new, "o_orderkey", "full_outer").filter(~F.col("old").eqNullSafe(F.col("new"))).select(
            "o_orderkey", F.array("old.o_orderdate", "new.o_orderdate").alias("dias")), "changed-headers")
    own = changed.select(F.explode("dias").alias("dia")).select(F.to_date("dia").alias("id_tempo"))
    returned = source.table("lineitem", "l_orderkey", "l_returnflag", "l_shipdate").filter("l_returnflag = 'R'").join(
        changed, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return own.unionAll(returned.select(F.to_date("l_shipdate").alias("id_tempo"))).filter("id_tempo IS NOT NULL").distinct()


def within_bound(days: DataFrame, since: date | None) -> DataFrame:
    """Days from ``since`` on. The bound is the caller's, one for the whole run, so what it leaves out does not depend on
    how files fall into batches."""
    return days if since is None else days.filter(F.col("id_tempo") >= F.lit(since))


def day_ranges(days: DataFrame) -> list[tuple[date, date]]:
    """Ranges that hold all the days, from the first to the last of each run of months; at most ``MOST_RANGES``, the
    smallest gaps being closed first. A late day of years ago does not make the years between be read."""
    months = days.groupBy(F.trunc("id_tempo", "month").alias("mes")).agg(F.min("id_tempo"), F.max("id_tempo")).orderBy("mes").collect()
    ranges = [(first, last) for _, first, last in months]
    gaps = sorted(range(1, len(ranges)), key=lambda k: ranges[k][0] - ranges[k - 1][1])
    apart = {k for k in gaps[max(0, len(gaps) - MOST_RANGES + 1):] if (ranges[k][0] - ranges[k - 1][1]).days > 31}
    out: list[tuple[date, date]] = []
    for k, (first, last) in enumerate(ranges):
        if out and k not in apart:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def rebuild_days(source: RetailSource, days: DataFrame) -> DataFrame | None:
    """Fact rows of the given days, from scans bounded by their months."""
    ranges = day_ranges(days)
    if not ranges:
        return None
    first, last = ranges[0][0], ranges[-1][1]
    wanted = days.select(F.col("id_tempo").alias("data_ref"))
    lines = reduce(DataFrame.unionByName, [source.movements(r) for r in ranges])
    near = source.spanning(first, last)
    open_days = goal_days(near.goal_cycles(), source.rules, first, last, wanted)
    goals = placed_goals(near.goal_sellers(), source.sellers(), open_days)
    return placed_fact(placed_actuals(lines.join(wanted, "data_ref", "left_semi")), goals, open_days)


def _rebuild(warehouse: Warehouse, source: RetailSource, touched: DataFrame, since: date | None) -> None:
    """Rebuild the days within the bound and note the others."""
    touched = materialise(touched, "touched-days")
    days = within_bound(touched, since)
    rows = rebuild_days(source, days)
    if rows is not None:
        # A fact holds each key once.
        warehouse.replace_days(rows, days, placed=True)
    if since is not None:
        note_late(warehouse, touched.filter(F.col("id_tempo") < F.lit(since)))


def refresh_batch(warehouse: Warehouse, source: RetailSource, since: date | None = None) -> Callable:
    def apply(batch: DataFrame, epoch: int) -> None:
        _rebuild(warehouse, source, touched_days(batch, source), since)

    return apply


def refresh_headers(warehouse: Warehouse, source: RetailSource, since: date | None = None) -> None:
    """Rebuild the days of headers that were added, changed or removed since the last call; the first call only notes them.

    The headers are compared by key with those last seen, one join of two narrow tables. They are noted after the rebuild: a
    run that fails is done again by the next one.
    """
    path = warehouse.current_path(warehouse.path(SEEN_HEADERS))
    after = materialise(source.table("orders", "o_orderkey", *HEADER_STATE), "headers")
    if warehouse.exists(path):
        touched = header_days(warehouse.spark.read.parquet(path), after, source)
        _rebuild(warehouse, source, touched, since)
    warehouse.switch(after, warehouse.path(SEEN_HEADERS))


def start_refresh(items: DataFrame, warehouse: Warehouse, source: RetailSource, checkpoint: str, *,
                  every: str | None = None, since: date | None = None) -> StreamingQuery:
    """Run the refresh at an interval such as "10 minutes", or once over what is there."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        items.writeStream.foreachBatch(refresh_batch(warehouse, source, since))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
