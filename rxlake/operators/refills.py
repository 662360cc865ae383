"""Gaps between consecutive fills of one drug by one patient.

Fills of a (patient, drug) pair are taken in order of service date (unknown dates first), days
supply and claim id; fills equal in these, in order of their amounts. A gap within ``grace`` times the
previous fill's days supply is on time; a gap that cannot be computed is late.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlake.sources.scratch import stored

PAIR = ["beneficiary_id", "ndc"]


def _usable(fills: DataFrame) -> DataFrame:
    return fills.filter(F.col("days_supply") > 0)


def _equal(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """Where two columns agree; NULL agrees with NULL."""
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    return np.asarray(pc.or_(pc.fill_null(pc.equal(a, b), False), both_null))


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to the sorted rows of one partition what the row before has, and the number in the pair.

    ``_open`` marks the rows of the partition's first pair, which may have begun in another one. The first
    row of any other pair has no predecessor and is left out, unless it may be the partition's last one.
    """
    chunk, before, position, is_open = TaskContext.get().partitionId(), None, 0, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        whole = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks()
        linked = np.ones(n, bool)  # to the row before, or to an earlier partition
        at = n - whole.num_rows + 1
        linked[at:] = np.logical_and.reduce([_equal(whole[c].slice(1), whole[c].slice(0, whole.num_rows - 1)) for c in PAIR])
        start = np.maximum.accumulate(np.where(linked, -1, np.arange(n)))
        number = np.where(start < 0, np.arange(n) + 1 + position, np.arange(n) - start + 1)
        known = linked.copy()
        known[:at] = False

        def shifted(name: str, whole: pa.Table = whole, known: np.ndarray = known, at: int = at, n: int = n) -> pa.Array:
            column = whole[name].combine_chunks()
            rows = pa.array(np.maximum(np.arange(n) - at, 0))
            return pc.if_else(pa.array(known), column.take(rows), pa.scalar(None, column.type))

        is_first = (start < 0) & is_open
        wanted = is_first | (number > 1)
        wanted[-1] = True
        rows = pa.RecordBatch.from_arrays(
            [
                *batch.columns, shifted("service_date"), shifted("days_supply"), pa.array(number),
                pa.array(is_first), pa.array(np.full(n, chunk, np.int32)),
            ],
            [*batch.schema.names, "_date", "_supply", "_number", "_open", "_chunk"],
        )
        yield rows.filter(pa.array(wanted))
        is_open = is_open and bool((start < 0).all())
        before, position = batch.slice(n - 1), int(number[-1])


def _borders(linked: DataFrame) -> DataFrame:
    """Per partition what its first pair had before it: number of fills, and last date and supply.

    The first and the last row of each partition are all that is looked at. A pair may fill many
    partitions; those before add their fills up.
    """
    of = [F.col(c) for c in PAIR]
    ends = linked.groupBy("_chunk").agg(
        F.min_by(F.struct(*of), F.when(F.col("_open"), F.col("_number"))).alias("first"),
        F.max_by(F.struct(*of, "service_date", "days_supply", "_number"), "_place").alias("last"),
    )
    nothing = [F.lit(None).cast("date").alias("date"), F.lit(None).cast("int").alias("supply"), F.lit(0).cast("long").alias("fills")]
    wants = ends.select("_chunk", F.lit(0).alias("gives"), *[F.col(f"first.{c}").alias(c) for c in PAIR], *nothing)
    gives = ends.select(
        "_chunk", F.lit(1).alias("gives"), *[F.col(f"last.{c}").alias(c) for c in PAIR],
        F.col("last.service_date").alias("date"), F.col("last.days_supply").alias("supply"), F.col("last._number").alias("fills"),
    )
    earlier = Window.partitionBy(*PAIR).orderBy("_chunk", "gives").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max_by(F.struct("date", "supply"), F.when(F.col("gives") == 1, F.col("_chunk"))).over(earlier)
    carried = wants.unionByName(gives).withColumns(
        {"_before": F.coalesce(F.sum("fills").over(earlier), F.lit(0)), "_last": last}
    )
    return carried.filter("gives = 0").select(F.col("_chunk").alias("_at"), "_before", "_last")


def refill_sequences(fills: DataFrame, grace: float = 1.5) -> DataFrame:
    """Every fill that has a predecessor, with the gap to it.

    One range sort puts the fills in order, so a pair that owns a large part of all fills is spread
    over many partitions. Each partition links its own rows, and one row per partition is carried
    over the border to the next.
    """
    order = [*PAIR, "service_date", "days_supply", "pde_id", "total_rx_cost", "quantity_dispensed", "patient_pay_amount"]
    rows = _usable(fills).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    shape = T.StructType([*rows.schema.fields]).add("_date", T.DateType()).add("_supply", T.IntegerType())
    shape = shape.add("_number", T.LongType()).add("_open", T.BooleanType()).add("_chunk", T.IntegerType())
    linked = stored(rows.mapInArrow(_link, shape), "linked")  # read for the borders and for the rows
    placed = linked.join(F.broadcast(_borders(linked)), F.col("_chunk") == F.col("_at"))
    crosses = F.col("_open") & (F.col("_number") == 1)
    placed = placed.withColumns(
        {
            "prev_fill_date": F.when(crosses, F.col("_last.date")).otherwise(F.col("_date")),
            "prev_days_supply": F.when(crosses, F.col("_last.supply")).otherwise(F.col("_supply")),
            "fill_number": F.col("_number") + F.when(F.col("_open"), F.col("_before")).otherwise(0),
        }
    ).filter(F.col("fill_number") > 1)
    gap = F.datediff("service_date", "prev_fill_date")
    on_time = F.when(gap <= F.col("prev_days_supply") * grace, 1).otherwise(0)
    return placed.select(
        *fills.columns,
        "prev_fill_date",
        "prev_days_supply",
        "fill_number",
        gap.alias("days_between_fills"),
        on_time.alias("refilled_on_time"),
    )


def refill_stats(fills: DataFrame, grace: float = 1.5) -> DataFrame:
    """Refill behaviour per patient with at least one refill.

    Equal to aggregating ``refill_sequences``, but fills are first summed up per patient,
    drug and day, with partial sums before the shuffle. Fills of one day follow each other
    with no gap, so only the first one of a day needs the day before, and the window sees
    at most one row per calendar day.
    """
    days = (
        _usable(fills)
        .groupBy(*PAIR, "service_date")
        .agg(
            F.count("*").alias("n"),
            F.sum("days_supply").alias("supply"),
            F.min("days_supply").alias("first_supply"),
            F.max("days_supply").alias("last_supply"),
        )
    )
    order = Window.partitionBy(*PAIR).orderBy(F.col("service_date").asc_nulls_first())
    gap = F.datediff("service_date", F.lag("service_date").over(order))
    starts = F.row_number().over(order) == 1
    dated = F.col("service_date").isNotNull()
    steps = days.select(
        "beneficiary_id",
        "n",
        "supply",
        "first_supply",
        starts.alias("starts"),
        gap.alias("gap"),
        (dated & (gap <= F.lag("last_supply").over(order) * grace)).alias("in_time"),
        F.when(dated, F.col("n") - 1).otherwise(0).alias("same_day"),
    )
    return (
        steps.groupBy("beneficiary_id")
        .agg(
            F.sum(F.col("n") - F.col("starts").cast("int")).alias("total_refill_opportunities"),
            F.sum(
                F.col("same_day") + F.when(F.col("in_time"), 1).otherwise(0)
            ).alias("on_time_refills"),
            F.sum("gap").alias("gap_days"),
            F.sum(F.col("same_day") + F.col("gap").isNotNull().cast("int")).alias("gaps"),
            F.sum(
                F.col("supply") - F.when(F.col("starts"), F.col("first_supply")).otherwise(0)
            ).alias("supply_days"),
        )
        .filter(F.col("total_refill_opportunities") > 0)
        .select(
            "beneficiary_id",
            "total_refill_opportunities",
            "on_time_refills",
            # All gaps may be unknown dates: then there is no mean gap.
            F.when(
                F.col("gaps") > 0, F.coalesce("gap_days", F.lit(0)) / F.col("gaps")
            ).alias("avg_gap_days"),
            (F.col("supply_days") / F.col("total_refill_opportunities")).alias("avg_days_supply"),
            (F.col("on_time_refills") / F.col("total_refill_opportunities")).alias(
                "historical_refill_rate"
            ),
        )
    )


def mean_refill_rate(stats: DataFrame) -> DataFrame:
    """Patients with refills and their mean on-time rate."""
    return stats.agg(
        F.count("*").alias("patients"),
        F.avg("historical_refill_rate").alias("mean_refill_rate"),
    )
