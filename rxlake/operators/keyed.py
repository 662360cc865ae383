"""Per-key picks, and ordering a whole DataFrame without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rxlake.sources.scratch import shared_folder, stored


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (which must be total over the group).

    Spark cuts each map task's rows to the best one per key before the shuffle, so a key
    that owns a large part of the table costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def ascending(columns: list[str]) -> list[Column]:
    """A tie-breaking order on the given columns, NULL first."""
    return [F.col(c).asc_nulls_first() for c in columns]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point checkpoints at the folder that all executors share."""
    wanted, current = shared_folder(spark), spark.sparkContext.getCheckpointDir()
    if current is None or not f"{current}/".startswith(f"{wanted}/"):
        spark.sparkContext.setCheckpointDir(wanted)
    return spark.sparkContext.getCheckpointDir()


def with_global_rank(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``_rank`` (1-based position in ``order``) and ``_total`` to every row.

    Range-sorts the rows, so equal or skewed sort values still spread over all tasks as
    long as ``order`` is total. The sorted rows are stored, so the partition sizes
    and the positions inside them come from one and the same run even if a task is redone.
    Only one row per partition is broadcast.
    """
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed, "placed")
    chunk = F.shiftright("_place", 33)
    sizes = placed.groupBy(chunk.alias("_chunk")).agg(F.count("*").alias("_size"))
    # One row per partition, so these windows over the whole frame stay tiny.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = sizes.select(
        "_chunk",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(everything).alias("_total"),
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_chunk", chunk)
        .join(F.broadcast(starts), "_chunk")
        .withColumn("_rank", F.col("_start") + position + 1)
        .drop("_chunk", "_place", "_start")
    )


def ntile_of_rank(n: int) -> Column:
    """The ``ntile(n)`` group of a row carrying ``_rank`` and ``_total``."""
    size, longer = f"(_total div {n})", f"(_total % {n})"
    head = f"{longer} * ({size} + 1)"  # rows in the groups that hold one row more
    return F.expr(
        f"CAST(1 + CASE WHEN _rank <= {head} THEN (_rank - 1) div ({size} + 1) "
        f"ELSE {longer} + (_rank - 1 - {head}) div greatest({size}, 1L) END AS INT)"
    )


def exact_quantile(
    df: DataFrame, groups: list[str], value: str, q: float, slices: int = 1024, few: int = 10_000,
    count: str | None = None,
) -> DataFrame:
    """The value at place ceil(q * n) of each group's known values, with no task per group.

    ``count`` names a column with the number of times a row's value counts, so that values already
    counted need not be read again. Values are counted first. Then the range that holds the place is cut into slices by value
    and narrowed to one of them, until few distinct values are left of every group. A round is
    one aggregation of at most ``slices`` rows per group, whatever the number of values.
    """
    keys = [f"_g{i}" for i in range(max(len(groups), 1))]
    named = [F.col(g).alias(k) for g, k in zip(groups, keys)] or [F.lit(0).alias(keys[0])]
    times = F.lit(1).cast("long") if count is None else F.col(count).cast("long")
    counted = df.filter(F.col(value).isNotNull()).select(*named, F.col(value).alias("_v"), times.alias("_n"))
    counted = counted.groupBy(*keys, "_v").agg(F.sum("_n").alias("_n")).filter("_n > 0")
    counted = stored(counted, "counted")
    total = F.sum("_n")
    place = F.greatest(F.lit(1), total - F.floor(total - q * total)).cast("long")
    upto = Window.partitionBy(*keys)
    wanted = counted.groupBy(*keys).agg(place.alias("_place"))
    while True:
        bounds = counted.groupBy(*keys).agg(
            F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_k")
        )
        wanted = stored(_null_safe(wanted, bounds, keys), "wanted")
        if (wanted.agg(F.max("_k")).first()[0] or 0) <= few:
            break
        wide = F.when(F.col("_hi") > F.col("_lo"), (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
        sliced = _null_safe(counted, wanted, keys).withColumn(
            "_slice", F.floor(F.coalesce(wide, F.lit(0.0)) * slices)
        )
        sums = sliced.groupBy(*keys, "_place", "_slice").agg(F.sum("_n").alias("_s"))
        sums = sums.withColumn("_end", F.sum("_s").over(upto.orderBy("_slice")))
        hit = sums.filter((F.col("_end") >= F.col("_place")) & (F.col("_end") - F.col("_s") < F.col("_place")))
        hit = stored(
            hit.select(*keys, "_slice", (F.col("_place") - F.col("_end") + F.col("_s")).alias("_place")), "hit"
        )
        inside = _null_safe(sliced.drop("_place"), hit.withColumnRenamed("_slice", "_in"), keys)
        counted = stored(inside.filter("_slice = _in").select(*keys, "_v", "_n"), "counted")
        wanted = hit.drop("_slice")
    placed = _null_safe(counted, wanted, keys).withColumn("_end", F.sum("_n").over(upto.orderBy("_v")))
    found = placed.filter((F.col("_end") >= F.col("_place")) & (F.col("_end") - F.col("_n") < F.col("_place")))
    return found.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], F.col("_v").alias(value))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where NULL keys meet; the right side has a row per group."""
    other = right.withColumnsRenamed({k: f"{k}_r" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
    return left.join(other, same, "inner").drop(*[f"{k}_r" for k in keys])
