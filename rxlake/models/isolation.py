"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs of built-in functions.

Each tree draws its own sample of at most ``sample_size`` rows. All trees grow together, one level
after the other, and all rows are scored against the grown trees. A forest is bounded by trees and
sample size, whatever the number of rows.

Every choice follows from MD5 digests of seed, tree, node and key, so a forest can be grown again by
any engine. Features count in single precision. Splits are uniform between the extremes of a node's
rows, so scaling a feature changes nothing and none is scaled.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.operators.keyed import with_global_rank
from rxlake.sources.scratch import stored

_PRIME = 2**31 - 1
_UNITS = 10**9  # path lengths are added up as whole numbers, in any order alike


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))


def _number(digest: Column, start: int, digits: int) -> Column:
    """Some hexadecimal digits of a digest as a whole number."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def _mean_path(n: Column) -> Column:
    """The mean depth at which n rows would be told apart."""
    n = n.cast("double")
    long = 2.0 * (F.log(n - 1.0) + float(np.euler_gamma)) - 2.0 * (n - 1.0) / n
    return F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(long)


def deepest(sample_size: int) -> int:
    return math.ceil(math.log2(max(sample_size, 2)))


def with_values(df: DataFrame, features: list[str], out: str) -> DataFrame:
    """The features in single precision as one array column."""
    return df.withColumn(out, F.array(*[F.col(f).cast("float").cast("double") for f in features]))


def tree_samples(
    df: DataFrame, n: int, trees: int, sample_size: int, seed: int, key: str, values: str
) -> DataFrame:
    """(tree, values) rows: per tree the ``sample_size`` rows with the smallest places, ties by key.

    A tree's place of a row is a line through the row's number, modulo a prime, with a slope and an
    offset of its own. The bar is set so that each tree gets a few more rows than it needs, and only
    those rows are exploded and ranked.
    """
    want = min(sample_size, n)
    share = min(1.0, (want + 8 * math.sqrt(want) + 16) / n)
    lines = []
    for tree in range(trees):
        digits = hashlib.md5(f"{seed}:{tree}".encode()).hexdigest()
        slope, offset = 1 + int(digits[:8], 16) % (_PRIME - 1), int(digits[8:16], 16) % _PRIME
        lines.append(
            F.struct(
                F.lit(tree).alias("tree"),
                F.lit(slope).cast("long").alias("slope"),
                F.lit(offset).cast("long").alias("offset"),
            )
        )
    number = _number(_digest(F.lit(seed), F.col(key)), 1, 12) % _PRIME
    numbered = df.select(key, values, number.alias("_number"))

    def place(line: Column) -> Column:
        return (line["slope"] * F.col("_number") + line["offset"]) % _PRIME

    def below(share: float) -> DataFrame:
        bar = math.ceil(share * _PRIME)
        hits = F.filter(F.array(*lines), lambda line: place(line) < bar)
        found = numbered.select(key, values, "_number", F.explode(hits).alias("_line"))
        return found.select(key, values, F.col("_line.tree").alias("tree"), place(F.col("_line")).alias("_place"))

    # The bar moves up until every tree has enough rows.
    drawn = stored(below(share), "drawn")
    while share < 1 and drawn.groupBy("tree").count().filter(F.col("count") >= want).count() < trees:
        share = min(1.0, 2 * share)
        drawn = stored(below(share), "drawn")
    w = Window.partitionBy("tree").orderBy("_place", key, values)
    return (
        drawn.withColumn("_order", F.row_number().over(w))
        .filter(F.col("_order") <= want)
        .select("tree", values)
    )


def grow_trees(samples: DataFrame, sample_size: int, seed: int, values: str, features: int) -> DataFrame:
    """One row per node: (tree, node, size, feature, split, path).

    The root is node 1, the children of node k are 2 k (up to the split) and 2 k + 1. A leaf has
    feature -1 and the path length of the rows that end there, in units of 1e-9. Rows stay with their
    tree from level to level, so all levels together take one shuffle.
    """
    levels = deepest(sample_size)
    node = Window.partitionBy("tree", "node")

    def of(column: str, i: Column | int) -> Column:
        return F.get(F.col(column), F.lit(i) if isinstance(i, int) else i)

    entry = "array<struct<node: int, size: int, feature: int, split: double, path: bigint>>"
    rows = samples.select("tree", F.lit(1).alias("node"), values, F.array().cast(entry).alias("_way"))
    rows = rows.withColumn("_done", F.lit(False))
    for depth in range(levels + 1):
        rows = rows.withColumns(
            {
                "_size": F.count("*").over(node).cast("int"),
                "_low": F.array(*[F.min(of(values, i)).over(node) for i in range(features)]),
                "_high": F.array(*[F.max(of(values, i)).over(node) for i in range(features)]),
                "_digest": _digest(F.lit(seed), F.col("tree"), F.col("node")),
            }
        )
        varied = F.filter(
            F.sequence(F.lit(0), F.lit(features - 1)), lambda i: of("_low", i) < of("_high", i)
        )
        rows = rows.withColumn("_varied", varied if depth < levels else F.array().cast("array<int>"))
        which = _number(F.col("_digest"), 7, 6) % F.greatest(F.size("_varied"), F.lit(1))
        rows = rows.withColumn("_feature", F.coalesce(of("_varied", which.cast("int")), F.lit(-1)))
        # 24 bits and a half: strictly between two single-precision numbers, so no child is empty.
        share = (_number(F.col("_digest"), 1, 6) + 0.5) / float(1 << 24)
        low, high = of("_low", F.col("_feature")), of("_high", F.col("_feature"))
        rows = rows.withColumn("_split", F.coalesce(low + share * (high - low), F.lit(0.0)))
        leaf = F.col("_feature") < 0
        path = F.round((depth + _mean_path(F.col("_size"))) * float(_UNITS)).cast("long")
        here = F.struct(
            F.col("node").alias("node"),
            F.col("_size").alias("size"),
            F.col("_feature").alias("feature"),
            F.col("_split").alias("split"),
            F.when(leaf, path).otherwise(0).alias("path"),
        )
        right = (of(values, F.col("_feature")) > F.col("_split")).cast("int")
        rows = rows.select(
            "tree",
            F.when(leaf, F.col("node")).otherwise(2 * F.col("node") + right).alias("node"),
            values,
            F.when(F.col("_done"), F.col("_way")).otherwise(F.concat("_way", F.array(here))).alias("_way"),
            (F.col("_done") | leaf).alias("_done"),
        )
    nodes = rows.select("tree", F.explode("_way").alias("_at")).select("tree", "_at.*")
    return nodes.dropDuplicates(["tree", "node"])


def score_rows(
    df: DataFrame, nodes: DataFrame, trees: int, sample_size: int, values: str, row: str
) -> DataFrame:
    """Add ``_path``, the sum of a row's path lengths, and ``_score``: minus the anomaly score, so
    lower is more anomalous. ``row`` names a column that tells rows apart.

    Every row goes down all trees, a level per join with the node table. That table is broadcast: it
    has fewer than 2 * trees * sample_size rows.
    """
    levels = deepest(sample_size)
    slots = 2 << levels
    at = (F.col("tree") * slots + F.col("node")).cast("long")
    table = F.broadcast(nodes.select(at.alias("_at"), "feature", "split", "path"))
    first = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: (t * slots + 1).cast("long"))
    walk = df.select(row, values, F.explode(first).alias("_at"))
    for _ in range(levels):
        right = (F.get(F.col(values), F.col("feature")) > F.col("split")).cast("long")
        root = F.shiftleft(F.shiftright("_at", levels + 1), levels + 1)
        child = 2 * F.col("_at") - root + right
        step = F.when(F.col("feature") < 0, F.col("_at")).otherwise(child)
        walk = walk.join(table, "_at").select(row, values, step.alias("_at"))
    paths = walk.join(table, "_at").groupBy(row).agg(F.sum("path").alias("_path"))
    mean = F.col("_path") / float(_UNITS) / float(trees)
    norm = 1.0
    if sample_size > 2:
        norm = 2.0 * (math.log(sample_size - 1.0) + float(np.euler_gamma))
        norm -= 2.0 * (sample_size - 1.0) / sample_size
    return df.join(paths, row).withColumn("_score", -F.pow(F.lit(2.0), -mean / norm))


def isolation_forest(
    df: DataFrame,
    features: list[str],
    trees: int = 100,
    contamination: float = 0.05,
    seed: int = 42,
    sample_size: int = 256,
    key: str = "ndc",
) -> DataFrame:
    """Rows with ``anomaly_score`` (-1 or 1), ``anomaly_raw_score`` and ``is_anomaly``.

    Rows with a missing feature are left out; rows with equal features get equal scores. The raw score is the distance to the score of
    the ``contamination`` quantile (interpolated); below zero is an anomaly.
    """
    values, row = "_values", "_row"
    # One row per drug, read by every step below: stored once, so its numbers stay.
    ready = with_values(df.na.drop(subset=features), features, values)
    ready = stored(ready.withColumn(row, F.monotonically_increasing_id()), "drugs")
    n = ready.count()
    if n == 0:
        raise ValueError("no complete rows to score")
    size = min(sample_size, n)
    samples = tree_samples(ready, n, trees, sample_size, seed, key, values)
    nodes = stored(grow_trees(samples, size, seed, values, len(features)), "nodes")
    # Sorting reads its input twice, scoring should not.
    scored = stored(score_rows(ready, nodes, trees, size, values, row).drop(values, row), "scored")
    ranked = with_global_rank(scored, [F.col("_path"), F.col(key)])
    place = contamination * (n - 1)
    lower = math.floor(place)
    around = {
        r["_rank"]: r["_score"]
        for r in ranked.filter(F.col("_rank").isin(lower + 1, min(lower + 2, n)))
        .select("_rank", "_score")
        .collect()
    }
    low, high = around[lower + 1], around[min(lower + 2, n)]
    offset = low + (high - low) * (place - lower)
    raw = F.col("_score") - offset
    return (
        ranked.withColumn("anomaly_raw_score", raw)
        .withColumn("is_anomaly", (raw < 0).cast("int"))
        .withColumn("anomaly_score", F.when(raw < 0, -1).otherwise(1))
        .drop("_path", "_score", "_rank", "_total")
    )


def anomaly_share(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.sum("is_anomaly").alias("anomalies"),
        F.round(F.avg("is_anomaly") * 100, 1).alias("pct"),
    )


def top_anomalies(scored: DataFrame, dim_drug: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most anomalous drugs, with a display name."""
    from rxlake.operators.prices import display_name, with_drug_names

    worst = (
        scored.filter(F.col("is_anomaly") == 1).orderBy("anomaly_raw_score", "ndc").limit(k)
    )
    return (
        with_drug_names(worst, dim_drug)
        .select(
            "ndc",
            display_name(33).alias("drug_name"),
            "mean_price",
            "latest_price",
            "latest_deviation",
            "coefficient_of_variation",
            "anomaly_raw_score",
        )
        .orderBy("anomaly_raw_score", "ndc")
    )


def anomaly_profile(scored: DataFrame) -> DataFrame:
    """Mean price features of anomalous and normal drugs."""
    means = {
        "avg_mean_price": "mean_price",
        "avg_stddev": "price_stddev",
        "avg_cv": "coefficient_of_variation",
        "avg_deviation": "latest_deviation",
        "avg_range_ratio": "range_to_mean_ratio",
    }
    return scored.groupBy("is_anomaly").agg(
        *[F.round(F.avg(c), 4).alias(name) for name, c in means.items()],
        F.count("*").alias("count"),
    )
