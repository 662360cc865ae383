"""Mixing sources to target weights by the cube method.

A source's share of all words follows its weight, up to a multiple of its own size. Each of its
documents is then wanted ``ratio = target / size of the source`` times: the whole part is taken for
certain, and the fraction is the document's inclusion probability. The cube method turns these
fractions into zeros and ones while the totals of words and of documents stay where they are: in its
flight, the fractions of a few documents at a time move along a direction in the null space of the
totals until one of them lands. A dozen documents of different sizes sit out; with the few that the
flight leaves open they are the landing problem, solved by the choice that is nearest to the totals.

A flight runs on a block of documents of one source, so a source of any size is many small tasks.
The few documents each block leaves open go to the next round's blocks, a hundredth in number, until
one block per source is left.

Defined results: a NULL or blank text has size 0 and is taken 0 words. NULL is a source of its own
and comes last. Repeated rows are documents of their own. Without any words nothing is taken and all
targets are 0; an empty table gives no rows. Equal input gives equal results, in any partitioning if
all rows have an id. Rows without one are spread over blocks by their place in the input, rows equal
in id and text by their number among these, whichever of them has it. Extra columns stay if asked for,
unless a result has their name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxlake.sources.scratch import stored

SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)  # by rank of the source, repeating
    most: float = 3.0  # times a source's own size
    block: int = 2_000  # documents of one flight
    aside: int = 14  # documents of a flight that wait for the landing
    seed: int = 7


def with_size(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the number of words."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), f"[{SPACE}]+", -1), lambda w: w != "")
    return df.withColumn("size", F.size(words).cast("long"))


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source with its size, target and ratio; ``sizes`` has (source, source_size).

    With caps in order of cap per weight, the sources that reach theirs come first, so running sums
    give the level at which all words are placed.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    choices = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = sizes.withColumns(
        {
            "_weight": F.get(choices, (rank - 1) % len(mix.weights)),
            "_cap": mix.most * F.col("source_size"),
            "_rank": rank,
        }
    )
    by_cap = everything.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    capped_before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns(
        {
            "_total": F.sum("source_size").over(everything),
            "_caps_before": F.coalesce(F.sum("_cap").over(capped_before), F.lit(0.0)),
            "_weights_from": F.sum("_weight").over(
                by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
            ),
        }
    )
    level = (F.col("_total") - F.col("_caps_before")) / F.col("_weights_from")
    # Not reached by any source: the first one that stays below its cap sets the level for the rest.
    open_level = F.min(F.when(F.col("_cap") / F.col("_weight") > level, F.struct(F.col("_cap") / F.col("_weight"), level.alias("level")))).over(everything)["level"]
    target = F.least(F.col("_cap"), F.coalesce(F.col("_weight") * open_level, F.col("_cap")))
    return ranked.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("ratio"),
    )


def fly(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move chances until at most two stay open, keeping their sum and their sum weighted by size.

    Each move goes to either end of its segment with the probability that keeps the mean in place,
    so a document is picked as often as its chance says.
    """
    chance = chance.astype(float).copy()
    tiny = 1e-9
    # Chances as good as settled are settled, so that none of them is left to the landing.
    chance[chance <= tiny], chance[chance >= 1 - tiny] = 0.0, 1.0
    waiting = iter(np.flatnonzero((chance > 0) & (chance < 1)))
    active: list[int] = []
    for item in waiting:
        active.append(int(item))
        if len(active) < 3:
            continue
        # A direction u with sum(u) = 0 and sum(u * size) = 0.
        a, b, c = active
        u = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]], float)
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])
        p = chance[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)).min()
            down = np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf)).min()
        p = p + (up if rng.random() * (up + down) < down else -down) * u
        p[np.abs(p) < tiny], p[np.abs(1 - p) < tiny] = 0.0, 1.0
        chance[active] = p
        active = [i for i, x in zip(active, p) if 0 < x < 1]
    return chance


def set_aside(size: np.ndarray, many: int) -> np.ndarray:
    """Which documents, ordered from the longest down, wait for the landing.

    Half of them are near the top, ever further apart, as only long documents can make up for a long
    one; the other half are evenly spread, for the fine adjustment.
    """
    aside = np.zeros(len(size), bool)
    top = np.round(1.6 ** np.arange(many // 2)).astype(int) - 1
    even = np.linspace(0, len(size) - 1, many - many // 2).round().astype(int)
    aside[np.minimum(np.concatenate([top, even]), len(size) - 1)] = True
    return aside


def land(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the open chances to the choice nearest to both totals.

    Every choice is tried; they are few, as a flight leaves few open. The document total may be off
    by two, the word total is brought as near as it goes.
    """
    still = np.flatnonzero((chance > 0) & (chance < 1))
    choices = np.arange(1 << len(still))[:, None] >> np.arange(len(still)) & 1
    words = np.abs(choices @ size[still] - chance[still] @ size[still])
    count = np.abs(choices.sum(1) - chance[still].sum())
    out = chance.copy()
    out[still] = choices[np.argmin(words + (size.max() + 1) * np.maximum(count - 2, 0))]
    return out


def _flight(landing: bool, aside: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The flight of one block, with the landing behind it if nothing follows."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "_order", "_salt", "_uid"], ascending=[False, True, True, True], kind="stable")
        size = block["size"].to_numpy(float)
        rng = np.random.default_rng([seed, int(block["_order"].min()) & ((1 << 63) - 1)])
        chance = block["_chance"].to_numpy(float)
        moving = ~set_aside(size, aside)
        chance[moving] = fly(chance[moving], size[moving], rng)
        if landing:
            chance = land(chance, size)
        return block.assign(_chance=chance)

    return run


def _salted(rows: DataFrame) -> DataFrame:
    """Add what spreads rows of one hash over blocks: 0 for the first, and the number of each other.

    Equal rows are numbered within their input partition behind those of the partitions before it, so no
    task gets all of them; which one has a number is all the same.
    """
    rows = rows.withColumn("_part", F.shiftright("_uid", 33))
    counts = rows.filter("NOT _no_id").groupBy("source", "_order", "_part").agg(F.count("*").alias("_many"))
    # A row per hash and partition at most.
    of = Window.partitionBy("source", "_order")
    before = F.sum("_many").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumns({"_before": F.coalesce(before, F.lit(0)), "_all": F.sum("_many").over(of)})
    again = counts.filter("_all > 1").select(
        F.col("source").alias("_s"), F.col("_order").alias("_o"), F.col("_part").alias("_p"), "_before"
    )
    again = stored(again, "again")
    own = F.when(F.col("_no_id"), F.col("_uid")).otherwise(F.lit(0).cast("long"))
    if again.isEmpty():
        return rows.withColumn("_salt", own).drop("_part")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_order") == F.col("_o")) & (F.col("_part") == F.col("_p"))
    found = rows.join(again, same & ~F.col("_no_id"), "left")
    number = F.row_number().over(Window.partitionBy("source", "_order", "_part", "_no_id").orderBy("_uid"))
    salt = F.when(F.col("_before").isNotNull(), F.col("_before") + number - 1).otherwise(own)
    return found.withColumn("_salt", salt).drop("_part", "_s", "_o", "_p", "_before")


def mix_sources(
    df: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source", doc_id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add size, source_size, target, copies and taken to every document.

    ``keep`` names the columns to carry along; they are stored, so leave out texts not needed.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    carried = [c for c in (keep if keep is not None else [doc_id, source]) if c not in made]
    slim = with_size(
        df.select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(carried)],
            F.col(text).alias("_text"),
            F.col(source).cast("string").alias("source"),
            F.xxhash64(F.lit(mix.seed), F.col(doc_id).cast("string"), F.col(text)).alias("_order"),
            F.col(doc_id).isNull().alias("_no_id"),
        ),
        "_text",
    ).drop("_text")
    docs = stored(slim.withColumn("_uid", F.monotonically_increasing_id()), "sizes")
    per_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    wanted = stored(
        targets(per_source, mix).join(
            per_source.select(F.col("source").alias("_s"), "_docs"), F.col("source").eqNullSafe(F.col("_s"))
        ).drop("_s"),
        "targets",
    ).withColumnRenamed("source", "_source")
    ready = docs.join(wanted, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.floor("ratio")
    chance = (F.col("ratio") - whole).alias("_chance")
    open_rows = ready.select("_uid", "_order", "_no_id", "source", "size", "_docs", chance)
    open_rows = _salted(open_rows).drop("_no_id")
    decided = None
    most = wanted.agg(F.max("_docs")).first()[0] or 0
    while True:
        last = most <= mix.block
        blocks = F.lit(1) if last else F.ceil(F.col("_docs") / mix.block)
        work = open_rows.withColumns(
            {"_blocks": blocks, "_block": F.pmod(F.xxhash64("_order", "_salt"), blocks)}
        )
        flown = stored(
            work.groupBy("source", "_block").applyInPandas(_flight(last, mix.aside, mix.seed), work.schema), "flight"
        ).drop("_blocks", "_block")
        done = flown.filter("_chance = 0 OR _chance = 1").select("_uid", "_chance")
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        left = mix.aside + 2  # open documents a block at most
        open_rows = flown.filter("_chance > 0 AND _chance < 1").withColumn(
            "_docs", left * F.ceil(F.col("_docs") / mix.block)
        )
        most = left * -(-most // mix.block)
    picked = decided.select(F.col("_uid").alias("_u"), F.col("_chance").cast("long").alias("_more"))
    out = ready.join(picked, F.col("_uid") == F.col("_u"), "left")
    copies = (F.floor("ratio") + F.coalesce("_more", F.lit(0))).cast("long")
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(carried)],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
