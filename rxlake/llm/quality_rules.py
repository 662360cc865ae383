"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Word, symbol, line and repetition counts of a text are turned into a vector of transformed shares.
For each language and source a minimum-covariance-determinant estimate gives the centre and spread
of the most concentrated three quarters, and documents far from it by Mahalanobis distance are
rejected. Only built-in column functions: rows are counted and moved by Spark alone.

The estimate starts from medians and median deviations and repeats concentration steps. A step is
one aggregation: rows fall into distance bins, each bin keeps its row count and exact whole-number
moments, and the bins of lowest distance that hold the wanted share give the next estimate. So no
step needs a sort, and a group of any size costs as many rows after pre-aggregation as it has bins.

Defined results: a NULL text counts as empty, so it has no words and fails the limits. NULL languages
and sources form groups of their own. A group of fewer than ``min_rows`` rows that pass the limits is
judged by the estimate of its language, or of all rows if that is small too; with fewer than
``min_rows`` rows in all, the limits alone decide. Repeated rows are judged alike; an empty table
gives no rows. Extra columns stay unless a result has their name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.sources.scratch import stored

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
UNIT = 1000  # vectors are whole thousandths, so sums do not depend on the order of rows
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    share: float = 0.75  # of a group that the estimate is concentrated on
    steps: int = 4
    min_rows: int = 60
    cutoff: float = 35.0  # squared distance
    # Smallest spread of each part of the vector, so that groups of copies and shares that are
    # nearly always zero do not make every other document an outlier.
    floor: tuple[float, ...] = (0.6, 0.12, 0.04, 0.15, 0.12)
    # Makes the concentrated covariance that of the whole group under a normal law, for a share of
    # 0.75 and five parts.
    consistency: float = 1.5


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the five counts of each text."""
    body = F.coalesce(F.col(text), F.lit(""))
    work = df.withColumn("_body", body).withColumns(
        {
            "_words": F.filter(F.split("_body", f"[{SPACE}]+", -1), lambda w: w != ""),
            "_lines": F.filter(F.split("_body", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")),
            "n_symbols": (
                F.length("_body") - F.length(F.regexp_replace("_body", SYMBOLS, ""))
            ).cast("long"),
        }
    )
    last = F.size("_words") - 3
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    work = work.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(last >= 1, windows),
        }
    ).drop("_words", "_lines", "_body")
    # Windows that occur again are neighbours once hashes are sorted together with positions.
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    keyed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    work = work.withColumn("_keyed", F.when(again, F.sort_array(keyed)))
    same = F.transform(
        "_keyed",
        lambda x, j: F.when(
            x["h"].eqNullSafe(F.get("_keyed", j + 1)["h"])
            | x["h"].eqNullSafe(F.get("_keyed", j - 1)["h"]),
            x["i"],
        ),
    )
    work = work.withColumn("_at", F.sort_array(F.filter(same, lambda i: i.isNotNull())))
    # A window covers three words, or fewer where the next repeated window begins within it.
    covered = F.transform("_at", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - i, F.lit(3))))
    total = F.aggregate(covered, F.lit(0), lambda a, b: a + b)
    return work.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop(
        "_windows", "_keyed", "_at"
    )


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def _vector(df: DataFrame) -> DataFrame:
    """The transformed statistics as whole thousandths, ``_x0`` onwards."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    parts = [
        F.log1p("n_words"),
        F.log(1 + F.col("word_chars") / n),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p("n_dup_lines") / F.log1p(n),
        F.sqrt(F.col("n_repeat_words") / n),
    ]
    return df.withColumns({f"_x{i}": F.round(p * UNIT).cast("long") for i, p in enumerate(parts)})


def _grouped(df: DataFrame, fit: Column, rules: Rules, lang: str, source: str) -> DataFrame:
    """Add ``_group``, by which a row is judged, and ``_fits``, whose estimates it is part of.

    The group is language and source; where that has few rows, the language; where that has few
    rows too, all rows.
    """

    def named(*parts: Column) -> Column:  # NULL and the text 'null' stay apart
        return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p), F.lit("-")) for p in parts])

    narrow, wide = named(F.col(lang).cast("string"), F.col(source).cast("string")), named(F.col(lang).cast("string"))
    df = df.withColumns({"_narrow": narrow, "_wide": wide})
    # One row per language and source from here on.
    names = df.filter(fit).groupBy("_narrow", "_wide").agg(F.count("*").alias("_n"))
    names = names.withColumn("_m", F.sum("_n").over(Window.partitionBy("_wide")))
    own, wider = F.col("_n") >= rules.min_rows, F.col("_m") >= rules.min_rows
    names = names.withColumns(
        {
            "_group": F.when(own, F.col("_narrow")).when(wider, F.col("_wide")).otherwise(""),
            "_wide_used": F.min(own.cast("int")).over(Window.partitionBy("_wide")) == 0,
            "_all_used": F.min(wider.cast("int")).over(Window.partitionBy(F.lit(0))) == 0,
        }
    )
    fits = F.array(
        F.when(own, F.col("_narrow")),
        F.when(wider & F.col("_wide_used"), F.col("_wide")),
        F.when(F.col("_all_used"), F.lit("")),
    )
    names = names.select("_narrow", "_group", F.array_compact(fits).alias("_fits"))
    return df.join(names, "_narrow", "left").drop("_narrow", "_wide")


def _squared_distance(p: int) -> Column:
    """Mahalanobis distance by forward substitution with the group's Cholesky factor."""
    z: list[Column] = []
    for i in range(p):
        rest = F.col(f"_x{i}") / UNIT - F.col(f"_m{i}")
        for j in range(i):
            rest = rest - F.col(f"_l{i}{j}") * z[j]
        z.append(rest / F.col(f"_l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _beside(rows: DataFrame, per_group: DataFrame, salts: int = 16) -> DataFrame:
    """Rows with what belongs to their group, a large group spread over ``salts`` tasks."""
    left = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    right = per_group.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, ["_group", "_salt"]).drop("_salt")


def _start(rows: DataFrame, p: int, rules: Rules) -> DataFrame:
    """Medians and median deviations as a first, diagonal estimate."""

    def median(c: Column) -> Column:  # exact: values are whole thousandths, so few are distinct
        return F.percentile(c, F.lit(0.5))

    centre = rows.groupBy("_group").agg(*[median(F.col(f"_x{i}")).alias(f"_m{i}") for i in range(p)])
    away = _beside(rows, centre)
    spread = away.groupBy("_group").agg(
        *[F.min(f"_m{i}").alias(f"_m{i}") for i in range(p)],
        *[median(F.abs(F.round(F.col(f"_x{i}") - F.col(f"_m{i}")))).alias(f"_s{i}") for i in range(p)],
    )
    made = {f"_m{i}": F.col(f"_m{i}") / UNIT for i in range(p)}
    made |= {f"_l{i}{i}": F.sqrt((1.4826 * F.col(f"_s{i}") / UNIT) ** 2 + rules.floor[i] ** 2) for i in range(p)}
    made |= {f"_l{i}{j}": F.lit(0.0) for i in range(p) for j in range(i)}
    return spread.select("_group", *[c.alias(n) for n, c in made.items()])


def _concentrated(rows: DataFrame, estimate: DataFrame, p: int, rules: Rules) -> DataFrame:
    """The estimate over the share of each group that is nearest by the last estimate."""
    near = _beside(rows, estimate).withColumn(
        "_bin", F.floor(F.log1p(_squared_distance(p)) * 40).cast("int")
    )
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    bins = near.groupBy("_group", "_bin").agg(
        F.count("*").alias("_n"),
        *[F.sum(f"_x{i}").alias(f"_t{i}") for i in range(p)],
        *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_t{i}{j}") for i, j in pairs],
    )
    before = Window.partitionBy("_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    inner = bins.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_all": F.sum("_n").over(Window.partitionBy("_group")),
        }
    ).filter(F.col("_before") < rules.share * F.col("_all"))
    sums = inner.groupBy("_group").agg(
        F.sum("_n").alias("_n"),
        *[F.sum(c).alias(c) for c in bins.columns if c.startswith("_t")],
    )
    mean = {f"_m{i}": F.col(f"_t{i}") / F.col("_n") / UNIT for i in range(p)}
    work = sums.withColumns(mean)
    cov = {
        f"_c{i}{j}": rules.consistency
        * (F.col(f"_t{i}{j}") / F.col("_n") / UNIT**2 - F.col(f"_m{i}") * F.col(f"_m{j}"))
        + (rules.floor[i] ** 2 if i == j else 0.0)
        for i, j in pairs
    }
    work = work.withColumns(cov)
    for i in range(p):  # Cholesky factor, row by row; the floor keeps it away from zero
        for j in range(i + 1):
            rest = F.col(f"_c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"_l{j}{j}")
            work = work.withColumn(f"_l{i}{j}", value)
    return work.select(*_columns(p))


def _columns(p: int) -> list[str]:
    return ["_group", *[f"_m{i}" for i in range(p)], *[f"_l{i}{j}" for i in range(p) for j in range(i + 1)]]


def judge(
    df: DataFrame,
    rules: Rules = Rules(),
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` (squared) and ``kept`` of every row.

    ``keep`` names the columns to carry along. They are stored with the counts, so leave out texts
    that are not needed.
    """
    p = len(rules.floor)
    carried = [c for c in (keep if keep is not None else ["doc_id"]) if c not in COUNTS]
    source_columns = [F.col(c).alias(f"_k{i}") for i, c in enumerate(carried)]
    slim = df.select(
        *source_columns,
        F.col(text).alias("_text"),
        F.col(lang).cast("string").alias("_lang"),
        F.col(source).cast("string").alias("_source"),
    )
    counted = _vector(with_counts(slim, "_text").drop("_text"))
    counted = stored(counted.withColumn("base_failed", base_failed(rules)), "counts")
    grouped = _grouped(counted, ~F.col("base_failed"), rules, "_lang", "_source")
    rows = grouped.filter(~F.col("base_failed")).select(
        F.explode("_fits").alias("_group"), *[f"_x{i}" for i in range(p)]
    )
    estimate = stored(_start(rows, p, rules), "start")
    for _ in range(rules.steps):
        estimate = stored(_concentrated(rows, estimate, p, rules), "step")
    enough = rows.groupBy("_group").agg((F.count("*") >= rules.min_rows).alias("_enough"))
    judged = grouped.join(estimate.join(enough, "_group"), "_group", "left").withColumn(
        "distance", F.when(F.col("_enough"), _squared_distance(p))
    )
    return judged.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(carried)],
        *COUNTS,
        "base_failed",
        "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= rules.cutoff)).alias("kept"),
    )
