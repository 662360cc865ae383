"""Data-quality reports, each one pass over its table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    FractionalType,
    IntegralType,
    StructField,
    TimestampType,
)

from rxlake.functions.codes import normalize_code


def _slots(df: DataFrame) -> list[tuple[str, list[Column]]]:
    """Per slot type, what each column puts there: NULL wherever its own type goes elsewhere.

    Whole numbers, dates and times are held as long, fractions as double, the rest as text, so that
    distinct values stay as small in a shuffle as they are in their column.
    """

    def place(field: StructField) -> tuple[str, Column]:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (IntegralType, BooleanType)):
            return "long", c.cast("long")
        if isinstance(field.dataType, DateType):
            return "long", F.unix_date(c).cast("long")
        if isinstance(field.dataType, TimestampType):
            return "long", F.unix_micros(c)
        if isinstance(field.dataType, FractionalType) and not isinstance(field.dataType, DecimalType):
            return "double", c.cast("double")
        return "string", c.cast("string")

    placed = [place(f) for f in df.schema.fields]
    used = [kind for kind in ("long", "double", "string") if any(k == kind for k, _ in placed)]
    return [(kind, [c if k == kind else F.lit(None).cast(kind) for k, c in placed]) for kind in used]


def _cells(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """A row per cell, (column_no, one value per slot), and the names of the slots."""
    slots = _slots(df)
    names = [f"as_{kind}" for kind, _ in slots]
    cells = [
        part for no in range(len(df.columns)) for part in (F.lit(no), *[c[no] for _, c in slots])
    ]
    rows = df.select(F.stack(F.lit(len(df.columns)), *cells).alias("column_no", *names))
    return rows, names


def _pct(part: Column, whole: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)) * 100, 4)


def null_rates(df: DataFrame, limit_pct: float = 20.0) -> DataFrame:
    """Share of NULL per column, flagged above ``limit_pct``."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    rows = counts.unpivot(["_rows"], df.columns, "column_name", "filled")
    pct = _pct(F.col("_rows") - F.col("filled"), F.col("_rows"))
    return rows.select(
        "column_name",
        pct.alias("null_pct"),
        (pct > limit_pct).cast("int").alias("flag"),
    )


def quality_report(df: DataFrame, limit_pct: float = 50.0) -> DataFrame:
    """Rows, share of NULL and distinct values per column; NULL counts as one value.

    One pass for any number of columns. Repeated values of a column, NULL included, are merged
    with their number before the shuffle, so rows and NULLs come from the same groups.
    """
    cells, slots = _cells(df)
    values = cells.groupBy("column_no", *slots).agg(F.count("*").alias("n"))
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in slots])
    nulls = F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0))
    name = F.get(F.array(*[F.lit(c) for c in df.columns]), F.col("column_no"))
    return (
        values.groupBy("column_no")
        .agg(
            F.sum("n").alias("total_rows"),
            _pct(nulls, F.sum("n")).alias("null_pct"),
            F.count("*").alias("distinct_values"),
        )
        .select(name.alias("column_name"), "total_rows", "null_pct", "distinct_values")
        .withColumn("flag", (F.col("null_pct") > limit_pct).cast("int"))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicate_keys"))
    )


def flag_prevalence(df: DataFrame, prefix: str = "cc_") -> DataFrame:
    """Share of rows with each 0/1 flag set, for all columns with the prefix."""
    flags = [c for c in df.columns if c.startswith(prefix)]
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c) == 1).alias(c) for c in flags]
    )
    rows = counts.unpivot(["_rows"], flags, "flag", "positive")
    return rows.select("flag", _pct(F.col("positive"), F.col("_rows")).alias("pct"))


def normalize_rate(df: DataFrame, raw_col: str) -> DataFrame:
    """How many raw codes can be read."""
    code = normalize_code(F.col(raw_col))
    return df.agg(F.count("*").alias("total"), F.count(code).alias("normalized")).select(
        "total",
        "normalized",
        (F.col("total") - F.col("normalized")).alias("failed"),
        _pct(F.col("normalized"), F.col("total")).alias("pct"),
    )


def key_coverage(df: DataFrame, raw_col: str, dim: DataFrame, key: str = "ndc") -> DataFrame:
    """How many distinct raw codes are found, once normalized, in a dimension."""
    codes = (
        df.select(F.col(raw_col).cast("string").alias("_raw"))
        .distinct()
        .withColumn(key, normalize_code(F.col("_raw")))
    )
    known = dim.select(key).distinct().withColumn("_known", F.lit(1))
    return (
        codes.join(known, key, "left")
        .agg(F.count("*").alias("total"), F.count("_known").alias("matched"))
        .select(
            "total",
            "matched",
            _pct(F.col("matched"), F.col("total")).alias("pct"),
            (F.col("total") - F.col("matched")).alias("unmatched"),
        )
    )


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
