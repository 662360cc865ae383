"""Delimited-file scans."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SOURCE_PATH = "_rxlake_path"


def header_schema(spark: SparkSession, paths: str | list[str], sep: str = ",") -> StructType:
    """All-text schema from the header line alone.

    For files whose columns change between vintages. Spark reads the first line of one
    file for this, never the data.
    """
    names = spark.read.option("header", True).option("sep", sep).csv(paths).columns
    return StructType([StructField(n, StringType()) for n in names])


def _first_lines(spark: SparkSession, paths: str | list[str], early: bool) -> tuple[dict[str, str], list[str]]:
    """First lines by path, from one distributed job, and the paths of files without one.

    ``early`` lets a task stop after the first batch of lines. Tasks have one file or part of a file then,
    unless the session bounds their number; a file behind another one's lines may be missed in that case.
    """
    own = spark.newSession()  # one file or part of a file per task, for this job alone
    own.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = own.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            found = {}
            for line, path, start in zip(*columns):
                if start == 0 and path not in seen:
                    seen.add(path)
                    found[path] = line
            names = [pa.array(list(x), pa.string()) for x in (found.values(), found)]
            yield pa.RecordBatch.from_arrays(names, ["line", "path"])
            if early:
                return

    rows = lines.mapInArrow(first, "line string, path string").collect()
    found = {unquote(r.path): r.line for r in rows}
    return found, [p for p in map(unquote, lines.inputFiles()) if p not in found]


def files_by_header(
    spark: SparkSession, paths: str | list[str], sep: str = ","
) -> list[tuple[StructType, list[str]]]:
    """The files of a set, together where their header lines agree, in order of their first file.

    One job finds the header lines of any number of files (a second one looks at files without any), and
    Spark parses each distinct line once. Files without a line are left out.
    """
    found, left = _first_lines(spark, paths, early=True)
    if left:  # empty, or behind another file in its task
        found |= _first_lines(spark, left, early=False)[0]
    groups: dict[str, list[str]] = {}
    for path, line in found.items():
        groups.setdefault(line, []).append(path)
    return [
        (header_schema(spark, files[0], sep), sorted(files))
        for files in sorted(groups.values(), key=min)
    ]


def scan_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType | None = None,
    sep: str = ",",
    header: bool = True,
    keep_path: bool = False,
) -> DataFrame:
    """Read one file, many files or a glob of delimited text.

    Columns are matched to ``schema`` by header name, so extra or reordered columns in a file are
    harmless, and only the columns in use are parsed. Files of one set may have different headers:
    they are put together by column name, and a column that some files lack is NULL there. A column
    that no file has is an error. Without a schema all columns are read, as text.
    """
    if not header and schema is None:
        raise ValueError("a file without a header needs a schema")
    # enforceSchema off: a file with another header than expected is an error, not a shift.
    reader = spark.read.option("header", header).option("sep", sep).option("enforceSchema", False)
    if not header:
        return reader.schema(schema).csv(paths)
    groups = files_by_header(spark, paths, sep)
    if not groups:
        raise ValueError(f"no files at {paths}")
    if schema is not None:
        present = {n.lower() for found, _ in groups for n in found.names}
        missing = [n for n in schema.names if n.lower() not in present]
        if missing:
            raise ValueError(f"columns not in {paths}: {', '.join(missing)}")

    def one(found: StructType, files: list[str]) -> DataFrame:
        df = reader.schema(found).csv(files if len(groups) > 1 else paths)
        path = F.col("_metadata.file_path").alias(SOURCE_PATH)
        if schema is None:
            return df.select("*", path)
        own = {n.lower() for n in found.names}
        columns = [
            (F.col(f"`{f.name}`") if f.name.lower() in own else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
        return df.select(*columns, path)

    parts = [one(found, files) for found, files in groups]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole if keep_path else whole.drop(SOURCE_PATH)


def scan_with_provenance(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType | None = None,
    year_regex: str = r"(\d{4})_Beneficiary",
    sep: str = ",",
) -> DataFrame:
    """Read a set of yearly files, keeping each row's file and the year in its name."""
    df = scan_delimited(spark, paths, schema, sep, keep_path=True)
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != SOURCE_PATH],
        F.col(SOURCE_PATH).alias("_source_file"),
        F.regexp_extract(SOURCE_PATH, year_regex, 1).alias("_source_year"),
    )


def with_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    """Add a constant provenance column."""
    return df.withColumn(name, F.lit(value))
