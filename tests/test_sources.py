import pytest
from pyspark.sql import functions as F

from rxlake.functions.codes import normalize_code
from rxlake.functions.columns import snake_case_columns
from rxlake.sources import (
    copy_table,
    create_layers,
    read_layer,
    scan_delimited,
    scan_with_provenance,
    with_constant,
    write_layer,
)
from rxlake.sources import schemas
from rxlake.sources.files import files_by_header
from rxlake.sources.tables import layer_tables


def write(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_tab_separated(spark, tmp_path):
    path = write(
        tmp_path,
        "package.txt",
        "PRODUCTNDC\tNDCPACKAGECODE\tPACKAGEDESCRIPTION\tEXTRA",
        "0002-1433\t0002-1433-01\tone, two\tx",
    )
    rows = scan_delimited(spark, path, schemas.PACKAGE, sep="\t").collect()
    assert [tuple(r) for r in rows] == [("0002-1433", "0002-1433-01", "one, two")]


def test_codes_keep_leading_zeros(spark, tmp_path):
    path = write(tmp_path, "nadac_2024.csv", "NDC,NADAC_Per_Unit", "02143301234,0.5")
    row = scan_delimited(spark, path).select(normalize_code(F.col("NDC"))).first()
    assert row[0] == "02143301234"


def test_glob_is_a_union(spark, tmp_path):
    write(tmp_path, "nadac_1.csv", "NDC,Price", "1,2")
    write(tmp_path, "nadac_2.csv", "NDC,Price", "3,4")
    assert scan_delimited(spark, str(tmp_path / "nadac*.csv")).count() == 2


def test_reordered_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path, "p.csv", "B,A", "1,2")
    row = scan_delimited(spark, path, schemas.text_schema("A B")).first()
    assert (row["A"], row["B"]) == ("2", "1")


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path, "p.csv", "A", "1")
    with pytest.raises(ValueError, match="B"):
        scan_delimited(spark, path, schemas.text_schema("A B"))


def test_headless_needs_schema(spark, tmp_path):
    path = write(tmp_path, "p.csv", "1,2")
    with pytest.raises(ValueError):
        scan_delimited(spark, path, header=False)
    row = scan_delimited(spark, path, schemas.text_schema("A B"), header=False).first()
    assert tuple(row) == ("1", "2")


def test_provenance(spark, tmp_path):
    for year in (2008, 2009, 2010):
        write(
            tmp_path,
            f"DE1_0_{year}_Beneficiary_Summary_File_Sample_1.csv",
            "DESYNPUF_ID,SP_STATE_CODE",
            f"P{year},05",
        )
    df = scan_with_provenance(spark, str(tmp_path / "DE1_0_*_Beneficiary*.csv"))
    rows = {r["DESYNPUF_ID"]: r for r in df.collect()}
    assert {k: r["_source_year"] for k, r in rows.items()} == {
        "P2008": "2008", "P2009": "2009", "P2010": "2010",
    }
    assert all(f"_{y}_" in rows[f"P{y}"]["_source_file"] for y in (2008, 2009, 2010))


def test_constant(spark):
    df = with_constant(spark.range(2), "_source_year", "2010")
    assert {r["_source_year"] for r in df.collect()} == {"2010"}


def test_snake_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Brand Name", "Tot-Spend Amt", "ok"])
    assert snake_case_columns(df).columns == ["brand_name", "tot_spend_amt", "ok"]


def test_layers(spark):
    create_layers(spark)
    names = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert {"bronze", "silver", "gold"} <= names
    write_layer(spark.range(3), "bronze", "t")
    write_layer(spark.range(2).withColumn("y", F.lit("a")), "bronze", "t")
    again = read_layer(spark, "bronze", "t")
    assert again.columns == ["id", "y"] and again.count() == 2
    copy_table(spark, "bronze.t", "u", "silver")
    assert read_layer(spark, "silver", "u").count() == 2


def test_partitioned_layer_prunes(spark):
    df = spark.range(10).withColumn("year", F.col("id") % 2 + 2000)
    write_layer(df, "gold", "by_year", ["year"])
    got = read_layer(spark, "gold", "by_year").filter("year = 2001")
    assert got.count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_vintages_of_many_files_take_as_many_jobs_as_few(spark, tmp_path):
    headers = ["NDC,Price,Note", "Price,NDC", "NDC,Price,Year"]

    def jobs(folder, files):
        folder.mkdir()
        for i in range(files):
            head = headers[i % 3]
            values = {"NDC": f"c{i}", "Price": str(i), "Note": "n", "Year": "2024"}
            lines = [",".join(f"{values[c]}" for c in head.split(","))] * (1 + i % 2 * 30_000)
            write(folder, f"vintage {i:02}+é.csv", head, *lines)
        (folder / "empty.csv").write_text("")
        spark.sparkContext.setJobGroup(str(folder), "headers")
        found = files_by_header(spark, f"{folder}/*.csv")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [len(paths) for _, paths in found] == [len(range(k, files, 3)) for k in range(3)]
        assert [schema.names for schema, _ in found] == [h.split(",") for h in headers]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(folder)))

    # Spark lists more than 32 files in a job of its own, so both sets have more.
    few, many = jobs(tmp_path / "few", 36), jobs(tmp_path / "many", 75)
    assert many == few <= 8
    rows = scan_delimited(spark, str(tmp_path / "many" / "*.csv"))
    assert sorted(rows.columns) == ["NDC", "Note", "Price", "Year"]
    got = rows.distinct().collect()
    assert sorted((r.NDC, r.Price) for r in got) == sorted((f"c{i}", str(i)) for i in range(75))
    assert {(r.Note, r.Year) for r in got} == {("n", None), (None, None), (None, "2024")}


def test_headers_behind_other_files_in_a_task(spark, tmp_path):
    for i in range(8):
        write(tmp_path, f"v{i}.csv", f"A,B{i % 2}", *["1,2"] * 5)
    spark.conf.set("spark.sql.files.maxPartitionNum", "1")
    try:
        found = files_by_header(spark, f"{tmp_path}/*.csv")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionNum")
    assert [len(files) for _, files in found] == [4, 4]


def test_a_failing_write_leaves_the_old_rows(spark):
    write_layer(spark.range(3), "atomic", "t")
    before = read_layer(spark, "atomic", "t")
    bad = spark.range(2_000).select(F.when(F.col("id") < 1_999, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_layer(bad, "atomic", "t")
    assert read_layer(spark, "atomic", "t").count() == before.count() == 3
    # From itself, with a new column.
    write_layer(read_layer(spark, "atomic", "t").withColumn("y", F.col("id") + 1), "atomic", "t")
    write_layer(read_layer(spark, "atomic", "t").filter("y > 1"), "atomic", "t")
    assert sorted(map(tuple, read_layer(spark, "atomic", "t").collect())) == [(1, 2), (2, 3)]


def test_versions_are_removed_and_hidden(spark):
    for i in range(5):
        write_layer(spark.range(i), "versions", "t")
        write_layer(spark.range(10 + i), "versions", "t_other")
    write_layer(spark.range(7).withColumn("k", F.col("id") % 2), "versions", "T2", ["k"])
    assert sorted(layer_tables(spark, "versions")) == ["t", "t2", "t_other"]
    assert spark.sql("SHOW TABLES IN versions").count() == 3 + 2 + 2 + 1
    assert [read_layer(spark, "versions", n).count() for n in ("t", "t_other", "t2")] == [4, 14, 7]
    assert read_layer(spark, "versions", "t2").filter("k = 1").count() == 3


def test_a_plain_table_of_the_name_is_taken_over(spark):
    create_layers(spark, "plain")
    spark.range(4).write.saveAsTable("plain.t")
    write_layer(read_layer(spark, "plain", "t").filter("id > 0"), "plain", "t")
    assert read_layer(spark, "plain", "t").count() == 3
    write_layer(spark.range(2), "plain", "t")
    write_layer(spark.range(1), "plain", "t")
    assert spark.sql("SHOW TABLES IN plain").count() == 3
