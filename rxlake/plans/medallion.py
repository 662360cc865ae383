"""The whole run: files to raw tables, raw to typed, typed to analytical.

Every table is computed once and written, and later steps read the written table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rxlake.functions.columns import snake_case_columns
from rxlake.operators import gold, quality, silver
from rxlake.sources import (
    copy_table,
    read_layer,
    scan_delimited,
    scan_with_provenance,
    with_constant,
    write_layer,
)
from rxlake.sources import schemas
from rxlake.sources.tables import BRONZE, GOLD, SILVER, layer_tables


@dataclass(frozen=True)
class RawFile:
    """Where a raw table comes from: a path or glob under the data folder."""

    pattern: str
    schema: StructType | None = None
    sep: str = ","
    by_year: bool = False


RAW_FILES = {
    "fda_ndc_product": RawFile("product.txt", schemas.PRODUCT, "\t"),
    "fda_ndc_package": RawFile("package.txt", schemas.PACKAGE, "\t"),
    "nadac_pricing": RawFile("nadac*.csv", schemas.PRICES),
    "synpuf_beneficiary": RawFile(
        "DE1_0_*_Beneficiary_Summary_File_Sample_*.csv", schemas.PATIENTS, by_year=True
    ),
    "synpuf_pde": RawFile("DE1_0_*_Prescription_Drug_Events_Sample_*.csv", schemas.FILLS),
    "synpuf_inpatient": RawFile("DE1_0_*_Inpatient_Claims_Sample_*.csv", schemas.INPATIENT),
    "synpuf_outpatient": RawFile("DE1_0_*_Outpatient_Claims_Sample_*.csv", schemas.OUTPATIENT),
    "synpuf_carrier": RawFile("DE1_0_*_Carrier_Claims_Sample_*.csv", schemas.CARRIER),
    # columns vary by year: taken as they are
    "partd_spending": RawFile("DSD_PTD_*.csv"),
}


def ingest_files(
    spark: SparkSession, folder: str, files: dict[str, RawFile] | None = None
) -> None:
    """Write every raw table from its files."""
    for table, source in (files or RAW_FILES).items():
        scan = scan_with_provenance if source.by_year else scan_delimited
        df = scan(spark, f"{folder}/{source.pattern}", source.schema, sep=source.sep)
        if source.schema is None:
            df = _storable(df)
        write_layer(df, BRONZE, table)


def _storable(df: DataFrame) -> DataFrame:
    """Drop header characters a table cannot hold."""
    return df.toDF(*[c.strip() for c in df.columns])


def ingest_tables(spark: SparkSession, tables: dict[str, str], patient_year: str = "2010") -> None:
    """Take raw tables over from a catalog, ``{raw name: catalog name}``.

    A patient table without a year gets ``patient_year`` for all rows.
    """
    for name, source in tables.items():
        if name == "synpuf_beneficiary" and "_source_year" not in spark.table(source).columns:
            df = with_constant(spark.table(source), "_source_year", patient_year)
            write_layer(df, BRONZE, name)
        else:
            copy_table(spark, source, name)


SILVER_TABLES = {
    "dim_drug": (silver.build_drug_dim, ["fda_ndc_product", "fda_ndc_package"]),
    "fact_drug_pricing": (silver.build_pricing, ["nadac_pricing"]),
    "fact_prescription_events": (silver.build_fills, ["synpuf_pde"]),
    "dim_beneficiary": (silver.latest_patient, ["synpuf_beneficiary"]),
    "fact_inpatient_claims": (silver.build_inpatient, ["synpuf_inpatient"]),
    "fact_outpatient_claims": (silver.build_outpatient, ["synpuf_outpatient"]),
    "fact_carrier_claims": (silver.build_carrier, ["synpuf_carrier"]),
    "agg_partd_spending": (snake_case_columns, ["partd_spending"]),
}


def build_silver(spark: SparkSession) -> None:
    """Write the typed tables from the raw ones."""
    for table, (build, inputs) in SILVER_TABLES.items():
        write_layer(build(*[read_layer(spark, BRONZE, i) for i in inputs]), SILVER, table)


def build_gold(spark: SparkSession, high_cost_quantile: float = 0.9) -> None:
    """Write the analytical tables from the typed ones."""

    def typed(name: str) -> DataFrame:
        return read_layer(spark, SILVER, name)

    fills, dim_drug, pricing = (
        typed("fact_prescription_events"), typed("dim_drug"), typed("fact_drug_pricing")
    )
    write_layer(gold.drug_cost_journey(fills, dim_drug, pricing), GOLD, "drug_cost_journey")
    write_layer(
        gold.patient_utilization(fills, typed("dim_beneficiary")),
        GOLD,
        "beneficiary_drug_utilization",
    )
    write_layer(
        gold.cost_spread_monthly(pricing, fills, dim_drug),
        GOLD,
        "drug_cost_spread_analysis",
        partition_by=["year"],
    )
    cohort = gold.high_cost_cohort(
        read_layer(spark, GOLD, "beneficiary_drug_utilization"),
        typed("fact_inpatient_claims"),
        typed("fact_outpatient_claims"),
        high_cost_quantile,
    )
    write_layer(cohort, GOLD, "high_cost_drug_cohort")


def inventory(spark: SparkSession, layer: str) -> DataFrame:
    """Rows per table of a layer, from the written files."""
    return quality.table_inventory({n: read_layer(spark, layer, n) for n in layer_tables(spark, layer)})
