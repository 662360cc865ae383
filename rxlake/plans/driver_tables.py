"""Raw claims tables derived from the star-schema test tables.

Line items play both prescription fills and price observations, parts the drug directory,
orders with their customer the yearly patient records, and orders by status the three kinds
of medical claims. All values are text, as in the raw files, with some unreadable ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.operators import gold, prices, refills, silver
from rxlake.sources.schemas import CONDITION_FLAGS
from rxlake.sources.scratch import stored

# One format of a nine-digit part key per remainder: 4-4-2, 5-3-2, 5-4-1, 5-4-2 with blanks
# around, 11, 10 and 9 digits, and one that cannot be read. Each is what comes before, the first
# digit taken, the digit after a hyphen (0: no hyphen), and what comes after.
FORMATS = [
    ("", 2, 6, "-01"), ("", 2, 7, "-01"), ("", 1, 6, "-1"), ("  ", 1, 6, "-01 "),
    ("", 1, 0, "01"), ("", 1, 0, "1"), ("", 1, 0, ""), ("UNK", 1, 0, ""),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digits(key: str) -> str:
    # Formats are for nine digits; a longer key would fall onto another part's code.
    return (
        f"if({key} BETWEEN 0 AND 999999999, lpad(CAST({key} AS STRING), 9, '0'), "
        f"CAST(raise_error('part key of more than nine digits') AS STRING))"
    )


def raw_code(key: str) -> str:
    """SQL for a drug code in the format its part key calls for.

    No patterns, and the digits are named once: filters on the code work it out once more, and
    their code must stay below the 8 kB beyond which the JVM compiles no method.
    """
    form = f"CAST({key} % 8 AS INT)"
    before, first, hyphen, after = zip(*FORMATS)

    def of_format(values: tuple) -> str:
        return f"get(array({', '.join(map(repr, values))}), {form})"

    signs = of_format(tuple("-" if h else "" for h in hyphen))
    places = of_format(tuple(h or 1 for h in hyphen))
    digits = f"substr(overlay({_digits(key)} PLACING {signs} FROM {places} FOR 0), {of_format(first)})"
    return f"concat({of_format(before)}, {digits}, {of_format(after)})"


def product_code(key: str) -> str:
    digits = _digits(key)
    return f"concat(substr({digits}, 1, 5), '-', substr({digits}, 6, 4))"


def raw_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of size 1 are filed under another code, so their packages find none."""
    return table(spark, sf_dir, "part").selectExpr(
        f"concat(if(p_size = 1, 'X', ''), {product_code('p_partkey')}) AS PRODUCTNDC",
        "p_name AS PROPRIETARYNAME",
        "if(p_size < 50, p_type, NULL) AS NONPROPRIETARYNAME",
        "p_brand AS LABELERNAME",
        "CASE p_size % 3 WHEN 0 THEN 'TABLET' WHEN 1 THEN 'CAPSULE' END AS DOSAGEFORMNAME",
        "if(p_size % 2 = 0, 'ORAL', 'TOPICAL') AS ROUTENAME",
        "upper(p_type) AS SUBSTANCENAME",
        "CAST(p_size AS STRING) AS ACTIVE_NUMERATOR_STRENGTH",
        "'mg' AS ACTIVE_INGRED_UNIT",
        "CAST(NULL AS STRING) AS PHARM_CLASSES",
        "if(p_size > 45, 'CII', NULL) AS DEASCHEDULE",
        "'HUMAN PRESCRIPTION DRUG' AS PRODUCTTYPENAME",
    )


def raw_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listings per part, in two formats; parts above size 40 list another package."""
    plain = f"concat({product_code('p_partkey')}, if(p_size > 40, '-99', '-01'))"
    mixed = f"if(p_size > 40, concat(' ', {plain}), {raw_code('p_partkey')})"
    return table(spark, sf_dir, "part").selectExpr(
        f"{product_code('p_partkey')} AS PRODUCTNDC",
        f"explode(array({plain}, {mixed})) AS NDCPACKAGECODE",
        "concat('pack of ', p_size) AS PACKAGEDESCRIPTION",
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit price to five digits, valid from two weeks before shipping."""
    unit = "(CAST(round(l_extendedprice * 100) AS BIGINT) * 1000 div CAST(l_quantity AS BIGINT))"
    day = "date_format(date_sub(l_shipdate, 14), 'MM/dd/yyyy')"
    kind = "(l_partkey + l_linenumber div 7) % 5"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{raw_code('l_partkey')} AS NDC",
        "concat(' part ', l_partkey, ' ') AS NDC_Description",
        f"if(l_orderkey % 71 = 0, '', CAST({unit} / 100000D AS STRING)) AS NADAC_Per_Unit",
        f"if(l_orderkey % 101 = 0, '13/45/2000', {day}) AS Effective_Date",
        "if(l_linenumber % 2 = 0, ' EA ', 'ML') AS Pricing_Unit",
        "if(l_linenumber < 7, concat(l_returnflag, ' '), NULL) AS Pharmacy_Type_Indicator",
        "if(l_tax > 0.04D, 'Y', 'N') AS OTC",
        "CAST(l_linenumber AS STRING) AS Explanation_Code",
        f"element_at(array('B', ' G', ' G', 'B-BIO', NULL), CAST({kind} AS INT) + 1)"
        " AS Classification_for_Rate_Setting",
        f"if({kind} = 0, CAST(l_discount AS STRING), NULL)"
        " AS Corresponding_Generic_Drug_NADAC_Per_Unit",
        f"if({kind} = 0, {day}, NULL) AS Corresponding_Generic_Drug_Effective_Date",
    )


def raw_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = "CAST(l_extendedprice AS DECIMAL(18,2))"
    pay = f"round({cost} * CAST(l_discount AS DECIMAL(4,2)), 2)"
    day = "date_format(l_shipdate, 'yyyyMMdd')"
    buyer = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    line = table(spark, sf_dir, "lineitem")
    return line.join(buyer, line.l_orderkey == buyer.o_orderkey, "inner").selectExpr(
        "CAST(o_custkey AS STRING) AS DESYNPUF_ID",
        f"concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, {day}) AS PDE_ID",
        f"if(l_orderkey % 101 = 0, '00000000', {day}) AS SRVC_DT",
        f"{raw_code('l_partkey')} AS PROD_SRVC_ID",
        "CAST(l_quantity AS STRING) AS QTY_DSPNSD_NUM",
        "if(l_orderkey % 53 = 0, '', CAST(30 * (1 + l_linenumber % 3) AS STRING))"
        " AS DAYS_SUPLY_NUM",
        f"CAST({pay} AS STRING) AS PTNT_PAY_AMT",
        f"if(l_orderkey % 67 = 0, 'n/a', CAST({cost} AS STRING)) AS TOT_RX_CST_AMT",
    )


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order: a patient has several records a year."""
    flags = [
        f"CASE WHEN (o_orderkey + {i}) % 13 = 0 THEN NULL "
        f"WHEN shiftright(o_custkey * 37 + o_orderkey * 5, {i}) % 2 = 0 THEN '1' ELSE '2' END"
        f" AS {name}"
        for i, name in enumerate(CONDITION_FLAGS)
    ]
    buyer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    order = table(spark, sf_dir, "orders")
    return order.join(buyer, order.o_custkey == buyer.c_custkey, "inner").selectExpr(
        "CAST(o_custkey AS STRING) AS DESYNPUF_ID",
        "concat(o_custkey % 60 + 1920, '0615') AS BENE_BIRTH_DT",
        "if(o_custkey % 11 = 0, date_format(o_orderdate, 'yyyyMMdd'), NULL) AS BENE_DEATH_DT",
        "CAST(o_custkey % 3 AS STRING) AS BENE_SEX_IDENT_CD",
        "CAST(o_custkey % 5 + 1 AS STRING) AS BENE_RACE_CD",
        "CASE WHEN o_custkey % 10 = 0 THEN concat('A', c_nationkey % 10) "
        "WHEN o_custkey % 17 = 0 THEN '99' ELSE CAST(c_nationkey AS STRING) END AS SP_STATE_CODE",
        "CAST(o_orderkey % 300 AS STRING) AS BENE_COUNTY_CD",
        "CAST(o_orderkey % 13 AS STRING) AS BENE_HI_CVRAGE_TOT_MONS",
        "CAST(o_custkey % 13 AS STRING) AS BENE_SMI_CVRAGE_TOT_MONS",
        "if(o_orderkey % 13 < 12, CAST(o_orderkey % 12 AS STRING), NULL) AS PLAN_CVRG_MOS_NUM",
        *flags,
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS MEDREIMB_IP",
        "if(o_orderkey % 5 > 0, CAST(o_orderkey % 5000 AS STRING), NULL) AS MEDREIMB_OP",
        "if(o_orderkey % 7 > 0, CAST(o_orderkey % 3000 AS STRING), NULL) AS MEDREIMB_CAR",
        "CAST(o_orderkey % 1100 AS STRING) AS BENRES_IP",
        "CAST(o_orderkey % 700 AS STRING) AS BENRES_OP",
        "CAST(o_orderkey % 500 AS STRING) AS BENRES_CAR",
        "CAST(year(o_orderdate) AS STRING) AS _source_year",
    )


def _claims(spark: SparkSession, sf_dir: str, status: str, *columns: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == status)
        .selectExpr(
            "CAST(o_custkey AS STRING) AS DESYNPUF_ID",
            "CAST(o_orderkey AS STRING) AS CLM_ID",
            f"{START} AS CLM_FROM_DT",
            f"{END} AS CLM_THRU_DT",
            *columns,
        )
    )


START = "date_format(o_orderdate, 'yyyyMMdd')"
END = "date_format(date_add(o_orderdate, CAST(o_orderkey % 15 AS INT)), 'yyyyMMdd')"
PROVIDER = "concat('P', o_orderkey % 100)"
PAID = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
SHARE = "CAST(o_orderkey % 90 AS STRING)"
DIAGNOSIS = "left(o_orderpriority, 1)"


def raw_inpatient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(
        spark,
        sf_dir,
        "F",
        f"{PROVIDER} AS PRVDR_NUM",
        f"{PAID} AS CLM_PMT_AMT",
        f"{SHARE} AS NCH_PRMRY_PYR_CLM_PD_AMT",
        f"{START} AS CLM_ADMSN_DT",
        f"if(o_orderkey % 19 > 0, {END}, NULL) AS NCH_BENE_DSCHRG_DT",
        "CAST(o_orderkey % 15 AS STRING) AS CLM_UTLZTN_DAY_CNT",
        "CAST(o_orderkey % 500 AS STRING) AS CLM_DRG_CD",
        f"{DIAGNOSIS} AS ADMTNG_ICD9_DGNS_CD",
        "if(o_orderkey % 4 = 0, '1024', '') AS NCH_BENE_IP_DDCTBL_AMT",
        "'0' AS NCH_BENE_PTA_COINSRNC_LBLTY_AM",
        f"{DIAGNOSIS} AS ICD9_DGNS_CD_1",
        f"if(o_orderkey % 2 = 0, {DIAGNOSIS}, NULL) AS ICD9_DGNS_CD_2",
        "CAST(NULL AS STRING) AS ICD9_DGNS_CD_3",
    )


def raw_outpatient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(
        spark,
        sf_dir,
        "O",
        f"{PROVIDER} AS PRVDR_NUM",
        f"{PAID} AS CLM_PMT_AMT",
        f"{SHARE} AS NCH_PRMRY_PYR_CLM_PD_AMT",
        "if(o_orderkey % 4 = 0, '100', 'x') AS NCH_BENE_PTB_DDCTBL_AMT",
        "'0' AS NCH_BENE_BLOOD_DDCTBL_LBLTY_AM",
        f"{DIAGNOSIS} AS ICD9_DGNS_CD_1",
        f"if(o_orderkey % 2 = 0, {DIAGNOSIS}, NULL) AS ICD9_DGNS_CD_2",
        "CAST(NULL AS STRING) AS ICD9_DGNS_CD_3",
        "CAST(o_orderkey % 9000 AS STRING) AS HCPCS_CD_1",
    )


def raw_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(
        spark,
        sf_dir,
        "P",
        f"{PROVIDER} AS PRF_PHYSN_NPI_1",
        "CAST(o_orderkey % 77 AS STRING) AS TAX_NUM_1",
        f"{PAID} AS LINE_NCH_PMT_AMT_1",
        f"{SHARE} AS LINE_BENE_PTB_DDCTBL_AMT_1",
        "if(o_orderkey % 4 = 0, '100', '') AS LINE_ALOWD_CHRG_AMT_1",
        f"{SHARE} AS LINE_COINSRNC_AMT_1",
        "CAST(o_orderkey % 9000 AS STRING) AS HCPCS_CD_1",
        f"{DIAGNOSIS} AS LINE_ICD9_DGNS_CD_1",
    )


def raw_partd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending by drug name, with headers as in the published file."""
    by_part = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spend"),
            F.count("*").alias("claims"),
        )
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (
        by_part.join(part, by_part.l_partkey == part.p_partkey, "inner")
        .groupBy(F.col("p_name").alias("Brand Name"), F.col("p_type").alias("Generic-Name"))
        .agg(
            F.sum("spend").cast("double").alias("Total Spending"),
            F.sum("claims").alias("Total Claims"),
        )
    )


# --- the same inputs, typed --------------------------------------------------------------


class Inputs:
    """Typed and gold frames over one directory of test tables, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _typed(self, build, *raws) -> DataFrame:
        return build(*[raw(self.spark, self.sf_dir) for raw in raws])

    def dim_drug(self) -> DataFrame:
        return self._typed(silver.build_drug_dim, raw_product, raw_package)

    def pricing(self) -> DataFrame:
        return self._typed(silver.build_pricing, raw_prices)

    def fills(self) -> DataFrame:
        return self._typed(silver.build_fills, raw_fills)

    def stored_fills(self) -> DataFrame:
        """The fills, written once, for what reads them more than once."""
        return stored(self.fills(), "typed-fills")

    def patients(self) -> DataFrame:
        return self._typed(silver.latest_patient, raw_patients)

    def inpatient(self) -> DataFrame:
        return self._typed(silver.build_inpatient, raw_inpatient)

    def outpatient(self) -> DataFrame:
        return self._typed(silver.build_outpatient, raw_outpatient)

    def carrier(self) -> DataFrame:
        return self._typed(silver.build_carrier, raw_carrier)

    def journey(self) -> DataFrame:
        return gold.drug_cost_journey(self.fills(), self.dim_drug(), self.pricing())

    def utilization(self) -> DataFrame:
        return gold.patient_utilization(self.fills(), self.patients())

    def cohort(self) -> DataFrame:
        return gold.high_cost_cohort(self.stored_utilization(), self.inpatient(), self.outpatient())

    def stored_utilization(self) -> DataFrame:
        """The utilization, written once, for what reads it more than once."""
        return stored(self.utilization(), "utilization")

    def refill_stats(self) -> DataFrame:
        return refills.refill_stats(self.fills())

    def anomaly_features(self) -> DataFrame:
        return prices.price_anomaly_features(self.pricing())
