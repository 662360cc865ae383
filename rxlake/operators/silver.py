"""Raw text tables to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.functions.codes import normalize_code, readable_code
from rxlake.functions.columns import (
    flag,
    parse_amount,
    parse_compact_date,
    parse_int,
    parse_us_date,
    present,
    total,
)
from rxlake.operators.keyed import ascending, first_per_key
from rxlake.sources.schemas import CONDITION_FLAGS


def _known_code(raw: str) -> Column:
    """The code of a row that passed ``readable_code``.

    Declared non-null, so that joins on it need not normalize once more to test for NULL.
    """
    return F.coalesce(normalize_code(F.col(raw)), F.lit(""))


def build_drug_dim(product: DataFrame, package: DataFrame) -> DataFrame:
    """One row per readable 11-digit drug code, with the product's description.

    Both sides are cut to one row per key before they meet, so repeated listings never
    multiply.
    """
    listed = package.filter(readable_code(F.col("NDCPACKAGECODE"))).withColumn(
        "ndc", _known_code("NDCPACKAGECODE")
    )
    listed = first_per_key(
        listed, ["ndc"], ascending(["PRODUCTNDC", "NDCPACKAGECODE", "PACKAGEDESCRIPTION"])
    )
    described = product.select(
        "PRODUCTNDC",
        F.col("PROPRIETARYNAME").alias("brand_name"),
        F.col("NONPROPRIETARYNAME").alias("generic_name"),
        F.col("LABELERNAME").alias("labeler_name"),
        F.col("DOSAGEFORMNAME").alias("dosage_form"),
        F.col("ROUTENAME").alias("route"),
        F.col("SUBSTANCENAME").alias("active_ingredients"),
        F.col("ACTIVE_NUMERATOR_STRENGTH").alias("strength"),
        F.col("ACTIVE_INGRED_UNIT").alias("strength_unit"),
        F.col("PHARM_CLASSES").alias("pharm_classes"),
        F.col("DEASCHEDULE").alias("dea_schedule"),
        F.col("PRODUCTTYPENAME").alias("product_type"),
    )
    details = described.columns[1:]
    described = first_per_key(described, ["PRODUCTNDC"], ascending(details))
    return listed.join(described, "PRODUCTNDC", "left").select(
        "ndc",
        F.col("PRODUCTNDC").alias("product_ndc"),
        F.col("NDCPACKAGECODE").alias("ndc_package_code_raw"),
        *details,
        F.col("PACKAGEDESCRIPTION").alias("package_description"),
    )


def build_pricing(raw: DataFrame) -> DataFrame:
    """Typed price observations; rows whose drug code cannot be read are left out."""
    return raw.filter(readable_code(F.col("NDC"))).select(
        _known_code("NDC").alias("ndc"),
        F.trim("NDC_Description").alias("ndc_description"),
        parse_amount(F.col("NADAC_Per_Unit")).alias("nadac_per_unit"),
        parse_us_date(F.col("Effective_Date")).alias("effective_date"),
        F.trim("Pricing_Unit").alias("pricing_unit"),
        F.trim("Pharmacy_Type_Indicator").alias("pharmacy_type"),
        F.trim("OTC").alias("otc_flag"),
        F.trim("Explanation_Code").alias("explanation_code"),
        F.trim("Classification_for_Rate_Setting").alias("rate_classification"),
        parse_amount(F.col("Corresponding_Generic_Drug_NADAC_Per_Unit")).alias(
            "generic_nadac_per_unit"
        ),
        parse_us_date(F.col("Corresponding_Generic_Drug_Effective_Date")).alias(
            "generic_effective_date"
        ),
    )


def build_fills(raw: DataFrame) -> DataFrame:
    """Typed prescription fills. Fills with an unreadable drug code stay, with NULL ``ndc``."""
    typed = raw.select(
        F.col("DESYNPUF_ID").alias("beneficiary_id"),
        F.col("PDE_ID").alias("pde_id"),
        parse_compact_date(F.col("SRVC_DT")).alias("service_date"),
        normalize_code(F.col("PROD_SRVC_ID")).alias("ndc"),
        F.col("PROD_SRVC_ID").cast("string").alias("ndc_raw"),
        parse_amount(F.col("QTY_DSPNSD_NUM")).alias("quantity_dispensed"),
        parse_int(F.col("DAYS_SUPLY_NUM")).alias("days_supply"),
        parse_amount(F.col("PTNT_PAY_AMT")).alias("patient_pay_amount"),
        parse_amount(F.col("TOT_RX_CST_AMT")).alias("total_rx_cost"),
    )
    return typed.withColumns(
        {
            "payer_paid_amount": F.col("total_rx_cost") - F.col("patient_pay_amount"),
            "service_year": F.year("service_date"),
            "service_month": F.month("service_date"),
        }
    )


def latest_patient(raw: DataFrame, year_col: str = "_source_year") -> DataFrame:
    """One typed row per patient, from the latest yearly record.

    Records of the same year are ordered by all their other columns, so the pick does not
    depend on how the input is partitioned. The state code stays two characters of text, so
    that leading zeros and letter codes survive.
    """
    rest = [c for c in raw.columns if c not in ("DESYNPUF_ID", year_col)]
    latest = first_per_key(
        raw, ["DESYNPUF_ID"], [F.col(year_col).desc_nulls_last(), *ascending(rest)]
    )
    sex = F.col("BENE_SEX_IDENT_CD").try_cast("int")
    state = F.trim("SP_STATE_CODE")
    typed = latest.select(
        F.col("DESYNPUF_ID").alias("beneficiary_id"),
        parse_compact_date(F.col("BENE_BIRTH_DT")).alias("birth_date"),
        parse_compact_date(F.col("BENE_DEATH_DT")).alias("death_date"),
        F.when(sex == 1, "Male").when(sex == 2, "Female").otherwise("Unknown").alias("sex"),
        parse_int(F.col("BENE_RACE_CD")).alias("race_code"),
        F.when(F.length(state) < 2, F.lpad(state, 2, "0")).otherwise(state).alias("state_code"),
        parse_int(F.col("BENE_COUNTY_CD")).alias("county_code"),
        parse_int(F.col("BENE_HI_CVRAGE_TOT_MONS")).alias("part_a_coverage_months"),
        parse_int(F.col("BENE_SMI_CVRAGE_TOT_MONS")).alias("part_b_coverage_months"),
        parse_int(F.col("PLAN_CVRG_MOS_NUM")).alias("part_d_coverage_months"),
        *[flag(F.col(raw_name)).alias(name) for raw_name, name in CONDITION_FLAGS.items()],
        parse_amount(F.col("MEDREIMB_IP")).alias("inpatient_reimbursement"),
        parse_amount(F.col("MEDREIMB_OP")).alias("outpatient_reimbursement"),
        parse_amount(F.col("MEDREIMB_CAR")).alias("carrier_reimbursement"),
        parse_amount(F.col("BENRES_IP")).alias("inpatient_beneficiary_resp"),
        parse_amount(F.col("BENRES_OP")).alias("outpatient_beneficiary_resp"),
        parse_amount(F.col("BENRES_CAR")).alias("carrier_beneficiary_resp"),
        parse_int(F.col(year_col)).alias("record_year"),
    )
    return typed.withColumns(
        {
            "chronic_condition_count": total([F.col(c) for c in CONDITION_FLAGS.values()]),
            "is_deceased": present(F.col("death_date")),
        }
    )


def _claim_columns() -> list:
    return [
        F.col("DESYNPUF_ID").alias("beneficiary_id"),
        F.col("CLM_ID").alias("claim_id"),
        parse_compact_date(F.col("CLM_FROM_DT")).alias("claim_start_date"),
        parse_compact_date(F.col("CLM_THRU_DT")).alias("claim_end_date"),
    ]


def build_inpatient(raw: DataFrame) -> DataFrame:
    """Typed hospital stays with their length in days."""
    typed = raw.select(
        *_claim_columns(),
        F.col("PRVDR_NUM").alias("provider_id"),
        parse_amount(F.col("CLM_PMT_AMT")).alias("claim_payment_amount"),
        parse_amount(F.col("NCH_PRMRY_PYR_CLM_PD_AMT")).alias("primary_payer_paid"),
        parse_compact_date(F.col("CLM_ADMSN_DT")).alias("admission_date"),
        parse_compact_date(F.col("NCH_BENE_DSCHRG_DT")).alias("discharge_date"),
        parse_int(F.col("CLM_UTLZTN_DAY_CNT")).alias("utilization_days"),
        F.col("CLM_DRG_CD").alias("drg_code"),
        F.col("ADMTNG_ICD9_DGNS_CD").alias("admitting_diagnosis"),
        parse_amount(F.col("NCH_BENE_IP_DDCTBL_AMT")).alias("deductible_amount"),
        parse_amount(F.col("NCH_BENE_PTA_COINSRNC_LBLTY_AM")).alias("coinsurance_amount"),
        F.col("ICD9_DGNS_CD_1").alias("diag_1"),
        F.col("ICD9_DGNS_CD_2").alias("diag_2"),
        F.col("ICD9_DGNS_CD_3").alias("diag_3"),
    )
    return typed.withColumns(
        {
            "service_year": F.year("claim_start_date"),
            "length_of_stay": F.datediff("discharge_date", "admission_date"),
        }
    )


def build_outpatient(raw: DataFrame) -> DataFrame:
    """Typed outpatient claims."""
    return raw.select(
        *_claim_columns(),
        F.col("PRVDR_NUM").alias("provider_id"),
        parse_amount(F.col("CLM_PMT_AMT")).alias("claim_payment_amount"),
        parse_amount(F.col("NCH_PRMRY_PYR_CLM_PD_AMT")).alias("primary_payer_paid"),
        parse_amount(F.col("NCH_BENE_PTB_DDCTBL_AMT")).alias("deductible_amount"),
        parse_amount(F.col("NCH_BENE_BLOOD_DDCTBL_LBLTY_AM")).alias("blood_deductible"),
        F.col("ICD9_DGNS_CD_1").alias("diag_1"),
        F.col("ICD9_DGNS_CD_2").alias("diag_2"),
        F.col("ICD9_DGNS_CD_3").alias("diag_3"),
        F.col("HCPCS_CD_1").alias("hcpcs_1"),
    ).withColumn("service_year", F.year("claim_start_date"))


def build_carrier(raw: DataFrame) -> DataFrame:
    """Typed physician claims, first line only.

    The raw file has no claim-level payment, so the claim payment and the primary payer
    amount are both the payment of line 1.
    """
    line_payment = parse_amount(F.col("LINE_NCH_PMT_AMT_1"))
    return raw.select(
        *_claim_columns(),
        F.col("PRF_PHYSN_NPI_1").alias("provider_id"),
        line_payment.alias("claim_payment_amount"),
        line_payment.alias("primary_payer_paid"),
        F.col("TAX_NUM_1").alias("provider_tax_id"),
        line_payment.alias("line_1_payment"),
        parse_amount(F.col("LINE_BENE_PTB_DDCTBL_AMT_1")).alias("line_1_deductible"),
        parse_amount(F.col("LINE_ALOWD_CHRG_AMT_1")).alias("line_1_allowed_amount"),
        parse_amount(F.col("LINE_COINSRNC_AMT_1")).alias("line_1_coinsurance"),
        F.col("HCPCS_CD_1").alias("hcpcs_1"),
        F.col("LINE_ICD9_DGNS_CD_1").alias("line_1_diagnosis"),
    ).withColumn("service_year", F.year("claim_start_date"))


def claims_by_year(raw: DataFrame, date_col: str = "CLM_FROM_DT") -> DataFrame:
    """Raw claims counted by the year of a ``yyyyMMdd`` column, latest first."""
    return (
        raw.groupBy(F.year(parse_compact_date(F.col(date_col))).alias("year"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("year").desc_nulls_last())
    )
