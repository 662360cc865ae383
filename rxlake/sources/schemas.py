"""Column names of the raw files. Every raw column is text, so codes keep leading zeros."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def text_schema(names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names.split()])


PRODUCT = text_schema(
    "PRODUCTNDC PROPRIETARYNAME NONPROPRIETARYNAME LABELERNAME DOSAGEFORMNAME ROUTENAME "
    "SUBSTANCENAME ACTIVE_NUMERATOR_STRENGTH ACTIVE_INGRED_UNIT PHARM_CLASSES DEASCHEDULE "
    "PRODUCTTYPENAME"
)
PACKAGE = text_schema("PRODUCTNDC NDCPACKAGECODE PACKAGEDESCRIPTION")
PRICES = text_schema(
    "NDC NDC_Description NADAC_Per_Unit Effective_Date Pricing_Unit Pharmacy_Type_Indicator OTC "
    "Explanation_Code Classification_for_Rate_Setting Corresponding_Generic_Drug_NADAC_Per_Unit "
    "Corresponding_Generic_Drug_Effective_Date"
)
CONDITION_FLAGS = {
    "SP_ALZHDMTA": "cc_alzheimers",
    "SP_CHF": "cc_heart_failure",
    "SP_CHRNKIDN": "cc_chronic_kidney",
    "SP_CNCR": "cc_cancer",
    "SP_COPD": "cc_copd",
    "SP_DEPRESSN": "cc_depression",
    "SP_DIABETES": "cc_diabetes",
    "SP_ISCHMCHT": "cc_ischemic_heart",
    "SP_OSTEOPRS": "cc_osteoporosis",
    "SP_RA_OA": "cc_arthritis",
    "SP_STRKETIA": "cc_stroke_tia",
}
PATIENTS = text_schema(
    "DESYNPUF_ID BENE_BIRTH_DT BENE_DEATH_DT BENE_SEX_IDENT_CD BENE_RACE_CD SP_STATE_CODE "
    "BENE_COUNTY_CD BENE_HI_CVRAGE_TOT_MONS BENE_SMI_CVRAGE_TOT_MONS PLAN_CVRG_MOS_NUM "
    + " ".join(CONDITION_FLAGS)
    + " MEDREIMB_IP MEDREIMB_OP MEDREIMB_CAR BENRES_IP BENRES_OP BENRES_CAR"
)
FILLS = text_schema(
    "DESYNPUF_ID PDE_ID SRVC_DT PROD_SRVC_ID QTY_DSPNSD_NUM DAYS_SUPLY_NUM PTNT_PAY_AMT "
    "TOT_RX_CST_AMT"
)
INPATIENT = text_schema(
    "DESYNPUF_ID CLM_ID CLM_FROM_DT CLM_THRU_DT PRVDR_NUM CLM_PMT_AMT NCH_PRMRY_PYR_CLM_PD_AMT "
    "CLM_ADMSN_DT NCH_BENE_DSCHRG_DT CLM_UTLZTN_DAY_CNT CLM_DRG_CD ADMTNG_ICD9_DGNS_CD "
    "NCH_BENE_IP_DDCTBL_AMT NCH_BENE_PTA_COINSRNC_LBLTY_AM ICD9_DGNS_CD_1 ICD9_DGNS_CD_2 "
    "ICD9_DGNS_CD_3"
)
OUTPATIENT = text_schema(
    "DESYNPUF_ID CLM_ID CLM_FROM_DT CLM_THRU_DT PRVDR_NUM CLM_PMT_AMT NCH_PRMRY_PYR_CLM_PD_AMT "
    "NCH_BENE_PTB_DDCTBL_AMT NCH_BENE_BLOOD_DDCTBL_LBLTY_AM ICD9_DGNS_CD_1 ICD9_DGNS_CD_2 "
    "ICD9_DGNS_CD_3 HCPCS_CD_1"
)
CARRIER = text_schema(
    "DESYNPUF_ID CLM_ID CLM_FROM_DT CLM_THRU_DT PRF_PHYSN_NPI_1 TAX_NUM_1 LINE_NCH_PMT_AMT_1 "
    "LINE_BENE_PTB_DDCTBL_AMT_1 LINE_ALOWD_CHRG_AMT_1 LINE_COINSRNC_AMT_1 HCPCS_CD_1 "
    "LINE_ICD9_DGNS_CD_1"
)
