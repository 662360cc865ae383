from datetime import date

import pytest
from pyspark.sql import functions as F

from rxlake.operators import silver
from rxlake.sources import schemas


def raw(spark, schema, *rows):
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_drug_dim(spark, by_key):
    product = raw(spark, schemas.PRODUCT, {"PRODUCTNDC": "0002-1433", "PROPRIETARYNAME": "A"})
    package = raw(
        spark,
        schemas.PACKAGE,
        {"PRODUCTNDC": "0002-1433", "NDCPACKAGECODE": "0002-1433-01"},
        {"PRODUCTNDC": "0002-1433", "NDCPACKAGECODE": "0002-1433-02"},
        {"PRODUCTNDC": "0002-1433", "NDCPACKAGECODE": "00002143301"},
        {"PRODUCTNDC": "9999-1111", "NDCPACKAGECODE": "9999-1111-1"},
        {"PRODUCTNDC": "0002-1433", "NDCPACKAGECODE": "junk"},
    )
    dim = silver.build_drug_dim(product, package)
    assert len(dim.columns) == 15
    rows = by_key(dim, "ndc")
    assert set(rows) == {"00002143301", "00002143302", "09999111101"}
    assert rows["00002143301"]["ndc_package_code_raw"] == "0002-1433-01" or (
        rows["00002143301"]["ndc_package_code_raw"] == "00002143301"
    )
    assert rows["00002143302"]["brand_name"] == "A"
    assert rows["09999111101"]["brand_name"] is None


def test_drug_dim_is_the_same_for_any_partitioning(spark, partitions):
    product = raw(spark, schemas.PRODUCT, {"PRODUCTNDC": "1", "PROPRIETARYNAME": "A"})
    package = raw(
        spark,
        schemas.PACKAGE,
        *[
            {"PRODUCTNDC": "1", "NDCPACKAGECODE": "1-1-1", "PACKAGEDESCRIPTION": f"d{i}"}
            for i in range(20)
        ],
    )
    results = partitions(
        lambda n: silver.build_drug_dim(product, package.repartition(n)).collect()
    )
    assert results[0] == results[1] == results[2]
    assert results[0][0]["package_description"] == "d0"


def test_pricing(spark, by_key):
    rows = by_key(
        silver.build_pricing(
            raw(
                spark,
                schemas.PRICES,
                {
                    "NDC": "00002143301", "NDC_Description": " A ", "NADAC_Per_Unit": "0.12345",
                    "Effective_Date": "01/31/2024", "Pharmacy_Type_Indicator": "C/I ",
                    "Corresponding_Generic_Drug_NADAC_Per_Unit": "",
                    "Corresponding_Generic_Drug_Effective_Date": "02/30/2024",
                },
                {"NDC": "123", "NADAC_Per_Unit": "abc", "Effective_Date": "2024-01-31"},
                {"NDC": "124", "NADAC_Per_Unit": "NaN"},
                {"NDC": "nope", "NADAC_Per_Unit": "1"},
                {"NDC": None, "NADAC_Per_Unit": "1"},
            )
        ),
        "ndc",
    )
    assert set(rows) == {"00002143301", "00000000123", "00000000124"}
    first = rows["00002143301"]
    assert first["ndc_description"] == "A" and first["pharmacy_type"] == "C/I"
    assert first["nadac_per_unit"] == 0.12345
    assert first["effective_date"] == date(2024, 1, 31)
    assert first["generic_nadac_per_unit"] is None and first["generic_effective_date"] is None
    assert rows["00000000123"]["nadac_per_unit"] is None
    assert rows["00000000123"]["effective_date"] is None
    assert rows["00000000124"]["nadac_per_unit"] is None


def test_fills(spark, by_key):
    rows = by_key(
        silver.build_fills(
            raw(
                spark,
                schemas.FILLS,
                {
                    "DESYNPUF_ID": "P", "PDE_ID": "1", "SRVC_DT": "20090215",
                    "PROD_SRVC_ID": "0002143301", "QTY_DSPNSD_NUM": "30.000",
                    "DAYS_SUPLY_NUM": "30", "PTNT_PAY_AMT": "10.50", "TOT_RX_CST_AMT": "100.25",
                },
                {"DESYNPUF_ID": "P", "PDE_ID": "2", "SRVC_DT": "20090230",
                 "PROD_SRVC_ID": "bad", "PTNT_PAY_AMT": "", "TOT_RX_CST_AMT": "5"},
            )
        ),
        "pde_id",
    )
    one, two = rows["1"], rows["2"]
    assert one["ndc"] == "00021433001" and one["ndc_raw"] == "0002143301"
    assert one["service_date"] == date(2009, 2, 15)
    assert (one["service_year"], one["service_month"], one["days_supply"]) == (2009, 2, 30)
    assert one["payer_paid_amount"] == pytest.approx(89.75)
    assert two["ndc"] is None and two["service_date"] is None
    assert two["payer_paid_amount"] is None and two["total_rx_cost"] == 5.0


def patient(**more):
    return {"DESYNPUF_ID": "P", **more}


def with_year(spark, *rows):
    years = [r.pop("_source_year") for r in rows]
    df = None
    for year, row in zip(years, rows):
        one = raw(spark, schemas.PATIENTS, row).withColumn("_source_year", F.lit(year))
        df = one if df is None else df.unionByName(one)
    return df


def test_latest_patient(spark, by_key):
    rows = by_key(
        silver.latest_patient(
            with_year(
                spark,
                patient(_source_year="2008", BENE_SEX_IDENT_CD="1", SP_STATE_CODE="7"),
                patient(
                    _source_year="2010", BENE_SEX_IDENT_CD="2", SP_STATE_CODE="5",
                    BENE_BIRTH_DT="19230501", BENE_DEATH_DT="20100301", SP_CHF="1",
                    SP_COPD="2", SP_DIABETES="1", MEDREIMB_IP="1000.00",
                ),
                {"DESYNPUF_ID": "Q", "_source_year": "2009", "SP_STATE_CODE": "A5",
                 "BENE_SEX_IDENT_CD": "9"},
            )
        ),
        "beneficiary_id",
    )
    p, q = rows["P"], rows["Q"]
    assert p["sex"] == "Female" and p["state_code"] == "05" and p["record_year"] == 2010
    assert p["birth_date"] == date(1923, 5, 1) and p["is_deceased"] == 1
    assert p["cc_heart_failure"] == 1 and p["cc_copd"] == 0 and p["cc_stroke_tia"] == 0
    assert p["chronic_condition_count"] == 2 and p["inpatient_reimbursement"] == 1000.0
    assert q["sex"] == "Unknown" and q["state_code"] == "A5" and q["is_deceased"] == 0
    assert len(p) == 30


def test_latest_patient_ties(spark, partitions):
    df = with_year(
        spark,
        *[patient(_source_year="2010", MEDREIMB_IP=str(v)) for v in (5, 3, 9, 4)],
    )
    results = partitions(lambda n: silver.latest_patient(df.repartition(n)).collect())
    assert results[0] == results[1] == results[2]
    assert results[0][0]["inpatient_reimbursement"] == 3.0


def test_claims(spark):
    claim = {
        "DESYNPUF_ID": "P", "CLM_ID": "1", "CLM_FROM_DT": "20080104", "CLM_THRU_DT": "20080110",
        "PRVDR_NUM": "X", "CLM_PMT_AMT": "4000.00", "CLM_ADMSN_DT": "20080104",
        "NCH_BENE_DSCHRG_DT": "20080110", "CLM_UTLZTN_DAY_CNT": "6", "ICD9_DGNS_CD_1": "4019",
    }
    stay = silver.build_inpatient(raw(spark, schemas.INPATIENT, claim)).first()
    assert stay["length_of_stay"] == 6 and stay["service_year"] == 2008
    assert stay["claim_payment_amount"] == 4000.0 and len(stay) == 19
    open_stay = dict(claim, NCH_BENE_DSCHRG_DT="")
    row = silver.build_inpatient(raw(spark, schemas.INPATIENT, open_stay)).first()
    assert row["length_of_stay"] is None
    visit = silver.build_outpatient(
        raw(spark, schemas.OUTPATIENT, {**claim, "HCPCS_CD_1": "99213"})
    ).first()
    assert visit["hcpcs_1"] == "99213" and len(visit) == 14
    line = silver.build_carrier(
        raw(spark, schemas.CARRIER, {**claim, "LINE_NCH_PMT_AMT_1": "80", "TAX_NUM_1": "7"})
    ).first()
    assert line["claim_payment_amount"] == line["primary_payer_paid"] == line["line_1_payment"] == 80
    assert len(line) == 15


def test_claims_by_year(spark):
    rows = raw(
        spark,
        schemas.CARRIER,
        *[{"CLM_FROM_DT": d} for d in ("20080101", "20081231", "20100601", "bad")],
    )
    got = [tuple(r) for r in silver.claims_by_year(rows).collect()]
    assert got == [(2010, 1), (2008, 2), (None, 1)]
