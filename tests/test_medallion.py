from rxlake.plans import medallion
from rxlake.sources import read_layer, schemas
from rxlake.sources.tables import GOLD, SILVER


def write(folder, name, schema, rows, sep=","):
    names = schema.names if hasattr(schema, "names") else schema
    lines = [sep.join(names)]
    lines += [sep.join(r.get(n, "") for n in names) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_files_to_gold(spark, tmp_path):
    write(tmp_path, "product.txt", schemas.PRODUCT,
          [{"PRODUCTNDC": "0002-1433", "PROPRIETARYNAME": "Brand"}], "\t")
    write(tmp_path, "package.txt", schemas.PACKAGE,
          [{"PRODUCTNDC": "0002-1433", "NDCPACKAGECODE": "0002-1433-01"}], "\t")
    write(tmp_path, "nadac_2009.csv", schemas.PRICES,
          [{"NDC": "00002143301", "NADAC_Per_Unit": "2.5", "Effective_Date": "01/15/2009",
            "Classification_for_Rate_Setting": "G"}])
    for year, state in (("2008", "05"), ("2009", "10")):
        write(tmp_path, f"DE1_0_{year}_Beneficiary_Summary_File_Sample_1.csv", schemas.PATIENTS,
              [{"DESYNPUF_ID": "P", "SP_STATE_CODE": state, "MEDREIMB_IP": "40"}])
    fill = {"DESYNPUF_ID": "P", "PROD_SRVC_ID": "00002143301", "QTY_DSPNSD_NUM": "10",
            "DAYS_SUPLY_NUM": "30", "PTNT_PAY_AMT": "10", "TOT_RX_CST_AMT": "60"}
    write(tmp_path, "DE1_0_2008_2010_Prescription_Drug_Events_Sample_1.csv", schemas.FILLS,
          [{**fill, "PDE_ID": "1", "SRVC_DT": "20090110"},
           {**fill, "PDE_ID": "2", "SRVC_DT": "20090210"}])
    claim = {"DESYNPUF_ID": "P", "CLM_ID": "1", "CLM_FROM_DT": "20090101", "CLM_PMT_AMT": "7"}
    write(tmp_path, "DE1_0_2008_2010_Inpatient_Claims_Sample_1.csv", schemas.INPATIENT, [claim])
    write(tmp_path, "DE1_0_2008_2010_Outpatient_Claims_Sample_1.csv", schemas.OUTPATIENT, [claim])
    for part in "AB":
        write(tmp_path, f"DE1_0_2008_2010_Carrier_Claims_Sample_1{part}.csv", schemas.CARRIER,
              [{**claim, "CLM_ID": part}])
    write(tmp_path, "DSD_PTD_RY25.csv", ["Brand Name", "Tot-Spend"],
          [{"Brand Name": "X", "Tot-Spend": "5"}])

    medallion.ingest_files(spark, str(tmp_path))
    medallion.build_silver(spark)
    medallion.build_gold(spark)

    counts = {r[0]: r[1] for r in medallion.inventory(spark, SILVER).collect()}
    assert counts["fact_carrier_claims"] == 2 and counts["dim_beneficiary"] == 1
    assert read_layer(spark, SILVER, "agg_partd_spending").columns == ["brand_name", "tot_spend"]
    patient = read_layer(spark, SILVER, "dim_beneficiary").first()
    assert patient["record_year"] == 2009 and patient["state_code"] == "10"
    journey = read_layer(spark, GOLD, "drug_cost_journey").first()
    assert journey["brand_name"] == "Brand" and journey["nadac_per_unit"] == 2.5
    assert journey["acquisition_to_claim_spread"] == 3.5
    months = {r["month"]: r["spread"] for r in
              read_layer(spark, GOLD, "drug_cost_spread_analysis").collect()}
    assert months == {1: 3.5, 2: None}
    cohort = read_layer(spark, GOLD, "high_cost_drug_cohort").first()
    assert cohort["total_all_spend"] == 160.0 and cohort["inpatient_total_paid"] == 7.0


def test_tables_as_source(spark):
    spark.createDataFrame([("P", "05")], "DESYNPUF_ID string, SP_STATE_CODE string").write.mode(
        "overwrite"
    ).saveAsTable("shared_ben_sum")
    medallion.ingest_tables(spark, {"synpuf_beneficiary": "default.shared_ben_sum"})
    row = read_layer(spark, "bronze", "synpuf_beneficiary").first()
    assert row["_source_year"] == "2010"
