"""Reference answers: for each registered query, plain SQL on the test tables (DuckDB)."""

from __future__ import annotations

# Fixed values, kept here a second time so that an error in the package shows: the state lookup,
# the condition flags, and the patient columns in file order.
STATE_CODES = {
    "00": "04", "01": "01", "02": "02", "03": "04", "04": "05", "05": "06", "06": "08",
    "07": "09", "08": "10", "09": "11", "10": "12", "11": "13", "12": "15", "13": "16",
    "14": "17", "15": "18", "16": "19", "17": "20", "18": "21", "19": "22", "20": "23",
    "21": "24", "22": "25", "23": "26", "24": "27", "25": "28", "26": "29", "27": "30",
    "28": "31", "29": "32", "30": "33", "31": "34", "32": "35", "33": "36", "34": "37",
    "35": "38", "36": "39", "37": "40", "38": "41", "39": "42", "40": "72", "41": "44",
    "42": "45", "43": "46", "44": "47", "45": "48", "46": "49", "47": "50", "48": "78",
    "49": "51", "50": "53", "51": "54", "52": "55", "53": "56", "54": "16", "55": "06",
    "56": "CA", "57": "36", "58": "54", "59": "MX", "64": "60", "65": "66", "66": "69",
    "67": "48", "68": "12", "69": "12", "70": "20", "71": "22", "72": "39", "73": "42",
    "74": "48", "75": "06", "76": "19", "77": "27", "78": "17", "79": "29", "80": "24",
    "81": "09", "82": "25", "83": "34", "84": "72", "85": "13", "86": "37", "87": "45",
    "88": "47", "89": "05", "90": "40", "91": "08", "92": "06", "93": "41", "94": "53",
    "95": "22", "96": "35", "97": "48", "99": None,
    "A0": "37", "A1": "37", "A2": "12", "A3": "22", "A4": "26", "A5": "28", "A6": "39",
    "A7": "42", "A8": "47", "A9": "48", "B0": "21", "B1": "54", "B2": "37",
}
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
PATIENT_COLUMNS = (
    "BENE_BIRTH_DT BENE_DEATH_DT BENE_SEX_IDENT_CD BENE_RACE_CD SP_STATE_CODE BENE_COUNTY_CD "
    "BENE_HI_CVRAGE_TOT_MONS BENE_SMI_CVRAGE_TOT_MONS PLAN_CVRG_MOS_NUM SP_ALZHDMTA SP_CHF "
    "SP_CHRNKIDN SP_CNCR SP_COPD SP_DEPRESSN SP_DIABETES SP_ISCHMCHT SP_OSTEOPRS SP_RA_OA "
    "SP_STRKETIA MEDREIMB_IP MEDREIMB_OP MEDREIMB_CAR BENRES_IP BENRES_OP BENRES_CAR "
).split()

# --- SQL fragments -----------------------------------------------------------------------


def esum(x: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def eavg(x: str, scale: int = 2) -> str:
    return f"({esum(x, scale)} / nullif(count({x}), 0))"


def iavg(x: str) -> str:
    """Mean of a whole-number column."""
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def rnd(x: str, n: int) -> str:
    # By way of text: the shortest decimal form of the number, halves away from zero.
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def product_code(k: str) -> str:
    return (
        f"(lpad(CAST(({k} // 10000) % 100000 AS VARCHAR), 5, '0') || '-' || "
        f"lpad(CAST({k} % 10000 AS VARCHAR), 4, '0'))"
    )


def raw_code(k: str) -> str:
    lab = f"lpad(CAST(({k} // 10000) % 100000 AS VARCHAR), 5, '0')"
    prod = f"lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')"
    return f"""(CASE {k} % 8
      WHEN 0 THEN {lab}[2:5] || '-' || {prod} || '-01'
      WHEN 1 THEN lpad(CAST(({k} // 1000) % 100000 AS VARCHAR), 5, '0') || '-'
                  || lpad(CAST({k} % 1000 AS VARCHAR), 3, '0') || '-01'
      WHEN 2 THEN {lab} || '-' || {prod} || '-1'
      WHEN 3 THEN '  ' || {lab} || '-' || {prod} || '-01 '
      WHEN 4 THEN {lab} || {prod} || '01'
      WHEN 5 THEN {lab} || {prod} || '1'
      WHEN 6 THEN lpad(CAST({k} AS VARCHAR), 9, '0')
      ELSE 'UNK' || lpad(CAST({k} AS VARCHAR), 9, '0') END)"""


def normalized(x: str) -> str:
    t = f"replace(trim({x}, ' ' || chr(9) || chr(10) || chr(13)), ' ', '')"

    def part(i: int, n: int) -> str:
        p = f"split_part({t}, '-', {i})"
        return f"(CASE WHEN length({p}) < {n} THEN lpad({p}, {n}, '0') ELSE {p} END)"

    return f"""(CASE
      WHEN {t} LIKE '%-%' THEN CASE WHEN len(string_split({t}, '-')) = 3
        THEN {part(1, 5)} || {part(2, 4)} || {part(3, 2)} END
      WHEN regexp_full_match({t}, '[0-9]{{11}}') THEN {t}
      WHEN regexp_full_match({t}, '[0-9]{{10}}') THEN {t}[1:9] || '0' || {t}[10:10]
      WHEN regexp_full_match({t}, '[0-9]{{1,9}}') THEN lpad({t}, 11, '0') END)"""


# --- inputs ------------------------------------------------------------------------------

KIND = "(l_partkey + l_linenumber // 7) % 5"
ORDER_FLAGS = [
    f"CASE WHEN (o_orderkey + {i}) % 13 = 0 THEN NULL "
    f"WHEN ((o_custkey * 37 + o_orderkey * 5) >> {i}) % 2 = 0 THEN '1' ELSE '2' END AS {name}"
    for i, name in enumerate(CONDITION_FLAGS)
]
PATIENT_TIES = ", ".join(
    f"{c} ASC NULLS FIRST" for c in PATIENT_COLUMNS
)

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (list(needs), body)


def sql(body: str, *needs: str) -> str:
    """A statement with the WITH list it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][0]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body


cte(
    "part_codes",
    f"""SELECT p_partkey AS k, {raw_code("p_partkey")} AS raw,
               {normalized(raw_code("p_partkey"))} AS ndc FROM part""",
)
cte(
    "raw_product",
    f"""SELECT CASE WHEN p_size = 1 THEN 'X' ELSE '' END || {product_code("p_partkey")} AS product_ndc,
      p_name AS brand_name, CASE WHEN p_size < 50 THEN p_type END AS generic_name,
      p_brand AS labeler_name,
      CASE p_size % 3 WHEN 0 THEN 'TABLET' WHEN 1 THEN 'CAPSULE' END AS dosage_form,
      CASE WHEN p_size % 2 = 0 THEN 'ORAL' ELSE 'TOPICAL' END AS route,
      upper(p_type) AS active_ingredients, CAST(p_size AS VARCHAR) AS strength,
      'mg' AS strength_unit, CAST(NULL AS VARCHAR) AS pharm_classes,
      CASE WHEN p_size > 45 THEN 'CII' END AS dea_schedule,
      'HUMAN PRESCRIPTION DRUG' AS product_type
    FROM part""",
)
cte(
    "raw_package",
    f"""SELECT {product_code("p_partkey")} AS product_ndc,
      {product_code("p_partkey")} || CASE WHEN p_size > 40 THEN '-99' ELSE '-01' END AS code,
      'pack of ' || p_size AS package_description FROM part
    UNION ALL
    SELECT {product_code("p_partkey")},
      CASE WHEN p_size > 40 THEN ' ' || {product_code("p_partkey")} || '-99'
           ELSE {raw_code("p_partkey")} END,
      'pack of ' || p_size FROM part""",
)
DIM_COLUMNS = (
    "product_ndc ndc_package_code_raw brand_name generic_name labeler_name dosage_form route "
    "active_ingredients strength strength_unit pharm_classes dea_schedule product_type "
    "package_description"
).split()
cte(
    "dim_drug",
    f"""SELECT * EXCLUDE (r) FROM (
      SELECT *, row_number() OVER (PARTITION BY ndc
               ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in DIM_COLUMNS)}) AS r
      FROM (SELECT {normalized("k.code")} AS ndc, k.code AS ndc_package_code_raw,
              k.package_description, k.product_ndc, p.* EXCLUDE (product_ndc)
            FROM raw_package k LEFT JOIN raw_product p ON k.product_ndc = p.product_ndc)
      WHERE ndc IS NOT NULL) WHERE r = 1""",
    "raw_product",
    "raw_package",
)
cte(
    "all_prices",
    f"""SELECT c.ndc, c.raw AS ndc_raw, 'part ' || l_partkey AS ndc_description,
      CASE WHEN l_orderkey % 71 <> 0 THEN
        ((CAST(round(l_extendedprice * 100) AS BIGINT) * 1000) // CAST(l_quantity AS BIGINT))
        / 100000.0::DOUBLE END AS nadac_per_unit,
      CASE WHEN l_orderkey % 101 <> 0 THEN CAST(l_shipdate AS DATE) - 14 END AS effective_date,
      CASE WHEN l_linenumber % 2 = 0 THEN 'EA' ELSE 'ML' END AS pricing_unit,
      CASE WHEN l_linenumber < 7 THEN l_returnflag END AS pharmacy_type,
      CASE WHEN l_tax > 0.04::DOUBLE THEN 'Y' ELSE 'N' END AS otc_flag,
      CAST(l_linenumber AS VARCHAR) AS explanation_code,
      CASE {KIND} WHEN 0 THEN 'B' WHEN 1 THEN 'G' WHEN 2 THEN 'G' WHEN 3 THEN 'B-BIO' END
        AS rate_classification,
      CASE WHEN {KIND} = 0 THEN l_discount END AS generic_nadac_per_unit,
      CASE WHEN {KIND} = 0 THEN CAST(l_shipdate AS DATE) - 14 END AS generic_effective_date
    FROM lineitem JOIN part_codes c ON c.k = l_partkey""",
    "part_codes",
)
cte("pricing", "SELECT * EXCLUDE (ndc_raw) FROM all_prices WHERE ndc IS NOT NULL", "all_prices")
cte(
    "fills",
    """SELECT *, total_rx_cost - patient_pay_amount AS payer_paid_amount,
      CAST(year(service_date) AS INTEGER) AS service_year,
      CAST(month(service_date) AS INTEGER) AS service_month
    FROM (SELECT CAST(o_custkey AS VARCHAR) AS beneficiary_id,
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  strftime(l_shipdate, '%Y%m%d')) AS pde_id,
        CASE WHEN l_orderkey % 101 <> 0 THEN CAST(l_shipdate AS DATE) END AS service_date,
        c.ndc, c.raw AS ndc_raw, l_quantity AS quantity_dispensed,
        CASE WHEN l_orderkey % 53 <> 0 THEN CAST(30 * (1 + l_linenumber % 3) AS INTEGER) END
          AS days_supply,
        CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
          AS DOUBLE) AS patient_pay_amount,
        CASE WHEN l_orderkey % 67 <> 0
          THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS total_rx_cost
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part_codes c ON c.k = l_partkey)""",
    "part_codes",
)
cte(
    "raw_patients",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS DESYNPUF_ID,
      (o_custkey % 60 + 1920) || '0615' AS BENE_BIRTH_DT,
      CASE WHEN o_custkey % 11 = 0 THEN strftime(o_orderdate, '%Y%m%d') END AS BENE_DEATH_DT,
      CAST(o_custkey % 3 AS VARCHAR) AS BENE_SEX_IDENT_CD,
      CAST(o_custkey % 5 + 1 AS VARCHAR) AS BENE_RACE_CD,
      CASE WHEN o_custkey % 10 = 0 THEN 'A' || (c_nationkey % 10)
           WHEN o_custkey % 17 = 0 THEN '99' ELSE CAST(c_nationkey AS VARCHAR) END AS SP_STATE_CODE,
      CAST(o_orderkey % 300 AS VARCHAR) AS BENE_COUNTY_CD,
      CAST(o_orderkey % 13 AS VARCHAR) AS BENE_HI_CVRAGE_TOT_MONS,
      CAST(o_custkey % 13 AS VARCHAR) AS BENE_SMI_CVRAGE_TOT_MONS,
      CASE WHEN o_orderkey % 13 < 12 THEN CAST(o_orderkey % 12 AS VARCHAR) END AS PLAN_CVRG_MOS_NUM,
      {", ".join(ORDER_FLAGS)},
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS MEDREIMB_IP,
      CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 5000 AS VARCHAR) END AS MEDREIMB_OP,
      CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 3000 AS VARCHAR) END AS MEDREIMB_CAR,
      CAST(o_orderkey % 1100 AS VARCHAR) AS BENRES_IP,
      CAST(o_orderkey % 700 AS VARCHAR) AS BENRES_OP,
      CAST(o_orderkey % 500 AS VARCHAR) AS BENRES_CAR,
      CAST(year(o_orderdate) AS VARCHAR) AS _source_year
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
COUNT = " + ".join(CONDITION_FLAGS.values())
cte(
    "patients",
    f"""SELECT *, CAST({COUNT} AS INTEGER) AS chronic_condition_count,
      CASE WHEN death_date IS NULL THEN 0 ELSE 1 END AS is_deceased
    FROM (SELECT DESYNPUF_ID AS beneficiary_id,
      CAST(try_strptime(BENE_BIRTH_DT, '%Y%m%d') AS DATE) AS birth_date,
      CAST(try_strptime(BENE_DEATH_DT, '%Y%m%d') AS DATE) AS death_date,
      CASE BENE_SEX_IDENT_CD WHEN '1' THEN 'Male' WHEN '2' THEN 'Female' ELSE 'Unknown' END AS sex,
      CAST(BENE_RACE_CD AS INTEGER) AS race_code, lpad(SP_STATE_CODE, 2, '0') AS state_code,
      CAST(BENE_COUNTY_CD AS INTEGER) AS county_code,
      CAST(BENE_HI_CVRAGE_TOT_MONS AS INTEGER) AS part_a_coverage_months,
      CAST(BENE_SMI_CVRAGE_TOT_MONS AS INTEGER) AS part_b_coverage_months,
      CAST(PLAN_CVRG_MOS_NUM AS INTEGER) AS part_d_coverage_months,
      {", ".join(f"CASE WHEN {a} = '1' THEN 1 ELSE 0 END AS {b}" for a, b in CONDITION_FLAGS.items())},
      CAST(MEDREIMB_IP AS DOUBLE) AS inpatient_reimbursement,
      CAST(MEDREIMB_OP AS DOUBLE) AS outpatient_reimbursement,
      CAST(MEDREIMB_CAR AS DOUBLE) AS carrier_reimbursement,
      CAST(BENRES_IP AS DOUBLE) AS inpatient_beneficiary_resp,
      CAST(BENRES_OP AS DOUBLE) AS outpatient_beneficiary_resp,
      CAST(BENRES_CAR AS DOUBLE) AS carrier_beneficiary_resp,
      CAST(_source_year AS INTEGER) AS record_year
      FROM (SELECT *, row_number() OVER (PARTITION BY DESYNPUF_ID
              ORDER BY _source_year DESC NULLS LAST, {PATIENT_TIES}) AS r FROM raw_patients)
      WHERE r = 1)""",
    "raw_patients",
)


def claims(status: str, columns: str) -> str:
    return f"""SELECT CAST(o_custkey AS VARCHAR) AS beneficiary_id,
      CAST(o_orderkey AS VARCHAR) AS claim_id, CAST(o_orderdate AS DATE) AS claim_start_date,
      CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS claim_end_date,
      'P' || (o_orderkey % 100) AS provider_id,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS claim_payment_amount,
      {columns}, CAST(year(o_orderdate) AS INTEGER) AS service_year
    FROM orders WHERE o_orderstatus = '{status}'"""


cte(
    "inpatient",
    claims(
        "F",
        """CAST(o_orderkey % 90 AS DOUBLE) AS primary_payer_paid,
      CAST(o_orderdate AS DATE) AS admission_date,
      CASE WHEN o_orderkey % 19 > 0
        THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) END AS discharge_date,
      CAST(o_orderkey % 15 AS INTEGER) AS utilization_days,
      CAST(o_orderkey % 500 AS VARCHAR) AS drg_code, o_orderpriority[1:1] AS admitting_diagnosis,
      CASE WHEN o_orderkey % 4 = 0 THEN 1024.0::DOUBLE END AS deductible_amount,
      0.0::DOUBLE AS coinsurance_amount, o_orderpriority[1:1] AS diag_1,
      CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority[1:1] END AS diag_2,
      CAST(NULL AS VARCHAR) AS diag_3,
      CASE WHEN o_orderkey % 19 > 0 THEN CAST(o_orderkey % 15 AS INTEGER) END AS length_of_stay""",
    ),
)
cte(
    "outpatient",
    claims(
        "O",
        """CAST(o_orderkey % 90 AS DOUBLE) AS primary_payer_paid,
      CASE WHEN o_orderkey % 4 = 0 THEN 100.0::DOUBLE END AS deductible_amount,
      0.0::DOUBLE AS blood_deductible, o_orderpriority[1:1] AS diag_1,
      CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority[1:1] END AS diag_2,
      CAST(NULL AS VARCHAR) AS diag_3, CAST(o_orderkey % 9000 AS VARCHAR) AS hcpcs_1""",
    ),
)
cte(
    "carrier",
    claims(
        "P",
        """CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS primary_payer_paid,
      CAST(o_orderkey % 77 AS VARCHAR) AS provider_tax_id,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS line_1_payment,
      CAST(o_orderkey % 90 AS DOUBLE) AS line_1_deductible,
      CASE WHEN o_orderkey % 4 = 0 THEN 100.0::DOUBLE END AS line_1_allowed_amount,
      CAST(o_orderkey % 90 AS DOUBLE) AS line_1_coinsurance,
      CAST(o_orderkey % 9000 AS VARCHAR) AS hcpcs_1, o_orderpriority[1:1] AS line_1_diagnosis""",
    ),
)

# --- gold --------------------------------------------------------------------------------

cte(
    "latest_price",
    """SELECT ndc, nadac_per_unit, pricing_unit, pharmacy_type, rate_classification,
      effective_date AS nadac_effective_date
    FROM pricing QUALIFY row_number() OVER (PARTITION BY ndc
      ORDER BY effective_date DESC NULLS LAST, nadac_per_unit ASC NULLS FIRST,
        pricing_unit ASC NULLS FIRST, pharmacy_type ASC NULLS FIRST,
        rate_classification ASC NULLS FIRST) = 1""",
    "pricing",
)
cte(
    "claims_by_drug",
    f"""SELECT ndc, count(*) AS total_claims, count(DISTINCT beneficiary_id) AS unique_patients,
      {esum("total_rx_cost")} AS total_gross_cost, {esum("patient_pay_amount")} AS total_patient_pay,
      {esum("payer_paid_amount")} AS total_payer_paid, {eavg("total_rx_cost")} AS avg_claim_cost,
      {eavg("patient_pay_amount")} AS avg_patient_pay,
      {eavg("quantity_dispensed", 3)} AS avg_quantity, {iavg("days_supply")} AS avg_days_supply
    FROM fills GROUP BY ndc""",
    "fills",
)
cte(
    "journey",
    f"""SELECT c.ndc, brand_name, generic_name, labeler_name, dosage_form, route, product_type,
      rate_classification, total_claims, unique_patients, nadac_per_unit,
      CASE WHEN avg_quantity > 0 THEN avg_claim_cost / avg_quantity END AS cost_per_unit_on_claim,
      CASE WHEN avg_quantity > 0 THEN avg_claim_cost / avg_quantity END - nadac_per_unit
        AS acquisition_to_claim_spread,
      avg_claim_cost, avg_patient_pay,
      CASE WHEN total_gross_cost > 0
        THEN {rnd("total_patient_pay / total_gross_cost * 100", 1)} END AS patient_cost_share_pct,
      total_gross_cost, total_patient_pay, total_payer_paid, avg_days_supply
    FROM claims_by_drug c LEFT JOIN dim_drug d ON c.ndc = d.ndc
      LEFT JOIN latest_price p ON c.ndc = p.ndc""",
    "claims_by_drug",
    "dim_drug",
    "latest_price",
)
cte(
    "fill_summary",
    f"""SELECT beneficiary_id, count(*) AS total_rx_fills, count(DISTINCT ndc) AS unique_drugs,
      {esum("total_rx_cost")} AS total_rx_spend, {esum("patient_pay_amount")} AS total_patient_pay,
      {esum("payer_paid_amount")} AS total_payer_paid, {iavg("days_supply")} AS avg_days_supply,
      CAST(sum(days_supply) AS BIGINT) AS total_days_supply,
      min(service_date) AS first_fill_date, max(service_date) AS last_fill_date,
      count(DISTINCT service_year) AS active_years
    FROM fills GROUP BY beneficiary_id""",
    "fills",
)
cte(
    "utilization",
    f"""SELECT *, CASE WHEN total_rx_spend + total_medical_spend > 0 THEN
        {rnd("total_rx_spend / (total_rx_spend + total_medical_spend) * 100", 1)} END
        AS rx_share_of_total_spend
    FROM (SELECT s.beneficiary_id, sex, race_code, state_code, chronic_condition_count, cc_diabetes,
      cc_heart_failure, cc_copd, cc_depression, cc_cancer, is_deceased, total_rx_fills,
      unique_drugs, total_rx_spend, total_patient_pay, avg_days_supply, total_days_supply,
      CAST(last_fill_date - first_fill_date AS INTEGER) AS observation_days,
      CASE WHEN last_fill_date - first_fill_date > 0 THEN
        {rnd("total_days_supply::DOUBLE / (last_fill_date - first_fill_date)", 2)} END
        AS days_supply_coverage_ratio,
      first_fill_date, last_fill_date, active_years, inpatient_reimbursement,
      outpatient_reimbursement, carrier_reimbursement,
      coalesce(inpatient_reimbursement, 0) + coalesce(outpatient_reimbursement, 0)
        + coalesce(carrier_reimbursement, 0) AS total_medical_spend
      FROM fill_summary s JOIN patients p ON s.beneficiary_id = p.beneficiary_id)""",
    "fill_summary",
    "patients",
)
cte(
    "monthly_prices",
    f"""SELECT *, max_nadac_per_unit - min_nadac_per_unit AS monthly_price_range
    FROM (SELECT ndc, CAST(year(effective_date) AS INTEGER) AS year,
      CAST(month(effective_date) AS INTEGER) AS month,
      {eavg("nadac_per_unit", 6)} AS avg_nadac_per_unit, min(nadac_per_unit) AS min_nadac_per_unit,
      max(nadac_per_unit) AS max_nadac_per_unit, count(*) AS price_observations,
      min(rate_classification) AS rate_classification
      FROM pricing WHERE effective_date IS NOT NULL GROUP BY ALL)""",
    "pricing",
)
cte(
    "monthly_claims",
    f"""SELECT *, CASE WHEN total_units > 0 THEN avg_claim_cost / (total_units / claim_count) END
        AS avg_cost_per_unit
    FROM (SELECT ndc, service_year AS year, service_month AS month, count(*) AS claim_count,
      {eavg("total_rx_cost")} AS avg_claim_cost, {eavg("patient_pay_amount")} AS avg_patient_pay,
      {esum("quantity_dispensed", 3)} AS total_units
      FROM fills WHERE service_date IS NOT NULL GROUP BY ALL)""",
    "fills",
)
cte(
    "spread",
    f"""SELECT m.*, brand_name, generic_name FROM (
      SELECT coalesce(p.ndc, c.ndc) AS ndc, coalesce(p.year, c.year) AS year,
        coalesce(p.month, c.month) AS month, avg_nadac_per_unit, rate_classification,
        monthly_price_range, claim_count, avg_claim_cost, avg_patient_pay,
        avg_cost_per_unit AS avg_claim_cost_per_unit,
        {rnd("avg_cost_per_unit - avg_nadac_per_unit", 4)} AS spread
      FROM monthly_prices p FULL JOIN monthly_claims c
        ON p.ndc = c.ndc AND p.year = c.year AND p.month = c.month) m
    LEFT JOIN dim_drug d ON m.ndc = d.ndc""",
    "monthly_prices",
    "monthly_claims",
    "dim_drug",
)
cte(
    "ip_util",
    f"""SELECT beneficiary_id, count(*) AS inpatient_claims,
      {esum("claim_payment_amount")} AS inpatient_total_paid,
      {iavg("length_of_stay")} AS avg_length_of_stay,
      CAST(sum(utilization_days) AS BIGINT) AS total_inpatient_days
    FROM inpatient GROUP BY beneficiary_id""",
    "inpatient",
)
cte(
    "op_util",
    f"""SELECT beneficiary_id, count(*) AS outpatient_claims,
      {esum("claim_payment_amount")} AS outpatient_total_paid
    FROM outpatient GROUP BY beneficiary_id""",
    "outpatient",
)
cte(
    "tiers",
    """SELECT *, CASE WHEN total_rx_spend >=
        (SELECT quantile_disc(total_rx_spend, 0.9) FROM utilization)
      THEN 'high_cost_top_10pct' ELSE 'standard' END AS spend_tier FROM utilization""",
    "utilization",
)
cte(
    "cohort",
    """SELECT t.beneficiary_id, spend_tier, sex, chronic_condition_count, total_rx_fills,
      unique_drugs, total_rx_spend, total_patient_pay, days_supply_coverage_ratio,
      total_medical_spend, rx_share_of_total_spend,
      coalesce(inpatient_claims, 0) AS inpatient_claims,
      coalesce(inpatient_total_paid, 0.0::DOUBLE) AS inpatient_total_paid,
      coalesce(avg_length_of_stay, 0.0::DOUBLE) AS avg_length_of_stay,
      coalesce(outpatient_claims, 0) AS outpatient_claims,
      coalesce(outpatient_total_paid, 0.0::DOUBLE) AS outpatient_total_paid,
      total_rx_spend + total_medical_spend AS total_all_spend
    FROM tiers t LEFT JOIN ip_util i ON t.beneficiary_id = i.beneficiary_id
      LEFT JOIN op_util o ON t.beneficiary_id = o.beneficiary_id""",
    "tiers",
    "ip_util",
    "op_util",
)

# --- refills and prices ------------------------------------------------------------------

cte(
    "sequences",
    """SELECT *, CASE WHEN days_between_fills <= prev_days_supply * 1.5 THEN 1 ELSE 0 END
        AS refilled_on_time
    FROM (SELECT *, CAST(service_date - prev_fill_date AS INTEGER) AS days_between_fills
      FROM (SELECT *, lag(service_date) OVER w AS prev_fill_date,
          lag(days_supply) OVER w AS prev_days_supply, row_number() OVER w AS fill_number
        FROM fills WHERE days_supply > 0
        WINDOW w AS (PARTITION BY beneficiary_id, ndc
          ORDER BY service_date ASC NULLS FIRST, days_supply, pde_id))
      WHERE fill_number > 1)""",
    "fills",
)
cte(
    "refill_stats",
    """SELECT *, on_time_refills::DOUBLE / total_refill_opportunities AS historical_refill_rate
    FROM (SELECT beneficiary_id, count(*) AS total_refill_opportunities,
      CAST(sum(refilled_on_time) AS BIGINT) AS on_time_refills,
      avg(days_between_fills) AS avg_gap_days, avg(days_supply) AS avg_days_supply
      FROM sequences GROUP BY beneficiary_id)""",
    "sequences",
)
cte(
    "price_features",
    f"""SELECT *, CASE WHEN mean_price > 0 THEN price_stddev / mean_price END
        AS coefficient_of_variation,
      CASE WHEN mean_price > 0 THEN price_range / mean_price END AS range_to_mean_ratio
    FROM (SELECT ndc, count(*) AS price_observations, {eavg("nadac_per_unit", 6)} AS mean_price,
      stddev_samp(nadac_per_unit) AS price_stddev, min(nadac_per_unit) AS min_price,
      max(nadac_per_unit) AS max_price, quantile_disc(nadac_per_unit, 0.5) AS median_price,
      max(nadac_per_unit) - min(nadac_per_unit) AS price_range
      FROM pricing WHERE nadac_per_unit > 0 GROUP BY ndc HAVING count(*) >= 4)""",
    "pricing",
)
cte(
    "anomaly_features",
    """SELECT f.*, latest_price, latest_date, rate_classification,
      (latest_price - mean_price) / nullif(mean_price, 0) AS latest_deviation,
      (latest_price - mean_price) / nullif(price_stddev, 0) AS latest_z_score
    FROM price_features f JOIN (
      SELECT ndc, nadac_per_unit AS latest_price, effective_date AS latest_date,
        rate_classification
      FROM pricing WHERE nadac_per_unit IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY ndc ORDER BY effective_date DESC NULLS LAST,
        nadac_per_unit ASC NULLS FIRST, rate_classification ASC NULLS FIRST) = 1) l
    ON f.ndc = l.ndc""",
    "price_features",
)
cte(
    "z_anomalies",
    f"""SELECT a.ndc, substr(coalesce(generic_name, brand_name, 'Unknown'), 1, 28) AS drug_name,
      {rnd("latest_z_score", 6)} AS latest_z_score,
      CASE WHEN latest_z_score > 0 THEN 'PRICE UP' ELSE 'PRICE DOWN' END AS direction,
      price_observations, abs(latest_z_score) AS far
    FROM anomaly_features a LEFT JOIN dim_drug d ON a.ndc = d.ndc
    WHERE mean_price IS NOT NULL AND price_stddev IS NOT NULL
      AND coefficient_of_variation IS NOT NULL AND range_to_mean_ratio IS NOT NULL
      AND latest_deviation IS NOT NULL AND abs(latest_z_score) > 2 AND price_observations >= 8""",
    "anomaly_features",
    "dim_drug",
)
# The isolation forest: 100 trees of 256 rows, grown and walked level by level. The root of a tree is
# node 1, the children of node k are 2 k and 2 k + 1.
cte(
    "iso_values",
    """SELECT ndc, i, CAST(CAST(v AS FLOAT) AS DOUBLE) AS v FROM (
      SELECT ndc, unnest([0, 1, 2, 3, 4]) AS i, unnest([mean_price, price_stddev,
        coefficient_of_variation, range_to_mean_ratio, latest_deviation]) AS v FROM anomaly_features
      WHERE mean_price + price_stddev + coefficient_of_variation + range_to_mean_ratio
        + latest_deviation IS NOT NULL)""",
    "anomaly_features",
)
cte(
    "iso_size",
    """SELECT n, least(n, 256) AS m, ceil(log2(greatest(least(n, 256), 2))) AS levels
    FROM (SELECT count(DISTINCT ndc) AS n FROM iso_values)""",
    "iso_values",
)
cte(
    "iso_0",
    """SELECT tree, ndc, 1 AS node, row_number() OVER (PARTITION BY tree
        ORDER BY (slope * number + start) % 2147483647, ndc) <= 256 AS drawn
    FROM (SELECT DISTINCT ndc, ('0x' || substr(md5('42:' || ndc), 1, 12))::BIGINT % 2147483647 AS number
      FROM iso_values),
      (SELECT range AS tree, 1 + ('0x' || substr(md5('42:' || range), 1, 8))::BIGINT % 2147483646 AS slope,
        ('0x' || substr(md5('42:' || range), 9, 8))::BIGINT % 2147483647 AS start FROM range(100))""",
    "iso_values",
)
for level in range(8):
    cte(
        f"iso_splits_{level}",
        f"""SELECT tree, node, i, low + (('0x' || substr(digest, 1, 6))::BIGINT + 0.5::DOUBLE) / 16777216
            * (high - low) AS split
        FROM (SELECT *, md5('42:' || tree || ':' || node) AS digest, count(*) OVER w AS varied,
            row_number() OVER (w ORDER BY i) - 1 AS place
          FROM (SELECT tree, node, i, min(v) AS low, max(v) AS high
            FROM iso_{level} JOIN iso_values USING (ndc) WHERE drawn
            GROUP BY tree, node, i HAVING min(v) < max(v)) WINDOW w AS (PARTITION BY tree, node))
        WHERE place = ('0x' || substr(digest, 7, 6))::BIGINT % varied
          AND {level} < (SELECT levels FROM iso_size)""",
        f"iso_{level}",
        "iso_values",
        "iso_size",
    )
    cte(
        f"iso_{level + 1}",
        f"""SELECT r.tree, r.ndc, r.drawn,
          CASE WHEN s.i IS NULL THEN r.node WHEN v.v > s.split THEN 2 * r.node + 1 ELSE 2 * r.node END AS node
        FROM iso_{level} r LEFT JOIN iso_splits_{level} s ON r.tree = s.tree AND r.node = s.node
          LEFT JOIN iso_values v ON v.ndc = r.ndc AND v.i = s.i""",
        f"iso_{level}",
        f"iso_splits_{level}",
    )
cte(
    "iso_paths",
    """SELECT ndc, CAST(sum(path) AS DOUBLE) AS path FROM iso_8 JOIN (
      SELECT tree, node, CAST(round((length(bin(node)) - 1 + CASE WHEN k = 1 THEN 0 WHEN k = 2 THEN 1
          ELSE 2 * (ln(k - 1) + 0.57721566490153286::DOUBLE) - 2 * (k - 1)::DOUBLE / k END) * 1e9) AS BIGINT) AS path
      FROM (SELECT tree, node, count(*) AS k FROM iso_8 WHERE drawn GROUP BY tree, node)) USING (tree, node)
    GROUP BY ndc""",
    "iso_8",
)
cte(
    "iso_scores",
    """SELECT *, row_number() OVER (ORDER BY path, ndc) AS r FROM (
      SELECT ndc, path, n, -pow(2.0::DOUBLE, -(path / 1e9 / 100) / CASE WHEN m > 2
        THEN 2 * (ln(m - 1) + 0.57721566490153286::DOUBLE) - 2 * (m - 1)::DOUBLE / m ELSE 1 END) AS score
      FROM iso_paths, iso_size)""",
    "iso_paths",
    "iso_size",
)
cte(
    "forest",
    """SELECT a.*, raw AS anomaly_raw_score, CASE WHEN raw < 0 THEN 1 ELSE 0 END AS is_anomaly,
      CASE WHEN raw < 0 THEN -1 ELSE 1 END AS anomaly_score
    FROM (SELECT ndc, score - (lo + (hi - lo) * (place - floor(place))) AS raw FROM iso_scores,
        (SELECT max(score) FILTER (r = floor(place) + 1) AS lo,
          max(score) FILTER (r = least(floor(place) + 2, n)) AS hi, any_value(place) AS place
        FROM (SELECT *, 0.05::DOUBLE * (n - 1) AS place FROM iso_scores)))
      JOIN anomaly_features a USING (ndc)""",
    "iso_scores",
    "anomaly_features",
)
FEATURES = [
    "chronic_condition_count", "cc_diabetes", "cc_heart_failure", "cc_copd", "cc_depression",
    "cc_cancer", "unique_drugs", "total_rx_fills", "total_rx_spend", "total_patient_pay",
    "avg_days_supply", "refill_avg_days_supply", "total_medical_spend", "rx_share_of_total_spend",
]
cte(
    "training",
    f"""SELECT * FROM (SELECT u.beneficiary_id, chronic_condition_count, cc_diabetes,
      cc_heart_failure, cc_copd, cc_depression, cc_cancer, unique_drugs, total_rx_fills,
      total_rx_spend, total_patient_pay, u.avg_days_supply,
      r.avg_days_supply AS refill_avg_days_supply, total_medical_spend, rx_share_of_total_spend,
      CASE WHEN historical_refill_rate < 0.6 THEN 1 ELSE 0 END AS low_adherence
      FROM utilization u JOIN refill_stats r ON u.beneficiary_id = r.beneficiary_id)
    WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)}""",
    "utilization",
    "refill_stats",
)


def report(table: str, columns: list[str], limit_pct: int = 50) -> str:
    """Quality report: one branch per column."""
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, "
        f"{rnd(f'count(*) FILTER ({c} IS NULL)::DOUBLE / count(*) * 100', 4)} AS null_pct, "
        f"count(DISTINCT CAST({c} AS VARCHAR)) "
        f"+ CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_values, "
        f"CASE WHEN count(*) FILTER ({c} IS NULL)::DOUBLE / count(*) * 100 > {limit_pct} "
        f"THEN 1 ELSE 0 END AS flag FROM {table}"
        for c in columns
    )


PRICING_COLUMNS = (
    "ndc ndc_description nadac_per_unit effective_date pricing_unit pharmacy_type otc_flag "
    "explanation_code rate_classification generic_nadac_per_unit generic_effective_date"
).split()
FILL_COLUMNS = (
    "beneficiary_id pde_id service_date ndc ndc_raw quantity_dispensed days_supply "
    "patient_pay_amount total_rx_cost payer_paid_amount service_year service_month"
).split()
PARTD = "(SELECT DISTINCT p_name, p_type FROM part JOIN lineitem ON p_partkey = l_partkey)"
CLAIM_COLUMNS = (
    "beneficiary_id claim_id claim_start_date claim_end_date provider_id claim_payment_amount "
    "primary_payer_paid service_year diag_1 diag_2 diag_3"
).split()
OTHER_COLUMNS = {
    "patients": (
        "beneficiary_id birth_date death_date sex race_code state_code county_code "
        "part_a_coverage_months part_b_coverage_months part_d_coverage_months "
        "inpatient_reimbursement outpatient_reimbursement carrier_reimbursement "
        "inpatient_beneficiary_resp outpatient_beneficiary_resp carrier_beneficiary_resp "
        "record_year chronic_condition_count is_deceased"
    ).split() + list(CONDITION_FLAGS.values()),
    "inpatient": CLAIM_COLUMNS + (
        "admission_date discharge_date utilization_days drg_code admitting_diagnosis "
        "deductible_amount coinsurance_amount length_of_stay"
    ).split(),
    "outpatient": CLAIM_COLUMNS + "deductible_amount blood_deductible hcpcs_1".split(),
    "carrier": CLAIM_COLUMNS[:8] + (
        "provider_tax_id line_1_payment line_1_deductible line_1_allowed_amount "
        "line_1_coinsurance hcpcs_1 line_1_diagnosis"
    ).split(),
}
LAYERS = {
    "dim_beneficiary": "patients",
    "dim_drug": "dim_drug",
    "fact_carrier_claims": "carrier",
    "fact_drug_pricing": "pricing",
    "fact_inpatient_claims": "inpatient",
    "fact_outpatient_claims": "outpatient",
    "fact_prescription_events": "fills",
}
GOLD = {
    "beneficiary_drug_utilization": "utilization",
    "drug_cost_journey": "journey",
    "drug_cost_spread_analysis": "spread",
    "high_cost_drug_cohort": "cohort",
}


def inventory(tables: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {t}"
        for name, t in tables.items()
    )


def coverage(raw_table: str) -> str:
    return f"""SELECT total, matched, {rnd("matched::DOUBLE / total * 100", 4)} AS pct,
      total - matched AS unmatched
    FROM (SELECT count(*) AS total, count(d.ndc) AS matched
      FROM (SELECT DISTINCT ndc_raw, ndc FROM {raw_table}) c LEFT JOIN dim_drug d
        ON c.ndc = d.ndc)"""


def condition(flag: str, name: str) -> str:
    ratio = "days_supply_coverage_ratio"
    return f"""SELECT '{name}' AS condition, a AS with_condition, b AS without_condition, n AS n_with,
      a - b AS delta FROM (SELECT
        coalesce({eavg(f"CASE WHEN {flag} = 1 THEN {ratio} END")}, 0) AS a,
        coalesce({eavg(f"CASE WHEN {flag} = 0 THEN {ratio} END")}, 0) AS b,
        count(*) FILTER ({flag} = 1) AS n FROM utilization WHERE {ratio} IS NOT NULL)"""


def comparable(table: str, dates: str = "", ints: str = "") -> str:
    """Dates as text and nullable whole numbers as doubles."""
    columns = [f"{day(d)} AS {d}" for d in dates.split()]
    columns += [f"CAST({i} AS DOUBLE) AS {i}" for i in ints.split()]
    return f"SELECT * REPLACE ({', '.join(columns)}) FROM {table}"


STATES = ", ".join(
    f"('{code}', {'NULL' if fips is None else repr(fips)})" for code, fips in STATE_CODES.items()
)
CONDITIONS = {
    "cc_diabetes": "Diabetes",
    "cc_heart_failure": "Heart Failure",
    "cc_copd": "COPD",
    "cc_depression": "Depression",
    "cc_cancer": "Cancer",
}
CLAIM_DATES = "claim_start_date claim_end_date"
FILL_DATES = "first_fill_date last_fill_date"
FILL_INTS = "days_supply service_year service_month"


def oracle_sql() -> dict[str, str]:
    low = "days_supply_coverage_ratio < 0.5 AND total_rx_fills >= 3"
    return {
        # sources, functions and silver
        "scan_delimited": sql(
            """SELECT product_ndc AS PRODUCTNDC, code AS NDCPACKAGECODE,
              package_description AS PACKAGEDESCRIPTION FROM raw_package""",
            "raw_package",
        ),
        "scan_with_provenance": sql(
            "SELECT DESYNPUF_ID, SP_STATE_CODE, MEDREIMB_IP, _source_year FROM raw_patients",
            "raw_patients",
        ),
        "scan_vintages": """
            WITH spending AS (
                SELECT p_name, p_type, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spent, count(*) AS claims,
                       (length(p_name) + ascii(p_name)) % 3 + 2020 AS vintage
                FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_name, p_type
            )
            SELECT p_name AS brand_name, CASE WHEN vintage <> 2021 THEN p_type END AS generic_name,
                   CASE WHEN vintage <> 2022 THEN CAST(spent AS DOUBLE) END AS total_spending,
                   CAST(claims AS BIGINT) AS total_claims,
                   CASE WHEN vintage = 2022 THEN CAST(vintage AS VARCHAR) END AS year,
                   CAST(vintage AS VARCHAR) AS _source_year
            FROM spending""",
        "normalize_code": sql("SELECT k AS part_key, raw, ndc FROM part_codes", "part_codes"),
        "normalize_ndc_sql": sql("SELECT k AS part_key, raw, ndc FROM part_codes", "part_codes"),
        "normalize_rate": sql(
            f"""SELECT count(*) AS total, count(ndc) AS normalized,
              count(*) - count(ndc) AS failed,
              {rnd("count(ndc)::DOUBLE / count(*) * 100", 4)} AS pct
            FROM (SELECT {normalized("code")} AS ndc FROM raw_package)""",
            "raw_package",
        ),
        "build_drug_dim": sql("SELECT * FROM dim_drug", "dim_drug"),
        "build_pricing": sql(
            comparable("pricing", "effective_date generic_effective_date"), "pricing"
        ),
        "build_fills": sql(comparable("fills", "service_date", FILL_INTS), "fills"),
        "latest_patient": sql(
            comparable("patients", "birth_date death_date", "part_d_coverage_months"), "patients"
        ),
        "build_inpatient": sql(
            comparable(
                "inpatient", CLAIM_DATES + " admission_date discharge_date",
                "service_year length_of_stay",
            ),
            "inpatient",
        ),
        "build_outpatient": sql(comparable("outpatient", CLAIM_DATES, "service_year"), "outpatient"),
        "build_carrier": sql(comparable("carrier", CLAIM_DATES, "service_year"), "carrier"),
        "snake_case_columns": sql(
            f"""SELECT p_name AS brand_name, p_type AS generic_name,
              {esum("l_extendedprice")} AS total_spending, count(*) AS total_claims
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name, p_type"""
        ),
        "claims_by_year": sql(
            """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
            FROM orders WHERE o_orderstatus = 'P' GROUP BY 1"""
        ),
        # gold
        "latest_price": sql(comparable("latest_price", "nadac_effective_date"), "latest_price"),
        "claims_by_drug": sql("SELECT * FROM claims_by_drug", "claims_by_drug"),
        "drug_cost_journey": sql("SELECT * FROM journey", "journey"),
        "top_drugs_by_spend": sql(
            """SELECT * FROM journey
            ORDER BY total_gross_cost DESC NULLS LAST, ndc ASC NULLS FIRST LIMIT 15""",
            "journey",
        ),
        "cross_domain_count": sql(
            """SELECT count(*) AS n FROM journey
            WHERE nadac_per_unit IS NOT NULL AND total_claims IS NOT NULL""",
            "journey",
        ),
        "patient_fill_summary": sql(
            comparable("fill_summary", FILL_DATES, "total_days_supply"), "fill_summary"
        ),
        "patient_utilization": sql(
            comparable("utilization", FILL_DATES, "total_days_supply observation_days"),
            "utilization",
        ),
        "monthly_prices": sql("SELECT * FROM monthly_prices", "monthly_prices"),
        "monthly_claims": sql(comparable("monthly_claims", ints="claim_count"), "monthly_claims"),
        "cost_spread_monthly": sql(comparable("spread", ints="claim_count"), "spread"),
        "inpatient_util": sql("SELECT * FROM ip_util", "ip_util"),
        "outpatient_util": sql("SELECT * FROM op_util", "op_util"),
        "spend_tiers": sql(
            "SELECT beneficiary_id, total_rx_spend, spend_tier FROM tiers", "tiers"
        ),
        "high_cost_cohort": sql("SELECT * FROM cohort", "cohort"),
        # analysis
        "cohort_comparison": sql(
            f"""SELECT spend_tier, count(*) AS beneficiary_count,
              {rnd(eavg("total_rx_spend"), 2)} AS avg_rx_spend,
              {rnd(eavg("total_medical_spend"), 2)} AS avg_medical_spend,
              {rnd(eavg("total_all_spend"), 2)} AS avg_total_spend,
              {rnd(eavg("rx_share_of_total_spend"), 1)} AS avg_rx_pct,
              {rnd(iavg("chronic_condition_count"), 1)} AS avg_chronic_conditions,
              {rnd(iavg("unique_drugs"), 1)} AS avg_unique_drugs,
              {rnd(iavg("inpatient_claims"), 2)} AS avg_ip_claims,
              {rnd("avg(avg_length_of_stay)", 1)} AS avg_los,
              {rnd(iavg("outpatient_claims"), 1)} AS avg_op_claims,
              {rnd(eavg("days_supply_coverage_ratio"), 2)} AS avg_adherence_ratio
            FROM cohort GROUP BY spend_tier""",
            "cohort",
        ),
        "cohort_summary": sql(
            f"""SELECT spend_tier, count(*) AS n,
              {rnd(eavg("total_rx_spend"), 2)} AS avg_rx_spend,
              {rnd(eavg("total_medical_spend"), 2)} AS avg_medical_spend,
              {rnd(iavg("inpatient_claims"), 2)} AS avg_ip_admissions,
              {rnd(eavg("inpatient_total_paid"), 2)} AS avg_ip_cost,
              {rnd("avg(avg_length_of_stay)", 1)} AS avg_los,
              {rnd(iavg("outpatient_claims"), 1)} AS avg_op_visits,
              {rnd(eavg("outpatient_total_paid"), 2)} AS avg_op_cost,
              {rnd(iavg("chronic_condition_count"), 1)} AS avg_chronic_conditions,
              {rnd(iavg("unique_drugs"), 1)} AS avg_unique_drugs,
              {rnd(eavg("days_supply_coverage_ratio"), 2)} AS avg_adherence
            FROM cohort GROUP BY spend_tier""",
            "cohort",
        ),
        "cost_sanity": sql(
            f"""SELECT min(total_rx_cost) AS min_cost, {eavg("total_rx_cost")} AS avg_cost,
              max(total_rx_cost) AS max_cost, {eavg("patient_pay_amount")} AS avg_patient_pay,
              {eavg("payer_paid_amount")} AS avg_payer_paid,
              {iavg("days_supply")} AS avg_days_supply FROM fills""",
            "fills",
        ),
        "utilization_means": sql(
            f"""SELECT {iavg("total_rx_fills")} AS avg_fills, {iavg("unique_drugs")} AS avg_drugs,
              {eavg("total_rx_spend")} AS avg_rx_spend,
              {eavg("days_supply_coverage_ratio")} AS avg_coverage_ratio,
              {iavg("chronic_condition_count")} AS avg_chronic_conditions,
              {eavg("rx_share_of_total_spend")} AS avg_rx_pct_of_spend FROM utilization""",
            "utilization",
        ),
        "class_spread": sql(
            f"""SELECT rate_classification, count(*) AS drug_count,
              CAST(sum(total_claims) AS BIGINT) AS total_claims,
              {rnd(eavg("nadac_per_unit", 6), 4)} AS avg_nadac_per_unit,
              {rnd("avg(avg_claim_cost)", 2)} AS avg_claim_cost,
              {rnd("avg(acquisition_to_claim_spread)", 4)} AS avg_spread,
              {rnd(eavg("patient_cost_share_pct"), 1)} AS avg_patient_cost_share_pct
            FROM journey WHERE rate_classification IS NOT NULL GROUP BY rate_classification""",
            "journey",
        ),
        "thin_margin_generics": sql(
            f"""SELECT ndc, generic_name, labeler_name, total_claims, unique_patients,
              {rnd("nadac_per_unit", 4)} AS nadac_per_unit,
              {rnd("cost_per_unit_on_claim", 4)} AS cost_per_unit_on_claim,
              {rnd("spread", 4)} AS acquisition_to_claim_spread,
              {rnd("patient_cost_share_pct", 1)} AS patient_cost_share_pct
            FROM (SELECT *, acquisition_to_claim_spread AS spread FROM journey)
            WHERE rate_classification = 'G' AND spread IS NOT NULL AND total_claims >= 10
            ORDER BY spread, ndc LIMIT 25""",
            "journey",
        ),
        "adherence_by_condition": sql(
            "\nUNION ALL ".join(condition(f, n) for f, n in CONDITIONS.items()), "utilization"
        ),
        "adherence_by_burden": sql(
            f"""SELECT chronic_condition_count, count(*) AS beneficiary_count,
              {rnd(eavg("days_supply_coverage_ratio"), 3)} AS avg_adherence,
              {rnd(iavg("unique_drugs"), 1)} AS avg_drugs,
              {rnd(eavg("total_rx_spend"), 2)} AS avg_rx_spend,
              {rnd(iavg("total_rx_fills"), 1)} AS avg_fills
            FROM utilization WHERE days_supply_coverage_ratio IS NOT NULL
            GROUP BY chronic_condition_count""",
            "utilization",
        ),
        "low_adherence_cohort": sql(
            f"""SELECT a.*, total_count,
              {rnd("low_adherence_count::DOUBLE / total_count * 100", 1)} AS low_adherence_pct
            FROM (SELECT count(*) AS low_adherence_count,
                {rnd(iavg("chronic_condition_count"), 1)} AS avg_chronic_conditions,
                {rnd(iavg("unique_drugs"), 1)} AS avg_unique_drugs,
                {rnd(eavg("total_rx_spend"), 2)} AS avg_total_rx_spend,
                {rnd(eavg("total_medical_spend"), 2)} AS avg_medical_spend
              FROM utilization WHERE {low}) a,
              (SELECT count(days_supply_coverage_ratio) AS total_count FROM utilization) b""",
            "utilization",
        ),
        "price_by_pharmacy_type": sql(
            f"""SELECT pharmacy_type, count(DISTINCT ndc) AS unique_drugs,
              count(*) AS price_observations,
              {rnd(eavg("nadac_per_unit", 6), 4)} AS avg_nadac_per_unit,
              {rnd("quantile_disc(nadac_per_unit, 0.5)", 4)} AS median_nadac,
              {rnd("stddev_samp(nadac_per_unit)", 4)} AS stddev_nadac
            FROM pricing WHERE nadac_per_unit IS NOT NULL AND pharmacy_type IS NOT NULL
            GROUP BY pharmacy_type""",
            "pricing",
        ),
        "price_pivot": sql(
            "SELECT ndc, "
            + ", ".join(
                eavg(f"CASE WHEN pharmacy_type = '{t}' THEN nadac_per_unit END", 6) + f' AS "{t}"'
                for t in "ANR"
            )
            + " FROM pricing WHERE pharmacy_type IS NOT NULL GROUP BY ndc",
            "pricing",
        ),
        "pharmacy_types": sql(
            "SELECT pharmacy_type, count(*) AS n FROM pricing GROUP BY pharmacy_type", "pricing"
        ),
        "patients_by_state": sql(
            f"""SELECT state_code, count(*) AS beneficiary_count,
              {rnd(iavg("chronic_condition_count"), 1)} AS avg_chronic_conditions,
              any_value(fips) AS fips_state
            FROM patients LEFT JOIN (VALUES {STATES}) AS s(code, fips) ON state_code = code
            GROUP BY state_code""",
            "patients",
        ),
        "spend_ratio": sql(
            f"""SELECT spend_tier, {rnd("ip / rx", 3)} AS ip_cost_per_rx_dollar,
              {rnd("op / rx", 3)} AS op_cost_per_rx_dollar,
              {rnd("(ip + op) / rx", 3)} AS total_medical_per_rx_dollar
            FROM (SELECT spend_tier, {esum("total_rx_spend")} AS rx,
              {esum("inpatient_total_paid")} AS ip, {esum("outpatient_total_paid")} AS op
              FROM cohort WHERE total_rx_spend > 0 GROUP BY spend_tier)""",
            "cohort",
        ),
        "spend_quartiles": sql(
            f"""SELECT CAST(q AS INTEGER) AS rx_quartile, count(*) AS n,
              {rnd(eavg("total_rx_spend"), 2)} AS avg_rx_spend,
              {rnd(iavg("inpatient_claims"), 2)} AS avg_ip_admissions,
              {rnd(eavg("inpatient_total_paid"), 2)} AS avg_ip_cost,
              {rnd(iavg("outpatient_claims"), 1)} AS avg_op_visits,
              {rnd(iavg("chronic_condition_count"), 1)} AS avg_conditions
            FROM (SELECT *, ntile(4) OVER (ORDER BY total_rx_spend, beneficiary_id) AS q
              FROM cohort WHERE spend_tier = 'high_cost_top_10pct') GROUP BY q""",
            "cohort",
        ),
        # quality
        "silver_inventory": sql(inventory({**LAYERS, "agg_partd_spending": PARTD}), *LAYERS.values()),
        "bronze_inventory": sql(
            f"""SELECT * FROM ({inventory({
                "fda_ndc_product": "part", "nadac_pricing": "lineitem", "synpuf_beneficiary": "raw_patients",
                "synpuf_carrier": "carrier", "synpuf_inpatient": "inpatient",
                "synpuf_outpatient": "outpatient", "synpuf_pde": "fills", "fda_ndc_package": "raw_package",
                "partd_spending": PARTD,
            })})""",
            "raw_patients", "carrier", "inpatient", "outpatient", "fills", "raw_package",
        ),
        "gold_inventory": sql(inventory(GOLD), *GOLD.values()),
        "null_rates": sql(
            "SELECT column_name, null_pct, flag FROM ("
            + report("dim_drug", ["ndc", *DIM_COLUMNS], 20)
            + ")",
            "dim_drug",
        ),
        "quality_report": sql(report("fills", FILL_COLUMNS), "fills"),
        "quality_report_pricing": sql(report("pricing", PRICING_COLUMNS), "pricing"),
        **{
            f"quality_report_{t}": sql(report(t, columns), t) for t, columns in OTHER_COLUMNS.items()
        },
        "duplicate_drug_codes": sql(
            "SELECT count(*) AS duplicate_keys FROM (SELECT ndc FROM dim_drug GROUP BY ndc HAVING count(*) > 1)",
            "dim_drug",
        ),
        "layer_round_trip": sql(
            """SELECT 'copy' AS origin, CAST(service_year AS DOUBLE) AS service_year, count(*) AS fills
            FROM fills GROUP BY service_year""",
            "fills",
        ),
        "duplicate_keys": sql(
            """SELECT count(*) AS duplicate_keys FROM (SELECT l_orderkey FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
        ),
        "flag_prevalence": sql(
            "\nUNION ALL ".join(
                f"SELECT '{c}' AS flag, {rnd(f'sum({c})::DOUBLE / count(*) * 100', 4)} AS pct "
                "FROM patients"
                for c in CONDITION_FLAGS.values()
            ),
            "patients",
        ),
        "key_coverage_fills": sql(coverage("fills"), "fills", "dim_drug"),
        "key_coverage_prices": sql(coverage("all_prices"), "all_prices", "dim_drug"),
        # refills and prices
        "refill_sequences": sql(
            comparable(
                "sequences", "service_date prev_fill_date", FILL_INTS + " days_between_fills"
            ),
            "sequences",
        ),
        "refill_stats": sql("SELECT * FROM refill_stats", "refill_stats"),
        "mean_refill_rate": sql(
            f"""SELECT count(*) AS patients,
              {rnd("avg(historical_refill_rate)", 6)} AS mean_refill_rate FROM refill_stats""",
            "refill_stats",
        ),
        "price_features": sql(
            f"""SELECT * REPLACE ({rnd("price_stddev", 6)} AS price_stddev,
              {rnd("coefficient_of_variation", 6)} AS coefficient_of_variation)
            FROM price_features""",
            "price_features",
        ),
        "price_anomaly_features": sql(
            f"""SELECT * REPLACE ({rnd("price_stddev", 6)} AS price_stddev,
              {rnd("coefficient_of_variation", 6)} AS coefficient_of_variation,
              {rnd("latest_z_score", 6)} AS latest_z_score, {day("latest_date")} AS latest_date)
            FROM anomaly_features""",
            "anomaly_features",
        ),
        "z_score_anomalies": sql("SELECT * EXCLUDE (far) FROM z_anomalies", "z_anomalies"),
        "z_score_top": sql(
            "SELECT * EXCLUDE (far) FROM (SELECT * FROM z_anomalies ORDER BY far DESC, ndc LIMIT 20)",
            "z_anomalies",
        ),
        # models
        "adherence_training_set": sql("SELECT * FROM training", "training"),
        "adherence_target_rate": sql(
            f"""SELECT count(*) AS n, {rnd("avg(low_adherence)", 6)} AS low_adherence_rate
            FROM training""",
            "training",
        ),
        "stratified_split": sql(
            """SELECT beneficiary_id, low_adherence, CASE WHEN r <= floor(0.75 * n + 0.5)
                THEN 'train' ELSE 'test' END AS part
            FROM (SELECT beneficiary_id, low_adherence, count(*) OVER (PARTITION BY low_adherence) AS n,
                row_number() OVER (PARTITION BY low_adherence
                  ORDER BY substr(md5('42:' || beneficiary_id), 1, 15), beneficiary_id) AS r
              FROM training)""",
            "training",
        ),
        "lr_gradient": sql(
            "\nUNION ALL ".join(f"SELECT '{c}' AS feature, 0.0::DOUBLE AS slope FROM (SELECT count(*) FROM training)" for c in FEATURES),
            "training",
        ),
        "lr_tier_checks": sql(
            """SELECT CAST(sum(n - floor(0.75 * n + 0.5)) AS BIGINT) AS scored, CAST(0 AS BIGINT) AS odd
            FROM (SELECT count(*) AS n FROM training GROUP BY low_adherence)""",
            "training",
        ),
        "importance_sum": sql(
            f"SELECT CAST({len(FEATURES)} AS BIGINT) AS features, 1.0::DOUBLE AS total FROM (SELECT count(*) FROM training)",
            "training",
        ),
        "isolation_checks": sql(
            """SELECT count(*) AS scored, CAST(0 AS BIGINT) AS odd
            FROM anomaly_features WHERE price_stddev IS NOT NULL""",
            "anomaly_features",
        ),
        "isolation_forest": sql(
            f"""SELECT * REPLACE ({rnd("price_stddev", 6)} AS price_stddev,
              {rnd("coefficient_of_variation", 6)} AS coefficient_of_variation,
              {rnd("latest_z_score", 6)} AS latest_z_score, {day("latest_date")} AS latest_date,
              {rnd("anomaly_raw_score", 6)} AS anomaly_raw_score)
            FROM forest""",
            "forest",
        ),
        "top_anomalies": sql(
            f"""SELECT f.ndc, substr(coalesce(generic_name, brand_name, 'Unknown'), 1, 33) AS drug_name,
              mean_price, latest_price, latest_deviation,
              {rnd("coefficient_of_variation", 6)} AS coefficient_of_variation,
              {rnd("anomaly_raw_score", 6)} AS anomaly_raw_score
            FROM (SELECT * FROM forest WHERE is_anomaly = 1 ORDER BY anomaly_raw_score, ndc LIMIT 20) f
              LEFT JOIN dim_drug d ON f.ndc = d.ndc""",
            "forest",
            "dim_drug",
        ),
        "anomaly_share": sql(
            f"""SELECT CAST(k AS BIGINT) AS anomalies, {rnd("k / n * 100", 1)} AS pct
            FROM (SELECT n, CASE WHEN 0.05 * (n - 1) > floor(0.05 * (n - 1))
                THEN floor(0.05 * (n - 1)) + 1 ELSE floor(0.05 * (n - 1)) END AS k
              FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM anomaly_features
                WHERE price_stddev IS NOT NULL))""",
            "anomaly_features",
        ),
        "stratified_split_counts": sql(
            """SELECT low_adherence, 'train' AS part, CAST(floor(0.75 * count(*) + 0.5) AS BIGINT) AS n
            FROM training GROUP BY low_adherence
            UNION ALL
            SELECT low_adherence, 'test', count(*) - CAST(floor(0.75 * count(*) + 0.5) AS BIGINT)
            FROM training GROUP BY low_adherence
            HAVING count(*) > CAST(floor(0.75 * count(*) + 0.5) AS BIGINT)""",
            "training",
        ),
        "classification_metrics": sql(
            f"""SELECT class, {rnd("precision", 6)} AS precision, {rnd("recall", 6)} AS recall,
              {rnd("CASE WHEN tp = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END",
                   6)} AS f1, support
            FROM (SELECT class, tp, support, predicted, coalesce(tp::DOUBLE / nullif(predicted, 0), 0) AS precision,
                coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall
              FROM (SELECT class, count(*) FILTER (y = class AND p = class) AS tp,
                  count(*) FILTER (p = class) AS predicted, count(*) FILTER (y = class) AS support
                FROM (SELECT low_adherence AS y,
                        CASE WHEN rx_share_of_total_spend > 80 THEN 1 ELSE 0 END AS p FROM training),
                  (VALUES (0), (1)) AS c(class) GROUP BY class))
            WHERE support > 0 OR predicted > 0""",
            "training",
        ),
        "roc_auc": sql(
            f"""SELECT {rnd("(wins + ties / 2.0) / nullif(pos * neg, 0)", 6)} AS roc_auc
            FROM (SELECT CAST(sum(p * below) AS DOUBLE) AS wins, CAST(sum(p * n) AS DOUBLE) AS ties,
                CAST(sum(p) AS DOUBLE) AS pos, CAST(sum(n) AS DOUBLE) AS neg
              FROM (SELECT p, n, coalesce(sum(n) OVER (ORDER BY s
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                FROM (SELECT rx_share_of_total_spend AS s, sum(low_adherence) AS p,
                    sum(1 - low_adherence) AS n FROM training GROUP BY s)))""",
            "training",
        ),
        "anomaly_profile": sql(
            f"""SELECT is_anomaly, {rnd("avg(mean_price)", 4)} AS avg_mean_price,
              {rnd("avg(price_stddev)", 4)} AS avg_stddev,
              {rnd("avg(coefficient_of_variation)", 4)} AS avg_cv,
              {rnd("avg(latest_deviation)", 4)} AS avg_deviation,
              {rnd("avg(range_to_mean_ratio)", 4)} AS avg_range_ratio, count(*) AS count
            FROM (SELECT *, CASE WHEN abs(latest_deviation) > 0.6 THEN 1 ELSE 0 END AS is_anomaly
              FROM anomaly_features WHERE price_stddev IS NOT NULL) GROUP BY is_anomaly""",
            "anomaly_features",
        ),
    }
