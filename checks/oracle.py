"""DuckDB SQL with the results the Spark queries must give.

as DECIMAL, rounding is DuckDB's ROUND, reports group straight from the records.
"""

from __future__ import annotations

from holdfast import spec

# Columns of the model, and the rules of data and requests, written out here so that
# a wrong rule in the library does not pass.
NUMERIC = ["tenure", "monthly_charges", "total_charges", "num_services", "avg_monthly_spend", "contract_risk_score", "support_score"]
CATEGORICAL = [
    "gender", "senior_citizen", "partner", "dependents", "phone_service", "multiple_lines", "internet_service", "online_security",
    "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies", "contract", "paperless_billing",
    "payment_method", "tenure_segment", "monthly_charges_tier",
]
CONTRACT_VALUES = "'Month-to-month', 'One year', 'Two year'"
INTERNET_VALUES = "'DSL', 'Fiber optic', 'No'"
SEGMENT_VALUES = "'New', 'Growing', 'Established', 'Loyal', 'Champion'"
RULES = [
    ("customers", "customer_id", "unique"), ("customers", "customer_id", "not_null"),
    ("customers", "churn_flag", "not_null"), ("customers", "churn_flag", "accepted_values", "0, 1"),
    ("customers", "tenure", "not_null"), ("customers", "monthly_charges", "not_null"),
    ("customers", "contract", "accepted_values", CONTRACT_VALUES), ("customers", "internet_service", "accepted_values", INTERNET_VALUES),
    ("stg_customers", "customer_id", "unique"), ("stg_customers", "customer_id", "not_null"),
    ("stg_customers", "churn_flag", "not_null"), ("stg_customers", "churn_flag", "accepted_values", "0, 1"),
    ("stg_customers", "tenure", "not_null"), ("stg_customers", "monthly_charges", "not_null"), ("stg_customers", "total_charges", "not_null"),
    ("stg_customers", "contract", "accepted_values", CONTRACT_VALUES), ("stg_customers", "tenure_segment", "accepted_values", SEGMENT_VALUES),
    ("stg_customers", "contract_risk_score", "accepted_values", "1, 2, 3"),
    ("mart_churn_kpis", "total_customers", "not_null"), ("mart_churn_kpis", "churn_rate_pct", "not_null"),
    ("mart_churn_by_segment", "dimension", "not_null"), ("mart_churn_by_segment", "dimension_value", "not_null"),
    ("mart_churn_by_segment", "churn_rate_pct", "not_null"),
    ("mart_customer_risk", "customer_id", "unique"), ("mart_customer_risk", "customer_id", "not_null"),
    ("mart_customer_risk", "risk_score", "not_null"),
    ("mart_customer_risk", "risk_category", "accepted_values", "'Critical', 'High', 'Medium', 'Low'"),
    ("mart_customer_risk", "recommended_action", "not_null"),
]
REQUESTS = [
    ("tenure", "range", "tenure < 0 OR tenure > 72"),
    ("monthly_charges", "range", "monthly_charges < 0 OR monthly_charges > 200"),
    ("total_charges", "range", "total_charges < 0"),
    ("num_services", "range", "num_services < 0 OR num_services > 7"),
    ("avg_monthly_spend", "range", "avg_monthly_spend < 0"),
    ("contract_risk_score", "one_of", "contract_risk_score NOT IN (1, 2, 3)"),
    ("support_score", "range", "support_score < 0 OR support_score > 3"),
    ("gender", "one_of", "gender NOT IN ('Male', 'Female')"),
    ("internet_service", "one_of", f"internet_service NOT IN ({INTERNET_VALUES})"),
    ("contract", "one_of", f"contract NOT IN ({CONTRACT_VALUES})"),
    ("payment_method", "one_of",
     "payment_method NOT IN ('Electronic check', 'Mailed check', 'Bank transfer (automatic)', 'Credit card (automatic)')"),
    ("tenure_segment", "one_of", f"tenure_segment NOT IN ({SEGMENT_VALUES})"),
    ("monthly_charges_tier", "one_of", "monthly_charges_tier NOT IN ('Low', 'Mid', 'High', 'Premium')"),
    *((c, "one_of", f"{c} NOT IN ('Yes', 'No')") for c in (
        "senior_citizen", "partner", "dependents", "phone_service", "multiple_lines", "online_security", "online_backup",
        "device_protection", "tech_support", "streaming_tv", "streaming_movies", "paperless_billing",
    )),
]
# End of the fixed values.

# ---------------------------------------------------------------------------- shared tables

_RAW = """
svc AS (
  SELECT l_orderkey,
         max(CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END) AS multi,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS paperless,
         max(CASE WHEN p_type LIKE 'SMALL%' THEN 1 ELSE 0 END) AS sec,
         max(CASE WHEN p_type LIKE 'LARGE%' THEN 1 ELSE 0 END) AS bak,
         max(CASE WHEN p_type LIKE 'ECONOMY%' THEN 1 ELSE 0 END) AS dev,
         max(CASE WHEN p_type LIKE 'MEDIUM%' THEN 1 ELSE 0 END) AS tech,
         max(CASE WHEN p_type LIKE 'PROMO%' THEN 1 ELSE 0 END) AS tv,
         max(CASE WHEN p_type LIKE 'STANDARD%' THEN 1 ELSE 0 END) AS mov
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey),
latest AS (SELECT max(year(o_orderdate) * 12 + month(o_orderdate)) AS m FROM orders),
joined AS (
  SELECT o_orderkey AS k, o_custkey, o_orderpriority, c_nationkey, c_acctbal, c_mktsegment, n_regionkey,
         1800 + CAST(floor(o_totalprice) AS BIGINT) % 10200 AS cents,
         CAST(least(72, greatest(0, m - (year(o_orderdate) * 12 + month(o_orderdate)) - 1)) AS INTEGER) AS tenure,
         coalesce(multi, 0) AS multi, coalesce(paperless, 0) AS paperless,
         coalesce(sec, 0) AS sec, coalesce(bak, 0) AS bak, coalesce(dev, 0) AS dev,
         coalesce(tech, 0) AS tech, coalesce(tv, 0) AS tv, coalesce(mov, 0) AS mov
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN svc ON o_orderkey = l_orderkey
       CROSS JOIN latest),
raw AS (
  SELECT 'C' || printf('%08d', k) AS "customerID",
         CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         CASE WHEN o_custkey % 6 = 0 THEN 1 ELSE 0 END AS "SeniorCitizen",
         CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Partner",
         CASE WHEN c_acctbal > 6700 THEN 'Yes' ELSE 'No' END AS "Dependents",
         tenure,
         CASE WHEN k % 10 <> 0 THEN 'Yes' ELSE 'No' END AS "PhoneService",
         CASE WHEN k % 10 = 0 THEN 'No phone service' WHEN multi = 1 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
         CASE WHEN n_regionkey = 0 THEN 'No' WHEN n_regionkey IN (1, 2) THEN 'DSL' ELSE 'Fiber optic' END AS "InternetService",
         CASE WHEN n_regionkey = 0 THEN 'No internet service' WHEN sec = 1 THEN 'Yes' ELSE 'No' END AS "OnlineSecurity",
         CASE WHEN n_regionkey = 0 THEN 'No internet service' WHEN bak = 1 THEN 'Yes' ELSE 'No' END AS "OnlineBackup",
         CASE WHEN n_regionkey = 0 THEN 'No internet service' WHEN dev = 1 THEN 'Yes' ELSE 'No' END AS "DeviceProtection",
         CASE WHEN n_regionkey = 0 THEN 'No internet service' WHEN tech = 1 THEN 'Yes' ELSE 'No' END AS "TechSupport",
         CASE WHEN n_regionkey = 0 THEN 'No internet service' WHEN tv = 1 THEN 'Yes' ELSE 'No' END AS "StreamingTV",
         CASE WHEN n_regionkey = 0 THEN 'No internet service' WHEN mov = 1 THEN 'Yes' ELSE 'No' END AS "StreamingMovies",
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Month-to-month'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'One year' WHEN o_orderpriority = '5-LOW' THEN 'Two year' END AS "Contract",
         CASE WHEN paperless = 1 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Mailed check' WHEN 'AUTOMOBILE' THEN 'Bank transfer (automatic)'
              WHEN 'FURNITURE' THEN 'Credit card (automatic)' ELSE 'Electronic check' END AS "PaymentMethod",
         CAST(cents AS DOUBLE) / 100 AS "MonthlyCharges",
         CASE WHEN tenure = 0 THEN ' '
              ELSE CAST(CAST((cents * tenure + k % 500) AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))::VARCHAR END AS "TotalCharges",
         CASE WHEN CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 30
                        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 10 ELSE 0 END
                 + CASE WHEN tenure <= 6 THEN 30 WHEN tenure <= 12 THEN 20 WHEN tenure <= 24 THEN 10 ELSE 0 END
                 + CASE WHEN n_regionkey IN (3, 4) THEN 12 ELSE 0 END
                 - CASE WHEN n_regionkey <> 0 AND sec = 1 THEN 6 ELSE 0 END
                 - CASE WHEN n_regionkey <> 0 AND tech = 1 THEN 6 ELSE 0 END
                 + ((k * 7919 + 104729) % 10007) % 60 > 70 THEN 'Yes' ELSE 'No' END AS "Churn"
  FROM joined)"""

_named = lambda c: {"customerID": "customer_id"}.get(c) or "".join(
    ("_" + ch.lower() if ch.isupper() and i and not c[i - 1].isupper() else ch.lower()) for i, ch in enumerate(c)
)
_RENAMED = "renamed AS (SELECT " + ", ".join(f'"{c}" AS {_named(c)}' for c in spec.RAW_COLUMNS) + " FROM raw)"

_CLEAN = (
    "clean AS (SELECT * REPLACE ("
    "coalesce(try_cast(trim(total_charges) AS DOUBLE), monthly_charges) AS total_charges, "
    "CASE senior_citizen WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS senior_citizen, "
    + ", ".join(f"replace({c}, 'No internet service', 'No') AS {c}" for c in spec.INTERNET_ADDONS)
    + ", replace(multiple_lines, 'No phone service', 'No') AS multiple_lines), "
    "CAST(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS churn_flag FROM renamed)"
)

_YES7 = " + ".join(f"({c} = 'Yes')::INTEGER" for c in spec.ADDON_SERVICES)
_SUPPORT = "(tech_support = 'Yes')::INTEGER + (online_security = 'Yes')::INTEGER + (device_protection = 'Yes')::INTEGER"
_BAND = ("CASE WHEN tenure <= 6 THEN 'New' WHEN tenure <= 12 THEN 'Growing' WHEN tenure <= 24 THEN 'Established' "
         "WHEN tenure <= 48 THEN 'Loyal' ELSE 'Champion' END")
_RISKCODE = "CASE contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 1 END"

_CUTS = ("cuts AS (SELECT quantile_cont(monthly_charges, 0.25) AS q1, quantile_cont(monthly_charges, 0.5) AS q2, "
         "quantile_cont(monthly_charges, 0.75) AS q3 FROM clean)")
_TELCO = f"""telco AS (
  SELECT clean.*, {_BAND} AS tenure_segment,
         CASE WHEN monthly_charges <= q1 THEN 'Low' WHEN monthly_charges <= q2 THEN 'Mid'
              WHEN monthly_charges <= q3 THEN 'High' ELSE 'Premium' END AS monthly_charges_tier,
         {_YES7} AS num_services, (internet_service = 'Fiber optic')::INTEGER AS has_fiber,
         monthly_charges AS revenue_at_risk,
         CASE WHEN tenure > 0 THEN total_charges / tenure ELSE monthly_charges END AS avg_monthly_spend,
         {_RISKCODE} AS contract_risk_score, {_SUPPORT} AS support_score
  FROM clean, cuts)"""

_RISK_BASE = ("customer_id, gender, senior_citizen, partner, dependents, tenure, tenure_segment, contract, "
              "contract_risk_score, internet_service, monthly_charges, total_charges, num_services, support_score, "
              "has_fiber, payment_method, churn_flag, churn AS churn_label")
_T_CONTRACT = "(contract_risk_score - 1) * 15"
_T_TENURE = "CASE WHEN tenure <= 6 THEN 30 WHEN tenure <= 12 THEN 20 WHEN tenure <= 24 THEN 10 ELSE 0 END"
_T_FIBER = "has_fiber * 10"
_T_CHARGES = "CASE WHEN monthly_charges > 89 THEN 15 WHEN monthly_charges > 65 THEN 8 ELSE 0 END"
_T_SUPPORT = "support_score * -5"
_T_SERVICES = "least(num_services * 3, 15) * -1"
_A = spec.RISK_ACTIONS
_RISK = f"""risk AS (
  SELECT *, value_tier || ' / ' || risk_category AS campaign_segment FROM (
  SELECT {_RISK_BASE},
    least(100, greatest(0, {_T_CONTRACT} + {_T_TENURE} + {_T_FIBER} + {_T_CHARGES} - support_score * 5
                           - least(num_services * 3, 15))) AS risk_score,
    CASE WHEN monthly_charges > 89 AND tenure > 24 THEN 'High Value' WHEN monthly_charges > 65 THEN 'Mid Value'
         ELSE 'Low Value' END AS value_tier,
    CASE WHEN contract = 'Month-to-month' AND tenure <= 12 THEN 'Critical'
         WHEN contract = 'Month-to-month' AND tenure <= 24 THEN 'High'
         WHEN contract = 'One year' AND tenure <= 12 THEN 'High'
         WHEN contract = 'Month-to-month' THEN 'Medium' ELSE 'Low' END AS risk_category,
    CASE WHEN contract = 'Month-to-month' THEN
           CASE WHEN tenure <= 6 THEN '{_A["m2m_first_months"]}' WHEN tenure <= 12 THEN '{_A["m2m_first_year"]}'
                WHEN has_fiber = 1 THEN '{_A["m2m_fiber"]}' WHEN monthly_charges > 89 THEN '{_A["m2m_high_bill"]}'
                ELSE '{_A["m2m_other"]}' END
         WHEN support_score = 0 AND num_services <= 2 THEN '{_A["few_services"]}'
         ELSE '{_A["steady"]}' END AS recommended_action
  FROM telco))"""

_CTES = {
    "raw": (_RAW.strip(), []),
    "renamed": (_RENAMED, ["raw"]),
    "clean": (_CLEAN, ["renamed"]),
    "cuts": (_CUTS, ["clean"]),
    "telco": (_TELCO, ["cuts"]),
    "risk": (_RISK, ["telco"]),
}


def define(name: str, sql: str, needs: str) -> None:
    _CTES[name] = (f"{name} AS ({sql})", [needs])


def using(name: str, body: str) -> str:
    """SQL text with the CTE and everything below it in front."""
    chain: list[str] = []
    at: str | None = name
    while at:
        text, needs = _CTES[at]
        chain.insert(0, text)
        at = needs[0] if needs else None
    return "WITH " + ",\n".join(chain) + "\n" + body


SQL: dict[str, str] = {}

# ---------------------------------------------------------------------------- money and rates

_D = lambda x: f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"
_MRR = _D("monthly_charges")
_LOST = _D("CASE WHEN churn_flag = 1 THEN monthly_charges ELSE 0 END")
_AVG_CHARGE = f"round({_MRR} / count(monthly_charges), 2)"
_PCT = lambda n: f"round(avg(churn_flag) * 100, {n})"
_CHURNED = "CAST(sum(churn_flag) AS BIGINT)"
_KEPT = "CAST(count(*) - sum(churn_flag) AS BIGINT)"
_AVG_IF = lambda c, v, n: f"round(avg(CASE WHEN churn_flag = {v} THEN {c} END), {n})"

# ---------------------------------------------------------------------------- tables

SQL["subscribers"] = using("raw", "SELECT * FROM raw")
SQL["standardise_columns"] = using("renamed", "SELECT * FROM renamed")
SQL["clean_subscribers"] = using("clean", "SELECT * FROM clean")
SQL["charge_tier_thresholds"] = using("cuts", "SELECT * FROM cuts")
SQL["engineered_features"] = using("telco", "SELECT * FROM telco")
SQL["stg_customers"] = using("telco", "SELECT * EXCLUDE (churn), churn AS churn_label FROM telco")
SQL["customer_risk"] = using("risk", "SELECT * FROM risk")
SQL["category_audit"] = using(
    "clean",
    "SELECT coalesce(b.column_name, a.column_name) AS column_name, coalesce(b.value, a.value) AS value, "
    "coalesce(b.n, 0) AS rows_before, coalesce(a.n, 0) AS rows_after FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM renamed GROUP BY 2" for c in spec.ADDON_SERVICES
    )
    + ") b FULL OUTER JOIN ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM clean GROUP BY 2" for c in spec.ADDON_SERVICES
    )
    + ") a ON a.column_name = b.column_name AND a.value = b.value",
)
SQL["derive_online_features"] = using(
    "clean",
    f"""SELECT customer_id, tenure, monthly_charges, total_charges,
    (phone_service = 'Yes')::INTEGER + {_YES7} AS num_services,
    round(total_charges / greatest(tenure, 1), 2) AS avg_monthly_spend,
    {_RISKCODE} AS contract_risk_score, {_SUPPORT} AS support_score,
    {", ".join(c for c in CATEGORICAL if c not in ("tenure_segment", "monthly_charges_tier"))},
    {_BAND} AS tenure_segment,
    CASE WHEN monthly_charges <= 35 THEN 'Low' WHEN monthly_charges <= 65 THEN 'Mid'
         WHEN monthly_charges <= 89 THEN 'High' ELSE 'Premium' END AS monthly_charges_tier FROM clean""",
)
SQL["contract_risk_lookup"] = using("clean", f"SELECT customer_id, contract, {_RISKCODE} AS contract_risk_score FROM clean")

_FLAGS = {
    "has_phone": "phone_service = 'Yes'", "has_multi_lines": "multiple_lines = 'Yes'",
    "has_internet": "internet_service != 'No'", "has_fiber": "internet_service = 'Fiber optic'",
    "has_security": "online_security = 'Yes'", "has_backup": "online_backup = 'Yes'",
    "has_device_protect": "device_protection = 'Yes'", "has_tech_support": "tech_support = 'Yes'",
    "has_streaming_tv": "streaming_tv = 'Yes'", "has_streaming_movies": "streaming_movies = 'Yes'",
}
_NAMES = ["Phone service", "Multiple lines", "Internet (any)", "Fiber optic", "Online security", "Online backup",
          "Device protection", "Tech support", "Streaming TV", "Streaming movies"]
define(
    "flags",
    "SELECT customer_id, churn_flag, monthly_charges, "
    + ", ".join(f"({rule})::INTEGER AS {name}" for name, rule in _FLAGS.items()) + " FROM clean",
    "clean",
)
define(
    "services",
    " UNION ALL ".join(
        f"SELECT churn_flag, '{name}' AS service, {flag} AS subscribed FROM flags"
        for name, flag in zip(_NAMES, _FLAGS, strict=True)
    ),
    "flags",
)
SQL["service_flags"] = using("flags", "SELECT * FROM flags")
SQL["services_long"] = using("services", "SELECT * FROM services")

define(
    "usage",
    "SELECT service, CAST(sum(subscribed) AS BIGINT) AS subscribers, round(avg(subscribed) * 100, 1) AS adoption_rate_pct, "
    "round(avg(CASE WHEN subscribed = 1 THEN churn_flag END) * 100, 1) AS churn_rate_with_service, "
    "round(avg(CASE WHEN subscribed = 0 THEN churn_flag END) * 100, 1) AS churn_rate_without_service, "
    "round(avg(CASE WHEN subscribed = 1 THEN churn_flag END) * 100 - avg(CASE WHEN subscribed = 0 THEN churn_flag END) * 100, 1) "
    "AS churn_lift_pct FROM services GROUP BY service",
    "services",
)
SQL["service_usage"] = using("usage", "SELECT * FROM usage ORDER BY churn_lift_pct, service")
SQL["service_effect_split"] = using(
    "usage",
    "SELECT CASE WHEN churn_lift_pct < 0 THEN 'protective' ELSE 'risky' END AS effect, service, churn_lift_pct, "
    "service || ': ' || printf('%+.1f%%', churn_lift_pct) AS label FROM usage WHERE churn_lift_pct <> 0",
)

# ---------------------------------------------------------------------------- reports

SQL["churn_kpis"] = using(
    "clean",
    f"""SELECT count(*) AS total_customers, {_CHURNED} AS total_churned, {_KEPT} AS total_retained, {_PCT(2)} AS churn_rate_pct,
    round({_MRR}, 2) AS total_mrr, {_AVG_CHARGE} AS avg_monthly_charges, round({_LOST}, 2) AS monthly_revenue_lost,
    round({_LOST} / {_MRR} * 100, 2) AS revenue_at_risk_pct, {_AVG_IF("tenure", 1, 1)} AS avg_tenure_churned_months,
    {_AVG_IF("tenure", 0, 1)} AS avg_tenure_retained_months FROM clean""",
)
SQL["mart_churn_kpis"] = using(
    "telco",
    f"""SELECT count(*) AS total_customers, {_CHURNED} AS total_churned, {_KEPT} AS total_retained, {_PCT(2)} AS churn_rate_pct,
    round((1 - avg(churn_flag)) * 100, 2) AS retention_rate_pct, round({_MRR}, 2) AS total_mrr, {_AVG_CHARGE} AS avg_monthly_charges,
    round({_LOST}, 2) AS monthly_revenue_lost, round({_LOST} * 12, 2) AS annual_revenue_lost,
    round({_LOST} / nullif({_MRR}, 0) * 100, 2) AS revenue_at_risk_pct, round(avg(tenure), 1) AS avg_tenure_months,
    {_AVG_IF("tenure", 1, 1)} AS avg_tenure_churned, {_AVG_IF("tenure", 0, 1)} AS avg_tenure_retained,
    round(avg(num_services), 2) AS avg_num_services, {_AVG_IF("num_services", 1, 2)} AS avg_services_churned,
    {_AVG_IF("num_services", 0, 2)} AS avg_services_retained FROM telco""",
)
SQL["churn_by_contract"] = using(
    "telco",
    f"""SELECT contract, contract_risk_score, count(*) AS total_customers, {_CHURNED} AS churned, {_KEPT} AS retained,
    {_PCT(1)} AS churn_rate_pct, {_AVG_CHARGE} AS avg_monthly_charges, round({_MRR}, 2) AS total_mrr,
    round({_LOST}, 2) AS revenue_at_risk, round(avg(tenure), 1) AS avg_tenure_months,
    {_AVG_IF("tenure", 1, 1)} AS avg_tenure_churned FROM telco GROUP BY contract, contract_risk_score""",
)
_SEG_ORDER = "CASE {} WHEN 'New' THEN 1 WHEN 'Growing' THEN 2 WHEN 'Established' THEN 3 WHEN 'Loyal' THEN 4 WHEN 'Champion' THEN 5 END"
SQL["churn_by_tenure"] = using(
    "telco",
    f"""SELECT tenure_segment, {_SEG_ORDER.format("tenure_segment")} AS segment_order, count(*) AS total_customers,
    {_CHURNED} AS churned, {_KEPT} AS retained, {_PCT(1)} AS churn_rate_pct, min(tenure) AS min_tenure_months,
    max(tenure) AS max_tenure_months, round(avg(tenure), 1) AS avg_tenure_months, {_AVG_CHARGE} AS avg_monthly_charges,
    round({_MRR}, 2) AS segment_mrr, round({_LOST}, 2) AS segment_revenue_at_risk FROM telco GROUP BY tenure_segment""",
)
define(
    "loss",
    f"""SELECT tenure_segment, contract, monthly_charges_tier, count(*) AS customers, {_CHURNED} AS churned,
    {_PCT(1)} AS churn_rate_pct, round({_LOST}, 2) AS revenue_lost_monthly,
    round({_D("CASE WHEN churn_flag = 1 THEN monthly_charges END")} / count(CASE WHEN churn_flag = 1 THEN monthly_charges END), 2) AS avg_churned_charge,
    round({_LOST} * 12, 2) AS revenue_lost_annual
    FROM telco GROUP BY tenure_segment, contract, monthly_charges_tier HAVING sum(churn_flag) > 0
    ORDER BY revenue_lost_monthly DESC, tenure_segment, contract, monthly_charges_tier LIMIT 20""",
    "telco",
)
SQL["revenue_at_risk"] = using("loss", "SELECT * FROM loss")
SQL["top_revenue_loss"] = using(
    "loss",
    """SELECT place, segment, monthly_charges_tier, churn_rate_pct, revenue_lost_monthly,
    CAST(sum(CASE WHEN place <= 3 THEN CAST(revenue_lost_monthly AS DECIMAL(18,2)) END) OVER () AS DOUBLE) AS head_total
    FROM (SELECT row_number() OVER (ORDER BY revenue_lost_monthly DESC, tenure_segment, contract, monthly_charges_tier) AS place,
          tenure_segment || ' / ' || contract AS segment, monthly_charges_tier, churn_rate_pct, revenue_lost_monthly FROM loss)
    WHERE place <= 10""",
)
define(
    "assigned",
    """SELECT *, CASE WHEN value_tier = 'High Value' THEN
        CASE risk_tier WHEN 'Low Risk' THEN 'Champions' WHEN 'High Risk' THEN 'At Risk' ELSE 'Needs Attention' END
      ELSE CASE risk_tier WHEN 'High Risk' THEN 'Lost Cause' WHEN 'Medium Risk' THEN 'Promising' ELSE 'Sleepers' END
      END AS customer_segment
    FROM (SELECT *, CASE WHEN monthly_charges > 65 AND tenure > 24 THEN 'High Value' ELSE 'Low Value' END AS value_tier,
      CASE WHEN contract <> 'Month-to-month' OR tenure > 24 THEN 'Low Risk' WHEN tenure <= 12 THEN 'High Risk'
           ELSE 'Medium Risk' END AS risk_tier FROM telco)""",
    "telco",
)
SQL["segment_assignment"] = using("assigned", "SELECT customer_id, value_tier, risk_tier, customer_segment FROM assigned")
define(
    "profile",
    f"""SELECT customer_segment, value_tier, risk_tier, count(*) AS customers, {_PCT(1)} AS actual_churn_rate_pct,
    {_CHURNED} AS actually_churned, {_AVG_CHARGE} AS avg_monthly_charges, round({_MRR}, 2) AS total_segment_mrr,
    round({_LOST}, 2) AS revenue_lost, round(avg(num_services), 1) AS avg_services, round(avg(tenure), 1) AS avg_tenure_months
    FROM assigned GROUP BY 1, 2, 3""",
    "assigned",
)
SQL["customer_segments"] = using("profile", "SELECT * FROM profile")
SQL["segment_table"] = using(
    "profile",
    'SELECT customer_segment AS "Segment", customers AS "Customers", actual_churn_rate_pct AS "Churn %", '
    'avg_monthly_charges AS "Avg MRR $", total_segment_mrr AS "Segment MRR $", revenue_lost AS "Revenue Lost $", '
    'avg_services AS "Avg Services" FROM profile',
)
SQL["contract_table"] = using(
    "telco",
    f"""SELECT contract AS "Contract", count(*) AS "Customers", {_CHURNED} AS "Churned", {_PCT(1)} AS "Churn %",
    {_AVG_CHARGE} AS "Avg Monthly $", round({_LOST}, 2) AS "Rev at Risk $", round(avg(tenure), 1) AS "Avg Tenure (mo)"
    FROM telco GROUP BY contract""",
)
SQL["segment_directory"] = using(
    "profile",
    "SELECT place, d.customer_segment, CAST(coalesce(n, 0) AS BIGINT) AS customers, note FROM (VALUES "
    + ", ".join(f"({i}, '{s}', '{spec.SEGMENT_NOTES[s]}')" for i, s in enumerate(spec.SEGMENTS, 1))
    + ") d(place, customer_segment, note) LEFT JOIN (SELECT customer_segment, sum(customers) AS n FROM profile GROUP BY 1) p "
    "ON p.customer_segment = d.customer_segment",
)
_DIM = lambda c, extra="": (
    f"SELECT '{c}' AS dimension, {c} AS dimension_value{extra}, count(*) AS customers, {_CHURNED} AS churned, "
    f"{_PCT(1)} AS churn_rate_pct, {_AVG_CHARGE} AS avg_monthly_charges"
)
SQL["retention_analysis"] = using(
    "clean",
    " UNION ALL ".join(
        _DIM(c) + f" FROM clean GROUP BY {c}"
        for c in ["payment_method", "paperless_billing", "senior_citizen", "gender", "dependents"]
    ),
)
_TIER_ORDER = "CASE monthly_charges_tier WHEN 'Low' THEN 1 WHEN 'Mid' THEN 2 WHEN 'High' THEN 3 WHEN 'Premium' THEN 4 END"
_PART = lambda c, order: (
    _DIM(c, f", CAST({order} AS BIGINT) AS sort_order") + f", round({_LOST}, 2) AS revenue_at_risk FROM telco GROUP BY {c}"
)
define(
    "by_segment",
    " UNION ALL ".join(
        [
            _PART("tenure_segment", _SEG_ORDER.format("tenure_segment")),
            _PART("contract", "max(contract_risk_score)"),
            _PART("internet_service", "row_number() OVER (ORDER BY avg(churn_flag) DESC, internet_service)"),
            _PART("payment_method", "row_number() OVER (ORDER BY avg(churn_flag) DESC, payment_method)"),
            _PART("monthly_charges_tier", _TIER_ORDER),
        ]
    ),
    "telco",
)
SQL["mart_churn_by_segment"] = using("by_segment", "SELECT * FROM by_segment")
SQL["top_risk_customers"] = using(
    "risk",
    "SELECT customer_id, tenure, contract, risk_score, risk_category, recommended_action FROM risk "
    "WHERE risk_category IN ('Critical', 'High') ORDER BY risk_score DESC, customer_id LIMIT 5",
)
SQL["headline_insights"] = using(
    "usage",
    f"""SELECT insight, CAST(value AS DOUBLE) AS value, label FROM (
    SELECT 'churn_rate_pct' AS insight, {_PCT(2)} AS value, NULL AS label FROM clean
    UNION ALL SELECT 'monthly_revenue_lost', round({_LOST}, 2), NULL FROM clean
    UNION ALL SELECT 'annual_revenue_lost', round(round({_LOST}, 2) * 12, 2), NULL FROM clean
    UNION ALL SELECT 'revenue_at_risk_pct', round({_LOST} / {_MRR} * 100, 2), NULL FROM clean
    UNION ALL SELECT 'avg_tenure_churned_months', {_AVG_IF("tenure", 1, 1)}, NULL FROM clean
    UNION ALL SELECT 'avg_tenure_retained_months', {_AVG_IF("tenure", 0, 1)}, NULL FROM clean
    UNION ALL SELECT 'tenure_gap_months', round({_AVG_IF("tenure", 0, 1)} - {_AVG_IF("tenure", 1, 1)}, 1), NULL FROM clean
    UNION ALL SELECT 'month_to_month_churn_pct', {_PCT(1)}, 'Month-to-month' FROM clean WHERE contract = 'Month-to-month' HAVING count(*) > 0
    UNION ALL SELECT 'new_customer_churn_pct', {_PCT(1)}, 'New' FROM clean WHERE tenure <= 6 HAVING count(*) > 0
    UNION ALL (SELECT 'most_protective_service', churn_lift_pct, service FROM usage WHERE churn_lift_pct < 0
               ORDER BY churn_lift_pct, service LIMIT 1))""",
)

# ---------------------------------------------------------------------------- dashboard

SQL["rate_by_dimension"] = using(
    "telco",
    " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS dimension_value, avg(churn_flag) AS churn_rate, count(churn_flag) AS customers "
        f"FROM telco GROUP BY {c}"
        for c in ["tenure_segment", "contract", "senior_citizen", "dependents", "payment_method"]
    ),
)
SQL["overview_cards"] = using(
    "telco",
    f"""SELECT count(*) AS total_customers, {_CHURNED} AS churned, avg(churn_flag) AS churn_rate, {_MRR} AS mrr, {_LOST} AS lost_mrr,
    {_D("CASE WHEN churn_flag = 1 THEN monthly_charges * 12 ELSE 0 END")} AS lost_mrr_annual, {_LOST} * 100 / ({_MRR} * 100) AS lost_share,
    avg(CASE WHEN churn_flag = 1 THEN tenure END) AS avg_tenure_churned, avg(CASE WHEN churn_flag = 0 THEN tenure END) AS avg_tenure_retained,
    avg(CASE WHEN churn_flag = 1 THEN num_services END) AS avg_services_churned,
    avg(CASE WHEN churn_flag = 0 THEN num_services END) AS avg_services_retained FROM telco""",
)
SQL["revenue_by_segment"] = using(
    "telco",
    f"SELECT tenure_segment, {_SEG_ORDER.format('tenure_segment')} AS segment_order, {_MRR} AS total_mrr, {_LOST} AS lost_mrr, "
    f"count(customer_id) AS customers, {_CHURNED} AS churned FROM telco GROUP BY tenure_segment",
)
_KEPT_MRR = _D("CASE WHEN churn_flag = 1 THEN 0 ELSE monthly_charges END")
SQL["revenue_by_contract"] = using(
    "clean",
    f"SELECT contract, {_MRR} AS total_mrr, {_LOST} AS lost_mrr, {_KEPT_MRR} AS retained_mrr FROM clean GROUP BY contract",
)
SQL["lost_mrr_share"] = using(
    "clean",
    "SELECT contract, CAST(lost AS DOUBLE) AS lost_mrr, CAST(lost * 100 AS DOUBLE) / CAST(sum(lost * 100) OVER () AS DOUBLE) AS lost_share FROM "
    "(SELECT contract, sum(CASE WHEN churn_flag = 1 THEN CAST(monthly_charges AS DECIMAL(18,2)) ELSE 0 END) AS lost FROM clean GROUP BY contract)",
)
SQL["ingest_summary"] = using(
    "clean",
    f"SELECT count(*) AS total_customers, {_CHURNED} AS churned, {_KEPT} AS retained, {_MRR} / count(monthly_charges) AS avg_monthly_charges, "
    "avg(tenure) AS avg_tenure, CAST("
    + " + ".join(f"count(*) FILTER (WHERE {_named(c)} IS NULL)" for c in spec.RAW_COLUMNS)
    + " + count(*) FILTER (WHERE churn_flag IS NULL) AS BIGINT) AS missing_cells, "
    "(SELECT count(*) FROM raw WHERE trim(\"TotalCharges\") = '') AS blank_totals FROM clean",
)
SQL["load_profile"] = using(
    "telco", "SELECT count(*) AS row_count, CAST(30 AS BIGINT) AS column_count, avg(churn_flag) AS churn_rate FROM telco"
)
SQL["built_models"] = """SELECT CAST(place AS INTEGER) AS place, model, 'built' AS first_build, 'unchanged' AS second_build FROM (VALUES
  (0, 'customers'), (1, 'stg_customers'), (2, 'mart_churn_kpis'), (3, 'mart_churn_by_segment'), (4, 'mart_customer_risk')) AS t(place, model)"""
_NUMBER = 'CAST(substr("customerID", 2) AS BIGINT)'
SQL["csv_load"] = using(
    "raw",
    f"SELECT count(*) AS lines, count(*) FILTER ({_NUMBER} % 97 <> 0 AND {_NUMBER} % 101 <> 0) AS accepted, "
    f"count(*) FILTER ({_NUMBER} % 97 <> 0 AND {_NUMBER} % 101 = 0) AS rejected, count(*) FILTER ({_NUMBER} % 97 = 0) AS malformed, "
    f"count(*) FILTER ({_NUMBER} % 97 <> 0 AND {_NUMBER} % 101 <> 0) AS table_rows FROM raw",
)
_CLEAN_SUMS = (
    "count(*) AS row_count, CAST(sum(churn_flag) AS BIGINT) AS churned, CAST(sum(CAST(round(monthly_charges * 100) AS BIGINT)) AS BIGINT) AS cents"
)
SQL["clean_files"] = using(
    "telco", f"SELECT 'parquet' AS format, {_CLEAN_SUMS} FROM telco UNION ALL SELECT 'csv', {_CLEAN_SUMS} FROM telco"
)
SQL["report_file"] = SQL["churn_by_contract"]
SQL["run_log"] = using(
    "clean",
    "SELECT run_id, 'success' AS status, total_customers, churn_rate, roc_auc, TRUE AS stamped FROM (VALUES ('night', 0.84::DOUBLE), ('day', NULL)) "
    "AS t(run_id, roc_auc), (SELECT count(*) AS total_customers, avg(churn_flag) AS churn_rate FROM clean)",
)
SQL["model_row_counts"] = using(
    "by_segment",
    "SELECT 'stg_customers' AS model, count(*) AS row_count, 'built' AS status FROM telco "
    "UNION ALL SELECT 'mart_churn_kpis', 1, 'built' UNION ALL SELECT 'mart_churn_by_segment', (SELECT count(*) FROM by_segment), 'built' "
    "UNION ALL SELECT 'mart_customer_risk', (SELECT count(*) FROM telco), 'built' "
    "UNION ALL SELECT 'mart_not_built', NULL, 'not found'",
)

# ---------------------------------------------------------------------------- split and evaluation

define(
    "graded",
    """SELECT *, risk_score / CAST(100 AS DOUBLE) AS p, CAST(risk_score > 50 AS INTEGER) AS hat,
    CAST(rn <= floor(0.2 * n + 0.5) AS INTEGER) AS is_test FROM (
    SELECT *, row_number() OVER (PARTITION BY churn_flag ORDER BY md5('42:' || customer_id), customer_id) AS rn,
           count(*) OVER (PARTITION BY churn_flag) AS n FROM risk)""",
    "risk",
)
define(
    "dealt",
    """SELECT *, CAST((row_number() OVER (PARTITION BY churn_flag ORDER BY md5('43:' || customer_id), customer_id) - 1) * 5
    // count(*) OVER (PARTITION BY churn_flag) AS INTEGER) AS fold FROM graded WHERE is_test = 0""",
    "graded",
)
SQL["class_balance"] = using(
    "clean", "SELECT count(*) AS row_count, avg(churn_flag) AS churn_share, 1 - avg(churn_flag) AS retained_share FROM clean"
)
SQL["stratified_split"] = using("graded", "SELECT customer_id, churn_flag, is_test FROM graded")
SQL["cv_folds"] = using("dealt", "SELECT customer_id, churn_flag, fold FROM dealt")
SQL["class_weights"] = using(
    "graded",
    "SELECT churn_flag, count(*) AS n, (SELECT count(*) FROM graded WHERE is_test = 0) / (2.0 * count(*)) AS weight "
    "FROM graded WHERE is_test = 0 GROUP BY churn_flag",
)
define(
    "trained",
    "SELECT t.*, g.is_test FROM telco t JOIN graded g USING (customer_id)",
    "graded",
)
SQL["scaled_features"] = using(
    "trained",
    "SELECT customer_id, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in NUMERIC)
    + " FROM telco, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
    + " FROM trained WHERE is_test = 0)",
)
define(
    "levels",
    "SELECT row_number() OVER (ORDER BY no, level) - 1 AS position, feature, column_name, level FROM ("
    + " UNION ALL ".join(f"SELECT {i} AS no, '{c}' AS feature, '{c}' AS column_name, NULL AS level"
                         for i, c in enumerate(NUMERIC))
    + "".join(f" UNION ALL SELECT DISTINCT {i}, '{c}_' || {c}, '{c}', {c} FROM trained WHERE is_test = 0"
              for i, c in enumerate(CATEGORICAL, 7))
    + ")",
    "trained",
)
SQL["one_hot_levels"] = using("levels", "SELECT * FROM levels")
_TITLE = lambda x: (
    f"list_reduce(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), lambda r: upper(r[1]) || lower(r[2:])), "
    "lambda a, b: a || b)"
)
SQL["feature_labels"] = using(
    "levels",
    "SELECT feature, CASE WHEN instr(feature, '_') > 0 THEN "
    + _TITLE("substr(feature, 1, instr(feature, '_') - 1)")
    + " || ': ' || substr(feature, instr(feature, '_') + 1) ELSE "
    + _TITLE("feature")
    + " END AS bar_label, substr("
    + _TITLE("replace(feature, '_', ' ')")
    + ", 1, 20) AS card_label FROM levels",
)
_AUC = lambda source, by="": f"""SELECT {by + ', ' if by else ''}
    (sum(CASE WHEN churn_flag = 1 THEN mid END) - positives * (positives + 1) / 2.0) / (positives * negatives) AS roc_auc,
    positives, negatives FROM (
      SELECT *, rank() OVER ({'PARTITION BY ' + by if by else ''} ORDER BY p)
                + (count(*) OVER (PARTITION BY {by + ', ' if by else ''}p) - 1) / 2.0 AS mid,
             count(*) FILTER (WHERE churn_flag = 1) OVER ({'PARTITION BY ' + by if by else ''}) AS positives,
             count(*) FILTER (WHERE churn_flag = 0) OVER ({'PARTITION BY ' + by if by else ''}) AS negatives FROM {source})
    GROUP BY {by + ', ' if by else ''}positives, negatives"""
SQL["roc_auc"] = using("graded", _AUC("graded"))
SQL["roc_curve"] = using(
    "graded",
    """SELECT threshold, tpr, fpr FROM (
      SELECT p AS threshold, tp / CAST(max(tp) OVER () AS DOUBLE) AS tpr, fp / CAST(max(fp) OVER () AS DOUBLE) AS fpr,
        lag(tp) OVER w IS NULL OR lead(tp) OVER w IS NULL OR lead(tp) OVER w - tp <> tp - lag(tp) OVER w
          OR lead(fp) OVER w - fp <> fp - lag(fp) OVER w AS kept
      FROM (SELECT DISTINCT p, count(*) FILTER (WHERE churn_flag = 1) OVER (ORDER BY p DESC) AS tp,
                   count(*) FILTER (WHERE churn_flag = 0) OVER (ORDER BY p DESC) AS fp FROM graded)
      WINDOW w AS (ORDER BY p DESC)) WHERE kept
    UNION ALL SELECT NULL, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""",
)
_CELLS = ("count(*) FILTER (WHERE churn_flag = 0 AND hat = 0) AS true_negatives, "
          "count(*) FILTER (WHERE churn_flag = 0 AND hat = 1) AS false_positives, "
          "count(*) FILTER (WHERE churn_flag = 1 AND hat = 0) AS false_negatives, "
          "count(*) FILTER (WHERE churn_flag = 1 AND hat = 1) AS true_positives")
SQL["confusion_matrix"] = using("graded", f"SELECT {_CELLS} FROM graded")
define(
    "cells",
    "SELECT CAST(count(*) FILTER (WHERE churn_flag = 0 AND hat = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE churn_flag = 0 AND hat = 1) AS DOUBLE) AS fp, "
    "CAST(count(*) FILTER (WHERE churn_flag = 1 AND hat = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE churn_flag = 1 AND hat = 1) AS DOUBLE) AS tp FROM graded",
    "graded",
)
define(
    "classes",
    "SELECT 'Retained' AS class_name, coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall, "
    "coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1_score, tn + fp AS support FROM cells UNION ALL "
    "SELECT 'Churned', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), "
    "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), fn + tp FROM cells",
    "cells",
)
SQL["classification_report"] = using(
    "classes",
    "SELECT class_name, precision, recall, f1_score, CAST(support AS BIGINT) AS support FROM classes UNION ALL "
    "SELECT 'accuracy', NULL, NULL, (tn + tp) / (tn + fp + fn + tp), CAST(tn + fp + fn + tp AS BIGINT) FROM cells UNION ALL "
    "SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM classes UNION ALL "
    "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
    "sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM classes",
)
_RECORD = f"""SELECT round((SELECT roc_auc FROM ({_AUC("(SELECT * FROM graded WHERE is_test = 1)")})), 4) AS roc_auc,
    round((SELECT avg(roc_auc) FROM ({_AUC("dealt", "fold")})), 4) AS cv_roc_auc,
    round(true_positives / nullif(true_positives + false_positives, 0), 4) AS precision_churn,
    round(true_positives / nullif(true_positives + false_negatives, 0), 4) AS recall_churn,
    round(2 * true_positives / (2 * true_positives + false_positives + false_negatives), 4) AS f1_churn,
    round((true_positives + true_negatives) / test_size, 4) AS accuracy, true_negatives, false_positives, false_negatives, true_positives,
    test_size FROM (SELECT {_CELLS}, count(*) AS test_size FROM graded WHERE is_test = 1)"""
SQL["model_metrics"] = using("dealt", _RECORD)
SQL["quality_gate"] = using(
    "dealt", f"SELECT roc_auc, CAST(0.75 AS DOUBLE) AS minimum, roc_auc >= 0.75 AS passed FROM ({_RECORD})"
)

# ---------------------------------------------------------------------------- checks

_MODEL_SOURCE = {
    "customers": "telco", "stg_customers": "telco", "mart_customer_risk": "risk", "mart_churn_by_segment": "by_segment",
    "mart_churn_kpis": f"(SELECT count(*) AS total_customers, {_PCT(2)} AS churn_rate_pct FROM telco)",
}


def _rule_sql(model: str, column: str, rule: str, accepted: str = "") -> str:
    source = _MODEL_SOURCE[model]
    if rule == "unique":
        failures = f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"
    elif rule == "not_null":
        failures = f"(SELECT count(*) FROM {source} WHERE {column} IS NULL)"
    else:
        failures = f"(SELECT count(*) FROM {source} WHERE {column} NOT IN ({accepted}))"
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, '{rule}' AS rule, {failures} AS failures, "
            f"{failures} = 0 AS passed")


define("segmented", _CTES["by_segment"][0].split(" AS (", 1)[1][:-1], "risk")
_MODEL_SOURCE["mart_churn_by_segment"] = "segmented"
SQL["dq_results"] = using(
    "segmented",
    " UNION ALL ".join(_rule_sql(*rule) for rule in RULES),
)
define("online", SQL["derive_online_features"].rsplit("\nSELECT", 1)[1].join(["SELECT", ""]), "clean")


def _field_error(field: str, rule: str, broken: str) -> str:
    return f"CASE WHEN {field} IS NULL THEN '{field}:missing' WHEN {broken} THEN '{field}:{rule}' END"


_FOUND = "SELECT *, list_filter([" + ", ".join(_field_error(*r) for r in REQUESTS) + "], lambda e: e IS NOT NULL) AS found"
define("judged", f"{_FOUND} FROM online", "online")
# requests count the services as the model learned them, without the phone
define("requested", "SELECT * REPLACE (num_services - (phone_service = 'Yes')::INTEGER AS num_services) FROM online", "online")
define("judged_requests", f"{_FOUND} FROM requested", "requested")
SQL["validate_records"] = using(
    "judged",
    "SELECT customer_id, len(found) = 0 AS is_valid, CAST(len(found) AS INTEGER) AS error_count, "
    "array_to_string(found, ';') AS errors, round(avg_monthly_spend, 2) AS avg_monthly_spend FROM judged",
)

# ---------------------------------------------------------------------------- scoring

_S = spec.SCORE_ACTIONS
_CODE = """CASE WHEN p < 0.3 THEN 'low_risk'
  WHEN contract = 'Month-to-month' THEN CASE WHEN tenure <= 6 THEN 'm2m_first_months' WHEN tenure <= 12 THEN 'm2m_first_year'
    WHEN internet_service = 'Fiber optic' AND monthly_charges > 75 THEN 'm2m_fiber_high_bill' ELSE 'm2m_other' END
  WHEN support_score = 0 THEN 'no_support' WHEN num_services <= 2 THEN 'few_services' ELSE 'watch' END"""
_TEXT = ("replace(CASE action_code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _S.items())
         + " END, '{pct}', CAST(CAST(round_even(p * 100, 0) AS INTEGER) AS VARCHAR))")
_TIER = "CASE WHEN p >= 0.7 THEN 'Critical' WHEN p >= 0.5 THEN 'High' WHEN p >= 0.3 THEN 'Medium' ELSE 'Low' END"
define(
    "replies",
    f"""SELECT customer_id, hat AS churn_prediction, round(p, 4) AS churn_probability, round(1 - p, 4) AS retention_probability,
    {_TIER} AS risk_tier, round(p * 100, 1) AS risk_score_pct, action_code, {_TEXT} AS recommendation, '1.0.0' AS model_version,
    round(p * 100 - (SELECT avg(churn_flag) * 100 FROM graded), 1) AS delta_pct
    FROM (SELECT *, {_CODE} AS action_code FROM graded)""",
    "graded",
)
SQL["score_output"] = using("replies", "SELECT * FROM replies")
SQL["reply_index"] = using(
    "replies",
    "SELECT row_index, customer_id, churn_probability, risk_tier FROM replies JOIN "
    "(SELECT row_number() OVER () - 1 AS row_index, o_orderkey FROM orders) ON customer_id = 'C' || printf('%08d', o_orderkey)",
)
SQL["risk_tier"] = using("replies", "SELECT customer_id, risk_tier FROM replies")
SQL["recommendation"] = using("replies", "SELECT customer_id, action_code, recommendation FROM replies")
SQL["score_summary"] = using(
    "replies",
    "SELECT count(*) AS batch_size, CAST(sum(churn_prediction) AS BIGINT) AS predicted_churn, "
    "count(*) FILTER (WHERE churn_prediction = 0) AS predicted_retain, "
    "round(CAST(sum(CAST(churn_probability AS DECIMAL(9,4))) AS DOUBLE) / count(*), 4) AS avg_churn_prob, "
    "count(*) FILTER (WHERE risk_tier = 'Critical') AS critical_count, count(*) FILTER (WHERE risk_tier = 'High') AS high_count FROM replies",
)
SQL["highest_score_row"] = using("graded", "SELECT customer_id, p AS probability FROM graded ORDER BY p DESC, customer_id LIMIT 1")
define(
    "streamed",
    f"""SELECT *, (least(100, greatest(0, {_T_CONTRACT} + {_T_TENURE}
      + (internet_service = 'Fiber optic')::INTEGER * 10 + {_T_CHARGES} - support_score * 5 - least(num_services * 3, 15)))) / CAST(100 AS DOUBLE) AS p
    FROM judged_requests""",
    "judged_requests",
)
SQL["stream_rule_score"] = using(
    "streamed",
    f"SELECT customer_id, CASE WHEN len(found) = 0 THEN round(p, 4) END AS churn_probability, CASE WHEN len(found) = 0 THEN {_TIER} END AS risk_tier, "
    f"CASE WHEN len(found) = 0 THEN {_CODE} END AS action_code, array_to_string(found, ';') AS errors FROM streamed",
)

# ---------------------------------------------------------------------------- explanation

define("sampled", "SELECT * FROM telco ORDER BY md5('42:' || customer_id), customer_id LIMIT 1000", "telco")
SQL["explain_sample"] = using("sampled", f"SELECT customer_id, {', '.join(NUMERIC + CATEGORICAL)} FROM sampled")
_TERMS = {
    "contract": ("contract_risk_score", _T_CONTRACT), "tenure": ("tenure", _T_TENURE), "fiber": ("has_fiber", _T_FIBER),
    "charges": ("monthly_charges", _T_CHARGES), "support": ("support_score", _T_SUPPORT), "services": ("num_services", _T_SERVICES),
}
_TOTAL = " + ".join(f"({t})" for _, t in _TERMS.values())
define(
    "contributed",
    " UNION ALL ".join(
        f"SELECT customer_id, '{f}' AS feature, CAST({c} AS DOUBLE) AS value, ({t}) - (SELECT avg({t}) FROM telco) AS contribution FROM telco"
        for f, (c, t) in _TERMS.items()
    ),
    "telco",
)
define(
    "drivers",
    "SELECT row_number() OVER (ORDER BY impact DESC, feature) AS place, feature, impact, direction FROM ("
    "SELECT feature, round(avg(abs(contribution)), 4) AS impact, CASE WHEN round(avg(contribution), 9) > 0 THEN 'increases' ELSE 'decreases' END AS direction "
    "FROM contributed GROUP BY feature) QUALIFY place <= 10",
    "contributed",
)
SQL["driver_ranking"] = using("drivers", "SELECT * FROM drivers")
SQL["driver_report_lines"] = using(
    "drivers",
    "SELECT CAST(0 AS BIGINT) AS line_no, 'Drivers of churn' AS line UNION ALL SELECT place, place || '. ' || "
    "CASE direction WHEN 'increases' THEN '↑' ELSE '↓' END || ' ' || feature || ' (impact=' || "
    "regexp_replace(printf('%.4f', impact), '(\\.\\d+?)0+$', '\\1') || ')' FROM drivers",
)
SQL["report_text"] = f"SELECT line FROM ({SQL['driver_report_lines']})"
SQL["insight_rows"] = using(
    "drivers",
    "SELECT place, feature, impact, direction, CASE WHEN place <= 5 THEN substr(" + _TITLE("replace(feature, '_', ' ')") + ", 1, 60) || ' ' || direction "
    "|| ' churn, by ' || regexp_replace(printf('%.4f', impact), '(\\.\\d+?)0+$', '\\1') || ' on average.' END AS sentence FROM drivers",
)
SQL["driver_cards"] = using(
    "drivers",
    "SELECT place, substr(" + _TITLE("replace(feature, '_', ' ')") + ", 1, 20) AS card, printf('%.4f', impact) AS impact, "
    "CASE direction WHEN 'increases' THEN '▲' ELSE '▼' END || ' ' || direction || ' churn' AS note FROM drivers WHERE place <= 5",
)
SQL["driver_bars"] = using(
    "contributed",
    "SELECT feature, " + _TITLE("feature") + " AS label, mean_abs, mean_abs > median(mean_abs) OVER () AS above_median FROM "
    "(SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs FROM contributed GROUP BY feature ORDER BY mean_abs DESC, feature LIMIT 15)",
)
SQL["dependence_pairs"] = using(
    "contributed",
    "SELECT customer_id, value, round(contribution, 6) AS contribution, contract_risk_score FROM contributed JOIN telco USING (customer_id) "
    "WHERE feature = 'tenure'",
)
SQL["shap_distribution"] = using(
    "contributed",
    "SELECT feature, "
    + ", ".join(
        f"round(quantile_cont({c}, {q}), 6) AS {c}_p{round(q * 100)}"
        for c in ("value", "contribution") for q in (0, 0.25, 0.5, 0.75, 1)
    )
    + " FROM contributed GROUP BY feature",
)
define(
    "one",
    f"""SELECT *, row_number() OVER (ORDER BY abs(contribution) DESC, feature) AS r,
    (SELECT avg({_TOTAL}) FROM telco) AS base FROM contributed WHERE customer_id = (
      SELECT customer_id FROM telco ORDER BY least(100, greatest(0, {_TOTAL})) DESC, customer_id LIMIT 1)""",
    "contributed",
)
SQL["waterfall_rows"] = using(
    "one",
    "SELECT CAST(0 AS BIGINT) AS place, 'base' AS feature, CAST(NULL AS DOUBLE) AS value, round(max(base), 6) AS contribution FROM one "
    "UNION ALL SELECT r, feature, value, round(contribution, 6) FROM one WHERE r < 5 "
    "UNION ALL SELECT 5, 'other', NULL, round(sum(contribution), 6) FROM one WHERE r >= 5 "
    "UNION ALL SELECT 6, 'score', NULL, round(sum(contribution) + max(base), 6) FROM one",
)
SQL["shap_check"] = "SELECT count(*) AS rows_checked, CAST(0 AS BIGINT) AS rows_off FROM orders"
SQL["score_check"] = "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS rows_off, CAST(0 AS BIGINT) AS scores_off FROM orders"
SQL["stream_check"] = using(
    "judged_requests", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS rows_off FROM judged_requests WHERE len(found) = 0"
)
SQL["train_check"] = using(
    "graded", "SELECT count(*) AS test_size, count(*) AS counted, TRUE AS passed FROM graded WHERE is_test = 1"
)
SQL["cv_check"] = using(
    "dealt", "SELECT fold, count(*) AS row_count, count(*) FILTER (WHERE churn_flag = 1) AS positives, TRUE AS fits FROM dealt GROUP BY fold"
)
SQL["explained_check"] = (
    "SELECT CAST(10 AS BIGINT) AS drivers, CAST(0 AS BIGINT) AS misplaced, TRUE AS ends_at_score, count(*) AS points, "
    "CAST(20 AS BIGINT) AS features, CAST(0 AS BIGINT) AS spread_off FROM orders"
)
SQL["model_information"] = (
    "SELECT 'ok' AS status, TRUE AS model_loaded, 'RandomForestClassificationModel' AS model_type, CAST(25 AS INTEGER) AS feature_count, "
    f"'{spec.MODEL_VERSION}' AS version"
)
SQL["encoded_names"] = using("levels", "SELECT position, feature FROM levels")
SQL["unseen_category"] = "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS unscored, CAST(0 AS BIGINT) AS codes_set FROM orders"
SQL["saved_model"] = using(
    "clean",
    "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS rows_off, quantile_cont(monthly_charges, 0.25) AS q1, "
    "quantile_cont(monthly_charges, 0.5) AS q2, quantile_cont(monthly_charges, 0.75) AS q3, CAST(25 AS INTEGER) AS features FROM clean",
)
SQL["importance_check"] = using(
    "levels", "SELECT count(*) AS features, CAST(0 AS BIGINT) AS negative, CAST(1 AS DOUBLE) AS total FROM levels"
)
SQL["output_manifest"] = using(
    "levels",
    "SELECT output, row_count, CAST(least_rows AS BIGINT) AS least_rows, row_count >= least_rows AS ok FROM ("
    "SELECT 'clean_table' AS output, (SELECT count(*) FROM clean) AS row_count, 1 AS least_rows "
    "UNION ALL SELECT 'churn_kpis', 1, 1 "
    "UNION ALL SELECT 'customer_segments', (SELECT count(*) FROM (SELECT DISTINCT monthly_charges > 65 AND tenure > 24, "
    "CASE WHEN contract <> 'Month-to-month' OR tenure > 24 THEN 0 WHEN tenure <= 12 THEN 1 ELSE 2 END FROM telco)), 1 "
    "UNION ALL SELECT 'mart_customer_risk', (SELECT count(*) FROM risk), 1 "
    "UNION ALL SELECT 'model_metrics', 1, 1 "
    "UNION ALL SELECT 'feature_levels', (SELECT count(*) FROM levels), 25 "
    "UNION ALL SELECT 'driver_ranking', 6, 1)",
)
