"""Bridge views: the churn data model derived from the generic test tables.

The driver's tables (``customer``, ``orders``) carry no churn schema, so two
views derive one from them: ``subscribers`` (the 23 raw columns, with
typos, nulls, odd tenures and outliers built in) and ``scored``
(``row_id, y, p``, a deterministic score table with ties).  The SQL text is
a test-input specification; the *same* text runs in Spark and in the DuckDB
oracle, so each side starts from identical rows.

Work grows with the input: one partial aggregate of ``orders`` by customer
key, then a join on that key (AQE picks sort-merge or broadcast).  Every
customer is a row; one without orders has churned and has no spend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SUBSCRIBERS_SQL = """SELECT concat('ACC', CAST(c_custkey AS VARCHAR(20))) AS account_id,
 CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
 CASE WHEN c_custkey % 6 = 1 THEN 1 ELSE 0 END AS seniorcitizen,
 CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner,
 CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS dependents,
 CASE WHEN c_custkey % 20 = 7 THEN NULL WHEN c_custkey % 140 = 10 THEN CAST(120 AS DOUBLE) ELSE CAST((c_custkey * 7) % 73 AS DOUBLE) END AS months_with_provider,
 CASE WHEN c_custkey % 10 = 9 THEN 'No' ELSE 'Yes' END AS phone_service,
 CASE WHEN c_custkey % 10 = 9 THEN 'No phone service' WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS extra_lines,
 CASE c_custkey % 50 WHEN 1 THEN 'Fiber optiic' WHEN 2 THEN 'iFber optic' WHEN 3 THEN 'Fibe optic' WHEN 8 THEN NULL ELSE CASE c_nationkey % 5 WHEN 0 THEN 'No' WHEN 1 THEN 'DSL' WHEN 2 THEN 'DSL' ELSE 'Fiber optic' END END AS internet_plan,
 CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS addon_security,
 CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_custkey % 11 < 5 THEN 'Yes' ELSE 'No' END AS addon_backup,
 CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS addon_device_protect,
 CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_custkey % 17 < 6 THEN 'Yes' ELSE 'No' END AS addon_techsupport,
 CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_custkey % 4 < 2 THEN 'Yes' ELSE 'No' END AS stream_tv,
 CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_custkey % 9 < 5 THEN 'Yes' ELSE 'No' END AS stream_movies,
 CASE WHEN c_custkey % 40 = 4 THEN NULL ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'One year' WHEN 'BUILDING' THEN 'Two year' ELSE 'Month-to-month' END END AS contract_type,
 CASE WHEN c_custkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS paperless_billing,
 CASE WHEN c_custkey % 10 = 3 THEN NULL WHEN c_custkey % 100 = 5 THEN 'NAN' WHEN c_custkey % 100 = 6 THEN '  ELECTRONIC CHECK ' ELSE CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END END AS payment_method,
 CASE WHEN c_custkey % 97 = 0 THEN CAST(417.5 AS DOUBLE) ELSE CAST(18.25 AS DOUBLE) + (c_acctbal + CAST(1000 AS DOUBLE)) / CAST(109 AS DOUBLE) END AS monthly_fee,
 CASE WHEN c_custkey % 8 = 5 THEN NULL ELSE CAST(spend AS DOUBLE) / CAST(5000 AS DOUBLE) END AS lifetime_spend,
 CASE WHEN last_ts >= TIMESTAMP '2001-01-01 00:00:00' THEN 0 ELSE 1 END AS churned,
 md5(CAST(c_custkey AS VARCHAR(20))) AS customer_hash,
 CASE WHEN c_custkey % 10 < 3 THEN 1 ELSE 0 END AS marketing_opt_in
FROM {customer} LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_ts, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey"""

SCORED_SQL = """SELECT c_custkey AS row_id,
 CASE WHEN last_ts >= TIMESTAMP '2001-01-01 00:00:00' THEN 0 ELSE 1 END AS y,
 CAST(((25 - coalesce(n_orders, 0)) * 32 + (c_custkey * 37) % 200) AS DOUBLE) / CAST(1000 AS DOUBLE) AS p
FROM {customer} LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_ts, count(*) AS n_orders FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey"""

# Same text with the row key kept: ``row_id`` is the customer key, used for
# deterministic ordering, splitting and joining scores back.
SUBSCRIBERS_KEYED_SQL = SUBSCRIBERS_SQL.replace(
    "SELECT concat('ACC'", "SELECT c_custkey AS row_id, concat('ACC'", 1)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _spark_refs(sf_dir: str) -> dict[str, str]:
    return {t: f"parquet.`{table_path(sf_dir, t)}`" for t in ("customer", "orders")}


_VIEWS: dict[tuple, DataFrame] = {}


def _view(spark: SparkSession, text: str, sf_dir: str) -> DataFrame:
    """The analysed view, built once per session and folder (file listing
    and footer reads happen once; nothing is cached in memory)."""
    key = (id(spark), spark.sparkContext.applicationId, text, sf_dir)
    if key not in _VIEWS:
        _VIEWS[key] = spark.sql(text.format(**_spark_refs(sf_dir)))
    return _VIEWS[key]


def subscribers(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """The raw 23-column subscriber table (plus ``row_id`` if ``keyed``)."""
    return _view(spark, SUBSCRIBERS_KEYED_SQL if keyed else SUBSCRIBERS_SQL, sf_dir)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score table ``row_id, y, p``."""
    return _view(spark, SCORED_SQL, sf_dir)


def oracle_cte(*views: str) -> str:
    """``WITH`` clause defining the bridge views for the DuckDB oracle."""
    plain = {"customer": "customer", "orders": "orders"}
    text = {
        "subscribers": SUBSCRIBERS_SQL,
        "subscribers_k": SUBSCRIBERS_KEYED_SQL,
        "scored": SCORED_SQL,
    }
    parts = [f"{v} AS ({text[v].format(**plain)})" for v in views]
    return "WITH " + ",\n".join(parts) + "\n"
