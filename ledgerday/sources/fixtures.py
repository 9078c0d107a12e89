"""Test inputs: the ledger, contact and send-log views over the driver's tables.

Each view is SQL that Spark and DuckDB both accept unchanged.  Table names
are ``{placeholders}``: Spark binds them to DataFrames through
``spark.sql(text, **frames)``, the DuckDB oracle replaces them by view names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerday.params import Items
from ledgerday.schemas import conform_contacts, conform_ledger, conform_send_log

# Codes of the fixture, standing in for the real item names.
FIXTURE_ITEMS = Items(coal="MEDIUM", maize="STANDARD", ethanol="LARGE", scrap=("SMALL", "COMMERCIAL SCRAP"))

LEDGER_SQL = """
SELECT
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey END AS vrno,
  CAST(l_shipdate AS DATE) AS vrdate,
  CASE l_linestatus WHEN 'O' THEN 'S' ELSE 'Q' END AS tcode,
  CASE l_partkey % 4 WHEN 1 THEN lower(p_type) WHEN 2 THEN concat(p_type, ' ') ELSE p_type END AS item_name,
  CASE WHEN l_suppkey % 37 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'SR'
       WHEN l_returnflag = 'A' THEN 'FG' ELSE 'RM' END AS item_nature,
  CASE p_size % 3 WHEN 0 THEN 'KGS' WHEN 1 THEN 'kgs' ELSE 'LTR' END AS um,
  CASE WHEN p_size = 13 THEN NULL WHEN p_size % 3 = 0 THEN 'KGS'
       WHEN p_size % 3 = 1 THEN 'kgs' ELSE 'LTR' END AS aum,
  CAST(CASE WHEN l_linenumber % 4 = 0 THEN 0 ELSE l_quantity END AS DECIMAL(18,3)) AS qtyissued,
  CAST(CASE WHEN l_linenumber % 4 = 1 THEN 0 ELSE l_quantity END AS DECIMAL(18,3)) AS qtyrecd,
  CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS DECIMAL(18,3)) AS aqtyissued,
  CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 50 = 0 THEN 'CANCEL PARTY' ELSE c_name END AS acc_name
FROM {lineitem}
JOIN {part} ON l_partkey = p_partkey
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
"""

CONTACTS_SQL = """
SELECT
  CASE c_nationkey % 3 WHEN 0 THEN 'Coal Availability (Email) '
       WHEN 1 THEN 'Maize Availability (Email)' ELSE 'MIS Email Monthly' END AS report_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN ''
       ELSE concat(lower(c_mktsegment), CAST(c_custkey AS STRING), '@example.com') END AS email,
  c_nationkey % 3 = 0 AND c_custkey % 2 = 0 AS coal_avail_email,
  c_nationkey % 3 = 1 AND c_custkey % 2 = 0 AS maize_avail_email,
  c_nationkey % 3 = 2 AND c_custkey % 2 = 0 AS mis_email_monthly,
  c_custkey % 5 = 0 AS is_cc,
  c_custkey % 7 = 0 AS is_bcc
FROM {customer}
"""

SEND_LOG_SQL = """
SELECT
  CASE WHEN event_type IN ('click', 'view') THEN 'email' ELSE 'whatsapp' END AS channel,
  CAST(concat('1998-03-', lpad(CAST(day(ts) AS STRING), 2, '0')) AS DATE) AS sent_date,
  min(event_id) AS seq
FROM {events}
GROUP BY 1, 2
HAVING count_if(event_type IN ('click', 'purchase')) > count_if(event_type IN ('view', 'signup'))
"""

VIEWS = {"ledger": LEDGER_SQL, "report_contacts": CONTACTS_SQL, "send_log": SEND_LOG_SQL}

# Parameters of the fixture's check figures.
REPORT_DATE = "1998-03-17"
ENTRY_DATE = "1998-03-31"
TODAY = "1998-03-20"
FIXTURE_RETENTION = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {t: _table(spark, sf_dir, t) for t in ("lineitem", "part", "orders", "customer")}
    return conform_ledger(spark.sql(LEDGER_SQL, **frames))


def fixture_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_contacts(spark.sql(CONTACTS_SQL, customer=_table(spark, sf_dir, "customer")))


def fixture_send_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_send_log(spark.sql(SEND_LOG_SQL, events=_table(spark, sf_dir, "events")))


def duckdb_prelude(names: tuple[str, ...] = ("ledger", "report_contacts", "send_log")) -> str:
    """``WITH`` clause defining the views over DuckDB's pre-registered tables."""
    plain = {t: t for t in ("lineitem", "part", "orders", "customer", "events")}
    body = ",\n".join(f"{n} AS ({VIEWS[n].format(**plain).strip()})" for n in names)
    return f"WITH {body}\n"
