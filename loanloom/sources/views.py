"""Raw tables derived from the test tables: orders as applications, their lines as history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_APP = """
SELECT o_orderkey AS SK_ID_CURR,
 CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS TARGET,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN 'XNA' ELSE o_orderpriority END AS ORGANIZATION_TYPE,
 CASE WHEN o_orderkey%11=0 THEN NULL WHEN o_orderkey%2=0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
 CASE WHEN o_orderkey%3=0 THEN 1 ELSE 0 END AS FLAG_MOBIL,
 CAST(o_orderkey%3 AS INT) AS FLAG_DOCUMENT_2,
 o_totalprice AS AMT_INCOME_TOTAL,
 -CAST(7500+o_custkey%15000 AS INT) AS DAYS_BIRTH,
 CASE WHEN o_orderkey%6=0 THEN 365243 WHEN o_orderkey%13=0 THEN NULL
      ELSE {o_orderdate} - 11687 END AS DAYS_EMPLOYED,
 {o_orderdate} - 11687 AS DAYS_REGISTRATION,
 {o_orderdate} - 11700 AS DAYS_ID_PUBLISH,
 -CAST(o_orderkey%4000 AS INT) AS DAYS_LAST_PHONE_CHANGE,
 CASE WHEN o_orderkey%10<7 THEN o_totalprice/1000 END AS LIVINGAREA_MEDI
FROM {orders}
"""

RAW_BUREAU = """
SELECT l_orderkey AS SK_ID_CURR,
 l_orderkey*100+l_linenumber AS SK_ID_BUREAU,
 CASE WHEN l_returnflag='N' THEN 'Active' WHEN l_returnflag='A' THEN 'Closed'
      WHEN l_linestatus='F' THEN 'XNA' WHEN l_linenumber>=4 THEN 'Sold' ELSE 'Frozen' END AS CREDIT_ACTIVE,
 'currency 1' AS CREDIT_CURRENCY,
 {l_shipdate} - 11687 AS DAYS_CREDIT,
 CAST(ROUND(l_tax*100) AS INT) AS CREDIT_DAY_OVERDUE,
 {l_shipdate} - 10407 AS DAYS_CREDIT_ENDDATE,
 CASE WHEN l_returnflag='A' THEN {l_shipdate} - 11687 + l_linenumber END AS DAYS_ENDDATE_FACT,
 CASE WHEN l_tax>0 THEN CAST(ROUND(l_extendedprice*l_tax) AS BIGINT) END AS AMT_CREDIT_MAX_OVERDUE,
 l_linenumber % 3 AS CNT_CREDIT_PROLONG,
 CASE WHEN l_linenumber=7 THEN 0 ELSE CAST(ROUND(l_extendedprice*100) AS BIGINT) END AS AMT_CREDIT_SUM,
 CASE WHEN l_discount>0 THEN CAST(ROUND(l_extendedprice*50) AS BIGINT) END AS AMT_CREDIT_SUM_DEBT,
 CASE WHEN l_linenumber%2=0 THEN CAST(l_quantity AS BIGINT)*100000 ELSE 0 END AS AMT_CREDIT_SUM_LIMIT,
 CAST(ROUND(l_extendedprice*l_tax) AS BIGINT) AS AMT_CREDIT_SUM_OVERDUE,
 CASE WHEN p_brand='Brand#13' THEN ' XNA ' ELSE p_brand END AS CREDIT_TYPE,
 {l_shipdate} - 11687 + CAST(l_suppkey%30 AS INT) AS DAYS_CREDIT_UPDATE,
 CASE WHEN l_quantity>25 THEN CAST(ROUND(l_extendedprice*8) AS BIGINT) END AS AMT_ANNUITY
FROM {lineitem} LEFT JOIN {part} ON l_partkey=p_partkey
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = RAW_APP.replace("{o_orderdate}", "unix_date(CAST(o_orderdate AS DATE))")
    return spark.sql(text, orders=_table(spark, sf_dir, "orders"))


def raw_bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = RAW_BUREAU.replace("{l_shipdate}", "unix_date(CAST(l_shipdate AS DATE))")
    tables = {name: _table(spark, sf_dir, name) for name in ("lineitem", "part")}
    return spark.sql(text, **tables)
