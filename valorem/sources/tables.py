"""Driver tables and the canonical master view derived from them.

The master table (21 columns, one row per entity) is derived from the
order tables so that every operator of the library runs on data whose size
grows with the input:

    lineitem --(partial agg per order)--> per_order
    per_order JOIN orders ON orderkey --(agg per customer)--> per_entity
    per_entity JOIN customer JOIN nation  --> master

Column mapping (entity = customer):

=====================  ===================================================
Name                   c_name
Age                    number of orders with at least one line
Overall rating         number of lines
Potential              total quantity
Team                   n_name (via c_nationkey)
ID                     c_custkey as string
Value                  sum(l_extendedprice), rounded to cents
Wage                   c_acctbal (negative for some entities)
Total attacking        lines with return flag R
Total skill            lines with return flag A
Total movement         open lines (line status O)
Total power            round(100 * sum(l_discount))
Total mentality        round(100 * sum(l_tax))
Total defending        orders with priority 1-URGENT or 2-HIGH
Total goalkeeping      orders with status F
Pace / Diving          largest line quantity
Shooting / Handling    smallest line quantity
Passing / Kicking      orders with status O
Dribbling / Reflexes   orders with status P
Defending / Pace       lines with return flag N
Position category      position code from c_mktsegment, categorised
=====================  ===================================================

Plan shape: lineitem is aggregated per order *before* any join (map-side
partial aggregation collapses hot orders), the order join is 1:1 on the
order key, the customer join is 1:1 after the per-customer aggregate, and
nation is broadcast only after its size is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valorem.functions import clean

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# FIXED VALUES: market segment -> position code of the derived master view.
SEGMENT_POSITION = [("AUTOMOBILE", "ST"), ("BUILDING", "CM"), ("FURNITURE", "CB"),
                    ("MACHINERY", "GK"), ("HOUSEHOLD", "RES")]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _position_code(segment: F.Column) -> F.Column:
    expr = None
    for seg, code in SEGMENT_POSITION:
        expr = F.when(segment == seg, F.lit(code)) if expr is None else expr.when(segment == seg, F.lit(code))
    return expr.otherwise(F.lit("RES"))


def master(spark: SparkSession, sf_dir: str, orders_since: str | None = None) -> DataFrame:
    """The 21-column master view, in ``MASTER_COLUMNS`` order.

    ``orders_since`` ('YYYY-MM-DD') restricts it to orders from that date on —
    a later, partial snapshot of the same entities (the upsert's new batch).
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    if orders_since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(orders_since).cast("timestamp_ntz"))
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")

    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("v"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.max("l_quantity").alias("qty_max"),
        F.min("l_quantity").alias("qty_min"),
        F.sum("l_discount").alias("disc"),
        F.sum("l_tax").alias("tax"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_r"),
        F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
        F.count_if(F.col("l_returnflag") == "N").alias("n_n"),
        F.count_if(F.col("l_linestatus") == "O").alias("n_open"),
    )
    per_entity = (
        per_order.join(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
                       per_order.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("v").alias("v"),
            F.sum("n_lines").alias("n_lines"),
            F.sum("qty").alias("qty"),
            F.max("qty_max").alias("qty_max"),
            F.min("qty_min").alias("qty_min"),
            F.sum("disc").alias("disc"),
            F.sum("tax").alias("tax"),
            F.sum("n_r").alias("n_r"),
            F.sum("n_a").alias("n_a"),
            F.sum("n_n").alias("n_n"),
            F.sum("n_open").alias("n_open"),
            F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("urgent"),
            F.count_if(F.col("o_orderstatus") == "F").alias("st_f"),
            F.count_if(F.col("o_orderstatus") == "O").alias("st_o"),
            F.count_if(F.col("o_orderstatus") == "P").alias("st_p"),
        )
    )
    cust = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nat = nation.select("n_nationkey", "n_name")  # the planner broadcasts it by its measured size
    j = (per_entity.join(cust, per_entity.o_custkey == cust.c_custkey)
         .join(nat, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    i = lambda c: F.col(c).cast("int")
    return j.select(
        F.col("c_name").alias("Name"),
        i("n_orders").alias("Age"),
        i("n_lines").alias("Overall rating"),
        i("qty").alias("Potential"),
        F.col("n_name").alias("Team"),
        F.col("c_custkey").cast("string").alias("ID"),
        F.round("v", 2).alias("Value"),
        F.col("c_acctbal").cast("double").alias("Wage"),
        i("n_r").alias("Total attacking"),
        i("n_a").alias("Total skill"),
        i("n_open").alias("Total movement"),
        F.round(F.col("disc") * 100).cast("int").alias("Total power"),
        F.round(F.col("tax") * 100).cast("int").alias("Total mentality"),
        i("urgent").alias("Total defending"),
        i("st_f").alias("Total goalkeeping"),
        i("qty_max").alias("Pace / Diving"),
        i("qty_min").alias("Shooting / Handling"),
        i("st_o").alias("Passing / Kicking"),
        i("st_p").alias("Dribbling / Reflexes"),
        i("n_n").alias("Defending / Pace"),
        clean.position_category(_position_code(F.col("c_mktsegment"))).alias("Position category"),
    )


_MATERIALIZED: dict = {}


def master_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master view written once as a parquet table in the shared
    checkpoint folder, then read back (column pruning and pushdown apply).

    Multi-pass operators (statistics first, then a pass that uses them) read
    this table instead of re-aggregating ``lineitem`` in every pass; the data
    survive executor loss. Written once per session and input folder;
    ``forget`` after the input files changed.
    """
    from valorem.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _MATERIALIZED.get(key)
    if path is None:
        path = scratch_path(spark, "master")
        master(spark, sf_dir).write.mode("overwrite").parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)


def forget() -> None:
    """Drops what this session remembers of input folders: master tables and fitted models."""
    from valorem.plans import train
    _MATERIALIZED.clear()
    train._CACHE.clear()  # noqa: SLF001


# Same view for the DuckDB oracle (tables are pre-registered views there).
def master_sql(name: str = "master", orders_since: str | None = None) -> str:
    """CTE list defining ``name`` as the master view (helper CTEs are suffixed)."""
    where = f"WHERE o_orderdate >= TIMESTAMP '{orders_since}'" if orders_since else ""
    return f"""
per_order_{name} AS (
  SELECT l_orderkey, sum(l_extendedprice) AS v, count(*) AS n_lines, sum(l_quantity) AS qty,
         max(l_quantity) AS qty_max, min(l_quantity) AS qty_min,
         sum(l_discount) AS disc, sum(l_tax) AS tax,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_r,
         count(*) FILTER (WHERE l_returnflag = 'A') AS n_a,
         count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
         count(*) FILTER (WHERE l_linestatus = 'O') AS n_open
  FROM lineitem GROUP BY l_orderkey
),
per_entity_{name} AS (
  SELECT o_custkey, count(*) AS n_orders, sum(v) AS v, sum(n_lines) AS n_lines, sum(qty) AS qty,
         max(qty_max) AS qty_max, min(qty_min) AS qty_min, sum(disc) AS disc, sum(tax) AS tax,
         sum(n_r) AS n_r, sum(n_a) AS n_a, sum(n_n) AS n_n, sum(n_open) AS n_open,
         count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS urgent,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS st_f,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS st_o,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS st_p
  FROM per_order_{name} JOIN (SELECT * FROM orders {where}) o ON l_orderkey = o_orderkey
  GROUP BY o_custkey
),
{name} AS (
  SELECT c_name AS "Name", CAST(n_orders AS INTEGER) AS "Age", CAST(n_lines AS INTEGER) AS "Overall rating",
         CAST(qty AS INTEGER) AS "Potential", n_name AS "Team", CAST(c_custkey AS VARCHAR) AS "ID",
         round(v, 2) AS "Value", CAST(c_acctbal AS DOUBLE) AS "Wage",
         CAST(n_r AS INTEGER) AS "Total attacking", CAST(n_a AS INTEGER) AS "Total skill",
         CAST(n_open AS INTEGER) AS "Total movement", CAST(round(disc * 100) AS INTEGER) AS "Total power",
         CAST(round(tax * 100) AS INTEGER) AS "Total mentality", CAST(urgent AS INTEGER) AS "Total defending",
         CAST(st_f AS INTEGER) AS "Total goalkeeping", CAST(qty_max AS INTEGER) AS "Pace / Diving",
         CAST(qty_min AS INTEGER) AS "Shooting / Handling", CAST(st_o AS INTEGER) AS "Passing / Kicking",
         CAST(st_p AS INTEGER) AS "Dribbling / Reflexes", CAST(n_n AS INTEGER) AS "Defending / Pace",
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'attaquant' WHEN 'BUILDING' THEN 'milieu'
              WHEN 'FURNITURE' THEN 'défenseur' WHEN 'MACHINERY' THEN 'gardien' ELSE 'res' END
           AS "Position category"
  FROM per_entity_{name} JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
)"""


MASTER_SQL = master_sql()
