"""Quality rules, lineage, lifecycle and metrics as queries."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.governance import catalogue, lifecycle, lineage, metrics, quality
from strata.governance.quality import Rule
from strata.queries.registry import query
from strata.session import shared_folder

TODAY = "2025-01-01"
RULES = [
    Rule("orders_rows", "orders", "ROW_COUNT", least=1, severity="BLOCKER"),
    Rule("orders_unique", "orders", "UNIQUE", ("o_orderkey",), severity="BLOCKER"),
    Rule("lineitem_unique", "lineitem", "UNIQUE", ("l_orderkey", "l_linenumber")),
    Rule("customer_not_null", "customer", "NOT_NULL", ("c_name",)),
    Rule("quantity_range", "lineitem", "RANGE", ("l_quantity",), least=1, most=40),
    Rule("events_fresh", "events", "FRESHNESS", ("ts",), most=400),
    Rule("lineitem_part", "lineitem", "REFERENTIAL", ("l_partkey",), parent="small_part", parent_column="p_partkey"),
    Rule("no_such_column", "orders", "NOT_NULL", ("nothing",)),
]
BY_NAME = {r.name: r for r in RULES}


def tables(t) -> dict[str, DataFrame]:
    return {"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer, "events": t.events, "small_part": t.part.where("p_size <= 25")}


def one(t, name: str) -> DataFrame:
    rule = BY_NAME[name]
    return tables(t)[rule.table].agg(quality.metric(rule, TODAY).alias("value"))


@query("SELECT count(*)::DOUBLE AS value FROM orders")
def dq_row_count(spark, t) -> DataFrame:
    return one(t, "orders_rows")


@query("SELECT (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::DOUBLE AS value FROM lineitem")
def dq_unique(spark, t) -> DataFrame:
    return one(t, "lineitem_unique")


@query("SELECT (count(*) FILTER (c_name IS NULL) / greatest(count(*), 1))::DOUBLE AS value FROM customer")
def dq_not_null(spark, t) -> DataFrame:
    return one(t, "customer_not_null")


@query("SELECT (count(*) FILTER (l_quantity IS NOT NULL AND (l_quantity < 1 OR l_quantity > 40)))::DOUBLE AS value FROM lineitem")
def dq_range(spark, t) -> DataFrame:
    return one(t, "quantity_range")


@query(f"SELECT date_diff('day', max(ts)::DATE, DATE '{TODAY}')::DOUBLE AS value FROM events")
def dq_freshness(spark, t) -> DataFrame:
    return one(t, "events_fresh")


@query("SELECT count(*) AS orphans FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25)")
def dq_referential(spark, t) -> DataFrame:
    own = tables(t)
    return quality.orphans(own["lineitem"], "l_partkey", own["small_part"], "p_partkey").agg(F.count(F.lit(1)).alias("orphans"))


@query(f"""WITH v AS (
  SELECT 'orders_rows' AS rule, 'BLOCKER' AS severity, count(*)::DOUBLE AS value, count(*) >= 1 AS passed FROM orders
  UNION ALL SELECT 'orders_unique', 'BLOCKER', (count(*) - count(DISTINCT o_orderkey))::DOUBLE, count(*) = count(DISTINCT o_orderkey) FROM orders
  UNION ALL SELECT 'lineitem_unique', 'WARN', (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::DOUBLE, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
  UNION ALL SELECT 'customer_not_null', 'WARN', (count(*) FILTER (c_name IS NULL) / greatest(count(*), 1))::DOUBLE, count(*) FILTER (c_name IS NULL) = 0 FROM customer
  UNION ALL SELECT 'quantity_range', 'WARN', (count(*) FILTER (l_quantity < 1 OR l_quantity > 40))::DOUBLE, count(*) FILTER (l_quantity < 1 OR l_quantity > 40) = 0 FROM lineitem
  UNION ALL SELECT 'events_fresh', 'WARN', date_diff('day', max(ts)::DATE, DATE '{TODAY}')::DOUBLE, date_diff('day', max(ts)::DATE, DATE '{TODAY}') <= 400 FROM events
  UNION ALL SELECT 'lineitem_part', 'WARN', count(*)::DOUBLE, count(*) = 0 FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
  UNION ALL SELECT 'no_such_column', 'WARN', NULL, false) SELECT * FROM v""")
def dq_report(spark, t) -> DataFrame:
    """All rules at once; one cannot be measured, which fails that rule alone."""
    return quality.measure(spark, tables(t), RULES, TODAY).drop("error")


#: What follows what: orders, customers, nations, regions; and some nations follow their region, which makes cycles.
EDGE_SQL = """edges(source, target) AS (
  SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation WHERE n_nationkey % 3 = 0)"""


def closure(start: str, a: str, b: str) -> str:
    return f"WITH RECURSIVE {EDGE_SQL}, r(tbl, steps) AS (SELECT {b}, 1 FROM edges WHERE {a} = '{start}' UNION SELECT {b}, steps + 1 FROM r JOIN edges ON {a} = tbl WHERE steps < 12) SELECT tbl AS \"table\", min(steps)::INT AS steps FROM r GROUP BY 1"


def edges(t) -> DataFrame:
    pair = lambda rows, a, b, x, y: rows.select(F.concat(F.lit(a), x).alias("source"), F.concat(F.lit(b), y).alias("target"))
    rows = pair(t.orders, "o", "c", "o_orderkey", "o_custkey").unionByName(pair(t.customer, "c", "n", "c_custkey", "c_nationkey"))
    rows = rows.unionByName(pair(t.nation, "n", "r", "n_nationkey", "n_regionkey"))
    return rows.unionByName(pair(t.nation.where("n_nationkey % 3 = 0"), "r", "n", "n_regionkey", "n_nationkey"))


@query(closure("o1", "source", "target"))
def lineage_downstream(spark, t) -> DataFrame:
    return lineage.reachable(edges(t), "o1")


@query(closure("n3", "target", "source"))
def lineage_upstream(spark, t) -> DataFrame:
    """From a nation on a cycle, which reaches itself."""
    return lineage.reachable(edges(t), "n3", down=False)


@query("WITH " + EDGE_SQL + ' SELECT source AS "table" FROM edges UNION SELECT target FROM edges')
def lineage_tables(spark, t) -> DataFrame:
    return lineage.tables(edges(t))


@query("""SELECT 'c' || c_custkey AS source, 'n' || c_nationkey AS target, f AS source_column, g AS target_column, 'DECLARED' AS origin
FROM (SELECT c_custkey, c_nationkey, unnest(CASE WHEN c_custkey % 3 = 0 THEN [NULL] WHEN c_custkey % 3 = 1 THEN ['c_name'] ELSE ['c_name', 'c_acctbal'] END) AS f,
  unnest(CASE WHEN c_custkey % 3 = 0 THEN [NULL] WHEN c_custkey % 3 = 1 THEN ['n_name'] ELSE ['n_name', 'n_total'] END) AS g FROM customer)""")
def lineage_columns(spark, t) -> DataFrame:
    """Declared pairs of columns; an edge without any has one row."""
    k, pair = F.col("c_custkey") % 3, lambda a, b: F.struct(F.lit(a).alias("from"), F.lit(b).alias("to"))
    columns = F.when(k == 1, F.array(pair("c_name", "n_name"))).when(k == 2, F.array(pair("c_name", "n_name"), pair("c_acctbal", "n_total")))
    return lineage.column_rows(t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("source"), F.concat(F.lit("n"), "c_nationkey").alias("target"), columns.alias("columns")))


POLICIES = [("click", 60, 300), ("view", 10, 340), ("purchase", 400, 900)]
POLICY_SQL = "policies(tbl, cold_days, keep_days) AS (VALUES " + ", ".join(map(str, POLICIES)) + ")"


@query(f"""WITH {POLICY_SQL}, p AS (SELECT DISTINCT event_type AS tbl, ts::DATE AS dt FROM events), d AS (
  SELECT tbl, dt, CASE WHEN last_day(dt) < DATE '{TODAY}' - keep_days THEN 'DROP' WHEN dt < DATE '{TODAY}' - cold_days THEN 'COLD' ELSE 'KEEP' END AS action, (DATE '{TODAY}' - keep_days) AS cutoff FROM p JOIN policies USING (tbl))
SELECT tbl AS "table", dt, action, cutoff FROM d WHERE action <> 'KEEP'""")
def lifecycle_plan(spark, t) -> DataFrame:
    partitions = t.events.select(F.col("event_type").alias("table"), F.to_date("ts").alias("dt")).distinct()
    policies = spark.createDataFrame(POLICIES, "table string, cold_days int, keep_days int")
    return lifecycle.plan(partitions, policies, TODAY)


@query("SELECT event_type AS \"table\", count(DISTINCT ts::DATE) AS files, count(*) AS \"rows\", min(ts::DATE) AS first_dt, max(ts::DATE) AS last_dt, TRUE AS has_bytes FROM events GROUP BY 1")
def partition_usage(spark, t) -> DataFrame:
    """Tables of events by type, a file a day: what their listing and their footers say."""
    base = f"{shared_folder(spark)}/usage-{uuid.uuid4()}"
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("dt"))
    rows.repartition("event_type", "dt").write.partitionBy("event_type", "dt").parquet(base)
    types = [r[0] for r in rows.select("event_type").distinct().collect()]  # a row a table
    files = functools.reduce(DataFrame.unionByName, [catalogue.files(spark, f"{base}/event_type={k}", k) for k in sorted(types)])
    return lifecycle.partition_usage(files).select("table", "files", "rows", "first_dt", "last_dt", (F.col("bytes") > 0).alias("has_bytes"))


@query("SELECT l_returnflag, round(sum(round(l_extendedprice * 100)::BIGINT) / sum(round(l_quantity)::BIGINT), 6) AS price_per_unit FROM lineitem GROUP BY 1")
def metric_registry_eval(spark, t) -> DataFrame:
    registry = metrics.Registry()
    registry.add(metrics.Metric("price_per_unit", "lineitem",
        "round(sum(cast(round(l_extendedprice * 100) as bigint)) / sum(cast(round(l_quantity) as bigint)), 6)", ("l_returnflag",)))
    return registry.evaluate("price_per_unit", {"lineitem": t.lineitem})
