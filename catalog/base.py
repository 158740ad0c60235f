"""Registry of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    "panel": """
SELECT CAST((center_id*1000+t)*10+meal_id AS BIGINT) AS id, t AS week, center_id, meal_id,
       CAST(round(min(l_extendedprice)*100) AS BIGINT) AS checkout_price,
       CAST(round(max(l_extendedprice)*100) AS BIGINT) AS base_price,
       CAST(max(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS INT) AS emailer_for_promotion,
       CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS homepage_featured,
       CAST(sum(l_quantity) AS BIGINT) AS num_orders
FROM (SELECT l.*, CAST(l_suppkey AS BIGINT) AS center_id,
             CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                              WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS INT) AS meal_id,
             CAST((year(l_shipdate)-1995)*12 + month(l_shipdate) AS INT) AS t
      FROM lineitem l JOIN part ON l_partkey = p_partkey) x
GROUP BY t, center_id, meal_id""",
    "center_info": """
SELECT CAST(s_suppkey AS BIGINT) AS center_id, s_nationkey AS city_code, n_regionkey AS region_code,
       CASE WHEN s_acctbal < 2000 THEN 'TYPE_A' WHEN s_acctbal < 6000 THEN 'TYPE_B' ELSE 'TYPE_C' END AS center_type,
       s_acctbal AS op_area
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "meal_info": """
SELECT * FROM (VALUES (1,'Core','ECONOMY'),(2,'Size','LARGE'),(3,'Size','MEDIUM'),
                      (4,'Deal','PROMO'),(5,'Size','SMALL'),(6,'Core','STANDARD')) AS m(meal_id, category, cuisine)""",
    "history": "SELECT * FROM panel WHERE week <= 73",
    "future": "SELECT * REPLACE (CAST(NULL AS BIGINT) AS num_orders) FROM panel WHERE week > 73",
    "truth": "SELECT id, num_orders FROM panel WHERE week > 73",
    "full_panel": "SELECT * REPLACE (CASE WHEN week <= 73 THEN num_orders END AS num_orders) FROM panel",
    "enriched": """
SELECT p.*, city_code, region_code, center_type, op_area, category, cuisine
FROM panel p JOIN center_info USING (center_id) JOIN meal_info USING (meal_id)""",
    "baseline": """
SELECT f.id, f.week, f.center_id, f.meal_id, m.forecast
FROM future f LEFT JOIN (SELECT center_id, meal_id, avg(num_orders) AS forecast FROM history GROUP BY ALL) m
  USING (center_id, meal_id)""",
    "scored": "SELECT b.*, t.num_orders AS actual FROM baseline b JOIN truth t USING (id)",
    "folds": "SELECT CAST(k AS BIGINT) AS fold, 23 + 10 * k AS start FROM range(5) r(k)",
    "foldrows": """
SELECT h.*, fold, CASE WHEN week <= start THEN 'train' ELSE 'test' END AS role
FROM history h JOIN folds ON week <= start OR (week > start AND week <= start + 10)""",
    "cvrows": """
SELECT f.fold, f.id, CAST(f.num_orders AS DOUBLE) AS actual, m.forecast
FROM foldrows f JOIN (SELECT fold, center_id, meal_id, avg(num_orders) AS forecast FROM foldrows
                      WHERE role = 'train' GROUP BY ALL) m USING (fold, center_id, meal_id)
WHERE f.role = 'test'""",
}


def sql_with(*views: str, body: str) -> str:
    """A statement that defines the named views, and those they use, before its body."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS:
            if other != name and other not in needed and f" {other}" in VIEWS[name].replace("\n", " "):
                words = VIEWS[name].replace("\n", " ").replace("(", " ").replace(")", " ").split()
                if other in words:
                    need(other)
        if name not in needed:
            needed.append(name)

    for view in views:
        need(view)
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed) + "\n" + body


def query(name: str, *views: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql_with(*views, body=sql) if views else sql
        return fn

    return register
