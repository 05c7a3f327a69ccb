"""``reviews_raw``: a dirty review table derived from ``lineitem`` and ``part``.

The fixture tables hold no nulls and no duplicate rows, so cleaning and
imputation are exercised on this derived table.  The SQL below is the fixed
fixture text (FIXTURES.md section 2); it is used verbatim on the Spark side and,
with back-ticks turned into double quotes, as the leading CTE of every DuckDB
oracle query.  Its work grows with ``lineitem``: one row per line item plus an
exact copy of about 2.5% of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

# The fixture query, verbatim.
REVIEWS_RAW_SQL = """WITH base AS (
  SELECT l.l_orderkey, l.l_linenumber, p.p_name, p.p_type,
    CAST((l.l_orderkey*7919 + l.l_partkey*104729 + l.l_suppkey*1299709 + l.l_linenumber*15485863) % 1000003 AS INT) AS h1,
    CAST((l.l_orderkey*3571 + l.l_partkey*27644437 + l.l_suppkey*2750159 + l.l_linenumber*86028121) % 999983 AS INT) AS h2,
    CAST((l.l_orderkey*611953 + l.l_partkey*1301081 + l.l_suppkey*49979687 + l.l_linenumber*67867967) % 999979 AS INT) AS h3
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
cat AS (
  SELECT *, CASE h2 % 4 WHEN 0 THEN 'General' WHEN 1 THEN 'General Petite' WHEN 2 THEN 'Initmates' ELSE 'Trend' END AS div0,
    CASE WHEN h3 % 100 < 5 THEN 1 WHEN h3 % 100 < 15 THEN 2 WHEN h3 % 100 < 30 THEN 3 WHEN h3 % 100 < 60 THEN 4 ELSE 5 END AS rat0
  FROM base),
dept AS (
  SELECT *, CASE WHEN div0 = 'Initmates' THEN 'Intimate' WHEN div0 = 'Trend' THEN 'Trend'
    WHEN h1 % 7 < 3 THEN 'Tops' WHEN h1 % 7 = 3 THEN 'Dresses' WHEN h1 % 7 < 6 THEN 'Bottoms' ELSE 'Jackets' END AS dep0
  FROM cat),
rows1 AS (
  SELECT h1,
    CASE WHEN h1 % 33 = 0 THEN NULL WHEN h1 % 97 = 1 THEN -1 WHEN h1 % 101 = 2 THEN 100 ELSE 18 + h2 % 53 END AS `Age`,
    CASE WHEN h2 % 100 = 1 THEN NULL ELSE concat('Great ', p_name, '!') END AS `Title`,
    concat('The ', p_name, ' is ', p_type) AS `Review Text`,
    CASE WHEN h1 % 20 = 3 THEN NULL WHEN h1 % 89 = 4 THEN 0 WHEN h1 % 83 = 5 THEN 6 ELSE rat0 END AS `Rating`,
    CASE WHEN h2 % 211 = 6 THEN NULL WHEN h2 % 199 = 7 THEN 2
         WHEN rat0 >= 4 THEN CASE WHEN h2 % 10 < 9 THEN 1 ELSE 0 END
         WHEN rat0 = 3 THEN h2 % 2
         ELSE CASE WHEN h2 % 10 < 1 THEN 1 ELSE 0 END END AS `Recommended IND`,
    CASE WHEN rat0 >= 4 THEN h1 % 26 ELSE h1 % 6 END AS `Positive Feedback Count`,
    CASE WHEN h3 % 50 = 7 THEN NULL ELSE div0 END AS `Division Name`,
    CASE WHEN h3 % 61 = 8 THEN NULL ELSE dep0 END AS `Department Name`,
    CASE dep0 WHEN 'Intimate' THEN CASE WHEN h3 % 2 = 0 THEN 'Intimates' ELSE 'Sleep' END
      WHEN 'Trend' THEN 'Trend' WHEN 'Tops' THEN CASE WHEN h3 % 2 = 0 THEN 'Blouses' ELSE 'Sweaters' END
      WHEN 'Dresses' THEN 'Dresses'
      WHEN 'Bottoms' THEN CASE h3 % 4 WHEN 0 THEN 'Pants' WHEN 1 THEN 'Skirts' WHEN 2 THEN 'Jeans' ELSE 'Shorts' END
      ELSE 'Jackets' END AS `Class Name`
  FROM dept),
raw AS (SELECT * FROM rows1 UNION ALL SELECT * FROM rows1 WHERE h1 % 40 = 11)
SELECT `Age`,`Title`,`Review Text`,`Rating`,`Recommended IND`,`Positive Feedback Count`,`Division Name`,`Department Name`,`Class Name` FROM raw"""


def reviews_raw_duckdb_sql() -> str:
    """The same fixture text in DuckDB's identifier quoting."""
    return REVIEWS_RAW_SQL.replace("`", '"')


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty review table over ``sf_dir``'s ``lineitem`` and ``part``.

    The two tables are bound as DataFrame parameters, so no session-wide view
    is created.  Catalyst prunes both scans to the five columns the query uses;
    the join is left to the planner (AQE picks broadcast or shuffle at run time
    from the real size of ``part``).
    """
    sql = REVIEWS_RAW_SQL.replace("FROM lineitem l JOIN part p", "FROM {lineitem} l JOIN {part} p")
    return spark.sql(
        sql,
        lineitem=read_table(spark, sf_dir, "lineitem"),
        part=read_table(spark, sf_dir, "part"),
    )
