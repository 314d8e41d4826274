"""DuckDB text of the derived inputs, shared by every oracle query.

``with_ctes(select, extra)`` prefixes a query with the ``contacts`` / ``ratings`` / ``scored``
common table expressions so a query body can name them like tables.
"""

from __future__ import annotations

CONTACTS_CTES = """
li AS (
  SELECT l_orderkey, count(*) AS campaign, sum(l_quantity) AS duration,
         avg(l_discount) AS euribor3m, avg(l_tax) AS emp_var_rate
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey AS contact_id, o.o_custkey, o.o_orderdate,
         c.c_mktsegment AS job, o.o_orderstatus AS marital, r.r_name AS education, n.n_name AS nation,
         lower(strftime(o.o_orderdate, '%b')) AS month, lower(strftime(o.o_orderdate, '%a')) AS day_of_week,
         c.c_acctbal AS cons_conf_idx, o.o_totalprice AS nr_employed,
         coalesce(li.campaign, 0) AS campaign, li.duration, li.euribor3m, li.emp_var_rate,
         CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderstatus <> 'F' THEN 'yes' ELSE 'no' END AS y
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
w AS (
  SELECT *,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, contact_id) - 1 AS previous,
    lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, contact_id) AS pd,
    lag(y) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, contact_id) AS py
  FROM b),
contacts AS (
  SELECT contact_id, job, marital, education, nation, month, day_of_week,
    CASE WHEN py IS NULL THEN 'nonexistent' WHEN py = 'yes' THEN 'success' ELSE 'failure' END AS poutcome,
    duration, CAST(campaign AS BIGINT) AS campaign,
    CAST(CASE WHEN pd IS NULL THEN 999 ELSE least(date_diff('day', pd, o_orderdate), 998) END AS BIGINT) AS pdays,
    CAST(previous AS BIGINT) AS previous, emp_var_rate, cons_conf_idx, euribor3m, nr_employed, y
  FROM w),
scored AS (
  SELECT contact_id,
    CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
    CASE WHEN marital <> 'F' AND pdays < 200 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
    nr_employed / 500000.0 AS score
  FROM contacts),
ratings AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS userId, CAST(l.l_partkey AS VARCHAR) AS itemId,
         sum(l.l_quantity) AS rating
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_custkey, l.l_partkey)
"""


def with_ctes(select: str, extra: str = "") -> str:
    """``WITH <derived inputs>[, <extra>] <select>``."""
    ctes = CONTACTS_CTES.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{select.strip()}"


def md5_unit(expr: str, seed: int) -> str:
    """DuckDB twin of ``functions.hashing.hash_unit``: a value in [0, 1) from md5 of seed:key."""
    return (f"(CAST(('0x' || substr(md5('{seed}:' || CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")
