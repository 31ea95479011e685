"""DuckDB (ANSI SQL) twins of the derived datasets, for the oracle check.

``with_fixtures(sql)`` prefixes a query with the CTEs it references, so every
oracle string runs stand-alone on the pre-registered base-table views.  The
expressions repeat ``quarry.sources.fixtures`` one to one; where the engines
differ (DuckDB rounds on double->integer casts, Spark truncates) the SQL
spells out the Spark meaning with ``trunc``.
"""

from __future__ import annotations

import re


def _item(k: str) -> str:
    qty = "(e.event_id % 3 + 1)"
    price = f"(CAST({k} AS DOUBLE) + 0.5)"
    return ("{'coupon': CASE WHEN e.event_id % 10 = 0 THEN 'NEWBED10' END, "
            f"'item_id': CAST({k} AS VARCHAR), 'item_name': 'item ' || CAST({k} AS VARCHAR), "
            f"'item_revenue_in_usd': {price} * {qty}, 'price_in_usd': {price}, "
            f"'quantity': CAST({qty} AS BIGINT)}}")


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "geo": ((), """
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"""),

    "events_nested": (("geo",), f"""
SELECT e.event_id,
  ['macOS', 'Windows', 'iOS', 'Android'][CAST(e.user_id % 4 + 1 AS INTEGER)] AS device,
  {{'purchase_revenue_in_usd': CASE WHEN e.event_type = 'purchase' THEN e.value END,
   'total_item_quantity': CASE WHEN e.event_type = 'purchase' THEN e.user_id % 5 + 1 END,
   'unique_items': CASE WHEN e.event_type = 'purchase' THEN e.event_id % 3 + 1 END}} AS ecommerce,
  e.event_type AS event_name,
  epoch_us(e.ts) AS event_timestamp,
  {{'city': g.n_name, 'state': g.r_name}} AS geo,
  list_slice([{_item('((e.event_id * 7) % 200)')}, {_item('((e.event_id * 7 + 3) % 200)')}], 1,
             CASE WHEN e.event_type = 'purchase' THEN 2 WHEN e.event_type = 'click' THEN 1 ELSE 0 END) AS items,
  c.c_mktsegment AS traffic_source,
  CAST(e.user_id AS VARCHAR) AS user_id
FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey"""),

    "users": ((), """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  1704067200000000 + c_custkey * 60000000 AS user_first_touch_timestamp,
  CASE WHEN c_custkey % 3 = 0 THEN NULL
       ELSE lower(replace(c_name, '#', '')) || '@' || lower(c_mktsegment) || '.com' END AS email,
  make_timestamp((1706745600 + c_custkey * 3600) * 1000000) AS updated
FROM customer"""),

    "users_dirty": (("users",), """
SELECT * FROM users
UNION ALL
SELECT user_id, user_first_touch_timestamp, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP)
FROM users WHERE CAST(user_id AS BIGINT) % 4 = 1
UNION ALL
SELECT CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP)
FROM region WHERE r_regionkey < 3"""),

    "item_lookup": ((), """
SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS name, p_retailprice AS price, p_type AS item_type
FROM part"""),

    "sales": (("users",), """
SELECT o.o_orderkey AS order_id, u.email, epoch_us(o.o_orderdate) AS transaction_timestamp,
  po.total_item_quantity, po.purchase_revenue_in_usd, po.unique_items, po.items
FROM (
  SELECT l_orderkey,
    CAST(sum(l_quantity) AS BIGINT) AS total_item_quantity,
    round(sum(l_extendedprice), 2) AS purchase_revenue_in_usd,
    count(DISTINCT l_partkey) AS unique_items,
    list_sort(list({'coupon': CASE WHEN l_discount > 0.05 THEN 'NEWBED10' END,
          'item_id': CAST(l_partkey AS VARCHAR), 'item_name': p_name,
          'item_revenue_in_usd': l_extendedprice,
          'price_in_usd': l_extendedprice / l_quantity,
          'quantity': CAST(trunc(l_quantity) AS BIGINT)})) AS items
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey) po
JOIN orders o ON po.l_orderkey = o.o_orderkey
LEFT JOIN users u ON o.o_custkey = CAST(u.user_id AS BIGINT)"""),

    "cdc_feed": (("geo",), """
SELECT e.user_id AS customer_id,
  CASE WHEN e.operation = 'DELETE' THEN NULL
       WHEN e.event_id % 11 = 0 THEN NULL ELSE 'user ' || CAST(e.user_id AS VARCHAR) END AS name,
  CASE WHEN e.operation = 'DELETE' THEN NULL
       WHEN e.event_id % 13 = 0 THEN 'user' || CAST(e.event_id AS VARCHAR) || '-at-example'
       ELSE 'user' || CAST(e.user_id AS VARCHAR) || '.' || CAST(e.event_id AS VARCHAR) || '@example.com' END AS email,
  CASE WHEN e.operation = 'DELETE' THEN NULL ELSE CAST(e.event_id AS VARCHAR) || ' Main St' END AS address,
  CASE WHEN e.operation = 'DELETE' THEN NULL ELSE g.n_name END AS city,
  CASE WHEN e.operation = 'DELETE' THEN NULL ELSE g.r_name END AS state,
  CASE WHEN e.operation = 'DELETE' THEN NULL ELSE lpad(CAST(e.event_id % 100000 AS VARCHAR), 5, '0') END AS zip_code,
  e.operation,
  e.ts AS timestamp
FROM (SELECT *, CASE WHEN event_id % 97 = 5 THEN NULL
                     WHEN event_type = 'signup' THEN 'INSERT'
                     WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation
      FROM events) e
LEFT JOIN geo g ON CAST(e.user_id % 25 AS INTEGER) = g.n_nationkey"""),

    "orders_feed": ((), """
SELECT o_orderkey AS order_id,
  strftime(o_orderdate + INTERVAL 27 YEAR, '%Y-%m-%d %H:%M:%S') AS order_timestamp,
  o_custkey AS customer_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS notifications
FROM orders"""),

    "status_feed": ((), """
SELECT o_orderkey AS order_id, o_orderstatus AS order_status,
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(0 AS BIGINT)
       ELSE epoch_us(o_orderdate + INTERVAL 27 YEAR) // 1000000 END AS status_timestamp
FROM orders"""),

    "retail_customers": (("geo",), """
SELECT c_custkey AS customer_id, c_name AS customer_name, g.r_name AS state, g.n_name AS city,
  c_nationkey * CAST(1.5 AS DOUBLE) - 60 AS lon, c_nationkey * CAST(0.5 AS DOUBLE) + 20 AS lat,
  c_custkey % 50 AS units_purchased, CAST(c_custkey % 4 AS INTEGER) AS loyalty_segment
FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey"""),

    "sales_orders_feed": ((), """
SELECT o.o_custkey AS customer_id, c.c_name AS customer_name, po.number_of_line_items,
  CAST(epoch_us(o.o_orderdate) // 1000000 AS VARCHAR) AS order_datetime,
  o.o_orderkey AS order_number, po.ordered_products
FROM (
  SELECT l_orderkey, count(*) AS number_of_line_items,
    list_sort(list({'curr': CASE WHEN l_linenumber % 3 = 0 THEN 'EUR' ELSE 'USD' END,
          'id': CAST(l_partkey AS VARCHAR),
          'price': CAST(trunc(l_extendedprice) AS BIGINT),
          'qty': CAST(trunc(l_quantity) AS BIGINT)})) AS ordered_products
  FROM lineitem GROUP BY l_orderkey) po
JOIN orders o ON po.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""),

    "recordings": ((), """
SELECT CAST(user_id AS VARCHAR) AS device_id, CAST(user_id + 100000 AS VARCHAR) AS mrn,
  CASE WHEN event_id % 17 = 0 THEN -value ELSE value END AS heartrate,
  epoch_us(ts) / 1000000 AS time
FROM events"""),

    "pii": ((), """
SELECT c_custkey + 100000 AS mrn, c_name AS name FROM customer"""),

    "user_ping": ((), """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(trunc(value) AS INTEGER) AS ping, ts AS time
FROM events"""),

    "movies_raw": ((), """
SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_name AS title,
  CAST(p_partkey % 30 + 1990 AS VARCHAR) AS year,
  CASE WHEN p_partkey % 7 = 0 THEN 'NA' ELSE CAST(p_size * 1000000 AS VARCHAR) END AS budget,
  CAST(p_size % 10 AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) AS rating
FROM part"""),

    "heartrate_device": ((), """
SELECT CAST(e.user_id AS INTEGER) AS device_id, CAST(e.user_id + 100000 AS VARCHAR) AS mrn,
  c.c_name AS name, e.ts AS time,
  CASE WHEN e.event_id % 17 = 0 THEN -e.value ELSE e.value END AS heartrate
FROM events e JOIN customer c ON e.user_id = c.c_custkey"""),
}


def sround(expr: str, places: int) -> str:
    """Spark's ``round`` (HALF_UP on the decimal form of a double) in DuckDB."""
    # Spark rounds BigDecimal(Double.toString(x)); DuckDB's double->text cast
    # also yields the shortest round-trip digits, so go through text.
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


def _needed(sql: str) -> list[str]:
    """Fixture CTEs referenced by ``sql`` (and their dependencies), in order."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out:
            return
        deps, _ = CTES[name]
        for dep in deps:
            visit(dep)
        out.append(name)

    for name in CTES:
        if re.search(rf"\b{name}\b", sql):
            visit(name)
    return out


def with_fixtures(sql: str, extra_ctes: str = "", recursive: bool = False) -> str:
    """Prefix ``sql`` with the fixture CTEs it uses (plus ``extra_ctes``)."""
    names = _needed(sql + " " + extra_ctes)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in names]
    if extra_ctes.strip():
        parts.append(extra_ctes.strip())
    if not parts:
        return sql.strip()
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + sql.strip()
