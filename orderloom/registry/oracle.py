"""SQL each query is checked against, written for DuckDB over the same tables.

The SQL is written from what a query means, not generated from its plan: it
joins first and sums afterwards, where the queries sum per item first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from orderloom import fixed_values as V
from orderloom import schemas as S
from orderloom.registry import queries as Q

M = "DECIMAL(18,2)"
DAY = "'%Y-%m-%d'"
SECOND = "'%Y-%m-%d %H:%M:%S'"
COMPACT = "'%Y%m%d'"


def case(expression: str, table: Mapping[str, str], default: str) -> str:
    arms = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in table.items())
    return f"CASE {expression} {arms} ELSE {default} END"


def text(value: str) -> str:
    return f"'{value}'"


def listed(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


LINE_KEY = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    f"strftime(l_shipdate, {COMPACT}))"
)
STATUS_CODE = "CASE o_orderstatus WHEN 'F' THEN '110' WHEN 'O' THEN '95' WHEN 'P' THEN '55' END"
SHIP_LABEL = case("status", V.SHIPMENT_STATUS, text(V.SHIPMENT_STATUS_DEFAULT))
TYPE_LABEL = case("trade_type", V.TRADE_TYPE, text(V.TRADE_TYPE_DEFAULT))
SHOP_NO = (
    f"CASE c_mktsegment WHEN 'MACHINERY' THEN '{V.WHOLESALE_SHOP}' WHEN 'FURNITURE' THEN NULL "
    "ELSE c_mktsegment END"
)
CHANNEL = (
    f"CASE WHEN shop_no <> '{V.WHOLESALE_SHOP}' THEN '{V.CHANNEL_ONLINE}' "
    f"ELSE '{V.CHANNEL_WHOLESALE}' END"
)

HEADERS = f"""
headers AS (
  SELECT *, {SHIP_LABEL} AS status_CN, {TYPE_LABEL} AS trade_type_name
  FROM (SELECT o_orderkey, o_orderpriority AS cs_remark, o_orderdate, o_totalprice,
               {STATUS_CODE} AS status, substring(o_orderpriority, 1, 1) AS trade_type,
               {SHOP_NO} AS shop_no,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'store ' || c_mktsegment END AS shop_name
        FROM orders JOIN customer ON o_custkey = c_custkey))"""
DETAIL = f"""{HEADERS},
detail AS (
  SELECT {LINE_KEY} AS detail_rec_id, CAST(l_orderkey AS VARCHAR) AS stockout_id,
         CAST(l_partkey AS VARCHAR) AS spec_no, CAST(l_quantity AS {M}) AS units,
         CAST(l_extendedprice AS {M}) AS amount, l_shipdate AS consign_time,
         status_CN, trade_type_name, shop_no, shop_name, cs_remark, r_name AS warehouse_name
  FROM lineitem JOIN headers ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""
INVENTORY = f"""
inventory AS (
  SELECT CAST(p_partkey AS VARCHAR) AS spec_no, w AS warehouse_name,
         CAST(p_size * (k + 1) AS {M}) AS stock_num,
         CAST(CAST(p_retailprice AS {M}) + 10 * k AS {M}) AS cost_price
  FROM part, (VALUES ('AFRICA', 0), ('AMERICA', 1), ('ASIA', 2), ('EUROPE', 3),
                     ('MIDDLE EAST', 4)) AS t(w, k)
  WHERE p_brand <> 'Brand#10')"""
PRODUCTS = """
products AS (
  SELECT 's1' AS sid, CAST(p_partkey AS VARCHAR) AS spec_no, p_name AS goods_name,
         CASE WHEN p_type <> 'PROMO' THEN p_type END AS class_name,
         CASE WHEN p_size > 5 THEN 'pc' WHEN p_size > 2 THEN ' ' END AS unit
  FROM part WHERE p_brand <> 'Brand#7')"""
PURCHASES = f"""
purchases AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS stockin_id, 's1' AS sid, {LINE_KEY} AS detail_rec_id,
         l_shipdate AS stockin_time,
         CASE WHEN l_linestatus = 'F' THEN '已完成' WHEN l_returnflag = 'A' THEN '已发货'
              ELSE '未知状态' END AS status_CN,
         CAST(l_partkey AS VARCHAR) AS detail_goods_no, 'item ' || l_partkey AS detail_goods_name,
         CAST(l_extendedprice AS {M}) AS detail_total_cost,
         CAST(l_quantity AS {M}) AS detail_goods_count,
         CASE WHEN l_tax = 0 THEN 0.13 ELSE l_tax END AS detail_tax
  FROM lineitem)"""
ORDERS = f"""
order_rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trade_id, 's1' AS sid,
         CASE o_orderstatus WHEN 'F' THEN '70' WHEN 'O' THEN '30' WHEN 'P' THEN '40' END
           AS trade_status,
         substring(o_orderpriority, 1, 1) AS trade_from,
         {case("substring(o_orderpriority, 1, 1)", V.ORDER_ORIGIN, text(V.ORDER_ORIGIN_DEFAULT))}
           AS trade_from_CN,
         CAST(o_totalprice AS {M}) AS paid, o_orderdate AS trade_time, o_orderdate AS modified,
         strftime(o_orderdate, '%Y-%m') AS trade_month
  FROM orders),
target AS (SELECT * FROM order_rows WHERE trade_time < TIMESTAMP '2000-01-01'),
batch AS (SELECT * REPLACE (paid + 10 AS paid) FROM order_rows
          WHERE trade_time >= TIMESTAMP '1999-01-01')"""
ORDER_OUT = f"""trade_id, sid, trade_status, trade_from, trade_from_CN, CAST(paid AS DOUBLE) AS paid,
  strftime(trade_time, {SECOND}) AS trade_time, strftime(modified, {SECOND}) AS modified,
  trade_month"""

COST = """
cost AS (SELECT spec_no, max(cost_price) AS cost_price FROM inventory GROUP BY spec_no)"""
SUMMARY = """CAST(sum(d.units) AS DOUBLE) AS units,
  CAST(round(sum(d.amount), 2) AS DOUBLE) AS revenue,
  CAST(round(sum(d.units * c.cost_price), 2) AS DOUBLE) AS cost,
  round(CAST(sum(d.units * c.cost_price) AS DOUBLE)
        / NULLIF(CAST(sum(d.amount) AS DOUBLE), 0), 2) AS cost_ratio,
  CAST(round(sum(d.amount) - sum(d.units * c.cost_price), 2) AS DOUBLE) AS profit"""
TOTAL, UNKNOWN = text(V.TOTAL_LABEL), text(V.UNKNOWN_LABEL)


def rolled(group: str) -> str:
    return f"CASE WHEN grouping({group}) = 1 THEN {TOTAL} ELSE coalesce({group}, {UNKNOWN}) END"


def window(p, column: str = "consign_time") -> str:
    end = p.end + dt.timedelta(days=1)
    return (
        f"{column} >= TIMESTAMP '{p.start}' AND {column} < TIMESTAMP '{end}' "
        f"AND status_CN IN {listed(p.statuses)}"
    )


def summary(p, group: str, where: str, label: str | None = None) -> str:
    shown = label or rolled("grp")
    return f"""
    WITH {DETAIL}, {INVENTORY}, {COST},
    chosen AS (SELECT {group} AS grp, spec_no, units, amount FROM detail
               WHERE {window(p)} {where})
    SELECT {shown} AS label, {SUMMARY}
    FROM chosen d LEFT JOIN cost c ON d.spec_no = c.spec_no
    GROUP BY ROLLUP (grp) HAVING count(*) > 0"""


def channel_sql(p) -> str:
    return summary(p, CHANNEL, f"AND warehouse_name IN {listed(p.warehouses)}")


def online_sql(p) -> str:
    arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in p.store_names.items())
    inner = summary(
        p, "shop_name",
        f"AND warehouse_name IN {listed(p.warehouses)} "
        f"AND trade_type_name IN {listed(p.trade_types)} "
        f"AND shop_no NOT IN ('{p.wholesale_shop}')",
    )
    return f"""SELECT CASE label {arms} ELSE label END AS label, units, revenue, cost,
    cost_ratio, profit FROM ({inner})"""


def offline_sql(p) -> str:
    kind = (
        f"CASE WHEN cs_remark LIKE '%{p.remark_phrase}%' THEN '{p.remark_label}' "
        f"ELSE '{V.REMARK_UNMATCHED}' END"
    )
    return summary(p, kind, f"AND shop_no IN ('{p.wholesale_shop}')")


def inventory_sql(p) -> str:
    return f"""
    WITH {DETAIL}, {INVENTORY}, {PRODUCTS},
    inv AS (SELECT {rolled("class_name")} AS label, sum(stock_num) AS stock,
                   sum(stock_num * cost_price) AS stock_cost
            FROM inventory LEFT JOIN products USING (spec_no)
            WHERE warehouse_name IN {listed(p.warehouses)}
            GROUP BY ROLLUP (class_name) HAVING count(*) > 0),
    sale AS (SELECT {rolled("class_name")} AS label, sum(units) AS units, sum(amount) AS amount
             FROM detail LEFT JOIN products USING (spec_no)
             WHERE {window(p)} GROUP BY ROLLUP (class_name) HAVING count(*) > 0)
    SELECT inv.label AS label, CAST(stock AS DOUBLE) AS stock,
           CAST(round(stock_cost, 2) AS DOUBLE) AS stock_cost,
           CAST(round(units, 2) AS DOUBLE) AS units,
           CAST(round(amount, 2) AS DOUBLE) AS revenue
    FROM inv LEFT JOIN sale ON inv.label = sale.label"""


def sku_sql(p, shops) -> str:
    return f"""
    WITH {DETAIL}, {INVENTORY}, {PRODUCTS},
    i AS (SELECT spec_no, max(cost_price) AS cost_price, sum(stock_num) AS stock
          FROM inventory WHERE warehouse_name IN {listed(p.warehouses)} GROUP BY spec_no),
    items AS (
      SELECT d.spec_no AS spec_no, goods_name, sum(units) AS units,
             round(sum(amount), 2) AS revenue,
             round(sum(units * coalesce(cost_price, 0)), 2) AS cost, coalesce(stock, 0) AS stock
      FROM detail d LEFT JOIN i ON d.spec_no = i.spec_no
           LEFT JOIN products g ON d.spec_no = g.spec_no
      WHERE {window(p)} AND shop_no IN {listed(shops)}
      GROUP BY d.spec_no, goods_name, stock, cost_price)
    SELECT spec_no, goods_name, CAST(units AS DOUBLE) AS units, CAST(revenue AS DOUBLE) AS revenue,
           CAST(cost AS DOUBLE) AS cost, CAST(stock AS DOUBLE) AS stock FROM items
    UNION ALL
    SELECT {TOTAL}, {TOTAL}, coalesce(CAST(sum(units) AS DOUBLE), 0),
           coalesce(CAST(sum(revenue) AS DOUBLE), 0), coalesce(CAST(sum(cost) AS DOUBLE), 0),
           coalesce(CAST(sum(stock) AS DOUBLE), 0) FROM items"""


def day_cells(days, amount: str, count: str) -> str:
    cells = []
    for day in days:
        hit = f"CAST(stockin_time AS DATE) = DATE '{day}'"
        cells.append(
            f"CAST(sum(CASE WHEN {hit} THEN {amount} ELSE 0 END) AS DOUBLE) AS \"{day}_amount\", "
            f"CAST(sum(CASE WHEN {hit} THEN {count} ELSE 0 END) AS DOUBLE) AS \"{day}_count\""
        )
    return ", ".join(cells)


def month_days(p):
    return [p.long_start + dt.timedelta(days=i) for i in range((p.end - p.long_start).days + 1)]


def month(p) -> str:
    end = p.end + dt.timedelta(days=1)
    return (
        f"stockin_time >= TIMESTAMP '{p.long_start}' AND stockin_time < TIMESTAMP '{end}' "
        "AND status_CN = '已完成'"
    )


def purchases_sql(p) -> str:
    cells = day_cells(month_days(p), "detail_total_cost", "detail_goods_count")
    return f"""
    WITH {PURCHASES}, chosen AS (SELECT * FROM purchases WHERE {month(p)})
    SELECT detail_goods_no, detail_goods_name, {cells} FROM chosen
    GROUP BY detail_goods_no, detail_goods_name
    UNION ALL SELECT {TOTAL}, {TOTAL}, {cells} FROM chosen"""


def blocks(keys: str, where: str, numbered: str) -> str:
    """Selects of blocks of 31 of the days that ``numbered`` has, over ``purchases``."""
    cells = []
    for place in range(1, 32):
        for name, column in (("amount", "detail_total_cost"), ("count", "detail_goods_count")):
            cells.append(
                f"CASE WHEN held >= {place} THEN CAST(sum(CASE WHEN place = {place} THEN {column} ELSE 0 END) "
                f"AS DOUBLE) END AS {name}_{place}"
            )
    return f"""
    WITH {PURCHASES},
    days AS (SELECT DISTINCT CAST(stockin_time AS DATE) AS day FROM purchases WHERE {numbered}),
    ranked AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS n FROM days),
    placed AS (SELECT day, CAST(n // 31 + 1 AS INTEGER) AS block, n % 31 + 1 AS place,
                      count(*) OVER (PARTITION BY n // 31) AS held FROM ranked),
    chosen AS (SELECT * FROM purchases JOIN placed ON CAST(stockin_time AS DATE) = day WHERE {where})
    SELECT block, {keys}, {", ".join(cells)} FROM chosen GROUP BY block, held, {keys}"""


def purchase_blocks_sql(p) -> str:
    keys = "detail_goods_no, detail_goods_name"
    statuses = month(p).rsplit(" AND ", 1)[0] + f" AND status_CN IN {listed(p.statuses)}"
    items = blocks(keys, month(p), statuses)
    select = items[items.index("SELECT block, "):]
    total = select.replace(f"block, {keys}", f"block, {TOTAL} AS detail_goods_no, {TOTAL} AS detail_goods_name", 1)
    return f"{items} UNION ALL {total.replace(f'held, {keys}', 'held')}"


# Landed pages -----------------------------------------------------------------

PAGE_CODE = "CASE WHEN l_tax = 0.07 THEN 1050 WHEN l_tax < 0.08 THEN 0 END"
FLAG_CODE = "CASE l_returnflag WHEN 'A' THEN '95' WHEN 'N' THEN '110' WHEN 'R' THEN '55' END"
LINES = f"""
rows AS (SELECT *, {LINE_KEY} AS key, strftime(l_shipdate, {SECOND}) AS stamp,
                strftime(l_shipdate + INTERVAL 1 DAY, {SECOND}) AS next_stamp,
                {PAGE_CODE} AS errorcode, {FLAG_CODE} AS code,
                CASE l_linestatus WHEN 'F' THEN '80' ELSE '20' END AS receipt
         FROM lineitem)"""
SALES_DOCS = f"""{LINES},
docs AS (SELECT *, key AS doc, 0 AS place FROM rows
         UNION ALL SELECT *, key || '-empty', 1 FROM rows WHERE l_discount = 0)"""
SALES_LINES = f"""{LINES},
lines AS (SELECT *, key AS rec, l_quantity AS qty, l_extendedprice AS total,
                 CAST(NULL AS VARCHAR) AS gift FROM rows
          UNION ALL SELECT *, key || '-gift', 1.0, 0.0, '1' FROM rows WHERE l_discount > 0.05)"""

NUMBERS = ("DECIMAL",)


def typed_null(kind: str) -> str:
    return "CAST(NULL AS DOUBLE)" if kind.startswith(NUMBERS) else "CAST(NULL AS VARCHAR)"


def projection(columns, kinds: Mapping[str, str], values: Mapping[str, str]) -> str:
    return ", ".join(
        f"{values[c] if c in values else typed_null(kinds.get(c, 'STRING'))} AS \"{c}\""
        for c in columns
    )


HEADER_VALUES = {
    "stockout_id": "doc",
    "order_no": "'SO' || l_orderkey",
    "warehouse_no": "'wh-' || l_suppkey",
    "consign_time": "stamp",
    "status": "code",
    "trade_status": "code",
    "trade_type": "CAST(l_linenumber AS VARCHAR)",
    "goods_count": "l_quantity",
    "receivable": "l_extendedprice",
    "trade_no": "CAST(l_orderkey AS VARCHAR)",
    "shop_no": "CAST(l_suppkey AS VARCHAR)",
    "modified": "stamp",
    "platform_id": "CAST(l_linenumber AS VARCHAR)",
    "tax_rate": "l_tax",
    "cs_remark": "l_returnflag",
    "sid": "'s1'",
    "status_CN": case("code", V.SHIPMENT_STATUS, text(V.SHIPMENT_STATUS_DEFAULT)),
    "trade_status_name": case(
        "code", V.SHIPMENT_TRADE_STATUS, text(V.SHIPMENT_TRADE_STATUS_DEFAULT)
    ),
    "trade_type_name": case(
        "CAST(l_linenumber AS VARCHAR)", V.TRADE_TYPE, text(V.TRADE_TYPE_DEFAULT)
    ),
}
DETAIL_VALUES = HEADER_VALUES | {
    "stockout_id": "key",
    "detail_rec_id": "rec",
    "detail_stockout_id": "key",
    "detail_spec_no": "CAST(l_partkey AS VARCHAR)",
    "detail_goods_count": "qty",
    "detail_gift_type": "gift",
    "detail_goods_name": "'item ' || l_partkey",
    "detail_goods_no": "CAST(l_partkey AS VARCHAR)",
    "detail_total_amount": "total",
    "detail_tax_rate": "l_tax",
    "detail_modified": "stamp",
    "detail_platform_id": "CAST(l_linenumber AS VARCHAR)",
}
DETAIL_KINDS = S.SALES_DOCUMENT_FIELDS | {
    S.LINE_PREFIX + f: kind for f, kind in S.SALES_LINE_FIELDS.items()
}
PURCHASE_VALUES = {
    "stockin_id": "key",
    "order_no": "'PO' || l_orderkey",
    "status": "receipt",
    "warehouse_no": "'wh-' || l_suppkey",
    "stockin_time": "stamp",
    "provider_no": "CAST(l_suppkey AS VARCHAR)",
    "goods_count": "l_quantity",
    "total_price": "l_extendedprice",
    "modified": "stamp",
    "status_CN": "'已完成'",
    "detail_rec_id": "rec",
    "detail_spec_no": "CAST(l_partkey AS VARCHAR)",
    "detail_goods_count": "l_quantity",
    "detail_tax": "CASE WHEN l_tax = 0 THEN 0.13 ELSE l_tax END",
    "detail_total_cost": "total",
    "detail_goods_name": "'item ' || l_partkey",
    "detail_goods_no": "CAST(l_partkey AS VARCHAR)",
    "sid": "'s1'",
}
PURCHASE_KINDS = S.PURCHASE_DOCUMENT_FIELDS | {
    S.LINE_PREFIX + f: kind for f, kind in S.PURCHASE_LINE_FIELDS.items()
}
ORDER_VALUES = {
    "trade_id": "CAST(o_orderkey AS VARCHAR)",
    "trade_no": "'T' || o_orderkey",
    "platform_id": "CAST(o_custkey AS VARCHAR)",
    "shop_no": "CAST(o_custkey AS VARCHAR)",
    "shop_remark": "o_orderpriority",
    "trade_status": "CASE o_orderstatus WHEN 'F' THEN '70' WHEN 'O' THEN '30' ELSE '40' END",
    "trade_type": "substring(o_orderpriority, 1, 1)",
    "trade_time": f"strftime(o_orderdate, {SECOND})",
    "trade_from": "substring(o_orderpriority, 1, 1)",
    "trade_from_CN": case(
        "substring(o_orderpriority, 1, 1)", V.ORDER_ORIGIN, text(V.ORDER_ORIGIN_DEFAULT)
    ),
    "modified": f"strftime(o_orderdate, {SECOND})",
    "created": f"strftime(o_orderdate, {SECOND})",
    "sid": "'s1'",
}
PAGE_COLUMNS = "'s1' AS sid, stamp AS start_time, next_stamp AS end_time, l_linenumber AS page_no"


def decoded(codes: Mapping[str, str], table: Mapping[str, str], default: str) -> str:
    code = case("l_returnflag || l_linenumber", codes, "NULL")
    return f"""
    SELECT code, {case("code", table, default)} AS label, count(*) AS n
    FROM (SELECT {code} AS code FROM lineitem) GROUP BY ALL"""


LATEST = """
lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS detail_rec_id, 's1' AS sid,
         CAST(l_partkey AS VARCHAR) AS detail_spec_no,
         CAST(l_quantity AS DECIMAL(18,2)) AS detail_goods_count,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS detail_total_amount,
         l_suppkey AS place, l_shipdate AS modified FROM lineitem),
target AS (
  SELECT * FROM lines WHERE modified < TIMESTAMP '2000-01-01'
  QUALIFY row_number() OVER (PARTITION BY detail_rec_id
    ORDER BY modified DESC, detail_spec_no, place DESC) = 1),
sent AS (
  SELECT * REPLACE (detail_total_amount + 10 AS detail_total_amount) FROM lines
  WHERE modified >= TIMESTAMP '1999-01-01')"""
LATEST_OUT = f"""detail_rec_id, sid, detail_spec_no,
  CAST(detail_goods_count AS DOUBLE) AS detail_goods_count,
  CAST(detail_total_amount AS DOUBLE) AS detail_total_amount, place,
  strftime(modified, {SECOND}) AS modified"""

EVENT_OUT = f"""event_id, strftime(ts, {SECOND}) AS ts, user_id, event_type, value, props"""
HEADER_ROWS = f"""
rows AS (SELECT CAST(o_orderkey AS VARCHAR) AS stockout_id, 's1' AS sid,
                CAST(o_orderkey AS VARCHAR) AS trade_no, {STATUS_CODE} AS status,
                CAST(o_totalprice AS {M}) AS receivable, o_orderpriority AS cs_remark,
                o_orderdate AS consign_time, o_orderdate AS modified FROM orders)"""

ORACLE: dict[str, str] = {
    "src_sales_pages": f"""
      WITH {LINES} SELECT {PAGE_COLUMNS}, CAST(errorcode AS VARCHAR) AS errorcode,
        CAST(1 + CAST(l_discount = 0 AS INTEGER) AS BIGINT) AS total_count,
        1 + CAST(l_discount = 0 AS INTEGER) AS documents FROM rows""",
    "src_purchase_pages": f"""
      WITH {LINES} SELECT {PAGE_COLUMNS}, CAST(errorcode AS VARCHAR) AS errorcode,
        CAST(1 AS BIGINT) AS total_count, 1 AS documents FROM rows""",
    "src_order_pages": f"""
      SELECT 's1' AS sid, strftime(o_orderdate, {SECOND}) AS start_time,
        strftime(o_orderdate + INTERVAL 1 DAY, {SECOND}) AS end_time,
        CAST(o_orderkey // 100 AS INTEGER) AS page_no,
        CASE WHEN o_orderpriority = '1-URGENT' THEN '1050' ELSE '0' END AS errorcode,
        count(*) OVER (PARTITION BY o_orderdate) AS total_count, 1 AS documents FROM orders""",
    "envelope_valid": f"""
      WITH {LINES} SELECT l_linenumber AS page_no, count(*) AS pages,
        CAST(sum(1 + CAST(l_discount = 0 AS INTEGER)) AS BIGINT) AS documents
      FROM rows WHERE errorcode = 0 GROUP BY l_linenumber""",
    "envelope_rejects": f"""
      WITH {LINES} SELECT CAST(errorcode AS VARCHAR) AS errorcode, l_linenumber AS page_no, count(*) AS pages
      FROM rows WHERE errorcode IS NULL OR errorcode <> 0 GROUP BY ALL""",
    "page_completeness": f"""
      WITH days AS (
        SELECT o_orderdate AS d, count(*) AS total,
          count(*) FILTER (o_orderpriority <> '1-URGENT') AS landed,
          count(DISTINCT o_orderkey // 100) FILTER (o_orderpriority <> '1-URGENT') AS pages
        FROM orders GROUP BY 1),
      seen AS (SELECT *, CASE WHEN landed > 0 THEN total END AS declared FROM days)
      SELECT 's1' AS sid, strftime(d, {SECOND}) AS start_time,
        strftime(d + INTERVAL 1 DAY, {SECOND}) AS end_time, declared, landed, pages,
        CAST(ceil(declared / 100.0) AS BIGINT) AS expected_pages,
        coalesce(landed >= declared AND pages >= ceil(declared / 100.0), FALSE) AS complete
      FROM seen""",
    "hourly_spine_counts": f"""
      WITH spine AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31',
                       TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS slot),
      counts AS (SELECT date_trunc('hour', ts) AS slot, count(*) AS n FROM events GROUP BY 1)
      SELECT strftime(slot, {SECOND}) AS slot, coalesce(n, 0) AS n
      FROM spine LEFT JOIN counts USING (slot)""",
    "lookback_filter": f"""
      SELECT event_type, count(*) AS n, strftime(min(ts), {SECOND}) AS first FROM events
      WHERE ts BETWEEN TIMESTAMP '2024-01-29' AND TIMESTAMP '2024-01-31' GROUP BY event_type""",
    "existing_keys": """
      SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS stockin_id, 's1' AS sid FROM lineitem""",
    "key_lookup": """
      SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000007'""",
    "scope_filter": """
      SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "flatten_sales_header": f"""
      WITH {SALES_DOCS} SELECT
        {projection(S.SALES_HEADER_COLUMNS, S.SALES_DOCUMENT_FIELDS, HEADER_VALUES)}
      FROM docs WHERE errorcode = 0 AND CAST(code AS INTEGER) >= 95""",
    "flatten_sales_detail": f"""
      WITH {SALES_LINES} SELECT
        {projection(S.SALES_DETAIL_COLUMNS, DETAIL_KINDS, DETAIL_VALUES)}
      FROM lines WHERE errorcode = 0 AND CAST(code AS INTEGER) >= 95""",
    "flatten_purchase_detail": f"""
      WITH {LINES}, lines AS (
        SELECT *, key AS rec, l_extendedprice AS total FROM rows
        UNION ALL SELECT *, key || '-spare', 0.0 FROM rows WHERE l_discount > 0.05)
      SELECT {projection(S.PURCHASE_DETAIL_COLUMNS, PURCHASE_KINDS, PURCHASE_VALUES)}
      FROM lines WHERE errorcode = 0 AND receipt = '80'""",
    "flatten_orders": f"""
      SELECT {projection(S.ORDER_COLUMNS, S.ORDER_FIELDS, ORDER_VALUES)}
      FROM orders WHERE o_orderpriority <> '1-URGENT'""",
    "normalise_keys": """
      SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR)
        AS l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey,
        CAST(l_suppkey AS VARCHAR) AS l_suppkey FROM lineitem""",
    "json_parse_explode": f"""
      WITH {SALES_LINES} SELECT key AS stockout_id, l_linenumber AS page_no, 0 AS place,
        rec AS rec_id, CAST(l_partkey AS VARCHAR) AS spec_no, qty AS goods_count FROM lines""",
    "positional_rename": """
      SELECT r_regionkey AS warehouse_id, r_name AS warehouse_name FROM region""",
    "status_threshold": f"""
      WITH {SALES_DOCS} SELECT doc AS stockout_id, code AS status FROM docs
      WHERE errorcode = 0 AND CAST(code AS INTEGER) >= 95""",
    "date_window_filter": f"""
      SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, {SECOND}) AS l_shipdate
      FROM lineitem
      WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'""",
    "in_list_filter": f"""
      WITH {HEADERS} SELECT CAST(o_orderkey AS VARCHAR) AS stockout_id, status_CN FROM headers
      WHERE status_CN IN ('已完成', '已发货')""",
    "not_in_filter": f"""
      SELECT * FROM (SELECT c_custkey, {SHOP_NO} AS shop_no FROM customer)
      WHERE shop_no NOT IN ('010')""",
    "like_filter": """
      SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '%URGENT%'""",
    "left_join_preagg": f"""
      WITH {DETAIL}, {INVENTORY}, {COST}
      SELECT detail_rec_id, spec_no AS detail_spec_no, CAST(units AS DOUBLE) AS detail_goods_count,
        CAST(cost_price AS DOUBLE) AS cost_price FROM detail LEFT JOIN cost USING (spec_no)""",
    "left_join_header": f"""
      SELECT {LINE_KEY} AS detail_rec_id, CAST(l_orderkey AS VARCHAR) AS stockout_id, 's1' AS sid,
        o_orderpriority AS cs_remark FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "left_join_dim": f"""
      WITH {DETAIL}, {PRODUCTS}
      SELECT detail_rec_id, spec_no AS detail_spec_no, goods_name, class_name
      FROM detail LEFT JOIN products USING (spec_no)""",
    "join_rollups": f"""
      WITH {DETAIL}, {INVENTORY}, {PRODUCTS},
      a AS (SELECT {rolled("class_name")} AS label, sum(stock_num) AS stock
            FROM inventory LEFT JOIN products USING (spec_no) GROUP BY ROLLUP (class_name)),
      b AS (SELECT {rolled("class_name")} AS label, sum(units) AS units
            FROM detail LEFT JOIN products USING (spec_no) GROUP BY ROLLUP (class_name))
      SELECT label, CAST(stock AS DOUBLE) AS stock, CAST(units AS DOUBLE) AS units
      FROM a LEFT JOIN b USING (label)""",
    "multiway_left_join": f"""
      WITH {DETAIL}, {INVENTORY}, {PRODUCTS},
      i AS (SELECT spec_no, max(cost_price) AS cost_price, sum(stock_num) AS stock
            FROM inventory GROUP BY spec_no)
      SELECT spec_no, goods_name, CAST(stock AS DOUBLE) AS stock,
        CAST(cost_price AS DOUBLE) AS cost_price, CAST(sum(units) AS DOUBLE) AS units,
        CAST(sum(amount) AS DOUBLE) AS amount
      FROM detail LEFT JOIN i USING (spec_no) LEFT JOIN products USING (spec_no)
      GROUP BY spec_no, goods_name, stock, cost_price""",
    "anti_join_new": f"""
      WITH {ORDERS} SELECT {ORDER_OUT} FROM batch b
      WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.trade_id = b.trade_id AND t.sid = b.sid)""",
    "semi_join_existing": f"""
      WITH {ORDERS} SELECT {ORDER_OUT} FROM batch b
      WHERE EXISTS (SELECT 1 FROM target t WHERE t.trade_id = b.trade_id AND t.sid = b.sid)""",
    "grouped_sum": f"""
      WITH {DETAIL} SELECT status_CN, CAST(sum(units) AS DOUBLE) AS units,
        CAST(sum(amount) AS DOUBLE) AS amount FROM detail GROUP BY status_CN""",
    "sum_product": f"""
      WITH {DETAIL}, {INVENTORY}, {COST}
      SELECT status_CN, CAST(sum(units * cost_price) AS DOUBLE) AS cost,
        CAST(sum(units * coalesce(cost_price, 0)) AS DOUBLE) AS cost_or_zero
      FROM detail LEFT JOIN cost USING (spec_no) GROUP BY status_CN""",
    "max_per_key": f"""
      WITH {INVENTORY}, {COST}
      SELECT spec_no, CAST(cost_price AS DOUBLE) AS cost_price FROM cost""",
    "ratio_of_sums": f"""
      SELECT l_linenumber, l_returnflag,
        round(CAST(sum(CAST(l_quantity AS {M})) AS DOUBLE) / NULLIF(CAST(sum(
          CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS {M}) ELSE 0 END) AS DOUBLE),
          0), 6) AS share
      FROM lineitem GROUP BY ALL""",
    "rollup_case": f"""
      WITH {DETAIL}, d AS (SELECT {CHANNEL} AS channel, units FROM detail)
      SELECT {rolled("channel")} AS label, CAST(sum(units) AS DOUBLE) AS units
      FROM d GROUP BY ROLLUP (channel)""",
    "rollup_plain": f"""
      WITH {DETAIL} SELECT {rolled("shop_name")} AS label, grouping(shop_name) = 1 AS is_total,
        CAST(sum(units) AS DOUBLE) AS units FROM detail GROUP BY ROLLUP (shop_name)""",
    "rollup_pattern": f"""
      WITH {DETAIL}, d AS (SELECT CASE WHEN cs_remark LIKE '%URGENT%' THEN 'urgent'
        ELSE '{V.REMARK_UNMATCHED}' END AS kind, amount FROM detail)
      SELECT {rolled("kind")} AS label, CAST(sum(amount) AS DOUBLE) AS amount
      FROM d GROUP BY ROLLUP (kind)""",
    "rollup_null_bucket": f"""
      WITH {DETAIL}, {PRODUCTS}
      SELECT {rolled("class_name")} AS label, CAST(sum(amount) AS DOUBLE) AS amount
      FROM detail LEFT JOIN products USING (spec_no) GROUP BY ROLLUP (class_name)""",
    "distinct_dates": f"""
      SELECT DISTINCT strftime(l_shipdate, {DAY}) AS day FROM lineitem""",
    "conditional_sum": f"""
      SELECT l_linenumber, {", ".join(
        f"CAST(sum(CASE WHEN l_returnflag = '{f}' THEN CAST(l_extendedprice AS {M}) ELSE 0 END)"
        f" AS DOUBLE) AS amount_{f}" for f in "ANR")}
      FROM lineitem GROUP BY l_linenumber""",
    "pivot_daily": blocks("detail_goods_no", month(Q.WHOLE), month(Q.WHOLE)),
    "pivot_daily_month": f"""
      WITH {PURCHASES} SELECT detail_goods_no,
        {day_cells(month_days(Q.MONTH), "detail_total_cost", "detail_goods_count")}
      FROM purchases WHERE {month(Q.MONTH)} GROUP BY detail_goods_no""",
    "pivot_daily_long": f"""
      WITH {PURCHASES} SELECT detail_goods_no, strftime(stockin_time, {DAY}) AS day,
        CAST(sum(detail_total_cost) AS DOUBLE) AS amount,
        CAST(sum(detail_goods_count) AS DOUBLE) AS count
      FROM purchases GROUP BY ALL""",
    "total_row_first": f"""
      WITH {PURCHASES}, items AS (SELECT detail_goods_no, sum(detail_total_cost) AS amount,
        sum(detail_goods_count) AS units, max(detail_tax) AS rate
        FROM purchases GROUP BY detail_goods_no)
      SELECT FALSE AS is_total, detail_goods_no, CAST(amount AS DOUBLE) AS amount,
        CAST(units AS DOUBLE) AS units, round(CAST(rate AS DOUBLE), 2) AS rate,
        CAST(NULL AS DOUBLE) AS note FROM items
      UNION ALL SELECT TRUE, {TOTAL}, CAST(sum(amount) AS DOUBLE), CAST(sum(units) AS DOUBLE),
        round(CAST(sum(rate) AS DOUBLE), 2), 0.0 FROM items""",
    "union_total": f"""
      WITH {DETAIL} SELECT spec_no, CAST(sum(units) AS DOUBLE) AS units,
        CAST(sum(amount) AS DOUBLE) AS amount FROM detail GROUP BY spec_no
      UNION ALL SELECT {TOTAL}, CAST(sum(units) AS DOUBLE), CAST(sum(amount) AS DOUBLE)
      FROM detail""",
    "hourly_counts": f"""
      SELECT strftime(date_trunc('hour', ts), {SECOND}) AS slot, count(*) AS n
      FROM events GROUP BY 1""",
    "latest_per_key": f"""
      SELECT * REPLACE (strftime(l_shipdate, {SECOND}) AS l_shipdate) FROM (
        SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1)""",
    "sort_desc": f"""
      WITH {DETAIL} SELECT spec_no, CAST(sum(units) AS DOUBLE) AS units,
        CAST(sum(amount) AS DOUBLE) AS amount FROM detail GROUP BY spec_no ORDER BY amount DESC""",
    "date_formats": f"""
      SELECT event_id, strftime(ts, {COMPACT}) AS compact, strftime(ts, {DAY}) AS dashed,
        strftime(ts, {SECOND}) AS second,
        strftime(ts - INTERVAL 7 DAY, {DAY}) AS week_before FROM events""",
    "extract_order_ref": """
      SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT%' AND o_orderstatus <> 'P'
        THEN CAST(o_orderkey AS VARCHAR) END AS ref FROM orders""",
    "coerce_numeric": f"""
      SELECT {LINE_KEY} AS key, TRY_CAST(CASE WHEN l_returnflag = 'A' THEN 'q' || l_linenumber
        ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE) AS number FROM lineitem""",
    "format_report_number": f"""
      SELECT {LINE_KEY} AS key, CASE WHEN l_returnflag = 'A' OR l_discount = 0 THEN ''
          ELSE format('{{:,.0f}}', l_extendedprice) END AS amount,
        format('{{:,.0f}}', l_quantity * l_linenumber / 2.0) AS half
      FROM lineitem""",
    "map_label_default": """
      SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'car shop'
        WHEN 'BUILDING' THEN 'house shop' ELSE c_mktsegment END AS shop FROM customer""",
    "decode_status": decoded(
        Q.spread(list(V.SHIPMENT_STATUS)), V.SHIPMENT_STATUS, text(V.SHIPMENT_STATUS_DEFAULT)
    ),
    "decode_trade_status": decoded(
        Q.spread(list(V.SHIPMENT_TRADE_STATUS)), V.SHIPMENT_TRADE_STATUS,
        text(V.SHIPMENT_TRADE_STATUS_DEFAULT),
    ),
    "decode_trade_type": decoded(
        Q.spread(list(V.TRADE_TYPE)), V.TRADE_TYPE, text(V.TRADE_TYPE_DEFAULT)
    ),
    "decode_order_origin": decoded(
        Q.spread(list(V.ORDER_ORIGIN)), V.ORDER_ORIGIN, text(V.ORDER_ORIGIN_DEFAULT)
    ),
    "decode_platform": decoded(Q.spread(list(V.PLATFORM)), V.PLATFORM, "code"),
    "decode_order_status": decoded(Q.spread(list(V.ORDER_STATUS)), V.ORDER_STATUS, "code"),
    "default_rate": f"""
      SELECT {LINE_KEY} AS detail_rec_id,
        CASE WHEN l_tax = 0 THEN 0.13 ELSE l_tax END AS detail_tax FROM lineitem""",
    "classify_channel": f"""
      SELECT c_custkey, {CHANNEL} AS channel
      FROM (SELECT c_custkey, {SHOP_NO} AS shop_no FROM customer)""",
    "classify_remark": f"""
      SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'urgent'
        ELSE '{V.REMARK_UNMATCHED}' END AS kind FROM orders""",
    "missing_unit_report": f"""
      WITH {PRODUCTS} SELECT sid, spec_no,
        '卖家账号 = ' || sid || ', 货品编码 = ' || spec_no AS line
      FROM products WHERE coalesce(trim(unit), '') = ''""",
    "append_new": f"""
      WITH {PURCHASES},
      target AS (SELECT * FROM purchases WHERE stockin_time < TIMESTAMP '2000-01-01'),
      batch AS (SELECT * REPLACE (detail_total_cost + 10 AS detail_total_cost) FROM purchases
                WHERE stockin_time >= TIMESTAMP '1999-01-01')
      SELECT * REPLACE (strftime(stockin_time, {SECOND}) AS stockin_time,
        CAST(detail_total_cost AS DOUBLE) AS detail_total_cost,
        CAST(detail_goods_count AS DOUBLE) AS detail_goods_count,
        CAST(detail_tax AS DOUBLE) AS detail_tax)
      FROM (SELECT * FROM target UNION ALL SELECT * FROM batch
            WHERE stockin_id NOT IN (SELECT stockin_id FROM target))""",
    "upsert_detail": f"""
      WITH {LATEST}, latest AS (SELECT * FROM sent QUALIFY row_number() OVER (
        PARTITION BY detail_rec_id ORDER BY modified DESC, detail_spec_no, place DESC) = 1)
      SELECT {LATEST_OUT} FROM (SELECT * FROM latest UNION ALL SELECT * FROM target
        WHERE detail_rec_id NOT IN (SELECT detail_rec_id FROM sent))""",
    "insert_ignore": f"""
      WITH {LATEST}, fresh AS (SELECT * FROM sent
        WHERE detail_rec_id NOT IN (SELECT detail_rec_id FROM target)
        QUALIFY row_number() OVER (PARTITION BY detail_rec_id
          ORDER BY modified, detail_spec_no, place) = 1)
      SELECT {LATEST_OUT} FROM (SELECT * FROM fresh UNION ALL SELECT * FROM target)""",
    "upsert_header": f"""
      WITH {HEADER_ROWS},
      target AS (SELECT * FROM rows WHERE modified < TIMESTAMP '2000-01-01'),
      batch AS (SELECT * REPLACE (receivable + 10 AS receivable) FROM rows
                WHERE modified >= TIMESTAMP '1999-01-01')
      SELECT stockout_id, sid, trade_no, status, {SHIP_LABEL} AS status_CN,
        CAST(receivable AS DOUBLE) AS receivable, cs_remark,
        strftime(consign_time, {SECOND}) AS consign_time, strftime(modified, {SECOND}) AS modified
      FROM (SELECT * FROM batch UNION ALL SELECT * FROM target
            WHERE stockout_id NOT IN (SELECT stockout_id FROM batch))""",
    "upsert_orders": f"""
      WITH {ORDERS} SELECT {ORDER_OUT} FROM (SELECT * FROM batch UNION ALL SELECT * FROM target
        WHERE trade_id NOT IN (SELECT trade_id FROM batch))""",
    "upsert_actions": f"""
      WITH {ORDERS} SELECT CASE WHEN t.trade_id IS NULL THEN 'inserted'
        WHEN b.trade_id IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS action, count(*) AS n
      FROM target t FULL JOIN batch b ON t.trade_id = b.trade_id GROUP BY 1""",
    "stream_dedupe": f"SELECT {EVENT_OUT} FROM events",
    "report_purchases": purchase_blocks_sql(Q.WHOLE),
    "report_purchases_month": purchases_sql(Q.MONTH),
    "empty_placeholder": f"SELECT '{Q.bundle.empty_message(Q.MONTH)}' AS message",
}
_ALLOWED = f"AND 'wh-' || l_suppkey IN {listed(Q.ALLOWED)}"
for _name in ("flatten_sales_detail", "flatten_purchase_detail"):
    ORACLE[_name + "_allowed"] = f"{ORACLE[_name]} {_ALLOWED}"
ORACLE["left_join_header_fanout"] = f"""
  SELECT {LINE_KEY} AS detail_rec_id, CAST(l_orderkey AS VARCHAR) AS trade_no, remark AS cs_remark
  FROM lineitem LEFT JOIN (
    SELECT o_orderkey, o_orderpriority AS remark FROM orders
    UNION ALL SELECT o_orderkey, 'second' FROM orders WHERE o_orderpriority = '2-HIGH')
  ON l_orderkey = o_orderkey"""
ORACLE["load_purchases_pages"] = ORACLE["flatten_purchase_detail"]
_NEWEST = ORDER_VALUES | {
    "trade_status": f"CASE WHEN o_orderstatus = 'F' THEN 'newer' ELSE {ORDER_VALUES['trade_status']} END",
    "modified": "strftime(o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 1 DAY "
    f"ELSE INTERVAL 0 DAY END, {SECOND})",
}
ORACLE["load_orders_pages"] = f"""
  SELECT {projection(S.ORDER_COLUMNS, S.ORDER_FIELDS, _NEWEST)}
  FROM orders WHERE o_orderpriority <> '1-URGENT'"""
ORACLE["stream_upsert"] = ORACLE["upsert_orders"]
ORACLE["stream_hourly_counts"] = ORACLE["hourly_counts"]

for _suffix, _p in (("", Q.WHOLE), ("_week", Q.WEEK)):
    ORACLE["report_channel_summary" + _suffix] = channel_sql(_p)
    ORACLE["report_online" + _suffix] = online_sql(_p)
    ORACLE["report_offline" + _suffix] = offline_sql(_p)
    ORACLE["report_inventory" + _suffix] = inventory_sql(_p)
    ORACLE["report_sku_online" + _suffix] = sku_sql(_p, _p.online_shops)
    ORACLE["report_sku_offline" + _suffix] = sku_sql(_p, _p.offline_shops)


def bundle_sql(p) -> str:
    """The sections below each other with their numbers as report text."""

    def number(column: str) -> str:
        return f"CASE WHEN coalesce({column}, 0) = 0 THEN '' ELSE format('{{:,.0f}}', {column}) END"

    span = f"{p.start:%Y%m%d}-{p.end:%Y%m%d} "
    summary_cells = [
        "label", number("units"), number("revenue"), number("cost"),
        "CAST(cost_ratio AS VARCHAR)", number("profit"),
    ]
    stock_cells = ["label", *map(number, ("stock", "stock_cost", "units", "revenue")), "NULL"]
    day_cells_shown = [
        "detail_goods_no", "detail_goods_name", "day", number("amount"), number("pieces"), "NULL"
    ]
    sku_cells = ["spec_no", "goods_name", *map(number, ("units", "revenue", "cost", "stock"))]
    parts = [
        ("channel", span + V.TITLE_CHANNEL, summary_cells, channel_sql(p)),
        ("online", span + V.TITLE_ONLINE, summary_cells, online_sql(p)),
        ("offline", span + V.TITLE_OFFLINE, summary_cells, offline_sql(p)),
        ("inventory", f"{p.end:%Y%m%d} {V.TITLE_INVENTORY}", stock_cells, inventory_sql(p)),
        ("sku_offline", V.SHEET_SKU_OFFLINE, sku_cells, sku_sql(p, p.offline_shops)),
        ("sku_online", V.SHEET_SKU_ONLINE, sku_cells, sku_sql(p, p.online_shops)),
        ("purchases", V.SHEET_PURCHASES, day_cells_shown, f"""
          WITH {PURCHASES} SELECT detail_goods_no, detail_goods_name,
            strftime(stockin_time, {DAY}) AS day,
            CAST(sum(detail_total_cost) AS DOUBLE) AS amount,
            CAST(sum(detail_goods_count) AS DOUBLE) AS pieces
          FROM purchases WHERE {month(p)} GROUP BY ALL"""),
    ]
    selects = []
    for ordinal, (name, title, cells, inner) in enumerate(parts, 1):
        shown = ", ".join(f"{cell} AS c{i}" for i, cell in enumerate(cells, 1))
        selects.append(
            f"SELECT {ordinal} AS ordinal, '{name}' AS section, '{title}' AS title, {shown} "
            f"FROM ({inner})"
        )
    return " UNION ALL ".join(selects)


def sections_sql(p) -> str:
    def counted(ordinal: int, name: str, title: str, inner: str) -> str:
        return (
            f"SELECT {ordinal} AS ordinal, '{name}' AS section, '{title}' AS title, "
            f"(SELECT count(*) FROM ({inner})) AS rows"
        )

    span = f"{p.start:%Y%m%d}-{p.end:%Y%m%d} "
    return " UNION ALL ".join([
        counted(1, "channel", span + V.TITLE_CHANNEL, channel_sql(p)),
        counted(2, "online", span + V.TITLE_ONLINE, online_sql(p)),
        counted(3, "offline", span + V.TITLE_OFFLINE, offline_sql(p)),
        counted(4, "inventory", f"{p.end:%Y%m%d} {V.TITLE_INVENTORY}", inventory_sql(p)),
        counted(5, "sku_offline", V.SHEET_SKU_OFFLINE, sku_sql(p, p.offline_shops)),
        counted(6, "sku_online", V.SHEET_SKU_ONLINE, sku_sql(p, p.online_shops)),
        counted(7, "purchases", V.SHEET_PURCHASES,
                purchases_sql(p) if p is Q.MONTH else purchase_blocks_sql(p)),
    ])


ORACLE["report_bundle"] = bundle_sql(Q.WHOLE)
ORACLE["report_sections"] = sections_sql(Q.WHOLE)
ORACLE["report_sections_month"] = sections_sql(Q.MONTH)


# Streams over landings --------------------------------------------------------

LANDED = f"""
landed AS (
  SELECT *, {Q.LANDING.replace("day(ts)", "date_part('day', ts)")} AS landing FROM events),
marks AS (
  SELECT landing, max(max(ts)) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL {V.LOOKBACK_DAYS} DAY AS mark
  FROM landed GROUP BY landing),
parted AS (
  SELECT l.*, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark, FALSE) AS late
  FROM landed l JOIN marks USING (landing))"""

ORACLE["stream_late_slots"] = f"""
  WITH {LANDED} SELECT strftime(date_trunc('hour', ts), {SECOND}) AS slot, count(*) AS n
  FROM parted WHERE NOT late GROUP BY 1"""
ORACLE["stream_late_rows"] = f"WITH {LANDED} SELECT {EVENT_OUT} FROM parted WHERE late"
ORACLE["stream_counts_compacted"] = ORACLE["hourly_counts"]
ORACLE["stream_dedupe_window"] = f"""
  SELECT {EVENT_OUT} FROM events UNION ALL
  SELECT {EVENT_OUT} FROM (
    SELECT * REPLACE (ts + INTERVAL {3 * Q.LANDING_DAYS} DAY AS ts) FROM events
    WHERE event_id % 7 = 0 AND date_part('day', ts) <= {Q.LANDING_DAYS})"""


# Loads with a choice of pages, and what loads have done ------------------------

ORACLE["stream_completeness"] = ORACLE["page_completeness"]
_LOW = Q.LOOKBACK_FROM - dt.timedelta(days=Q.LOOKBACK_DAYS)
ORACLE["load_orders_lookback"] = f"""
  SELECT {projection(S.ORDER_COLUMNS, S.ORDER_FIELDS, ORDER_VALUES)}
  FROM orders WHERE o_orderpriority <> '1-URGENT'
    AND o_orderdate + INTERVAL 1 DAY >= TIMESTAMP '{_LOW}' AND o_orderdate <= TIMESTAMP '{Q.LOOKBACK_FROM}'"""
ORACLE["load_orders_changes"] = """
  WITH good AS (SELECT o_orderstatus = 'F' AS finished FROM orders WHERE o_orderpriority <> '1-URGENT')
  SELECT 'load-0' AS load, 'inserted' AS action, count(*) AS n FROM good WHERE finished
  UNION ALL SELECT 'load-1', 'updated', count(*) FROM good WHERE finished
  UNION ALL SELECT 'load-1', 'inserted', count(*) FROM good WHERE NOT finished
  UNION ALL SELECT 'load-2', 'unchanged', count(*) FROM good"""
