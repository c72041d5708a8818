"""Schemas of landed pages and column lists of the stored tables.

Schemas are always explicit: inference would read every page twice and would
let a code column change type from one load to the next. Business times carry
no zone, hence TIMESTAMP_NTZ.
"""

from pyspark.sql import types as T

MONEY = "DECIMAL(18,2)"
RATE = "DECIMAL(9,4)"
TIME = "TIMESTAMP_NTZ"

# Field names of the landed documents, in document order.
SALES_LINE_FIELDS = {
    "rec_id": "STRING", "stockout_id": "STRING", "spec_no": "STRING", "sell_price": MONEY,
    "goods_count": MONEY, "brand_no": "STRING", "brand_name": "STRING", "goods_type": "STRING",
    "gift_type": "STRING", "goods_name": "STRING", "goods_no": "STRING", "spec_name": "STRING",
    "spec_code": "STRING", "suite_no": "STRING", "cost_price": MONEY, "total_amount": MONEY,
    "goods_id": "STRING", "spec_id": "STRING", "paid": MONEY, "refund_status": "STRING",
    "market_price": MONEY, "discount": MONEY, "share_amount": MONEY, "tax_rate": RATE,
    "barcode": "STRING", "sale_order_id": "STRING", "share_post": MONEY, "src_oid": "STRING",
    "src_tid": "STRING", "modified": TIME, "platform_id": "STRING",
}
SALES_DOCUMENT_FIELDS = {
    "stockout_id": "STRING", "order_no": "STRING", "src_order_no": "STRING",
    "warehouse_no": "STRING", "consign_time": TIME, "order_type": "STRING",
    "order_type_name": "STRING", "status": "STRING", "trade_status": "STRING",
    "trade_type": "STRING", "subtype": "STRING", "goods_count": MONEY,
    "goods_total_amount": MONEY, "receivable": MONEY, "paid": MONEY, "refund_status": "STRING",
    "warehouse_name": "STRING", "created": TIME, "remark": "STRING", "outer_no": "STRING",
    "trade_no": "STRING", "src_trade_no": "STRING", "trade_time": TIME, "pay_time": TIME,
    "shop_name": "STRING", "shop_no": "STRING", "post_amount": MONEY, "modified": TIME,
    "platform_id": "STRING", "trade_id": "STRING", "stockout_no": "STRING",
    "wms_status": "STRING", "warehouse_id": "STRING", "consign_status": "STRING",
    "discount": MONEY, "src_tids": "STRING", "tax": MONEY, "tax_rate": RATE,
    "currency": "STRING", "stock_check_time": TIME, "invoice_type": "STRING",
    "cs_remark": "STRING",
}
PURCHASE_LINE_FIELDS = {
    "rec_id": "STRING", "spec_no": "STRING", "goods_count": MONEY, "cost_price": MONEY,
    "src_price": MONEY, "tax_price": MONEY, "tax_amount": MONEY, "tax": RATE,
    "total_cost": MONEY, "remark": "STRING", "right_num": MONEY, "right_price": MONEY,
    "right_cost": MONEY, "brand_no": "STRING", "brand_name": "STRING", "goods_name": "STRING",
    "goods_no": "STRING",
}
PURCHASE_DOCUMENT_FIELDS = {
    "stockin_id": "STRING", "order_no": "STRING", "status": "STRING", "warehouse_no": "STRING",
    "warehouse_name": "STRING", "stockin_time": TIME, "check_time": TIME, "created_time": TIME,
    "src_order_no": "STRING", "remark": "STRING", "stockin_reason": "STRING",
    "order_type": "STRING", "order_type_name": "STRING", "goods_amount": MONEY,
    "total_price": MONEY, "discount": MONEY, "tax_amount": MONEY, "post_fee": MONEY,
    "other_fee": MONEY, "logistics_type": "STRING", "logistics_code": "STRING",
    "logistics_name": "STRING", "logistics_no": "STRING", "purchase_no": "STRING",
    "provider_no": "STRING", "provider_name": "STRING", "outer_no": "STRING",
    "goods_count": MONEY, "right_nums": MONEY, "right_price": MONEY, "stockin_no": "STRING",
    "warehouse_id": "STRING", "modified": TIME,
}
ORDER_FIELDS = {
    "trade_id": "STRING", "trade_no": "STRING", "platform_id": "STRING",
    "shop_platform_id": "STRING", "shop_no": "STRING", "shop_name": "STRING",
    "shop_remark": "STRING", "warehouse_type": "STRING", "warehouse_no": "STRING",
    "src_tids": "STRING", "trade_status": "STRING", "consign_status": "STRING",
    "trade_type": "STRING", "refund_status": "STRING", "trade_time": TIME, "pay_time": TIME,
    "stockout_no": "STRING", "trade_from": "STRING", "modified": TIME, "created": TIME,
    "fenxiao_tid": "STRING",
}

# Columns of the stored tables, in table order.
SALES_HEADER_COLUMNS = (
    "stockout_id", "order_no", "src_order_no", "warehouse_no", "consign_time", "order_type",
    "trade_status", "order_type_name", "trade_type", "trade_type_name", "subtype",
    "goods_count", "goods_total_amount", "receivable", "paid", "refund_status",
    "warehouse_name", "created", "remark", "outer_no", "trade_no", "src_trade_no",
    "trade_time", "pay_time", "status", "status_CN", "shop_name", "shop_no", "post_amount",
    "modified", "platform_id", "trade_id", "stockout_no", "wms_status", "warehouse_id",
    "consign_status", "discount", "src_tids", "tax", "tax_rate", "currency",
    "stock_check_time", "trade_status_name", "sid", "invoice_type", "cs_remark",
)
ORDER_COLUMNS = (
    "trade_id", "trade_no", "platform_id", "shop_platform_id", "shop_no", "shop_name",
    "shop_remark", "warehouse_type", "warehouse_no", "src_tids", "trade_status",
    "consign_status", "trade_type", "refund_status", "trade_time", "pay_time", "stockout_no",
    "trade_from", "trade_from_CN", "modified", "created", "fenxiao_tid", "sid",
)

# Line tables repeat the document on each line; line fields get a prefix.
LINE_PREFIX = "detail_"
SALES_DETAIL_COLUMNS = tuple(c for c in SALES_HEADER_COLUMNS if c != "cs_remark") + tuple(
    LINE_PREFIX + f for f in SALES_LINE_FIELDS
)
PURCHASE_DETAIL_COLUMNS = (
    tuple(PURCHASE_DOCUMENT_FIELDS)
    + ("status_CN",)
    + tuple(LINE_PREFIX + f for f in PURCHASE_LINE_FIELDS)
    + ("sid",)
)

# Partition columns our tables have on top.
CONSIGN_MONTH = "consign_month"
STOCKIN_MONTH = "stockin_month"
TRADE_MONTH = "trade_month"

SALES_HEADER_KEY = ("stockout_id", "sid")
SALES_DETAIL_KEY = ("detail_rec_id", "sid")
PURCHASE_KEY = ("stockin_id", "sid")
ORDER_KEY = ("trade_id", "sid")


def struct_ddl(fields: dict[str, str], lines: dict[str, str] | None = None) -> str:
    parts = [f"`{name}`: {kind}" for name, kind in fields.items()]
    if lines is not None:
        parts.append(f"details_list: ARRAY<{struct_ddl(lines)}>")
    return f"STRUCT<{', '.join(parts)}>"


def page_schema(list_field: str, document: str) -> T.StructType:
    """One landed page: the request it answers and the response envelope."""
    return T.StructType.fromDDL(
        "sid STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, page_no INT, "
        "response STRUCT<errorcode: INT, total_count: BIGINT, "
        f"`{list_field}`: ARRAY<{document}>>, corrupt STRING"
    )
