"""Values that have to be exactly these for results to be right.

Code tables, labels, thresholds and defaults belong to the data, not to the
program. They are stated here once, as plain text.
"""

# Shipment document status.
SHIPMENT_STATUS = {
    "95": "已发货",
    "105": "部分打款",
    "110": "已完成",
    "113": "异常发货",
    "115": "回传失败",
    "120": "回传成功",
}
SHIPMENT_STATUS_DEFAULT = "未知状态"

# Trade status carried on a shipment document.
SHIPMENT_TRADE_STATUS = {
    "95": "已发货",
    "105": "部分打款",
    "110": "已完成",
    "113": "异常发货",
}
SHIPMENT_TRADE_STATUS_DEFAULT = "未知状态"

# Trade type.
TRADE_TYPE = {
    "1": "网店销售",
    "2": "线下零售",
    "3": "售后换货",
    "4": "批发业务",
    "5": "保修换新",
    "6": "保修完成",
    "7": "订单补发",
    "8": "供销补发",
    "101": "达人样品",
    "102": "寄样",
}
TRADE_TYPE_DEFAULT = "未知类型"

# How an order was created. Codes 1 and 4 share a label.
ORDER_ORIGIN = {
    "1": "API抓单",
    "2": "手工建单",
    "3": "excel导入",
    "4": "API抓单",
}
ORDER_ORIGIN_DEFAULT = "现款销售"

# Sales platform.
PLATFORM = {
    "0": "线下",
    "1": "淘宝",
    "2": "淘宝分销",
    "3": "京东",
    "14": "唯品会",
    "32": "微店",
    "39": "拼多多",
    "69": "放心购(抖店）",
    "139": "抖音供销",
}

# Order status.
ORDER_STATUS = {
    "10": "未确认",
    "20": "待尾款",
    "30": "待发货",
    "40": "部分发货",
    "50": "已发货",
    "60": "已签收",
    "70": "已完成",
    "80": "已退款",
    "90": "已关闭",
}

# Thresholds, codes and rates.
SHIPPED_FROM_STATUS = 95
RECEIPT_DONE_STATUS = "80"
RECEIPT_DONE_LABEL = "已完成"
DEFAULT_TAX_RATE = "0.13"
WHOLESALE_SHOP = "010"
REPORT_STATUSES = ("已完成", "已发货")
ONLINE_TRADE_TYPES = ("网店销售", "线下零售", "订单补发", "批发业务")

# Page sizes and time spans.
SALES_PAGE_SIZE = 100
PURCHASE_PAGE_SIZE = 50
ORDER_PAGE_SIZE = 100
LOOKBACK_DAYS = 2
BACKFILL_DAYS = 12
SHORT_WINDOW_DAYS = 7
LONG_WINDOW_DAYS = 30

# Report labels.
TOTAL_LABEL = "汇总"
UNKNOWN_LABEL = "未知分类"
CHANNEL_ONLINE = "网店销售"
CHANNEL_WHOLESALE = "批发业务"
REMARK_UNMATCHED = "线下-置换/寄样"

# Phrase and marker of the original order reference in a remark.
ORDER_REF_PHRASE = "售后返修换新"
ORDER_REF_MARKER = "原订单号"

# Report headings, in column order.
SALES_HEADINGS = ("销售类型", "出库件数", "销售金额", "成本价", "成本价/销售金额", "利润")
INVENTORY_HEADINGS = ("分类", "库存件数", "成本金额(RMB)", "出库件数", "销售金额")
SKU_HEADINGS = ("商家编码", "货品名称", "出库件数", "支付金额", "总成本(未税)", "ERP库存件数")
PURCHASE_HEADINGS = ("商家编码", "货品名称")
PURCHASE_AMOUNT_SUFFIX = "采购金额"
PURCHASE_COUNT_SUFFIX = "采购件数"

# Section titles after the window bounds, and the empty message.
TITLE_CHANNEL = "销售情况总概"
TITLE_ONLINE = "线上渠道销售情况"
TITLE_OFFLINE = "线下渠道销售情况"
TITLE_INVENTORY = "库存情况"
SHEET_SKU_OFFLINE = "线下销售情况"
SHEET_SKU_ONLINE = "线上销售情况"
SHEET_PURCHASES = "采购情况(金额)"
EMPTY_PURCHASES = "近一个月无采购信息"
MISSING_UNIT_LINE = "卖家账号 = %s, 货品编码 = %s"
