"""Groups a report is made over, derived from codes and remarks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom import fixed_values as V


def channel(
    shop_no: Column,
    wholesale_shop: str = V.WHOLESALE_SHOP,
    online: str = V.CHANNEL_ONLINE,
    wholesale: str = V.CHANNEL_WHOLESALE,
) -> Column:
    """Online or wholesale. A line without a shop counts as wholesale."""
    return F.when(shop_no != wholesale_shop, online).otherwise(wholesale)


def remark_class(
    remark: Column, phrase: str, matched: str, unmatched: str = V.REMARK_UNMATCHED
) -> Column:
    """Split by a phrase in the remark; no remark counts as no match."""
    return F.when(remark.contains(phrase), matched).otherwise(unmatched)


def tax_rate(rate: Column, default: str = V.DEFAULT_TAX_RATE) -> Column:
    """A rate of zero means the default rate."""
    return F.when(rate == 0, F.lit(default).cast("decimal(9,4)")).otherwise(rate)
