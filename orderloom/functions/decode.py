"""Codes to labels."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom import fixed_values as V


def literal_map(table: Mapping[str, str]) -> Column:
    """The table as one map literal."""
    return F.expr(f"map({', '.join(map(_quoted, chain.from_iterable(table.items())))})")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def decode(code: Column, table: Mapping[str, str], default: str) -> Column:
    """Label of a code; NULL and unknown codes get the default."""
    return F.coalesce(F.try_element_at(literal_map(table), code.cast("string")), F.lit(default))


def relabel(name: Column, table: Mapping[str, str]) -> Column:
    """Replace a name found in the table and let every other one through."""
    if not table:
        return name
    return F.coalesce(F.try_element_at(literal_map(table), name), name)


def shipment_status(code: Column) -> Column:
    return decode(code, V.SHIPMENT_STATUS, V.SHIPMENT_STATUS_DEFAULT)


def shipment_trade_status(code: Column) -> Column:
    return decode(code, V.SHIPMENT_TRADE_STATUS, V.SHIPMENT_TRADE_STATUS_DEFAULT)


def trade_type(code: Column) -> Column:
    return decode(code, V.TRADE_TYPE, V.TRADE_TYPE_DEFAULT)


def order_origin(code: Column) -> Column:
    return decode(code, V.ORDER_ORIGIN, V.ORDER_ORIGIN_DEFAULT)


def platform(code: Column) -> Column:
    """Platform name; a code without a name stays as it is."""
    return relabel(code.cast("string"), V.PLATFORM)


def order_status(code: Column) -> Column:
    """Order status name; a code without a name stays as it is."""
    return relabel(code.cast("string"), V.ORDER_STATUS)
