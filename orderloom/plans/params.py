"""Parameters of the reports. Dates are given, never taken from a clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from orderloom import fixed_values as V


@dataclass(frozen=True)
class ReportParams:
    start: dt.date
    end: dt.date
    long_start: dt.date
    warehouses: tuple[str, ...]
    online_shops: tuple[str, ...]
    remark_phrase: str
    remark_label: str
    offline_shops: tuple[str, ...] = (V.WHOLESALE_SHOP, "")
    trade_types: tuple[str, ...] = V.ONLINE_TRADE_TYPES
    statuses: tuple[str, ...] = V.REPORT_STATUSES
    wholesale_shop: str = V.WHOLESALE_SHOP
    store_names: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def as_of(cls, day: dt.date, **rest) -> ReportParams:
        """The usual windows: the last week and the last month up to a day."""
        return cls(
            start=day - dt.timedelta(days=V.SHORT_WINDOW_DAYS),
            end=day,
            long_start=day - dt.timedelta(days=V.LONG_WINDOW_DAYS),
            **rest,
        )
