"""Run parameters. Operators never read the clock; the planning day is `as_of`."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from datetime import date, timedelta


@dataclasses.dataclass(frozen=True)
class Params:
    as_of: date
    target_year: int | None = None
    """ISO year whose lost sales count as revenue at risk; the year of `as_of` when None."""
    horizon: int = 104
    """Weeks planned by the waterfall."""
    drop_week_53: bool = True
    """Leave ISO week 53 out of the calendar, and with it the quantities that fall into it."""
    missing_stock: str = "zero"
    """"zero": a ref without stock opens at 0. "null": all its stock figures stay NULL."""
    double_deduct: bool = False
    """Take the location deductions off the opening stock a second time."""
    raw_join: bool = False
    """Join open PO lines to every shipment header snapshot instead of one total per PO line."""
    fan_out_master: bool = False
    """Repeat a PO line for every latest master row of its sku instead of using one row per sku."""
    inbound_fallback: str = "row"
    """"row": first known date per row. "column": expected delivery date, else the default."""
    po_routes: str = "all"
    """Routes used for purchase orders: "all", or only those "po" knows."""
    inbound_routes: str = "all"
    """Routes used for shipments: "all", or only those "inbound" knows."""
    lead_time_routes: str = "all"
    """Routes used for lead times: "all", or the "legacy" map."""
    po_route_default: int = 39
    po_buffer_default: int = 39
    inbound_route_default: int = 45
    route_default: int = 45
    production_default: int = 45
    lead_time_buffers: str = "table"
    """Port buffers for lead times: the "table", or by "market" alone, none where it is the origin."""
    processing_days: int = 15
    """Days added to a lead time for processing the order."""
    carton_default: int = 1
    """Units per carton where none are known."""
    markets: tuple[tuple[str, str], ...] = ()
    """Raw market labels with the market they stand for, besides or instead of the built-in ones."""
    quantity_decimals: int = 6
    """Decimals that the waterfall keeps of quantities; a DECIMAL source with more keeps all of its own."""

    def __post_init__(self):
        if self.missing_stock not in ("zero", "null"):
            raise ValueError(f"missing_stock: {self.missing_stock!r}")
        if self.inbound_fallback not in ("row", "column"):
            raise ValueError(f"inbound_fallback: {self.inbound_fallback!r}")
        if self.lead_time_buffers not in ("table", "market"):
            raise ValueError(f"lead_time_buffers: {self.lead_time_buffers!r}")

    def market_map(self, built_in: Mapping[str, str]) -> dict[str, str]:
        """Built-in market names with those of this run on top."""
        return {**built_in, **dict(self.markets)}

    @property
    def year(self) -> int:
        return self.target_year if self.target_year is not None else self.as_of.year

    @property
    def plan_from(self) -> date:
        """First day of the month two months before `as_of`."""
        month = self.as_of.year * 12 + self.as_of.month - 1 - 2
        return date(month // 12, month % 12 + 1, 1)

    @property
    def plan_to(self) -> date:
        """Last day of the year after `as_of`."""
        return date(self.as_of.year + 1, 12, 31)

    @property
    def calendar_end(self) -> date:
        """Last day the calendar may step on: the day before 31 December two years on."""
        return date(self.as_of.year + 2, 12, 31) - timedelta(days=1)

    @property
    def weeks(self) -> list[date]:
        """Mondays of all weeks of the calendar, at most 157."""
        steps = range((self.calendar_end - self.as_of).days // 7 + 1)
        days = [self.as_of + timedelta(weeks=step) for step in steps]
        return [
            day - timedelta(days=day.weekday())
            for day in days
            if not (self.drop_week_53 and day.isocalendar().week == 53)
        ]

    @property
    def horizon_end(self) -> date | None:
        """Monday of the last week of the calendar; none if it has no week."""
        return max(self.weeks, default=None)

    @property
    def labels(self) -> list[str]:
        """Labels of the planned weeks in order."""
        weeks = [monday.isocalendar() for monday in self.weeks[: self.horizon]]
        return [f"CW{week:02d}-{year}" for year, week, _ in weeks]
