"""Thresholds and names that steer cleaning, modelling and analysis."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

# Sale codes, return reasons and assumptions of the marketplace being analysed.
MEGA_SALE_CODES = ("MEGA1111", "WHITEFRI", "SALE1212", "AZADI14")
RETURN_REASONS = {
    "size_or_fit": "Size or fit issue",
    "not_as_described": "Not as described",
    "defective_or_damaged": "Defective or damaged",
    "arrived_too_late": "Arrived too late",
    "changed_mind": "Changed mind",
}
AB_GROUPS = ("control", "treatment")
AB_DEVICES = ("Android", "iOS", "Desktop")


@dataclass(frozen=True)
class Rules:
    """One marketplace's settings; the defaults are the published ones."""

    as_of: dt.date = dt.date(2026, 6, 30)
    qa_prefix: str = "TEST"
    legacy_until: dt.datetime = dt.datetime(2025, 1, 1)
    bot_seconds: int = 3
    price_slips: tuple[tuple[int, int], ...] = ((50, 100), (5, 10))
    repeat_days: int = 90
    mega_sale_codes: tuple[str, ...] = MEGA_SALE_CODES
    value_band: Decimal = Decimal(15000)
    rto_unit_cost: int = 420
    watched_courier: str = "RapidRoute"
    max_cohort_offset: int = 12
    return_reasons: dict[str, str] = field(default_factory=lambda: dict(RETURN_REASONS))
    misdescribed_reason: str = "Not as described"
    seller_min_items: int = 50
    seller_z: float = 3.0
    rfm_buckets: int = 5


DEFAULT_RULES = Rules()
