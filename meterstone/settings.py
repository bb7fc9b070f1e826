"""Run settings. One frozen object travels through every plan as literals."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Business thresholds that results depend on.
WIND_BANDS = (
    (0.0, 25.0, "Under 25 mph", 1),
    (25.0, 35.0, "25-35 mph", 2),
    (35.0, 45.0, "35-45 mph", 3),
    (45.0, 55.0, "45-55 mph", 4),
    (55.0, 999.0, "55+ mph", 5),
)
RISK_LEVELS = (
    (0.0, 1.5, "Normal", 1),
    (1.5, 3.0, "Elevated", 2),
    (3.0, 8.0, "High", 3),
    (8.0, 1e9, "Severe", 4),
)


@dataclass(frozen=True)
class Settings:
    """Dates and thresholds of one warehouse build.

    ``window_start`` .. ``window_end`` is the reporting window, ``as_of`` the
    business date balances and ages are measured at.
    """

    as_of: date = date(2026, 9, 30)
    window_start: date = date(2024, 10, 1)
    window_end: date = date(2026, 9, 30)
    calendar_start: date = date(2014, 1, 1)
    calendar_end: date = date(2026, 12, 31)
    backtest_start: date = date(2026, 4, 1)
    spike_factor: float = 15.0
    major_event_beta: float = 2.5
    top_accounts: int = 2000
    recent_bill_months: int = 3
    wind_bands: tuple = field(default=WIND_BANDS)
    risk_levels: tuple = field(default=RISK_LEVELS)
