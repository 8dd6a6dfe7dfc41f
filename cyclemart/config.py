"""Business parameters. Every rule the operators apply can be changed here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Operation types, holidays, commission tiers and list sizes that results depend on.
SALE_OPERATIONS = (3107, 3108, 3109, 3112, 3200, 3207, 3216, 3217)
RETURN_OPERATIONS = (2200, 2201, 2209)
APPROVED_STATUS = "A"
HOLIDAYS = (date(2025, 12, 25), date(2026, 1, 1), date(2026, 2, 17))
RATE_FLOOR = date(2026, 1, 1)
DEFAULT_RATE = "0.01"
COMMISSION_TIERS = (
    ("1.50", "0.0150"),
    ("1.40", "0.0140"),
    ("1.30", "0.0130"),
    ("1.20", "0.0120"),
    ("1.10", "0.0110"),
    ("1.00", "0.0105"),
)
BASE_TIER_RATE = "0.0100"
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
CORPORATE_COMPANY = (0, "CORPORATIVO (METAS)")
NO_BRAND = (0, "SEM MARCA")


@dataclass(frozen=True)
class SalesRules:
    sale_operations: tuple[int, ...] = SALE_OPERATIONS
    return_operations: tuple[int, ...] = RETURN_OPERATIONS
    approved_status: str = APPROVED_STATUS
    holidays: tuple[date, ...] = HOLIDAYS
    rate_floor: date = RATE_FLOOR
    default_rate: str = DEFAULT_RATE
    tiers: tuple[tuple[str, str], ...] = COMMISSION_TIERS
    base_tier_rate: str = BASE_TIER_RATE
    ranking_size: int = 10
    list_depth: int = 50
    profile_products: int = 5
    profile_sellers: int = 3
    profile_days: int = 180
    top_sellers: int = 5
    lookback_days: int = 60
    lookahead_days: int = 10
