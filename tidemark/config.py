"""Thresholds and fixed names shared by every model."""

from __future__ import annotations

from dataclasses import dataclass

# Risk levels from safest to worst; the position is the ordinal.
RISK_LEVELS = ("SAFE", "WARNING", "DANGER", "CRITICAL", "LIQUIDATABLE")

# Debounce window in milliseconds by the alert's new risk level.
DEBOUNCE_MS = {
    "SAFE": 300_000,
    "WARNING": 300_000,
    "DANGER": 120_000,
    "CRITICAL": 60_000,
    "LIQUIDATABLE": 0,
}

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
STATE_TTL_MS = 7 * DAY_MS


@dataclass(frozen=True)
class Settings:
    """Model variables. Defaults are the documented production values."""

    health_safe: float = 2.0
    health_warning: float = 1.5
    health_danger: float = 1.2
    health_critical: float = 1.0
    tier_whale_usd: int = 1_000_000
    tier_large_usd: int = 100_000
    tier_medium_usd: int = 10_000
    whale_position_usd: int = 1_000_000
    whale_transfer_usd: int = 1_000_000
    whale_window_days: int = 30
    whale_movement_min_usd: int = 10_000
    rapid_decline: float = 0.2
    bot_day_count: int = 100
    bot_hours: int = 20
    chain: str = "base"
    confirmation_depth: int = 6
    default_start_date: str = "2024-01-01"


DEFAULTS = Settings()
