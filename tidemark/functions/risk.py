"""Health-factor and position-size rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import DEBOUNCE_MS, DEFAULTS, RISK_LEVELS, Settings


def risk_level(health: Column, settings: Settings = DEFAULTS) -> Column:
    floors = (
        settings.health_safe,
        settings.health_warning,
        settings.health_danger,
        settings.health_critical,
    )
    rule = F
    for floor, level in zip(floors, RISK_LEVELS):
        rule = rule.when(health >= F.lit(floor), F.lit(level))
    return rule.otherwise(F.lit(RISK_LEVELS[-1]))


def risk_rank(level: Column) -> Column:
    """1 for SAFE up to 5 for LIQUIDATABLE, 0 for an unknown level."""
    return F.array_position(F.array(*[F.lit(x) for x in RISK_LEVELS]), level).cast("int")


def debounce_ms(level: Column) -> Column:
    rule = F
    for name, millis in DEBOUNCE_MS.items():
        rule = rule.when(level == name, F.lit(millis).cast("long"))
    return rule


def size_tier(collateral_usd: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(collateral_usd >= F.lit(settings.tier_whale_usd), "whale")
        .when(collateral_usd >= F.lit(settings.tier_large_usd), "large")
        .when(collateral_usd >= F.lit(settings.tier_medium_usd), "medium")
        .otherwise("small")
    )


def utilization(debt: Column, collateral: Column) -> Column:
    """Debt over collateral as a double; 0 where there is no collateral."""
    return F.when(collateral > 0, debt.cast("double") / collateral.cast("double")).otherwise(F.lit(0.0))
