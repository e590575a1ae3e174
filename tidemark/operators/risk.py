"""Risk state per user and the alerts on its transitions (batch form)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DAY_MS, DEBOUNCE_MS, DEFAULTS, STATE_TTL_MS, Settings
from tidemark.functions.risk import debounce_ms, risk_level, risk_rank
from tidemark.functions.values import dash_key, from_millis
from tidemark.operators.timeline import keep_spaced, with_history

ORDER = ["timestamp", "block_number", "protocol", "chain", "health_factor"]


def risk_transitions(
    positions: DataFrame,
    keys: tuple[str, ...] = ("user_address",),
    ttl_ms: int = STATE_TTL_MS,
    settings: Settings = DEFAULTS,
    bucket_ms: int = DAY_MS,
) -> DataFrame:
    """Every position with its level, the state before it and the last level change.

    State older than `ttl_ms` counts as absent: the row then starts afresh.
    """
    state = F.struct(
        F.col("risk_level").alias("level"),
        F.col("health_factor").alias("health"),
        F.col("timestamp").alias("at"),
    )
    rows = (
        positions.where(F.col("timestamp").isNotNull())
        .withColumn("risk_level", risk_level(F.col("health_factor"), settings))
        .withColumn("_state", state)
    )

    def live(prev: Column, current: Column) -> Column:
        return prev.isNotNull() & (current["at"] - prev["at"] < ttl_ms)

    def changed(prev: Column, current: Column) -> Column:
        old = F.when(live(prev, current), prev["level"]).otherwise(current["level"])
        return F.when(
            ~F.coalesce(live(prev, current), F.lit(False)) | (prev["level"] != current["level"]),
            F.struct(old.alias("level"), current["at"].alias("at")),
        )

    history = with_history(rows, list(keys), ORDER, "_state", changed, bucket_ms)
    fresh = F.col("timestamp") - F.col("prev.at") < ttl_ms
    return history.select(
        *[F.col(c) for c in positions.columns],
        "risk_level",
        F.col("mark.level").alias("previous_risk_level"),
        F.col("mark.at").alias("risk_changed_ms"),
        F.when(fresh, F.col("prev.level")).alias("state_risk_level"),
        F.when(fresh, F.col("prev.health")).alias("state_health_factor"),
    )


def metrics_record() -> list[Column]:
    """The columns of one risk-metrics row; the version is the event time."""
    return [
        F.col("chain"),
        F.col("user_address"),
        F.col("protocol"),
        F.col("health_factor"),
        F.col("risk_level"),
        F.col("previous_risk_level"),
        from_millis(F.col("risk_changed_ms")).alias("risk_changed_at"),
        F.col("total_collateral_usd"),
        F.col("total_debt_usd"),
        F.col("available_borrow_usd"),
        F.col("ltv"),
        F.col("liquidation_threshold"),
        F.col("block_number"),
        from_millis(F.col("timestamp")).alias("updated_at"),
        F.col("timestamp").alias("version"),
    ]


def risk_metrics(positions: DataFrame, **options) -> DataFrame:
    """One metrics row per position."""
    return risk_transitions(positions, **options).select(*metrics_record())


def alert_rules(settings: Settings = DEFAULTS) -> dict[str, Column]:
    """Type, severity and condition over `state_*` (before) and the current row."""
    level, old = F.col("risk_level"), F.col("state_risk_level")
    health, old_health = F.col("health_factor"), F.col("state_health_factor")
    rose = risk_rank(level) > risk_rank(old)
    back_to_safe = (risk_rank(level) < risk_rank(old)) & (level == "SAFE")
    newly_liquidatable = (level == "LIQUIDATABLE") & (old != "LIQUIDATABLE")
    rapid = F.when(old_health > 0, (old_health - health) / old_health > settings.rapid_decline).otherwise(False)
    return {
        "fires": old.isNotNull() & (rose | back_to_safe | newly_liquidatable | rapid),
        "alert_type": F.when(newly_liquidatable, "LIQUIDATION_RISK")
        .when(rapid, "RAPID_HF_DECLINE")
        .when(rose, "RISK_INCREASED")
        .otherwise("RISK_DECREASED"),
        "severity": F.when(newly_liquidatable, "CRITICAL")
        .when(rapid, "HIGH")
        .when(rose & (level == "CRITICAL"), "HIGH")
        .when(rose & (level == "DANGER"), "WARNING")
        .otherwise("INFO"),
        "change_pct": F.when(old_health > 0, (health - old_health) / old_health * 100).otherwise(F.lit(0.0)),
    }


def alert_candidates(transitions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Transitions that raise an alert before debouncing."""
    rules = alert_rules(settings)
    return transitions.where(rules["fires"]).select(
        dash_key("chain", "protocol", "user_address", "block_number", "timestamp").alias("_id"),
        rules["alert_type"].alias("alert_type"),
        rules["severity"].alias("severity"),
        "chain",
        "protocol",
        "user_address",
        F.col("state_risk_level").alias("previous_risk_level"),
        F.col("risk_level").alias("current_risk_level"),
        F.col("state_health_factor").alias("previous_health_factor"),
        F.col("health_factor").alias("current_health_factor"),
        rules["change_pct"].alias("health_factor_change_pct"),
        "total_collateral_usd",
        "total_debt_usd",
        "liquidation_threshold",
        "ltv",
        "block_number",
        F.col("timestamp").alias("event_ms"),
    ).withColumn("alert_id", F.md5("_id")).drop("_id")


def debounce(candidates: DataFrame, keys: tuple[str, ...] = ("user_address",)) -> DataFrame:
    """Drop alerts that follow the last emitted one of the user too closely.

    The window belongs to the new level; the clock moves on emitted alerts only.
    """
    spaced = keep_spaced(
        candidates.withColumn("_gap", debounce_ms(F.col("current_risk_level"))),
        list(keys),
        "event_ms",
        "_gap",
        ["block_number", "protocol", "chain", "current_health_factor"],
    )
    return spaced.drop("_gap")


def alert_record() -> list[Column]:
    event_time = from_millis(F.col("event_ms"))
    return [
        F.col(c)
        for c in (
            "alert_id",
            "alert_type",
            "severity",
            "chain",
            "protocol",
            "user_address",
            "previous_risk_level",
            "current_risk_level",
            "previous_health_factor",
            "current_health_factor",
            "health_factor_change_pct",
            "total_collateral_usd",
            "total_debt_usd",
            "liquidation_threshold",
            "ltv",
            "block_number",
        )
    ] + [event_time.alias("event_time"), event_time.alias("processing_time")]


def risk_alerts(positions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Positions to debounced alerts."""
    return debounce(alert_candidates(risk_transitions(positions, settings=settings), settings)).select(
        *alert_record()
    )


def to_alert_json(alerts: DataFrame) -> DataFrame:
    """The message shape read by alert consumers: a key and a JSON value with nested details."""
    details = F.struct(
        "current_health_factor",
        "previous_health_factor",
        "health_factor_change_pct",
        "current_risk_level",
        "previous_risk_level",
        F.col("total_collateral_usd").cast("string").alias("total_collateral_usd"),
        F.col("total_debt_usd").cast("string").alias("total_debt_usd"),
    )
    body = F.struct(
        "alert_id",
        "chain",
        "protocol",
        "user_address",
        "alert_type",
        "severity",
        details.alias("details"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
    )
    return alerts.select(F.col("user_address").alias("key"), F.to_json(body).alias("value"))


SALTS = 64


def route_alerts(alerts: DataFrame, configs: DataFrame) -> DataFrame:
    """Alerts matched to the users who asked for them.

    `configs` holds user_id, address, min_severity and an optional list of
    alert types; a NULL address watches every address. The two cases join
    separately: watched addresses by key, and watch-everything users by the
    severity rank, so no pair is formed that does not lead to a result row.
    There are four ranks only, so alerts are dealt to SALTS parts of each and
    the watchers of a rank are copied to every part.
    """
    # Severities from lowest to highest.
    ranks = F.array(*[F.lit(s) for s in ("INFO", "WARNING", "HIGH", "CRITICAL")])
    ranked = alerts.withColumn("_rank", F.array_position(ranks, F.col("severity")))
    wanted = configs.select(
        "user_id",
        F.lower("address").alias("_address"),
        F.array_position(ranks, F.col("min_severity")).alias("_least"),
        F.col("alert_types").alias("_types"),
    )
    passes = (F.col("_rank") >= F.col("_least")) & (
        F.col("_types").isNull() | F.array_contains("_types", F.col("alert_type"))
    )
    by_address = ranked.join(
        wanted.where(F.col("_address").isNotNull()), F.lower("user_address") == F.col("_address")
    ).where(passes)
    watching_all = (
        wanted.where(F.col("_address").isNull())
        .withColumn("_rank", F.explode(F.sequence(F.col("_least"), F.lit(4).cast("bigint"))))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = ranked.withColumn("_salt", F.pmod(F.xxhash64("alert_id", "user_address"), F.lit(SALTS)).cast("int"))
    by_rank = salted.join(watching_all, ["_rank", "_salt"]).where(passes)
    names = ["user_id", *alerts.columns]
    return by_address.select(*names).unionByName(by_rank.select(*names))
