"""Risk state per user over a stream of positions. Users are dealt to shards, and one state row holds the users of a shard."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.config import DEBOUNCE_MS, DEFAULTS, STATE_TTL_MS, Settings
from tidemark.functions.risk import risk_level
from tidemark.operators.risk import ORDER, alert_candidates, alert_record, metrics_record

#: Groups that users are dealt to: a group costs some milliseconds a batch, which a user alone would cost as well.
SHARDS = 2_048

# Of each user of a shard: level, previous level, time of the last change, health factor, time of the last position, time
# of the last emitted alert, and the clock when the last position came.
STATE = (
    "users array<string>, level array<string>, previous array<string>, changed_ms array<long>, health array<double>, "
    "seen_ms array<long>, alerted_ms array<long>, touched_ms array<long>"
)


def track_users(
    key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState, decline: float = DEFAULTS.rapid_decline
) -> Iterator[pd.DataFrame]:
    """Walk the new positions of a shard's users, each in event order, and remember where they end."""
    if state.hasTimedOut:
        state.remove()
        return
    rows = pd.concat(list(chunks)).sort_values(["user_address", *ORDER], kind="stable")
    clock = state.getCurrentProcessingTimeMs()
    held = {user: rest for user, *rest in zip(*state.get, strict=True) if clock - rest[-1] < STATE_TTL_MS} if state.exists else {}
    previous, changed, old_levels, old_healths, fires = [], [], [], [], []
    for user, level, rank, health, at in zip(
        rows["user_address"], rows["risk_level"], rows["_rank"], rows["health_factor"], rows["timestamp"]
    ):
        at = int(at)
        known = held.get(user)
        alerted = known[5] if known else 0
        if known and at - known[4] >= STATE_TTL_MS:
            known = None
        if known is None:
            before, since = level, at
        elif known[0] != level:
            before, since = known[0], at
        else:
            before, since = known[1], known[2]
        fire = False
        if known is not None:
            old_rank = LEVEL_RANK[known[0]]
            fire = (
                rank > old_rank
                or (rank < old_rank and level == "SAFE")
                or (known[3] > 0 and (known[3] - health) / known[3] > decline)
            ) and at - alerted >= DEBOUNCE_MS[level]
        if fire:
            alerted = at
        previous.append(before)
        changed.append(since)
        old_levels.append(known[0] if known else None)
        old_healths.append(known[3] if known else None)
        fires.append(fire)
        held[user] = (level, before, since, float(health), at, alerted, clock)
    state.update(tuple(list(column) for column in zip(*((user, *rest) for user, rest in held.items()), strict=True)))
    # The timeout only frees memory: expiry itself is judged above, by event time.
    state.setTimeoutDuration(STATE_TTL_MS)
    yield rows.drop(columns=["_rank", "_shard"]).assign(
        previous_risk_level=previous,
        risk_changed_ms=changed,
        state_risk_level=old_levels,
        state_health_factor=pd.array(old_healths, dtype="Float64").astype("float64"),
        fires=fires,
    )


LEVEL_RANK = {name: i for i, name in enumerate(DEBOUNCE_MS, start=1)}


def risk_stream(
    positions: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Transitions of a position stream; `metrics_of` and `alerts_of` select the two outputs.

    There is no watermark, which would delete late positions: each counts when its micro-batch arrives, and the rows of
    one micro-batch count in event order.
    """
    keep = [
        "chain",
        "protocol",
        "user_address",
        "block_number",
        "health_factor",
        "total_collateral_usd",
        "total_debt_usd",
        "available_borrow_usd",
        "ltv",
        "liquidation_threshold",
        "timestamp",
    ]
    level = risk_level(F.col("health_factor"), settings)
    ranks = F.create_map(*[F.lit(x) for pair in LEVEL_RANK.items() for x in pair])
    source = (
        positions.where(F.col("timestamp").isNotNull())
        .select(*keep, level.alias("risk_level"), F.timestamp_millis("timestamp").alias("event_time"))
        .withColumns({"_rank": ranks[F.col("risk_level")], "_shard": F.pmod(F.xxhash64("user_address"), F.lit(SHARDS))})
    )
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    columns = [*keep, "risk_level", "event_time"]
    output = ", ".join(f"{c} {types[c]}" for c in columns) + (
        ", previous_risk_level string, risk_changed_ms long, state_risk_level string, "
        "state_health_factor double, fires boolean"
    )
    decline = settings.rapid_decline

    def step(key, chunks, state):
        return track_users(key, chunks, state, decline)

    return source.groupBy("_shard").applyInPandasWithState(
        step, output, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def metrics_of(transitions: DataFrame) -> DataFrame:
    return transitions.select(*metrics_record())


def alerts_of(transitions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows the state step let through, shaped by the same rules as the batch form."""
    return alert_candidates(transitions.where("fires"), settings).select(*alert_record())
