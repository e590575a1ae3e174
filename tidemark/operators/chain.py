"""Block-chain consistency: confirmation depth, slices, reorganisations, checkpoints, polling tiers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DAY_MS, DEFAULTS
from tidemark.functions.values import moment_ms

# Health factors below which a position is polled more often.
HIGH_RISK_HEALTH = 1.5
CRITICAL_HEALTH = 1.2


def confirmed_head(blocks: DataFrame, depth: int = DEFAULTS.confirmation_depth) -> Column:
    """Highest block that is `depth` blocks deep, never below 0, as a scalar subquery.

    The subquery runs once and its value reaches the outer scan as a literal.
    """
    head = blocks.agg(F.greatest(F.max("block_number") - depth, F.lit(0)).alias("head"))
    return head.scalar()


def confirmed(blocks: DataFrame, depth: int = DEFAULTS.confirmation_depth) -> DataFrame:
    return blocks.where(F.col("block_number") <= confirmed_head(blocks, depth))


def block_slice(df: DataFrame, start: int, end: int, column: str = "block_number") -> DataFrame:
    """Rows of an inclusive block range; the bounds reach the scan as literals."""
    return df.where(F.col(column).between(start, end))


def _with_predecessor(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Each block beside the hash of the block one number lower, if there is one.

    An equi-join on the number spreads over the cluster; a `lag` over all
    blocks would pull the chain into one partition.
    """
    child = blocks.select(
        *keys, "block_number", "block_hash", "parent_hash", (F.col("block_number") - 1).alias("_parent_number")
    )
    parent = blocks.select(
        *keys, F.col("block_number").alias("_parent_number"), F.col("block_hash").alias("expected_parent")
    )
    return child.join(parent, [*keys, "_parent_number"], "left")


def parent_mismatches(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Blocks whose parent hash is not the hash of the block before."""
    keys = keys or []
    return (
        _with_predecessor(blocks, keys)
        .where(F.col("expected_parent").isNotNull() & (F.col("parent_hash") != F.col("expected_parent")))
        .select(*keys, "block_number", "block_hash", "expected_parent", F.col("parent_hash").alias("actual_parent"))
    )


def block_gaps(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Blocks with no predecessor, apart from the first block of the table (of each key)."""
    keys = keys or []
    orphans = _with_predecessor(blocks, keys).where(F.col("expected_parent").isNull())
    first = blocks.groupBy(*keys).agg(F.min("block_number").alias("_first"))
    if keys:
        orphans = orphans.join(first, keys).where(F.col("block_number") > F.col("_first"))
    else:
        orphans = orphans.where(F.col("block_number") > first.scalar())
    return orphans.select(*keys, (F.col("block_number") - 1).alias("missing_block"), "block_number")


def verify_checkpoint(
    checkpoints: DataFrame, blocks: DataFrame, depth: int = DEFAULTS.confirmation_depth, start_block: int = 0
) -> DataFrame:
    """Where each indexer resumes: after its checkpoint if the stored hash still
    matches the chain, otherwise at the confirmed head. A configured start wins."""
    chain = blocks.select(F.col("block_number").alias("last_block"), F.col("block_hash").alias("chain_hash"))
    head = confirmed_head(blocks, depth)
    saved = F.coalesce("block_hash", F.lit(""))
    status = (
        F.when(F.lit(start_block) > 0, "configured")
        .when(F.coalesce("last_block", F.lit(0)) <= 0, "no_checkpoint")
        .when(saved == "", "unverified")
        .when(F.col("chain_hash").isNull(), "block_missing")
        .when(saved != F.col("chain_hash"), "hash_mismatch")
        .otherwise("verified")
    )
    return (
        checkpoints.join(chain, "last_block", "left")
        .withColumn("status", status)
        .select(
            "indexer",
            "last_block",
            "status",
            F.when(F.col("status") == "configured", F.lit(start_block).cast("bigint"))
            .when(F.col("status").isin("verified", "unverified"), F.col("last_block") + 1)
            .otherwise(head)
            .alias("start_block"),
        )
    )


def poll_tiers(latest: DataFrame, activity: DataFrame, as_of: str | datetime) -> DataFrame:
    """How often each account is polled: by risk first, then by activity in the last day.

    `latest` holds user_address and health_factor, `activity` user_address and
    last_active_ms. A user of several protocols counts by the lowest health
    factor. Accounts that are neither risky nor ever active are not polled.
    """
    cutoff = moment_ms(as_of) - DAY_MS
    joined = latest.groupBy("user_address").agg(F.min("health_factor").alias("health_factor")).join(
        activity.select("user_address", "last_active_ms"), "user_address", "full_outer"
    )
    tier = (
        F.when(F.col("health_factor") < HIGH_RISK_HEALTH, "high_risk")
        .when(F.col("last_active_ms") > cutoff, "active")
        .when(F.col("last_active_ms") < cutoff, "inactive")
    )
    severity = F.when(F.col("health_factor") < CRITICAL_HEALTH, "critical").when(
        F.col("health_factor") < HIGH_RISK_HEALTH, "warning"
    )
    return (
        joined.select("user_address", tier.alias("tier"), severity.alias("severity"), "health_factor", "last_active_ms")
        .where(F.col("tier").isNotNull())
    )
