"""Broadcast hints behind a size check.

``broadcast_if_small(df)`` reads the optimizer's size estimate of ``df``
(no Spark job) and adds the broadcast hint only when it is at most
``max_bytes``; above that the DataFrame is returned unhinted and the join
is planned as a shuffle join (AQE may still broadcast from runtime sizes
below spark.sql.autoBroadcastJoinThreshold). Every hint in this package goes
through here, also for tables that are small by definition (regions,
nations, code lists), so a changed input cannot force a huge broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    try:
        size = estimated_bytes(df)
    except Exception:  # noqa: BLE001 - no estimate: do not force a broadcast
        return df
    return F.broadcast(df) if size <= max_bytes else df
