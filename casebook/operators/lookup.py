"""Names for id lists of several roles from one dimension of any size.

The same dimension is joined once per role: each list is exploded with its
ordinals, joined by id in a shuffle, and put together again in order. Nothing of
the dimension is kept on the rows, so its size does not matter. An id that very
many rows hold is dealt out by a salt: its rows go to as many tasks as they fill,
and its dimension row is repeated for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.sources.io import materialize

ROWS_PER_KEY = 100_000               # an id with more rows is split
MOST_SPLIT = 10_000                  # at most so many ids are split, so their table can be broadcast


def split_ids(tagged: DataFrame, roles, rows_per_key: int, name: str) -> DataFrame:
    """``(_id, _parts)`` of the ids that more than ``rows_per_key`` list entries hold."""
    def none(r):
        return F.coalesce(F.col(r), F.array().cast(tagged.schema[r].dataType))
    total = tagged.agg(F.sum(sum((F.size(none(r)) for r in roles), F.lit(0)).cast("long"))).first()[0] or 0
    least = max(rows_per_key, total // MOST_SPLIT)
    counts = tagged.select(F.explode(F.concat(*(none(r) for r in roles))).alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    return materialize(counts.where((F.col("_n") > least) & F.col("_id").isNotNull())
                       .select("_id", F.ceil(F.col("_n") / least).cast("int").alias("_parts")), f"{name}_split")


def names_by_role(rows: DataFrame, roles, dim: DataFrame, id_col: str, name_col: str,
                  rows_per_key: int = ROWS_PER_KEY, stage: str = "role_rows") -> DataFrame:
    """``rows`` with ``<role>_found`` for each array column in ``roles``: (at, id, name) structs by position.

    Ids without a dimension row and null ids are left out; a null list gives an
    empty one. Repeated rows stay repeated.
    """
    roles = list(roles)
    tagged = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), stage)
    split = split_ids(tagged, roles, rows_per_key, stage)
    d = dim.select(F.col(id_col).alias("_id"), F.col(name_col).alias("_name")).join(broadcast_if_small(split), "_id", "left")
    d = d.select("_id", "_name", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_salt"))
    found = None
    for r in roles:
        e = tagged.select("_row", F.posexplode(r).alias("_at", "_id")).join(broadcast_if_small(split), "_id", "left")
        e = e.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_parts")), F.lit(0)).cast("int"))
        e = e.join(d, ["_id", "_salt"]).select("_row", F.lit(r).alias("_role"), F.struct(
            F.col("_at").alias("at"), F.col("_id").alias("id"), F.col("_name").alias("name")).alias("_e"))
        found = e if found is None else found.unionAll(e)
    lists = found.groupBy("_row").agg(*(F.array_sort(F.collect_list(F.when(F.col("_role") == r, F.col("_e")))).alias(f"{r}_found") for r in roles))
    out = tagged.join(lists, "_row", "left")
    empty = {r: F.array().cast(lists.schema[f"{r}_found"].dataType) for r in roles}
    return out.withColumns({f"{r}_found": F.coalesce(F.col(f"{r}_found"), empty[r]) for r in roles}).drop("_row")
