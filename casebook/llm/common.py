"""Staging and bounded id sets shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.sources.io import drop_stages, materialize, staged_paths

BIT_INDEX = 22                      # id sets are hashed to 2**22 bits: 512 KB, whatever the input
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    return materialize(df, f"llm/{name}")


def stage_tidy(df: DataFrame, name: str) -> DataFrame:
    """``stage``; the shuffle files of the write are deleted with its end, not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(TIDY, None)
    conf.set(TIDY, "true")
    try:
        return stage(df, name)
    finally:
        conf.unset(TIDY) if before is None else conf.set(TIDY, before)


def unstage(*tables: DataFrame) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in tables:
        files = df.inputFiles()[:1]
        drop_stages(df.sparkSession, [p for p in staged_paths(df.sparkSession) if any(p.split(":", 1)[-1].lstrip("/") in f for f in files)])


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def merged_blocks(parts: DataFrame, dtype, combine) -> dict[int, np.ndarray]:
    """Arrays summed up (or or-ed) over all tasks: one per block number.

    ``parts`` (block, data) holds each task's share of a fixed-size array, cut
    into blocks. Blocks meet by number in a shuffle, so the driver receives the
    array once, however many tasks there are.
    """
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column("block").to_pylist(), b.column("data")):
                part = np.frombuffer(data.as_buffer(), dtype)
                held[k] = combine(held[k], part) if k in held else part.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["block", "data"])
    rows = parts.repartition("block").mapInArrow(run, "block long, data binary").collect()
    return {r["block"]: np.frombuffer(r["data"], dtype) for r in rows}


def blocks_of(array: np.ndarray, size: int) -> pa.RecordBatch:
    """A task's share for ``merged_blocks``: blocks of ``size`` values, those of zeros left out."""
    cut = [(k // size, array[k:k + size]) for k in range(0, len(array), size)]
    cut = [(k, x) for k, x in cut if x.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in cut], pa.int64()), pa.array([x.tobytes() for _, x in cut], pa.binary())], ["block", "data"])


def whole(blocks: dict[int, np.ndarray], n: int, size: int, dtype) -> np.ndarray:
    out = np.zeros(n, dtype)
    for k, x in blocks.items():
        out[k * size:k * size + len(x)] = x
    return out


def bit_set(ids: DataFrame, column: str) -> np.ndarray:
    """A fixed-size bit set of the hashed 64-bit values in ``column``.

    Its size does not depend on the input. Membership errs only towards
    "contained"; users check again exactly or need no more than that.
    """
    return bits_by(ids.select(hashed_bit(column).alias("bit")), lambda b: b.column("bit").to_numpy().astype(np.int64))


def bits_by(df: DataFrame, number) -> np.ndarray:
    """Bit set of the bit numbers that ``number`` works out from the batches of a task."""
    def run(batches):
        words = np.zeros(1 << (BIT_INDEX - 6), np.uint64)
        for b in batches:
            at = number(b)
            np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        yield blocks_of(words, 1024)
    got = merged_blocks(df.mapInArrow(run, "block long, data binary"), np.uint64, np.bitwise_or)
    return whole(got, 1 << (BIT_INDEX - 6), 1024, np.uint64).view(np.int64)


def hashed_bit(column: str):
    """The bit number of a value, computed in Spark like ``bit_set`` does."""
    return F.shiftrightunsigned(F.xxhash64(F.col(column)), 64 - BIT_INDEX).cast("int")


def in_bits(bits: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Which of the bit numbers are set."""
    return ((bits[index >> 6].view(np.uint64) >> (index & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
