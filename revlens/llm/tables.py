"""Intermediate tables in the session's shared checkpoint folder, and groups streamed in Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revlens.session import scratch_path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and lost executors don't
    take it along. Later joins see a plain scan, so adaptive execution can split their skewed sides."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the length of the array."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of rows sorted by the integer column ``key``, dealt so that no group is parted.

    Yields a table and the starts of its groups; a group that a batch leaves open waits for the next.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        at = runs(b.column(key).to_numpy(zero_copy_only=False))
        keys = b.column(key)
        if held and keys[0].as_py() != last:
            t = pa.Table.from_batches(held).combine_chunks()
            yield t, runs(t.column(key).to_numpy())
            held = []
        if len(at) > 2:
            t = pa.Table.from_batches([*held, b.slice(0, int(at[-2]))]).combine_chunks()
            yield t, runs(t.column(key).to_numpy())
            held = [b.slice(int(at[-2]))]
        else:
            held.append(b)
        last = keys[b.num_rows - 1].as_py()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, runs(t.column(key).to_numpy())
