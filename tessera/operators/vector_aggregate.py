"""User aggregates over the whole band vector.

A reduction of one band at a time cannot see the other bands.  Here the user
gives three numpy functions:

    partial(vectors)         rows (n, bands) of one group -> a state vector
    merge(states)            states (k, size) of one group -> one state vector
    finish(state)            state vector -> the result vector

States are combined map-side: every task keeps one state per group it meets
(written out when it holds ``KEEP`` groups), and only states are shuffled, so a
group costs at most a few rows per task however many observations it has.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KEEP = 20_000       # groups of a task held at a time


def group_rows(batch: pa.RecordBatch, group: list[str]) -> tuple[list[np.ndarray], pa.Table]:
    """Row indexes of each group of a batch, and the groups' keys."""
    n = batch.num_rows
    table = pa.table({g: batch.column(g) for g in group}).append_column("_i", pa.array(np.arange(n)))
    found = table.group_by(group, use_threads=False).aggregate([("_i", "list")])
    return [np.asarray(x) for x in found.column("_i_list").to_pylist()], found.select(group)


def matrix(column: pa.Array) -> np.ndarray:
    """An array<double> column of equal lengths as (rows, length); a binary
    column as its values."""
    if pa.types.is_binary(column.type):
        out = np.empty(len(column), object)
        out[:] = column.to_pylist()
        return out
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def states(df: DataFrame, group, columns, partial: Callable, merge: Callable) -> DataFrame:
    """(group, _s) with one state per group; ``columns`` are array<double>
    or binary columns handed to ``partial`` as matrices."""
    group, columns = list(group), list(columns)
    types = dict(df.dtypes)
    schema = ", ".join(f"`{g}` {types[g]}" for g in group) + ", _s array<double>"

    def rows(keys: pa.Table, vectors: list[np.ndarray]) -> pa.RecordBatch:
        out = keys.append_column("_s", pa.array([v.tolist() for v in vectors], pa.list_(pa.float64())))
        return out.combine_chunks().to_batches()[0]

    def local(batches):
        held, tables = {}, None
        for batch in batches:
            if not batch.num_rows:
                continue
            data = [matrix(batch.column(c)) for c in columns]
            at, keys = group_rows(batch, group)
            for i, key in zip(at, keys.to_pylist(), strict=True):
                k = tuple(key.values())
                s = np.asarray(partial(*[d[i] for d in data]), float)
                held[k] = merge(np.stack([held[k], s])) if k in held else s
            tables = keys.schema
            if len(held) >= KEEP:
                yield rows(pa.Table.from_pylist([dict(zip(group, k, strict=True)) for k in held], schema=tables), list(held.values()))
                held = {}
        if held:
            yield rows(pa.Table.from_pylist([dict(zip(group, k, strict=True)) for k in held], schema=tables), list(held.values()))

    def meet(table: pa.Table) -> pa.Table:
        s = np.asarray(merge(matrix(table.column("_s").combine_chunks())), float)
        return table.select(group).slice(0, 1).append_column("_s", pa.array([s.tolist()], pa.list_(pa.float64())))

    return df.select(*group, *columns).mapInArrow(local, schema).groupBy(*group).applyInArrow(meet, schema)


def vector_aggregate(df: DataFrame, group, bands, partial: Callable, merge: Callable, finish: Callable, name: str = "result") -> DataFrame:
    """(group, name array<double>): the user's aggregate of the band vectors;
    rows with a NULL band take no part."""
    from pyspark.sql import functions as F
    vector = F.array(*[F.col(b).cast("double") for b in bands])
    data = df.select(*group, vector.alias("_x")).where(F.forall("_x", lambda v: v.isNotNull()))
    types = dict(df.dtypes)

    def end(batches):
        for batch in batches:
            s = batch.column("_s").to_pylist()
            out = [np.asarray(finish(np.array(x)), float).tolist() for x in s]
            yield pa.RecordBatch.from_arrays([*(batch.column(g) for g in group), pa.array(out, pa.list_(pa.float64()))], names=[*group, name])
    return states(data, group, ["_x"], partial, merge).mapInArrow(
        end, ", ".join(f"`{g}` {types[g]}" for g in group) + f", {name} array<double>")
