"""Many short groups in one Arrow call, and a long one in its own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType



def over_groups(
    df: DataFrame, by: Sequence[str], order: Sequence[str], each: Callable[[pa.Table, np.ndarray], pa.Table], schema: StructType
) -> DataFrame:
    """`each` gets a table of whole groups, one after the other and sorted by `order`, and where they start (the end of the last one too).

    A partition is sorted by group and read batch by batch, so a task holds a batch and the group that it cuts, whatever the number of
    groups; a call for every group would cost milliseconds for a few rows.
    """
    by, out = list(by), to_arrow_schema(schema)

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            # the last row held says whether the batch goes on with its group
            seam = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table]) if held else table
            last = int(_starts(seam, by)[-1]) - (1 if held else 0)
            if last < 0:
                held.append(table)
                continue
            whole = pa.concat_tables([*held, table.slice(0, last)]).combine_chunks()
            held = [table.slice(last)]
            if whole.num_rows:
                yield from call(whole)
        if held:
            yield from call(pa.concat_tables(held).combine_chunks())

    def call(whole: pa.Table):
        made = each(whole, np.append(_starts(whole, by), whole.num_rows))
        yield from made.select(out.names).cast(out).to_batches(max_chunksize=65_536)

    # dealt by a hash of the keys: a deal by the keys themselves gives way to that of a join below, which adaptive execution may undo
    return df.repartition(F.xxhash64(*by)).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def _starts(table: pa.Table, by: Sequence[str]) -> np.ndarray:
    """First rows of the groups; nulls are a group."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in by:
        codes = table[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def lists(parts: Sequence[np.ndarray]) -> pa.Array:
    """Arrays as rows of a list column."""
    ends = np.cumsum([0, *(len(p) for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0), *parts])))


def rows_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A list column of numbers as arrays."""
    array = column.combine_chunks()
    at, values = array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]
