"""Left-to-right folds over sorted rows, streamed batch by batch.

Spark places and sorts the rows; the Python step keeps a few scalars between Arrow batches, so a
group is never held as a whole. Callers key the fold by islands that no state can cross, which
spreads one long song over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sorted_fold(
    df: DataFrame, keys: list[str], order: list[str], step: Callable[[], Callable], outputs: str, lying: bool = False
) -> DataFrame:
    """Add the columns ``outputs``; ``step()`` makes ``fn(new_group, row_tuple) -> values``.

    The row tuple holds the ``order`` columns followed by the other non-key columns. With ``lying`` the rows lie by the first key, and
    those of a group follow each other in ``order``; they are not moved.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    columns = [*keys, *order, *rest]
    extra = T.StructType.fromDDL(outputs)
    schema = T.StructType([*df.select(*columns).schema.fields, *extra.fields])
    n_keys = len(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = step()
        last = None
        for pdf in batches:
            values = [pdf[c].tolist() for c in columns]
            made = []
            for row in zip(*values):
                key = row[:n_keys]
                made.append(fn(key != last, row[n_keys:]))
                last = key
            for j, field in enumerate(extra.fields):
                col = [m[j] for m in made]
                kind = np.float64 if isinstance(field.dataType, T.DoubleType) else object
                pdf[field.name] = pd.Series(col, index=pdf.index, dtype=kind)
            yield pdf

    placed = df.select(*columns)
    placed = placed.sortWithinPartitions(keys[0], *order) if lying else placed.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.mapInPandas(run, schema)


def grouped_kernel(
    df: DataFrame, keys: list[str], order: list[str], fn: Callable, schema: str, lying: bool = False
) -> DataFrame:
    """Run ``fn(key, columns)`` once per group over sorted rows and collect its column dicts.

    Like a grouped map, but with one Arrow stream per task instead of one exchange per group, which
    matters when there are millions of small groups. Only one group is held at a time, so the keys
    should include an island that bounds it. ``columns`` and the result are dicts of NumPy arrays;
    the result holds the non-key output columns and may be None. With ``lying`` rows that are partitioned by
    the keys are sorted where they lie; others are shuffled all the same.
    """
    out_schema = T.StructType.fromDDL(schema)
    rest = [c for c in df.columns if c not in keys and c not in order]
    columns = [*keys, *order, *rest]

    def emit(made: list) -> pd.DataFrame:
        data = {}
        for f in out_schema.fields:
            if f.name in keys:
                data[f.name] = np.concatenate([np.full(n, k[f.name], dtype=object) for k, n, _ in made])
            else:
                data[f.name] = np.concatenate([np.asarray(m[f.name]) for _, _, m in made])
        return pd.DataFrame(data, columns=out_schema.fieldNames())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        held_key = None

        def close():
            if held_key is None:
                return None
            cols = {c: np.concatenate([h[c] for h in held]) for c in columns if c not in keys}
            got = fn(held_key, cols)
            if got is None:
                return None
            n = len(next(iter(got.values())))
            return (dict(zip(keys, held_key)), n, got) if n else None

        for pdf in batches:
            if not len(pdf):
                continue
            change = np.zeros(len(pdf), dtype=bool)
            change[0] = True
            for k in keys:
                v = pdf[k].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], len(pdf))
            arrays = {c: pdf[c].to_numpy() for c in columns}
            made = []
            for a, b in zip(starts, ends):
                key = tuple(arrays[k][a] for k in keys)
                if key != held_key:
                    done = close()
                    if done:
                        made.append(done)
                    held, held_key = [], key
                held.append({c: arrays[c][a:b] for c in columns if c not in keys})
            if made:
                yield emit(made)
        done = close()
        if done:
            yield emit([done])

    placed = df.select(*columns)
    if lying:
        # A window asks for its keys in one task and in order, and moves nothing that lies so.
        placed = placed.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_nth > 0").drop("_nth")
    else:
        placed = placed.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.mapInPandas(run, out_schema)
