"""Named transforms: DataFrame in, DataFrame out, with parameters that are checked and a schema that is declared.

A transform is registered once under a name and applied by name. Its function may be a composition of DataFrame
operations, a vectorised column function, a function of one group at a time, or a table function that makes many rows
of one. Nothing runs when a transform is applied; only the plan's schema is compared with the declared one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Says what is wrong with a value, or None.
Check = Callable[[Any], str | None]


@dataclass(frozen=True)
class Param:
    """A parameter: its check, and its default unless it is required."""

    check: Check = lambda value: None
    default: Any = None
    required: bool = False


@dataclass(frozen=True)
class Transform:
    name: str
    fn: Callable[[DataFrame, dict], DataFrame]
    #: Columns it needs, and those it returns; with ``adds`` they come on top of the input's columns.
    needs: tuple[str, ...]
    schema: T.StructType
    adds: bool
    params: dict[str, Param] = field(default_factory=dict)


# --- checks of parameters --------------------------------------------------------------------


def one_of(*values) -> Check:
    return lambda v: None if v in values else f"must be one of {', '.join(map(str, values))}"


def at_least(low: float) -> Check:
    return lambda v: None if not isinstance(v, bool) and isinstance(v, (int, float)) and v >= low else f"must be a number of at least {low}"


def positive(v) -> str | None:
    return None if not isinstance(v, bool) and isinstance(v, (int, float)) and v > 0 else "must be a number above 0"


def span(low: float = float("-inf"), high: float = float("inf")) -> Check:
    """An ordered pair inside limits."""

    def check(v):
        good = isinstance(v, (tuple, list)) and len(v) == 2 and low <= v[0] <= v[1] <= high
        return None if good else f"must be a pair with {low} <= low <= high <= {high}"

    return check


def unique(v) -> str | None:
    return None if len(set(v)) == len(v) else "must not repeat a value"


# --- the registry ----------------------------------------------------------------------------


class Transforms:
    def __init__(self):
        self._known: dict[str, Transform] = {}

    def names(self) -> list[str]:
        return sorted(self._known)

    def register(self, name: str, fn, schema: str, *, needs=(), adds: bool = False, params: dict[str, Param] | None = None) -> None:
        """``fn(df, params)``; ``schema`` is what it returns, as DDL."""
        if name in self._known:
            raise ValueError(f"transform {name!r} is registered already")
        self._known[name] = Transform(name, fn, tuple(needs), T.StructType.fromDDL(schema), adds, dict(params or {}))

    def register_column(self, name: str, udf, inputs: list[str], output: str, returns: str) -> None:
        """A column function, such as a pandas UDF, of the ``inputs``, as column ``output`` of type ``returns``."""
        self.register(name, lambda df, _: df.withColumn(output, udf(*[F.col(f"`{c}`") for c in inputs])), f"`{output}` {returns}", needs=inputs, adds=True)

    def register_grouped(self, name: str, keys: list[str], fn, schema: str, params: dict[str, Param] | None = None) -> None:
        """``fn(pandas, params)`` of all rows that share the keys. A group must fit into one task."""
        self.register(name, lambda df, p: df.groupBy(*keys).applyInPandas(lambda group: fn(group, p), schema), schema, needs=keys, params=params)

    def register_table(self, name: str, table_function, inputs: list[str], schema: str) -> None:
        """A Python table function, joined laterally: every row it yields is added to the row it was made of."""

        def fn(df: DataFrame, _: dict) -> DataFrame:
            return df.lateralJoin(table_function(*[F.col(f"`{c}`").outer() for c in inputs]))

        self.register(name, fn, schema, needs=inputs, adds=True)

    def apply(self, df: DataFrame, name: str, params: dict | None = None) -> DataFrame:
        """The named transform of ``df``. Unknown names and parameters, failed checks, missing columns and another schema than declared raise ValueError."""
        if name not in self._known:
            raise ValueError(f"no transform {name!r}; there are {', '.join(self.names()) or 'none'}")
        t, given = self._known[name], dict(params or {})
        if other := sorted(set(given) - set(t.params)):
            raise ValueError(f"{name}: no parameter {', '.join(other)}")
        for key, param in t.params.items():
            if key not in given and param.required:
                raise ValueError(f"{name}: parameter {key} is required")
            given.setdefault(key, param.default)
            if (wrong := param.check(given[key])) and (param.required or given[key] is not None):
                raise ValueError(f"{name}: parameter {key} {wrong}")
        if lacking := [c for c in t.needs if c not in df.columns]:
            raise ValueError(f"{name}: the input has no column {', '.join(lacking)}")
        out = t.fn(df, given)
        made = {f.name: f.dataType for f in t.schema}
        want = [(f.name, made.get(f.name, f.dataType)) for f in df.schema] + [(c, d) for c, d in made.items() if c not in df.columns] if t.adds else list(made.items())
        got = [(f.name, f.dataType) for f in out.schema]
        if got != want:
            told = lambda cols: ", ".join(f"{c} {d.simpleString()}" for c, d in cols)
            raise ValueError(f"{name}: returns ({told(got)}) instead of ({told(want)})")
        return out

    def chain(self, df: DataFrame, steps: list[tuple[str, dict]]) -> DataFrame:
        for name, params in steps:
            df = self.apply(df, name, params)
        return df


def library() -> Transforms:
    """The score transforms of this package under their names; users add their own to the registry that is returned."""
    from noteflow.operators import expand, scores

    note = "score_id string, note_idx int, onset_s double, offset_s double, pitch_midi int, lyric string"
    needs = ("score_id", "note_idx", "onset_s", "offset_s", "pitch_midi", "lyric")
    out = Transforms()

    def bare(df: DataFrame) -> DataFrame:
        return df.select(*needs)

    out.register("valid_notes", lambda df, _: scores.valid_notes(bare(df)), note, needs=needs)
    out.register(
        "transpose", lambda df, p: expand.transpose(bare(df), expand.Transpose(tuple(p["offsets"]), p["policy"], tuple(p["window"]))).select(*needs, "transform"),
        f"{note}, transform string", needs=needs,
        params={"offsets": Param(unique, required=True), "policy": Param(one_of("drop", "clamp"), "drop"), "window": Param(span(0, 127), (expand.LOW, expand.HIGH))},
    )
    out.register(
        "jitter_timing", lambda df, p: expand.jitter_timing(bare(df), p["ms"], F.lit(p["seed"]).cast("long")).select(*needs), note, needs=needs,
        params={"ms": Param(positive, required=True), "seed": Param(at_least(0), 0)},
    )
    out.register(
        "phrases", lambda df, p: scores.segment_phrases(bare(df), gap_s=p["gap_s"], max_phrase_s=p["max_phrase_s"]).select(*needs[:-1]), note.removesuffix(", lyric string"), needs=needs,
        params={"gap_s": Param(positive, 0.4), "max_phrase_s": Param(positive, 12.0)},
    )
    return out
