"""Ordered scans that stay bounded when one group holds much of the data.

A window over ``(group)`` puts the whole group into one task. So groups are counted first, at the grain of the scan
itself. Usually all are small, and then the plan is the plain window. The rows of the others are range-partitioned
by (group, order); the window runs inside (group, partition), and a small table with one row for each of
those pieces carries counts, sums, maxima and edge rows across the cuts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noteflow.session import ensure_checkpoint_dir

#: Rows of one group that one task may sort.
HOT_ROWS = 2_000_000
#: Dimensions up to this many rows are broadcast after being counted.
BROADCAST_ROWS = 200_000
#: Values between the ends of a bracket of a percentile that one task may sort, and the steps of a sketch that narrows one with more.
HELD_VALUES = 200_000
LADDER = 1000

BLK = "_blk"


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equal keys, where null equals null."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[f"_of_{k}"])
    return out


def place(df: DataFrame, key: str, order: list[str], max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` ready for scans over ``key`` in ``order``, and whether a group of more than ``max_rows`` rows had to be cut.

    If so, ``BLK`` holds the piece of each row: 0 for groups that stay whole, else the number of a range partition,
    which never decreases along ``order``. The rows of cut groups are written to the checkpoint folder, so the pieces
    hold when executors are lost. Rows that agree in key and order stay in one piece. Scans over columns made from these rows may
    use the same pieces, as long as the order of the rows is the same.
    """
    max_rows = HOT_ROWS if max_rows is None else max_rows
    names, rows = _large_groups(df, key, max_rows)
    if not rows:
        return df, False
    match = _same(df, names, [key])
    parts = 2 * math.ceil(rows / max_rows)
    held = df.join(names, match, "left_semi").repartitionByRange(parts, key, *order)
    held = held.withColumn(BLK, F.spark_partition_id().cast("long")).checkpoint()
    whole = df.join(names, match, "left_anti").withColumn(BLK, F.lit(0).cast("long"))
    return whole.unionByName(held), True


def _large_groups(df: DataFrame, key: str, max_rows: int, sizes: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The groups of more than ``max_rows`` rows, ready to be joined, and their number of rows; ``sizes`` as in ``by_size``."""
    told = (df, F.count(F.lit(1))) if sizes is None else (sizes, F.sum("rows"))
    large = told[0].groupBy(F.col(key).alias(f"_of_{key}")).agg(told[1].alias("_n")).filter(F.col("_n") > max_rows)
    ensure_checkpoint_dir(df.sparkSession)
    large = large.checkpoint()
    known = large.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows")).first()
    return F.broadcast(large) if known["groups"] <= BROADCAST_ROWS else large, known["rows"] or 0


def all_small(df: DataFrame, key: str, max_rows: int | None = None) -> bool:
    """Whether no group has more than ``max_rows`` rows, by one narrow aggregation; then scans over any of the rows need not count again."""
    most = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return (most or 0) <= (HOT_ROWS if max_rows is None else max_rows)


def by_size(df: DataFrame, key: str, max_rows: int | None = None, sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups that one task may hold, and those of larger groups; the latter are None if there are none.

    ``sizes``: the key and ``rows``, parts of a number that a group's rows do not exceed, where that is cheaper than to make the rows and count them.
    """
    names, rows = _large_groups(df, key, HOT_ROWS if max_rows is None else max_rows, sizes)
    if not rows:
        return df, None
    match = _same(df, names, [key])
    return df.join(names, match, "left_anti"), df.join(names, match, "left_semi")


def ordered_scan(
    df: DataFrame,
    key: str,
    order: list[str],
    *,
    row_number: str | None = None,
    sum_before: dict[str, str] | None = None,
    max_before: dict[str, str] | None = None,
    xor_before: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    cut: bool | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Row number, exclusive running sum / maximum / bitwise xor, and neighbours over ``key`` in ``order``.

    The dicts map an output column to its input column. ``cut`` is what ``place`` said of these rows; without it the
    groups are counted here.
    """
    sums, maxs, xors, lags, leads = sum_before or {}, max_before or {}, xor_before or {}, lag or {}, lead or {}
    names = [*([row_number] if row_number else []), *sums, *maxs, *xors, *lags, *leads]
    wanted = df.columns
    if cut is None:
        df, cut = place(df, key, order, max_rows)
    keys = [key, BLK] if cut else [key]

    w = Window.partitionBy(*keys).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    local: dict[str, Column] = {row_number: F.row_number().over(w)} if row_number else {}
    local |= {o: F.coalesce(F.sum(c).over(before), F.lit(0)) for o, c in sums.items()}
    local |= {o: F.max(c).over(before) for o, c in maxs.items()}
    local |= {o: F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")) for o, c in xors.items()}
    if not cut:
        local |= {o: F.lag(c).over(w) for o, c in lags.items()}
        local |= {o: F.lead(c).over(w) for o, c in leads.items()}
        return df.withColumns(local).select(*wanted, *names)
    # A struct tells a missing neighbour from a neighbour that holds NULL.
    local |= {o: F.lag(F.struct(c)).over(w) for o, c in lags.items()}
    local |= {o: F.lead(F.struct(c)).over(w) for o, c in leads.items()}

    rank = F.struct(*order)
    per_piece = [F.count(F.lit(1)).alias("_n")]
    per_piece += [F.sum(c).alias(f"_s_{o}") for o, c in sums.items()]
    per_piece += [F.max(c).alias(f"_m_{o}") for o, c in maxs.items()]
    per_piece += [F.bit_xor(c).alias(f"_x_{o}") for o, c in xors.items()]
    per_piece += [F.max_by(F.struct(c), rank).alias(f"_l_{o}") for o, c in lags.items()]
    per_piece += [F.min_by(F.struct(c), rank).alias(f"_f_{o}") for o, c in leads.items()]
    # Groups that were not cut have one piece and nothing to carry.
    pieces = df.groupBy(*keys).agg(*per_piece)
    by_piece = Window.partitionBy(key).orderBy(BLK)
    earlier = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    carry = pieces.select(
        F.col(key).alias(f"_of_{key}"),
        F.col(BLK).alias(f"_of_{BLK}"),
        F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_pieces"),
        F.sum("_n").over(earlier).alias("_rows_before"),
        *[F.sum(f"_s_{o}").over(earlier).alias(f"_c_{o}") for o in sums],
        *[F.max(f"_m_{o}").over(earlier).alias(f"_c_{o}") for o in maxs],
        *[F.bit_xor(f"_x_{o}").over(earlier).alias(f"_c_{o}") for o in xors],
        *[F.lag(f"_l_{o}").over(by_piece).alias(f"_c_{o}") for o in lags],
        *[F.lead(f"_f_{o}").over(by_piece).alias(f"_c_{o}") for o in leads],
    ).filter("_pieces > 1")
    # One row per piece, written out so that chained scans do not repeat each other's plans.
    ensure_checkpoint_dir(df.sparkSession)
    carry = carry.checkpoint()
    out = df.withColumns(local)
    out = out.join(carry, _same(out, carry, keys), "left")

    final: dict[str, Column] = {}
    if row_number:
        final[row_number] = F.col(row_number) + F.coalesce(F.col("_rows_before"), F.lit(0))
    for o in sums:
        final[o] = F.col(o) + F.coalesce(F.col(f"_c_{o}"), F.lit(0))
    for o in maxs:
        final[o] = F.greatest(F.col(o), F.col(f"_c_{o}"))
    for o in xors:
        final[o] = F.col(o).bitwiseXOR(F.coalesce(F.col(f"_c_{o}"), F.lit(0)))
    for o, c in [*lags.items(), *leads.items()]:
        final[o] = F.coalesce(F.col(o), F.col(f"_c_{o}"))[c]
    return out.withColumns(final).select(*wanted, *names)


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """0-based position in the total order, without sorting everything in one task.

    A range-partitioned sort is written to the checkpoint folder, so that the partition numbers hold
    when executors are lost; then one count per partition gives the offsets.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_p", F.shiftright("_mid", 33))
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # One row per sort partition.
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    within = F.col("_mid") - F.shiftleft(F.col("_p"), 33)
    return (
        placed.join(F.broadcast(offsets), "_p")
        .withColumn(name, within + F.col("_off"))
        .drop("_p", "_mid", "_off")
    )


def key_ranks(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """The distinct values of the order columns with ``name``, the 0-based position of their first row, and ``_ties``, their number of rows.

    Only the order columns are sorted and written to the checkpoint folder, once for each distinct key; the other columns of a row stay where they are.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_ties")).orderBy(*order)
    placed = keys.withColumns({"_mid": F.monotonically_increasing_id(), "_p": F.spark_partition_id()}).checkpoint()
    sizes = placed.groupBy("_p").agg(F.sum("_ties").alias("_n"))
    # One row per sort partition.
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    within = F.sum("_ties").over(Window.partitionBy("_p").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0))
    ranked = placed.withColumn("_to", within).join(F.broadcast(offsets), "_p")
    return ranked.select(*order, (F.col("_off") + F.col("_to") - F.col("_ties")).alias(name), "_ties")


def rank_rows(df: DataFrame, order: list[str], name: str = "rank", keep: Column | None = None) -> DataFrame:
    """Rows with their 0-based position in the total order; with ``keep``, a condition on ``name``, only those that meet it.

    The positions of the keys that are wanted are joined to the rows, which are hashed but neither sorted nor written. Rows that
    agree in all order columns are numbered on by a digest of the row; equal rows are interchangeable.
    """
    keep = F.lit(True) if keep is None else keep
    keys = key_ranks(df, order, name)
    columns = [*df.columns, name]

    def of(wanted: DataFrame) -> DataFrame:
        if set(df.columns) == set(order):
            return wanted
        named = wanted.select(*[F.col(c).alias(f"_of_{c}") for c in order], name, "_ties")
        # Each key is there once, so the hash tables spread evenly.
        return df.join(named.hint("shuffle_hash"), _same(df, named, order)).drop(*[f"_of_{c}" for c in order])

    out = of(keys.filter("_ties = 1").filter(keep)).select(*columns)
    if keys.filter("_ties > 1").isEmpty():
        return out
    tied = df.withColumn("_dig", F.xxhash64(*[F.col(c) for c in df.columns])).withColumn("_key", F.struct(*order))
    named = keys.filter("_ties > 1").select(F.struct(*order).alias("_of__key"), F.col(name).alias("_from"))
    tied = tied.join(named.hint("shuffle_hash"), _same(tied, named, ["_key"]))
    tied = ordered_scan(tied, "_key", ["_dig"], row_number="_rn")
    return out.unionByName(tied.withColumn(name, F.col("_from") + F.col("_rn") - 1).filter(keep).select(*columns))


def join_dimension(
    df: DataFrame, dim: DataFrame, on: list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a table that is usually small: counted first, broadcast only up to ``max_rows``.

    Beyond that it is an ordinary shuffle join, where AQE splits skewed partitions.
    """
    if dim.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(dim), on, how)
    return df.join(dim, on, how)


def join_few_keys(
    df: DataFrame, dim: DataFrame, on: str, max_rows: int = BROADCAST_ROWS, salts: int = 256
) -> DataFrame:
    """Inner join on a key with few values: broadcast if counted small, otherwise salted.

    With a handful of key values a plain shuffle join would use a handful of tasks.
    """
    if dim.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(dim), on)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(copies, [on, "_salt"]).drop("_salt")


def exact_percentiles(df: DataFrame, column: str, ps: list[float], accuracy: int = 100_000) -> dict:
    """``exact_quantiles`` of one column."""
    return exact_quantiles(df, {column: ps}, accuracy)[column]


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], accuracy: int = 100_000, held: int | None = None) -> dict[str, dict]:
    """Exact linear-interpolated percentiles of numeric columns, with their n, min, max and mean; null values are left out.

    One pass sketches all columns and brackets every wanted rank (a sketch is off by at most n / accuracy ranks).
    Each further pass counts for all open brackets what lies below them and on their ends, and sketches what lies strictly
    between, which narrows a bracket some hundred times; once that is at most ``held`` values, the pass lists it
    instead and the bracket is closed. Values on an end are only counted, so one value may fill any part of a column.
    Two passes do for a billion values, three for a hundred billion.
    """
    if accuracy < 100:
        raise ValueError("a sketch of less than 100 steps narrows nothing")
    held = HELD_VALUES if held is None else held
    slack = 4.0 / accuracy
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(wanted)])
    cuts = [[min(1.0, max(0.0, q)) for p in ps for q in (p - slack, p + slack)] for ps in wanted.values()]
    sketch = x.agg(*[
        F.struct(
            F.count(f"x{i}").alias("n"), F.min(f"x{i}").alias("min"), F.max(f"x{i}").alias("max"), F.avg(f"x{i}").alias("mean"),
            F.percentile_approx(f"x{i}", q, accuracy).alias("q"),
        ).alias(f"s{i}")
        for i, q in enumerate(cuts)
    ]).first()
    # Per column the value of each wanted rank, and the brackets: column, ends, ranks, and the most values between the ends.
    at: list[dict[int, float]] = [{} for _ in wanted]
    todo = []
    for i, ps in enumerate(wanted.values()):
        n, q = sketch[f"s{i}"]["n"], sketch[f"s{i}"]["q"]
        for j, p in enumerate(ps if n else []):
            ranks = sorted({int((n - 1) * p), min(int((n - 1) * p) + 1, n - 1)})
            if n <= held:
                todo.append((i, sketch[f"s{i}"]["min"], sketch[f"s{i}"]["max"], ranks, n))
            else:
                todo.append((i, q[2 * j], q[2 * j + 1], ranks, math.ceil(n * (2 * slack + 2 / accuracy))))
    while todo:
        got = x.agg(*[_bracket(F.col(f"x{i}"), lo, hi, ranks, most <= held, accuracy).alias(f"b{k}") for k, (i, lo, hi, ranks, most) in enumerate(todo)]).first()
        later = []
        for k, (i, lo, hi, ranks, most) in enumerate(todo):
            b, whole = got[f"b{k}"], sketch[f"s{i}"]
            for m, rank in enumerate(ranks):
                place = rank - b["below"] - b["on_lo"]
                if place < -b["on_lo"]:  # a sketch was further off than it may be
                    later.append((i, whole["min"], lo, [rank], whole["n"]))
                elif place < 0:
                    at[i][rank] = lo
                elif place < b["inside"]:
                    if most <= held:
                        at[i][rank] = b["values"][m]
                    else:
                        later.append(_narrower(i, lo, hi, rank, place / b["inside"], b["inside"], b["values"], accuracy))
                elif place < b["inside"] + b["on_hi"]:
                    at[i][rank] = hi
                else:
                    later.append((i, hi, whole["max"], [rank], whole["n"]))
        todo = later
    out = {}
    for i, (column, ps) in enumerate(wanted.items()):
        s, values = sketch[f"s{i}"], []
        for p in ps:
            h = (s["n"] - 1) * p
            a, b = (at[i][int(h)], at[i][min(int(h) + 1, s["n"] - 1)]) if s["n"] else (None, None)
            values.append(a + (b - a) * (h - int(h)) if s["n"] else None)
        out[column] = {"n": s["n"], "min": s["min"], "max": s["max"], "mean": s["mean"], "values": values}
    return out


def _bracket(x: Column, lo: float, hi: float, ranks: list[int], listed: bool, accuracy: int) -> Column:
    """Counts around a bracket, and of what lies between its ends the values at ``ranks`` or a ladder of sketched quantiles."""
    between = (x > lo) & (x < hi)
    below, on_lo = F.count_if(x < lo), F.count_if(x == lo)
    if listed:
        inside = F.sort_array(F.collect_list(F.when(between, x)))
        values = F.array(*[F.get(inside, (F.lit(rank) - below - on_lo).cast("int")) for rank in ranks])
    else:
        values = F.percentile_approx(F.when(between, x), [k / LADDER for k in range(1, LADDER)], accuracy)
    on_hi = F.count_if((x == hi) & (x > lo))
    return F.struct(below.alias("below"), on_lo.alias("on_lo"), F.count_if(between).alias("inside"), on_hi.alias("on_hi"), values.alias("values"))


def _narrower(i: int, lo: float, hi: float, rank: int, part: float, inside: int, ladder: list[float], accuracy: int) -> tuple:
    """The bracket between two rungs of the ladder that are surely on either side of the rank."""
    down, up = math.floor((part - 4.0 / accuracy) * LADDER), math.ceil((part + 4.0 / accuracy) * LADDER)
    most = math.ceil(inside * (min(up - down, LADDER) / LADDER + 2 / accuracy))
    return i, ladder[down - 1] if down >= 1 else lo, ladder[up - 1] if up < LADDER else hi, [rank], most


def with_halo(
    df: DataFrame, index: str, block_rows: int, before: int = 0, after: int = 0
) -> DataFrame:
    """Cut dense positions into blocks, with copies of the rows around each cut.

    ``before`` / ``after`` say how many earlier / later positions a row has to see. Adds the block
    and ``_own``; windows over (key, block) are then exact for the rows where ``_own`` holds.
    """
    own = F.floor(F.col(index) / block_rows)
    low = F.floor((F.col(index) - after) / block_rows)
    high = F.floor((F.col(index) + before) / block_rows)
    return (
        df.withColumn(BLK, F.explode(F.sequence(low, high)))
        .withColumn("_own", F.col(BLK) == own)
    )


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[Column, Column],
    right_span: tuple[Column, Column], width: float, how: str = "inner",
) -> DataFrame:
    """Pairs whose [lo, hi] spans touch, as an equi-join on (keys, time bin).

    Both sides are listed under every bin they touch; a pair is kept in the first common bin only.
    Long groups spread over many bins, so no task sees all pairs of a group. Exploded sides look small
    to the optimizer, so neither is left to an automatic broadcast.
    """
    def binned(df, span, tag):
        lo, hi = span
        first = F.floor(lo / width)
        return df.withColumns({f"_{tag}lo": lo, f"_{tag}hi": hi, f"_{tag}first": first}).withColumn(
            "_bin", F.explode(F.sequence(first, F.floor(hi / width)))
        )

    a, b = binned(left, left_span, "a"), binned(right, right_span, "b")
    touch = (F.col("_alo") <= F.col("_bhi")) & (F.col("_blo") <= F.col("_ahi"))
    once = F.col("_bin") == F.greatest("_afirst", "_bfirst")
    scratch = ["_bin", "_alo", "_ahi", "_afirst", "_blo", "_bhi", "_bfirst"]
    return a.join(b.hint("merge"), [*keys, "_bin"]).filter(touch & once).drop(*scratch)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a plain file scan to all cores when its few files cannot do so."""
    width = df.sparkSession.sparkContext.defaultParallelism
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if parts >= width else df.repartition(width)


def one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row tables side by side, by a union and a maximum per column."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
