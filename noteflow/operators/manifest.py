"""Analytics over the provenance manifest: counts, coverage, criteria, audit, splits, set checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noteflow.functions.scalar import derive_seed, is_noncommercial, lacks_attribution, source_key
from noteflow.operators.scan import one_row, ordered_scan

ACCEPTED = "accepted"
REFUSED = "license_refused"
# The statuses a record can have.
STATUSES = ("accepted", "rejected", "quarantined", "flagged", "license_refused")
ONSET_TOLERANCE_MS = 50.0


def status() -> Column:
    return F.col("verdict.status")


def is_accepted() -> Column:
    return status() == ACCEPTED


def filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def accepted(m: DataFrame) -> DataFrame:
    return m.filter(is_accepted())


def synthesized(m: DataFrame) -> DataFrame:
    """Records that reached a renderer."""
    return m.filter(status() != REFUSED)


def is_variant() -> Column:
    return F.col("base_score_id").isNotNull()


def is_original() -> Column:
    return F.col("base_score_id").isNull() & (F.col("lane") != "score_augmentation")


def run_summary(m: DataFrame) -> DataFrame:
    """One row: attempted, accepted, and a count per status."""
    return m.agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(is_accepted()).alias("accepted"),
        *[F.count_if(status() == s).alias(f"n_{s}") for s in STATUSES],
    )


def corpus_stats(m: DataFrame, approx: bool = False) -> DataFrame:
    """Totals, distinct scores, voices and timbre identities, augmentation coverage.

    ``approx`` replaces the exact distinct counts by sketches.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    ok = is_accepted()
    identity = F.concat_ws("\x1f", "voice_id", F.coalesce("augmentation_profile", F.lit("")))
    n_ok = F.count_if(ok)
    return m.agg(
        F.count(F.lit(1)).alias("total_samples"), n_ok.alias("accepted"),
        distinct(F.when(ok, F.col("score_id"))).alias("unique_scores"),
        distinct(F.when(ok, F.col("voice_id"))).alias("unique_voices"),
        distinct(F.when(ok, identity)).alias("timbre_identities"),
        F.when(n_ok > 0, F.count_if(ok & filled("augmentation_profile")) / n_ok).otherwise(0.0).alias("augmentation_coverage"),
    )


def score_aug_coverage(m: DataFrame) -> DataFrame:
    """Variant share, effective multiplier and counts by transform over accepted records.

    One row per transform with the totals repeated; a corpus without variants gives one row.
    """
    acc = accepted(m)
    by = acc.withColumn("_t", F.when(filled("base_score_id"), F.coalesce(F.nullif("score_aug_transform", F.lit("")), F.lit("?"))))
    counts = by.groupBy("_t").agg(F.count(F.lit(1)).alias("n"))  # one row per transform
    tot = counts.agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("_t").isNotNull(), F.col("n"))), F.lit(0)).alias("variants"),
        F.coalesce(F.sum(F.when(F.col("_t").isNull(), F.col("n"))), F.lit(0)).alias("originals"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct("_t", "n"))))).alias("by_transform"),
    )
    return tot.select(
        (F.col("variants") > 0).alias("enabled"),
        F.when(F.col("total") > 0, F.col("variants") / F.col("total")).otherwise(0.0).alias("variant_share"),
        F.when(F.col("originals") > 0, F.col("total") / F.col("originals")).otherwise(0.0).alias("effective_multiplier"),
        "by_transform",
    )


def lyric_stats(m: DataFrame) -> DataFrame:
    """Counts by lyric source and by language over all records, and the multi-syllable total."""
    facets = F.explode(F.array(
        F.struct(F.lit("source").alias("facet"), F.col("lyric_source").alias("value")),
        F.struct(F.lit("language").alias("facet"), F.col("lyric_language").alias("value")),
    ))
    return (
        m.select(facets.alias("f"), "lyric_multisyllable_supplied")
        .groupBy("f.facet", "f.value")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("lyric_multisyllable_supplied").alias("multisyllable"))
    )


# --- criteria --------------------------------------------------------------------------------


def _fraction(num: Column, den: Column) -> Column:
    return F.when(den == 0, 1.0).otherwise(num / den)


def _criteria(wide: DataFrame, rows: list[tuple]) -> DataFrame:
    """One wide aggregate row to criterion rows (sc, value, threshold, passed, gated)."""
    made = F.array(*[
        F.struct(
            F.lit(sc).alias("sc"), value.cast("double").alias("value"), F.lit(float(thr)).alias("threshold"),
            passed.alias("passed"), gated.alias("gated"),
        )
        for sc, value, thr, passed, gated in rows
    ])
    return wide.select(F.inline(made))


def criteria_core(m: DataFrame) -> DataFrame:
    """Onset, offset, first-pass, consent, identities, augmentation and re-derived-onset criteria."""
    ok = is_accepted()
    v = lambda f: F.col(f"verdict.{f}")
    svs = ok & (F.col("lane") == "svs")
    identity = F.concat_ws("\x1f", "voice_id", F.coalesce("augmentation_profile", F.lit("")))
    w = m.agg(
        F.count_if(ok).alias("acc"), F.count_if(ok & v("onset_ok")).alias("on"), F.count_if(ok & v("offset_ok")).alias("off"),
        F.count_if(status() != REFUSED).alias("syn"), F.count_if(ok & ~F.col("consent_verified")).alias("uncon"),
        F.count_distinct(F.when(ok, identity)).alias("ids"), F.count_if(ok & filled("augmentation_profile")).alias("aug"),
        F.count_if(F.col("lane") == "augmentation").alias("aug_lane"), F.count_if(svs).alias("svs"),
        F.count_if(svs & (v("max_onset_dev_ms") < 50.0)).alias("svs_in"),
    )
    c, yes = F.col, F.lit(True)
    on, off = _fraction(c("on"), c("acc")), _fraction(c("off"), c("acc"))
    first, aug, dev = _fraction(c("acc"), c("syn")), _fraction(c("aug"), c("acc")), _fraction(c("svs_in"), c("svs"))
    return _criteria(w, [
        ("SC-001", on, 0.99, on >= 0.99, yes), ("SC-002", off, 0.99, off >= 0.99, yes),
        ("SC-007", first, 0.95, first >= 0.95, yes), ("SC-008", c("uncon"), 0.0, c("uncon") == 0, yes),
        ("SC-004", c("ids"), 1000.0, c("ids") >= 1000, c("acc") >= 1000),
        ("SC-006", aug, 0.60, aug >= 0.60, c("aug_lane") > 0), ("SC-010", dev, 0.90, dev >= 0.90, c("svs") > 0),
    ])


def criteria_accompaniment(m: DataFrame) -> DataFrame:
    """Untouched vocal, timing on the mix, provenance and licence, note shift, stems."""
    a = lambda f: F.col(f"accompaniment.{f}")
    acc = is_accepted() & (F.col("lane") == "accompaniment") & F.col("accompaniment").isNotNull()
    lego, comp = acc & (a("mode") == "lego"), acc & (a("mode") == "complete")
    complete = filled("accompaniment.model_id") & filled("accompaniment.model_license") & filled("accompaniment.mode") & filled("accompaniment.source_vocal_sample_id")
    bad = ~complete | is_noncommercial("accompaniment.model_license") | lacks_attribution("accompaniment.model_license", "accompaniment.attribution_text")
    w = m.agg(
        F.count_if(acc).alias("acc"), F.count_if(lego).alias("lego"), F.count_if(comp).alias("comp"),
        F.count_if(lego & ~a("vocal_bit_exact")).alias("touched"), F.count_if(lego & ~a("stem_available")).alias("no_stem"),
        F.count_if(comp & F.col("verdict.onset_ok") & F.col("verdict.offset_ok")).alias("timed"),
        F.count_if(acc & bad).alias("bad"), F.count_if(acc & (a("max_note_shift_ms") > ONSET_TOLERANCE_MS)).alias("moved"),
    )
    c = F.col
    timed = _fraction(c("timed"), c("comp"))
    return _criteria(w, [
        ("ACC-001", c("touched"), 0.0, c("touched") == 0, c("lego") > 0),
        ("ACC-002", timed, 0.99, timed >= 0.99, c("comp") > 0),
        ("ACC-004", c("bad"), 0.0, c("bad") == 0, c("acc") > 0),
        ("ACC-005", c("moved"), 0.0, c("moved") == 0, c("acc") > 0),
        ("ACC-008", c("no_stem"), 0.0, c("no_stem") == 0, c("lego") > 0),
    ])


def eval_report(criteria: DataFrame) -> DataFrame:
    """Overall result: every gated criterion passed."""
    return criteria.agg(
        F.coalesce(F.bool_and(F.col("passed") | ~F.col("gated")), F.lit(True)).alias("passed"),
        F.count(F.lit(1)).alias("criteria"), F.count_if(~F.col("passed") & F.col("gated")).alias("failed"),
    )


def originals(m: DataFrame) -> DataFrame:
    return m.filter(is_original())


def last_base(m: DataFrame) -> DataFrame:
    """The original of each (score, lane, voice); the record appended last wins."""
    last = F.max_by(F.struct("sample_id", "score_path"), "ord")
    return originals(m).groupBy("score_id", "lane", "voice_id").agg(last.alias("b")).select(
        F.col("score_id").alias("base_score_id"), "lane", "voice_id", F.col("b.sample_id").alias("base_sample_id"),
    )


def variant_base_pairs(m: DataFrame, accepted_bases: bool = False) -> DataFrame:
    """Variants with the base record of the same lane and voice, if there is one (among accepted records)."""
    variants = m.filter(is_variant()).select(
        "sample_id", "score_id", "base_score_id", "lane", "voice_id", "score_aug_axis", "score_aug_transform",
        "score_aug_profile", status().alias("status"), "score_path",
    )
    return variants.join(last_base(accepted(m) if accepted_bases else m), ["base_score_id", "lane", "voice_id"], "left")


def labels_of(m: DataFrame, notes: DataFrame) -> DataFrame:
    """Notes of every accepted record that has labels; a record without notes is simply absent."""
    recs = accepted(m).filter(filled("score_path")).select("sample_id", "score_id")
    return recs.join(notes, "score_id")


def variant_note_checks(pairs: DataFrame, notes: DataFrame, budgets: dict[str, float]) -> DataFrame:
    """Per variant: note counts and whether pitch, timing, order and budget hold against the base.

    Variant and base notes are matched by position, one equi-join for all variants.
    """
    budget = F.lit(None).cast("double")
    for profile, value in budgets.items():
        budget = F.when(F.col("score_aug_profile") == profile, F.lit(value)).otherwise(budget)
    n = notes.select("score_id", "note_idx", "onset_s", "offset_s", "pitch_midi")
    base = n.select(
        F.col("score_id").alias("base_score_id"), "note_idx", F.col("onset_s").alias("b_on"),
        F.col("offset_s").alias("b_off"), F.col("pitch_midi").alias("b_pitch"),
    )
    sized = base.groupBy("base_score_id").agg(F.count(F.lit(1)).alias("n_base"))
    nxt = ordered_scan(n, "score_id", ["onset_s", "note_idx"], lead={"_nx": "onset_s"})
    offset = F.coalesce(F.expr("try_cast(substring(score_aug_transform, 2) AS INT)"), F.lit(0))
    joined = (
        pairs.select("sample_id", "score_id", "base_score_id", "base_sample_id", "score_aug_transform", "score_aug_profile")
        .join(nxt, "score_id")
        .join(base, ["base_score_id", "note_idx"], "left")
        .withColumn("_budget", budget)
    )
    per = joined.groupBy("sample_id", "base_score_id").agg(
        F.count(F.lit(1)).alias("n_notes"),
        F.bool_and(F.coalesce((F.col("pitch_midi") == F.col("b_pitch") + offset) & F.col("pitch_midi").between(0, 127), F.lit(False))).alias("pitch_exact"),
        F.bool_and(F.coalesce((F.col("onset_s") == F.col("b_on")) & (F.col("offset_s") == F.col("b_off")), F.lit(False))).alias("timing_same"),
        F.bool_and(F.coalesce(F.col("pitch_midi") == F.col("b_pitch"), F.lit(False))).alias("pitch_same"),
        F.bool_and((F.col("offset_s") > F.col("onset_s")) & (F.col("_nx").isNull() | (F.col("offset_s") <= F.col("_nx") + 1e-9))).alias("valid"),
        F.bool_and(F.coalesce((F.abs(F.col("onset_s") - F.col("b_on")) <= F.col("_budget") + 1e-9) & (F.abs(F.col("offset_s") - F.col("b_off")) <= F.col("_budget") + 1e-9), F.lit(True))).alias("in_budget"),
    )
    return per.join(sized, "base_score_id", "left").withColumn("same_count", F.coalesce(F.col("n_notes") == F.col("n_base"), F.lit(False)))


def criteria_score_aug(m: DataFrame, notes: DataFrame, budgets: dict[str, float]) -> DataFrame:
    """Off-safe, exact transposition, valid humanisation, lineage, coverage and path separation."""
    aug_path = F.col("score_path").contains("augmented/")
    inert = F.col("score_aug_axis").isNull() & F.col("score_aug_profile").isNull() & ~aug_path
    complete = (
        filled("base_score_id") & filled("score_aug_profile") & filled("score_aug_transform")
        & F.col("score_aug_seed").isNotNull() & filled("score_aug_axis") & (~filled("score_path") | aug_path)
    )
    var, orig, ok = is_variant(), is_original(), is_accepted()
    misfiled = filled("score_path") & ((var & ~aug_path) | (orig & aug_path))
    w = m.agg(
        F.count_if(orig).alias("orig"), F.count_if(orig & inert).alias("clean"), F.count_if(var).alias("var"),
        F.count_if(var & complete).alias("traced"), F.count_if(misfiled).alias("misfiled"),
        F.count_if(ok & var).alias("acc_var"), F.count_if(ok & ~var).alias("acc_orig"),
        F.count_if(ok & var & (F.col("score_aug_axis") == "transpose")).alias("n_tr"),
        F.count_if(var & (F.col("score_aug_axis") == "humanize")).alias("n_hu"),
    )
    pairs = variant_base_pairs(m)
    checks = variant_note_checks(pairs, notes, budgets).select("sample_id", "pitch_exact", "timing_same", "valid", "in_budget", "same_count", "n_notes")
    joined = pairs.join(checks, "sample_id", "left")
    based = F.col("base_sample_id").isNotNull()
    good_tr = (F.col("status") == ACCEPTED) & (F.col("score_aug_axis") == "transpose") & based & F.col("same_count") & F.col("pitch_exact") & F.col("timing_same")
    within = ~(based & F.col("same_count")) | F.col("in_budget")
    good_hu = (F.col("score_aug_axis") == "humanize") & (F.col("n_notes") > 0) & F.col("valid") & within
    g = joined.agg(F.count_if(good_tr).alias("ok_tr"), F.count_if(good_hu).alias("ok_hu"))
    p = path_collisions(m).agg(F.count(F.lit(1)).alias("collisions"))
    told = score_aug_coverage(m).select("enabled", F.size("by_transform").alias("transforms"), "effective_multiplier")
    c = F.col
    none = lambda n, x: F.when(c(n) == 0, 1.0).otherwise(x)
    clean, tr, hu = _fraction(c("clean"), c("orig")), _fraction(c("ok_tr"), c("n_tr")), _fraction(c("ok_hu"), c("n_hu"))
    traced = _fraction(c("traced"), c("var"))
    apart = (c("collisions") == 0) & (c("misfiled") == 0)
    times = F.when(c("acc_orig") > 0, (c("acc_var") + c("acc_orig")) / c("acc_orig")).otherwise(0.0)
    covered = (c("acc_var") == 0) | (c("enabled") & (c("transforms") > 0) & (F.abs(c("effective_multiplier") - times) < 1e-9))
    return _criteria(one_row(w, g, p, told), [
        ("SC-001", clean, 1.0, c("clean") == c("orig"), F.lit(True)),
        ("SC-002", none("n_tr", tr), 1.0, c("ok_tr") == c("n_tr"), c("n_tr") > 0),
        ("SC-003", none("n_hu", hu), 1.0, c("ok_hu") == c("n_hu"), c("n_hu") > 0),
        ("SC-006", none("var", traced), 1.0, c("traced") == c("var"), c("var") > 0),
        ("SC-007", F.when(covered, 1.0).otherwise(0.0), 1.0, covered, c("acc_var") > 0),
        ("SC-009", F.when(apart, 1.0).otherwise(0.0), 1.0, apart, F.lit(True)),
    ])


def criteria_volume(pairs: DataFrame, note_levels: DataFrame, checks: DataFrame) -> DataFrame:
    """One row: variants whose note levels spread wider than their base's, with equal labels.

    ``pairs`` must be made with accepted bases. ``note_levels`` is (sample_id, note_idx, rms) of variants and bases.
    """
    spread = note_levels.groupBy("sample_id").agg(F.stddev_pop("rms").alias("sd"), F.count(F.lit(1)).alias("n"))
    base = spread.select(F.col("sample_id").alias("base_sample_id"), F.col("sd").alias("b_sd"), F.col("n").alias("b_n"))
    vol = pairs.filter((F.col("status") == ACCEPTED) & (F.col("score_aug_axis") == "volume"))
    joined = vol.join(spread, "sample_id", "left").join(base, "base_sample_id", "left").join(
        checks.select("sample_id", "timing_same", "pitch_same", "same_count"), "sample_id", "left"
    )
    wide = (F.col("n") > 1) & (F.col("b_n") > 1) & (F.col("sd") > F.col("b_sd"))
    same = F.col("base_sample_id").isNotNull() & F.col("timing_same") & F.col("pitch_same") & F.col("same_count")
    w = joined.agg(F.count(F.lit(1)).alias("n_vol"), F.count_if(wide).alias("widened"), F.count_if(same).alias("labels_ok"))
    c = F.col
    return w.select(
        "n_vol", "widened", "labels_ok", _fraction(c("widened"), c("n_vol")).alias("value"),
        ((c("widened") == c("n_vol")) & (c("labels_ok") == c("n_vol"))).alias("passed"),
    )


def criteria_reexpand(expected_lines: DataFrame, stored_lines: DataFrame, base: str | None = None) -> DataFrame:
    """One row: scores whose stored label lines equal the freshly derived ones, line by line.

    ``base``: a column of both that follows from the score. Lines that lie by it are compared and counted there, and no line is moved.
    """
    keys = [base, "score_id"] if base else ["score_id"]
    both = expected_lines.select(*keys, "note_idx", "line", F.lit(1).alias("e")).join(
        stored_lines.select(*keys, "note_idx", F.col("line").alias("s_line"), F.lit(1).alias("s")), [*keys, "note_idx"], "full"
    )
    per = both.groupBy(*keys).agg(
        F.bool_or(F.col("s") == 1).alias("stored"), F.bool_or(F.col("e") == 1).alias("made"),
        F.bool_and(F.coalesce(F.col("line") == F.col("s_line"), F.lit(False))).alias("same"),
    ).filter("stored AND made")
    n, ok = F.count(F.lit(1)), F.count_if("same")
    return per.agg(n.alias("checked"), ok.alias("reproduced"), _fraction(ok, n).alias("value"), (ok == n).alias("passed"))


# --- audit -----------------------------------------------------------------------------------


def voice_licenses(m: DataFrame) -> DataFrame:
    """Licence of each voice; the record appended last wins."""
    return m.groupBy("voice_id").agg(F.max_by("voice_license", "ord").alias("license"))


def license_audit(m: DataFrame) -> DataFrame:
    """One row: voices, refusals, unconsented accepted records, accompaniment violations, result."""
    a = lambda f: f"accompaniment.{f}"
    acc = is_accepted() & (F.col("lane") == "accompaniment") & F.col("accompaniment").isNotNull()
    bad = ~filled(a("model_license")) | is_noncommercial(a("model_license")) | lacks_attribution(a("model_license"), a("attribution_text"))
    w = m.agg(
        F.count_distinct("voice_id").alias("voices"), F.count_if(status() == REFUSED).alias("refusals"),
        F.count_if(is_accepted() & ~F.col("consent_verified")).alias("unconsented"),
        F.count_distinct(F.when(acc, F.col(a("model_id")))).alias("models"), F.count_if(acc & bad).alias("violations"),
    )
    return w.withColumn("passed", (F.col("unconsented") == 0) & (F.col("violations") == 0))


# --- splits ----------------------------------------------------------------------------------

STRATIFY = ("lane", "voice_id", "augmentation_profile")
#: A source is shuffled by a 63-bit seeded number; its leading bits cut it into this many blocks.
SPLIT_BLOCKS = 4096


def val_split(m: DataFrame, fraction: float = 0.2, seed: int = 0, stratify: tuple = STRATIFY) -> DataFrame:
    """Accepted records with source and side; each source gives a rounded share to validation.

    Sources may be very uneven, so ranks come from counts per (source, leading bits) and windows
    inside those blocks only; no task orders a whole source.
    """
    acc = accepted(m).select(
        "sample_id", "audio_path", "score_path", source_key(*stratify).alias("source"),
    ).withColumn("_r", derive_seed(seed, "source", "sample_id"))
    placed = acc.withColumn("_b", F.shiftright("_r", 63 - 12))
    counts = placed.groupBy("source", "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_block = Window.partitionBy("source").orderBy("_b")
    whole = Window.partitionBy("source")
    offsets = counts.select(
        "source", "_b", F.coalesce(F.sum("_n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("_total"),
    )
    total = F.col("_total")
    n_val = F.when(total >= 2, F.least(total - 1, F.rint(total * fraction).cast("long"))).otherwise(0)
    # Blocks that lie entirely on one side need no ordering, but the window is cheap inside a block.
    rank = F.row_number().over(Window.partitionBy("source", "_b").orderBy("_r", "sample_id"))
    ranked = placed.withColumn("_k", rank).join(offsets, ["source", "_b"]).withColumn("_n_val", n_val)
    side = F.when(F.col("_k") + F.col("_off") <= F.col("_n_val"), "val").otherwise("train")
    return ranked.select("sample_id", "audio_path", "score_path", "source", side.alias("side"))


def per_source_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("side") == "train").alias("train"), F.count_if(F.col("side") == "val").alias("val")
    )


def split_disjoint(split: DataFrame, m: DataFrame) -> DataFrame:
    """One row: ids on both sides, accepted ids on neither, and ids that are not accepted."""
    sides = split.groupBy("sample_id").agg(
        F.bool_or(F.col("side") == "train").alias("t"), F.bool_or(F.col("side") == "val").alias("v")
    )
    ids = accepted(m).select("sample_id").distinct().withColumn("a", F.lit(True))
    both = sides.join(ids, "sample_id", "full")
    return both.agg(
        F.count_if(F.col("t") & F.col("v")).alias("on_both"), F.count_if(F.col("t").isNull()).alias("missing"),
        F.count_if(F.col("a").isNull()).alias("foreign"),
    )


# --- set checks ------------------------------------------------------------------------------


def path_collisions(m: DataFrame) -> DataFrame:
    """Score and audio paths that occur more than once over all records."""
    paths = m.select(F.explode(F.array("score_path", "audio_path")).alias("path")).filter(filled("path"))
    return paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merge_runs(runs: DataFrame, shard_size: int = 1000) -> DataFrame:
    """Accepted records of several runs in run and id order, numbered on and put into shards."""
    from noteflow.operators.scan import rank_rows

    ranked = rank_rows(accepted(runs), ["run_idx", "sample_id"], "idx")
    return ranked.withColumn("shard", F.format_string("%03d", F.floor(F.col("idx") / shard_size)))


def stage_cap(samples: DataFrame, specs: list[str]) -> DataFrame:
    """First N samples by path of every requested dataset (``id`` or ``id:cap``), renamed.

    Entries holding ``=`` are skipped, unknown ids match nothing. A dataset that is named more than once
    counts once, with its largest cap or none. At most N rows of a capped dataset leave each task.
    """
    caps: dict[str, float] = {}
    for spec in specs:
        rid, _, cap = spec.partition(":")
        if "=" not in rid:
            caps[rid] = max(caps.get(rid, 0), int(cap) if cap else float("inf"))
    out = samples.filter(F.col("dataset").isin(*[rid for rid, cap in caps.items() if cap == float("inf")]))
    for rid, cap in caps.items():
        if cap < float("inf"):
            out = out.unionByName(samples.filter(F.col("dataset") == rid).orderBy("path").limit(cap))
    return out.withColumn("staged", F.concat_ws("__", "dataset", "sample_id"))


def interleaved_slice(df: DataFrame, order: list[str], part: int, of: int) -> DataFrame:
    """Every ``of``-th row of the total order, starting at ``part``."""
    from noteflow.operators.scan import rank_rows

    return rank_rows(df, order, "_rank", F.col("_rank") % of == part).drop("_rank")


def stride_limit(df: DataFrame, order: list[str], stride: int, limit: int = 0) -> DataFrame:
    """Every ``stride``-th row of the total order, and of those the first ``limit``."""
    from noteflow.operators.scan import HELD_VALUES, rank_rows

    last = stride * (limit - 1) + 1
    if limit and last <= HELD_VALUES:
        # Rows after the last wanted one needn't be ranked.
        df = df.orderBy(*order).limit(last)
    wanted = F.col("_rank") % stride == 0
    return rank_rows(df, order, "_rank", wanted & (F.col("_rank") < stride * limit) if limit else wanted).drop("_rank")


def relabel_drift(log: DataFrame) -> DataFrame:
    """Percentiles of onset and offset drift, and the accepted share."""
    from noteflow.operators.scan import exact_quantiles

    spark = log.sparkSession
    out = None
    n_ok = log.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == ACCEPTED).alias("ok")).first()
    ps = [0.5, 0.9, 0.99]
    for column, got in exact_quantiles(log, {"onset_drift_ms": ps, "offset_drift_ms": ps}).items():
        p50, p90, p99 = got["values"]
        d = lambda x: F.lit(x).cast("double")
        row = spark.range(1).select(
            F.lit(column).alias("measure"), d(p50).alias("p50"), d(p90).alias("p90"), d(p99).alias("p99"), d(got["max"]).alias("max"),
            F.lit(n_ok["n"]).cast("long").alias("n"), F.lit(n_ok["ok"]).cast("long").alias("accepted"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def timing_totals(budgets: DataFrame) -> DataFrame:
    """Largest frame hop and summed group delay of the active methods."""
    on = budgets.filter("active")
    return on.agg(
        F.coalesce(F.max("frame_hop_ms"), F.lit(0.0)).alias("largest_frame_hop_ms"),
        F.coalesce(F.sum("group_delay_ms"), F.lit(0.0)).alias("total_group_delay_ms"),
    )


def dataset_volume(clips: DataFrame) -> DataFrame:
    return clips.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration_s") / 60.0, 3).alias("minutes")
    )
