"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from noteflow.functions import lyrics as L
from noteflow.functions import scalar as K
from noteflow.operators import clips as C
from noteflow.operators import decode as D
from noteflow.plans.registry import query
from noteflow.plans.views import VIEWS, seed_sql
from noteflow.sources.adapters import Tables


def r6(c):
    return F.round(c, 6)


@query("note_duration", "SELECT score_id, note_idx, round(offset_s - onset_s, 6) AS duration_s, round((offset_s - onset_s) * 1e3, 6) AS duration_ms FROM @notes")
def _(t: Tables):
    return t.notes.select("score_id", "note_idx", r6(K.duration_s()).alias("duration_s"), r6(K.duration_ms()).alias("duration_ms"))


@query("midi_to_hz", "SELECT score_id, note_idx, round(440e0 * pow(2e0, (pitch_midi - 69) / 12e0), 6) AS hz FROM @notes")
def _(t: Tables):
    return t.notes.select("score_id", "note_idx", r6(K.midi_to_hz("pitch_midi")).alias("hz"))


@query("hz_to_midi", "SELECT sample_id, frame_idx, round(CASE WHEN f0_hz > 0 THEN 69 + 12 * log2(f0_hz / 440e0) END, 6) AS midi FROM @f0_frames")
def _(t: Tables):
    return t.f0_frames.select("sample_id", "frame_idx", r6(K.hz_to_midi("f0_hz")).alias("midi"))


@query("cents", "SELECT sample_id, frame_idx, round(CASE WHEN f0_hz > 0 THEN 1200e0 * log2(f0_hz / 440e0) END, 5) AS c FROM @f0_frames")
def _(t: Tables):
    return t.f0_frames.select("sample_id", "frame_idx", F.round(K.cents("f0_hz", F.lit(440.0)), 5).alias("c"))


@query(
    "db_gain",
    """SELECT event_id, round(pow(10e0, (value - 20) / 20), 6) AS gain, round(CASE WHEN value > 1e-12 THEN 20e0 * log10(value / 3e0) END, 6) AS snr FROM events""",
)
def _(t: Tables):
    return t.raw("events").select(
        "event_id", r6(K.db_gain(F.col("value") - 20)).alias("gain"), r6(K.snr_db("value", F.lit(3.0))).alias("snr")
    )


@query("pitch_class", "SELECT score_id, note_idx, pitch_midi % 12 AS pc, 60 + pitch_midi % 12 AS folded FROM @notes")
def _(t: Tables):
    return t.notes.select("score_id", "note_idx", K.pitch_class("pitch_midi").alias("pc"), K.pseudo_octave("pitch_midi").alias("folded"))


@query(
    "piano_window_bin",
    "SELECT score_id, note_idx, CAST((pitch_midi - 21) * 3 + b AS INTEGER) AS bin FROM @notes, (VALUES (0), (1), (2)) v(b) WHERE pitch_midi BETWEEN 21 AND 108",
)
def _(t: Tables):
    return D.piano_window_bins(t.notes).select("score_id", "note_idx", "bin")


@query("frame_index", "SELECT score_id, note_idx, CAST(round_even(onset_s * 16000e0 / 256e0, 0) AS BIGINT) AS frame FROM @notes")
def _(t: Tables):
    return t.notes.select("score_id", "note_idx", K.frame_index("onset_s").alias("frame"))


@query("n_frames", "SELECT doc_id, CASE WHEN n_chars = 0 THEN 0 ELSE (n_chars - 1) // 256 + 1 END AS n FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", K.n_frames("n_chars").alias("n"))


@query("derive_seed", f"SELECT o_orderkey, {seed_sql('7', 'o_custkey', 'o_orderpriority')} AS seed FROM orders")
def _(t: Tables):
    return t.raw("orders").select("o_orderkey", K.derive_seed(7, "o_custkey", "o_orderpriority").alias("seed"))


@query(
    "request_key",
    "SELECT o_orderkey, sha256('love|en-us' || chr(31) || o_orderpriority || chr(31) || o_orderkey || chr(31) || o_custkey || chr(31) || o_orderkey % 9) AS k FROM orders",
)
def _(t: Tables):
    k = K.request_key(F.lit("love|en-us"), "o_orderpriority", "o_orderkey", "o_custkey", F.col("o_orderkey") % 9)
    return t.raw("orders").select("o_orderkey", k.alias("k"))


_SYL = """list_transform(range(1 + o_orderkey % 6), lambda i: CASE WHEN (o_orderkey + i) % 4 = 0 THEN NULL ELSE ['la', 'winter', 'sun'][1 + (o_custkey + i) % 3] END)"""


def _syllables():
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    names = F.array(*[F.lit(x) for x in ("la", "winter", "sun")])
    return F.transform(
        F.sequence(F.lit(0), (k % 6).cast("int")),
        lambda i: F.when((k + i) % 4 != 0, F.element_at(names, ((c + i) % 3 + 1).cast("int"))),
    )


@query(
    "syllable_hash",
    f"SELECT o_orderkey, sha256(array_to_string(list_transform({_SYL}, lambda s: coalesce(s, chr(0)) || chr(31)), '')) AS h FROM orders",
)
def _(t: Tables):
    return t.raw("orders").select("o_orderkey", K.syllable_hash(_syllables()).alias("h"))


@query(
    "config_hash",
    """SELECT 's' || o_orderkey AS score_id, 'sha256:' || sha256('{"alpha":1,"beta":[1,2],"name":"x"}') AS config_hash FROM orders""",
)
def _(t: Tables):
    from noteflow.operators.workplan import stamp_config

    return stamp_config(t.scores.select("score_id"), {"name": "x", "beta": [1, 2], "alpha": 1})


@query(
    "safe_filename",
    """SELECT doc_id, left(CASE WHEN s = '' THEN 'segment' ELSE s END, 100) || '-' || left(sha256(x), 10) || '.tsv' AS f FROM (
    SELECT doc_id, x, regexp_replace(regexp_replace(x, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS s FROM (SELECT doc_id, text AS x FROM documents))""",
)
def _(t: Tables):
    return t.documents.select("doc_id", K.safe_filename("text").alias("f"))


@query(
    "slug",
    """SELECT doc_id, CASE WHEN s = '' THEN 'sound' ELSE s END AS slug FROM (
    SELECT doc_id, left(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '_', 'g'), '^_+|_+$', '', 'g'), 40) AS s FROM documents)""",
)
def _(t: Tables):
    return t.documents.select("doc_id", K.slug("text").alias("slug"))


@query(
    "sample_id",
    """SELECT s, s || '_aug_p1' AS aug, s || '_accomp_lego' AS acc FROM (SELECT score_id || '_singer_' || voice_id || CASE WHEN lane = 'deterministic' THEN '' ELSE '_' || lane END AS s FROM @manifest)""",
)
def _(t: Tables):
    s = K.sample_id("score_id", "voice_id", "lane")
    return t.manifest.select(s.alias("s"), K.augmented_id(s, F.lit("p1")).alias("aug"), K.accompanied_id(s, F.lit("lego")).alias("acc"))


@query(
    "parse_variant_id",
    """SELECT sample_id, b AS base, CASE WHEN tr <> '' THEN tr END AS transform,
    CASE WHEN regexp_matches(tr, '^t[+-][0-9]+$') THEN 'transpose' WHEN regexp_matches(tr, '^hum[0-9]+$') THEN 'humanize' WHEN tr = 'vol' THEN 'volume' END AS axis,
    CASE WHEN regexp_matches(tr, '^t[+-][0-9]+$') THEN CAST(tr[2:] AS INTEGER) END AS semitones
    FROM (SELECT sample_id, split_part(score_id, '__', 1) AS b, split_part(score_id, '__', 2) AS tr FROM @manifest)""",
)
def _(t: Tables):
    m = t.manifest.select("sample_id", K.variant_base("score_id").alias("base"), K.variant_transform("score_id").alias("transform"))
    return m.withColumns({"axis": K.transform_axis("transform"), "semitones": K.transform_offset("transform")})


@query("source_key", "SELECT sample_id, lane || '/' || voice_id || '/' || CASE WHEN coalesce(augmentation_profile, '') = '' THEN '-' ELSE augmentation_profile END AS source FROM @manifest")
def _(t: Tables):
    return t.manifest.select("sample_id", K.source_key("lane", "voice_id", "augmentation_profile").alias("source"))


NC_SQL = "(contains(upper({0}), '-NC') OR contains(upper({0}), 'NONCOMMERCIAL') OR contains(upper({0}), 'NON-COMMERCIAL'))"


@query(
    "license_class",
    f"""SELECT sample_id, CASE WHEN coalesce(acc_license, '') = '' THEN 'empty' WHEN {NC_SQL.format('acc_license')} THEN 'noncommercial'
    WHEN starts_with(upper(acc_license), 'CC-BY') AND coalesce(acc_attribution, '') = '' THEN 'attribution_missing' ELSE 'ok' END AS c FROM @manifest""",
)
def _(t: Tables):
    return t.manifest.select("sample_id", K.license_class("accompaniment.model_license", "accompaniment.attribution_text").alias("c"))


_STEM = "CASE s_suppkey % 4 WHEN 0 THEN 'vocalset_' || s_suppkey WHEN 1 THEN 'vctk_speaker' WHEN 2 THEN 'me' ELSE 'my_vctk' END"


@query(
    "dataset_license",
    f"""SELECT s_suppkey, CASE WHEN starts_with(stem, 'vocalset') THEN 'VocalSet, CC BY 4.0 (Wilkins et al.); streamed sample' WHEN starts_with(stem, 'vctk') THEN 'VCTK, CC BY 4.0; streamed sample'
    ELSE 'operator-recorded, consented' END AS license FROM (SELECT s_suppkey, {_STEM} AS stem FROM supplier)""",
)
def _(t: Tables):
    k = F.col("s_suppkey")
    stem = F.when(k % 4 == 0, F.concat(F.lit("vocalset_"), k.cast("string"))).when(k % 4 == 1, F.lit("vctk_speaker")).when(k % 4 == 2, F.lit("me")).otherwise(F.lit("my_vctk"))
    return t.raw("supplier").withColumn("stem", stem).select("s_suppkey", K.dataset_license("stem").alias("license"))


@query(
    "pick_language",
    f"SELECT score_id, ['en-us', 'de', 'ja'][CAST({seed_sql('5', 'score_id', 'dir', chr(39) + 'lyric_lang' + chr(39))} % 3 AS INTEGER) + 1] AS lang FROM @scores",
)
def _(t: Tables):
    langs = F.array(F.lit("en-us"), F.lit("de"), F.lit("ja"))
    return t.scores.select("score_id", K.pick_language(langs, 5, "score_id", "dir").alias("lang"))


@query(
    "hnr_db",
    "SELECT event_id, round(CASE WHEN r > 0 THEN 10 * log10(r / (1 - r)) ELSE -60 END, 5) AS hnr FROM (SELECT event_id, least(greatest(value / 50 - 0.1e0, 0e0), 1 - 1e-6) AS r FROM events)",
)
def _(t: Tables):
    return t.raw("events").select("event_id", F.round(K.hnr_db(F.col("value") / 50 - 0.1), 5).alias("hnr"))


@query(
    "donor_problems",
    """SELECT event_id, array_to_string(list_filter([CASE WHEN user_id % 10 / 10e0 < 0.5 THEN 'too_short' END, CASE WHEN value / 100 < 0.01 THEN 'too_quiet' END,
    CASE WHEN p < 0.4e0 THEN 'low_periodicity' WHEN 10 * log10(least(p, 1 - 1e-6) / (1 - least(p, 1 - 1e-6))) < 7 THEN 'noisy' END], lambda x: x IS NOT NULL), ',') AS problems
    FROM (SELECT *, greatest(least(value / 30, 1e0), 0e0) AS p FROM events)""",
)
def _(t: Tables):
    p = F.greatest(F.least(F.col("value") / 30, F.lit(1.0)), F.lit(0.0))
    got = K.donor_problems(F.col("user_id") % 10 / 10.0, F.col("value") / 100, p)
    return t.raw("events").select("event_id", F.array_join(got, ",").alias("problems"))


# --- lyric columns ---------------------------------------------------------------------------


@query(
    "onset_vowel",
    """SELECT doc_id, regexp_replace(regexp_extract(lower(text), '^[^aeiou]*'), '[^\\p{L}]', '', 'g') AS onset, regexp_extract(lower(text), '[aeiou]') AS vowel FROM documents""",
)
def _(t: Tables):
    return t.documents.select("doc_id", L.onset_letters("text").alias("onset"), L.nucleus_vowel("text").alias("vowel"))


VIEWS["phonemes"] = """SELECT o_orderkey AS k, list_transform(range(1 + o_orderkey % 5), lambda i: ['s', 'ə', 't', 'iː', 'ŋ', 'k', 'l'][1 + (o_custkey + i) % 7]) AS ph FROM orders"""


@query(
    "map_phonemes",
    """SELECT k, array_to_string(CASE WHEN f IS NULL THEN ph ELSE ph[1:f - 1] END, ' ') AS lead_consonants, array_to_string(CASE WHEN f IS NULL THEN [] ELSE ph[l + 1:] END, ' ') AS tail_consonants
    FROM (SELECT k, ph, list_min(v) AS f, list_max(v) AS l FROM (SELECT k, ph, list_filter(range(1, len(ph) + 1), lambda i: regexp_matches(ph[i], '[aeiouɑɐɒæɛɜɝɪɔʊʌəɚɘɞyøœɶ]')) AS v FROM @phonemes))""",
)
def _(t: Tables):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    names = F.array(*[F.lit(x) for x in ("s", "ə", "t", "iː", "ŋ", "k", "l")])
    ph = F.transform(F.sequence(F.lit(0), (k % 5).cast("int")), lambda i: F.element_at(names, ((c + i) % 7 + 1).cast("int")))
    rows = t.raw("orders").select(k.alias("k"), L.map_phonemes(ph, F.lit(0.0)).alias("r"))
    return rows.select("k", F.array_join("r.lead_consonants", " ").alias("lead_consonants"), F.array_join("r.tail_consonants", " ").alias("tail_consonants"))


@query(
    "reconcile",
    f"""SELECT k, array_to_string(list_transform(range(1, n + 1), lambda i: coalesce(s[i], '?')), ' ') AS cells, len(s) <> n AS mismatch FROM (SELECT o_orderkey AS k, {_SYL} AS s, o_custkey % 7 AS n FROM orders)""",
)
def _(t: Tables):
    rows = t.raw("orders").select(F.col("o_orderkey").alias("k"), _syllables().alias("s"), (F.col("o_custkey") % 7).alias("n"))
    cells, mismatch = L.reconcile("s", "n")
    return rows.select("k", F.array_join(F.transform(cells, lambda x: F.coalesce(x, F.lit("?"))), " ").alias("cells"), mismatch.alias("mismatch"))


@query("clip_gate", "SELECT clip_id, list_max(list_transform(samples, lambda x: abs(x * 3))) > 1 + 1e-6 AS clipping FROM @clips")
def _(t: Tables):
    return t.clips.select("clip_id", C.clipping(F.transform("samples", lambda x: x.cast("double") * 3)).alias("clipping"))


@query(
    "constrain_pitch",
    "SELECT song_id, frame, pitch, CASE WHEN pitch >= 48 AND pitch < 84 THEN onset_p ELSE 0 END AS onset_p, CASE WHEN pitch >= 48 AND pitch < 84 THEN frame_p ELSE 0 END AS frame_p FROM @posteriors",
)
def _(t: Tables):
    return D.constrain_pitch(t.posteriors, 48, 84)
