"""Scalar column functions: pitch, level, seeds, identifiers, licences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- pitch, level, grids ---------------------------------------------------------------------


def duration_s(onset: ColumnLike = "onset_s", offset: ColumnLike = "offset_s") -> Column:
    return _c(offset) - _c(onset)


def duration_ms(onset: ColumnLike = "onset_s", offset: ColumnLike = "offset_s") -> Column:
    return duration_s(onset, offset) * 1000.0


def midi_to_hz(p: ColumnLike) -> Column:
    return F.lit(440.0) * F.pow(F.lit(2.0), (_c(p) - 69.0) / 12.0)


def hz_to_midi(f: ColumnLike) -> Column:
    """NULL where the frequency is missing, NaN, infinite or not positive."""
    f = _c(f)
    usable = f.isNotNull() & ~F.isnan(f) & (f > 0) & (f < float("inf"))
    return F.when(usable, F.lit(69.0) + F.lit(12.0) * F.log2(f / 440.0))


def cents(f: ColumnLike, ref: ColumnLike) -> Column:
    """Signed distance in cents; NULL where the measured frequency is not positive."""
    f = _c(f)
    return F.when((f > 0) & ~F.isnan(f), F.lit(1200.0) * F.log2(f / _c(ref)))


def db_gain(db: ColumnLike) -> Column:
    return F.pow(F.lit(10.0), _c(db) / 20.0)


def snr_db(rms_signal: ColumnLike, rms_noise: ColumnLike, eps: float = 1e-12) -> Column:
    a, b = _c(rms_signal), _c(rms_noise)
    return F.when((a > eps) & (b > eps), F.lit(20.0) * F.log10(a / b))


def pitch_class(p: ColumnLike) -> Column:
    return F.pmod(_c(p), F.lit(12))


def pseudo_octave(p: ColumnLike) -> Column:
    """Pitch class placed in the octave that starts at 60."""
    return pitch_class(p) + 60


# Fixed values of the frame grid: 16 kHz, hop 256.
GRID_RATE = 16_000
GRID_HOP = 256


def frame_index(t: ColumnLike) -> Column:
    """Half-even rounded frame of a time in seconds."""
    return F.rint(_c(t) * float(GRID_RATE) / float(GRID_HOP)).cast("long")


def n_frames(n_samples: ColumnLike) -> Column:
    return F.floor((_c(n_samples) - 1) / GRID_HOP) + 1


# --- seeds and digests -----------------------------------------------------------------------

UNIT_SEP = "\x1f"


def derive_seed(master: int | Column, *parts: ColumnLike | int) -> Column:
    """63-bit seed of the unit-separated parts: low 63 bits of the first 8 digest bytes."""
    first = master if isinstance(master, Column) else F.lit(str(master))
    cols = [first.cast("string")]
    cols += [(F.lit(str(p)) if isinstance(p, int) else _c(p)).cast("string") for p in parts]
    digest = F.sha2(F.concat_ws(UNIT_SEP, *cols), 256)
    # 60 bits from fifteen digits, three more from the first digit: no step leaves 64-bit integers.
    low = F.conv(F.substring(digest, 2, 15), 16, 10).cast("long")
    top = F.pmod(F.ascii(digest) - F.when(F.ascii(digest) > 57, 87).otherwise(48), F.lit(8))
    return low + F.shiftleft(top.cast("long"), 60)


def uniform(master: int | Column, *parts: ColumnLike | int) -> Column:
    """Seeded number in [0, 1): the same on every retry and in every partitioning."""
    return derive_seed(master, *parts).cast("double") / F.lit(float(2**63))


def request_key(theme: ColumnLike, model: ColumnLike, score: ColumnLike, seed: ColumnLike, n: ColumnLike) -> Column:
    cols = [_c(x).cast("string") for x in (theme, model, score, seed, n)]
    return F.sha2(F.concat_ws(UNIT_SEP, *cols), 256)


def syllable_hash(arr: ColumnLike) -> Column:
    """Digest of a note-ordered syllable list; a missing syllable is a NUL character."""
    cells = F.transform(_c(arr), lambda s: F.concat(F.coalesce(s, F.lit("\x00")), F.lit(UNIT_SEP)))
    return F.sha2(F.array_join(cells, ""), 256)


# --- identifiers -----------------------------------------------------------------------------


def safe_filename(segment_id: ColumnLike, suffix: str = ".tsv") -> Column:
    """Readable, collision-resistant file name: cleaned stem up to 100 characters and a digest."""
    s = _c(segment_id)
    stem = F.regexp_replace(F.regexp_replace(s, r"[^A-Za-z0-9._-]+", "_"), r"^[._-]+|[._-]+$", "")
    stem = F.coalesce(F.nullif(stem, F.lit("")), F.lit("segment"))
    return F.concat(F.substring(stem, 1, 100), F.lit("-"), F.substring(F.sha2(s, 256), 1, 10), F.lit(suffix))


def slug(text: ColumnLike) -> Column:
    s = F.regexp_replace(F.lower(_c(text)), r"[^\p{L}\p{N}]", "_")
    s = F.substring(F.regexp_replace(s, r"^_+|_+$", ""), 1, 40)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("sound"))


VARIANT_SEP = "__"


def sample_id(score: ColumnLike, voice: ColumnLike, lane: ColumnLike) -> Column:
    """Lane is part of the id unless it is the deterministic lane."""
    base = F.concat(_c(score), F.lit("_singer_"), _c(voice))
    return F.when(_c(lane) == "deterministic", base).otherwise(F.concat(base, F.lit("_"), _c(lane)))


def augmented_id(base: ColumnLike, profile: ColumnLike) -> Column:
    return F.concat(_c(base), F.lit("_aug_"), _c(profile))


def accompanied_id(base: ColumnLike, mode: ColumnLike) -> Column:
    return F.concat(_c(base), F.lit("_accomp_"), _c(mode))


def variant_base(score: ColumnLike) -> Column:
    return F.split_part(_c(score), F.lit(VARIANT_SEP), F.lit(1))


def variant_transform(score: ColumnLike) -> Column:
    return F.nullif(F.split_part(_c(score), F.lit(VARIANT_SEP), F.lit(2)), F.lit(""))


def transform_axis(transform: ColumnLike) -> Column:
    t = _c(transform)
    return (
        F.when(t.rlike(r"^t[+-]\d+$"), F.lit("transpose"))
        .when(t.rlike(r"^hum\d+$"), F.lit("humanize"))
        .when(t == "vol", F.lit("volume"))
    )


def transform_offset(transform: ColumnLike) -> Column:
    """Signed semitones of a transposition; NULL for the other transforms."""
    return F.expr(f"try_cast(regexp_extract({_name(transform)}, '^t([+-][0-9]+)$', 1) AS INT)")


def _name(x: ColumnLike) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("a column name is expected")


def source_key(*cols: ColumnLike) -> Column:
    """Slash-joined stratification key; empty and missing parts become a dash."""
    return F.concat_ws(
        "/", *[F.coalesce(F.nullif(_c(c).cast("string"), F.lit("")), F.lit("-")) for c in cols]
    )


# --- licences --------------------------------------------------------------------------------

# Markers of a licence that forbids commercial use.
NONCOMMERCIAL_MARKERS = ("-NC", "NONCOMMERCIAL", "NON-COMMERCIAL", "CC-BY-NC")


def is_noncommercial(lic: ColumnLike) -> Column:
    upper = F.upper(_c(lic))
    hit = F.lit(False)
    for marker in NONCOMMERCIAL_MARKERS:
        hit = hit | upper.contains(marker)
    return F.coalesce(hit, F.lit(False))


def lacks_attribution(lic: ColumnLike, attribution: ColumnLike) -> Column:
    """An attribution licence without its attribution text."""
    named = F.coalesce(_c(attribution), F.lit("")) != ""
    return F.coalesce(F.upper(_c(lic)).startswith("CC-BY"), F.lit(False)) & ~is_noncommercial(lic) & ~named


def license_class(lic: ColumnLike, attribution: ColumnLike) -> Column:
    return (
        F.when(F.coalesce(_c(lic), F.lit("")) == "", F.lit("empty"))
        .when(is_noncommercial(lic), F.lit("noncommercial"))
        .when(lacks_attribution(lic, attribution), F.lit("attribution_missing"))
        .otherwise(F.lit("ok"))
    )


# Licence texts by the prefix of a donor file's stem.
DONOR_LICENSES = {
    "vocalset": "VocalSet, CC BY 4.0 (Wilkins et al.); streamed sample",
    "vctk": "VCTK, CC BY 4.0; streamed sample",
}
OWN_RECORDING = "operator-recorded, consented"


def dataset_license(stem: ColumnLike) -> Column:
    out = F
    for prefix, text in DONOR_LICENSES.items():
        out = out.when(_c(stem).startswith(prefix), F.lit(text))
    return out.otherwise(F.lit(OWN_RECORDING))


def pick_language(langs: ColumnLike, master: int, score: ColumnLike, voice: ColumnLike) -> Column:
    """Seeded choice of one language from a non-empty list."""
    arr = _c(langs)
    seed = derive_seed(master, score, voice, F.lit("lyric_lang"))
    return F.element_at(arr, (F.pmod(seed, F.size(arr).cast("long")) + 1).cast("int"))


# --- donor recordings ------------------------------------------------------------------------


def hnr_db(periodicity: ColumnLike) -> Column:
    r = F.least(F.greatest(_c(periodicity), F.lit(0.0)), F.lit(1.0 - 1e-6))
    return F.when(r > 0, F.lit(10.0) * F.log10(r / (F.lit(1.0) - r))).otherwise(F.lit(-60.0))


def donor_problems(duration: ColumnLike, rms: ColumnLike, periodicity: ColumnLike) -> Column:
    """Names of the checks that a recording fails; empty when it can be used."""
    p = _c(periodicity)
    return F.array_compact(
        F.array(
            F.when(_c(duration) < 0.5, F.lit("too_short")),
            F.when(_c(rms) < 0.01, F.lit("too_quiet")),
            F.when(p < 0.4, F.lit("low_periodicity")).when(hnr_db(p) < 7.0, F.lit("noisy")),
        )
    )
