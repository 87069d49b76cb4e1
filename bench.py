"""Time the headline queries over one scale-factor folder; prints one JSON line.

Each query is planned and run to the end into a sink that keeps nothing. The sum is the headline.
"""

from __future__ import annotations

import json
import os
import sys
import time

from noteflow.plans import catalog
from noteflow.plans.registry import QUERIES
from noteflow.session import local_session

HEADLINE = (
    "gate_summary", "note_frame_join", "monophony", "learn_min_note_ms", "segment_phrases", "extract_melody",
    "expand_variants", "derive_labels", "refine_offsets", "criteria_core", "criteria_score_aug", "corpus_stats",
    "val_split", "merge_runs", "augment_fanout", "syllabify_en", "phonetic_coverage", "auto_syllables", "rasterize",
    "match_candidates", "note_prf", "decode_poly", "align_dtw", "stream_tally",
)

#: Also timed, but not part of the sum, which stays comparable between rounds.
FURTHER = ("humanize", "lyric_plan", "work_list", "stream_gate", "relabel_repair")


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, *FURTHER]
    catalog.load()
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
        except Exception as exc:  # noqa: BLE001 - one broken query must not hide the others
            times[name] = -1.0
            print(f"{name}: {type(exc).__name__}: {str(exc)[:300]}", file=sys.stderr)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(v for n, v in times.items() if v >= 0 and n not in FURTHER), 3)
    line = {"metric": "noteflow_headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}
    print(json.dumps(line))
    return 0


if __name__ == "__main__":
    sys.exit(main())
