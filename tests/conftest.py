import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from noteflow.session import local_session

    return local_session(8, 8, "8g")


@pytest.fixture
def notes(spark):
    """Builds a note table from {score: [(onset, offset, pitch[, lyric])]}."""

    def make(scores):
        rows = [
            (sid, i, float(n[0]), float(n[1]), int(n[2]), n[3] if len(n) > 3 else None)
            for sid, ns in scores.items()
            for i, n in enumerate(ns)
        ]
        return spark.createDataFrame(rows, "score_id string, note_idx int, onset_s double, offset_s double, pitch_midi int, lyric string")

    return make
