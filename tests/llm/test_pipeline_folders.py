"""What a pipeline run leaves behind."""

import corpus_pipeline
from roadpulse import session
from roadpulse.streaming import files

SF_DIR = "/root/testdata/sf0.001"


def test_a_run_leaves_the_last_input_and_what_the_last_stage_made(spark, monkeypatch):
    every, original = [], session.workspace

    def listed(*args):
        every.append(original(*args))
        return every[-1]

    monkeypatch.setattr("roadpulse.llm.common.workspace", listed)
    start = session.mark()
    kept = corpus_pipeline.run(spark, SF_DIR)
    assert kept.count() > 0
    left = [p for p in every if files.exists(spark, p)]
    assert "llm-secrets" in left[0] and len(left) <= 2 < len(every)
    assert session.release(spark, start) == len(left)
    assert not any(files.exists(spark, p) for p in every)
