"""The end-to-end example runs and its numbers hang together."""

from __future__ import annotations

import os
import runpy


def test_walkthrough_end_to_end(spark):
    mod = runpy.run_path(os.path.join(os.path.dirname(__file__), "..", "examples", "walkthrough.py"))
    out = mod["main"]("/root/testdata/sf0.01")
    assert out["train_rows"] + out["test_rows"] > 0
    assert out["monitoring"]["log_rows"] == out["test_rows"] == out["monitoring"]["written_rows"]
    assert out["metrics"]["example_count"] == out["test_rows"]
