"""What a task of the training-data operators leaves in its worker process."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pytest
from cadence.llm.common import tidy, worker_state

BLOCKS = 2_000  # of 100,000 bytes each


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGESIZE")


def allocating(batches):
    """Frees all its blocks; the small arrays between them stay, so that the heap doesn't shrink by itself."""
    between = worker_state().setdefault("between", [])
    for batch in batches:
        held = []
        for i in range(BLOCKS):
            held.append(np.ones(100_000, np.uint8))
            if i % 20 == 0:
                between.append(np.ones(5_000, np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64())], names=["n"])


def test_memory_freed_by_a_task_goes_back():
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int64())], names=["n"])
    before = resident()
    out = list(tidy(allocating)(iter([batch])))
    grown = resident() - before
    worker_state().pop("between", None)
    assert [b["n"].to_pylist() for b in out] == [[BLOCKS]]
    assert grown < BLOCKS * 100_000 // 4


def test_a_task_drops_other_modules_state_only():
    def noting(batches):
        yield from batches
        worker_state().setdefault("words", {})["one"] = 1

    worker_state()["left"] = "by another module"
    worker_state()["owner"] = "another module"
    list(tidy(noting)(iter([])))
    assert "left" not in worker_state() and worker_state()["words"] == {"one": 1}
    kept = worker_state()["words"]
    list(tidy(noting)(iter([])))
    assert worker_state()["words"] is kept
    for name in ("owner", "words"):
        del worker_state()[name]


def test_a_failing_task_still_fails():
    def failing(batches):
        yield from batches
        raise ValueError("as before")

    with pytest.raises(ValueError, match="as before"):
        list(tidy(failing)(iter([])))
