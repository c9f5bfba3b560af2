"""What workers hold: bounded runs, and nothing that is free after a task."""

import numpy as np
import pyarrow as pa
import pytest

from depotlens.llm import words


def _held_mb() -> float:
    try:
        with open("/proc/self/status") as lines:
            return next(int(line.split()[1]) / 1024 for line in lines if line.startswith("RssAnon"))
    except (OSError, StopIteration):
        pytest.skip("no /proc")


def test_memory_is_given_back_after_a_task():
    def run(batches):
        kept = []
        for size in batches:
            kept = [np.ones(size, np.uint8) for _ in range(200_000_000 // size)]
            last = np.ones(1000, np.uint8)
            yield kept[0][:1]
        del kept
        yield last  # at the end of what the allocator holds

    before = _held_mb()
    last = list(words.released(run)([50_000]))
    assert len(last) == 2
    assert _held_mb() < before + 100


def test_released_gives_what_the_run_gives_and_fails_as_it_fails():
    def run(batches):
        for batch in batches:
            if batch is None:
                raise ValueError("no batch")
            yield batch

    assert list(words.released(run)(iter([1, 2]))) == [1, 2]
    with pytest.raises(ValueError, match="no batch"):
        list(words.released(run)(iter([1, None])))


def test_runs_of_texts_are_small_and_whole():
    texts = ["a" * 300_000] * 20 + ["b" * 5_000_000, None, "", "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(words.slices(batch))
    assert [t for part in parts for t in part.column("text").to_pylist()] == texts
    sizes = [sum(len(t or "") for t in part.column("text").to_pylist()) for part in parts]
    assert max(size for size in sizes if size < 5_000_000) <= 2_000_000
