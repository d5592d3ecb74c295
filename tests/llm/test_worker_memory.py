"""Workers live on between tasks: what a task freed goes back to the system, and results come as without it."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import chunks

ROLLUP = Path("/proc/self/smaps_rollup")


def held() -> float:
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", ROLLUP.read_text()))) / 1024


@pytest.mark.skipif(not ROLLUP.exists(), reason="no memory figures here")
def test_freed_memory_goes_back():
    kept = []

    def work(table):
        large = [np.ones(1 << 20) for _ in range(2)]  # freeing these makes the allocator keep more
        del large
        many = [np.ones(1 << 15) for _ in range(600)]
        kept.append(np.ones(1 << 12))  # lies above them
        return table.num_rows + len(many)

    before = held()
    assert chunks.lean(work)(pa.table({"x": [1]})) == 601
    assert held() - before < 60  # 150 MB were taken
    assert list(chunks.lean_batches(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4]
    assert chunks.lean(lambda left, right: (left, right))(1, 2) == (1, 2)


def test_windows_of_a_chunk_take_sixteen_bytes_each():
    from tillroll.llm import substring_dedup

    text = " ".join(f"w{i % 97}" for i in range(5000)).encode()
    h, doc, at, counts = substring_dedup._windows(np.arange(2, dtype=np.int32), np.frombuffer(text * 2, np.uint8),
                                                  np.array([0, len(text), 2 * len(text)]), 50)
    assert counts.tolist() == [5000, 5000] and len(h) == 2 * 4951
    assert h.nbytes + doc.nbytes + at.nbytes == 16 * len(h)
    assert at[0] == 0 and at[4951] == 5000 and doc[4950] == 0 and doc[4951] == 1
