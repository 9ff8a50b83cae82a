import sys
from pathlib import Path

import pyarrow as pa
import pytest

from tideglass.llm.common import released


@pytest.mark.skipif(sys.platform != "linux", reason="resident memory is read from /proc")
def test_freed_memory_leaves_the_worker():
    """What a task has freed between small objects that stay goes back to the system behind its last batch."""
    import resource

    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize() >> 20
    batch = pa.RecordBatch.from_pydict({"a": [1, 2]})
    large, small = [], []
    for k in range(2000):
        large.append(b"x" * 60_000)
        small.append(bytes([k % 256]) * 2_000)
    del large
    before = resident()
    assert [*released(iter([batch, batch]))] == [batch, batch] and resident() < before - 80 and len(small) == 2000
