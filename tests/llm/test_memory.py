"""What a Python worker still holds after a task."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from customer_canon.llm import common, packing
from customer_canon.llm.common import release_memory, releasing

ROLLUP = Path("/proc/self/smaps_rollup")
only_linux = pytest.mark.skipif(
    not sys.platform.startswith("linux") or not ROLLUP.exists(), reason="reads this process's own memory from /proc"
)


def own_mb() -> float:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", ROLLUP.read_text())[1]) / 1024


@only_linux
def test_freed_memory_goes_back_to_the_system():
    release_memory()
    before = own_mb()
    held = [bytes(2000) for _ in range(40_000)]
    last = held[-1]
    del held
    release_memory()
    assert own_mb() - before < 20 and len(last) == 2000


def test_memory_is_released_after_the_last_batch_and_when_a_task_ends_early(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1))

    def doubled(batches):
        for batch in batches:
            yield 2 * batch

    work = releasing(doubled)
    assert list(work(iter([1, 2]))) == [2, 4] and len(calls) == 1
    early = work(iter([1, 2]))
    assert next(early) == 2 and len(calls) == 1
    early.close()
    assert len(calls) == 2


class _Docs:
    """Stands for a table; keeps the function that a task would run."""

    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])

    def selectExpr(self, *columns):
        return self

    def mapInArrow(self, work, schema):
        return work


class _Task:
    @staticmethod
    def get():
        return _Task

    @staticmethod
    def partitionId():
        return 0


@only_linux
def test_a_worker_keeps_no_tokenizer_after_packing(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", _Task)
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    work = packing.pack_documents(_Docs(), *files, with_ids=True)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, None], "text": ["Some words. " * 900, None, "some more"]})
    assert sum(out.num_rows for out in work(iter([batch]))) > 3  # once before, for the modules that it imports
    release_memory()
    before = own_mb()
    for _ in work(iter([batch])):
        pass
    assert own_mb() - before < 25
