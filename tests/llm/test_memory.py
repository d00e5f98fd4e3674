"""What Python workers hold, while they work and afterwards."""

import subprocess
import sys
import tracemalloc

import pyarrow as pa

from marketlens.llm import jaccard
from marketlens.llm.common import arrow_map


class Rows:
    """Stands for a frame of one partition, worked on in this process."""

    def __init__(self, **columns):
        self.batch = pa.RecordBatch.from_pydict(columns)

    def mapInArrow(self, fn, schema):  # noqa: N802
        return fn(iter([self.batch]))


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def grown(after) -> int:
    """By how much this process is larger once ``after`` has come and gone."""
    pins = []

    def run(batches):
        for b in batches:
            waste = [bytearray(b"x" * 100_000) for _ in range(1500)]
            pins.append(bytearray(120_000))  # fits no hole, so it lies above the waste and the heap's end cannot move back
            yield {"v": [len(waste)]}

    before = resident()
    after(run)
    return resident() - before


def test_a_worker_gives_back_what_its_task_took():
    code = "from test_memory import *; print(grown(lambda run: list(arrow_map(Rows(v=[1]), run, 'v long'))))"
    path = [p for p in sys.path if p]
    out = subprocess.run([sys.executable, "-c", f"import sys; sys.path[:0] = {path!r}; {code}"], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 100_000_000


def test_a_group_gives_back_what_it_took():
    code = "from test_memory import *; from marketlens.llm.common import freed; print(grown(lambda run: freed(lambda rows: list(run([rows])))(1)))"
    path = [p for p in sys.path if p]
    out = subprocess.run([sys.executable, "-c", f"import sys; sys.path[:0] = {path!r}; {code}"], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 100_000_000


def test_functions_of_one_and_two_tables_stay_what_they_are():
    from marketlens.llm.common import freed

    assert freed(lambda rows: rows + 1)(1) == 2
    assert freed(lambda left, right: (left, right))(1, 2) == (1, 2)
    assert [freed(f).__code__.co_argcount for f in (lambda a: a, lambda a, b: a)] == [1, 2]


def test_few_texts_are_objects_at_a_time():
    n = 10_000
    words = b"".join(b"%d " % i for i in range(n))
    docs = Rows(doc_id=range(n), text_key=range(n), text=[words[i : i + 6000] for i in range(n)])  # 60 MB
    most = docs.batch.nbytes // 2
    for made in (jaccard._sets, lambda d, width: jaccard._keys(d, width, jaccard.Bands(80, 100))):
        tracemalloc.start()
        rows = sum(b.num_rows for b in made(docs, 5))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows and peak < most
