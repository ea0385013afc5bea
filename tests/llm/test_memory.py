"""What a Python worker still holds after a task of the pipeline."""

import subprocess
import sys
from pathlib import Path

import pytest

HELD = '''
import sys
import pyarrow as pa
from pyspark.sql import types as T
from linkmill.llm import ngram_join

class Caught:
    """A table that gives the task's function away."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    columns = ["doc_id", "text"]
    def select(self, *_):
        return self
    def mapInArrow(self, run, schema):
        return run

class Named(Caught):
    def alias(self, *_):
        return self
    cast = alias

ngram_join.F = type("F", (), {"col": staticmethod(lambda c: Named())})

def held():
    return sum(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith("Pss_Anon:")) / 1024

def batches(times):
    for k in range(times):
        texts = [" ".join(f"w{(i * 7919 + j * j + k) % 99991}" for j in range(300)) for i in range(4000)]
        yield pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts)], names=["doc_id", "text"])
        del texts

run = {"node": lambda: ngram_join.with_node(Caught(), "text", "node"), "signatures": lambda: ngram_join.signatures(Caught(), "doc_id", "text", 5, 24, 5)}[sys.argv[1]]()
before = held()
rows = sum(b.num_rows for b in run(batches(3)))
print(rows, held() - before)
'''


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
@pytest.mark.parametrize("step", ["node", "signatures"])
def test_worker_gives_memory_back(step):
    """Workers outlive their tasks, and what they hold counts with their executor."""
    out = subprocess.run([sys.executable, "-c", HELD, step], capture_output=True, text=True, cwd=Path(__file__).parents[2], timeout=120)
    assert out.returncode == 0, out.stderr
    rows, mb = out.stdout.split()
    assert int(rows) == 12_000
    assert float(mb) < 60
