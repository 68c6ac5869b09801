"""What an operator leaves in a Python worker."""

import gc
import weakref
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tradeflow.llm import jaccard, langid, packing, workers
from tradeflow.llm.queries import VOCABULARY


class Rows:
    """Stands for a DataFrame whose tasks run here."""

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    columns = ["doc_id", "text"]

    def select(self, *columns):
        return self

    def mapInArrow(self, run, kind):
        return run


@pytest.fixture
def task(spark, monkeypatch):
    """Runs an operator's task over two rows, as in a worker."""
    context = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(jaccard, "TaskContext", context)
    monkeypatch.setattr(packing, "TaskContext", context)
    monkeypatch.setattr(langid, "sample", lambda *_: [])
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2]), "text": pa.array(["some words of text", None])})
    return lambda make, columns=("doc_id", "text"): list(make(Rows())(iter([batch.select(list(columns))])))


PATH = public_tokenizers.path(VOCABULARY)


@pytest.mark.parametrize(
    "make, columns",
    [
        (lambda rows: jaccard._scan(rows, 4, 4), ["doc_id", "text"]),
        (lambda rows: jaccard._sets(rows, 4), ["text"]),
        (lambda rows: langid.identify(rows, None), ["doc_id", "text"]),
    ],
)
def test_a_memo_goes_when_another_operator_comes(task, make, columns):
    pack = lambda: task(lambda rows: packing.pieces(rows, PATH))
    first = pack()
    encoder = weakref.ref(packing.encoder_of(PATH))
    assert pack() == first and packing.encoder_of(PATH) is encoder() and encoder().memo  # warm for its own operator
    assert task(make, columns)
    gc.collect()
    assert encoder() is None
    assert pack() == first


def test_free_memory_goes_back_at_the_end_of_a_task(task, monkeypatch):
    given = []
    pools = [SimpleNamespace(release_unused=lambda n=n: given.append(n)) for n in ("default", "system")]
    fake = SimpleNamespace(default_memory_pool=lambda: pools[0], system_memory_pool=lambda: pools[1])
    monkeypatch.setattr(workers, "pa", fake)
    task(lambda rows: jaccard._sets(rows, 4), ["text"])
    task(lambda rows: packing.pieces(rows, PATH))
    assert given == ["default", "system"] * 2
