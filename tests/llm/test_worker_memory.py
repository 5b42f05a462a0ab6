"""What a worker keeps for one step is dropped by the tasks of later ones (workers are used again)."""

import pickle

import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

from rawfold.llm import token_store as ts

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


class _Taken:
    """Stands for a session and its frames: keeps the function that tasks would run."""

    def createDataFrame(self, rows, schema):
        return self

    def repartition(self, n):
        return self

    def mapInArrow(self, run, schema):
        self.run = pickle.loads(cloudpickle.dumps(run))  # as a worker gets it
        return self


def test_reading_tokens_back_drops_the_encoder_its_worker_has_kept():
    first = ts.encoder(PATH)
    assert ts.encoder(PATH) is first
    taken = _Taken()
    ts.read_tokens(taken, "/nowhere", [{"file": "shard-000000.dac", "tokens": 1}])
    assert list(taken.run(iter([]))) == []
    assert ts.encoder(PATH) is not first


def test_tasks_of_other_operators_drop_it_too():
    """The pipeline's language and near_dups stages run in workers that have written tokens."""
    from rawfold.llm import minhash

    class Docs(_Taken):
        schema = {"id": T.StructField("id", T.LongType())}

    first, taken = ts.encoder(PATH), Docs()
    minhash._members(taken, 5, 4, 2)
    assert list(taken.run(iter([]))) == []
    assert ts.encoder(PATH) is not first
