"""What workers keep from one operator to the next."""

import pyarrow as pa
import public_tokenizers

from eventloom.llm import packing
from eventloom.llm.common import by_batch
from tests.llm import odd


def test_other_work_frees_remembered_words(spark):
    """A worker that goes from packing over to another operator holds no words of the tokenizer any more."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = odd.docs(spark, [(i, " ".join(f"word{i}x{k}" for k in range(300)), "en", "a", 0) for i in range(40)], clashing=False)
    assert packing.harmonic_pack(docs, path).count() >= 40

    def held(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = packing.tokenizer(path)
        return pa.record_batch([pa.array([len(known.known) + len(known.old)], pa.int64())], ["n"])

    found = by_batch(spark.range(64).repartition(16), held, "n long").collect()
    assert {r.n for r in found} == {0}
