"""Texts dealt to the tasks that train on them: compressed, in parts of the caller's number, every row once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rawfold.llm import langid
from rawfold.llm.common import dealt, unpacked

SENT = pa.schema([("h", pa.int64()), ("text", pa.string()), ("y", pa.int32())])


def _rows(spark, n=4000):
    text = F.concat_ws(" ", *[F.concat(F.lit("word"), F.col("id") % k) for k in range(2, 60)])
    return spark.range(0, n, 1, 5).select(F.xxhash64("id").alias("h"), text.alias("text"), (F.col("id") % 2).cast("int").alias("y"))


def test_every_row_is_in_one_part_in_order(spark):
    def rows_of(batches):
        from pyspark import TaskContext
        t = unpacked(batches, SENT, ("h", "y"))
        yield pa.RecordBatch.from_arrays([t.column("h").combine_chunks(), t.column("text").combine_chunks(), t.column("y").combine_chunks(),
                                          pa.array([TaskContext.get().partitionId()] * len(t), pa.int32()),
                                          pa.array(range(len(t)), pa.int32())], ["h", "text", "y", "part", "at"])

    rows = _rows(spark)
    packs = dealt(rows, 3, "h", SENT)
    assert packs.rdd.getNumPartitions() == 3
    out = packs.mapInArrow(rows_of, "h long, text string, y int, part int, at int").collect()
    assert sorted((r.h, r.text, r.y) for r in out) == sorted(tuple(r) for r in rows.collect())
    assert {r.part for r in out} == {0, 1, 2}
    for p in range(3):
        own = [r.h for r in sorted((r for r in out if r.part == p), key=lambda r: r.at)]
        assert own == sorted(own)


def test_texts_are_compressed_before_they_are_shuffled(spark):
    rows = _rows(spark)
    raw = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    sent = dealt(rows, 3, "h", SENT).agg(F.sum(F.octet_length("pack"))).first()[0]
    assert 3 * sent < raw


def test_no_text_is_shuffled_as_it_is(spark, monkeypatch):
    """The one shuffle of texts is that of the packs, and there are as many models as parts by size, however many partitions a shuffle has."""
    seen = []
    monkeypatch.setattr(langid, "dealt", lambda rows, parts, by, schema, prepare: seen.append(parts) or dealt(rows, parts, by, schema, prepare))
    docs = _rows(spark, 200).select(F.col("h").alias("doc_id"), "text", F.when(F.col("y") == 1, "en").otherwise("de").alias("lang"))
    model = langid.fit(docs, F.lit(True), alpha=0, part_docs=50)
    assert seen == [4] and model.langs == ["de", "en"]


def test_sums_by_column_are_sums_of_rows():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(1025, 4)).astype(np.float32)
    table[1024] = 0
    texts = [b" ab ", b" some longer text of words ", b"  ", b" x "]
    sums, counts = langid.text_sums(texts, table)
    for text, got, n in zip(texts, sums, counts):
        flat = np.frombuffer(text + b"    ", np.uint8)
        rows = np.concatenate([langid.gram_rows(flat, k, len(text), 1024) for k in langid.GRAMS])
        assert n == (rows != 1024).sum()
        np.testing.assert_allclose(got, table[rows].sum(axis=0), atol=1e-4)


def test_subwords_of_many_samples_are_those_of_each():
    samples = [b" ab cd ", b"  ", b" a ", b" words and words "]
    for s, got in zip(samples, langid._subwords(samples, 512)):
        flat = np.frombuffer(s + b"    ", np.uint8)
        rows = np.concatenate([langid.gram_rows(flat, k, len(s), 512) for k in langid.GRAMS])
        assert got.tolist() == rows[rows != 512].tolist()


def test_texts_are_dealt_as_their_spans():
    words = [f"w{i}" for i in range(500)]
    h = list(range(0, 2000, 7))
    t = langid._excerpts(pa.table({"h": h, "text": [" ".join(words)] * len(h), "label": ["en"] * len(h)}))
    whole = [x for k, x in zip(h, t.column("text").to_pylist()) if langid._is_held(k)]
    cut = [x for k, x in zip(h, t.column("text").to_pylist()) if not langid._is_held(k)]
    assert 0.05 < len(whole) / len(h) < 0.15 and set(whole) == {" ".join(words)}
    for x in cut:
        spans = x.split("\n")
        assert len(spans) == 4 and all(s in " ".join(words) and s for s in spans)
    assert sum(map(len, cut)) < 0.5 * len(cut) * len(whole[0])
    assert langid.excerpt("a b c", 5) == langid.excerpt("a b c", 5)
    assert langid.excerpt("", 1) == "\n\n\n"


def test_parts_of_spans_learn_the_languages(spark):
    say = {"en": "the house and the garden of which they were often thinking", "de": "das haus und der garten an den sie oft gedacht haben"}
    docs = spark.createDataFrame([(i, " ".join(say[x].split()[i % 5:] * 6), x) for i in range(400) for x in say],
                                 "doc_id long, text string, lang string").withColumn("doc_id", F.monotonically_increasing_id())
    model = langid.fit(docs, F.lit(True), alpha=0, part_docs=200)
    texts = ["they were in the garden", "sie haben oft an das haus gedacht"]
    assert langid.predict(model, texts)[0] == ["en", "de"]
