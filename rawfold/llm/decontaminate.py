"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned over all
training windows, every hit verified word by word.

The benchmark is cut into blocks of at most ``block_bytes`` of text; a block (and so what is broadcast)
never grows with the benchmark. One block is the usual case and costs one pass over the documents;
further blocks are further passes that add their hits to the same rows.

In a worker a word is its number in the block's vocabulary (0: not there), so equal numbers are equal
words. A rolling hash of every window of the block's lengths is looked up in the sorted hash array; the
words of each hit are then compared with the item's, so a hash collision never counts.

Defined results: a null or empty text has no words and no hit; an item without words has no window; an
item of fewer words than the window is one window; rows that repeat an item id are one item; a null
item id marks words but is not listed; rows that repeat a document id are separate; empty tables give an empty
result (no documents) or no hits (no benchmark); other columns are ignored (``decontaminate`` keeps them).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawfold.llm.common import alnum_words, bounded_batches, checkpointed, discard, materialize

_MULT = np.uint64(0x9E3779B97F4A7C15)


class Block(NamedTuple):
    """Windows of some items: vocabulary, and per window length sorted hashes with their windows."""
    vocab: dict
    lengths: dict  # length -> (sorted distinct hashes, starts into windows, windows [m, length], item per window)


def _window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    n = len(ids) - length + 1
    h = np.zeros(n, np.uint64)
    w = ids.astype(np.uint64)
    for j in range(length):
        h = (h + w[j:j + n]) * _MULT
        h ^= h >> np.uint64(29)
    return h


def build_block(items: list[tuple], window: int) -> Block:
    """items: (item id as string or None, text)."""
    vocab: dict = {}
    by_length: dict = {}
    for item, text in items:
        words = alnum_words(text)
        if words:
            ids = np.array([vocab.setdefault(w, len(vocab) + 1) for w in words], np.int32)
            by_length.setdefault(min(window, len(ids)), []).append((item, ids))
    lengths = {}
    for length, found in by_length.items():
        rows = np.concatenate([np.lib.stride_tricks.sliding_window_view(ids, length) for _, ids in found])
        owner = [item for item, ids in found for _ in range(len(ids) - length + 1)]
        hashes = np.concatenate([_window_hashes(ids, length) for _, ids in found])
        order = np.argsort(hashes, kind="stable")
        uniq, start = np.unique(hashes[order], return_index=True)
        lengths[length] = (uniq, np.append(start, len(order)), rows[order], [owner[i] for i in order])
    return Block(vocab, lengths)


def scan(words: list[bytes], block: Block) -> tuple[np.ndarray, set]:
    """(hit flag per word, items with an occurring window)."""
    ids = np.fromiter((block.vocab.get(w, 0) for w in words), np.int32, len(words))
    hit, items = np.zeros(len(ids), bool), set()
    for length, (uniq, start, windows, owner) in block.lengths.items():
        if len(ids) < length:
            continue
        known = np.cumsum(np.concatenate(([0], ids > 0)))
        at = np.flatnonzero(known[length:] - known[:-length] == length)  # windows of known words only
        if not len(at):
            continue
        h = _window_hashes(ids, length)[at]
        pos = np.minimum(np.searchsorted(uniq, h), len(uniq) - 1)
        for i, p in zip(at[uniq[pos] == h], pos[uniq[pos] == h]):
            for w in range(start[p], start[p + 1]):
                if np.array_equal(windows[w], ids[i:i + length]):
                    hit[i:i + length] = True
                    items.add(owner[w])
    return hit, items


def _spans(hit: np.ndarray) -> list[dict]:
    if not hit.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of at most ``block_bytes`` of text and one item more.

    Yields one block at a time to the driver: what is collected is bounded by the block. Blocks are cut by a prefix sum over
    ranges of about a block: a range adds up its own sizes, and the driver gets one number of each. Rows that repeat an item and
    its text are taken once, so that they cannot fill a range."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                             F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    if total <= block_bytes:
        yield [(r["item"], r["text"]) for r in items.collect()]
        return
    keyed = items.distinct().withColumns({"h": F.xxhash64("item", "text"), "size": F.octet_length("text") + 16})
    ranges = materialize(keyed.repartitionByRange(math.ceil(total / block_bytes), "h").withColumn("range", F.spark_partition_id()),
                         "benchmark-ranges")
    sums = sorted(tuple(r) for r in ranges.groupBy("range").agg(F.sum("size")).collect())  # one row a range
    starts = itertools.accumulate((n for _, n in sums), initial=0)
    offsets = ranges.sparkSession.createDataFrame([(r, s) for (r, _), s in zip(sums, starts)], "range int, start long")
    order = Window.partitionBy("range").orderBy("h", "item", "text").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("start")
    slim = materialize(ranges.join(offsets, "range").select("item", "text", F.floor(before / block_bytes).alias("block")),
                       "benchmark-blocks")
    discard(ranges)
    for row in slim.select("block").distinct().orderBy("block").toLocalIterator():
        yield [(r["item"], r["text"]) for r in slim.filter(F.col("block") == row["block"]).collect()]
    discard(slim)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                       block_bytes: int = 16 << 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans, items`` and the columns in ``keep``.

    ``spans`` are the hit words as (first, last) word positions, ``items`` the ids (as strings, sorted) of
    items with an occurring window."""
    spark = docs.sparkSession
    bounded_batches(spark)
    hits = "array<struct<first:int,last:int>>"
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys((id_col, *keep))]).alias("row"),
                       text.alias("text"), F.lit(0).cast("long").alias("n_words"),
                       F.array().cast(hits).alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = rows.schema
    blocks = 0
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        if blocks:
            rows = checkpointed(rows)
        sent = spark.sparkContext.broadcast(build_block(items, window))
        rows = rows.mapInArrow(_scanner(sent), schema)
        blocks += 1
    return rows.select("row.*", "n_words", "spans", "items")


def _scanner(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for b in batches:
            n_words, spans, items = [], [], []
            for text, s0, i0 in zip(b.column("text"), b.column("spans"), b.column("items")):
                words = alnum_words(text.as_py())
                hit, found = scan(words, block)
                if len(s0):
                    for s in s0.as_py():
                        hit[s["first"]:s["last"] + 1] = True
                n_words.append(len(words))
                spans.append(_spans(hit))
                items.append(sorted({x for x in found if x is not None} | set(i0.as_py())))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("text"), pa.array(n_words, pa.int64()),
                 pa.array(spans, b.schema.field("spans").type), pa.array(items, b.schema.field("items").type)],
                schema=b.schema)

    return run


def contamination_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``find_contamination`` as the columns doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, action: str = "drop", text_col: str = "text",
                  id_col: str = "doc_id", max_hit_share: float = 0.0, **options) -> DataFrame:
    """The documents without benchmark passages; the same columns.

    ``drop`` removes documents of whose words more than ``max_hit_share`` are hit; ``cut`` removes the hit words
    with what stands between them from the text instead (a document of hits only becomes empty)."""
    if action not in ("drop", "cut"):
        raise ValueError(f"action is 'drop' or 'cut', not {action!r}")
    names = docs.columns
    found = find_contamination(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
                                           F.col(f"`{text_col}`").alias("text"), F.lit(0).alias("id")),
                               benchmark, id_col="id", text_col="text", keep=("doc",), **options)
    if action == "drop":
        n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
        return found.filter(n_hit <= F.col("n_words") * max_hit_share).select(
            *[F.col(f"doc.`{c}`").alias(c) for c in names])
    cut = _cut_words(found.select("doc", "spans"), text_col)
    return cut.select(*[(F.col("text") if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in names])


def _cut_words(found: DataFrame, text_col: str) -> DataFrame:
    import re
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    text = F.col(f"doc.`{text_col}`").cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                if t and spans:
                    raw = t.encode()
                    places = [m.span() for m in word.finditer(raw.lower())]  # bytes: A-Z only
                    for s in reversed(spans):
                        raw = raw[:places[s["first"]][0]] + raw[places[s["last"]][1]:]
                    t = raw.decode()
                out.append(t)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("spans"), pa.array(out, b.schema.field("text").type)], schema=b.schema)

    rows = found.select("doc", "spans", text.alias("text"))
    return rows.mapInArrow(run, rows.schema)

