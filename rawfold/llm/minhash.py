"""Near-duplicate documents: fast similarity sketching, banding, exact verification, components.

1. Shingles. A document's set is its distinct ``k``-word shingles as 64-bit hashes (a document of fewer
   words is one shingle; one without words has the empty set and is linked with nothing).
2. Classes. Documents with equal sets (128-bit digest of the sorted set) form one class, by a partial
   aggregate: thousands of copies become one row, and only classes are compared.
3. Sketch. ``t`` bins are filled in at most ``2t`` rounds: in round ``i < t`` every shingle falls into a
   hashed bin with value ``i + hash``; from round t on, round ``t + j`` puts every shingle into bin j. A bin
   keeps its smallest value, and the rounds end when all bins are filled, so every coordinate is filled
   and coordinates agree with a probability of the Jaccard similarity, with the concentration of t
   independent draws.
4. Bands of ``rows`` coordinates are keys. Each class is paired with one hub of the buckets it is in; pairs are
   verified on the full sets, and components are found by star contraction. A bucket whose classes then lie in
   several components is not settled. For ``rounds`` rounds each class outside its bucket's largest component is
   paired with one member of it; then what is still apart is compared, by a finer sketch, with all classes of
   other components in the bucket, and the pairs that may be similar enough are verified too. So links between
   components are found without making n * n pairs of a bucket of n copies.
5. Verification is exact: full sets of both sides, ``100 * |A and B| >= percent * |A or B|``.

A pair at exactly 0.8 shares none of the 64 bands of 8 with a probability below 1e-5, and is ruled out by the finer
sketch with one below 1e-5.

Defined results: null and empty texts have ``n_shingles`` 0 and are their own component; rows that
repeat an id are separate members (equal texts fall in one class anyway); a null id never names a component
unless all ids there are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm.common import WordHashes, bounded_batches, checkpointed, discard, forget, materialize, space_words

_M1, _M2, _K = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def shingle_set(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles."""
    words = space_words(text)
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - k + 1)
    h = np.full(n, len(w) if len(w) < k else k, np.uint64)
    for j in range(min(k, len(w))):
        h = mix64((h + w[j:j + n]) * _K)
    return np.unique(h)


def fast_similarity_sketch(shingles: np.ndarray, t: int) -> np.ndarray:
    """``t`` coordinates of 64 bits: round number above, 48 bits of the value's hash below."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(t, none, np.uint64)
    low = np.uint64((1 << 48) - 1)
    filled = 0
    per = max(1, min(t, 4096 // max(1, len(shingles))))  # rounds done at a time for small sets
    i = 0
    while i < 2 * t and filled < t:
        m = min(per, (t if i < t else 2 * t) - i)
        rounds = np.arange(i, i + m, dtype=np.uint64)
        h = mix64(shingles[None, :] ^ mix64(rounds + _K)[:, None])
        value = (rounds[:, None] << np.uint64(48)) | (mix64(h + _K) & low)
        if i < t:
            where = (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(bins, where.ravel(), value.ravel())
        else:
            bins[i - t:i - t + m] = np.minimum(bins[i - t:i - t + m], value.min(axis=1))
        i += m
        filled = int((bins != none).sum())
    return bins


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key per band of ``rows`` coordinates; the band's number is part of it."""
    s = sketch.reshape(-1, rows)
    key = mix64(np.arange(1, len(s) + 1, dtype=np.uint64) * _K)
    for j in range(rows):
        key = mix64((key + s[:, j]) * _K)
    return key.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _members(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(id, th, text) -> (id, th, digest, n, band keys); digest and keys null for the empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hashes, seen = WordHashes(), {}
        for b in batches:
            n, digests, keys = [], [], []
            for text in b.column("text"):
                s = shingle_set(text.as_py(), k, hashes)
                d = _digest(s) if len(s) else None
                if d is not None and d not in seen:
                    if len(seen) >= 256:  # only spares copies the work
                        seen.clear()
                    seen[d] = band_keys(fast_similarity_sketch(s, bands * rows), rows)
                n.append(len(s))
                digests.append(d)
                keys.append(None if d is None else seen[d])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(digests, pa.binary()), pa.array(n, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "th", "digest", "n", "bands"])

    schema = T.StructType([docs.schema["id"], T.StructField("th", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(run, schema)


def _full_sets(texts: DataFrame, k: int) -> DataFrame:
    """(node, digest, text) -> (node, full shingle set) of the texts whose set has that digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            nodes, sets = [], []
            for node, digest, text in zip(b.column("node"), b.column("digest"), b.column("text")):
                s = shingle_set(text.as_py(), k, hashes)
                if _digest(s) == digest.as_py():
                    nodes.append(node.as_py())
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>")


FINE = 2048  # coordinates of the sketch that rules pairs out; two bits of each are kept


def fine_bits(shingles: np.ndarray) -> np.ndarray:
    """Two bits of each of ``FINE`` sketch coordinates, packed into 64-bit words."""
    two = (fast_similarity_sketch(shingles, FINE) & np.uint64(3)).reshape(-1, 32)
    return (two << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64)


def most_mismatches(percent: int) -> int:
    """Mismatching coordinates that a pair of that similarity exceeds with a probability of 3e-6 (4.5 deviations):
    two bits agree with a probability of (1 + 3 s) / 4."""
    p = (1 + 3 * percent / 100) / 4
    return int(FINE * (1 - p) + 4.5 * (FINE * p * (1 - p)) ** 0.5) + 1


def _fine(texts: DataFrame, k: int) -> DataFrame:
    """(node, digest, text) -> (node, f0, f1, ...) of the texts whose set has that digest."""
    names = [f"f{i}" for i in range(FINE // 32)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            nodes, bits = [], []
            for node, digest, text in zip(b.column("node"), b.column("digest"), b.column("text")):
                s = shingle_set(text.as_py(), k, hashes)
                if _digest(s) == digest.as_py():
                    nodes.append(node.as_py())
                    bits.append(fine_bits(s).view(np.int64))
            rows = np.array(bits, np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), *[pa.array(rows[:, i]) for i in range(len(names))]],
                                             ["node", *names])

    return texts.mapInArrow(run, "node long, " + ", ".join(f"{n} long" for n in names))


def _texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, digest, text): a text of each class, found by the hash of the text and the id."""
    carriers = classes.join(nodes, "node").select("node", "digest", F.col("carrier.th").alias("cth"),
                                                  F.col("carrier.id").alias("cid"))
    return (docs.join(carriers, (F.col("th") == F.col("cth")) & F.col("id").eqNullSafe(F.col("cid")))
            .select("node", "digest", "text").dropDuplicates(["node", "text"]))


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Distinct pairs of classes (a, b) whose full sets are similar enough.

    Sizes alone settle many pairs. The sets of the classes that remain are built again from one text of each
    class; a pair carries the set of b and meets that of a in a join, so a hub's set is sent once."""
    size = classes.select("node", "n")
    pairs = (pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
             .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b"))
    pairs = materialize(pairs, "near-dup-pairs")
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = _texts_of(need, classes, docs)
    sets = materialize(_full_sets(texts, k), "near-dup-sets")
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - common
    links = materialize(both.filter(common * 100 >= union * percent).select("a", "b"), "near-dup-links")
    discard(pairs, sets)
    return links


def _mark(edges: DataFrame) -> tuple:
    """Number and checksums of the edges, in one job: equal when a step has changed nothing."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1_000_003)))).first())


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node) and links (a, b) -> (node, comp): the smallest node of the connected component.

    Alternating star contraction; each step is a partial aggregate by node, so a hub of many links
    ships one row per map task, and links shrink to one per node."""
    edges = checkpointed(links.filter("a != b").select(F.greatest("a", "b").alias("u"),
                                                       F.least("a", "b").alias("v")).distinct())
    mark = _mark(edges)
    while mark[0]:
        # large star: every larger neighbour is linked to the smallest of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
        large = checkpointed(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .filter("u != v").distinct())
        # small star: the smaller neighbours and the node itself are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = checkpointed(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        was, mark = mark, _mark(edges)
        if was == mark:
            break
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")), "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp"))


def near_dup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
             bands: int = 64, rows: int = 8, rounds: int = 1) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    bounded_batches(docs.sparkSession)
    docs = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .withColumn("th", F.xxhash64("text")))
    members = materialize(_members(docs, k, bands, rows), "near-dup-members")

    # one class per set; a text of it is found again by the hash of the text and the id
    classes = materialize(
        members.filter("n > 0").groupBy("digest")
        .agg(F.min("id").alias("least"), F.min(F.struct("th", "id")).alias("carrier"),
             F.first("n").alias("n"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "near-dup-classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    # written first: the next joins then have plain shuffles on both sides, which AQE can split
    shared = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "near-dup-shared")
    buckets = materialize(keys.join(shared, "key"), "near-dup-buckets")
    # the classes that meet most others lie in the middle of their neighbours: one of them is each bucket's hub
    weight = materialize(buckets.groupBy("node").agg(F.sum("size").alias("w")), "near-dup-weights")
    hubs = materialize(buckets.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node")).alias("hub")),
                       "near-dup-hubs")

    discard(shared, weight)
    # first each class with the weightiest hub it meets, then ``rounds`` times one pair for each class that is still apart
    # from its bucket's largest component, then all pairs across components of a bucket that may be similar enough
    nodes = classes.select("node")
    tried = links = None
    comps = nodes.withColumn("comp", F.col("node"))
    for attempt in range(rounds + 2):
        scratch: list[DataFrame] = []
        if attempt == 0:
            new = (buckets.select("key", "node").join(hubs, "key").groupBy("node").agg(F.max("hub").alias("hub"))
                   .filter("hub.node != node")
                   .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct())
            scratch.append(hubs)
        elif attempt <= rounds:
            new = _one_each(buckets, comps, attempt, scratch)
        else:
            new = _unsettled(buckets, comps, classes, docs, k, percent, scratch)
        if new is None:
            break
        if tried is not None:
            new = new.join(tried, ["a", "b"], "left_anti")
        new = materialize(new, "near-dup-tried")
        discard(*scratch)
        if new.isEmpty():
            continue
        tried = new if tried is None else tried.unionByName(new)
        found = verify(new, classes, docs, k, percent)
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        comps = materialize(components(nodes, links), "near-dup-components")

    named = comps.join(classes, "node").select("comp", "digest", "least")
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(names, "comp").select("digest", "component_id"), "near-dup-names")
    discard(classes, buckets)
    out = members.select("id", "digest", "n").join(named, "digest", "left")
    comp = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.col("id").eqNullSafe(comp).alias("kept"))


CELL = 256  # classes of a bucket that meet in one place


def _apart(buckets: DataFrame, comps: DataFrame, scratch: list[DataFrame]) -> tuple[DataFrame, DataFrame] | None:
    """Rows (key, node, comp, main, cells) of buckets that hold several components: all of them, and those outside the
    bucket's largest component; ``cells`` grows with the bucket. None if there are none. Tables written are added to ``scratch``."""
    placed = materialize(buckets.select("key", "node").join(comps, "node"), "near-dup-placed")
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("parts"),
                                    F.ceil(F.sum("n") / CELL).cast("long").alias("cells"))
    main = materialize(main.filter("parts > 1").drop("parts"), "near-dup-apart")
    scratch.append(main)
    if main.isEmpty():
        discard(placed)
        return None
    b = materialize(placed.join(main, "key"), "near-dup-open")
    scratch.append(b)
    discard(placed)
    return b, b.filter("comp != main")


def _one_each(buckets: DataFrame, comps: DataFrame, attempt: int, scratch: list[DataFrame]) -> DataFrame | None:
    """One pair (a < b) for each class outside its bucket's largest component: with the member of that component
    whose hash, other for every attempt, is smallest; over its buckets the smallest of these."""
    apart = _apart(buckets, comps, scratch)
    if apart is None:
        return None
    every, minor = apart
    chosen = (every.filter("comp = main").groupBy("key")
              .agg(F.min(F.struct(F.xxhash64(F.lit(attempt), "node").alias("h"), F.col("node").alias("x"))).alias("pick")))
    best = minor.join(chosen, "key").groupBy("node").agg(F.min("pick").alias("pick"))
    return best.select(F.least("node", "pick.x").alias("a"), F.greatest("node", "pick.x").alias("b")).distinct()


def _unsettled(buckets: DataFrame, comps: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int,
               scratch: list[DataFrame]) -> DataFrame | None:
    """Pairs (a < b) that share a bucket, lie in different components and may be similar enough: every class outside
    the bucket's largest component against every class of another component there.

    The comparison is the join's condition, on two bits of each of 2,048 sketch coordinates, so pairs it rules out
    are never rows; a pair is looked at in the smallest of the keys it shares only. A bucket's classes are dealt out over cells of some
    ``CELL``, and the classes outside its largest component go to each of them, so no task holds a large bucket."""
    apart = _apart(buckets, comps, scratch)
    if apart is None:
        return None
    every, minor = apart
    fine = materialize(_fine(_texts_of(every.select("node").distinct(), classes, docs), k), "near-dup-fine")
    scratch.append(fine)
    fine = fine.dropDuplicates(["node"]).join(classes.select("node", "bands"), "node")
    names = [f"f{i}" for i in range(FINE // 32)]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def side(rows: DataFrame, tag: str, cell) -> DataFrame:
        return (rows.select("key", "node", "comp", cell.alias("cell")).join(fine, "node")
                .toDF("node_" + tag, "key", "comp_" + tag, "cell", *[f"{n}_{tag}" for n in names], "bands_" + tag)
                .repartition(parts, "key", "cell"))

    x = side(minor, "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    y = side(every, "y", F.pmod(F.xxhash64("node"), "cells"))
    wrong = F.lit(0)
    for n in names:
        v = F.col(n + "_x").bitwiseXOR(F.col(n + "_y"))
        wrong = wrong + F.bit_count((v.bitwiseOR(F.shiftrightunsigned(v, 1))).bitwiseAND(F.lit(0x5555555555555555)))
    both = x.join(y, (x["key"] == y["key"]) & (x["cell"] == y["cell"]) & (F.col("comp_x") != F.col("comp_y"))
                  & (wrong <= most_mismatches(percent))
                  & (F.array_min(F.array_intersect("bands_x", "bands_y")) == x["key"]))
    return both.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def drop_near_dups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each component; the same columns.

    Rows are told apart by id and a hash of all their columns, so of rows equal in both one stays."""
    names = docs.columns
    keyed = docs.withColumn("__key", F.struct(F.col(f"`{id_col}`").alias("id"),
                                              F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("row")))
    marked = near_dup(keyed.select("__key", F.col(f"`{text_col}`").alias("text")), id_col="__key", text_col="text",
                      **options)
    stay = marked.filter("kept").select("__key").distinct()
    return keyed.join(stay, "__key", "left_semi").dropDuplicates(["__key"]).select(*[F.col(f"`{c}`") for c in names])
