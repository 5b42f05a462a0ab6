"""Token ids in directly addressable codes: any token is read without decoding a block.

Documents are range-partitioned and sorted by id; every partition becomes one shard file. In a shard the ids are
split into 8-bit chunks by level: level 0 holds the low chunk of every id, level 1 the next chunk of those ids that
have one, and so on. A bitmap per level tells which ids continue, and a rank directory (ones before each
block of 512 bits) turns a position on one level into that on the next. So ``token(i)`` reads one byte,
one bit and one rank per level.

Shard file (little-endian): magic, counts, then the offsets of each array; document ids (as 64-bit integers, nulls
by a bitmap), document starts, and per level chunks, bitmap and ranks. A shard is written under a name of its
own attempt and then renamed, so a task that runs twice or dies leaves one whole file; its content depends only
on the partition's rows.

Ids of a text are those the tokenizer gives for the whole text. Byte-level BPE never merges across a
single space between two other characters (the space begins the next piece), so a text is cut there, each
distinct piece is encoded once by the library and its ids are remembered (bounded); ``tests/llm`` compares with
whole texts encoded directly.

Defined results: null counts as empty (one id, the end id); null document ids come first; rows that repeat an
id follow each other in order of their text; an empty table gives no shard and an empty result; other columns are
ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawfold.llm.common import bounded_batches, forget, kept
from rawfold.session import scratch_path

MAGIC = b"DACTOK01"
_BLOCK = 512
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


# --- the code -------------------------------------------------------------------------------------

def dac_encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, continuation bitmap, ones before each block of 512 bits)."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunk, rest = (rest & np.uint32(255)).astype(np.uint8), rest >> np.uint32(8)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
        ones = _POP[bits].reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint64)
        levels.append((chunk, bits, np.concatenate(([0], np.cumsum(ones)))[:-1].astype(np.uint64)))
        if not more.any():
            return levels
        rest = rest[more]


class DacReader:
    """Random access over the arrays of a shard (a memory map or bytes)."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, np.uint64, 5, 8)
        if bytes(buffer[:8]) != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n_tokens, n_levels = (int(x) for x in head[:3])
        table = np.frombuffer(buffer, np.uint64, 2 * (3 + 3 * n_levels), 32).reshape(-1, 2)
        part = [np.frombuffer(buffer, dt, int(n), int(o)) for (o, n), dt in
                zip(table, [np.int64, np.uint8, np.uint64] + [np.uint8, np.uint8, np.uint64] * n_levels)]
        self.doc_ids, self.null_ids, self.starts = part[:3]
        self.levels = [tuple(part[3 + 3 * i:6 + 3 * i]) for i in range(n_levels)]

    def token(self, i: int) -> int:
        """Id at position i: one chunk, one bit and one rank a level."""
        value = 0
        for depth, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * depth)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // _BLOCK
            before = bits[block * (_BLOCK // 8):i >> 3]
            i = int(ranks[block]) + int(_POP[before].sum()) + int(_POP[bits[i >> 3] & ((1 << (i & 7)) - 1)])
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids of a range: the rank of its first id on each level, then slices."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        a, b = start, stop
        for depth, (chunks, bits, ranks) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * depth)
            more = np.unpackbits(bits[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:(a & 7) + b - a].astype(bool)
            block = a // _BLOCK
            rank = int(ranks[block]) + int(_POP[bits[block * (_BLOCK // 8):a >> 3]].sum()) + int(
                _POP[bits[a >> 3] & ((1 << (a & 7)) - 1)]) if a // 8 < len(bits) else 0
            where = where[more]
            a, b = rank, rank + len(where)
        return out


def shard_bytes(doc_ids: list, counts: list[int], ids: np.ndarray) -> Iterator[bytes]:
    """The shard file of these documents, in pieces."""
    nulls = np.packbits([d is None for d in doc_ids], bitorder="little")
    arrays = [np.array([0 if d is None else d for d in doc_ids], np.int64), nulls,
              np.concatenate(([0], np.cumsum(counts))).astype(np.uint64)]
    levels = dac_encode(ids)
    for level in levels:
        arrays.extend(level)
    at = 32 + 16 * len(arrays)
    table, raw = [], []
    for a in arrays:
        at += -at % 8
        table += [at, len(a)]
        raw.append((at, a))
        at += a.nbytes
    yield MAGIC + np.array([len(doc_ids), len(ids), len(levels)], np.uint64).tobytes()
    yield np.array(table, np.uint64).tobytes()
    at = 32 + 16 * len(arrays)
    for place, a in raw:
        yield b"\0" * (place - at) + a.tobytes()
        at = place + a.nbytes


# --- encoding texts ---------------------------------------------------------------------------------

class PieceEncoder:
    """Ids of whole texts by remembered pieces. Two generations of the memory bound it: a full one becomes the
    old one, so frequent pieces stay; long pieces are not remembered."""

    #: a space between two characters that are no white space (Python's, which holds all of the tokenizer's)
    CUT = re.compile(r"(?<=\S) (?=\S)")
    #: texts without these, and with no white space at their ends, can be cut at every space
    DOUBLE = ("  ", " \n", "\n ", "\t")
    RARE = re.compile("[\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    LONGEST = 48
    #: words of Latin letters with punctuation after them, over one line break: the parts never merge, so a piece met
    #: for the first time is put together from parts that are known already
    PARTS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?#$%&*|]*)"
                       "(?:(\n)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?#$%&*|]*))?")

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content for t in added.values()}
        vocab = self.tokenizer.get_vocab()
        #: bytes of each token: byte-level tokens are written with one character a byte
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token)
        self.limit, self.now, self.old = limit, {}, {}
        #: ids are remembered in two bytes where they fit
        self.dtype = np.dtype(np.uint16 if len(self.sizes) <= 1 << 16 else np.uint32)
        self.line = self._ids("\n").tobytes()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def pieces(self, text: str) -> tuple[str, list[str]]:
        """(the first piece, the others without the space that begins each)."""
        if any(s in text for s in self.special):
            return text, []  # added tokens are looked for before pieces are cut
        rare = any(c in text for c in "\r\x0b\x0c\x1c\x1d\x1e\x1f") if text.isascii() else self.RARE.search(text)
        if rare or text[0].isspace() or text[-1].isspace() or any(d in text for d in self.DOUBLE):
            cuts = [m.start() for m in self.CUT.finditer(text)]
            return text[:cuts[0]] if cuts else text, [text[a + 1:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]
        first, *rest = text.split(" ")
        return first, rest

    def _learn(self, missing: list[str], before: str = " ", key: str = "") -> None:
        """Encode pieces, each with ``before`` (a space or a line break) before it and none ending in white space, as one
        text: they stay apart. With a line break, which is a token of its own, the ids are those of the bare piece."""
        ids = self._ids(before + before.join(missing))
        at = np.cumsum(self.sizes[ids])
        ends = np.cumsum([len(p) + 1 if p.isascii() else len(p.encode("utf-8", "surrogatepass")) + 1 for p in missing])
        cuts = np.searchsorted(at, ends) + 1
        if not len(at) or cuts[-1] != len(ids) or (at[cuts - 1] != ends).any():  # not a byte-level vocabulary
            for p in missing:
                self.now[key + p] = self._ids(before * (not key) + p).tobytes()
            return
        width = self.dtype.itemsize
        packed, lo, skip = ids.tobytes(), 0, width * len(key)
        for p, hi in zip(missing, (width * cuts).tolist()):
            self.now[key + p] = packed[lo + skip:hi]
            lo = hi

    def _known(self, key: str) -> bool:
        if key in self.now:
            return True
        if key in self.old:
            self.now[key] = self.old[key]
            return True
        return False

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces(t) if t else ("", []) for t in texts]
        now, old, odd, made = self.now, self.old, {}, []
        missing, bare = set(), set()  # with a space before them; without (remembered under "\n" + word)
        unknown = set().union(*(rest for _, rest in cut)).difference(now)
        fresh = unknown.difference(old)
        for p in unknown - fresh:
            now[p] = old[p]
        for p in fresh:
            if len(p) > self.LONGEST or p[-1].isspace():
                odd[p] = self._ids(" " + p).tobytes()
            elif p.isalpha():
                missing.add(p)
            elif parts := self.PARTS.fullmatch(p):
                word, marks, line, second, more = parts.groups()
                made.append((p, word, marks, line, second, more))
                if not self._known(word):
                    missing.add(word)
                for x in (marks, second, more):
                    if x and not self._known("\n" + x):
                        bare.add(x)
            else:
                missing.add(p)
        for first, _ in cut:
            if first and len(first) <= self.LONGEST and first.isalpha() and not self._known("\n" + first):
                bare.add(first)
        if missing:
            self._learn(list(missing))
        if bare:
            self._learn(list(bare), "\n", "\n")
        for p, word, marks, line, second, more in made:
            ids = now[word] + now["\n" + marks] if marks else now[word]
            if line:
                ids += self.line + now["\n" + second] + (now["\n" + more] if more else b"")
            now[p] = ids
        out = []
        for first, rest in cut:
            known = list(map(now.__getitem__, rest)) if not odd else [odd[p] if p in odd else now[p] for p in rest]
            if first:
                known.insert(0, now.get("\n" + first) or self._ids(first).tobytes())
            out.append(np.frombuffer(b"".join(known), self.dtype))
        if len(now) > self.limit:
            self.now, self.old = {}, now
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process, kept for its next tasks."""
    return kept(("encoder", path), lambda: PieceEncoder(path))


# --- Spark ------------------------------------------------------------------------------------------

def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, shards: int | None = None) -> list[dict]:
    """Write the shards; returns the manifest, one row per shard: file, docs, tokens (in order)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    fs, root = _filesystem(out)
    fs.create_dir(root, recursive=True)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows that repeat an id share a range partition by the id alone, so the text need not be a key of the ranges
    ranged = (rows.repartitionByRange(n, order[0]).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, doc_ids, counts, ids, part = encoder(tokenizer_path), [], [], [], None
        end = np.array([end_id], np.uint32).astype(pieces.dtype if end_id < 1 << 16 else np.uint32)
        for b in batches:
            part = b.column("part")[0].as_py() if len(b) and part is None else part
            doc_ids += b.column("doc_id").to_pylist()
            for e in pieces.encode_all(b.column("text").to_pylist()):
                counts.append(len(e) + 1)
                ids += [e, end]
            ids = [np.concatenate(ids)] if ids else []
        if doc_ids:
            fs, root = _filesystem(out)
            name = f"shard-{part:06d}.dac"
            attempt = f"{root}/.{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(attempt) as f:
                for piece in shard_bytes(doc_ids, counts, ids[0]):
                    f.write(piece)
            fs.move(attempt, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [len(doc_ids)],
                                              "tokens": [sum(counts)]},
                                             schema=pa.schema([("part", pa.int32()), ("file", pa.string()),
                                                               ("docs", pa.int64()), ("tokens", pa.int64())]))

    # one row per shard comes back: as many as partitions
    done = ranged.mapInArrow(run, "part int, file string, docs long, tokens long")
    return [r.asDict() for r in sorted(done.collect(), key=lambda r: r["part"])]


def open_shard(uri: str) -> DacReader:
    """A shard, memory-mapped where the folder is mounted, else read through its file system."""
    fs, path = _filesystem(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return DacReader(np.memmap(path, np.uint8, "r"))
    with fs.open_input_file(path) as f:
        return DacReader(np.frombuffer(f.read(), np.uint8))


def read_tokens(spark, out: str, manifest: list[dict]) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    start, rows = 0, []
    for m in manifest:
        rows.append((f"{out}/{m['file']}", start))
        start += m["tokens"]
    if not rows:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # this worker may have written before; later stages need its memory
        for b in batches:
            for file, first in zip(b.column("file").to_pylist(), b.column("first").to_pylist()):
                shard = open_shard(file)
                tokens = shard.tokens(0, shard.n_tokens).astype("<u4")
                at = shard.starts.astype(np.int64)
                null = np.unpackbits(shard.null_ids, bitorder="little")[:shard.n_docs].astype(bool)
                crc = [zlib.crc32(tokens[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64(), mask=null), pa.array(at[:-1] + first), pa.array(np.diff(at)),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(rows, "file string, first long").repartition(len(rows))
    return files.mapInArrow(run, schema)


def token_store(docs: DataFrame, tokenizer_path: str, *, out: str | None = None, **options) -> DataFrame:
    """Write the token files (under the shared folder unless ``out`` is given) and read them back."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "tokens")
    return read_tokens(spark, out, write_tokens(docs, tokenizer_path, out, **options))
