"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawfold.session import scratch_path, shared_dir, shuffles_released

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: words of the two contracts, as regular expressions (SQL side) and byte tables (Python side)
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space
_ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is that on pure ASCII text and much cheaper than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8 (``bytes.split`` cuts at
    exactly these six characters)."""
    return text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_ALNUM).split() if text else []


def crc_mod(doc_id: int | None, mod: int) -> int:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def crc_mod_col(name: str, mod: int) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).cast("binary")) % mod


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered; forgets everything when ``limit`` words are held, so a
    worker's memory is bounded whatever the vocabulary."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            self[word] = h
        return h


_KEPT: dict = {}


def kept(key, make: Callable):
    """What this worker process keeps under ``key`` for its next tasks, made if it is not there; until ``forget``."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Drop what this worker has kept for the tasks of an earlier step, and give the memory back to the system: workers are used again, and
    would hold it through all later steps. To be called by tasks; a task's own function names copies of a module's
    variables, so it can't clear them itself."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of an Arrow batch sent to a Python worker: whole texts can be long, so a batch holds few."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts the lineage and is
    whole again after an executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_released(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Remove materialized tables that no later plan reads."""
    for df in tables:
        if df is not None:
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, for small tables."""
    shared_dir(df.sparkSession)
    with shuffles_released(df.sparkSession):
        return df.checkpoint(eager=True)


_PACK_BYTES = 32 << 20


def dealt(rows: DataFrame, parts: int, by: str, schema: pa.Schema, prepare: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """``rows`` in ``parts`` by a hash of the column ``by``, a task for each part: packs (``size``, ``pack``) for ``unpacked``. A task's
    rows of one part are compressed together before they are shuffled; ``schema`` names the columns sent and their types.
    ``prepare`` changes rows before that."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.nbytes for x in held) >= _PACK_BYTES:
                yield _packs(held, parts, schema, prepare)
                held = []
        if held:
            yield _packs(held, parts, schema, prepare)

    bounded_batches(rows.sparkSession)
    part = F.pmod(F.hash(by), F.lit(parts)).alias("__part")
    packs = rows.select(part, *schema.names).mapInArrow(pack, "part int, size long, pack binary")
    return packs.repartitionById(parts, "part").select("size", "pack")


def _packs(batches: list[pa.RecordBatch], parts: int, schema: pa.Schema, prepare: Callable | None) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches)
    if prepare:
        t = prepare(t)
    part = t.column("__part").to_numpy()
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    whole = t.select(schema.names).cast(schema).take(pa.array(order)).combine_chunks()
    out: tuple[list, list, list] = ([], [], [])
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        raw = whole.slice(int(cuts[p]), int(cuts[p + 1] - cuts[p])).to_batches()[0].serialize()
        for column, x in zip(out, (p, raw.size, pa.compress(raw, codec="zstd", asbytes=True))):
            column.append(x)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                                      ["part", "size", "pack"])


def unpacked(batches: Iterator[pa.RecordBatch], schema: pa.Schema, order: tuple[str, ...]) -> pa.Table:
    """The rows of a part (see ``dealt``), sorted."""
    rows = [pa.ipc.read_record_batch(pa.decompress(z, decompressed_size=n, codec="zstd"), schema)
            for b in batches for n, z in zip(b.column("size").to_pylist(), b.column("pack").to_pylist())]
    return pa.Table.from_batches(rows, schema).sort_by([(c, "ascending") for c in order])
