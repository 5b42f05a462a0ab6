"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, memory-mapped by workers.

Tokens are words (lower-cased A-Z) by a 64-bit hash, then one end token a document. The model of order n:

* order 1: the sorted array of token hashes in shards by hash range, with counts; a token's id is its rank;
* order k > 1: a gram's key is ``id of its first k-1 tokens * M + id of its last token`` (no two grams share one);
  sorted arrays of keys with counts, in shards by a hash of the key; a gram's id is its rank;
* counts and sums have 32 bits, or 64 in the files and packs whose greatest needs them;
* per context: the sum of its adjusted counts and its back-off weight, in one array by the context's id.

Counting: a task sums equal keys of a few million tokens, packs them by shard (sorted, differences, compressed) and
Spark shuffles the packs; a task per shard merges its packs and writes the shard. A frequent gram thus ships one entry
per pack, and shards are even whatever the text. The number of shards goes by the bytes of the corpus, so a shard's size
does not grow. Adjusted counts (distinct left neighbours) and context sums are made from the shards in the same way.

The files lie in the shared folder, which must be mounted on the executors, since they are memory-mapped. A file is
written under a name of its own attempt and renamed, or written at its fixed place with fixed content: a task that runs twice does no harm.

Discounts follow Chen and Goodman from the counts of counts, per order; the lowest order is interpolated with
1 / (V + 1), V tokens and one unknown.

Defined results: null and empty texts have one token, the end; unknown words count as one unknown token each;
without any training row every token has probability 1 / (V + 1) = 1; repeated rows count as often as they are there; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm.common import ASCII_LOWER, WordHashes, bounded_batches, shuffles_released
from rawfold.session import scratch_path

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_END = b"\n end of text \n"  # no word holds white space
_FLUSH = 4_000_000
_CHARS = 2_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _shard_of(order: int, keys: np.ndarray, shards: int) -> np.ndarray:
    """Order 1: by hash range, so that shards in a row are sorted; else by a hash of the key."""
    h = keys if order == 1 else _mix(keys)
    return (((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _by_shard(shard: np.ndarray) -> np.ndarray:
    """Places in the order of their shards, equal ones as they are; 16 bits are sorted without comparing."""
    return np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")


def _chunks(texts: list) -> Iterator[list]:
    """Texts in a row, some 2 million characters at a time: keys are looked up together, so each once, in order."""
    own, size = [], 0
    for t in texts:
        own.append(t)
        size += len(t) if t else 1
        if size >= _CHARS:
            yield own
            own, size = [], 0
    if own:
        yield own


# --- packs ----------------------------------------------------------------------------------------------

def _squeeze(a: np.ndarray) -> bytes:
    """Integers by byte planes, zstd: small numbers cost little."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueeze(b: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = pa.decompress(b, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).ravel()


def fitting(values: np.ndarray):
    """The type that holds all values: 32 bits, or 64 where the greatest needs them."""
    return np.uint64 if len(values) and values.max() > 0xFFFFFFFF else np.uint32


def pack(keys: np.ndarray, values: np.ndarray) -> dict:
    """Sorted distinct keys and their values (one row each, of 4 or 8 bytes a value)."""
    dtype = fitting(values)
    return {"n": len(keys), "item": np.dtype(dtype).itemsize, "keys": _squeeze(np.diff(keys, prepend=np.uint64(0))),
            "vals": _squeeze(np.ascontiguousarray(values.astype(dtype)).reshape(len(keys), -1))}


def unpack(n: int, item: int, keys: bytes, vals: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.cumsum(_unsqueeze(keys, n, np.uint64), dtype=np.uint64)
    raw = pa.decompress(vals, decompressed_size=item * width * n, codec="zstd", asbytes=True)
    v = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(item * width, n).T).view(f"u{item}").reshape(n, width)
    return k, v


def _sum_equal(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    if not len(first):
        return keys, values
    return keys[first], np.add.reduceat(values[order].astype(np.uint64), first, axis=0)


_PACK = "shard int, n long, item int, keys binary, vals binary"


def _pack_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("item", pa.int32()),
                                                       ("keys", pa.binary()), ("vals", pa.binary())]))


def _emit(keys: np.ndarray, values: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One pack a shard; keys sorted."""
    by = _by_shard(shard)
    cuts = np.searchsorted(shard[by], np.arange(int(shard.max()) + 2)) if len(shard) else [0]
    for s in range(len(cuts) - 1):
        own = by[cuts[s]:cuts[s + 1]]
        if len(own):
            yield _pack_batch([{"shard": s, **pack(keys[own], values[own])}])


# --- the stored model -----------------------------------------------------------------------------------

class Order(NamedTuple):
    """What is known of one order: shard sizes, discounts for counts of 1, 2 and 3 or more."""
    sizes: tuple[int, ...]
    counts: tuple[int, int, int, int] = (0, 0, 0, 0)  # grams of adjusted count 1, 2, 3, 4
    total: int = 0                                    # sum of (adjusted) counts

    @property
    def size(self) -> int:
        return sum(self.sizes)

    def discounts(self) -> np.ndarray:
        n1, n2, n3, n4 = self.counts
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
        d = [min(max(x, 0.0), k + 1.0) for k, x in enumerate(d)]
        if not n2:
            d[1] = d[0]
        if not n3:
            d[2] = d[1]
        return np.array([0.0, *d])


class Store:
    """The files of a model, memory-mapped on first use."""

    def __init__(self, path: str, orders: dict[int, Order], order: int):
        self.path, self.orders, self.order, self._maps = path, orders, order, {}

    def __reduce__(self):
        return Store, (self.path, self.orders, self.order)

    def _map(self, name: str, dtype) -> np.ndarray:
        if name not in self._maps:
            file = f"{self.path}/{name}"
            self._maps[name] = np.asarray(np.memmap(file, dtype, "r")) if os.path.getsize(file) else np.empty(0, dtype)
        return self._maps[name]

    @property
    def base(self) -> int:
        """M of the keys: token ids and the begin."""
        return self.orders[1].size + 1

    @property
    def neighbours(self):
        """Type of a number of distinct left neighbours: at most all token ids and the begin."""
        return np.uint32 if self.base <= 0xFFFFFFFF else np.uint64

    def special(self, k: int) -> int:
        """Id of the context of k begins."""
        return self.orders[k].size

    def keys(self, k: int, shard: int) -> np.ndarray:
        return self._map(f"o{k}-{shard:05d}.keys", np.uint64)

    def shard_counts(self, k: int, shard: int) -> np.ndarray:
        """32 bits a count, or 64 in a shard whose greatest needs them; its size tells."""
        name, size = f"o{k}-{shard:05d}.counts", self.orders[k].sizes[shard]
        wide = name not in self._maps and size and os.path.getsize(f"{self.path}/{name}") == 8 * size
        return self._map(name, np.uint64 if wide else np.uint32)

    def find(self, k: int, keys: np.ndarray, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(ids or -1, raw counts or 0); all 0 if not ``counted``."""
        sizes = self.orders[k].sizes
        uniq, inv = np.unique(keys, return_inverse=True)
        ids, counts = np.full(len(uniq), -1, np.int64), np.zeros(len(uniq), np.uint64)
        shard = _shard_of(k, uniq, len(sizes))
        by = _by_shard(shard)
        cuts = np.searchsorted(shard[by], np.arange(len(sizes) + 1))
        first = np.concatenate(([0], np.cumsum(sizes)))
        for s in range(len(sizes)):
            own = by[cuts[s]:cuts[s + 1]]
            if len(own) and sizes[s]:
                stored = self.keys(k, s)
                at = np.minimum(np.searchsorted(stored, uniq[own]), sizes[s] - 1)
                hit = stored[at] == uniq[own]
                ids[own[hit]] = first[s] + at[hit]
                if counted:
                    counts[own[hit]] = self.shard_counts(k, s)[at[hit]]
        return ids[inv], counts[inv] if counted else np.zeros(len(inv), np.uint64)

    def key_of(self, k: int, ids: np.ndarray) -> np.ndarray:
        first = np.concatenate(([0], np.cumsum(self.orders[k].sizes)))
        shard = np.searchsorted(first, ids, "right") - 1
        out = np.empty(len(ids), np.uint64)
        for s in np.unique(shard):
            own = shard == s
            out[own] = self.keys(k, int(s))[ids[own] - first[s]]
        return out

    def suffix(self, k: int, ids: np.ndarray) -> np.ndarray:
        """Id of the last k-1 tokens of grams of order k (0: the empty one)."""
        if k == 1:
            return np.zeros(len(ids), np.int64)
        out = np.full(len(ids), self.special(k - 1), np.int64)
        real = ids < self.special(k)
        key = self.key_of(k, ids[real])
        head, last = (key // np.uint64(self.base)).astype(np.int64), key % np.uint64(self.base)
        out[real] = self.extend(k - 1, self.suffix(k - 1, head), last)
        return out

    def extend(self, k: int, head: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Ids of the grams of order k made of a context (order k-1) and a token."""
        if k == 1:
            return last.astype(np.int64)
        return self.find(k, head.astype(np.uint64) * np.uint64(self.base) + last.astype(np.uint64), counted=False)[0]

    def continuations(self, k: int) -> np.ndarray:
        return self._map(f"cont{k}.bin", self.neighbours)

    def contexts(self, k: int) -> np.ndarray:
        """[contexts of order k-1 and the begin, (sum, back-off weight)]."""
        return self._map(f"ctx{k}.bin", np.float32).reshape(-1, 2)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_PREFIX = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # the first i bytes of eight
_LONG = 64


def _prints(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit numbers by which words of a text are told apart: of their length and bytes, eight at a time for all words; of a long word by
    xxhash. Eight bytes or more follow the last word."""
    lanes = np.empty(len(text) // 8 * 8, np.uint64)
    for i in range(8):
        own = lanes[i::8]
        own[:(len(text) - i) // 8] = np.frombuffer(text, "<u8", (len(text) - i) // 8, i)
    sizes = ends - starts
    h = sizes.astype(np.uint64) * _ODD
    own = np.flatnonzero(sizes <= _LONG)
    at, left = starts[own], sizes[own]
    while len(own):
        h[own] = _mix(h[own] ^ (lanes[at] & _PREFIX[np.minimum(left, 8)])) + _ODD
        more = np.flatnonzero(left > 8)
        own, at, left = own[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(text[starts[i]:ends[i]], 1)
    return h


class Words:
    """The place of each word that is remembered, by its ``_prints``. ``facts`` are arrays by place, made by ``of`` from the hashes of the
    words that are new, so that a word is looked up in a store once while it is remembered. Once ``limit`` words are held all are
    forgotten before the next chunk (``tidy``), so a worker's memory is bounded whatever the vocabulary."""

    def __init__(self, of: Callable[[np.ndarray], tuple[np.ndarray, ...]], limit: int = 400_000):
        self.of, self.limit = of, limit
        self.clear()

    def __len__(self) -> int:
        return len(self.places)

    def clear(self) -> None:
        self.prints, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)  # sorted by the first
        self.new, self.known = [], None

    def places_of(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        prints = _prints(text, starts, ends)
        by = np.argsort(prints)
        prints = prints[by]
        first = np.concatenate(([True], prints[1:] != prints[:-1]))
        uniq, one = prints[first], by[first]
        at = np.searchsorted(self.prints, uniq)
        new = np.ones(len(uniq), bool)
        inside = at < len(self.prints)
        new[inside] = self.prints[at[inside]] != uniq[inside]
        places = np.empty(len(uniq), np.int64)
        places[~new] = self.places[at[~new]]
        places[new] = len(self) + np.arange(np.count_nonzero(new))
        self.new += [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())]
        self.prints, self.places = np.insert(self.prints, at[new], uniq[new]), np.insert(self.places, at[new], places[new])
        out = np.empty(len(by), np.int64)
        out[by] = places[np.cumsum(first) - 1]
        return out

    def facts(self) -> tuple[np.ndarray, ...]:
        if self.new:
            new, self.new = self.of(np.array(self.new, np.uint64)), []
            self.known = tuple(np.concatenate(x) for x in zip(self.known, new)) if self.known else tuple(new)
        return self.known

    def tidy(self) -> None:
        if len(self) >= self.limit:
            self.clear()


def _read_tokens(texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(places of the tokens of all texts in a row, number of each text's tokens). The words are those of ``space_words``, cut for all
    texts at once."""
    words.tidy()
    if not len(texts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    size = sum(map(len, raw)) + len(raw)
    # the end token holds white space, so it stands behind the texts and its place is known
    text = b"\n".join((b"", *raw, b"")).translate(ASCII_LOWER) + _END + bytes(16)
    own = np.frombuffer(text, np.uint8, size + 1)
    inside = (own != 32) & (own - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # starts and ends in turn: the first and last byte are white space
    starts, ends = edges[::2], edges[1::2]
    places = words.places_of(text, np.append(starts, size + 1), np.append(ends, size + 1 + len(_END)))
    limits = np.cumsum([len(r) + 1 for r in raw])
    sizes = np.diff(np.searchsorted(starts, limits), prepend=0) + 1
    out, last = np.full(len(starts) + len(raw), places[-1]), np.cumsum(sizes) - 1
    word = np.ones(len(out), bool)
    word[last] = False
    out[word] = places[:-1]
    return out, sizes


def _gram_ids(store: Store, upto: int, word: np.ndarray, sizes: np.ndarray, counted: tuple[int, ...] = ()) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per order k from 2: (k, context id before each token, gram id at it, its raw count); -1 where unknown. ``word`` are the
    tokens' ids. Counts of the orders in ``counted`` only."""
    starts = np.cumsum(sizes) - sizes
    ids = word
    for k in range(2, upto + 1):
        context = np.concatenate(([0], ids[:-1]))
        context[starts] = store.special(k - 1)
        known = (context >= 0) & (word >= 0)
        ids, counts = np.full(len(word), -1, np.int64), np.zeros(len(word), np.uint64)
        if k in store.orders:
            ids[known], counts[known] = store.find(
                k, context[known].astype(np.uint64) * np.uint64(store.base) + word[known].astype(np.uint64), k in counted)
        yield k, context, ids, counts


# --- building -------------------------------------------------------------------------------------------

def _write(file: str, a: np.ndarray) -> None:
    own = f"{file}.{uuid.uuid4().hex}"
    a.tofile(own)
    os.replace(own, file)


def _write_counts(file: str, n: np.ndarray) -> None:
    _write(file, n.astype(fitting(n)))


def _count(docs: DataFrame, store: Store, k: int, shards: int) -> Order:
    """Count the grams of order k of all rows of ``docs`` (text) and write their shards."""
    path = store.path

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words((lambda h: (h,)) if k == 1 else (lambda h: store.find(1, h, counted=False))), [], 0
        for b in batches:
            texts = b.column("text").to_pylist()
            for some in _chunks(texts):
                places, sizes = _read_tokens(some, words)
                word = words.facts()[0][places]
                if k == 1:
                    keys = word
                else:
                    ids = word
                    for _, _, ids, _ in _gram_ids(store, k - 1, word, sizes):
                        pass
                    context = np.concatenate(([0], ids[:-1]))
                    context[np.cumsum(sizes) - sizes] = store.special(k - 1)
                    keys = context.astype(np.uint64) * np.uint64(store.base) + word.astype(np.uint64)
                held.append(keys)
                size += len(keys)
                if size >= _FLUSH:
                    uniq, n = np.unique(np.concatenate(held), return_counts=True)
                    yield from _emit(uniq, n, _shard_of(k, uniq, shards))
                    held, size = [], 0
        if size:
            uniq, n = np.unique(np.concatenate(held), return_counts=True)
            yield from _emit(uniq, n, _shard_of(k, uniq, shards))

    def merge(table: pa.Table) -> pa.Table:
        packs = [unpack(r["n"], r["item"], r["keys"], r["vals"], 1) for r in table.to_pylist()]
        keys, n = _sum_equal(np.concatenate([p[0] for p in packs]), np.concatenate([p[1] for p in packs])[:, 0])
        shard = table.column("shard")[0].as_py()
        _write(f"{path}/o{k}-{shard:05d}.keys", keys)
        _write_counts(f"{path}/o{k}-{shard:05d}.counts", n)
        return pa.Table.from_pylist([{"shard": shard, "size": len(keys), "total": int(n.sum()),
                                      **{f"n{i}": int((n == i).sum()) for i in (1, 2, 3, 4)}}], _SIZES_ARROW)

    with shuffles_released(docs.sparkSession):
        done = (docs.mapInArrow(grams, _PACK).repartition(shards, "shard").groupBy("shard")
                .applyInArrow(merge, _SIZES).collect())  # one row a shard
    by = {r["shard"]: r for r in done}
    for s in range(shards):
        if s not in by:
            _write(f"{path}/o{k}-{s:05d}.keys", np.empty(0, np.uint64))
            _write(f"{path}/o{k}-{s:05d}.counts", np.empty(0, np.uint32))
    return Order(tuple(by[s]["size"] if s in by else 0 for s in range(shards)),
                 tuple(sum(r[f"n{i}"] for r in done) for i in (1, 2, 3, 4)), sum(r["total"] for r in done))


_SIZES = "shard int, size long, total long, n1 long, n2 long, n3 long, n4 long"
_SIZES_ARROW = pa.schema([("shard", pa.int32())] + [(c, pa.int64()) for c in ("size", "total", "n1", "n2", "n3", "n4")])


def _spread(spark, store: Store, k: int, of_shard, width: int, size: int, ranges: int, file: str, dtype, columns: int,
            finish) -> list:
    """Sum packs made of each shard of order k into one array by id: ``of_shard(store, shard)`` gives (ids, values),
    ``finish(sums)`` the array's rows. A task per range of ids writes its place in the file."""
    path, step = store.path, -(-size // ranges)
    with open(f"{path}/{file}", "wb") as f:
        f.truncate(size * columns * np.dtype(dtype).itemsize)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column("id").to_pylist():
                if store.orders[k].sizes[shard]:
                    ids, values = _sum_equal(*of_shard(store, shard))
                    yield from _emit(ids.astype(np.uint64), values.reshape(len(ids), -1), (ids // step).astype(np.int64))

    def add(table: pa.Table) -> pa.Table:
        part = table.column("shard")[0].as_py()
        lo, hi = part * step, min(size, (part + 1) * step)
        sums = np.zeros((hi - lo, width), np.uint64)
        for r in table.to_pylist():
            ids, values = unpack(r["n"], r["item"], r["keys"], r["vals"], width)
            sums[(ids - np.uint64(lo)).astype(np.int64)] += values
        place = np.ascontiguousarray(finish(sums).astype(dtype))
        with open(f"{path}/{file}", "r+b") as f:
            f.seek(lo * columns * np.dtype(dtype).itemsize)
            f.write(place.tobytes())
        n = sums[:, 0]
        return pa.Table.from_pylist([{"shard": part, "size": len(n), "total": int(n.sum()),
                                      **{f"n{i}": int((n == i).sum()) for i in (1, 2, 3, 4)}}], _SIZES_ARROW)

    shards = len(store.orders[k].sizes)
    with shuffles_released(spark):
        return (spark.range(0, shards, 1, shards).mapInArrow(send, _PACK).repartition(ranges, "shard").groupBy("shard")
                .applyInArrow(add, _SIZES).collect())  # one row a range


def _adjusted(store: Store, k: int, shard: int) -> np.ndarray:
    if k == store.order:
        return np.asarray(store.shard_counts(k, shard))
    first = sum(store.orders[k].sizes[:shard])
    return np.asarray(store.continuations(k)[first:first + store.orders[k].sizes[shard]])


def _left_neighbours(k: int):
    """Of each gram of order k: one more left neighbour for its last k-1 tokens."""
    def of_shard(store: Store, shard: int) -> tuple[np.ndarray, np.ndarray]:
        key = np.asarray(store.keys(k, shard))
        head, last = (key // np.uint64(store.base)).astype(np.int64), key % np.uint64(store.base)
        ids = store.extend(k - 1, store.suffix(k - 1, head), last)
        return ids, np.ones((len(ids), 1), np.uint32)
    return of_shard


def _context_sums(k: int):
    """Of each gram of order k for its context: adjusted count, and whether that is 1, 2 or more."""
    def of_shard(store: Store, shard: int) -> tuple[np.ndarray, np.ndarray]:
        c = _adjusted(store, k, shard)
        head = (np.asarray(store.keys(k, shard)) // np.uint64(store.base)).astype(np.int64)
        return head, np.stack([c, c == 1, c == 2, c >= 3], axis=1).astype(c.dtype)
    return of_shard


def _weights(d: np.ndarray):
    def finish(sums: np.ndarray) -> np.ndarray:
        total = sums[:, 0].astype(np.float64)
        weight = (sums[:, 1] * d[1] + sums[:, 2] * d[2] + sums[:, 3] * d[3]) / np.maximum(total, 1)
        return np.stack([total, weight], axis=1)
    return finish


def build(docs: DataFrame, learn: Column, *, text_col: str = "text", order: int = 2, shard_bytes: int = 24 << 20,
          path: str | None = None) -> Store:
    """Count the rows for which ``learn`` holds and write the model into the shared folder."""
    if order < 2:
        raise ValueError("order is 2 or more")
    spark = docs.sparkSession
    bounded_batches(spark)
    uri = path or scratch_path(spark, "ngrams")
    if "://" in uri and not uri.startswith("file://"):
        raise ValueError(f"the n-gram files are memory-mapped: {uri} must be a folder mounted on all executors")
    folder = uri.removeprefix("file://").removeprefix("file:") if uri.startswith("file:") else uri
    os.makedirs(folder, exist_ok=True)
    train = docs.filter(learn).select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    orders: dict[int, Order] = {}
    orders[1] = _count(train, Store(folder, {}, order), 1, max(1, -(-shards // 4)))
    for k in range(2, order + 1):
        orders[k] = _count(train, Store(folder, dict(orders), order), k, shards)
    for k in range(order, 1, -1):
        store = Store(folder, dict(orders), order)
        ranges = len(orders[k - 1].sizes)
        _spread(spark, store, k, _context_sums(k), 4, orders[k - 1].size + 1, ranges + 1, f"ctx{k}.bin", np.float32, 2,
                _weights(orders[k].discounts()))
        lower = _spread(spark, store, k, _left_neighbours(k), 1, max(1, orders[k - 1].size), ranges, f"cont{k - 1}.bin",
                        store.neighbours, 1, lambda sums: sums)
        if k > 2:
            orders[k - 1] = orders[k - 1]._replace(counts=tuple(sum(r[f"n{i}"] for r in lower) for i in (1, 2, 3, 4)))
        else:
            # the tokens' own counts stay in ``total``; the lowest order's adjusted ones are their left neighbours
            orders[0] = Order((sum(r["size"] for r in lower),), tuple(sum(r[f"n{i}"] for r in lower) for i in (1, 2, 3, 4)),
                              sum(r["total"] for r in lower))
    return Store(folder, orders, order)


# --- scoring --------------------------------------------------------------------------------------------

def _word_scores(store: Store):
    """Of the hashes of tokens: ids (-1 where unknown), base score, probability by the lowest order."""
    v, n, low = store.orders[1].size, store.orders[1].total, store.orders[0]

    def of(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        ids, raw = store.find(1, hashes)
        known, p = ids >= 0, np.full(len(ids), 1.0 / (v + 1))
        if low.total:
            d = low.discounts()
            c = np.zeros(len(ids))
            c[known] = store.continuations(1)[ids[known]]
            weight = (d[1] * low.counts[0] + d[2] * low.counts[1] + d[3] * (v - low.counts[0] - low.counts[1])) / low.total
            p = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0) / low.total + weight * p
        return ids, np.log10((raw + 0.5) / (n + 0.5 * (v + 1))), p
    return of


def score_texts(store: Store, texts: list[str | None], words: Words | WordHashes) -> list[np.ndarray]:
    """Per text: number of tokens, of known tokens, base score, model score (log10)."""
    if not isinstance(words, Words):
        words = Words(_word_scores(store))
    places, sizes = _read_tokens(texts, words)
    if not len(sizes):
        return [np.empty(0)] * 4
    starts = np.cumsum(sizes) - sizes
    ids, base, p = (x[places] for x in words.facts())
    known = ids >= 0
    for k, context, ids, counts in _gram_ids(store, store.order, ids, sizes, (store.order,)):
        d = store.orders[k].discounts()
        seen = np.flatnonzero(context >= 0)
        total, weight = (x.astype(np.float64) for x in store.contexts(k)[context[seen]].T)
        c = counts[seen].astype(np.float64)
        if k < store.order:
            c = np.zeros(len(seen))
            has = ids[seen] >= 0
            c[has] = store.continuations(k)[ids[seen][has]]
        better = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0) / np.maximum(total, 1) + weight * p[seen]
        p[seen] = np.where(total > 0, better, p[seen])
    return [sizes, np.add.reduceat(known.astype(np.int64), starts), np.add.reduceat(base, starts),
            np.add.reduceat(np.log10(p), starts)]


def score(docs: DataFrame, store: Store, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and n_tokens, n_known, base_score, score, perplexity of every whole text."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(_word_scores(store))
        for b in batches:
            texts, parts = b.column("text").to_pylist(), []
            for some in _chunks(texts):
                parts.append(score_texts(store, some, words))
            n, known, base, own = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0) for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(own, pa.float64())], ["row", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(run, schema).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "n_tokens", "n_known", "base_score", "score", "perplexity")
