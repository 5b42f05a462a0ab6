"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

A word (lower-cased A-Z, letters and digits) is the sum of three rows of a hashed embedding table: two hashes of the word, so
two words are confused only if both meet, and one of its first four bytes, so that forms of a word share something; rows
start at zero, so a word never trained on is neutral. Filters over
one, two and three words, rectified and max-pooled over the whole text, feed a logistic output. Trained by Adagrad: a start from a
bounded sample of labelled rows (``max_docs``, ``max_bytes``, shared evenly by the labels, chosen by a hash), then over all
rows in parts, whose models are averaged.

The language used for calibration is the one ``langid`` reads from the text, so the score depends on the text
alone. On a fifth of all rows, held back, each language gets the threshold that separates its labels best; the score is the
probability with that threshold moved to 0.5.

Defined results: null and empty texts have no words and the score of a text of neutral words; without labels of both
kinds every score is 0; repeated rows get equal scores; an empty table gives an empty result; other columns are
ignored; labels that are null or of no document are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm import langid
from rawfold.llm.common import WordHashes, alnum_words, bounded_batches, checkpointed, dealt, shuffles_released, unpacked

WIDTHS = (1, 2, 3)
_PIECE = 1 << 16  # words convolved at a time


class ToxicModel(NamedTuple):
    emb: np.ndarray        # [3 * buckets + 1, dim]; the last row is the zero of padding
    filters: np.ndarray    # [dim, sum(widths) * per]: width by width, word by word
    bias: np.ndarray       # [len(widths) * per]
    out: np.ndarray
    out_bias: float
    thresholds: dict       # language -> logit
    default: float
    languages: langid.LanguageModel


class Words(WordHashes):
    """word -> 21 bits of each of its two hashes, then 21 bits of the hash of its first four bytes."""

    def __missing__(self, word: bytes) -> int:
        own, start = xxhash.xxh3_64_intdigest(word), xxhash.xxh3_64_intdigest(word[:4], 1)
        if len(self) >= self.limit:
            self.clear()
        h = own & (1 << 42) - 1 | (start & (1 << 21) - 1) << 42
        if len(word) <= 32:
            self[word] = h
        return h


def word_rows(words: list[bytes], hashes: Words, buckets: int) -> np.ndarray:
    """[words, 3] rows of the table; ``buckets`` is a power of 2 of at most 2 ** 21."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    mask = np.uint64(buckets - 1)
    return np.stack([h & mask, ((h >> np.uint64(21)) & mask) + np.uint64(buckets),
                     ((h >> np.uint64(42)) & mask) + np.uint64(2 * buckets)], axis=1).astype(np.int32)


def _convolve(rows: np.ndarray, emb: np.ndarray, filters: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """[positions, widths * per] for windows that begin at each word; the rows end in padding."""
    per = len(bias) // len(WIDTHS)
    z = (emb[rows[:, 0]] + emb[rows[:, 1]] + emb[rows[:, 2]]) @ filters
    n = len(rows) - WIDTHS[-1] + 1
    out, at = np.empty((n, len(bias)), np.float32), 0
    for i, w in enumerate(WIDTHS):
        s = z[:n, at:at + per].copy()
        for j in range(1, w):
            s += z[j:n + j, at + j * per:at + (j + 1) * per]
        out[:, i * per:(i + 1) * per] = s
        at += w * per
    out += bias
    return out


def _padding(rows: np.ndarray, emb: np.ndarray) -> np.ndarray:
    return rows[:, 0] == len(emb) - 1


def pooled(texts: list[np.ndarray], m: ToxicModel) -> np.ndarray:
    """Max-pooled features of whole texts. Texts are convolved in pieces of bounded size; a longer text is several
    pieces that overlap by the widest filter less one."""
    pad = np.full((WIDTHS[-1] - 1, 3), len(m.emb) - 1, np.int32)
    out = np.zeros((len(texts), len(m.bias)), np.float32)
    flat, cuts, owner, size = [], [], [], 0

    def flush() -> None:
        nonlocal flat, cuts, owner, size
        if flat:
            rows = np.concatenate([*flat, pad])
            conv = _convolve(rows, m.emb, m.filters, m.bias)
            conv[_padding(rows[:len(conv)], m.emb)] = 0  # windows that begin in padding reach into the next text
            np.maximum.at(out, owner, np.maximum.reduceat(conv, cuts, axis=0))
        flat, cuts, owner, size = [], [], [], 0

    for i, rows in enumerate(texts):
        for a in range(0, max(1, len(rows)), _PIECE):
            piece = np.concatenate([rows[a:a + _PIECE + len(pad)], pad])
            cuts.append(size)
            owner.append(i)
            flat.append(piece)
            size += len(piece)
            if size >= _PIECE:
                flush()
    flush()
    return out


def logits(texts: list[np.ndarray], m: ToxicModel) -> np.ndarray:
    return pooled(texts, m) @ m.out + m.out_bias


def train(rows: list[tuple[str, int]], languages: langid.LanguageModel, shares: dict[int, float], *, dim: int = 16,
          per: int = 8, buckets: int = 1 << 17, epochs: int = 6, steps: int = 1200, rate: float = 0.05,
          batch: int = 32, seed: int = 5, memory: list | None = None) -> ToxicModel | None:
    """rows: (text, 0 or 1). Every fifth document of each label calibrates; few rows are gone over more often, until
    there are ``steps`` steps. ``memory``: an empty list that gets Adagrad's sums of squares."""
    rows = sorted((y, t) for t, y in rows)
    if len({y for y, _ in rows}) < 2:
        return None
    rng = np.random.default_rng(seed)
    hashes = Words()
    x = [word_rows(alnum_words(t), hashes, buckets) for _, t in rows]
    y = np.array([label for label, _ in rows], np.float32)
    held = np.zeros(len(rows), bool)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        if len(own) >= 10:
            held[own[4::5]] = True

    n = len(WIDTHS) * per
    m = ToxicModel(np.zeros((3 * buckets + 1, dim), np.float32),
                   rng.normal(0, 0.4, (dim, sum(WIDTHS) * per)).astype(np.float32), np.full(n, 0.01, np.float32),
                   rng.normal(0, 0.3, n).astype(np.float32), 0.0, {}, 0.0, languages)
    emb, filters, bias, out = m.emb, m.filters, m.bias, m.out
    # a start in one direction: rows seen in more toxic texts than chance has it, so that the first winning windows of a
    # text are not arbitrary; half of the filters look that way
    way = np.ones(dim, np.float32) / dim ** 0.5
    emb[:] += _lift([x[i] for i in range(len(x)) if not held[i]], y[~held], len(emb))[:, None] * way
    half = np.arange(filters.shape[1]) % per < per // 2
    filters[:, half] = np.abs(filters[:, half])
    out[np.arange(n) % per < per // 2] = 0.3
    sums = [*(np.full(a.shape, 1e-6, np.float32) for a in (emb, filters, bias, out)), 1e-6]
    order = np.flatnonzero(~held)
    m = descend(m, sums, x, y, order, rng, max(epochs, -(-steps * batch // len(order))), rate, batch)
    if memory is not None:
        memory[:] = sums
    check = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    z = logits([x[i] for i in check], m)
    weight = np.array([1 / shares.get(int(label), 1.0) for label in y[check]])
    default = best_threshold(z, y[check], weight)
    langs, _ = langid.predict(languages, [rows[i][1] for i in check])
    thresholds = {}
    for lang in sorted(set(langs)):
        own = np.array([x == lang for x in langs])
        if min((y[check][own] == 0).sum(), (y[check][own] == 1).sum()) >= 5:
            thresholds[lang] = best_threshold(z[own], y[check][own], weight[own])
    return m._replace(thresholds=thresholds, default=default)


def descend(m: ToxicModel, memory: list, x: list[np.ndarray], y: np.ndarray, order: np.ndarray, rng: np.random.Generator,
            epochs: int, rate: float, batch: int) -> ToxicModel:
    """Adagrad over the texts ``x`` named in ``order``; changes the arrays of ``m`` and ``memory`` in place."""
    emb, filters, bias, out, out_bias = m.emb, m.filters, m.bias, m.out, m.out_bias
    per, buckets = len(bias) // len(WIDTHS), (len(emb) - 1) // 3
    pad = np.full((WIDTHS[-1] - 1, 3), 3 * buckets, np.int32)
    firsts = np.cumsum((0, *WIDTHS[:-1])) * per

    def step(param: np.ndarray, mem: np.ndarray, grad: np.ndarray, at=slice(None)) -> None:
        mem[at] += grad * grad
        param[at] -= rate * grad / np.sqrt(mem[at])

    for _ in range(epochs):
        rng.shuffle(order)
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            pieces = [np.concatenate([x[i], pad]) if len(x[i]) else np.concatenate([pad[:1], pad]) for i in pick]
            sizes = np.array([len(p) for p in pieces])
            ends = np.cumsum(sizes)
            flat = np.concatenate([*pieces, pad])
            conv = _convolve(flat, emb, filters, bias)
            conv[_padding(flat[:len(conv)], emb)] = 0
            # the winning window of each text and filter; only it has a gradient
            best = np.stack([conv[e - s:e].argmax(axis=0) + e - s for e, s in zip(ends, sizes)])
            value = np.maximum(np.take_along_axis(conv, best, axis=0), 0)
            p = 1 / (1 + np.exp(-np.clip(value @ out + out_bias, -30, 30)))
            d = ((p - y[pick]) / len(pick)).astype(np.float32)
            g = d[:, None] * out[None, :] * (value > 0)
            g_filters = np.zeros_like(filters)
            words, grads = [], []
            for i, w in enumerate(WIDTHS):
                cols = slice(i * per, (i + 1) * per)
                for j in range(w):
                    at = best[:, cols] + j                                     # [texts, per]
                    f = slice(firsts[i] + j * per, firsts[i] + (j + 1) * per)
                    vec = emb[flat[at]].sum(axis=2)                            # [texts, per, dim]
                    g_filters[:, f] += np.einsum("tpd,tp->dp", vec, g[:, cols])
                    words.append(at.ravel())
                    grads.append((g[:, cols, None] * filters[:, f].T[None]).reshape(-1, emb.shape[1]))
            words, grads = np.concatenate(words), np.concatenate(grads)
            touched = flat[words].T.ravel()
            uniq, inv = np.unique(touched, return_inverse=True)
            g_emb = np.zeros((len(uniq), emb.shape[1]), np.float32)
            np.add.at(g_emb, inv, np.concatenate([grads] * 3))
            real = uniq != 3 * buckets
            step(emb, memory[0], g_emb[real], uniq[real])
            step(filters, memory[1], g_filters)
            step(bias, memory[2], g.sum(axis=0))
            step(out, memory[3], value.T @ d)
            memory[4] += float(d.sum()) ** 2
            out_bias -= rate * float(d.sum()) / memory[4] ** 0.5
    return m._replace(out_bias=float(out_bias))


def _lift(texts: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Per row: smoothed log ratio of its shares of toxic and other texts, 0 where it is not clearly above 0."""
    seen = np.zeros((2, size), np.float32)
    for rows, label in zip(texts, y):
        seen[int(label), np.unique(rows)] += 1
    neg, pos = seen
    ratio = np.log((pos + 0.5) / (max(1, (y == 1).sum()) + 1)) - np.log((neg + 0.5) / (max(1, (y == 0).sum()) + 1))
    return np.where(pos >= 2, 0.15 * np.clip(ratio, 0, 4) * pos / (pos + 3), 0).astype(np.float32)


def best_threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The logit of least weighted error; in the middle of the widest gap that reaches it."""
    order = np.argsort(z, kind="stable")
    z, y, weight = z[order], y[order], weight[order]
    wrong = np.concatenate(([0], np.cumsum(weight * (y == 1)))) + weight[y == 0].sum() - np.concatenate(
        ([0], np.cumsum(weight * (y == 0))))
    edges = np.concatenate(([z[0] - 2], z, [z[-1] + 2]))
    wrong = np.where(np.diff(edges) > 0, wrong, np.inf)  # equal logits are not parted
    gap = np.where(wrong <= wrong.min() + 1e-9, np.diff(edges), -1)
    k = int(gap.argmax())
    return float((edges[k] + edges[k + 1]) / 2)


def predict(m: ToxicModel, texts: list[str | None], hashes: Words) -> np.ndarray:
    buckets = (len(m.emb) - 1) // 3
    z = logits([word_rows(alnum_words(t), hashes, buckets) for t in texts], m)
    langs, _ = langid.predict(m.languages, texts)
    at = np.array([m.thresholds.get(lang, m.default) for lang in langs])
    return 1 / (1 + np.exp(-np.clip(z - at, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, *, label: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", max_docs: int = 6000, max_bytes: int = 24 << 20,
        **options) -> ToxicModel | None:
    """A model from all rows for which ``learn`` holds and that have a label. It starts from a balanced sample (at most ``max_docs`` rows
    and ``max_bytes`` bytes, half of both for each label, by a hash of id and length; no text longer than an eighth of a label's
    bytes). If that is not all, tasks go on over parts of all rows but a fifth, and that fifth sets the thresholds. The same on
    every run."""
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.filter(learn).select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).filter("text is not null")
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).filter("y in (0, 1)")
    # sizes and the choice are made on rows without their texts; the chosen ids, max_docs of them, are then sent to the texts
    slim = own.select("id", F.octet_length("text").cast("long").alias("b")).withColumns(
        {"h": langid.hash63(11, "id", "b"), "side": langid.hash63(13, "id", "b")}).join(marks, "id")
    sizes = slim.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"), F.max("b").alias("most")).collect()  # two rows
    whole = all(r["n"] <= max_docs // 2 and r["b"] <= max_bytes // 2 and r["most"] <= max_bytes // 16 for r in sizes)
    fifth = F.col("side") <= langid.hash_limit(0.2)
    if not whole:  # a fifth of all rows sets the thresholds
        slim = slim.filter(~fifth)
    shares = {r["y"]: min(1.0, max_docs / 2 / r["n"], max_bytes / 2 / max(1, r["b"])) for r in sizes}
    pick = F.lit(False)
    for y, share in shares.items():
        pick = pick | ((F.col("y") == y) & (F.col("h") <= langid.hash_limit(share)))
    few = slim.filter(pick & (F.col("b") <= max_bytes // 16)).distinct()
    chosen = checkpointed(langid.within(few, "y", max_docs // 2, max_bytes // 2))
    met = own.withColumn("b", F.octet_length("text").cast("long")).join(F.broadcast(chosen), ["id", "b"])
    taken = met.groupBy("id", "b", "h", "y").agg(F.min("text").alias("text")).collect()  # of texts alike in id and length, one
    rows = [(r["text"], r["y"]) for r in sorted(taken, key=lambda r: (r["h"], r["y"], r["id"]))]
    languages = langid.fit(docs, learn, label=lang_col, id_col=id_col, text_col=text_col, alpha=0)  # its rejection is not used here
    memory: list = []
    model = train(rows, languages, shares, memory=memory, **options)
    if whole or model is None:
        return model
    marks = marks.withColumnRenamed("id", "label_id")
    if sum(r["n"] for r in sizes) <= _FEW_LABELS and labels.count() <= _FEW_LABELS:  # sent to the texts; more are shuffled with them
        marks = F.broadcast(marks)
    labelled = own.withColumn("b", F.octet_length("text").cast("long")).withColumn("side", langid.hash63(13, "id", "b")).join(
        marks, F.col("id") == F.col("label_id")).select("text", "y", "side")
    parts = max(1, -(-sum(r["n"] for r in sizes) // (4 * max_docs)), -(-sum(r["b"] for r in sizes) // (2 * max_bytes)))
    model = _tuned(labelled.filter(~fifth), model, memory, parts)
    return _calibrated(labelled.filter(fifth), model)


_CHUNK = 1 << 14  # rows of the table averaged together
_FEW_LABELS = 1_000_000
_SENT = pa.schema([("h", pa.int64()), ("text", pa.string()), ("y", pa.int32())])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    """Rows of a part in the order of their hash: the same on every run; copies of a row are neighbours."""
    last, table = None, unpacked(batches, _SENT, ("h", "y"))
    for b in table.to_batches(1000):
        for row in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
            if row != last:
                yield row
            last = row


def _tuned(rows: DataFrame, model: ToxicModel, memory: list, parts: int, rate: float = 0.05, batch: int = 32) -> ToxicModel:
    """``model`` trained on over all ``rows``: each task goes on from it over one part, and what changed is averaged. A row of the
    table is averaged over the parts that changed it."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((model, memory))
    dense = [a.shape for a in (model.filters, model.bias, model.out)]

    def tune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, (start, sums) = TaskContext.get().partitionId(), sent.value
        m = start._replace(emb=start.emb.copy(), filters=start.filters.copy(), bias=start.bias.copy(), out=start.out.copy())
        hashes, x, y = Words(), [], []
        for text, label in _once(batches):
            x.append(word_rows(alnum_words(text), hashes, (len(m.emb) - 1) // 3))
            y.append(label)
        if not x:
            return
        m = descend(m, [s.copy() if isinstance(s, np.ndarray) else s for s in sums], x, np.array(y, np.float32), np.arange(len(x)),
                    np.random.default_rng(part), 1, rate, batch)
        moved = np.flatnonzero((m.emb != start.emb).any(axis=1))
        found = [(-1, b"", np.concatenate([m.filters.ravel(), m.bias, m.out, [m.out_bias]]).astype(np.float64).tobytes())]
        for lo in range(0, len(m.emb), _CHUNK):
            own = moved[(moved >= lo) & (moved < lo + _CHUNK)]
            if len(own):
                found.append((lo, own.astype(np.int64).tobytes(), m.emb[own].tobytes()))
        for lo, own, v in found:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([float(len(x))]), pa.array([lo], pa.int32()),
                                              pa.array([own], pa.binary()), pa.array([v], pa.binary())], ["part", "n", "at", "own", "v"])

    dim = model.emb.shape[1]

    def averaged(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])  # in one order: the same sums on every run
        lo, own = rows[0]["at"], b""
        if lo < 0:
            v = sum(np.frombuffer(r["v"]) * r["n"] for r in rows) / sum(r["n"] for r in rows)
        else:
            total, n = np.zeros((_CHUNK, dim)), np.zeros(_CHUNK)
            for r in rows:
                at = np.frombuffer(r["own"], np.int64) - lo
                total[at] += np.frombuffer(r["v"], np.float32).reshape(-1, dim) * r["n"]
                n[at] += r["n"]
            at = np.flatnonzero(n)
            own, v = (at + lo).tobytes(), (total[at] / n[at, None]).astype(np.float32)
        return pa.table({"at": pa.array([lo], pa.int32()), "own": pa.array([own], pa.binary()), "v": pa.array([v.tobytes()], pa.binary())})

    emb, head = model.emb.copy(), None
    packs = dealt(rows.withColumn("h", langid.hash63(14, "side", "text")), parts, "h", _SENT)
    models = packs.mapInArrow(tune, "part int, n double, at int, own binary, v binary")
    with shuffles_released(spark):
        got = models.groupBy("at").applyInArrow(averaged, "at int, own binary, v binary").collect()  # one model
    for r in got:
        if r["at"] < 0:
            head = np.frombuffer(r["v"])
        else:
            emb[np.frombuffer(r["own"], np.int64)] = np.frombuffer(r["v"], np.float32).reshape(-1, dim)
    if head is None:
        return model
    cuts = np.cumsum([int(np.prod(s)) for s in dense])
    filters, bias, out, last = np.split(head, cuts)
    return model._replace(emb=emb, filters=filters.reshape(dense[0]).astype(np.float32), bias=bias.astype(np.float32),
                          out=out.astype(np.float32), out_bias=float(last[0]))


def _calibrated(rows: DataFrame, model: ToxicModel) -> ToxicModel:
    """Thresholds from all ``rows``, none of them trained on: counts by language, label and logit in steps of 1/128."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def logit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, hashes = sent.value, Words()
        for b in batches:
            texts = b.column("text").to_pylist()
            z = logits([word_rows(alnum_words(t), hashes, (len(m.emb) - 1) // 3) for t in texts], m)
            yield pa.RecordBatch.from_arrays([pa.array(langid.predict(m.languages, texts)[0], pa.string()), b.column("y"),
                                              pa.array(np.round(np.clip(z, -30, 30) * 128).astype(np.int32))], ["lang", "y", "z"])

    with shuffles_released(rows.sparkSession):
        counts = rows.select("text", "y").mapInArrow(logit, "lang string, y int, z int").groupBy("lang", "y", "z").count().toPandas()
    if counts.empty:
        return model

    def threshold(c) -> float:
        return best_threshold(c.z.to_numpy() / 128, c.y.to_numpy(), c["count"].to_numpy(float))

    found = {lang: threshold(c) for lang, c in counts.groupby("lang")
             if min(c["count"][c.y == 0].sum(), c["count"][c.y == 1].sum()) >= 5}
    return model._replace(thresholds=found, default=threshold(counts))


def score(docs: DataFrame, model: ToxicModel | None, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and ``score``, ``predicted`` of every whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # (3 * buckets + 1) x dim floats: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, hashes = sent.value, Words()
        for b in batches:
            texts = b.column("text").to_pylist()
            s = predict(m, texts, hashes) if m is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                                             ["row", "score", "predicted"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "score", "predicted")
