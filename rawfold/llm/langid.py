"""Language identification: averaged hashed subword embeddings, linear softmax, calibrated rejection.

A text is lower-cased (A-Z), everything of ASCII that is no letter becomes a space, and its subwords are the byte
n-grams of 2 to 4 inside words, the spaces around a word included. Each is hashed to a row of an
embedding table; the mean of a whole text's rows goes through a linear softmax. Trained in numpy by
stochastic gradient descent on word spans of all labelled rows: Spark deals them into parts, a task trains on each, and the
models are averaged. Where there are several parts, a row's spans are cut before it is dealt, so that no whole texts are
shuffled but those held back. A tenth of each part is held back: on it the softmax temperature is fitted (score = calibrated probability).

A document is rejected by its score or by how familiar its subwords are (mean log frequency in training: a text of
another language can be sure of its nearest one). All but ``alpha`` of the rightly recognised documents reach both
thresholds; for them, a tenth of all rows (10 / alpha, half of all at most, if that is more) is kept from training and scored by
Spark. Fewer than
2 / alpha right ones cannot tell: the threshold is then half the lowest score of a right one, and none of familiarity.

Since the softmax is linear in the mean, the table is multiplied by its weights before it is sent, and a
text costs one row look-up per byte and n-gram length, over windows of bounded size.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; without any labelled
row every text is ``und``; ties go to the language first in code point order; repeated rows get equal results; an empty
table gives an empty result; other columns are ignored (``keep_recognised`` keeps them).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm.common import bounded_batches, checkpointed, dealt, forget, shuffles_released, unpacked

UND = "und"
GRAMS = (2, 3, 4)
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")
_WINDOW = 1 << 19


class LanguageModel(NamedTuple):
    langs: list[str]
    table: np.ndarray       # [buckets + 1, languages + 1]: embedding times weights, log frequency; the last row is 0
    bias: np.ndarray
    temperature: float
    threshold: float
    familiar: float = -np.inf


def normalised(text: str) -> bytes:
    return b" " + text.encode("utf-8", "surrogatepass").translate(_LETTERS) + b" "


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def gram_rows(b: np.ndarray, n: int, count: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each of the first ``count`` bytes; ``buckets`` where it leaves its word."""
    g = np.full(count, n, np.uint32)
    for j in range(n):
        g = g * np.uint32(0x01000193) ^ b[j:j + count]
    g = (g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    g = (g ^ (g >> np.uint32(12))) % np.uint32(buckets)
    space = b == 32
    bad = space[0:count] & space[1:1 + count] if n == 2 else space[1:1 + count].copy()
    for j in range(2, n - 1):
        bad |= space[j:j + count]
    g[bad] = buckets
    return g


def text_sums(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of its subwords' rows and their number. Memory: the texts and one window."""
    buckets, width = len(table) - 1, table.shape[1]
    sums, counts = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64)
    if not texts:
        return sums, counts
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(texts) + b"    ", np.uint8)
    columns = np.ascontiguousarray(table.T)
    for lo in range(0, int(ends[-1]), _WINDOW):
        hi = min(lo + _WINDOW, int(ends[-1]))
        a = int(np.searchsorted(ends, lo, "right"))
        z = int(np.searchsorted(ends, hi - 1, "right")) + 1
        cuts = np.maximum(ends[a:z] - lengths[a:z] - lo, 0)
        part = flat[lo:hi + 3]
        for n in GRAMS:
            rows = gram_rows(part, n, hi - lo, buckets)
            at = rows.astype(np.intp)
            for j, column in enumerate(columns):  # column by column: each fits a cache
                sums[a:z, j] += np.add.reduceat(np.take(column, at, mode="clip"), cuts)
            counts[a:z] += np.add.reduceat((rows != buckets).astype(np.int64), cuts)
    return sums, counts


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def recognise(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and familiarity of each text."""
    lettered = [has_letter(t) for t in texts]
    if not model.langs:
        return [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    raw = [normalised(t) if ok else b"  " for t, ok in zip(texts, lettered)]
    sums, counts = text_sums(raw, model.table)
    means = sums / np.maximum(counts, 1)[:, None]
    p = _softmax((means[:, :-1] + model.bias) / model.temperature)
    best = p.argmax(axis=1)
    score = np.where(lettered, p[np.arange(len(texts)), best], 0.0)
    return [model.langs[i] if ok else UND for i, ok in zip(best, lettered)], score, means[:, -1]


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    return recognise(model, texts)[:2]


# --- training -----------------------------------------------------------------------------------------

def train(rows: list[tuple[str, str]], **options) -> LanguageModel:
    """rows: (text, language). Plain SGD; every tenth document (at least one a language) calibrates."""
    return learn_part(rows, **options)[0]


def _frequency(seen: np.ndarray) -> np.ndarray:
    buckets = len(seen) - 1
    return np.log((seen + 0.5) / (seen.sum() + 0.5 * buckets))


def _subwords(samples: list[bytes], buckets: int) -> list[np.ndarray]:
    """Rows of each sample's subwords, by length; many samples are hashed at once. A sample ends in a space, so no gram of one reads the next."""
    out = []
    for lo in range(0, len(samples), 1000):
        some = samples[lo:lo + 1000]
        ends = np.cumsum([len(s) for s in some]).tolist()
        flat = np.frombuffer(b"".join(some) + b"    ", np.uint8)
        grams = [gram_rows(flat, n, ends[-1], buckets) for n in GRAMS]
        for a, z in zip([0, *ends], ends):
            r = np.concatenate([g[a:z] for g in grams])
            out.append(r[r != buckets].astype(np.int64))
    return out


def excerpt(text: str, seed: int, spans: int = 4) -> str:
    """The spans of words a text is learned from, one a line; always the same for a seed."""
    rng, words, out = random.Random(seed), text.split(), []
    for _ in range(spans):
        n = min(len(words), int(2 ** rng.uniform(0, 6.5)))
        at = rng.randint(0, len(words) - n)
        out.append(" ".join(words[at:at + n]))
    return "\n".join(out)


def _is_held(h: int) -> bool:
    return h // 10 % 10 == 9


def _excerpts(t: pa.Table) -> pa.Table:
    """Rows (h, text, ..) as parts are trained on: the spans of their texts; a tenth, which calibrates, keeps them whole."""
    texts = [x if _is_held(h) else excerpt(x, h) for h, x in zip(t.column("h").to_pylist(), t.column("text").to_pylist())]
    return t.set_column(t.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def learn_part(rows: list[tuple[str, str]], *, langs: list[str] | None = None, dim: int = 16, buckets: int = 1 << 16,
               epochs: int = 6, rate: float = 4.0, spans: int = 4, batch: int = 64, seed: int = 7,
               cut: list[tuple[str, str]] = ()) -> tuple[LanguageModel, np.ndarray]:
    """The model of these rows and how often each bucket was seen; ``langs``: the languages of all rows, of which these may be a part.
    ``cut``: (spans, language) of rows whose spans are cut already (``excerpt``); then ``rows`` are those held back."""
    rows = sorted((lang, t) for t, lang in rows if has_letter(t))
    cut = sorted((lang, t) for t, lang in cut if has_letter(t))
    if langs is None:
        langs = sorted({lang for lang, _ in rows}, key=lambda s: s.encode())
    if not rows and not cut:
        return LanguageModel([], np.zeros((buckets + 1, 1), np.float32), np.zeros(1), 1.0, 0.0), np.zeros(buckets + 1, np.int64)
    rng = np.random.default_rng(seed)
    code = {lang: i for i, lang in enumerate(langs)}
    held = [i % 10 == 9 for i in range(len(rows))]
    if cut:
        held = [True] * len(rows)
    elif len(rows) < 40:
        held = [False] * len(rows)

    # spans of words: short and long ones, so that a text of a few words is no surprise
    samples, labels = [], []
    for (lang, text), out in zip(rows, held):
        if out:
            continue
        words = text.split()
        for _ in range(spans):
            n = min(len(words), int(2 ** rng.uniform(0, 6.5)))
            at = int(rng.integers(0, len(words) - n + 1))
            samples.append(normalised(" ".join(words[at:at + n])))
            labels.append(code[lang])
    for lang, text in cut:
        for span in text.split("\n"):
            samples.append(normalised(span))
            labels.append(code[lang])
    y = np.array(labels)
    subwords = _subwords(samples, buckets)

    emb = rng.normal(0, 0.1, (buckets + 1, dim)).astype(np.float32)
    w, bias = np.zeros((dim, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    weight = (len(y) / len(langs) / np.maximum(np.bincount(y, minlength=len(langs)), 1)).astype(np.float32)
    keep = np.array([i for i, s in enumerate(subwords) if len(s)], np.int64)
    steps = max(1, epochs * -(-len(keep) // batch))
    step = 0
    met, place = np.zeros(buckets + 1, bool), np.zeros(buckets + 1, np.int64)
    for _ in range(epochs):
        rng.shuffle(keep)
        for at in range(0, len(keep), batch):
            pick = keep[at:at + batch]
            sizes = np.array([len(subwords[i]) for i in pick])
            flat = np.concatenate([subwords[i] for i in pick])
            cuts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(emb[flat], cuts, axis=0) / sizes[:, None]
            p = _softmax(mean @ w + bias)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[y[pick], None] / len(pick)
            lr = rate * (1 - step / steps)
            grad = (p @ w.T) / sizes[:, None]
            w -= lr * (mean.T @ p)
            bias -= lr * p.sum(axis=0)
            # each subword's row moves by its texts' gradients; rows are few, so they are summed first
            met[flat] = True
            uniq = np.flatnonzero(met)
            met[uniq] = False
            place[uniq] = np.arange(len(uniq))
            inv, by_dim = place[flat], grad.astype(np.float32).T
            moved = np.zeros((dim, len(uniq)), np.float32)
            for j in range(dim):  # along one axis ``add.at`` is many times faster
                np.add.at(moved[j], inv, np.repeat(by_dim[j], sizes))
            emb[uniq] -= lr * len(pick) * moved.T
            step += 1
    seen = np.bincount(np.concatenate([np.empty(0, np.int64), *subwords]), minlength=buckets + 1)
    table = np.concatenate([emb @ w, _frequency(seen)[:, None]], axis=1).astype(np.float32)
    table[buckets] = 0
    model = LanguageModel(langs, table, bias, 1.0, 0.0)

    check = [r for r, out in zip(rows, held) if out] or rows or cut
    sums, counts = text_sums([normalised(t) for _, t in check], table)
    logits = sums[:, :-1] / np.maximum(counts, 1)[:, None] + bias
    truth = np.array([code[lang] for lang, _ in check])

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean())

    temperature = min((0.05 * 1.25 ** i for i in range(28)), key=loss)
    p = _softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    return model._replace(temperature=temperature, threshold=float(right[0]) / 2 if len(right) else 0.0), seen


def calibrated(model: LanguageModel, rows: DataFrame, alpha: float) -> LanguageModel:
    """The model with the thresholds that ``rows`` (text, label), none of them trained on, give for ``alpha``, or for the
    smallest share that so many rows can tell.

    Conformal: a new right answer is below the k-th smallest of n with a probability of k / (n + 1); half of ``alpha`` for
    each of the two. Without a right answer the model stays as it is."""
    right = checkpointed(_scored(rows, model, "text", ("label",), ("lang_pred", "score", "familiar")).filter("lang_pred = label").select("score", "familiar"))
    n = right.count()
    if not n:
        return model
    k = max(1, int(alpha / 2 * (n + 1)))
    score, familiar = (float(right.orderBy(c).limit(k).agg(F.max(c)).first()[0]) for c in right.columns)
    return model._replace(threshold=score, familiar=familiar)


_MAX63 = (1 << 63) - 1


def hash63(seed: int, *cols) -> Column:
    return F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit(_MAX63))


def hash_limit(share: float) -> int:
    """The greatest 63-bit hash of a share of all; however small, a share is not nothing."""
    return max(1, min(_MAX63, int(share * (1 << 63))))


def labelled_sample(docs: DataFrame, learn: Column, label: str, id_col: str, text_col: str, max_docs: int, max_bytes: int,
                    apart: float = 0, max_labels: int = 200) -> tuple[list[tuple[str, str]], DataFrame | None]:
    """(text, label) of at most ``max_docs`` rows and ``max_bytes`` bytes, shared evenly by the labels; and about ``apart``
    other rows of all labels alike, half of all at most.

    A label's different texts are taken in the order of their hashes while its rows and bytes last: the same on every
    run, whatever rows are repeated. Texts longer than an eighth of a label's bytes are not learned from, nor are labels
    beyond the ``max_labels`` most frequent (ties by name)."""
    d = docs.filter(learn).select(F.col(f"`{text_col}`").cast("string").alias("text"),
                                  F.col(f"`{label}`").cast("string").alias("label"),
                                  hash63(12, f"`{id_col}`", F.octet_length(f"`{text_col}`")).alias("side")).filter(
        "label is not null and text is not null").withColumn("b", F.octet_length("text").cast("long"))
    counted = d.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
    sizes = counted.orderBy(F.desc("n"), "label").limit(max_labels).collect()
    if not sizes:
        return [], None
    total, others, left = sum(r["n"] for r in sizes), None, 1.0
    if apart > 0:
        kept = F.col("side") <= hash_limit(min(0.5, apart / total))
        others, d, left = d.filter(kept).select("text", "label"), d.filter(~kept), 1 - min(0.5, apart / total)
    each_rows, each_bytes = max(1, max_docs // len(sizes)), max_bytes // len(sizes)
    limits = [(r["label"], hash_limit(min(1.0, each_rows / r["n"] / left, each_bytes / max(1, r["b"]) / left))) for r in sizes]
    shares = docs.sparkSession.createDataFrame(limits, "label string, share long")  # max_labels rows at most
    picked = d.filter(F.col("b") <= each_bytes // 8).withColumn("h", hash63(11, "text")).join(
        F.broadcast(shares), "label").filter("h <= share")
    rows = within(picked.groupBy("label", "h").agg(F.min("text").alias("text"), F.min("b").alias("b")), "label", each_rows, each_bytes)
    return [(r["text"], r["label"]) for r in sorted(rows.collect(), key=lambda r: (r["h"], r["label"]))], others


def within(rows: DataFrame, label: str, max_rows: int, max_bytes: int) -> DataFrame:
    """Of rows with a hash ``h`` and bytes ``b``, already few: those first by hash while each label's rows and bytes last."""
    w = Window.partitionBy(label).orderBy("h", "b")
    ranked = rows.withColumns({"__n": F.row_number().over(w),
                               "__b": F.sum("b").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    return ranked.filter((F.col("__n") <= max_rows) & (F.col("__b") <= max_bytes)).drop("__n", "__b")


# --- Spark --------------------------------------------------------------------------------------------

def _scored(docs: DataFrame, model: LanguageModel, text_col: str, keep: tuple[str, ...], names: tuple[str, ...]) -> DataFrame:
    """The columns in ``keep`` and those of ``lang_pred, score, familiar, accepted`` in ``names``, of every whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # buckets x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        m = sent.value
        for b in batches:
            langs, score, familiar = recognise(m, b.column("text").to_pylist())
            ok = [x != UND and s >= m.threshold and f >= m.familiar for x, s, f in zip(langs, score, familiar)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                 pa.array(familiar, pa.float64()), pa.array(ok, pa.bool_())],
                ["row", "lang_pred", "score", "familiar", "accepted"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("familiar", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    return rows.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *names)


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in ``keep`` and ``lang_pred, score, accepted`` of every whole text."""
    return _scored(docs, model, text_col, keep, ("lang_pred", "score", "accepted"))


_CHUNK = 4096  # buckets of a model sent as one row


def fit(docs: DataFrame, learn: Column, *, label: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        part_docs: int = 6000, part_bytes: int = 24 << 20, max_labels: int = 200, alpha: float = 5e-4, epochs: int = 6,
        buckets: int = 1 << 16, **options) -> LanguageModel:
    """A model from all rows for which ``learn`` holds and that have a label; with ``alpha``, a tenth of them (10 / alpha rows, half
    of all at most, if that is more) sets its thresholds instead of being trained on.

    Spark deals the rows into parts of about ``part_docs`` rows and ``part_bytes`` bytes by a hash; each task trains on one part, and
    the models, which are linear in their tables, are averaged by rows, their counts summed. The same on every run."""
    spark = docs.sparkSession
    d = docs.filter(learn).select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{label}`").cast("string").alias("label"),
                                  hash63(12, f"`{id_col}`", F.octet_length(f"`{text_col}`")).alias("side")).filter(
        "label is not null and text is not null")
    counted = d.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("b"))
    sizes = counted.orderBy(F.desc("n"), "label").limit(max_labels).collect()
    if not sizes:
        return train([], buckets=buckets)
    total, others = sum(r["n"] for r in sizes), None
    if alpha:
        kept = F.col("side") <= hash_limit(max(0.1, min(0.5, 10 / alpha / total)))
        others, d = d.filter(kept).select("text", "label"), d.filter(~kept)
    langs = sorted((r["label"] for r in sizes), key=lambda s: s.encode())
    parts = max(1, -(-total // part_docs), -(-sum(r["b"] for r in sizes) // part_bytes))
    model = _averaged(d.filter(F.col("label").isin(langs)), langs, parts, buckets,
                      dict(options, epochs=max(2, -(-epochs // parts))) if parts > 1 else dict(options, epochs=epochs))
    return calibrated(model, others, alpha) if others is not None else model


def _averaged(rows: DataFrame, langs: list[str], parts: int, buckets: int, options: dict) -> LanguageModel:
    """The average of the models of ``parts`` parts of ``rows`` (text, label, side)."""
    width = len(langs)
    sent = pa.schema([("h", pa.int64()), ("text", pa.string()), ("label", pa.string())])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own, cut, last = [], [], None
        table = unpacked(batches, sent, ("h", "label"))  # in the order of a hash: copies of a row are neighbours, and taken once
        for h, t, lang in zip(*(table.column(c).to_pylist() for c in ("h", "text", "label"))):
            if (t, lang) != last:
                (own if parts == 1 or _is_held(h) else cut).append((t, lang))
            last = t, lang
        m, seen = learn_part(own, langs=langs, buckets=buckets, cut=cut, **options)
        if not m.langs:
            return
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), float(len(own) + len(cut))
        at, values = [-1], [np.array([m.temperature, m.threshold, *m.bias]).tobytes()]
        for lo in range(0, buckets + 1, _CHUNK):
            at.append(lo)
            values.append(pa.compress(m.table[lo:lo + _CHUNK, :-1].tobytes() + seen[lo:lo + _CHUNK].astype(np.int64).tobytes(), codec="zstd", asbytes=True))
        for lo, v in zip(at, values):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n]), pa.array([lo], pa.int32()),
                                              pa.array([v], pa.binary())], ["part", "n", "at", "v"])

    def averaged(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])  # in one order: the same sums on every run
        lo, n = rows[0]["at"], sum(r["n"] for r in rows)
        if lo < 0:
            x = [np.frombuffer(r["v"]) for r in rows]
            out = sum(v * (r["n"] / n) for v, r in zip(x, rows))
            out[1] = min(v[1] for v in x)
            v = out.tobytes()
        else:
            size = min(_CHUNK, buckets + 1 - lo)
            table, seen = np.zeros((size, width)), np.zeros(size, np.int64)
            for r in rows:
                v = pa.decompress(r["v"], decompressed_size=size * (width * 4 + 8), codec="zstd", asbytes=True)
                table += np.frombuffer(v, np.float32, size * width).reshape(size, width) * (r["n"] / n)
                seen += np.frombuffer(v, np.int64, size, size * width * 4)
            v = table.astype(np.float32).tobytes() + seen.tobytes()
        return pa.table({"at": pa.array([lo], pa.int32()), "v": pa.array([v], pa.binary())})

    prepare = _excerpts if parts > 1 else None  # several parts need no whole texts; one cuts its spans itself
    packs = dealt(rows.withColumn("h", hash63(11, "side", "text")), parts, "h", sent, prepare)
    models = packs.mapInArrow(learned, "part int, n double, at int, v binary")
    with shuffles_released(rows.sparkSession):
        got = {r["at"]: r["v"] for r in models.groupBy("at").applyInArrow(averaged, "at int, v binary").collect()}  # one model
    if not got:
        return train([], buckets=buckets)
    head = np.frombuffer(got.pop(-1))
    table, seen = np.zeros((buckets + 1, width + 1), np.float32), np.zeros(buckets + 1, np.int64)
    for lo, v in got.items():
        size = min(_CHUNK, buckets + 1 - lo)
        table[lo:lo + size, :-1] = np.frombuffer(v, np.float32, size * width).reshape(size, width)
        seen[lo:lo + size] = np.frombuffer(v, np.int64, size, size * width * 4)
    table[:, -1] = _frequency(seen)
    table[buckets] = 0
    return LanguageModel(langs, table, head[2:].copy(), float(head[0]), float(head[1]))


def keep_recognised(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is recognised; the same columns."""
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return identify(whole, model, text_col="text", keep=("doc",)).filter("accepted").select(
        *[F.col(f"doc.`{c}`").alias(c) for c in names])
