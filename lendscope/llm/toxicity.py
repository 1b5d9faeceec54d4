"""Toxicity from subword-bag embeddings averaged into a linear softmax.

A word that repeats the one before it is passed over. A text is cut into
windows of ``WORDS`` words. A window's features are its
byte n-grams (word edges included), hashed into a table of embeddings; their
mean goes through a linear softmax. A text scores as its most toxic window, so
one bad word counts in a long text as in a short one. A word that was never
seen, or is misspelled, still shares n-grams with words that were.

Embeddings and softmax are trained together in numpy on a bounded sample of
labelled texts: windows of clean texts are all negative, of each toxic text
the window that the model itself finds most toxic is positive (all windows, in
the first pass).

Defined results: null, empty and blank texts have no window and score as the
model's bias alone; null labels teach nothing; without any label of one kind
the score is the share of toxic labels; a text with several labels learns from
each; rows are independent and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _FOLD, Shipped, mix, remainder, small_batches, table, word_windows

WORDS = 8
SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 16
DIM = 8
SAMPLE_CHARS = 4_000_000  # of each class's labelled texts, in expectation
PASSES = 5
BATCH = 256
RATE = 0.5
SEED = 7
_LETTER = (_FOLD + 2).astype(np.uint64)  # 1 is the word edge
_SALT = mix(np.arange(16))


def ngrams(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(word, bucket) of every n-gram of the words data[start:end], each word
    taken with one edge sign before and after it."""
    size = end - start + 2
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(word)) - begin[word]
    edge = (inside == 0) | (inside == size[word] - 1)
    code = np.where(edge, np.uint64(1), _LETTER[data[np.clip(start[word] + inside - 1, 0, len(data) - 1)]])
    words, buckets = [], []
    h = np.zeros(len(code), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(SIZES) + 1):
            if n > 1:
                h = h[:-1]
            h = h * np.uint64(0x100000001B3) + code[n - 1:]
            if n in SIZES:
                fits = np.flatnonzero(inside[:len(h)] + n <= size[word[:len(h)]])
                words.append(word[fits])
                buckets.append((mix(h[fits] ^ _SALT[n]) >> np.uint64(48)).astype(np.int64) % BUCKETS)
    return np.concatenate(words), np.concatenate(buckets)


def windows(texts: pa.Array):
    """Yield (text row, window start flags, word ranges, bytes) with windows of
    ``WORDS`` words counted from each text's stretch."""
    for row, s, e, h, data in word_windows(texts):
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        row, s, e = row[fresh], s[fresh], e[fresh]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        yield row, np.cumsum(nth % WORDS == 0) - 1, s, e, data


class Model:
    def __init__(self, bucket_logit: np.ndarray, bias: float):
        self.bucket_logit, self.bias = bucket_logit, bias

    def score(self, texts: pa.Array) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        for row, window, s, e, data in windows(texts):
            word, bucket = ngrams(data, s, e)
            n = window[-1] + 1
            total = np.bincount(window[word], self.bucket_logit[bucket], minlength=n)
            count = np.bincount(window[word], minlength=n)
            np.maximum.at(best, row[np.searchsorted(window, np.arange(n))], total / np.maximum(count, 1))
        logit = np.where(np.isfinite(best), best, 0.0) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def _bags(texts: pa.Array):
    """(text of each window, offsets, buckets) over all windows."""
    rows, counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, window, s, e, data in windows(texts):
        word, bucket = ngrams(data, s, e)
        by = np.argsort(window[word], kind="stable")
        rows.append(row[np.searchsorted(window, np.arange(window[-1] + 1))])
        counts.append(np.bincount(window[word], minlength=window[-1] + 1))
        ids.append(bucket[by].astype(np.int32))
    return np.concatenate(rows), np.concatenate([[0], np.cumsum(np.concatenate(counts))]), np.concatenate(ids)


def train(texts: pa.Array, toxic: np.ndarray, passes: int = PASSES, seed: int = SEED) -> Model:
    """Joint stochastic gradient descent (Adagrad) over embeddings and softmax."""
    rng = np.random.default_rng(seed)
    share = float(toxic.mean()) if len(toxic) else 0.5
    if not 0.0 < share < 1.0:
        return Model(np.zeros(BUCKETS), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    text, at, ids = _bags(texts)
    embed = rng.uniform(-1.0 / DIM, 1.0 / DIM, (BUCKETS, DIM))
    soft, bias = np.zeros((DIM, 2)), np.zeros(2)
    grown, grown_soft, grown_bias = np.full((BUCKETS, DIM), 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    label = toxic[text].astype(np.int64)
    for turn in range(passes):
        use = np.arange(len(text))
        if turn:
            weight, logit = embed @ (soft[:, 1] - soft[:, 0]), np.empty(len(text))
            for lo in range(0, len(text), 4096):
                own = at[lo:lo + 4097]
                logit[lo:lo + 4096] = np.add.reduceat(weight[ids[own[0]:own[-1]]], own[:-1] - own[0]) / np.diff(own)
            top = np.lexsort((-logit, text))
            lead = top[np.diff(text[top], prepend=-1) != 0]  # the most toxic window of each text
            use = np.concatenate([np.flatnonzero(label == 0), lead[label[lead] == 1]])
        use = rng.permutation(use)
        for lo in range(0, len(use), BATCH):
            w = use[lo:lo + BATCH]
            size = (at[w + 1] - at[w])
            own = np.repeat(np.arange(len(w)), size)
            bag = ids[np.repeat(at[w] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            mean = np.add.reduceat(embed[bag], np.cumsum(size) - size) / size[:, None]
            z = mean @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(w)), label[w]] -= 1.0
            back = (p @ soft.T) / size[:, None]
            g_soft, g_bias = mean.T @ p, p.sum(axis=0)
            hit, slot = np.unique(bag, return_inverse=True)
            g = np.stack([np.bincount(slot, back[own, d], minlength=len(hit)) for d in range(DIM)], axis=1)
            grown[hit] += g * g
            embed[hit] -= RATE * g / np.sqrt(grown[hit])
            grown_soft += g_soft * g_soft
            soft -= RATE * g_soft / np.sqrt(grown_soft)
            grown_bias += g_bias * g_bias
            bias -= 0.1 * g_bias / np.sqrt(grown_bias)
    return Model(embed @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on the texts of ``docs`` that ``labels`` (doc_id, toxic) marks 0 or
    1; each class is thinned by a hash to about ``sample_chars`` characters."""
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("_toxic")).where("_toxic IN (0, 1)")
    rows = docs.select("doc_id", F.length("text").alias("_n")).where("_n > 0").join(marks, "doc_id")
    chars = {r["_toxic"]: r["n"] for r in rows.groupBy("_toxic").agg(F.sum("_n").alias("n")).collect()}
    rate = F.when(F.col("_toxic") == 1, min(1.0, sample_chars / max(1, chars.get(1, 0)))).otherwise(min(1.0, sample_chars / max(1, chars.get(0, 0))))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    chosen = rows.where(chance < rate).select("doc_id", "_toxic").distinct()
    # about sample_chars rows a class at most, so small enough to be sent to every task: no text is shuffled
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("length(text) > 0").orderBy("doc_id", "text", "_toxic").toArrow()
    return train(sample.column("text"), np.asarray(sample.column("_toxic").to_numpy(), dtype=np.int64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = Shipped(docs.sparkSession, model)  # a number per bucket

    def run(batches):
        own = shared.value
        for whole in batches:
            for b in small_batches(whole, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(own.score(b.column("text")))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs.where(remainder("doc_id", 5) != 0), labels.where(remainder("doc_id", 5) != 0))
    return scored(docs, model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
