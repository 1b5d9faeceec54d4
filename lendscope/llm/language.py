"""Language identification by segmentation-marginalised unigram models.

Every language has a probability for each piece of a fixed public vocabulary;
a word's probability is the sum over all its segmentations into pieces, by the
forward algorithm, and a text's is the product over its words. The piece
probabilities are fitted by expectation-maximisation on word counts of a
bounded sample of labelled texts.

Words are runs of letters, lower-cased; a run of over ``LONGEST`` bytes is
scored as consecutive stretches of that length. Defined results: a null text
or one without letters is ``und`` with score 0; ties fall to the first name in
code point order; null labels teach nothing; with nothing to learn from, every
text is ``und``; rows are independent and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTE, Shipped, materialised, mix, remainder, small_batches, table, tidy, unused, word_windows

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_CHARS = 6_000_000  # of a language's labelled texts, in expectation
ROUNDS = 3
SMOOTH = 0.05
UNKNOWN = 1e-7  # of a byte that no piece covers
LONGEST = 48
SCALE = 4096.0  # put on each byte in the lattice, near UNKNOWN ** -0.5: paths of LONGEST + 1 bytes stay within 1e-166 and 1e177
NODES = 2_000_000
KNOWN_VALUES = 4_000_000
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
MARK = 0x20  # stands for the vocabulary's word-start sign


def piece_list(path: str) -> list[bytes]:
    """The vocabulary's pieces of lower-case letters, with or without the word-start sign."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = set()
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        body = p.replace("▁", "", 1) if p.startswith("▁") else p
        if not model.is_byte(i) and not model.is_control(i) and not model.is_unknown(i) and p == p.lower() and (body.isalpha() or p == "▁"):
            out.add((" " if p.startswith("▁") else "").encode() + body.encode())
    return sorted(out)


class Lattice:
    """Segmentation lattices of many words at once.

    Substrings are looked up by rolling fingerprint, one piece length after
    another; a start drops out when no piece continues it.
    """

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        codes, prefixes = [], set()
        for p in pieces:
            h = self._fingerprints(p)
            codes.append(h[-1])
            prefixes.update(h)
        codes = np.array(codes, dtype=np.uint64)
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        self.prefixes = np.sort(np.array(list(prefixes), dtype=np.uint64))
        self.longest = max(map(len, pieces), default=1)
        self.scale = SCALE ** np.minimum([len(p) for p in pieces], LONGEST + 1)[:, None]

    @staticmethod
    def _fingerprints(p: bytes) -> list[int]:
        h, power, out = 0, 1, []
        for b in p:
            h = (h + int(_BYTE[b]) * power) & (2**64 - 1)
            power = power * int(_R) & (2**64 - 1)
            out.append(h)
        return out

    def edges(self, data: np.ndarray, left: np.ndarray):
        """(start, length, piece) of every piece occurrence in ``data``; ``left``
        is how many bytes of its word each position still has."""
        here = np.arange(len(data))
        h = np.zeros(len(data), dtype=np.uint64)
        power = np.uint64(1)
        found = []
        with np.errstate(over="ignore"):
            for n in range(1, self.longest + 1):
                ok = left[here] >= n
                here, h = here[ok], h[ok]
                h = h + _BYTE[data[here + n - 1]] * power
                power = power * _R
                at = np.minimum(np.searchsorted(self.prefixes, h), len(self.prefixes) - 1)
                ok = self.prefixes[at] == h
                here, h = here[ok], h[ok]
                if not len(here):
                    break
                at = np.minimum(np.searchsorted(self.codes, h), len(self.codes) - 1)
                hit = self.codes[at] == h
                found.append((here[hit], np.full(hit.sum(), n), self.order[at[hit]]))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*found))

    def sweep(self, words: list[np.ndarray] | tuple[np.ndarray, np.ndarray], probability: np.ndarray, weight=None):
        """Log probabilities (words x languages); with ``weight`` (words x
        languages) also the expected piece counts (pieces x languages). Inside,
        a path's weight is its probability times ``SCALE`` for each byte."""
        data, size = words
        probability, unknown = probability * self.scale, UNKNOWN * SCALE
        begin = np.cumsum(size) - size
        word = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(data)) - begin[word]
        node = np.arange(len(data)) + word  # a word of n bytes has n + 1 nodes
        start, length, piece = self.edges(data, size[word] - inside)
        by = np.lexsort((length, inside[start]))
        start, length, piece = start[by], length[by], piece[by]
        depth = inside[start]
        cuts = np.flatnonzero(np.diff(depth * 64 + length, prepend=-1, append=-1))
        groups = [(lo, hi, int(depth[lo])) for lo, hi in zip(cuts[:-1], cuts[1:])]
        steps = [np.flatnonzero(inside == t) for t in range(int(size.max()) if len(size) else 0)]
        alpha = np.zeros((len(data) + len(size), probability.shape[1]))
        alpha[begin + np.arange(len(size))] = 1.0
        g = 0
        for t, at in enumerate(steps):
            alpha[node[at] + 1] += alpha[node[at]] * unknown
            while g < len(groups) and groups[g][2] == t:
                lo, hi, _ = groups[g]
                src = node[start[lo:hi]]
                alpha[src + length[lo]] += alpha[src] * probability[piece[lo:hi]]
                g += 1
        last = begin + np.arange(len(size)) + size
        total = alpha[last]
        logs = np.log(total) - size[:, None] * np.log(SCALE)
        if weight is None:
            return logs
        beta = np.zeros_like(alpha)
        beta[last] = weight / total
        counts = np.zeros_like(probability)
        g = len(groups) - 1
        for t in range(len(steps) - 1, -1, -1):
            at = steps[t]
            beta[node[at]] += beta[node[at] + 1] * unknown
            while g >= 0 and groups[g][2] == t:
                lo, hi, _ = groups[g]
                src = node[start[lo:hi]]
                flow = beta[src + length[lo]] * probability[piece[lo:hi]]
                beta[src] += flow
                flow *= alpha[src]
                for j in range(probability.shape[1]):
                    counts[:, j] += np.bincount(piece[lo:hi], flow[:, j], minlength=len(counts))
                g -= 1
        return logs, counts


def letters(texts: pa.Array) -> pa.Array:
    """Words of letters and their marks, lower-cased; marks without a letter are no word."""
    words = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pM]+", " ")
    return pc.replace_substring_regex(words, r"(?:^| )(?:\pM+(?: |$))+", " ")


def distinct_words(data: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray):
    """(bytes and sizes of the distinct words, each with the start mark; their
    fingerprints; which of them each word is; each one's place in the input).
    Long runs come as stretches."""
    if len(s) and (e - s).max() > LONGEST:
        parts = -(-(e - s) // LONGEST)
        back = np.repeat(np.arange(len(s)), parts)
        nth = np.arange(len(back)) - np.repeat(np.cumsum(parts) - parts, parts)
        s2 = s[back] + nth * LONGEST
        e = np.minimum(s2 + LONGEST, e[back])
        h = np.where(parts[back] > 1, mix(h[back] + nth.astype(np.uint64)), h[back])
        s = s2
    else:
        back = np.arange(len(s))
    code, first, which = np.unique(h, return_index=True, return_inverse=True)
    size = (e - s)[first] + 1
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(first)), size)
    inside = np.arange(len(word)) - begin[word]
    raw = np.where(inside == 0, MARK, data[np.maximum(s[first][word] + inside - 1, 0)]).astype(np.uint8)
    return (raw, size), code, which, back


def blocks(words, languages: int):
    """Stretches of the distinct words whose lattices fit a bounded table."""
    data, size = words
    ends = np.cumsum(size)
    per = max(1, NODES // max(4, languages))
    lo = 0
    while lo < len(size):
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + per, "right")))
        yield lo, hi, (data[base:int(ends[hi - 1])], size[lo:hi])
        lo = hi


class Known:
    """Word log probabilities by fingerprint, kept from batch to batch."""

    def __init__(self, languages: int):
        self.codes, self.logs = np.zeros(0, np.uint64), np.zeros((0, languages))
        self.room = KNOWN_VALUES // max(1, languages)

    def missing(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.ones(len(codes), dtype=bool) if not len(self.codes) else self.codes[at] != codes

    def add(self, codes: np.ndarray, logs: np.ndarray) -> None:
        codes, logs = np.concatenate([self.codes, codes]), np.concatenate([self.logs, logs])
        by = np.argsort(codes, kind="stable")
        self.codes, self.logs = codes[by], logs[by]

    def find(self, codes: np.ndarray) -> np.ndarray:
        return self.logs[np.searchsorted(self.codes, codes)]

    def trim(self) -> None:
        if len(self.codes) > self.room:
            self.codes, self.logs = self.codes[:0], self.logs[:0]


class Model:
    """Languages, pieces and piece probabilities (pieces x languages)."""

    def __init__(self, languages: list[str], pieces: list[bytes], probability: np.ndarray):
        self.languages, self.pieces, self.probability = languages, pieces, probability

    def score(self, lattice: Lattice, known: Known, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities texts x languages, words of each text)."""
        known.trim()
        rows, codes, count = [], [], np.zeros(len(texts), np.int64)
        new_codes, new_sizes, new_raw = [], [], []
        for row, s, e, h, data in word_windows(letters(texts)):
            (raw, size), code, which, back = distinct_words(data, s, e, h)
            rows.append(row[back])
            codes.append(code[which])
            count += np.bincount(row, minlength=len(texts))
            new = known.missing(code)
            new_codes.append(code[new])
            new_sizes.append(size[new])
            new_raw.append(raw[np.repeat(new, size)])
        out = np.zeros((len(texts), len(self.languages)))
        if not rows:
            return out, count
        code, first = np.unique(np.concatenate(new_codes), return_index=True)
        if len(code):
            size, raw = np.concatenate(new_sizes), np.concatenate(new_raw)
            begin, size = (np.cumsum(size) - size)[first], size[first]
            raw = raw[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
            known.add(code, np.concatenate([lattice.sweep(w, self.probability) for _, _, w in blocks((raw, size), len(self.languages))]))
        row, logs = np.concatenate(rows), known.find(np.concatenate(codes))
        for j in range(len(self.languages)):
            out[:, j] = np.bincount(row, logs[:, j], minlength=len(texts))
        return out, count


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all words of (lang, text) rows; a word comes with its start mark."""
    @tidy("language")
    def count(batches):
        for whole in batches:
            for b in small_batches(whole, "text"):
                codes = b.column("lang").dictionary_encode()
                lang = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                for row, s, e, h, data in word_windows(letters(b.column("text"))):
                    (raw, size), _, which, back = distinct_words(data, s, e, h)
                    pair, n = np.unique(lang[row[back]] * len(size) + which, return_counts=True)
                    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays([codes.dictionary.take(pa.array(pair // len(size))).cast(pa.string()), words.take(pa.array(pair % len(size))),
                                                      pa.array(n)], names=["lang", "word", "n"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, vocabulary: str | None = None, sample_chars: int = SAMPLE_CHARS, rounds: int = ROUNDS) -> Model:
    """Fit on (doc_id, lang, text) rows with a label. Each language's texts are
    thinned by a hash of their id and text to about ``sample_chars`` characters."""
    from .packing import vocabulary_path
    path = vocabulary or vocabulary_path(VOCABULARY)
    pieces = piece_list(path)
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    rates = docs.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"))
    rates = rates.select("lang", F.least(F.lit(1.0), F.lit(float(sample_chars)) / F.greatest("chars", F.lit(1))).alias("rate"))
    rates = materialised(rates, "rates")
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    sample = docs.join(rates, "lang").where(chance < F.col("rate"))
    counts = materialised(word_counts(sample), "words")
    languages = sorted(r["lang"] for r in rates.select("lang").collect())  # one per language
    probability = np.full((len(pieces), len(languages)), 1.0 / max(1, len(pieces)))
    if not languages:
        return Model(languages, pieces, probability)
    column = {name: j for j, name in enumerate(languages)}
    for _ in range(rounds):
        shared = counts.sparkSession.sparkContext.broadcast(probability)  # pieces x languages

        @tidy("language")
        def expect(batches):
            lattice, table_, total = Lattice(pieces), shared.value, np.zeros((len(pieces), len(languages)))
            for b in batches:
                words = b.column("word").cast(pa.large_binary())
                size = pc.binary_length(words).to_numpy().astype(np.int64)
                off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
                data = np.frombuffer(words.buffers()[2], np.uint8)[off[0]:off[-1]]
                j = np.array([column[x] for x in b.column("lang").to_pylist()])
                weight = np.zeros((len(size), len(languages)))
                weight[np.arange(len(size)), j] = b.column("n").to_numpy()
                for lo, hi, own in blocks((data, size), len(languages)):
                    total += lattice.sweep(own, table_, weight[lo:hi])[1]
            p, j = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(j), pa.array(total[p, j])], names=["piece", "lang", "n"])

        mass = np.full((len(pieces), len(languages)), SMOOTH)
        sums = counts.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        np.add.at(mass, (sums["piece"].to_numpy(np.int64), sums["lang"].to_numpy(np.int64)), sums["n"].to_numpy(float))
        probability = mass / mass.sum(axis=0)
        shared.unpersist()
    return Model(languages, pieces, probability)


def identify(docs: DataFrame, model: Model, keep: list[str], names=("_lang_pred", "_score")) -> DataFrame:
    """The ``keep`` columns of ``docs`` with two more by the given names: the
    language and its share of the total probability (languages equally likely)."""
    spark: SparkSession = docs.sparkSession
    shared = Shipped(spark, model)  # pieces x languages
    kept = [docs.schema[c] for c in keep]
    hidden = "text" if "text" in keep else unused([*keep, *names], "_text")[0]

    @tidy("language")
    def run(batches):
        m = shared.value
        lattice, known = Lattice(m.pieces), Known(len(m.languages))
        spoken = np.array([*m.languages, "und"], dtype=object)
        for whole in batches:
            for b in small_batches(whole, hidden):
                best, share = np.full(b.num_rows, len(m.languages)), np.zeros(b.num_rows)
                if m.languages:
                    logs, words = m.score(lattice, known, b.column(hidden))
                    top = logs.max(axis=1)
                    share = np.where(words > 0, 1.0 / np.exp(logs - top[:, None]).sum(axis=1), 0.0)
                    best = np.where(words > 0, logs.argmax(axis=1), len(m.languages))
                yield pa.RecordBatch.from_arrays([b.column(f.name) for f in kept] + [pa.array(spoken[best], pa.string()), pa.array(share)],
                                                 names=[f.name for f in kept] + list(names))

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{names[0]}` string", f"`{names[1]}` double"])
    text = [] if hidden in keep else [F.col("text").alias(hidden)]
    return docs.select(*[F.col(f"`{f.name}`") for f in kept], *text).mapInArrow(run, schema)


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.where(remainder("doc_id", 3) != 1).select("doc_id", "lang", "text")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit(learning_rows(docs)), ["doc_id"])
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))
