"""Hierarchical Pitman-Yor language model over words, their contexts and spelling.

A restaurant of each previous word serves the words that follow it; a new table
there is a customer of the word restaurant, which all previous words share as
their parent. A new table of the word restaurant is a new spelling, drawn
from restaurants of bytes whose context is the two bytes before: a context of
two bytes shares its parent (the last byte) with all that end alike, those
share the empty context, and its parent is uniform over the byte alphabet.
So the model gives every possible word a probability after every word, and
those of all words sum to one. Words that training never saw are one unknown
word, which has what the model leaves to all of them together. The end of a
text is the empty word, and also what stands before its first word.

Seating is sampled by Gibbs sweeps. In a sweep all customers of a dish leave
and are seated anew one after another, given the parent's probabilities and
the restaurant's number of tables of the sweep before. A pair of words that
occurs once has one table and needs no draw, so only repeated pairs are seated;
how many single pairs a word has is its count less that of its repeated pairs.
Predictive probabilities are averaged over the sweeps after burn-in.

A dish's seating is a function of the seed, the sweep and the dish, so the
states of the sweeps need not be stored, and a lost task seats alike: the chunk
of texts that asks for a pair gets its count and seats it again.

How it scales: texts become chunks of word codes, written once. Each distinct
pair of a chunk is sent once to the range of pair fingerprints that counts it,
and its count comes back to the chunk, with a mark that makes one of the chunks
of a repeated pair its owner. In a sweep an owner asks the ranges of words for
the words of its pairs, seats them and sends back sums by word: what travels is
an entry a word and chunk, never a row a pair. So a frequent pair or word is one
entry a chunk, ranges are even (fingerprints are mixed) and their number grows
with the entries. Arrays travel and rest as compressed byte planes. Tables and
shuffle files that a later step replaces are deleted as soon as it is written.
Words are known by 64-bit fingerprints; two of the same fingerprint would be
taken for one word.

Defined results: null and empty texts are one end token; a null doc_id counts
as an empty id when training texts are chosen; repeated rows are separate
texts; without training tokens every count is 0 and the model falls back to
its spelling prior; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _FOLD, Shipped, discard, materialised, mix, release, remainder, scratch, small_batches, table, tidy, trimmed, word_windows

BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0  # of every restaurant
BYTE_DISCOUNT = 0.5
CHUNK_BYTES = 12 << 20
RANGE_ENTRIES, RANGE_WORDS = 1 << 20, 1 << 18
BLOCK = 1 << 19
SEED = 41
END, START = 256, 257
CONTEXTS, SYMBOLS = 258, 257
_ASCII_LOWER = _FOLD.astype(np.uint8)


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches data[start:start + size] one after another."""
    begin = np.cumsum(size) - size
    return data[np.repeat(start - begin, size) + np.arange(int(size.sum()))]


def _binary(size: np.ndarray, raw: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def chunk_tokens(texts: pa.Array):
    """The distinct words of a chunk by fingerprint, the end token (0) first, as
    (fingerprints, sizes, bytes); its tokens as their codes; where each text ends."""
    rows, codes, own, sizes, raws = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(1, np.uint64)], [np.zeros(1, np.int64)], []
    for row, s, e, h, data in word_windows(texts):
        rows.append(row)
        codes.append(np.maximum(h, np.uint64(1)))  # 0 is the end token
        u, first = np.unique(codes[-1], return_index=True)
        own.append(u)
        sizes.append((e - s)[first])
        raws.append(_ASCII_LOWER[gathered(data, s[first], sizes[-1])])
    raw, size = np.concatenate(raws) if raws else np.zeros(0, np.uint8), np.concatenate(sizes)
    ids, first = np.unique(np.concatenate(own), return_index=True)
    raw = gathered(raw, (np.cumsum(size) - size)[first], size[first])
    row, word = np.concatenate(rows).astype(np.int64), np.concatenate(codes)
    out = np.zeros(len(word) + len(texts), np.int32)
    out[np.arange(len(word)) + row] = np.searchsorted(ids, word)
    ends = np.cumsum(np.bincount(row, minlength=len(texts)) + 1)
    return ids, size[first], raw, out, ends


def pair_id(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(before) + word)


def _numbered(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of so many bits in order, and each entry's place among them:
    key and number of an entry are sorted as one integer, where they fit in one."""
    low = len(key).bit_length()
    if bits + low > 64:
        return np.unique(key, return_inverse=True)
    both = np.sort(key << np.uint64(low) | np.arange(len(key), dtype=np.uint64))
    key = both >> np.uint64(low)
    both &= np.uint64((1 << low) - 1)
    new = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
    place = np.empty(len(key), np.int32)
    place[both.astype(np.int64)] = np.cumsum(new, dtype=np.int32) - 1
    return key[new], place


def chunk_pairs(ids: np.ndarray, codes: np.ndarray):
    """(pair, previous code, code, place of each token's pair): a chunk's distinct
    pairs in the order of the high bits of their fingerprints, then of the words."""
    bits = max(1, len(ids).bit_length())
    both = np.zeros(len(codes), np.uint64)
    both[1:] = codes[:-1]
    both <<= np.uint64(bits)
    both |= codes.astype(np.uint64)
    both, place = _numbered(both, 2 * bits)
    before, word = (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    pair = pair_id(ids[before], ids[word])
    low = np.uint64((1 << len(pair).bit_length()) - 1)
    order = (np.sort((pair & ~low) | np.arange(len(pair), dtype=np.uint64)) & low).astype(np.int64)
    back = np.empty(len(order), np.int32)
    back[order] = np.arange(len(order), dtype=np.int32)
    return pair[order], before[order], word[order], back[place]


# --- compressed arrays -----------------------------------------------------------

def packed(x: np.ndarray) -> bytes:
    """An array as compressed byte planes, after their length."""
    x = np.ascontiguousarray(x)
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(x.size, x.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unpacked(raw: bytes, kind) -> np.ndarray:
    if not raw:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def steps(x: np.ndarray) -> bytes:
    """Fingerprints in order, packed as differences (mod 2^64)."""
    return packed(np.diff(x, prepend=np.uint64(0)))


def restored(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, np.uint64), dtype=np.uint64)


def _all(column, read, kind) -> np.ndarray:
    """The arrays of a binary column, one after another."""
    return np.concatenate([np.zeros(0, kind), *[read(x) for x in column.to_pylist() if x is not None]])


def _longs(raw: bytes) -> np.ndarray:
    return unpacked(raw, np.int64)


CODED = "chunk long, ids binary, sizes binary, spelled binary, trained binary, codes binary, ends array<long>, doc_id array<{}>, held_out array<boolean>, tokens long, words long"


def coded(docs: DataFrame) -> DataFrame:
    """A row for each chunk of texts: its words (fingerprint, size, bytes, count in
    training texts), its tokens as their codes, its documents and how many
    tokens and distinct words it has."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @tidy("pitmanyor")
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            for b in small_batches(whole, "text", CHUNK_BYTES):
                held = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                ids, size, raw, codes, ends = chunk_tokens(b.column("text"))
                trained = np.bincount(codes, np.repeat(~held, np.diff(ends, prepend=0)), minlength=len(ids)).astype(np.int64)
                docs_ = pa.array([0, b.num_rows], pa.int32())
                one = lambda x: pa.array([x], pa.binary())
                lists = lambda x: pa.ListArray.from_arrays(docs_, x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + number]), one(steps(ids)), one(packed(size)), one(packed(raw)), one(packed(trained)), one(packed(codes)),
                     lists(pa.array(ends.astype(np.int64))), lists(b.column("doc_id")), lists(pa.array(held)), pa.array([len(codes)]), pa.array([len(ids)])], names=names)
                number += 1

    names = [part.split()[0] for part in CODED.split(", ")]
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, CODED.format(kind))


# --- questions and answers ----------------------------------------------------

def range_of(ids: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each mixed fingerprint, in the order of the fingerprints."""
    return (((ids >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _cut(where: np.ndarray):
    """(range, start, end) of each run of equal values."""
    begin = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else np.zeros(0, np.int64)
    return [(int(where[s]), int(s), int(e)) for s, e in zip(begin, np.append(begin[1:], len(where)))]


def _chunk_row(b, i: int):
    read = lambda name: b.column(name)[i].as_py()
    return read("chunk"), restored(read("ids")), unpacked(read("codes"), np.int32), np.array(read("ends")), np.array(read("held_out"), dtype=bool)


def _parts(cuts, chunk: int, columns: dict) -> pa.RecordBatch:
    """One row (part, chunk, ...) for each range that a chunk has entries in."""
    data = {"part": pa.array([r for r, _, _ in cuts], pa.int64()), "chunk": pa.array([chunk] * len(cuts), pa.int64())}
    return pa.RecordBatch.from_pydict(data | {name: pa.array([cut(s, e) for _, s, e in cuts], pa.binary()) for name, cut in columns.items()})


# A range of words: fingerprints, sizes, bytes, training counts; the sum of the
# counts, and how many words have one.
WORDS = "part long, ids binary, sizes binary, spelled binary, c binary, total long, known long"


def _schema(kinds: str) -> pa.Schema:
    return pa.schema([(n, pa.binary() if kind == "binary" else pa.int64()) for n, kind in (x.split() for x in kinds.split(", "))])


def _words_row(part: int, ids, size, raw, c: np.ndarray) -> pa.Table:
    row = {"part": part, "ids": steps(ids), "sizes": packed(size), "spelled": packed(raw), "c": packed(c), "total": int(c.sum()), "known": int((c > 0).sum())}
    return pa.Table.from_pylist([row], schema=_schema(WORDS))


def packed_words(vocabulary: DataFrame) -> DataFrame:
    """Rows (id, word, c) as one range of words."""
    @trimmed
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().to_batches()[0]
        size, raw, c = _columns(rows)
        ids = rows.column("id").to_numpy().view(np.uint64)
        order = np.argsort(ids)
        return _words_row(0, ids[order], size[order], gathered(raw, (np.cumsum(size) - size)[order], size[order]), c[order])

    return vocabulary.select("id", "word", "c", F.lit(0).alias("part")).groupBy("part").applyInArrow(run, WORDS)


def word_rows(words: DataFrame) -> DataFrame:
    """(id, c, ts, ps): the words of :func:`fit`, a row each."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, c = restored(b.column("ids")[i].as_py()), _longs(b.column("c")[i].as_py())
                ts, ps = (np.stack([unpacked(x, kind) for x in b.column(name)[i].as_py()], 1) for name, kind in (("ts", np.int64), ("ps", np.float32)))
                lists = lambda x: pa.array(list(x))
                yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(c), lists(ts), lists(ps)], names=["id", "c", "ts", "ps"])

    return words.mapInArrow(run, "id long, c long, ts array<long>, ps array<float>")


def count_words(chunks: DataFrame, ranges: int) -> DataFrame:
    """A row for each range of words, see ``WORDS``."""
    @tidy("pitmanyor")
    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                read = lambda name, kind: unpacked(b.column(name)[i].as_py(), kind)
                ids, size, raw, trained = restored(b.column("ids")[i].as_py()), read("sizes", np.int64), read("spelled", np.uint8), read("trained", np.int64)
                at = np.append(0, np.cumsum(size))
                yield _parts(_cut(range_of(ids, ranges)), b.column("chunk")[i].as_py(),
                             {"ids": lambda s, e: steps(ids[s:e]), "sizes": lambda s, e: packed(size[s:e]), "spelled": lambda s, e: packed(raw[at[s]:at[e]]), "n": lambda s, e: packed(trained[s:e])})

    @trimmed
    def count(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        ids, size, n = _all(rows["ids"], restored, np.uint64), _all(rows["sizes"], _longs, np.int64), _all(rows["n"], _longs, np.int64)
        raw = _all(rows["spelled"], lambda x: unpacked(x, np.uint8), np.uint8)
        own, first, place = np.unique(ids, return_index=True, return_inverse=True)
        return _words_row(rows["part"][0].as_py(), own, size[first], gathered(raw, (np.cumsum(size) - size)[first], size[first]), np.bincount(place, n, minlength=len(own)).astype(np.int64))

    asked = chunks.select("chunk", "ids", "sizes", "spelled", "trained").mapInArrow(ask, "part long, chunk long, ids binary, sizes binary, spelled binary, n binary")
    return asked.groupBy("part").applyInArrow(count, WORDS)


def count_pairs(chunks: DataFrame, ranges: int) -> DataFrame:
    """(chunk, part, counts): the training counts of a chunk's distinct pairs of a
    range, doubled; 1 more where the chunk is the pair's owner."""
    @tidy("pitmanyor")
    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                chunk, ids, codes, ends, held = _chunk_row(b, i)
                pair, _, _, place = chunk_pairs(ids, codes)
                n = np.bincount(place, np.repeat(~held, np.diff(ends, prepend=0)), minlength=len(pair)).astype(np.int64)
                yield _parts(_cut(range_of(pair, ranges)), chunk, {"pairs": lambda s, e: steps(pair[s:e]), "n": lambda s, e: packed(n[s:e])})

    @trimmed
    def count(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        pairs = [restored(x) for x in rows["pairs"].to_pylist()]
        ends = np.cumsum([len(x) for x in pairs])
        _, first, place = np.unique(np.concatenate(pairs), return_index=True, return_inverse=True)
        counts = 2 * np.bincount(place, _all(rows["n"], _longs, np.int64), minlength=len(first)).astype(np.int64)[place]
        counts[first] += 1
        return pa.table({"chunk": rows["chunk"], "part": rows["part"], "counts": pa.array([packed(counts[s:e]) for s, e in zip(np.append(0, ends[:-1]), ends)], pa.binary())})

    return chunks.select("chunk", "ids", "codes", "ends", "held_out").mapInArrow(ask, "part long, chunk long, pairs binary, n binary").groupBy("part").applyInArrow(count, "chunk long, part long, counts binary")


# Pairs that occur twice or more in training, at their owner: fingerprints of their
# words, places in these of the previous word and the word, counts; the sum of the
# counts and how many are 2.
OWNED = "chunk long, ids binary, u binary, w binary, c binary, inside long, twice long"


def _owned_row(chunk: int, ids, u, w, c: np.ndarray) -> pa.Table:
    used, at = np.unique(np.concatenate([u, w]), return_inverse=True)
    u, w = at[:len(u)].astype(np.int32), at[len(u):].astype(np.int32)
    order = np.lexsort((w, u))
    return pa.Table.from_pylist([{"chunk": chunk, "ids": steps(ids[used]), "u": packed(u[order]), "w": packed(w[order]), "c": packed(c[order]), "inside": int(c.sum()), "twice": int((c == 2).sum())}],
                                schema=_schema(OWNED))


def owned_pairs(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each chunk's own repeated pairs."""
    @trimmed
    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        chunk, ids, codes, _, _ = _chunk_row(own, 0)
        _, u, w, _ = chunk_pairs(ids, codes)
        counts = _all(got.sort_by("part")["counts"], _longs, np.int64)
        at = np.flatnonzero((counts & 1 == 1) & (counts > 3))
        return _owned_row(chunk, ids, u[at], w[at], counts[at] >> 1)

    return chunks.select("chunk", "ids", "codes", "ends", "held_out").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, OWNED)


def packed_pairs(repeated: DataFrame) -> DataFrame:
    """Rows (u, w, c) of distinct pairs as tables of owned pairs, one a batch."""
    def run(batches):
        task = TaskContext.get().partitionId()
        for number, b in enumerate(batches):
            u, w, c = (b.column(x).to_numpy() for x in "uwc")
            ids, at = np.unique(np.concatenate([u, w]).view(np.uint64), return_inverse=True)
            yield from _owned_row((task << 32) + number, ids, at[:len(u)], at[len(u):], c).to_batches()

    return repeated.select("u", "w", "c").mapInArrow(run, OWNED)


# --- restaurants -------------------------------------------------------------

def _uniform(state: np.ndarray) -> np.ndarray:
    return (mix(state) >> np.uint64(11)).astype(float) / float(1 << 53)


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, state: np.ndarray) -> np.ndarray:
    """Tables that each dish's customers open when they come in one after
    another: the next one opens a table with probability weight / (seated -
    discount * tables + weight), ``weight`` being that of a new table.

    From the 128th customer on they come in parties of 1/64 of those seated,
    for which that probability is held fixed and the number of new tables
    drawn at once. ``state`` seeds each dish's own random numbers.
    """
    tables = np.minimum(customers, 1).astype(float)
    order = np.flatnonzero(customers > 1)
    order = order[np.argsort(-customers[order], kind="stable")]  # those still to seat stay in front
    n, own, w, z = customers[order], tables[order], weight[order], state[order]
    fewer, live, seated = -n, len(n), 1
    with np.errstate(over="ignore"):
        while live:
            t, size = own[:live], max(1, seated // 64)
            p = w[:live] / (seated - discount * t + w[:live])
            u = _uniform(z[:live] + np.uint64(2 * seated))
            if seated < 128:
                t += u < p
            else:
                party = np.minimum(size, n[:live] - seated)
                mean = party * p
                v = _uniform(z[:live] + np.uint64(2 * seated + 1))
                normal = np.sqrt(-2 * np.log1p(-u)) * np.cos(2 * np.pi * v)
                new = np.clip(np.rint(mean + normal * np.sqrt(mean * (1 - p))), 0, party)
                rare = np.flatnonzero(mean < 9)
                if len(rare):  # Poisson by inversion
                    k, term = np.zeros(len(rare)), np.exp(-mean[rare])
                    total = term.copy()
                    for i in range(1, 40):
                        more = u[rare] > total
                        if not more.any():
                            break
                        k += more
                        term = term * mean[rare] / i
                        total = total + term
                    new[rare] = np.minimum(k, party[rare])
                t += new
            seated += size
            live = int(np.searchsorted(fewer[:live], -seated))
    tables[order] = own
    return tables.astype(np.int64)


class Spelling:
    """Log probabilities of the next symbol by context: a row per context of
    two bytes that was seen, before them a row per last byte."""

    def __init__(self, row_of: np.ndarray, log_table: np.ndarray):
        self.row_of, self.log_table = row_of, log_table

    @staticmethod
    def uniform() -> "Spelling":
        return Spelling(np.tile(np.arange(CONTEXTS, dtype=np.int32), CONTEXTS), np.full((CONTEXTS, SYMBOLS), -np.log(SYMBOLS)))

    @staticmethod
    def sampled(cell: np.ndarray, customers: np.ndarray, before: "Spelling", tables_before: dict, seed: int) -> tuple["Spelling", dict]:
        """One Gibbs pass up the byte restaurants, given the customers of each
        (context, symbol) cell, and the predictive probabilities it leaves."""
        levels, tables = [], {}
        state = mix(np.uint64(seed))
        for level in (2, 1, 0):
            context, symbol = cell // SYMBOLS, cell % SYMBOLS
            size = CONTEXTS ** level
            if level:
                parent = before.parents[level - 1].reshape(-1, SYMBOLS)[context % CONTEXTS ** (level - 1), symbol]
            else:
                parent = np.full(len(cell), 1.0 / SYMBOLS)
            opened = tables_before.get(level, np.zeros(size))[context]
            with np.errstate(over="ignore"):
                t = seat(customers, (STRENGTH + BYTE_DISCOUNT * opened) * parent, BYTE_DISCOUNT, mix(cell.astype(np.uint64) * np.uint64(4) + np.uint64(level) + state))
            tables[level] = np.bincount(context, t, minlength=size)
            levels.append((cell, customers, t))
            above = (context % CONTEXTS ** max(level - 1, 0)) * SYMBOLS + symbol
            cell, where = np.unique(above, return_inverse=True)
            customers = np.bincount(where, t, minlength=len(cell)).astype(np.int64)
        probability = np.full((1, SYMBOLS), 1.0 / SYMBOLS)
        parents = []
        for level, (cell, n, t) in zip((0, 1), levels[:0:-1]):
            context, size = cell // SYMBOLS, CONTEXTS ** level
            total = np.bincount(context, n, minlength=size)
            share = (STRENGTH + BYTE_DISCOUNT * tables[level]) / (STRENGTH + total)
            probability = share[:, None] * probability[np.zeros(size, np.int64) if level == 1 else slice(None)]
            probability[context, cell % SYMBOLS] += (n - BYTE_DISCOUNT * t) / (STRENGTH + total[context])
            parents.append(probability)
        cell, n, t = levels[0]
        seen, where = np.unique(cell // SYMBOLS, return_inverse=True)
        total, opened = np.bincount(where, n, minlength=len(seen)), np.bincount(where, t, minlength=len(seen))
        rows = ((STRENGTH + BYTE_DISCOUNT * opened) / (STRENGTH + total))[:, None] * probability[seen % CONTEXTS]
        rows[where, cell % SYMBOLS] += (n - BYTE_DISCOUNT * t) / (STRENGTH + total[where])
        row_of = np.tile(np.arange(CONTEXTS, dtype=np.int32), CONTEXTS)
        row_of[seen] = CONTEXTS + np.arange(len(seen))
        out = Spelling(row_of, np.log(np.concatenate([probability, rows])))
        out.parents = parents
        return out, tables

    def symbols(self, size: np.ndarray, raw: np.ndarray):
        """(context, symbol, first) of every symbol of the words, each ended."""
        begin = np.cumsum(size + 1) - (size + 1)
        symbol = np.full(len(raw) + len(size), END)
        inside = np.ones(len(symbol), dtype=bool)
        inside[begin + size] = False
        symbol[inside] = raw
        one, two = np.full(len(symbol), START), np.full(len(symbol), START)
        one[1:] = symbol[:-1]
        two[2:] = symbol[:-2]
        one[begin] = two[begin] = START
        two[(begin + 1)[size > 0]] = START
        return two * CONTEXTS + one, symbol, begin

    def logs(self, size: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Log probability of each word's spelling."""
        context, symbol, begin = self.symbols(size, raw)
        return np.add.reduceat(self.log_table[self.row_of[context], symbol], begin) if len(size) else np.zeros(0)


Spelling.parents = [np.full((1, SYMBOLS), 1.0 / SYMBOLS), np.full((CONTEXTS, SYMBOLS), 1.0 / SYMBOLS)]


def word_states(size: np.ndarray, raw: np.ndarray, sweep: int) -> np.ndarray:
    """A random state of each word for a sweep, from its bytes."""
    begin = np.cumsum(size) - size
    inside = np.arange(len(raw)) - np.repeat(begin, size)
    with np.errstate(over="ignore"):
        parts = np.append(mix(raw.astype(np.uint64) + np.uint64(256) * inside.astype(np.uint64)), np.uint64(0))
        total = np.add.reduceat(parts, np.minimum(begin, len(parts) - 1))
        total[size == 0] = 0
        return mix(total + np.uint64(SEED * 1000 + sweep))


class Words:
    """The word restaurant and the discounts of words and of pairs, estimated from
    the numbers of dishes with one and with two customers."""

    def __init__(self, words: tuple[int, int], pairs: tuple[int, int]):
        self.customers = 0
        self.discount, self.pair_discount = (float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.95)) for once, twice in (words, pairs))

    def pair_tables(self, u, w, c: np.ndarray, opened: np.ndarray, lp: np.ndarray, sweep: int) -> np.ndarray:
        """Tables of pairs, given those of the previous word's restaurant and the
        log probability of the word in the sweep before."""
        weight = (STRENGTH + self.pair_discount * opened.astype(np.float32).astype(float)) * np.exp(lp.astype(np.float32).astype(float))
        with np.errstate(over="ignore"):
            return seat(c, weight, self.pair_discount, mix(pair_id(u, w) + np.uint64(SEED * 1000 + sweep)))

    def tables(self, n: np.ndarray, log_spelling: np.ndarray, opened: float, state: np.ndarray) -> np.ndarray:
        return seat(n, (STRENGTH + self.discount * opened) * np.exp(log_spelling), self.discount, state)

    def log_probability(self, n: np.ndarray, t: np.ndarray, log_spelling: np.ndarray, opened: float) -> np.ndarray:
        total = STRENGTH + self.customers
        with np.errstate(divide="ignore"):
            own = np.log(np.where(n > 0, n - self.discount * t, 0.0) / total)
        return np.logaddexp(own, np.log((STRENGTH + self.discount * opened) / total) + log_spelling)


def _columns(batch):
    words = batch.column("word").cast(pa.large_binary())
    off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    return np.diff(off), data[off[0]:off[-1]], batch.column("c").to_numpy(zero_copy_only=False).astype(np.int64)


def _spelled(read):
    """(size, bytes, counts) of a range of words."""
    return unpacked(read("sizes"), np.int64), unpacked(read("spelled"), np.uint8), unpacked(read("c"), np.int64)


SUMS = "part long, chunk long, ids binary, sums binary"


def _owned(b, i: int):
    read = lambda name, kind: unpacked(b.column(name)[i].as_py(), kind)
    return b.column("chunk")[i].as_py(), restored(b.column("ids")[i].as_py()), read("u", np.int32), read("w", np.int32), read("c", np.int64)


def _sums(chunk: int, ids: np.ndarray, ranges: int, sums: list) -> pa.RecordBatch:
    sums = np.array(sums).astype(np.int64)
    return _parts(_cut(range_of(ids, ranges)), chunk, {"ids": lambda s, e: steps(ids[s:e]), "sums": lambda s, e: packed(sums[:, s:e])})


def pair_sums(owned: DataFrame, ranges: int) -> DataFrame:
    """By word: the counts and numbers of the repeated pairs that it begins (cu, ou) and ends (cw, ow)."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                chunk, ids, u, w, c = _owned(b, i)
                yield _sums(chunk, ids, ranges, [np.bincount(u, c, len(ids)), np.bincount(w, c, len(ids)), np.bincount(u, minlength=len(ids)), np.bincount(w, minlength=len(ids))])

    return owned.mapInArrow(run, SUMS)


def seated_sums(owned: DataFrame, words: DataFrame, ranges: int, restaurant: Words, sweep: int) -> DataFrame:
    """By word: the tables of the repeated pairs that it begins (tu) and ends (tw)."""
    shared = Shipped(words.sparkSession, restaurant)
    told = word_answers(owned, words.select("part", "ids", "c", F.slice("ts", -1, 1).alias("ts"), F.slice("ps", -1, 1).alias("ps")), ranges)

    @trimmed
    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        chunk, ids, u, w, c = _owned(own, 0)
        _, x = _answered(got, 2)
        seats = shared.value.pair_tables(ids[u], ids[w], c, x[0, u], x[1, w], sweep)
        return pa.Table.from_batches([_sums(chunk, ids, ranges, [np.bincount(u, seats, len(ids)), np.bincount(w, seats, len(ids))])])

    return owned.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, SUMS)


# A range of words in a sweep: customers that only one pair gives as previous word
# (single_u) and as word (single_w); tables by state (ts) and log probabilities (ps);
# the customers n of the word restaurant, its tables t and theirs by byte cell.
HELD = "part long, ids binary, sizes binary, spelled binary, c binary, single_u binary, single_w binary, ts array<binary>, ps array<binary>"
SEATED = f"{HELD}, n binary, t binary, cells binary, tables binary, once long, twos long, customers long"


def seated_words(words: DataFrame, sums: DataFrame, restaurant: Words | None, state: tuple, sweep: int) -> DataFrame:
    """The word restaurant of a sweep, its customers being the tables of the pairs."""
    shared = Shipped(words.sparkSession, (restaurant, *state))  # bounded by the byte alphabet
    names = [x.split()[0] for x in SEATED.split(", ")]
    schema = pa.schema([(n, pa.list_(pa.binary()) if n in ("ts", "ps") else pa.int64() if n in ("part", "once", "twos", "customers") else pa.binary()) for n in names])

    @trimmed
    def run(known: pa.Table, got: pa.Table) -> pa.Table:
        own, spell, opened = shared.value
        row = {name: x[0] for name, x in known.to_pydict().items()}
        ids, (size, raw, c) = restored(row["ids"]), _spelled(row.get)
        total = np.zeros((2 if sweep else 4, len(ids)), np.int64)
        for asked, amounts in zip(got["ids"].to_pylist(), got["sums"].to_pylist()):
            total[:, np.searchsorted(ids, restored(asked))] += _longs(amounts).reshape(len(total), -1)
        if not sweep:
            row |= {"single_u": packed(c - total[0]), "single_w": packed(c - total[1]), "ts": [], "ps": []}
        tables, n = _longs(row["single_u"]) + total[-2], _longs(row["single_w"]) + total[-1]
        live = np.flatnonzero(c > 0)
        lsize, lraw, ln = size[live], gathered(raw, (np.cumsum(size) - size)[live], size[live]), n[live]
        t = own.tables(ln, spell.logs(lsize, lraw), opened, word_states(lsize, lraw, sweep)) if sweep else np.minimum(ln, 1)
        ctx, symbol, _ = spell.symbols(lsize, lraw)
        cell, where = np.unique(ctx * SYMBOLS + symbol, return_inverse=True)
        count = np.bincount(where, np.repeat(t, lsize + 1), minlength=len(cell)).astype(np.int64)
        everyone = np.zeros(len(ids), np.int64)
        everyone[live] = t
        row |= {"ts": [*row["ts"], packed(tables)], "n": packed(n), "t": packed(everyone), "cells": packed(np.append(cell, -1)), "tables": packed(np.append(count, t.sum())),
                "once": int((ln == 1).sum()), "twos": int((ln == 2).sum()), "customers": int(ln.sum())}
        return pa.Table.from_pylist([{name: row[name] for name in names}], schema=schema)

    return words.groupBy("part").cogroup(sums.groupBy("part")).applyInArrow(run, SEATED)


def byte_cells(seated: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the word restaurant by byte cell (bounded by the byte alphabet), their number under -1."""
    def run(batches):
        for b in batches:
            for cells, tables in zip(b.column("cells").to_pylist(), b.column("tables").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(_longs(cells)), pa.array(_longs(tables))], names=["cell", "n"])

    got = seated.select("cells", "tables").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
    return got["cell"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def with_probability(seated: DataFrame, restaurant: Words, spelling: Spelling, opened: int) -> DataFrame:
    """Words with the log probability that the word restaurant's state gives them."""
    shared = Shipped(seated.sparkSession, (restaurant, spelling, opened))

    @tidy("pitmanyor")
    def run(batches):
        own, spell, tables = shared.value
        for b in batches:
            ps = []
            for i in range(b.num_rows):
                read = lambda name: b.column(name)[i].as_py()
                size, raw, _ = _spelled(read)
                p = own.log_probability(unpacked(read("n"), np.int64), unpacked(read("t"), np.int64), spell.logs(size, raw), tables)
                ps.append([*read("ps"), packed(p.astype(np.float32))])
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.list_(pa.binary())) if name == "ps" else b.column(name) for name in names], names=names)

    names = [x.split()[0] for x in HELD.split(", ")]
    return seated.select(*names, "n", "t").mapInArrow(run, HELD)


def fit(vocabulary: DataFrame, owned: DataFrame, ranges: int = 1, burn_in: int = BURN_IN, samples: int = SAMPLES):
    """(restaurants, words, log probability of the unknown word in each state).

    ``vocabulary`` holds the ranges of words (:func:`count_words`), ``owned`` the
    pairs of two or more (:func:`owned_pairs`). ``words`` holds in each state the
    tables of each word's own restaurant (as the previous word) and its log
    probability (:func:`word_rows`). State 0 has one table a pair; a sweep leads
    from each state to the next."""
    spark = vocabulary.sparkSession
    total = vocabulary.agg(F.sum("total")).first()[0] or 0
    inside, twice = owned.agg(F.sum("inside"), F.sum("twice")).first()
    pairs = (int(total) - int(inside or 0), int(twice or 0))
    words, restaurant, state, byte_tables, states = None, None, (Spelling.uniform(), 0), {}, []
    for sweep in range(1 + burn_in + samples):
        sums = seated_sums(owned, words, ranges, restaurant, sweep) if sweep else pair_sums(owned, ranges)
        now = materialised(seated_words(words if sweep else vocabulary, sums, restaurant, state, sweep), "seated")
        once, twos, customers = now.agg(F.sum("once"), F.sum("twos"), F.sum("customers")).first()
        restaurant = restaurant or Words((int(once or 0), int(twos or 0)), pairs)
        restaurant.customers = int(customers or 0)
        cell, count = byte_cells(now)
        opened = int(count[cell == -1].sum())
        spelling, byte_tables = Spelling.sampled(cell[cell >= 0], count[cell >= 0], state[0], byte_tables, SEED + sweep)
        before, words = words, materialised(with_probability(now, restaurant, spelling, opened), "words")
        state = (spelling, opened)
        states.append((spelling, opened, restaurant.customers))
        for done in (now, before):
            if done is not None:
                discard(done)
        del sums, now, before, done
        release(spark)
    left = unknown_mass(vocabulary, [s for s, _, _ in states])
    unknown = []
    for share, (_, opened, customers) in zip(left, states):
        restaurant.customers = customers
        unknown.append(float(restaurant.log_probability(np.zeros(1), np.zeros(1), np.log([share]), opened)[0]))
    return restaurant, words, unknown


def unknown_mass(vocabulary: DataFrame, states: list) -> np.ndarray:
    """For each state, the share of the spelling's probability that is left to
    words with c = 0."""
    shared = Shipped(vocabulary.sparkSession, states)

    def run(batches):
        spells = shared.value
        total = np.zeros(len(spells))
        for b in batches:
            for i in range(b.num_rows):
                size, raw, c = _spelled(lambda name: b.column(name)[i].as_py())
                total += [np.exp(spell.logs(size, raw))[c > 0].sum() for spell in spells]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["state", "p"])

    known = vocabulary.select("sizes", "spelled", "c").mapInArrow(run, "state long, p double").groupBy("state").agg(F.sum("p").alias("p")).toPandas()
    return np.maximum(1.0 - np.bincount(known["state"], known["p"], minlength=len(states)), 1e-12)


def word_answers(askers: DataFrame, words: DataFrame, ranges: int) -> DataFrame:
    """(chunk, part, cs, xs): for the words of a chunk in a range their counts,
    and as 32-bit floats the tables and log probabilities that ``words`` holds."""
    @tidy("pitmanyor")
    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids = restored(b.column("ids")[i].as_py())
                yield _parts(_cut(range_of(ids, ranges)), b.column("chunk")[i].as_py(), {"ids": lambda s, e: steps(ids[s:e])})

    @trimmed
    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        row, cs, xs = {name: x[0] for name, x in known.to_pydict().items()}, [], []
        ids, c = restored(row["ids"]), _longs(row["c"])
        x = np.stack([*[_longs(t).astype(np.float32) for t in row["ts"]], *[unpacked(p, np.float32) for p in row["ps"]]])
        for raw in asked["ids"].to_pylist():
            at = np.searchsorted(ids, restored(raw))
            cs.append(packed(c[at]))
            xs.append(packed(x[:, at]))
        return pa.table({"chunk": asked["chunk"], "part": asked["part"], "cs": pa.array(cs, pa.binary()), "xs": pa.array(xs, pa.binary())})

    asked = askers.select("chunk", "ids").mapInArrow(ask, "part long, chunk long, ids binary")
    return asked.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(answer, "chunk long, part long, cs binary, xs binary")


def _answered(got: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and floats (a row each float) of a chunk's words, in their order."""
    got = got.sort_by("part")
    xs = [unpacked(x, np.float32).reshape(width, -1) for x in got["xs"].to_pylist() if x is not None]
    return _all(got["cs"], _longs, np.int64), np.hstack([np.zeros((width, 0), np.float32), *xs])


def pair_log10(restaurant: Words, unknown: list, samples: int, u, w, c, cu, cw, tu, pw) -> np.ndarray:
    """log10 of P(w | u), averaged over the last ``samples`` states, of pairs of
    count ``c``, words of counts ``cu`` and ``cw``, tables ``tu`` and log
    probabilities ``pw`` (rows: those states and the one before; columns: pairs)."""
    first = len(unknown) - samples
    total, d = np.zeros(len(c)), restaurant.pair_discount
    many, t = np.flatnonzero(c > 1), np.minimum(c, 1)  # a single customer has one table
    for i in range(1, samples + 1):
        k = first + i - 1
        t[many] = restaurant.pair_tables(u[many], w[many], c[many], tu[i - 1, many], pw[i - 1, many], k)
        p = np.exp(np.where(cw > 0, pw[i].astype(float), unknown[k]))
        total += (np.where(c > 0, c - d * t, 0.0) + (STRENGTH + d * tu[i].astype(float)) * p) / (STRENGTH + cu)
    return np.log10(total / samples)


def score(docs: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    (doc_id, text, held_out) rows; those not held out train the model."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    with scratch(spark):
        chunks = materialised(coded(docs), "coded")
        entries, asked = chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
        ranges = -(-asked // RANGE_WORDS) or 1
        vocabulary = materialised(count_words(chunks, ranges), "vocabulary")
        n, v = vocabulary.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
        release(spark)
        answers = materialised(count_pairs(chunks, -(-entries // RANGE_ENTRIES) or 1), "answers")
        release(spark)
        owned = materialised(owned_pairs(chunks, answers), "owned")
        release(spark)
        restaurant, words, unknown = fit(vocabulary, owned, ranges, burn_in, samples)
        last = lambda name: F.slice(name, -(samples + 1), samples + 1)
        release(spark)
        told = word_answers(chunks, words.select("part", "ids", "c", last("ts").alias("ts"), last("ps").alias("ps")), ranges)
        shared = Shipped(spark, (restaurant, unknown))

        @trimmed
        def run(own: pa.Table, got: pa.Table) -> pa.Table:
            model, none = shared.value
            _, fingers, codes, ends, held = _chunk_row(own, 0)
            _, before, word, place = chunk_pairs(fingers, codes)
            c = _all(got.sort_by("part")["counts"], _longs, np.int64) >> 1
            cw, x = _answered(got, 2 * (samples + 1))
            lp = np.empty(len(c))
            for at in range(0, len(c), BLOCK):
                u, w = before[at:at + BLOCK], word[at:at + BLOCK]
                lp[at:at + BLOCK] = pair_log10(model, none, samples, fingers[u], fingers[w], c[at:at + BLOCK], cw[u], cw[w], x[:samples + 1, u], x[samples + 1:, w])
            start = np.append(0, ends[:-1])
            sums = lambda x: pa.array(np.add.reduceat(x, start))
            base = np.log10((cw + 1) / float(n + v + 1))
            return pa.table([own["doc_id"].combine_chunks().flatten(), pa.array(held), pa.array(np.diff(ends, prepend=0)), sums((cw[codes] > 0).astype(np.int64)),
                             pa.array(np.full(len(ends), n, np.int64)), sums(base[codes]), sums(lp[place])], names=names)

        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        none = F.lit(None).cast("binary")
        back = answers.withColumns({"cs": none, "xs": none}).unionByName(told.withColumn("counts", none))
        own = chunks.select("chunk", "ids", "codes", "ends", "doc_id", "held_out")
        scored = own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, schema)
        return materialised(scored, "scores", keep=True)


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, tokens, perplexity per token of the model and of the base."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), power("score").alias("perplexity"), power("base_score").alias("base_perplexity"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.withColumn("held_out", remainder("doc_id", 7) == 2))
