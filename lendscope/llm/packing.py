"""Packing token sequences by best-fit decreasing.

Documents are tokenised, ended with one id, and cut into full windows plus a
rest. A full window is a sequence of its own. The rests are dealt into groups
of bounded size; each group sorts its pieces by length, longest first, and puts each into the open window with the
least room that still holds it, found in a segment tree over remaining room.

Defined results: a null or empty text is the end id alone; a null doc_id is
kept as it is; repeated rows are packed each; an empty table gives no pieces;
other columns are ignored. Every id lies in exactly one piece, pieces of one
sequence follow each other from offset 0 without gaps.
"""

from __future__ import annotations

import os
import unicodedata
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised, small_batches, table, tidy, worker_cache

WINDOW = 4096
END_ID = 2
GROUP_DOCS = 50_000
# Smaller tables are dealt to up to SMALL_GROUPS groups of SMALL_DOCS.
SMALL_GROUPS, SMALL_DOCS = 32, 1000
FULL = 1 << 62  # sequence ids of full windows start here
CACHE_WORDS = 1_000_000
ENDS = ".,;:!?"
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts, each distinct space-separated word encoded once.

    Exact for tokenizers that lower case and never let a piece span white
    space, or letters and the punctuation after them: neither normalisation
    nor merges then reach across. New words are encoded many at a time, and
    the ids told apart by their offsets.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {"": b""}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def learn(self, words: set[str]) -> None:
        ended = {}
        for w in words:
            stem = w.rstrip(ENDS)
            if stem != w and stem and stem.lower()[-1].isalpha():
                ended[w] = stem
        self._encode_all([w for w in (words - ended.keys()).union(ended.values()).union(w[len(s):] for w, s in ended.items()) if w not in self.ids])
        self.ids.update((w, self.ids[s] + self.ids[w[len(s):]]) for w, s in ended.items())

    def _encode_all(self, words: list[str]) -> None:
        plain = lambda w: w.isascii() or (unicodedata.is_normalized("NFC", w) and not unicodedata.combining(w[0]))
        self.ids.update((w, self.encode(w).tobytes()) for w in words if not plain(w))  # offsets are not theirs
        words = [w for w in words if plain(w)]
        groups = [words[at:at + 500] for at in range(0, len(words), 500)]
        for some, enc in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            size = np.array([len(w) + 1 for w in some])
            begin = np.cumsum(size) - size
            at = np.fromiter((o[0] for o in enc.offsets), np.int64, len(enc))
            edges = (4 * np.searchsorted(at, np.append(begin, begin[-1] + size[-1]))).tolist()
            raw = np.array(enc.ids, dtype="<u4").tobytes()
            self.ids.update((w, raw[lo:hi]) for w, lo, hi in zip(some, edges, edges[1:]))

    def __call__(self, texts: list) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (None: no ids)."""
        texts = [t.lower() if t and t.isascii() else t or "" for t in texts]  # as the tokenizer does
        words = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.ids) > CACHE_WORDS:
            self.ids = {"": b""}
        self.learn(set().union(*words).difference(self.ids))
        get = self.ids.__getitem__
        return [b"".join(map(get, ws)) for ws in words]


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this process for ``path``: the words learned in one task
    serve the worker's next one, until it turns to another operator."""
    kept = worker_cache("packing")
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]


def pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY, digest: bool = False) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (binary, little-endian unsigned
    32-bit): the full windows and the rest of every document. With ``digest``,
    the CRC-32 of the ids as ids_crc32 in their place."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    @tidy("packing")
    def cut(batches):
        encode = worker_tokenizer(vocabulary_path(vocabulary))
        for whole in batches:
            for batch in small_batches(whole, "text", 4 << 20):
                row, start, total, ids = [], [], [], []
                for i, own in enumerate(encode(batch.column("text").to_pylist())):
                    own += end
                    for at in range(0, len(own), 4 * window):
                        row.append(i)
                        start.append(at // 4)
                        total.append(len(own) // 4)
                        ids.append(own[at:at + 4 * window])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(total, pa.int64()),
                     pa.array([crc32(x) for x in ids], pa.int64()) if digest else pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids_crc32" if digest else "ids"])

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {id_type}, start long, length long, doc_tokens long, {'ids_crc32 long' if digest else 'ids binary'}")


class RoomTree:
    """Segment tree over remaining room 0..size-1; a node counts the open
    windows below it. ``tightest(r)`` is the least room >= r with a window."""

    def __init__(self, size: int):
        self.leaves = 1 << (size - 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open = [[] for _ in range(size)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def push(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def pop(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()

    def tightest(self, room: int) -> int:
        i = room + self.leaves
        if self.count[i]:
            return room
        while i > 1:  # up to the first right sibling with windows, then down its left edge
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths, window: int) -> tuple[list[int], list[int]]:
    """(window number, offset) of each length, given longest first."""
    tree, number, offset, opened = RoomTree(window + 1), [], [], 0
    for n in lengths:
        room = tree.tightest(n)
        if room < 0:
            at, room, opened = opened, window, opened + 1
        else:
            at = tree.pop(room)
        number.append(at)
        offset.append(window - room)
        if room > n:
            tree.push(room - n, at)
    return number, offset


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds sequence_id and offset to piece rows (any columns besides length).

    A full window is a sequence of its own. The other pieces, at most one a
    document, are dealt to groups by a salted hash, so rows that agree in every
    column spread too; a group is one task's unit, of about ``GROUP_DOCS`` at most.
    """
    cut = materialised(cut, "pieces")
    full, rest = cut.where(F.col("length") == window), cut.where(F.col("length") < window)
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(group_count(rest.count())))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("length", ascending=False, kind="stable").reset_index(drop=True)
        number, offset = best_fit_decreasing(pdf["length"].tolist(), window)
        first = int(pdf["_group"].iloc[0]) << 32
        return pdf.drop(columns="_group").assign(sequence_id=[first + n for n in number], offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    filled = rest.withColumn("_group", group).groupBy("_group").applyInPandas(fill, schema)
    return filled.unionByName(full.withColumn("sequence_id", F.lit(FULL) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")))


def group_count(rows: int, group_docs: int = GROUP_DOCS) -> int:
    return max(1, -(-rows // group_docs), min(SMALL_GROUPS, rows // SMALL_DOCS))


def packed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The packed pieces with their ids: doc_id, start, length, doc_tokens,
    ids, sequence_id, offset."""
    return pack(pieces(docs, window), window)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the ids of each sequence's pieces in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one window of ids
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"),
                                             F.concat_ws("", F.transform(parts, lambda x: F.hex(x["ids"]))).alias("h")) \
        .select("sequence_id", "length", F.unhex("h").alias("ids"))


def digested(docs: DataFrame) -> DataFrame:
    """The packed pieces with a CRC-32 in place of the ids, so that only
    narrow rows are shuffled."""
    cut = pieces(docs, digest=True).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    return pack(cut)


def query(spark, sf_dir: str) -> DataFrame:
    return digested(table(spark, sf_dir, "documents"))
