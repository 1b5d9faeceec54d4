"""Conversation prefix trie in balanced parentheses, shard by shard.

Each conversation is a path of turns from the root; a node is a distinct
sequence of leading turns and its members are the conversations that start
with it. A node is named by a chained 128-bit digest of its turns, so only
narrow rows travel (no texts), and its member count, least member and
ends come from aggregates with partial sums.

Shards. A node with at most ``shard_members`` members whose parent has more is
the top of a shard subtree; subtrees are dealt to shards by the hash of their
top. Nodes above (the spines, which several shards share) have more members
than that, so they number less than rows / ``shard_members``; the default is the
square root of the rows, which bounds both the members of a subtree and the
spines by it. A node of one member whose parent has one, too, needs no shard:
its subtree is a chain without savings.

Within a shard the forest is one sequence of balanced parentheses. Its excess
is kept with minima and maxima per block, and ``findclose`` skips blocks whose
least excess is too high to hold the close; rank over "()" pairs counts leaves
and a cumulative array in open order gives the savings between open and close.
The totals of shard tops are summed by their parent and hang on the spines, which
form one more such sequence.

Scale: paths stream through tasks sorted by conversation with a running digest;
a shard holds its shared nodes and one more per conversation, about 100 bytes
each. Hot first turns are split over shards below them. The member ids that end
in one node are hashed in a stream, whatever their number.

Defined results: null role or text is empty; rows go by turn, null first, ties
by their digest; repeated rows are turns of their own; rows with a null conv_id
belong to no conversation and take no part; an empty table has no nodes;
columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialised, table

#: Nodes a shard holds on average.
SHARD_NODES = 50_000
#: Parentheses of a block of the excess index.
BLOCK = 64
_ROOT = b"\0" * 16


# --- balanced parentheses ----------------------------------------------------

class Parentheses:
    """A forest as a 0/1 sequence (1 opens), with excess minima and maxima per
    block and running counts of opens and of leaves ("()" pairs)."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits, block
        self.excess = np.cumsum(np.where(bits == 1, 1, -1), dtype=np.int64)
        starts = np.arange(0, len(bits), block)
        self.low = np.minimum.reduceat(self.excess, starts) if len(bits) else np.zeros(0, np.int64)
        self.high = np.maximum.reduceat(self.excess, starts) if len(bits) else np.zeros(0, np.int64)
        self.opens = np.concatenate([[0], np.cumsum(bits == 1)])
        pair = np.zeros(len(bits), bool)
        pair[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.leaves = np.concatenate([[0], np.cumsum(pair)])
        # minima over pairs of blocks, pairs of pairs, ...: the tree over blocks
        self.levels = [self.low]
        while len(self.levels[-1]) > 1:
            x = self.levels[-1]
            x = np.append(x, np.iinfo(np.int64).max) if len(x) % 2 else x
            self.levels.append(x.reshape(-1, 2).min(axis=1))

    def _next_block(self, block: int, goal: int) -> int:
        """The first block after ``block`` whose least excess reaches ``goal``.
        Excess moves by one, so a block reaches a goal below its start if its
        least does; walked up to a subtree that does, then down in it."""
        level, at = 0, block + 1
        while True:
            row = self.levels[level]
            if at < len(row) and row[at] <= goal:
                break
            if at % 2 == 0 and at + 1 < len(row) and row[at + 1] <= goal:
                at += 1
                break
            at, level = at // 2 + 1, level + 1
        while level:
            level, at = level - 1, at * 2
            if self.levels[level][at] > goal:
                at += 1
        return at

    def findclose(self, at: int) -> int:
        """The close of the open at ``at``: the first later place with one less excess."""
        goal = self.excess[at] - 1
        block = at // self.block
        inside = self.excess[at + 1:(block + 1) * self.block]
        hit = np.flatnonzero(inside == goal)
        if len(hit):
            return at + 1 + int(hit[0])
        block = self._next_block(block, goal)
        start = block * self.block
        return start + int(np.flatnonzero(self.excess[start:start + self.block] == goal)[0])


def encode(parents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, order) of the forest in which node i hangs on ``parents[i]`` (-1: a
    root): opens come in depth-first order, ``order`` names their nodes."""
    n = len(parents)
    by = np.argsort(parents, kind="stable")
    start = np.searchsorted(parents[by], np.arange(-1, n + 1))
    kids = lambda i: by[start[i + 1]:start[i + 2]]
    bits, order, at = np.zeros(2 * n, np.uint8), np.zeros(n, np.int64), 0
    stack = kids(-1)[::-1].tolist()
    seen = 0
    while stack:
        node = stack.pop()
        if node < 0:  # the close of an open
            at += 1
            continue
        bits[at] = 1
        order[seen] = node
        at, seen = at + 1, seen + 1
        stack.append(-1)
        if start[node + 2] > start[node + 1]:
            stack.extend(kids(node)[::-1].tolist())
    return bits, order


def subtree_sums(parents: np.ndarray, weights: np.ndarray, hanging_leaves: np.ndarray | None = None):
    """(children, leaves, sums) of every node's subtree, itself included.

    ``hanging_leaves`` are leaves below a node that are not in the forest: a
    node with some is no leaf itself. Its "()" pair, if it has one, is taken back.
    """
    n = len(parents)
    children = np.bincount(parents[parents >= 0], minlength=n)
    if n == 0:
        return children, children, weights
    bits, order = encode(parents)
    tree = Parentheses(bits)
    opens = np.flatnonzero(bits)
    closes = np.fromiter((tree.findclose(int(i)) for i in opens), np.int64, n)
    first = np.arange(n)                       # rank of the open in open order
    last = tree.opens[closes]                  # opens up to the close
    total = np.concatenate([[0], np.cumsum(weights[order])])
    leaves, sums = np.zeros(n, np.int64), np.zeros(n, weights.dtype)
    leaves[order] = tree.leaves[closes] - tree.leaves[opens]
    sums[order] = total[last] - total[first]
    if hanging_leaves is not None:
        change = np.where((children == 0) & (hanging_leaves > 0), hanging_leaves - 1, hanging_leaves)
        more = np.concatenate([[0], np.cumsum(change[order])])
        leaves[order] += more[last] - more[first]
    return children, leaves, sums


# --- paths -------------------------------------------------------------------

def _narrow(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, code (128 bits of the SHA-256 of role and text), words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = F.substring(F.unhex(F.sha2(F.concat_ws("\n", F.length(role).cast("string"), role, text), 256)), 1, 16)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), code.alias("code"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def taken_turns(conv) -> F.Column:
    """How many first turns a conversation takes from the first of its twenty."""
    return F.pmod(F.crc32(F.col(conv).cast("string")), F.lit(4)).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Narrow rows of the rebuilt conversations, in the order (conv_id, part,
    turn, code): part 0 are turns taken from the first of the twenty, part 1 the
    conversation's own, whose first ``skip`` are to be left out."""
    own = _narrow(conversations)
    base = lambda c: F.col(c) - F.col(c) % 20
    w = Window.partitionBy("conv_id").orderBy("turn", "code")
    heads = (own.where(F.col("conv_id") == base("conv_id")).withColumn("place", F.row_number().over(w))
                .where("place <= 3").select(F.col("conv_id").alias("base"), "place", "turn", "code", "words"))
    ids = own.select("conv_id").distinct().withColumn("base", base("conv_id"))
    given = (heads.join(ids, "base").where(F.col("place") <= taken_turns("conv_id"))  # at most 20 conversations a base
                  .select("conv_id", F.lit(0).alias("part"), "turn", "code", "words", F.lit(0).alias("skip")))
    return given.unionByName(own.select("conv_id", F.lit(1).alias("part"), "turn", "code", "words",
                                        taken_turns("conv_id").alias("skip")))


_PATH = "conv_id long, depth long, name binary, words long, ends boolean"


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, name, words, ends) of every node on each conversation's
    path, the root included, from rows as :func:`rebuilt` gives them."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]

    def walk(batches):
        now, left, depth, name, words = None, 0, 0, _ROOT, 0

        def batch(out):
            columns = list(zip(*out)) if out else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                              ["conv_id", "depth", "name", "words", "ends"])

        for b in batches:
            out = []
            for conv, part, code, size, skip in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "code", "words", "skip"))):
                if conv != now:
                    if now is not None:
                        out.append((now, depth, name, words, True))
                    now, left, depth, name, words = conv, None, 0, _ROOT, 0
                if part == 1:
                    left = skip if left is None else left
                    if left > 0:
                        left -= 1
                        continue
                out.append((now, depth, name, words, False))
                depth, name, words = depth + 1, hashlib.blake2b(name + code, digest_size=16).digest(), size
            yield batch(out)
        if now is not None:
            yield batch([(now, depth, name, words, True)])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "code")
    return ordered.mapInArrow(walk, _PATH)


def _ends(path: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes in which conversations end: a running
    digest of their ascending ids."""
    def read(batches):
        now, digest = None, None

        def batch(out):
            names, shas = zip(*out) if out else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(shas, pa.string())], ["name", "ends_sha256"])

        for b in batches:
            out = []
            for name, conv in zip(b.column("name").to_pylist(), b.column("conv_id").to_pylist()):
                if name != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = name, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield batch(out)
        if now is not None:
            yield batch([(now, digest.hexdigest())])

    last = path.where("ends").select("name", "conv_id")
    return last.repartition("name").sortWithinPartitions("name", "conv_id").mapInArrow(read, "name binary, ends_sha256 string")


# --- shards ------------------------------------------------------------------

_NODE = ["name", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "words", "n_ends", "ends_sha256"]
_NODE_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_SUMS = ["n_children", "n_leaves", "saved_tokens"]
_DONE = ("name binary, conv_id long, depth long, parent binary, parent_conv_id long, n_convs long, words long, "
         "n_ends long, ends_sha256 string, n_children long, n_leaves long, saved_tokens long, is_top boolean")


def _forest(batches):
    """One shard: its nodes with their subtree sums. ``more_*`` columns, where
    there are some, are totals that hang on a node from below."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    place = {name: i for i, name in enumerate(t.column("name").to_pylist())}
    parents = np.array([place.get(p, -1) for p in t.column("parent").to_pylist()], np.int64)
    members = t.column("n_convs").to_numpy()
    weights = (members - 1) * t.column("words").to_numpy()
    hang = lambda c: t.column(c).to_numpy() if c in t.column_names else np.zeros(len(members), np.int64)
    children, leaves, saved = subtree_sums(parents, weights + hang("more_saved"), hang("more_leaves"))
    # a node of one member with turns after it has one child, left out of the shard
    tail = (members == 1) & (t.column("n_ends").to_numpy() == 0) & (t.column("depth").to_numpy() > 0)
    children = children + hang("more_children") + tail
    out = t.select(_NODE).cast(pa.schema(list(zip(_NODE, _NODE_TYPES))))
    for c, v in zip(_SUMS, (children, leaves, saved)):
        out = out.append_column(c, pa.array(v, pa.int64()))
    out = out.append_column("is_top", pa.array(parents < 0))
    yield from out.to_batches(max_chunksize=10_000)


def trie(rows: DataFrame, shard_members: int | None = None, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The trie's nodes from rows as :func:`rebuilt` gives them: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    path = materialised(paths(rows), "trie-paths")
    nodes = path.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("least"),
        F.sum(F.col("ends").cast("long")).alias("n_ends"))
    nodes = materialised(nodes, "trie-nodes")
    root = nodes.where(F.col("name") == F.lit(_ROOT)).first()
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", *_SUMS, "ends_sha256"]
    if root is None:
        return path.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                                     "n_leaves long, saved_tokens long, ends_sha256 string")
    if shard_members is None:
        shard_members = math.isqrt(path.count()) + 1

    # every node's counts on every path (the root's are known); a node is told by its least member's path
    below = path.where("depth > 0").join(nodes.select("name", "n_convs", "least", "n_ends"), "name")
    rooted = path.where("depth = 0").select(*path.columns, F.lit(root["n_convs"]).alias("n_convs"),
                                            F.lit(root["least"]).alias("least"), F.lit(root["n_ends"]).alias("n_ends"))
    w = Window.partitionBy("conv_id").orderBy("depth")
    lag = lambda c: F.lag(c).over(w)
    top = F.first(F.when((F.col("depth") > 0) & (F.col("n_convs") <= shard_members), F.col("name")), ignorenulls=True)
    told = (below.unionByName(rooted)
            .withColumns({"parent": lag("name"), "parent_conv_id": lag("least"), "parent_convs": lag("n_convs"),
                          "top": top.over(w.rowsBetween(Window.unboundedPreceding, 0))})
            .where(F.col("conv_id") == F.col("least")))
    told = materialised(told.join(_ends(path), "name", "left")
                        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))), "trie-told")

    spine = (F.col("n_convs") > shard_members) | (F.col("depth") == 0)
    chain = (F.col("parent_convs") == 1) & (F.col("depth") > 1) & ~spine
    tails = told.where(chain).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.when(F.col("n_ends") > 0, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends_sha256")
    inner = told.where(~chain & ~spine)
    shards = max(1, -(-inner.count() // shard_nodes))
    # a chain's leaf is counted by the node it hangs on, which stands as a leaf in the shard
    sharded = materialised(inner.repartition(shards, "top").select(*_NODE).mapInArrow(_forest, _DONE), "trie-shards")
    hung = (sharded.where("is_top").groupBy("parent").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"),
                                   F.count(F.lit(1)).alias("more_children")).withColumnRenamed("parent", "name"))
    spines = told.where(spine).select(*_NODE).join(hung, "name", "left").na.fill(0, ["more_leaves", "more_saved", "more_children"])
    # fewer than rows / shard_members nodes by construction: one sequence
    spines = spines.repartition(1).mapInArrow(_forest, _DONE)
    return sharded.select(result).unionByName(spines.select(result)).unionByName(tails.select(result))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(table(spark, sf_dir, "conversations")))
