"""Near-duplicate groups by SuperMinHash.

A document's set are its distinct shingles of ``width`` words. Documents with
equal sets form a class. A class gets a SuperMinHash signature: every shingle
draws its own random permutation of the signature's slots, offers each slot
its rank there plus a fraction, and a slot keeps its least offer; ranks are
handed out level by level, and a set stops at the first level that can no
longer lower a slot. Slots are cut into bands; classes that agree in a band
are candidates, and a candidate pair counts once its full sets are compared.

A band value shared by b classes never yields b * b pairs. Rounds compare each
class with one partner, a varying member of its bucket's least component, and
classes that have come into one component drop out. What is still apart after
the rounds goes through an exact prefix filter: similar sets share one of
their rarest shingles, so only classes that do are compared, without a cap.

Defined results: words are A-Z-lowered runs of non-space bytes; fewer words
than ``width`` give one shingle of them all; null, empty and blank texts have
no shingle and are linked with nothing; null doc_ids are the largest, repeated
ids and rows belong to their text's class like any other; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, components, discard, materialised, mix, release, scratch, small_batches, table, tidy, unused, word_hashes

BANDS, ROWS = 40, 6
SLOTS = BANDS * ROWS
ROUNDS = 3
CHUNK = 120_000
SEED = 17
#: Places of a filter before a join (262,144 longs at most, for any input), and shingles in a bucket of the stored sets.
PLACES = 1 << 24
BUCKET = 4_000_000


def shingle_sets(texts: pa.Array, width: int):
    """(row, shingle) of every distinct shingle, sorted by row, then shingle."""
    row, h = word_hashes(texts)
    if not len(row):
        return row, h
    n = np.bincount(row, minlength=len(texts))
    first = np.cumsum(n) - n
    nth = np.arange(len(row)) - first[row]
    with np.errstate(over="ignore"):
        at = np.flatnonzero((nth + width <= n[row]) | ((n[row] < width) & (nth == 0)))
        code = mix(np.minimum(n[row[at]], width).astype(np.uint64))
        for k in range(width):
            has = nth[at] + k < n[row[at]]
            code = np.where(has, mix(code * np.uint64(0x100000001B3) ^ h[np.minimum(at + k, len(h) - 1)]), code)
    by = np.lexsort((code, row[at]))
    r, c = row[at][by], code[by]
    keep = np.ones(len(r), dtype=bool)
    keep[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    return r[keep], c[keep]


def signatures(row: np.ndarray, shingle: np.ndarray, rows: int, slots: int = SLOTS, seed: int = SEED) -> np.ndarray:
    """SuperMinHash signatures (rows x slots) of the sets given as sorted
    (row, shingle) pairs; a row without shingles keeps infinity."""
    sig = np.full((rows, slots), np.inf)
    flat = sig.ravel()
    edges = np.searchsorted(row, np.arange(rows + 1))
    lo = 0
    while lo < rows:  # as many whole rows as fit a chunk; a larger row comes in parts
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + CHUNK, "right")) - 1)
        for at in range(int(edges[lo]), max(int(edges[hi]), int(edges[lo]) + 1), CHUNK):
            r, s = row[at:min(at + CHUNK, edges[hi])], shingle[at:min(at + CHUNK, edges[hi])]
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(r), 1))
            mine = np.arange(len(r))
            state = mix(s ^ np.uint64(seed))
            with np.errstate(over="ignore"):
                for level in range(slots):
                    state = mix(state)
                    k = level + ((state >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
                    slot = order[mine, k].astype(np.int64)  # one Fisher-Yates step of each shingle's permutation
                    order[mine, k] = order[mine, level]
                    np.minimum.at(flat, r * slots + slot, level + (state & np.uint64(0xFFFFFFFF)).astype(np.float64) / 4294967296.0)
                    if level + 1 < slots:
                        live = sig[lo:hi].max(axis=1) > level + 1  # a later offer is at least level + 1
                        if not live.all():
                            on = live[r - lo]
                            r, mine, state = r[on], mine[on], state[on]
                    if not len(r):
                        break
        lo = hi
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key per band (rows x bands)."""
    parts = sig.view(np.uint64).reshape(len(sig), bands, -1)
    key = np.broadcast_to(mix(np.arange(bands)), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for j in range(parts.shape[2]):
            key = mix(key * np.uint64(0x100000001B3) ^ parts[:, :, j])
    return key


def set_names(row: np.ndarray, shingle: np.ndarray, rows: int) -> list[bytes]:
    """A 128-bit name of each set, the same for equal sets."""
    edges = np.searchsorted(row, np.arange(rows))
    empty = np.bincount(row, minlength=rows) == 0
    out = []
    with np.errstate(over="ignore"):
        for salt in (1, 2):
            v = np.append(mix(shingle ^ mix(salt)), np.uint64(0))
            total = np.add.reduceat(v, np.minimum(edges, len(v) - 1))
            total[empty] = 0
            out.append(mix(total + np.uint64(salt)))
    return [x.tobytes() for x in np.stack(out, axis=1)]


def described(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, tag (of its text), name (of its set), n_shingles, bands."""
    @tidy("dedup")
    def run(batches):
        for whole in batches:
            for b in small_batches(whole, "text", 4 << 20):
                row, shingle = shingle_sets(b.column("text"), width)
                n = np.bincount(row, minlength=b.num_rows)
                keys = band_keys(signatures(row, shingle, b.num_rows)).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("tag"), pa.array(set_names(row, shingle, b.num_rows), pa.binary()), pa.array(n, pa.int64()), bands],
                    names=["doc_id", "tag", "name", "n_shingles", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("tag"), "text").mapInArrow(run, f"doc_id {kind}, tag long, name binary, n_shingles long, bands array<long>")


def named_sets(docs: DataFrame, width: int) -> DataFrame:
    """name, shingles of every document that has any."""
    @tidy("dedup")
    def run(batches):
        for whole in batches:
            for b in small_batches(whole, "text", 2 << 20):
                row, shingle = shingle_sets(b.column("text"), width)
                n = np.bincount(row, minlength=b.num_rows)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(shingle.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_names(row, shingle, b.num_rows), pa.binary()), lists], names=["name", "shingles"])

    return docs.select("text").mapInArrow(run, "name binary, shingles array<long>").where(F.size("shingles") > 0)


def flagged(df: DataFrame, columns: list[str], keys: DataFrame, flag: str) -> DataFrame:
    """``df`` with a boolean column: false only for rows whose ``columns`` are no row of
    ``keys``. A bitmap of hashed keys tells, of bounded size for any input, so that
    most rows without a partner need not be shuffled for a join; the join decides."""
    place = lambda names: F.pmod(F.xxhash64(*names), F.lit(PLACES))
    bucket, held = unused([*df.columns, flag], "_bucket", "_bits")
    at = keys.select(place(keys.columns).alias("_at"))
    bits = at.groupBy(F.shiftright("_at", 6).alias(bucket)).agg(F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 AS int))")).alias(held))
    met = df.withColumn(bucket, F.shiftright(place(columns), 6)).join(F.broadcast(bits), bucket, "left")
    return met.withColumn(flag, F.coalesce(F.getbit(held, (place(columns) % 64).cast("int")) == 1, F.lit(False))).drop(bucket, held)


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union. The set of a
    goes to b's, so a name of very many pairs had better be an a."""
    left = sets.select(F.col("name").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("name").alias("b"), F.col("shingles").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - F.col("_c")
    return pairs.join(left, "a").join(right, "b").withColumn("_c", common).where(100 * F.col("_c") >= percent * union).select("a", "b")


def rare_partners(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, nx, y, ny) of the (name, n_shingles, root) rows whose roots differ
    and whose sets may be similar, by prefix filtering: with the shingles in
    order of rarity, sets that share enough share one of their first
    n - ceil(n * percent / 100) + 1."""
    held = sets.join(open_, "name").select("name", "n_shingles", "root", "shingles")
    often = held.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # a shingle that only one set holds comes first and needs no partner
    shared = held.select("name", "n_shingles", "root", F.explode("shingles").alias("shingle")).join(often, "shingle")
    listed = shared.groupBy("name", "n_shingles", "root").agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("s"))  # one set's shingles
    listed = listed.select("name", "n_shingles", "root", F.size("s").alias("m"), F.col("s.shingle").alias("s"))
    reach = F.expr(f"n_shingles - int(({percent} * n_shingles + 99) / 100) + 1 - (n_shingles - m)")
    enough = f"{100 + percent} * m >= {percent} * (n_shingles + int(({percent} * n_shingles + 99) / 100))"  # with a partner of the least size
    first = listed.withColumn("_p", reach).where(f"_p > 0 AND {enough}").withColumn("s", F.slice("s", F.lit(1), F.col("_p").cast("int")))
    first = materialised(first.select("name", "n_shingles", "root", "m", F.posexplode("s").alias("at", "shingle")), "prefixes")
    release(first.sparkSession)
    side = lambda end: first.select("shingle", *[F.col(c).alias(c + end) for c in ("name", "n_shingles", "root", "m", "at")])
    # what follows a common shingle can be common enough; if that holds for any, it does for the first, so pairs
    # may come once a common shingle and are told apart by the caller's distinct
    left = F.least(F.col("m1") - F.col("at1"), F.col("m2") - F.col("at2"))
    can = (100 + percent) * left >= percent * (F.col("n_shingles1") + F.col("n_shingles2"))
    met = side("1").join(side("2"), "shingle").where((F.col("root1") < F.col("root2")) & can)
    return met.select(F.col("name1").alias("x"), F.col("n_shingles1").alias("nx"), F.col("name2").alias("y"), F.col("n_shingles2").alias("ny"))


def _pairs(turn: int, member: DataFrame, root: DataFrame, sets: DataFrame, asked: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of a round that were not compared before; a is the partner that many may have."""
    now = member.join(root, "name")
    ends = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key", "low")
    apart = materialised(now.join(ends, "key"), "apart")
    if turn < ROUNDS:
        # every class outside the bucket's least component meets one member of that component
        mine = apart.where("root <> low").select("key", F.col("name").alias("x"), F.col("n_shingles").alias("nx"))
        pick = F.struct(F.xxhash64("name", F.lit(turn)), "name", "n_shingles")
        other = apart.where("root = low").groupBy("key").agg(F.min(pick).alias("p")).select("key", F.col("p.name").alias("y"), F.col("p.n_shingles").alias("ny"))
        met = mine.join(other, "key")
    else:
        met = rare_partners(materialised(apart.select("name", "n_shingles", "root").distinct(), "open"), sets, percent)
    # sizes too far apart cannot be similar
    fits = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    low, high = F.least("x", "y"), F.greatest("x", "y")
    new = met.where(fits).groupBy(low.alias("low"), high.alias("high")).agg(F.max("y").alias("a")).join(asked, ["low", "high"], "left_anti")
    return new.select("a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"))


def members(classes: DataFrame) -> DataFrame:
    """key, name, n_shingles of every class and band key that it shares."""
    keyed = classes.select(F.explode("bands").alias("key"), "name", "n_shingles")
    shared = materialised(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "shared")
    return materialised(flagged(keyed, ["key"], shared, "_maybe").where("_maybe").drop("_maybe").join(shared, "key"), "members")


def links(classes: DataFrame, member: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links (a, b) between class names that connect exactly the
    classes that all links connect."""
    held = materialised(member.select("name", "n_shingles").distinct(), "held")
    firsts = materialised(classes.join(held, "name", "left_semi").select("first_id").distinct(), "firsts")
    spark = classes.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (held.agg(F.sum("n_shingles")).first()[0] or 0) // BUCKET)
    texts = flagged(docs.select("doc_id", "text"), ["doc_id"], firsts, "_maybe").where("_maybe")
    texts = texts.join(firsts, texts["doc_id"].eqNullSafe(firsts["first_id"]))  # as a semi-join it would move below the filter
    sets = named_sets(texts, width).repartition(buckets, "name")
    sets = bucketed(sets.join(held.select("name"), "name", "left_semi").dropDuplicates(["name"]), "sets", "name", buckets)
    release(spark)
    found = spark.createDataFrame([], "a binary, b binary")
    asked = spark.createDataFrame([], "low binary, high binary")
    root = held.select("name", F.col("name").alias("root"))
    for turn in range(ROUNDS + 1):
        with scratch(spark):
            pairs = materialised(_pairs(turn, member, root, sets, asked, percent), "pairs", keep=True)
            if pairs.isEmpty():
                continue
            new = materialised(similar(pairs, sets, percent), "links", keep=True)
            asked, found = asked.union(pairs.select(F.least("a", "b"), F.greatest("a", "b"))), found.union(new)
            if turn < ROUNDS and not new.isEmpty():
                roots = components(found).select(F.col("node").alias("name"), "root")
                root = materialised(held.join(roots, "name", "left").select("name", F.coalesce("root", "name").alias("root")), "roots", keep=True)
        release(spark)  # the round's shuffle files
    return found


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, tag (a fingerprint of its text), n_shingles,
    root (its component's, null without shingles) and component_id (the
    smallest doc_id reachable; null only if all reachable ids are)."""
    told = materialised(described(docs, width), "described")
    classes = told.where("n_shingles > 0").groupBy("name").agg(
        F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"))
    banded = materialised(classes, "banded")
    member = members(banded)
    # the bands go, they are most of both tables
    classes, slim = materialised(banded.drop("bands"), "classes"), materialised(told.drop("bands"), "told")
    for wide in (banded, told):
        discard(wide)
    release(docs.sparkSession)
    roots = components(links(classes, member, docs, width, percent))
    joined = classes.select("name", "first_id").join(roots, classes["name"] == roots["node"], "left") \
                    .select("name", "first_id", F.coalesce("root", "name").alias("root"))
    joined = materialised(joined, "joined")
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = joined.join(least, "root").select("name", "root", "component_id")
    out = slim.join(of_class, "name", "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "tag", "n_shingles", "root", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less all but one of every near-duplicate group: the
    smallest doc_id stays (null is the largest; among equal ids the text with
    the smaller fingerprint; of equal rows one). Documents without shingles stay."""
    with scratch(docs.sparkSession):
        found = materialised(groups(docs, width, percent).where("n_shingles > 0"), "grouped", keep=True)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tag")
    first = found.groupBy("root").agg(F.min(rank).alias("_first"))
    d, t, own, twice, maybe = unused(docs.columns, "_d", "_t", "_tag", "_twice", "_maybe")
    rest = found.join(first, "root").where(~rank.eqNullSafe(F.col("_first"))).select(F.col("doc_id").alias(d), F.col("tag").alias(t)).distinct()
    rest = materialised(rest, "rest")
    again = found.groupBy("doc_id", "tag").count().where("count > 1").select(F.col("doc_id").alias(d), F.col("tag").alias(t))
    again = again.join(rest, again[d].eqNullSafe(rest[d]) & (again[t] == rest[t]), "left_anti")
    marks = materialised(rest.withColumn(twice, F.lit(False)).union(again.withColumn(twice, F.lit(True))), "marks")
    # only rows that may be marked are joined; an anti-join would move below the filter
    tagged = flagged(docs.withColumn(own, F.xxhash64("text")), ["doc_id", own], marks.select(d, t), maybe)
    met = tagged.where(maybe).join(marks, tagged["doc_id"].eqNullSafe(marks[d]) & (tagged[own] == marks[t]), "left")
    out = tagged.where(~F.col(maybe)).select(docs.columns).union(met.where(F.col(twice).isNull()).select(docs.columns))
    if not marks.where(twice).isEmpty():
        out = out.union(met.where(twice).dropDuplicates(["doc_id", own]).select(docs.columns))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    out = groups(table(spark, sf_dir, "documents"), width=2)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
