"""The corpus operators against brute force on small fixtures: nulls, empty and
long texts, ties, repeated rows, empty tables and extra columns."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendscope.llm import ann, dedup, language, mixing, packing, pii, pitmanyor, pivots, toxicity, warc
from lendscope.llm.common import WORD, bucketed, components, shared_folder, word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, name string"
FOLD = {i: i + 32 for i in range(65, 91)}
W = re.compile(WORD)


def words(t):
    return W.findall((t or "").translate(FOLD))


def doc_rows():
    base = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\n ", "one", "one", "One", base, base, base + " tail", base.replace("w30", "x"), "a b", "b a",
             "z" * 5000, "long " * 9000 + base, "mail a.b@c.example.com or +1 (555) 010-2030, 10.0.0.1"]
    rows = [(i, t, "en" if i % 2 else None, "s%d" % (i % 3) if i % 5 else None, 0, 1.0, "x") for i, t in enumerate(texts)]
    return rows + [rows[6], (None, base, "en", "s1", 0, 1.0, "x"), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_word_fingerprints_follow_the_regex():
    texts = ["", None, "Ab  c\td", "x", "é ab", "y " * 700_000 + "AB c", "z" * 1_500_000 + " ab"]
    row, code = word_hashes(pa.array(texts))
    exp = [(i, w) for i, t in enumerate(texts) for w in words(t)]
    assert row.tolist() == [i for i, _ in exp]
    seen = {}
    assert all(seen.setdefault(w, c) == c for (_, w), c in zip(exp, code.tolist()))
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (20, 21), (3, 20)] + [(100, 100 + i) for i in range(1, 50)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 21: 1, 7: 7, 8: 7, 9: 7} | {100 + i: 100 for i in range(50)}


def shingles(t, width):
    w = words(t)
    return frozenset([tuple(w)] if 0 < len(w) < width else [tuple(w[i:i + width]) for i in range(len(w) - width + 1)])


@pytest.mark.parametrize("width", [2, 5])
def test_dedup_groups_equal_brute_force(docs, none, width):
    rows = [(r[0], shingles(r[1], width)) for r in doc_rows()]
    root = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    def least(i):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        return min(ids) if ids else None
    exp = [(rows[i][0], len(rows[i][1]), least(i) if rows[i][1] else rows[i][0]) for i in range(len(rows))]
    got = [tuple(r) for r in dedup.groups(docs, width).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=str) == sorted(exp, key=str)
    assert dedup.groups(none, width).count() == 0


def test_dedup_keeps_one_row_of_each_group(docs):
    out = dedup.deduplicated(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 6, 10, 11, 12, 14]  # 13 repeats one word before the text of 6


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_shuffles_no_text_that_has_no_partner(spark, docs):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = docs.withColumn("_bucket", F.lit(7)).withColumn("_bits", F.lit("b"))
        out = dedup.deduplicated(wide)
        nodes = plan(out).split("\n")
        sent = [i for i, line in enumerate(nodes) if "Exchange hashpartitioning" in line and "doc_id" in line]
        assert sent and all("getbit" in "\n".join(nodes[i:i + 16]) for i in sent)  # the filter is below the exchange
        assert out.columns == wide.columns
        ids = [r["doc_id"] for r in out.where("_bucket = 7 AND _bits = 'b'").collect()]
        assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 6, 10, 11, 12, 14] and ids.count(None) == 1
        same = spark.createDataFrame([(None, "")] * 3 + [(1, "")] * 2 + [(None, "a b")] * 3 + [(4, "c d")] * 2, "doc_id long, text string")
        kept = [tuple(r) for r in dedup.deduplicated(same).collect()]
        assert sorted(kept, key=str) == sorted([(None, "")] * 3 + [(1, "")] * 2 + [(None, "a b"), (4, "c d")], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filter_before_a_join_loses_no_key(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").alias("_bits"))
    keys = rows.where("k % 40 = 0 OR k IS NULL").select("k")
    got = {r["k"]: r["maybe"] for r in dedup.flagged(rows, ["k"], keys, "maybe").collect()}
    assert len(got) == 20_000 and all(got[k] for k in got if k is None or k % 40 == 0)
    assert sum(got.values()) < 600  # all but a few of the others are told
    assert not any(r["maybe"] for r in dedup.flagged(rows, ["k"], keys.where("k < 0"), "maybe").collect())


def test_stored_sets_are_joined_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = spark.range(50).select(F.col("id").cast("string").cast("binary").alias("name"))
        sets = bucketed(names.withColumn("shingles", F.array(F.lit(1), F.lit(2))), "sets", "name", 4)
        pairs = spark.range(50).select(F.col("id").cast("string").cast("binary").alias("a"), ((F.col("id") + 1) % 50).cast("string").cast("binary").alias("b"))
        found = dedup.similar(pairs, sets, 80)
        assert plan(found).count("Exchange") == 2  # of the pairs, once by either end
        assert found.count() == 50
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("sets")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.sort(np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)]))
    sig = dedup.signatures(np.repeat([0, 1], 400), np.concatenate([a, b]), 2)
    assert abs((sig[0] == sig[1]).mean() - 300 / 500) < 0.12
    assert np.floor(sig[0]).max() < 12  # stops early: few levels hand out all ranks


def test_mixing_targets_and_takes(spark, docs, none):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(3000)] + [(10_000, "w " * 400, "small"), (10_001, None, None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    by = got.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert len(got) == len(rows) and (got["taken"] <= 2 * got["size"]).all()
    assert abs(by["target"].sum() - 1.5 * by["size"].sum()) < 1e-6 and (by["target"] <= 2 * by["size"] + 1e-9).all()
    big = by[by["size"] > 1000]
    assert ((big["taken"] - big["target"]).abs() < 30).all()
    free = by[by["target"] < 2 * by["size"] - 1e-9]["target"]
    weights = [(3, 1, 2)[i % 3] for i, _ in enumerate(sorted(x for x in by.index if isinstance(x, str)))]
    level = {t / w for (s, t), w in zip(sorted(by["target"][[x for x in by.index if isinstance(x, str)]].items()), weights) if s in free.index}
    assert max(level) - min(level) < 1e-6
    again = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).toPandas()
    assert got.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()
    assert mixing.mix(docs).count() == len(doc_rows()) and mixing.mix(none).count() == 0
    assert mixing.mixed_documents(docs).agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] == \
        mixing.mix(docs, key=F.xxhash64(*docs.columns)).agg(F.sum("taken")).first()[0]


def test_packing_holds_every_id_once(docs, none):
    tok = packing.WordTokenizer(packing.vocabulary_path())
    got = packing.packed(docs).toPandas()
    total = sorted(len(tok.encode(r[1] or "")) + 1 for r in doc_rows())
    assert sorted(got[got["start"] == 0]["doc_tokens"]) == total and got["length"].sum() == sum(total)
    for r in doc_rows()[6:14]:
        own = got[got["doc_id"] == r[0]].drop_duplicates("start").sort_values("start")
        assert b"".join(own["ids"]) == np.append(tok.encode(r[1]), 2).astype("<u4").tobytes()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 4096 and s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]]
    assert packing.digested(none).count() == 0
    joined = packing.sequences(packing.packed(docs)).toPandas()
    assert (joined["ids"].map(len) == 4 * joined["length"]).all()


def test_best_fit_decreasing_equals_a_scan():
    rng = np.random.default_rng(3)
    lengths = sorted(rng.integers(1, 101, 500).tolist(), reverse=True)
    number, offset = packing.best_fit_decreasing(lengths, 100)
    room = []
    for n, at, o in zip(lengths, number, offset):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if not fits:
            assert at == len(room) and o == 0
            room.append(100 - n)
        else:
            assert room[at] == min(fits)[0] and o == 100 - room[at]
            room[at] -= n


def test_word_tokenizer_is_exact():
    tok = packing.WordTokenizer(packing.vocabulary_path())
    for t in ["é é ́x", "DON'T it's.    x\t\ty", "İ. ß ΣΑΣ ﬁ J̌", "<|endoftext|> x", "日本 語 12...!!", "각. q̣̇!"]:
        assert tok([t])[0] == tok.encode(t).astype("<u4").tobytes()


def base_spans(t):
    out = []
    for k, rx in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                  ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(rx, t):
            n = re.sub("[^0-9]", "", m.group())
            if (k == "ip" and any(int(p) > 255 for p in m.group().split("."))) or (k == "phone" and not 10 <= len(n) <= 15) \
                    or (k == "card" and not (14 <= len(n) <= 19 and pii.luhn(n))):
                continue
            out.append((m.start(), pii.KINDS.index(k), m.end(), k))
    return sorted(out)


def test_pii_plain_spans_equal_the_patterns():
    rng = np.random.default_rng(5)
    for _ in range(4000):
        t = "".join(rng.choice(list("ab1.@-+ (9 _%0123456789"), rng.integers(0, 60)))
        assert sorted((s, pii.KINDS.index(k), e, k) for s, e, k in pii.plain_spans(t)) == base_spans(t)


@pytest.mark.parametrize("text,found", [
    ("mail john.doe (at) example (dot) com now", "john.doe (at) example (dot) com"), ("john at example dot com", "john at example dot com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ!", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"), ("jo​hn@exa​mple.com", "jo​hn@exa​mple.com"),
    ("call plus one five five five one two three four five six seven", "plus one five five five one two three four five six seven"),
    ("meet me at home. dot the i", None), ("one two three four is fine", None), ("x at y", None), (None, None), ("", None)])
def test_pii_disguises(text, found):
    got = [text[s["start"]:s["end"]] for s in pii.spans(text)]
    assert got == ([found] if found else [])
    if found is None:
        assert pii.masked_text(text) == text


def test_pii_query_columns(docs):
    got = docs.select("doc_id", pii.find(F.col("text")).alias("s")).where("size(s) > 0").collect()
    assert [(r["doc_id"], [x["kind"] for x in r["s"]]) for r in got] == [(14, ["email", "phone", "ip"])]


def test_language_forward_sums_all_segmentations():
    pieces = sorted([b" ", b" a", b"a", b"ab", b"b", b" ab", b"c"])
    lattice, p = language.Lattice(pieces), np.random.default_rng(0).dirichlet(np.ones(7), 2).T
    def total(w, j):
        if not w:
            return 1.0
        own = sum(p[i, j] * total(w[len(x):], j) for i, x in enumerate(pieces) if w.startswith(x))
        return own + language.UNKNOWN * total(w[1:], j)
    ws = [b" ab", b" abcab", b" q", b" aabb"]
    logs, counts = lattice.sweep((np.frombuffer(b"".join(ws), np.uint8), np.array([len(w) for w in ws])), p, np.ones((4, 2)))
    assert np.allclose(np.exp(logs), [[total(w, j) for j in (0, 1)] for w in ws])
    assert counts.min() >= 0 and np.isclose((counts * np.array([len(x) for x in pieces])[:, None]).sum(), 2 * sum(map(len, ws)), atol=2.1)


def test_language_held_out_and_defined_cases(spark, small, docs, none):
    got = language.query(spark, small).join(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.95 and got["score"].between(0, 1).all()
    model = language.fit(docs)
    out = language.identify(docs, model, ["doc_id", "text"]).collect()
    assert all((r["_lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in out)
    assert language.identify(docs, language.fit(none), ["doc_id"]).where("_lang_pred <> 'und'").count() == 0


def test_toxicity_finds_misspelt_words(docs):
    rng = np.random.default_rng(2)
    clean = [" ".join(rng.choice(["the", "of", "thing", "reon", "andst", "hean"], 60)) for _ in range(200)]
    toxic = [c + " " + w for c, w in zip(clean[:60], ["blorgwit", "blorgwits", "blorgwitty"] * 20)]
    model = toxicity.train(pa.array(clean + toxic), np.array([0] * 200 + [1] * 60))
    s = model.score(pa.array([clean[3] + " blorgwitten", clean[4], "", None]))
    assert s[0] > 0.5 > s[1] and s[2] == s[3] < 0.5
    assert toxicity.scored(docs, model).count() == len(doc_rows())
    assert toxicity.train(pa.array(["a"]), np.array([0])).score(pa.array(["b"]))[0] < 0.5


PAGES = [(1, "u1", "<p>x</p>"), (2, "u2", "<p>x</p>"), (0, "u0", "é"), (3, None, None), (4, "u\r\n4", ""), (None, "n", "<p>x</p>"),
         (None, "m", "only"), (None, "k", "only"), (7, "u7", "y" * 300_000), (7, "u7", "y" * 300_000)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int")
    folder = shared_folder(spark, "t")
    manifest = warc.write_archives(pages, folder, shard_bytes=100_000, roll_bytes=500)
    assert manifest.count() > 2
    got = warc.read_archives(spark, folder, payloads=True).toPandas()
    first = {}
    for i, _, h in PAGES:
        first[h or ""] = min(x for x in (first.get(h or ""), i, math.inf) if x is not None)
    exp = []
    for i, _, h in PAGES:
        f = first[h or ""]
        revisit = f < math.inf and (i is None or i > f)
        exp.append((i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    own = [tuple(None if x != x else x for x in r) for r in got[cols].itertuples(index=False)]
    assert sorted(own, key=str) == sorted(((float(a) if a is not None else None, b, c, d, float(e) if e is not None else None) for a, b, c, d, e in exp), key=str)
    names = lambda f: sorted(r["file"] for r in warc.write_archives(pages, f, 100_000, 500).collect())
    assert names(shared_folder(spark, "t")) == names(shared_folder(spark, "t"))
    empty = shared_folder(spark, "t")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[200:240] = x[5]  # a hot vector
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(1000, None, 0), (1100, [None] * 8, 0), (1200, [math.nan] * 8, 0), (1300, [math.inf] * 8, 0), (1400, [1.0, 2.0], 0), (None, x[0].tolist(), 0), rows[0]]
    df = spark.createDataFrame(rows + odd + [(1500, [0.0] * 8, 0)], "vec_id long, embedding array<float>, score int")
    return df, {i: np.array(v, dtype=float) for i, v, _ in rows}


def test_ann_small_table_is_exact(vectors):
    df, rows = vectors
    got = collections.defaultdict(list)
    for r in ann.search(df, every=5).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in rows if i % 5 == 0}
    hits = 0
    for q, own in got.items():
        exp = sorted((np.sqrt(((v - rows[q]) ** 2).sum()), i) for i, v in rows.items() if i != q)[:10]
        assert [r for r, _, _ in sorted(own)] == list(range(1, 11)) and q not in {i for _, i, _ in own}
        hits += len({i for _, i in exp} & {i for _, i, _ in own})
    assert hits >= 0.9 * 10 * len(got)
    assert ann.search(df.limit(0), every=5).count() == 0


def test_pivot_search_is_exact(vectors):
    df, rows = vectors
    ints = {i: np.floor(256 * v).astype(int) for i, v in rows.items()} | {1500: np.zeros(8, int)}
    got = collections.defaultdict(list)
    for r in pivots.search(df, every=5).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in ints if i % 5 == 0}
    for q, own in got.items():
        exp = sorted((-int(v @ ints[q]), i) for i, v in ints.items() if i != q)[:5]
        assert [(i, s) for _, i, s in sorted(own)] == [(i, -s) for s, i in exp]
    assert pivots.search(df.limit(0), every=5).count() == 0


def test_pii_cover_equals_comparing_all():
    import random
    for seed in range(300):
        r, seen, cover = random.Random(seed), [], pii.Cover()
        for _ in range(40):
            s = r.randrange(30)
            e = s + r.randrange(1, 9)
            new = not any(a <= s and e <= b for a, b in seen)
            assert cover.add(s, e) == new
            seen += [(s, e)] * new


def test_pitman_yor_counts_and_scores(spark, small, docs, none):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows}
    tokens = {r[0]: words(r[1]) + [""] for r in rows}
    c = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in pitmanyor.query(spark, small).collect()}
    for i, t in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(c[w] > 0 for w in t), n, held[i])
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert pitmanyor.score(docs.withColumn("held_out", F.lit(False))).count() == len(doc_rows())
    assert pitmanyor.score(none.withColumn("held_out", F.lit(False))).count() == 0


def test_pitman_yor_spelling_is_a_distribution():
    size, raw = np.array([0, 1, 2, 3]), np.frombuffer(b"aababc", np.uint8)
    uniform = pitmanyor.Spelling.uniform()
    ctx, sym, _ = uniform.symbols(size, raw)
    cell, n = np.unique(ctx * pitmanyor.SYMBOLS + sym, return_counts=True)
    spell, _ = pitmanyor.Spelling.sampled(cell, n * 5, uniform, {}, 1)
    assert np.allclose(np.exp(spell.log_table).sum(axis=1), 1)
    seats = pitmanyor.seat(np.array([1, 2, 500, 10**6, 0]), np.array([.5, .5, 1., 1., 1.]), 0.5, np.arange(5, dtype=np.uint64))
    assert seats[0] == 1 and 1 <= seats[1] <= 2 and 1 < seats[2] < 500 and seats[2] < seats[3] < 10**6 and seats[4] == 0


def test_pitman_yor_follows_its_predictive_rule(spark, tmp_path):
    """Counts, tables and scores against dictionaries; every context's words sum to one."""
    texts = ["a b a b c", "a b b", "c a b", "b", "", None, "A b x", "b a b a b a"] * 3 + ["b a", "a b", "zzz a", "a zzz", "q b a b"]
    rows = [(i, t, i >= 24 or i % 5 == 4) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    tokens = {i: words(t) + [""] for i, t, _ in rows}
    c, pairs = collections.Counter(), collections.Counter()
    for i, _, held in rows:
        if not held:
            c.update(tokens[i])
            pairs.update(zip([""] + tokens[i], tokens[i]))
    finger = {w: int(word_hashes(pa.array([w]))[1][0]) if w else 0 for t in tokens.values() for w in t}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    vocabulary = spark.createDataFrame([(signed(h), w.encode(), c[w]) for w, h in finger.items()], "id long, word binary, c long")
    repeated = spark.createDataFrame([(signed(finger[u]), signed(finger[w]), n) for (u, w), n in pairs.items() if n > 1], "u long, w long, c long")
    model, table, unknown = pitmanyor.fit(pitmanyor.packed_words(vocabulary), pitmanyor.packed_pairs(repeated))
    name = {signed(h): w for w, h in finger.items()}
    state = {name[r["id"]]: r for r in pitmanyor.word_rows(table).collect()}
    for w, r in state.items():
        assert r["ts"][0] == sum(u == w for u, _ in pairs)
    known = [w for w in finger if c[w]]
    d = model.pair_discount
    p = {}
    for k in range(4):
        if k:
            asked = list(pairs)
            fingers = lambda at: np.array([finger[x[at]] for x in asked], np.uint64)
            seats = model.pair_tables(fingers(0), fingers(1), np.array([pairs[x] for x in asked]), np.array([state[u]["ts"][k - 1] for u, _ in asked]),
                                      np.array([state[w]["ps"][k - 1] for _, w in asked]), k)
            t = dict(zip(asked, seats.tolist()))
            for u in known:
                assert state[u]["ts"][k] == sum(n for (x, _), n in t.items() if x == u)
        prior = {w: math.exp(state[w]["ps"][k]) for w in known} | {None: math.exp(unknown[k])}
        assert math.isclose(sum(prior.values()), 1, rel_tol=1e-5)
        if k < 2:
            continue
        for u in [*known, None]:
            n, opened = (c[u], state[u]["ts"][k]) if u is not None else (0, 0)
            p[k, u] = {w: ((pairs[u, w] - d * t[u, w] if (u, w) in pairs else 0) + (1 + d * opened) * q) / (1 + n) for w, q in prior.items()}
            assert math.isclose(sum(p[k, u].values()), 1, rel_tol=1e-5)
    got = {r["doc_id"]: r["score"] for r in pitmanyor.score(docs).collect()}
    assert set(got) == set(tokens)
    unk = lambda w: w if c[w] else None
    for i, own in tokens.items():
        exp = sum(math.log10((p[2, unk(u)][unk(w)] + p[3, unk(u)][unk(w)]) / 2) for u, w in zip([""] + own, own))
        assert math.isclose(got[i], exp, rel_tol=1e-5), (i, got[i], exp)
    assert got[25] > got[24] and got[26] != got[27]  # the order of words counts


def test_pitman_yor_scores_do_not_depend_on_chunks_and_ranges(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("held_out", F.col("doc_id") % 5 == 0)
    read = lambda: {r["doc_id"]: r for r in pitmanyor.score(docs).collect()}
    exp = read()
    monkeypatch.setattr(pitmanyor, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(pitmanyor, "RANGE_ENTRIES", 500)
    monkeypatch.setattr(pitmanyor, "RANGE_WORDS", 100)
    got = read()
    assert set(got) == set(exp)
    for i, r in got.items():
        assert r["n_known"] == exp[i]["n_known"] and math.isclose(r["base_score"], exp[i]["base_score"], rel_tol=1e-9)
        assert math.isclose(r["score"], exp[i]["score"], rel_tol=1e-4)


def test_pitman_yor_packed_arrays():
    rng = np.random.default_rng(5)
    for n in (0, 1, 1000):
        x = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False))
        assert (pitmanyor.restored(pitmanyor.steps(x)) == x).all()
        y = rng.normal(size=(2, n)).astype(np.float32)
        assert (pitmanyor.unpacked(pitmanyor.packed(y), np.float32).reshape(2, -1) == y).all()


def test_pipeline_stages_on_odd_rows(spark, docs):
    import corpus_pipeline
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.materialised(stage(spark, now, ""), name)
        assert now.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() > 0
