"""Cases where an operator once did less than the whole job."""

import numpy as np
import pytest

from lendscope.llm import ann, language, mixing, packing, pii, toxicity

UNCOVERED = ["".join(chr(0x1D4D2 + i % 20) for i in range(12)), "a" + "́" * 60, "\U00010400" * 300]


def test_language_uncovered_stretches_keep_a_probability():
    lattice = language.Lattice(sorted([b" ", b" a", b"a", b"b"]))
    words = [b" " + u.encode()[:language.LONGEST] for u in UNCOVERED] + [b" " + b"a" * language.LONGEST]
    data, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    p = np.array([[0.4, 1e-9], [0.3, 1 - 3e-9], [0.2, 1e-9], [0.1, 1e-9]])
    logs, counts = lattice.sweep((data, size), p, np.full((len(words), 2), 1e9))
    assert np.isfinite(logs).all() and np.isfinite(counts).all() and (counts >= 0).all()
    # " " and UNKNOWN bytes, or UNKNOWN bytes alone
    assert np.allclose(logs[0], np.log(p[0] + language.UNKNOWN) + (size[0] - 1) * np.log(language.UNKNOWN))


@pytest.mark.parametrize("odd", UNCOVERED, ids=["letters", "marks", "unspaced"])
def test_language_uncovered_letters_in_training_and_scoring(spark, odd):
    said = {"en": "the house and the water of the people", "fr": "la maison et les eaux de la ville"}
    rows = [(i, lang, text) for i, (lang, text) in enumerate(sorted(said.items()) * 5)] + [(98, "fr", odd), (99, "en", odd)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.fit(docs)
    assert np.isfinite(model.probability).all()
    asked = spark.createDataFrame([(0, said["fr"]), (1, said["en"]), (2, f"{said['fr']} {odd} {said['fr']}"), (3, odd)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify(asked, model, ["doc_id"]).collect()}
    assert [got[i]["_lang_pred"] for i in range(3)] == ["fr", "en", "fr"] and all(0 < got[i]["_score"] <= 1 for i in range(4))


def shown(text):
    return [text[s["start"]:s["end"]] for s in pii.spans(text)]


@pytest.mark.parametrize("address", ["john@example.com", "10.20.30.40", "4111 1111 1111 1111", "+1 415 555 0123"])
def test_pii_one_odd_character_anywhere(address):
    alike = {plain: odd for odd, plain in pii._ALIKE.items()}
    forms = [address[:i] + alike[c] + address[i + 1:] for i, c in enumerate(address) if c in alike]
    forms += [address[:i] + "​" + address[i:] for i in range(1, len(address))]
    assert len(forms) > len(address)
    for form in forms:
        text = f"write: {form}; thanks"
        assert form in shown(text)
        kind = pii.spans(address)[0]["kind"].upper()
        assert pii.masked_text(text) == f"write: [{kind}]; thanks"
        # the plain finds of the text stay
        plain = [(s["start"], s["end"], s["kind"]) for s in pii.spans(text) if s["plain"]]
        assert sorted(plain) == sorted(pii.plain_spans(text))


def test_pii_disguise_with_a_plain_remainder():
    assert shown("bob@mail.example [dot] com") == ["bob@mail.example", "bob@mail.example [dot] com"]
    assert pii.masked_text("bob@mail.example [dot] com") == "[EMAIL]"
    # a disguised find inside a plain one is no further span
    assert all(s["plain"] for s in pii.spans("a.b@c.example.com, +1 (555) 010-2030, 10.0.0.1"))


@pytest.mark.parametrize("said", [
    "plus 4 one 5 five 0 seven 1 two 3 four 9", "192 dot 168 dot 1 dot 10", "192 point 168 dot 1 point seven",
    "+1 four one five 555 0123", "plus 1 415 555 0123", "4111 1111 1111 one one 1 1", "+1 double four 5 555 0123",
    "john1 at mail.1host.example", "４１１１ １１１１ １１１１ １１１１"])
def test_pii_mixed_spelling(said):
    assert said in shown(f"say: {said}; thanks")
    assert said not in pii.masked_text(f"say: {said}; thanks")


def test_pii_gates_never_refuse_a_match():
    rng = np.random.default_rng(3)
    items = ["one", "Five", "oh", "7", "42", "dot", "point", "double", "triple", "plus", "+", "x", "at"]
    seen = 0
    for _ in range(6000):
        text = "".join(rng.choice(items) + rng.choice([" ", "  ", "-", ", ", " - ", "", "."], p=[.5, .1, .1, .1, .1, .05, .05]) for _ in range(rng.integers(4, 10)))
        for m in pii._SPELLED_RUN.finditer(text):
            put = pii.spelled_digits(m)
            assert (put is None) == (not any(c.isalpha() for c in m.group()))
            assert put is None or pii._HAS_SPELLED.search(text), text
            seen += put is not None
    assert seen > 500


def test_pii_find_stays_where_a_later_step_joins_it():
    card = "４１１１ １１１１ １１１１ １１１１"  # with the next word a number of 17 digits
    assert card in shown(f"card {card} one")


def test_pii_numbers_and_long_gaps_stay():
    for text in ("in 2019, 2020, 2021, 2022, 2023", "one" + " " * 200_000 + "x two", "1, 2 - 3 - 4" + "," * 200_000 + "a four 4"):
        assert shown(text) == []


def unit_vectors(n, d=64):
    v = np.random.default_rng(0).normal(size=(n, d))
    return (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)


def test_ann_recall_where_a_query_cannot_open_every_list(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 8)
    v = unit_vectors(6000)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(df, every=100).collect()}
    x, hits = v.astype(float), 0
    for q in range(0, len(v), 100):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += sum((q, int(i)) in got for i in np.argsort(d)[:10])
    assert hits >= 0.97 * 10 * len(range(0, len(v), 100))


def test_ann_opened_lists_grow_with_the_lists():
    x, opened = unit_vectors(8000).astype(float), []
    for n in (2000, 8000):
        own, graph = x[:n], ann.CentroidGraph(ann.bisected(x[:n], n // 8))
        d = ((own[:64, None] - own[None]) ** 2).sum(axis=2)
        d[np.arange(64), np.arange(64)] = np.inf
        near = np.argsort(d, axis=1)[:, :10]
        assert graph.calibrate(own[:64], np.repeat(np.arange(64), 10), own[near.ravel()]) >= ann.TARGET
        assert 1.5 < np.mean([len(c) for c in graph.lists_of(own[:200])]) <= ann.COPIES
        near, true = graph.search(own[:200], 64)[0], graph.ordered(own[:200], 64)[0]  # the graph's own recall
        assert np.mean([len(set(a) & set(b)) / len(b) for a, b in zip(near, true)]) > 0.85
        assert all(len(set(a)) == len(a) for a in near.tolist())
        opened.append(graph.probes)
    assert ann.PROBES <= opened[0] < opened[1] < 1000


def test_toxicity_learns_from_four_million_characters(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic: taken.append(len(texts)))
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('word ', 2000) AS text")
    toxicity.fit(docs, spark.range(300).selectExpr("id AS doc_id", "0 AS toxic"))
    assert taken == [300]  # 3 million characters of one class


def test_packing_full_windows_stand_alone_and_small_tables_are_dealt(spark):
    docs = spark.range(2500).selectExpr("id AS doc_id", "CASE WHEN id % 500 = 0 THEN repeat('long words ', 6000) ELSE 'a few words' END AS text")
    got = packing.digested(docs).toPandas()
    size = got.groupby("sequence_id")["length"].sum()
    assert len(got[got["start"] == 0]) == 2500 and size.max() <= packing.WINDOW
    full = got[got["length"] == packing.WINDOW]
    assert len(full) >= 10 and full["sequence_id"].is_unique and (full["sequence_id"] >= packing.FULL).all()
    rest = got[got["length"] < packing.WINDOW]
    assert (rest["sequence_id"] < packing.FULL).all() and (rest["sequence_id"] // 2**32).nunique() == 2
    assert packing.group_count(10) == 1 and packing.group_count(50_001) == 32 and packing.group_count(10_000_000) == 200


# --- ties, marks, names, workers -------------------------------------------------

@pytest.mark.parametrize("sizes,weights", [({"a": 300, "b": 100, "c": 200}, (3, 1, 2)), ({"a": 50, "b": 50, "c": 50}, (1, 1, 1)),
                                           ({"a": 70}, (3, 1, 2)), ({"a": 300, "b": 100, "c": 200, "d": 10}, (3, 1, 2)), ({"a": 0, "b": 0}, (3, 1, 2))])
def test_targets_of_tied_sources(spark, sizes, weights):
    names = sorted(sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, budget = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(sizes.values())
    while left:  # deal out, stop the full ones, deal again
        level = budget / sum(w[s] for s in left)
        full = {s for s in left if level * w[s] > 2 * sizes[s]}
        if not full:
            target.update({s: level * w[s] for s in left})
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        left -= full
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows, weights).collect()}
    assert got == pytest.approx(target)


def test_marks_without_letters_are_no_words(spark):
    said = {"en": "the house and the water of the people", "fr": "la maison et les eaux de la ville"}
    docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(sorted(said.items()) * 4)], "doc_id long, lang string, text string")
    model = language.fit(docs)
    texts = ["❤️ 123", "́", " ́  ́ ̈́ 7", "", None, "1́ la maison et les eaux", "été les eaux"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["_lang_pred"], r["_score"]) for r in language.identify(asked, model, ["doc_id"]).collect()}
    assert [got[i][0] for i in range(5)] == ["und"] * 5 and got[0][1] == 0.0
    assert got[5][0] == got[6][0] == "fr"


def test_pipeline_keeps_columns_of_any_name(spark):
    import corpus_pipeline as cp
    words = "the house and the water of the people was near a long river in that old town".split()
    rows = [(i, " ".join(words[i % 5:] + [f"w{chr(97 + i)}{chr(97 + j)}" for j in range(9)]), "en" if i % 2 else "fr", "s", 1, 7.5, "keep", 4, 5, "t")
            for i in range(12)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars int, "
                                 "_score double, _LANG_pred string, _d long, _key long, _tag string")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        got = out.select("_score", "_LANG_pred", "_d", "_key", "_tag").distinct().collect()
        assert [tuple(r) for r in got] == [(7.5, "keep", 4, 5, "t")]
        assert stage(spark, docs.limit(0), "").collect() == []
    assert cp.STAGES[-1][1](spark, docs.limit(0), "").collect() == []


def test_cut_prefixes_find_what_brute_force_finds(spark):
    import random
    from lendscope.llm import dedup
    rnd = random.Random(2)
    base = [[f"w{rnd.randrange(60)}" for _ in range(rnd.randint(4, 40))] for _ in range(30)]
    texts = []
    for b in base:
        for _ in range(4):
            t = list(b)
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(len(t))] = f"w{rnd.randrange(60)}"
            texts.append(" ".join(t))
    sets = [{tuple(t.split()[i:i + 2]) for i in range(len(t.split()) - 1)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in dedup.groups(docs, width=2).collect()}
    assert got == dict(enumerate(root))
    # the prefix filter alone finds every similar pair
    named = dedup.named_sets(docs, 2).dropDuplicates(["name"])
    apart = named.select("name", named["name"].alias("root"), (__import__("pyspark").sql.functions.size("shingles")).alias("n_shingles"))
    pairs = dedup.rare_partners(apart, named, 80).select("x", "y").distinct()
    kept = {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in dedup.similar(pairs.toDF("a", "b"), named, 80).collect()}
    by_name = {bytes(r["name"]): set(r["shingles"]) for r in named.collect()}
    names = sorted(by_name)
    exp = {frozenset((a, b)) for a in names for b in names if a < b
           and 100 * len(by_name[a] & by_name[b]) >= 80 * len(by_name[a] | by_name[b])}
    assert kept == exp
