"""Forests and boosted trees: held against Spark's own, brute force and themselves."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendscope.operators import evaluate as ev
from lendscope.operators import trees as T

NUM = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = np.random.default_rng(3)
    n = 3000
    x = rnd.normal(size=(n, 3))
    d = (rnd.random(n) < .4).astype(float)
    z = 1.5 * x[:, 0] - x[:, 1] * x[:, 2] + 2 * d * (x[:, 0] > 0) - .5
    y = (rnd.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(i, *map(float, x[i]), float(d[i]), int(y[i]), 1.0 + (i % 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, y int, w double")
    return VectorAssembler(inputCols=NUM, outputCol="features").transform(df).persist()


def auc(model, rows):
    out = model.transform(rows).select(F.lit("m").alias("model_name"), F.col("y").alias("y_true"),
                                       vector_to_array("probability")[1].alias("y_prob"))
    return ev.roc_auc(out).first()["roc_auc"]


@pytest.fixture(scope="module")
def halves(table):
    return table.where("row_id % 2 = 0"), table.where("row_id % 2 = 1")


@pytest.fixture(scope="module")
def edges(halves):
    return T.bin_table(halves[0], NUM[:3], 4)


def forest(df, edges, **kw):
    return T.fit_forest(df, edges, 1500, "y", "w", **{"numTrees": 30, "seed": 7, **kw})


def boosted(df, edges, **kw):
    return T.fit_boosted(df, edges, 1500, "y", "w", **{"maxIter": 30, "stepSize": .2, "maxDepth": 3, "seed": 7, **kw})


def test_edges_and_bins(edges):
    assert [len(e) for e in edges] == [31, 31, 31, 1]
    assert T.binned(np.array([[-99, 0, 99, 0.0], [99, 0, -99, 1.0]]), edges)[:, [0, 2, 3]].tolist() == [[0, 31, 0], [31, 0, 1]]


def test_forest_ranks_like_sparks(halves, edges):
    fit, held = halves
    own = auc(forest(fit, edges, maxDepth=8), held)
    spark_own = auc(RandomForestClassifier(labelCol="y", weightCol="w", numTrees=30, maxDepth=8, seed=7, featureSubsetStrategy="sqrt").fit(fit), held)
    assert own > spark_own - .015 and own > .8


def test_boosting_ranks_like_sparks(halves, edges):
    fit, held = halves
    own = auc(boosted(fit, edges), held)
    spark_own = auc(GBTClassifier(labelCol="y", weightCol="w", maxIter=30, stepSize=.2, maxDepth=3, seed=7, subsamplingRate=.8).fit(fit), held)
    assert own > spark_own - .015 and own > .8


def same_trees(a, b, exact=True):
    assert len(a.trees) == len(b.trees)
    for s, t in zip(a.trees, b.trees):
        for k, _ in T.FIELDS:
            assert (np.array_equal if exact else np.allclose)(s[k], t[k])


@pytest.mark.parametrize("fit", [forest, boosted])
def test_same_model_from_any_layout(halves, edges, fit):
    one, other = halves[0].repartition(1).orderBy("row_id"), halves[0].repartition(7).sortWithinPartitions(F.desc("a"))
    same_trees(fit(one, edges), fit(other, edges))


def test_many_chunks_are_one_table(halves, edges):
    whole = boosted(halves[0], edges, maxIter=5, fold=2)
    same_trees(whole, boosted(halves[0], edges, maxIter=5, fold=2, chunk_rows=400), exact=False)
    same_trees(whole, boosted(halves[0], edges, maxIter=5, fold=5), exact=False)
    same_trees(whole, boosted(halves[0], edges, maxIter=5, fold=3, chunk_rows=60), exact=False)  # sums added in two steps


def test_first_split_of_boosting_is_the_best(halves, edges):
    """The root of the first tree against every split of every slot."""
    m = boosted(halves[0], edges, maxIter=1, maxDepth=1, subsamplingRate=1.0, columnRate=1.0, stepSize=1.0)
    rows = halves[0].select("features", "y", "w").collect()
    x = T.binned(np.array([r["features"].toArray() for r in rows]), edges)
    y, w = np.array([r["y"] for r in rows]), np.array([r["w"] for r in rows])
    g, h = w * (.5 - y), w * .25
    part = lambda i: g[i].sum() ** 2 / (h[i].sum() + 1)
    best = max((.5 * (part(x[:, j] <= c) + part(x[:, j] > c) - part(x[:, j] >= 0)), -j, -c) for j in range(4) for c in range(len(edges[j])))
    t = m.trees[0]
    assert (t["feature"][0], t["bin"][0]) == (-best[1], -best[2]) and t["gain"][0] == pytest.approx(best[0])
    left = x[:, t["feature"][0]] <= t["bin"][0]
    assert t["value"][t["left"][0]] == pytest.approx(-g[left].sum() / (h[left].sum() + 1))


def test_unlimited_depth_parts_every_row():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 32, (400, 6)).astype(np.uint8)
    x[:, 5] = np.arange(400) % 32
    y = rnd.integers(0, 2, 400).astype(float)
    tree = T.grow_bag(x, y, np.ones(400), 1 << 30, 2, np.random.default_rng(2), 32)
    assert ((tree["value"][T.walk(tree, x)] > .5) == (y > .5)).mean() > .99
    shallow = T.grow_bag(x, y, np.ones(400), 2, 2, np.random.default_rng(2), 32)
    assert (shallow["feature"] >= 0).sum() <= 3
    pure = T.grow_bag(x, np.ones(400), np.ones(400), 5, 2, np.random.default_rng(2), 32)
    assert pure["value"].tolist() == [1.0]


def test_bags_are_poisson_and_bounded(table, edges):
    ids = np.arange(200_000)
    for rate in (1.0, .3):
        k = T.poisson(T.uniform(ids, 42, 5), rate)
        assert k.mean() == pytest.approx(rate, abs=.01) and k.var() == pytest.approx(rate, abs=.02)
        assert (k == 0).mean() == pytest.approx(math.exp(-rate), abs=.01)
    assert abs(np.corrcoef(T.uniform(ids, 42, 5), T.uniform(ids, 42, 6))[0, 1]) < .01
    small = T.fit_forest(table, edges, 3000, "y", "w", numTrees=4, tree_rows=100)
    assert all((t["feature"] >= 0).sum() < 200 for t in small.trees)


@pytest.mark.parametrize("fit", [forest, boosted])
def test_saved_and_loaded(spark, halves, edges, fit, tmp_path):
    model = PipelineModel(stages=[fit(halves[0], edges)])
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    told = lambda m: m.transform(halves[1]).orderBy("row_id").select(vector_to_array("probability").alias("p"), "prediction").collect()
    assert told(model) == told(back)
    assert back.stages[-1].featureImportances == model.stages[-1].featureImportances
    assert sum(back.stages[-1].featureImportances.toArray()) == pytest.approx(1.0)


def test_equal_splits_go_to_the_first_slot_in_any_chunks(halves):
    """A slot and its complement split alike: the sums' rounding must not choose,
    nor the number of chunks (75: their sums are added in two steps)."""
    mirrored = VectorAssembler(inputCols=[*NUM, "e"], outputCol="wider").transform(halves[0].withColumn("e", 1 - F.col("d")))
    edges = T.bin_table(mirrored, NUM[:3], 5)
    fits = [boosted(mirrored, edges, features="wider", columnRate=1.0, maxIter=5, fold=3, chunk_rows=n) for n in (1500, 400, 20)]
    assert any((t["feature"] == 3).any() for t in fits[0].trees)
    assert not any((t["feature"] == 4).any() for m in fits for t in m.trees)
    for other in fits[1:]:
        same_trees(fits[0], other, exact=False)


def test_sums_of_a_chunk_are_those_of_its_rows():
    rnd = np.random.default_rng(5)
    edges = [[.1 * i for i in range(7)], [.5], [.5], [0, .5], []]
    x = np.stack([rnd.integers(0, len(e) + 1, 300) for e in edges], axis=1).astype(np.uint8)
    b = T._Boosting(edges, 1, .1, 3, .8, 1.0, 1.0, 0.0)
    at, ones = np.nonzero(x[:, b.narrow])
    w, m = rnd.random(300), rnd.normal(size=300)
    y = rnd.integers(0, 2, 300).astype(float)
    parts = [np.arange(300), np.ascontiguousarray(x[:, b.wide].T), ones.astype(np.int32), at.astype(np.int32), y, w, m]
    c = T._Chunk([p.tobytes() for p in parts], b)
    assert (c.x.T == x).all()
    node, used = rnd.integers(0, 6, 300), np.array([0, 1, 3, 4])
    got = b.opened(b.sums(c, b.slopes(c, 2), node, [2, 5], used), [2, 5], used)
    p = 1 / (1 + np.exp(-m))
    on = T.uniform(np.arange(300), 1, 2) < .8
    for i, v in enumerate((2, 5)):
        for k, s in enumerate(used):
            for bin_ in range(8):
                r = on & (node == v) & (x[:, s] == bin_)
                assert got[i, k, bin_] == pytest.approx([(w * (p - y))[r].sum(), (w * p * (1 - p))[r].sum()], abs=1e-9)


def test_a_large_forest_stays_a_table(spark, halves, edges, tmp_path, monkeypatch):
    """Fitting, saving, loading and scoring never bring the trees to the driver;
    scores equal those of the shipped trees, equal rows and all columns kept."""
    model = forest(halves[0], edges)
    rows = halves[1].withColumn("more", F.lit("x")).union(halves[1].limit(50).withColumn("more", F.lit("y")))
    p = vector_to_array("probability")
    told = lambda m: m.transform(rows).orderBy("row_id", "more").select("row_id", "more", "prediction", p[1].alias("p")).collect()
    want = told(model)
    size = model.told["bytes"]
    assert size == sum(a.nbytes for t in model.trees for a in t.values())
    monkeypatch.setattr(T, "TREE_BYTES", size // 4)
    monkeypatch.setattr(T, "SCORE_ROWS", 400)
    monkeypatch.setattr(T.TreeModel, "trees", property(lambda self: pytest.fail("trees asked for")))
    again = forest(halves[0], edges)
    assert again.large and again.featureImportances == model.featureImportances
    PipelineModel(stages=[again]).write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m")).stages[-1]
    assert back.large and back.transform(rows).columns == [*rows.columns, "prediction", "probability"]
    for m in (again, back):
        got = told(m)
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r["p"] for r in got] == pytest.approx([r["p"] for r in want])


def test_a_bag_is_drawn_from_all_rows(halves, edges):
    """However many rows there are: bags were cut to 200,000 of them."""
    fit = lambda n: T.fit_forest(halves[0], edges, n, "y", "w", numTrees=3, seed=7)
    whole, told_more = fit(1500), fit(1500 * 4000)
    same_trees(whole, told_more, exact=False)
    assert all((t["feature"] >= 0).sum() > 100 for t in whole.trees)


@pytest.mark.parametrize("depth, rows", [(None, 200), (4, 1)])
def test_a_bag_larger_than_a_task_holds_gives_the_same_forest(halves, edges, depth, rows, monkeypatch):
    """The top of such a tree is grown from sums over the chunks, the rest in
    units; the units' values add up to the tree's."""
    fit = lambda: forest(halves[0], edges, numTrees=4, maxDepth=depth)
    whole = fit()
    row = 8 * T._Growing(*T._kinds(edges), 32, 2, 9).row_words
    monkeypatch.setattr(T, "CHUNK_ROWS", 300)
    monkeypatch.setattr(T, "BAG_BYTES", rows * row)
    parts = fit()
    assert parts.told["trees"] == whole.told["trees"] == 4
    assert depth or len(parts.trees) > 8
    assert parts.featureImportances.toArray() == pytest.approx(whole.featureImportances.toArray())
    told = lambda m: [r["p"] for r in m.transform(halves[1]).orderBy("row_id").select(vector_to_array("probability")[1].alias("p")).collect()]
    assert told(parts) == pytest.approx(told(whole))
    monkeypatch.setattr(T, "TREE_BYTES", parts.told["bytes"] // 3)  # scored by a join, too
    assert told(parts) == pytest.approx(told(whole))


def test_a_tree_splits_alike_from_narrow_and_wide_slots():
    """Slots of two bins are summed from bits: the tree is that of their bins."""
    rnd = np.random.default_rng(8)
    edges = [[.5], [.1 * i for i in range(9)], *[[.5]] * 70, []]
    x = np.stack([rnd.integers(0, len(e) + 1, 500) for e in edges], axis=1).astype(np.uint8)
    y, w = rnd.integers(0, 2, 500), rnd.choice([1.0, 1.7, 2.0], 500)
    wide, narrow = T._kinds(edges)
    key, s = np.array([9], np.uint64), np.where(y == 1, w, -w)
    packed = T._Growing(wide, narrow, 10, 5, 1 << 30)
    rows, plain = packed.pack(x, s), T._Growing(np.arange(len(edges)), np.arange(0), 10, 5, 1 << 30)
    tree, other = packed.grow([rows], [500], key, [0]), plain.grow([plain.pack(x, s)], [500], key, [0])
    for k, _ in T.FIELDS:
        assert np.allclose(tree[k], other[k])
    assert (packed.descend(tree, rows) == T.walk(tree, x)).all()
    assert ((tree["value"][T.walk(tree, x)] > .5) == (y == 1)).all()
    low = x[:, tree["feature"][0]] <= tree["bin"][0]
    gini = lambda i: (w[i & (y == 1)].sum() ** 2 + w[i & (y == 0)].sum() ** 2) / w[i].sum()
    assert tree["gain"][0] == pytest.approx(gini(low) + gini(~low) - gini(y >= 0))
    tried = packed.looks(key, 0)[0]
    cuts = [gini(x[:, j] <= c) + gini(x[:, j] > c) for j in tried for c in range(len(edges[j])) if 0 < (x[:, j] <= c).sum() < 500]
    assert tree["gain"][0] == pytest.approx(max(cuts) - gini(y >= 0))
    assert sorted(np.concatenate([packed.looks(key, i)[0] for i in range(0, len(edges), 5)])) == list(range(len(edges)))


def test_rounds_of_held_rows_are_those_of_chunks_that_travel(halves, edges, monkeypatch):
    """Jobs get the tree so far and give sums of rows that stay where they are: the
    trees are those of jobs over the chunks, also if the files are lost on the way."""
    fit = lambda: boosted(halves[0], edges, maxIter=3, fold=2, chunk_rows=400)
    held, over, calls = fit(), T._rounds_over_chunks, []
    monkeypatch.setattr(T, "DIRECT", 2)  # sums over chunks are added in two steps
    monkeypatch.setattr(T, "_rounds_over_chunks", lambda *a: calls.append(len(a[4])) or over(*a))
    asked, lost = T._asked, iter([False] * 4 + [True] + [False] * 20)

    def ask(shares, *a):
        if next(lost):
            shares.foreach(lambda s: T.shutil.rmtree(s[1]))
        return asked(shares, *a)

    monkeypatch.setattr(T, "_asked", ask)
    same_trees(held, fit(), exact=False)
    assert not calls and next(lost) is False
    lost = iter([False] * 3 + [True] * 20)  # again and again
    same_trees(held, fit(), exact=False)
    assert calls == [1]
    monkeypatch.setattr(T, "SHARE_ROWS", 1)
    same_trees(held, fit(), exact=False)
    assert calls == [1, 0]


def test_a_share_sums_its_rows_as_their_chunks():
    """A share's sums and margins are those of ``_Chunk``; a level that is asked for
    again gives the same; a share without rows has sums of zero."""
    rnd = np.random.default_rng(6)
    edges = [[.1 * i for i in range(7)], [.5], *[[.5]] * 70, [0, .5], []]
    b, chunks = T._Boosting(edges, 1, .1, 3, .8, .9, 1.0, 0.0), []
    for c in range(2):
        x = np.stack([rnd.integers(0, len(e) + 1, 300) for e in edges], axis=1).astype(np.uint8)
        at, ones = np.nonzero(x[:, b.narrow])
        parts = [np.arange(300) + 300 * c, np.ascontiguousarray(x[:, b.wide].T), ones.astype(np.int32), at.astype(np.int32),
                 rnd.integers(0, 2, 300).astype(float), rnd.random(300), rnd.normal(size=300)]
        chunks.append([p.tobytes() for p in parts])
    share, both, asked = T._Share(T._Share.write(chunks, b, []), b), [T._Chunk(p, b) for p in chunks], []
    known = [b.start(), b.start()]
    for turn in (0, 1):
        before = b.arrays(known[0]) if turn else None

        def ask(level, *now):
            got = share.answer(turn, level, before, *now)
            assert (share.answer(turn, level, before, *now) == got).all()
            asked.append((level, len(now[2]), len(now[3])))
            return got

        tree, used, active, nodes = T._grown_by(b, turn, ask), b.usable(turn), [0], [np.zeros(300, np.int64) for _ in both]
        for _ in range(3):
            sums = sum(b.sums(c, b.slopes(c, turn), n, active, used) for c, n in zip(both, nodes))
            active = b.split(known[turn], active, b.opened(sums, active, used), used)
            nodes = [c.step(b.arrays(known[turn]), n, 1) for c, n in zip(both, nodes)]
        for k, _ in T.FIELDS:
            assert np.allclose(tree[k], known[turn][k])
        for c, n in zip(both, nodes):
            c.m = c.m + np.array(known[turn]["value"])[n]
    assert asked[:3] == [(0, 1, 1), (1, 2, 1), (2, 4, 2)]  # of two children one is summed
    again = T._Share(T._Share.write(chunks, b, [b.arrays(t) for t in known]), b)
    assert np.allclose(again._load("m-2"), np.concatenate([c.m for c in both]))
    empty = T._Share(T._Share.write([], b, []), b)
    assert not T._grown_by(b, 0, lambda level, *now: empty.answer(0, level, None, *now))["value"].any()
