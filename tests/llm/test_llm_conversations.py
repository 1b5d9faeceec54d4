"""Chat formatting, the prefix trie and structure repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from lendscope.llm import chat, oracles, repair, trie

TALK = "conv_id long, turn long, role string, text string, name string, depth long, code string, audit string"
W = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows():
    rnd = random.Random(5)
    texts = [None, "", " \t", "Hello there.", "Yes!", "no end", "[INST] x [/INST]", "</s>", "[\\INST]", "<\\\\</SYS>>", "a" * 30000 + ".", "é ❤️ ?"]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", "", "[SAYS]"]
    rows = []
    for conv in [*range(0, 48), 60, 61, 83, None]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, turn if rnd.random() < .9 else None, rnd.choice(roles[:rnd.choice([2, 5, 9])]), rnd.choice(texts)))
    rows += [r for r in rows if r[0] == 7] + [(40 + i, t, "user", "same.") for i in range(8) for t in range(3)]
    rows += [(100 + i, t, r, f"{t}.") for i in range(30) for t, r in enumerate(["user", "assistant"] * 3)]  # copies
    return [(*r, "x", 3, "y", "KK") for r in rows]


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame(odd_rows(), TALK).repartition(5)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    c.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in odd_rows()])
    return c


def same(df, con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    exp = sorted(res.fetchall(), key=key)
    assert got == exp


# --- op11 ----------------------------------------------------------------------

def test_every_text_of_control_parts_reads_back():
    parts = ["[INST]", "[/INST]", "</s>", "<<SYS>>", "<</SYS>>", "[TURN]", "[SAYS]", "[/TURN]", "\\", "[", "<", "INST]", "/s>", "x", "[\\INST]", "<\\/s>"]
    for n in (1, 2, 3):
        for t in itertools.product(parts, repeat=n):
            text = "".join(t)
            assert chat.unescape(chat.escape(text)) == text
            for role in ("user", "assistant", "system", "tool", "", text):
                piece, a, b = chat.render(role, text)
                assert chat.parse(piece) == [(role, text)] and chat.unescape(piece[a:b]) == text
    assert chat.render("user", "plain [x] < y")[0] == "[INST]plain [x] < y[/INST]"
    assert chat.parse("") == [] and chat.parse("[INST]a") is None and chat.parse("a[INST]b[/INST]") is None


def test_joined_pieces_read_back():
    rnd = random.Random(3)
    parts = ["[INST]", "[/INST]", "</s>", "<", "[", "\\", "a", "<<SYS>>", "[TURN]"]
    for _ in range(300):
        turns = [(rnd.choice(["user", "assistant", "system", "", "tool"]), "".join(rnd.choices(parts, k=rnd.randint(0, 4)))) for _ in range(6)]
        assert chat.parse("".join(chat.render(*t)[0] for t in turns)) == turns


def test_formatting_equals_sql_on_odd_rows(spark, talk, con):
    hostile = spark.createDataFrame(chat.HOSTILE, "conv_id long, turn long, role string, text string")
    rows = talk.select("conv_id", "turn", "role", "text").unionByName(hostile)
    pieces = chat.formatted_pieces(rows)
    same(chat.read_back(pieces), con, oracles.CHAT)
    same(chat.read_back(chat.formatted_pieces(talk.drop("name")).unionByName(chat.formatted_pieces(hostile))), con, oracles.CHAT)


def test_formatting_of_no_rows(spark, talk):
    assert chat.read_back(chat.formatted_pieces(talk.limit(0))).collect() == []


# --- op12 ----------------------------------------------------------------------

def brute_sums(parents, weights, hang):
    n = len(parents)
    children, leaves, sums = [0] * n, [0] * n, [0] * n
    depth = [0] * n
    for i in range(n):
        j = i
        while parents[j] >= 0:
            j, depth[i] = parents[j], depth[i] + 1
    for i in sorted(range(n), key=lambda i: -depth[i]):
        sums[i] += int(weights[i])
        leaves[i] += int(hang[i]) if hang[i] else int(children[i] == 0)
        if parents[i] >= 0:
            children[parents[i]] += 1
            leaves[parents[i]] += leaves[i]
            sums[parents[i]] += sums[i]
    return children, leaves, sums


@pytest.mark.parametrize("chain", [0.1, 0.5, 0.98])
def test_subtree_sums(chain):
    rnd = np.random.RandomState(4)
    for n in [0, 1, 2, 5, 63, 64, 65, 400]:
        up = np.array([(i - 1 if rnd.rand() < chain else rnd.randint(-1, i)) if i else -1 for i in range(n)], np.int64)
        mixed = rnd.permutation(n)
        parents = np.full(n, -1, np.int64)
        for i in range(n):
            if up[i] >= 0:
                parents[mixed[i]] = mixed[up[i]]
        weights, hang = rnd.randint(0, 9, n), np.where(rnd.rand(n) < .3, rnd.randint(1, 5, n), 0)
        assert tuple(x.tolist() for x in trie.subtree_sums(parents, weights, hang)) == brute_sums(parents.tolist(), weights, hang)
        bits, order = trie.encode(parents)
        assert sorted(order.tolist()) == list(range(n)) and bits.sum() * 2 == len(bits)


def test_findclose_over_many_blocks():
    deep = np.array([1] * 1000 + [0] * 1000, np.uint8)
    tree = trie.Parentheses(deep, block=8)
    assert [tree.findclose(i) for i in range(1000)] == [1999 - i for i in range(1000)]


@pytest.mark.parametrize("members,nodes", [(None, 50_000), (1, 7), (4, 10), (1000, 50_000)])
def test_trie_equals_sql_whatever_the_shards(talk, con, members, nodes):
    same(trie.trie(trie.rebuilt(talk), shard_members=members, shard_nodes=nodes), con, oracles.TRIE)


def test_trie_of_little(spark, talk):
    assert trie.trie(trie.rebuilt(talk.limit(0))).collect() == []
    one = spark.createDataFrame([(21, 0, "user", "a b"), (21, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    c = duckdb.connect()
    c.execute("CREATE TABLE conversations AS SELECT * FROM (VALUES (21::BIGINT, 0::BIGINT, 'user', 'a b'), (21, 1, 'assistant', 'c')) v(conv_id, turn, role, text)")
    same(trie.trie(trie.rebuilt(one)), c, oracles.TRIE)
    only = spark.createDataFrame([(None, 0, "user", "a")], one.schema)
    assert trie.trie(trie.rebuilt(only)).collect() == []


# --- op13 ----------------------------------------------------------------------

GOOD = re.compile(r"(s?(ua)+)?")
OPEN = re.compile(r"(s?(ua)*u?)?")


def cheapest(rows):
    """(cost, audit) by trying every sequence of edits."""
    best = (10 ** 9, "")

    def go(i, roles, cost, audit, inserts):
        nonlocal best
        if cost > best[0] or not OPEN.fullmatch(roles):
            return
        if i == len(rows) and GOOD.fullmatch(roles):
            best = min(best, (cost, audit))
        if inserts < 3:
            for r in "ua":
                go(i, roles + r, cost + 3, audit + "I", inserts + 1)
        if i < len(rows):
            initial, must_go, cut = rows[i]
            go(i + 1, roles, cost + 4, audit + "D", 0)
            if not must_go:
                go(i + 1, roles + initial if initial else roles + "?", cost + 3 * cut, audit + "K", 0)
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + 3 * cut, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best


def test_parse_finds_the_cheapest_edits():
    rnd = random.Random(6)
    for _ in range(400):
        rows = [(rnd.choice(["s", "u", "a", "x", " ", ""]), rnd.random() < .2, rnd.random() < .3) for _ in range(rnd.randint(0, 5))]
        p = repair.Parse()
        for r in rows:
            p.row(*r)
        assert p.audit() == cheapest(rows), rows


def test_stacks_follow_from_the_grammar():
    assert len(repair.STACKS) == 8 and max(len(s) for s in repair.STACKS) == 3
    assert [s for s, ok in zip(repair.STACKS, repair.ACCEPT) if ok] == [(), ("Pairs",), ("s", "Pairs")]


def test_repair_equals_sql_on_odd_rows(talk, con):
    rows = repair.damaged(talk)
    same(repair.digests(rows, repair.report(rows)), con, oracles.REPAIR)


def test_damage_by_remainder(spark):
    rows = [(c, 0, "assistant", "One. Two!") for c in range(200)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["role"], r["text"], r["copies"]) for r in repair.damaged(df).collect()}
    for c in range(200):
        fate = zlib.crc32(f"{c}:0".encode()) % 20
        assert got[c] == {0: ("assistant", "One. Two!", 0), 1: ("assistant", "", 1), 2: ("assistant", "One Two", 1),
                          3: ("assistant", "One. Two!", 2), 4: ("user", "One. Two!", 1)}.get(fate, ("assistant", "One. Two!", 1))
    assert got[None][1] in (" ", "")


def test_repaired_turns(spark, talk):
    rows = repair.undamaged(talk)
    reports = repair.report(rows)
    told = {}
    for r in repair.repaired_turns(rows, reports).collect():
        told.setdefault(r["conv_id"], []).append((r["place"], r["edit"], r["role"], r["text"]))
    for r in repair.digests(rows, reports).collect():
        turns = sorted(told.get(r["conv_id"], []))
        assert [t[0] for t in turns] == list(range(len(turns)))
        assert "".join(t[1] for t in turns) == r["audit"].replace("D", "")
        assert GOOD.fullmatch("".join(t[2][0] for t in turns))
        text = "\n".join(f"{t[2]}:{t[3]}" for t in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]
    assert repair.report(rows.limit(0)).collect() == []


def test_long_conversation_of_one_row_repeated(spark):
    rows = spark.range(3000).selectExpr("5L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id div 1000, '.') as text")
    r = repair.report(repair.undamaged(rows)).first()
    assert (r["gaps"], r["duplicate"], r["blank"], r["illegal"]) == (0, 2994, 0, 0) and len(r["audit"]) >= 3000
