"""Filter audit, SimHash classes and conversation repair against plain versions."""

import itertools
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from asterion.llm import audit, simhash, turns  # noqa: E402
from asterion.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"
CLASHING = ", part string, fails string, digest string, good string, mask string, n string, fp string, rep string, comp string"
EXTRA = ("x",) * 9


def documents(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], "doc_id bigint, text string, lang string" + CLASHING)


def odd_documents():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    out = [(1, None, None), (2, "", ""), (3, " \t\n\x0b\x0c\r", "de"), (None, "no id", "de"), (None, "no id", "de"), (4, "no id", "de"), (5, "no id", "fr"), (5, "no id", "de"), (5, "no id", "de"),
           (6, "A\x1cB C", "en"), (7, "a b\x85c " * 120, "en"), (8, "x|y", None), (9, "ABC " * 60, "en"), (10, "x" * 1_200_000 + " # " + "yz " * 400_000, "en")]
    for k in range(20, 60):
        out.append((k, " ".join(word() for _ in range(r.choice([3, 199, 200, 201, 260]))) + r.choice(["", "$", " QQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQQ"]), r.choice(["en", "de", None])))
    return out + [(k, out[20][1], "en") for k in range(100, 140)]


def test_swaps_visit_every_order():
    for n in range(6):
        order, seen = list(range(n)), [tuple(range(n))]
        for k in audit.adjacent_swaps(n):
            order[k], order[k + 1] = order[k + 1], order[k]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_diagram_holds_its_counts_in_every_order():
    r = random.Random(1)
    counts = {m: (r.randint(1, 9), r.randint(0, 3)) for m in r.sample(range(32), 11)}
    d = audit.Diagram(counts, 5)
    for k in [0, *audit.adjacent_swaps(5)]:
        d.swap(k)
        left = dict(counts)
        for f, kept, gone in d.steps():
            out = [left.pop(m) for m in list(left) if m >> f & 1]
            assert gone.tolist() == [sum(x[i] for x in out) for i in range(2)] and kept.tolist() == [sum(x[i] for x in left.values()) for i in range(2)]
    empty = audit.Diagram({}, 5)
    empty.swap(2)
    assert [k.tolist() for _, k, _ in empty.steps()] == [[]] * 5


def test_filter_audit(spark):
    rows = odd_documents()
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 130, 2)] + [(20, None, 1), (20, 1, None), (None, 1, 1), (999, 1, 1), (5, 1, 1)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels]
    got = audit.audit(documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    want = brute.audit(rows, labels)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()} == want
    assert got.count() == 600 * len({r[2] or "" for r in rows})
    assert audit.audit(documents(spark, []), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).count() == 0


def test_filter_audit_of_the_given_documents_equals_its_sql(spark):
    from oracle import compare, duck
    problem, n = compare(spark, duck(SF), QUERIES["op11_filter_audit"], audit.ORACLE, SF)
    assert problem is None and n == 2400


def test_fingerprints():
    texts = [t for _, t, _ in odd_documents()] + ["One", "one two", "ONE\x0btwo three", "a b c d", "é É ü"]
    assert simhash.fingerprints(texts).tolist() == [brute.simhash(t) for t in texts]


def ball(r, n):
    """Fingerprints around some centres, far and near."""
    centres = [r.getrandbits(64) for _ in range(6)]
    out = {0}
    while len(out) < n:
        x = r.choice(centres)
        for _ in range(r.randint(0, 9)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("leaf", [40, 1000])
def test_trees_lose_no_link(leaf):
    fps = np.array(ball(random.Random(leaf), 1500), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    met = np.zeros_like(near)
    for points in simhash.halves(fps):
        tree = simhash.Tree(np.sort(points[::3]), 3.0, leaf)
        at, index, home = tree.route(points)
        assert sorted(index[home].tolist()) == list(range(len(fps)))
        assert tree.leaves > 4 or leaf == 1000
        for k in range(tree.leaves):
            i, j = index[(at == k) & home], index[at == k]
            met[np.ix_(i, j)] = True
            met[np.ix_(j, i)] = True
    assert not (near & ~met).any()


@pytest.mark.parametrize("bounds", [{}, {"leaf": 30}, {"leaf": 60, "shard_rows": 40}])
def test_links_hold_every_class(spark, bounds):
    fps = ball(random.Random(5), 1200)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    pairs = [(int(a), int(b)) for a, b in simhash.links(table, **bounds).collect()]
    assert all(((a ^ b) & (2**64 - 1)) and a in set(signed) and b in set(signed) for a, b in pairs)
    parent = {x: x for x in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[find(a)] = find(b)
    want = brute.hamming_classes(dict(zip(signed, fps)))
    groups = lambda f: {frozenset(y for y in signed if f[y] == x) for x in set(f.values())}
    assert groups({x: find(x) for x in signed}) == groups(want)


def test_simhash_classes(spark):
    rows = odd_documents()
    base = rows[30][1].split()
    r = random.Random(9)
    for k in range(200, 260):  # near copies, some of them chained
        w = list(base)
        for _ in range(k % 4):
            w[r.randrange(len(w))] = "new"
        rows.append((k, " ".join(w), "en"))
    got = simhash.report(simhash.near_classes(documents(spark, rows)))
    fps = {k: brute.simhash(t) for k, t, _ in rows if k is not None}
    want = brute.hamming_classes(fps)
    have = got.collect()
    assert len(have) == len(rows)
    assert {(x.doc_id, x.fingerprint, x.component_id) for x in have if x.doc_id is not None} == {(k, f"{fps[k]:016x}", want[k]) for k in fps}
    assert {(x.fingerprint, x.component_id) for x in have if x.doc_id is None} == {(f"{brute.simhash('no id'):016x}", want[4])}
    alone = simhash.near_classes(documents(spark, [(None, "no id at all", "en")])).collect()
    assert [x.component_id for x in alone] == [None]
    assert simhash.near_classes(documents(spark, [])).count() == 0


def test_simhash_of_the_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {k: brute.simhash(t) for k, t in docs.items()}
    want = brute.hamming_classes(fps)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op12_simhash_dedup"](spark, SF).collect()} == {(k, f"{fps[k]:016x}", want[k]) for k in docs}


def same_repair(spark, rows):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, same string, nth string, h string")
    got = {r.conv_id: tuple(r)[1:] for r in turns.repair(table).collect()}
    assert got == brute.repaired(rows)
    return got


def test_repair_of_odd_rows(spark):
    r = random.Random(11)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "So."), (1, None, "user", "a."), (1, 3, "assistant", "b."), (1, 3, "assistant", "b."), (1, 3, "user", "c"), (2, 0, "", "x."), (2, 1, "tool", "y."),
            (3, 5, "user", "  \n"), (4, 1, "system", "s."), (5, 9, "user", "x" * 1_500_000), (5, 10, "assistant", "é.")]
    rows += [(6, k, "user", "same.") for k in range(40)] + [(7, k, "assistant", f"text {k}") for k in range(40)] + [(8, k, "system", f"{k}!") for k in range(30)]
    for conv in range(100, 400):
        for turn in range(r.randint(1, 9)):
            if r.random() < 0.9:
                rows.append((conv, turn, r.choice(["user", "assistant", "user", "assistant", "system", "uncle", None]), r.choice(["Yes.", "No!", "why", "", None, f"t{turn}.", f"t{turn}? \n"])))
    got = same_repair(spark, rows)
    assert len(got) == len({x[0] for x in rows})
    assert any(x[6] == "" for x in got.values()) and {"K", "R", "D"} <= set("".join(x[6] for x in got.values()))
    assert turns.repair(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_repair_of_the_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SF).collect()}
    assert got == brute.repaired(rows)


def test_survivors_coalesce():
    """A long conversation is held as a few unresolved turns, whatever its length."""
    r = random.Random(2)
    one = turns.Repair()
    for k in range(20_000):
        one.turn(r.choice(["user", "assistant", "assistant", "system"]), f"{k}.", r.random() < 0.1, r.random() < 0.1)
    assert one.most < 100
    cost, edits, _ = one.finish()
    assert len(edits.replace("I", "")) == 20_000 and cost > 0


@pytest.mark.parametrize("insert", [5, 1])
def test_every_short_conversation(monkeypatch, insert):
    """All conversations of up to four turns against all edit sequences; a cheap insertion makes many ties."""
    monkeypatch.setitem(turns.COSTS, "I", insert)
    for n in range(5):
        for roles in itertools.product("sua", repeat=n):
            for short in itertools.product([False, True], repeat=n):
                one = turns.Repair()
                for role, t in zip(roles, short):
                    one.turn(role, "x", False, t)
                assert one.finish()[:2] == cheapest(roles, short, insert)


def cheapest(roles, short, insert):
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    ways, best = [(0, "", 0, "")], None
    while ways:  # all edit sequences of bounded cost
        cost, edits, i, state = ways.pop()
        if best is not None and cost > best[0]:
            continue
        if i == len(roles) and state in ("", "a"):
            best = min(best or (cost, edits), (cost, edits))
        name = "a" if after[state] == "a" else "u"
        if cost + insert <= 2 * len(roles):
            ways.append((cost + insert, edits + "I", i, name))
        if i < len(roles):
            more = 5 if short[i] else 0
            ways.append((cost + 2, edits + "D", i + 1, state))
            if cost + more <= 2 * len(roles):
                ways.append((cost + more + 1, edits + "R", i + 1, name))
                if roles[i] in after[state]:
                    ways.append((cost + more, edits + "K", i + 1, roles[i]))
    return best
