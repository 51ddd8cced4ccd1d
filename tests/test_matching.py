"""Containment and interval joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from taskcurate.operators import entities as E
from taskcurate.operators import matching as M


@pytest.mark.parametrize("q", [1, 2, 3, 5])
def test_containing(spark, q):
    r = random.Random(q)
    word = lambda n: "".join(r.choice("aab_é🙂.[") for _ in range(r.randrange(n)))
    outer = [(r.randrange(3), word(14), i) for i in range(120)] + [(0, None, -1), (1, "", -2), (0, "a.b[c", -3)]
    inner = [(r.randrange(3), word(6), f"t{i % 4}") for i in range(60)] + [(0, None, "x"), (1, "", "y"), (0, ".b[", "z"), (0, ".b[", "z2")]
    got = M.containing(spark.createDataFrame(outer, "k int, o string, i int"), "o", spark.createDataFrame(inner, "k int, s string, t string"), "s", ["k"], q)
    want = [(a, o, i, s, t) for a, o, i in outer for b, s, t in inner if a == b and o and s and s in o]
    assert sorted(tuple(x) for x in got.select("k", "o", "i", "s", "t").collect()) == sorted(want)


def test_outer_texts_are_no_more_rows_than_their_length(spark):
    outer = spark.createDataFrame([(1, "x" * 50 + "".join(map(chr, range(65, 91))))], "k int, o string")
    inner = spark.createDataFrame([(1, "x" * n) for n in range(3, 60)], "k int, s string")
    assert M.containing(outer, "o", inner, "s", ["k"]).count() == 48
    assert len(outer.select(M.grams(F.col("o"), F.lit(3)).alias("g")).first().g) <= 76


@pytest.mark.parametrize("width", [1, 4, 64])
def test_cover_is_exact_and_short(spark, width):
    r = random.Random(width)
    rows = [(a, a + r.choice((0, 1, 7, 8, 63, 1000, 10**6 - 1)) - r.randrange(2)) for a in (r.randrange(10**r.randrange(1, 7)) for _ in range(300))] + [(1, 10**6), (0, 10**6 - 1), (1, 2**20 - 2)]
    for row in spark.createDataFrame(rows, "a long, b long").select("a", "b", M.cover(F.col("a"), F.col("b"), width).alias("c")).collect():
        first, last = row.a // width, max(row.a, row.b) // width
        parts = sorted((n.node << n.level, ((n.node + 1) << n.level) - 1) for n in row.c)
        assert parts[0][0] == first and parts[-1][1] == last
        assert all(x[1] + 1 == y[0] for x, y in zip(parts, parts[1:], strict=False))
        assert len(parts) <= 40


@pytest.mark.parametrize("width", [1, 8])
def test_inside(spark, width):
    r = random.Random(3)
    spans = [(r.choice("pq"), a, a + r.choice((0, 1, 5, 40, 300)), i) for i, a in enumerate(r.randrange(400) for _ in range(60))]
    places = [(r.choice("pqr"), r.randrange(500)) for _ in range(200)]
    got = M.inside(spark.createDataFrame(places, "f string, x int"), "x", spark.createDataFrame(spans, "f string, a int, b int, i int"), "a", "b", ["f"], width=width)
    assert got.columns == ["f", "x", "a", "b", "i"]
    assert sorted((x.f, x.x, x.i) for x in got.collect()) == sorted((f, x, i) for f, x in places for g, a, b, i in spans if f == g and a <= x <= b)
    assert M.inside(spark.createDataFrame(places, "f string, x int"), "x", spark.createDataFrame([], "f string, a int, b int, i int"), "a", "b", ["f"]).count() == 0


@pytest.mark.parametrize("top", [0, 1, 3])
def test_cover_up_to_a_level(spark, top):
    r = random.Random(top)
    rows = [(a, a + r.randrange(80)) for a in (r.randrange(200) for _ in range(200))]
    for row in spark.createDataFrame(rows, "a long, b long").select("a", "b", M.cover(F.col("a"), F.col("b"), 1, top).alias("c")).collect():
        assert sorted(i for n in row.c for i in range(n.node << n.level, (n.node + 1) << n.level)) == list(range(row.a, row.b + 1))
        assert max(n.level for n in row.c) <= top


@pytest.mark.parametrize("width", [1, 64])
def test_overlapping(spark, width):
    r = random.Random(width)
    spans = [(r.choice("pq"), a, a + r.choice((0, 3, 90, 5000)), i) for i, a in enumerate(r.randrange(1, 9000) for _ in range(50))]
    hunks = [(r.choice("pqr"), a, a + r.choice((0, 2, 70, 6000)), i) for i, a in enumerate(r.randrange(1, 9000) for _ in range(90))]
    got = M.overlapping(spark.createDataFrame(hunks, "f string, x int, y int, h int"), "x", "y", spark.createDataFrame(spans, "f string, a int, b int, s int"), "a", "b", ["f"], width)
    pairs = [(i.h, i.s) for i in got.collect()]
    met = [p for p in pairs if p[1] is not None]
    assert sorted(met) == sorted((h, s) for f, x, y, h in hunks for g, a, b, s in spans if f == g and a <= y and b >= x)
    assert {h for h, _ in pairs} == {h[3] for h in hunks}


def test_hunk_owners_over_long_spans(spark):
    r = random.Random(9)
    spans = [("f", r.choice(("function", "method", "class")), f"e{i}", a, a + r.choice((0, 9, 700, 10**6))) for i, a in enumerate(r.randrange(1, 5000) for _ in range(40))]
    hunks = [(i, "f", a, a + r.choice((-1, 0, 3, 900))) for i, a in enumerate(r.randrange(1, 6000) for _ in range(80))]
    got = E.hunk_owners(spark.createDataFrame(hunks, "h int, path string, first_line long, last_line long"), spark.createDataFrame(spans, "path string, kind string, name string, start_line long, end_line long"), ["h"], ["path"])
    want = {}
    for h, _, a, b in hunks:
        hit = sorted((s, n) for _, k, n, s, e in spans if k != "class" and s <= max(a, b) and e >= a)
        want[h] = hit[0][1] if hit else None
    assert {x.h: x.owner for x in got.collect()} == want


def test_hunks_move_as_one_row(spark):
    """Nested and equal spans, repeated ids, missing numbers: each hunk meets the spans of its file once."""
    r = random.Random(3)
    spans = [(r.choice("fg"), "function", r.choice("abc") + str(i % 5), a, r.choice((None, a, a - 3, a + 9, a + 400))) for i, a in enumerate(r.choice((None, *range(1, 300))) if i % 9 == 0 else r.randrange(1, 300) for i in range(50))]
    hunks = [(r.choice((None, *range(40))), r.choice(("f", "g", "h", None)), r.choice((None, 5, 90, 200, 700)), r.choice((None, 7, 90, 150, 800))) for _ in range(90)]
    got = E.hunk_owners(spark.createDataFrame(hunks, "h int, path string, first_line long, last_line long"), spark.createDataFrame([*spans, ("f", "method", None, 1, 999)], "path string, kind string, name string, start_line long, end_line long"), ["h"], ["path"])
    want = {}
    for h, f, a, b in hunks:
        if a is not None:
            hit = [(s, n) for g, _, n, s, e in spans if f == g and s is not None and s <= max(a, b or a) and max(s, e or s) >= a]
            want.setdefault(h, []).extend(hit)
    assert sorted((str(x.h), x.owner) for x in got.collect()) == sorted((str(h), min(hit)[1] if hit else None) for h, hit in want.items())
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_small_groups_are_not_cut(spark):
    """Few texts looked for in a group: outer texts stay whole rows; many: the same matches by parts."""
    r = random.Random(4)
    word = lambda n: "".join(r.choice("ab_") for _ in range(n))
    outer = [(k, word(9)) for k in range(6) for _ in range(30)] + [(0, ""), (1, None), (None, "ab")]
    inner = list({(k, word(1 + r.randrange(6))) for k in range(6) for _ in range(3 if k % 2 else 80)}) + [(0, ""), (1, None), (None, "a")]
    assert max(sum(k == x for k, _ in inner) for x in range(6)) > M.FEW
    o, i = spark.createDataFrame(outer, "k int, o string"), spark.createDataFrame(inner, "k int, s string")
    pairs = [(a, x, y) for a, x in outer for b, y in inner if a is not None and a == b and x and y]
    assert sorted(tuple(x) for x in M.containing(o, "o", i, "s", ["k"]).select("k", "o", "s").collect()) == sorted(p for p in pairs if p[2] in p[1])
    assert sorted(tuple(x) for x in M.ending(o, "o", i, "s", ["k"]).select("k", "o", "s").collect()) == sorted(p for p in pairs if p[1].endswith(p[2]))


def test_touched_entities_against_all_pairs(spark):
    """Every edited line against every span; lines are not rows of their own on the way."""
    r = random.Random(8)
    spans = list({(r.choice("pq"), "function", r.choice(("", "a", "b", "c", "d")), r.choice(("old", "new")), a, a + r.choice((0, 4, 60, 900))) for a in (r.randrange(1, 900) for _ in range(24))})
    lines = [(i, r.choice("pqr"), k, n if k != "added" else None, n if k != "deleted" else None) for i in range(40) for k, n in ((r.choice(("added", "deleted", "context")), r.randrange(1, 950)) for _ in range(5))]
    got = E.touched_entities(spark.createDataFrame(lines, "c int, path string, type string, old_line int, new_line int"), spark.createDataFrame(spans, "path string, kind string, name string, version string, start_line int, end_line int"), ["c"])
    there = {(p, n): {v for q, _, m, v, _, _ in spans if (p, n) == (q, m)} for p, _, n, _, _, _ in spans}
    state = lambda vs: "modified" if len(vs) == 2 else "added" if "new" in vs else "deleted"
    want = {(c, p, n, state(there[p, n])) for c, p, k, o, w in lines for q, _, n, v, a, b in spans if p == q and {"deleted": "old", "added": "new"}.get(k) == v and a <= (o or w) <= b}
    rows = [(x.c, x.path, x.name, x.status) for x in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_edits_are_bits(spark):
    """Lines and spans at the edges of a row of bits; spans without an end or that end before they start; nothing is collected."""
    edges = [0, 1, 62, 63, 64, 65, 127, 128, 191, 192, 1000]
    lines = [(i, "p", k, n if k == "deleted" else None, n if k == "added" else None) for i, (k, n) in enumerate((k, n) for k in ("deleted", "added") for n in [*edges, None])]
    spans = [("p", "function", f"{v}{a}-{b}", v, a, b) for v in ("old", "new") for a in edges for b in [*edges, None]]
    got = E.touched_entities(spark.createDataFrame(lines, "c int, path string, type string, old_line int, new_line int"), spark.createDataFrame(spans, "path string, kind string, name string, version string, start_line int, end_line int"), ["c"])
    at = lambda o, w: w if o is None else o
    want = {(c, n) for c, _, k, o, w in lines for _, _, n, v, a, b in spans if (k == "deleted") == (v == "old") and b is not None and at(o, w) is not None and a <= at(o, w) <= b}
    assert sorted((x.c, x.name) for x in got.collect()) == sorted(want)
    assert "collect_set" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_test_entities_are_read_once(spark):
    rows = spark.createDataFrame([(1, "t", "function", "f", "added"), (1, "s", "function", "f", "added"), (2, "t", "function", "g", "deleted")], "c int, path string, kind string, name string, status string")
    got = E.test_entities(rows, ["c"], F.col("path") == "t")
    assert [tuple(x) for x in got.collect()] == [(1, "t", "function", "f")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
