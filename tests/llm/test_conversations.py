"""The conversation trie against nodes made from whole prefixes, with screens wide and useless."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from taskcurate.llm import conversations

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in held.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = (*turns.get(c - c % 20, [])[:h], *own[h:])
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = defaultdict(set)
    for n in members:
        if n:
            children[n[:-1]].add(n)
    out = []
    for n, m in members.items():
        tree = [u for u in members if u[: len(n)] == n]
        saved = sum((len(members[u]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", u[-1][1])) for u in tree if u)
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(n))))
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), sum(not children[u] for u in tree), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, width=None, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).withColumn("k", F.lit("y")).repartition(parts)
    out = conversations.prefix_trie(*conversations.rebuilt(df), width)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def talks(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(0, 90), 100, 119, 140, 4096, 8191, 10**12]:
        for t in range(r.choice((0, 1, 1, 2, 3, 5, 9))):
            rows.append((c, t, r.choice(("user", "assistant", None)), r.choice(("hi there", "hello", "", None, "why  not\n now", f"own {c}"))))
    rows += [(c, t, "user", f"long talk {t}") for c in (200, 201, 202, 220) for t in range(300)]  # equal long conversations
    rows += [(300, None, "user", "first"), (300, 5, "user", "then"), (None, 1, "user", "no one's"), (7, 50, None, None), (320, -3, "a", "b"), (320, 2, "a", "c")]
    return rows


@pytest.mark.parametrize("width", [None, 8, 64])
def test_nodes(spark, width):
    rows = talks(1)
    assert trie(spark, rows, width) == brute(rows)


def test_role_and_text_are_apart(spark):
    rows = [(0, 0, "ab", "c"), (20, 0, "a", "bc"), (40, 0, "ab", "c"), (60, 0, "", "abc"), (80, 0, None, "abc")]
    assert trie(spark, rows) == brute(rows)


def test_turnless_and_empty(spark):
    borrowing = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(borrowing, 0, "user", "mine")]  # its own first three turns are replaced, and conversation 20 is absent
    assert trie(spark, rows) == brute(rows) == [(borrowing, 0, None, 1, 0, 1, 0, hashlib.sha256(str(borrowing).encode()).hexdigest())]
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_most_conversations_equal(spark):
    rows = [(c, t, "user", "same") for c in range(0, 12000, 20) for t in range(4)] + [(c, 0, "user", f"other {c}") for c in range(12000, 12400, 20)]
    assert trie(spark, rows) == brute(rows)


def test_equal_turn_numbers_give_one_result(spark):
    rows = [(0, 1, "user", f"text {i}") for i in range(6)] + [(20, 1, "user", f"text {i}") for i in range(6)] + [(0, 1, "user", "text 1")]
    assert trie(spark, rows) == trie(spark, rows[::-1], parts=1)


def test_sketch_counts_once_and_more(spark):
    rows = [(c, t, "u", f"{c % 50} {t}") for c in range(0, 2000, 20) for t in range(3)]
    paths = conversations.prefixes(*conversations.rebuilt(spark.createDataFrame(rows, SCHEMA)))
    found = conversations.screened(paths, 1 << 16)
    wide = found.where("depth > 0").groupBy("depth", "dx", "dy").agg(F.count("*").alias("n"), F.max("once").alias("once")).collect()
    assert all(r.n == 1 for r in wide if r.once) and sum(r.n == 1 and not r.once for r in wide) < 3
    narrow = conversations.screened(paths, 8).where("once and depth > 0").count()
    assert narrow == 0
