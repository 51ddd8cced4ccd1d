"""Near-duplicates of the pipeline against all pairs of shingle sets."""

import random
from collections import Counter

import pytest

from taskcurate.llm import neardup

from . import fixtures


def brute(texts):
    """doc_id -> smallest doc_id of its component, over all pairs of 5-word similarity 0.8 or more."""
    words = {d: t.lower().split() for d, t in texts.items()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in words.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(sets):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


@pytest.mark.parametrize("few", [1, neardup.FEW])
def test_pairs_of_similarity_08(spark, monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW", few)
    r, texts = random.Random(8), []
    for k in range(12):
        base = fixtures.prose(200 + k, 160).split()
        texts.append(base)
        for changes in (1, 2, 3, 4, 6):  # a changed word costs five shingles: similarity 0.94 down to 0.68
            other = list(base)
            for i in r.sample(range(0, 160, 8), changes):
                other[i] = f"changed{i}"
            texts.append(other)
    texts = dict(enumerate(map(" ".join, texts)))
    want = brute(texts)
    assert Counter(want.values()).most_common(1)[0][1] < 7 and len(set(want.values())) < len(texts) / 2
    rows = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in rows} == want
    assert {x.doc_id for x in rows if x.stays} == set(want.values())


def test_stage_takes_them(spark):
    """Two texts of similarity 0.8 to 0.9, whose three-word fingerprints differ in over three bits, are one."""
    import corpus_pipeline as cp
    from taskcurate.llm import simhash

    a = fixtures.prose(300, 160).split()
    b = [f"changed{i}" if i in (30, 70, 110) else w for i, w in enumerate(a)]
    assert (simhash.fingerprint(" ".join(a)) ^ simhash.fingerprint(" ".join(b))).bit_count() > 3
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, fixtures.prose(301, 160))], "doc_id long, text string")
    assert sorted(r.doc_id for r in cp.STAGES[2][1](spark, docs, "").collect()) == [1, 3]


def near_copies(n, seed, changes):
    """``n`` copies of one text with random words changed: most pairs are just below the limit, many to the base just above."""
    r, base, out = random.Random(seed), fixtures.prose(seed, 200).split(), []
    for k in range(n):
        other = list(base)
        for i in r.sample(range(0, 200, 5), r.choice(changes)):
            other[i] = f"changed{k}x{i}"
        out.append(" ".join(other))
    return out


@pytest.mark.parametrize(("few", "many"), [(16, 256), (4, 16)])
def test_a_large_group_of_near_copies(spark, monkeypatch, few, many):
    """Weakly linked copies: bounded rounds, and the components of all pairs."""
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "MANY", many)
    rounds, stored = [], neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df: rounds.append(1) or stored(df))
    texts = dict(enumerate(near_copies(150, 400, (0, 2, 3, 4, 5)) + near_copies(60, 401, (1, 2))))
    want = brute(texts)
    rows = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    got = {x.doc_id: x.component_id for x in rows}
    assert len(rounds) < 60
    if many == 256:
        assert got == want
    else:  # a split bucket needs a second agreeing key
        assert all(want[d] == want[c] for d, c in got.items())
        assert sum(got[d] == want[d] for d in want) >= 0.98 * len(want)


def test_pipeline_drops_the_components_of_op9(spark):
    """The stage keeps one text of each component of fingerprints, and not by another measure of likeness."""
    import corpus_pipeline as cp
    from taskcurate.llm import simhash

    words = [f"w{i}" for i in range(60)]
    texts = {1: " ".join(words), 2: "  ".join(words), 3: " ".join(words[:57] + ["x", "y", "z"]), 4: "other text here now", 5: None, 6: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prints = {d: simhash.fingerprint(t) for d, t in texts.items()}
    assert 3 < (prints[1] ^ prints[3]).bit_count()  # alike at 0.8 and more, but no link
    stage = dict(cp.STAGES)["SimHash near-dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == [1, 3, 4, 5]
