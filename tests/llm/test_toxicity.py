"""Restoring disguised words against every path of the lattice, and scores against sums of weights."""

import itertools
import math
import random
from collections import Counter

import duckdb
import pytest

from taskcurate.llm import catalog, toxicity

from tests.conftest import SF_DIR

from . import fixtures

SPOKEN = "idiot moron stupid loser losers shit ass what you are a an here real balloon letter see wow plain you're good people think".split()


@pytest.fixture(scope="module")
def restorer():
    texts = duckdb.sql(f"SELECT coalesce(text, '') FROM '{SF_DIR}/documents.parquet'").fetchall()
    words = Counter(toxicity.stripped(w) for (t,) in texts for w in t.lower().split()) + Counter({w: 40 for w in SPOKEN})
    return toxicity.Restorer(toxicity.trigrams(words.items()))


@pytest.mark.parametrize(
    ("token", "word"),
    [("1d10t", "idiot"), ("idiooot", "idiot"), ("m0r0n", "moron"), ("a$$", "ass"), ("loser$", "losers"), ("5h17", "shit"), ("a55", "ass"), ("iiddiioott", "idiot"), ("$tup1d", "stupid"), ("id*ot", "idiot"), ("idiot!", "idiot"), ("stuuupid", "stupid"), ("(idiot", "idiot"), ("i" + "d" * 60 + "iot", "idiot")],
)
def test_disguises(restorer, token, word):
    assert restorer.restore(toxicity.stripped(token)) == word


@pytest.mark.parametrize("token", ["plain", "2024", "1000", "balloon", "letter", "wow", "3.5", "x" * 2, "a" + "bc" * 40])
def test_plain_tokens_stay(restorer, token):
    assert restorer.restore(toxicity.stripped(token)) == token


@pytest.mark.parametrize(
    ("text", "words"),
    [("what a m o r o n", ["what", "a", "moron"]), ("s t u p i d i d i o t", ["stupid", "idiot"]), ("an i-d-i-o-t here", ["an", "idiot", "here"]), ("$ t u p 1 d", ["stupid"]), ("1 2 3 4 5 6", ["123456"]), ("i.d.i.o.t", ["idiot"])],
)
def test_runs_are_cut_into_words(restorer, text, words):
    assert sorted(restorer.words(text).elements()) == sorted(words)


def brute(r, places, breaks):
    """Best path of a lattice by trying every one."""
    best = (-math.inf, "")
    ends = itertools.product((False, True), repeat=len(places) - 1) if breaks else [(False,) * (len(places) - 1)]
    for cut in ends:
        for path in itertools.product(*places):
            score, two, said = 0.0, "^^", ""
            for (x, cost), end in zip(path, (False, *cut), strict=True):
                if end:
                    score, two, said = score + r.step(two, ".") + toxicity.COST_BREAK, "^^", said + " "
                score += cost
                for c in x:
                    score, two = score + r.step(two, c), two[1] + c
                said += x
            best = max(best, (score + r.step(two, "."), said))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_best_path(restorer, seed):
    r = random.Random(seed)
    places = restorer.lattice("".join(r.choice("1!aido0tt$5s") for _ in range(r.randrange(1, 7))))
    for breaks in (False, True):
        got, want = restorer.best(places, breaks), brute(restorer, places, breaks)
        assert got[0] == pytest.approx(want[0])


def test_trigrams_are_those_of_each_word():
    counted, want = [("idiot", 2), ("a", 3), ("été", 1), ("x-y", 5), ("", 4), ("don", 1)], Counter()
    for w, n in counted:
        if w.isalpha():
            for i in range(len(w) + 1):
                want[f"^^{w}."[i : i + 3]] += n
    assert toxicity.trigrams(counted) == want


def test_scores_are_sums_over_the_features(restorer):
    counts = {"^^a": 1}
    weights = {"=idiot#1": 1.5, "idi#2": -0.25, "mor#4": 2.0, "#": -1.0}
    scorer = toxicity.Scorer(counts, weights)
    for text in (None, "", "idiot", "idiot idiocy plain", "moron morons morose, moral; " * 3):
        met = Counter(p for w in (text or "").split() for p in toxicity.pieces(toxicity.stripped(w)))
        x = -1.0 + sum(v for f, v in weights.items() if f != "#" and met[f.split("#")[0]] >= int(f.split("#")[1]))
        assert scorer.score(text) == pytest.approx(1 / (1 + math.exp(-x)))


def score(spark, docs, labels):
    df = toxicity.scores(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return {r.doc_id: (round(r.score, 6), r.predicted) for r in df.collect()}


def test_labels_without_documents_give_zero(spark):
    docs = [(i, f"you idiot {i}" if i % 2 else f"good day {i}") for i in range(40)]
    assert set(score(spark, docs, [(1000 + i, 0, i % 2) for i in range(40)]).values()) == {(0.0, 0)}
    assert set(score(spark, docs, [(i, 0, 1) for i in range(40)]).values()) == {(0.0, 0)}


def test_contradicting_labels_are_not_used(spark):
    docs = [(i, f"you idiot {i}" if i % 2 else f"good day {i}") for i in range(60)]
    clear = [(i, 0, i % 2) for i in range(40)]
    muddled = clear + [(i, 0, y) for i in range(40, 60) for y in (0, 1)]
    got = score(spark, docs, muddled)
    assert got == score(spark, docs, clear) and all(p == d % 2 for d, (_, p) in got.items())


def test_every_row_has_a_score(spark, tmp_path):
    folder = fixtures.hard(tmp_path)
    rows = catalog.QUERIES["op5_toxicity"](spark, folder).collect()
    assert len(rows) == catalog.table(spark, folder, "documents").count() and len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert all(0 <= r.score <= 1 for r in rows)
