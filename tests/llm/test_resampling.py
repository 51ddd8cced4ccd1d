"""Bit-sliced weights and ranks against sums over single features."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from taskcurate.llm import catalog, resampling

from . import fixtures


def features(text, run):
    w = resampling.words(text)
    return [b" ".join(w[i : i + n]) for n in range(1, run + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, run, buckets, percent, least):
    held = Counter(zlib.crc32(x) % buckets for _, t in docs for x in features(t, run))
    wanted = Counter(zlib.crc32(x) % buckets for t in target for x in features(t, run))
    s, t = sum(held.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((held[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for d, text in docs:
        own = features(text, run)
        weight = sum(gain[zlib.crc32(x) % buckets] for x in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(resampling.words(text)) >= least])
    best = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    ranks = {id(x): i + 1 for i, x in enumerate(best[: len(best) * percent // 100])}
    return sorted(((*x[:4], ranks.get(id(x))) for x in out), key=repr)


@pytest.mark.parametrize(("run", "buckets", "percent"), [(1, 10_000, 10), (3, 130, 60)])
def test_weights_scores_and_ranks(spark, tmp_path, run, buckets, percent):
    folder = fixtures.hard(tmp_path)
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = resampling.ranked(catalog.table(spark, folder, "documents"), catalog.table(spark, folder, "benchmark"), percent, 20, run, buckets)
    got = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows.collect()), key=repr)
    assert got == brute(docs, target, run, buckets, percent, 20)


def test_planes_give_the_exact_sum():
    r = np.random.default_rng(4)
    for buckets in (1, 63, 64, 65, 1000):
        counts, gain = r.integers(0, 1 << r.integers(1, 20), buckets), r.integers(-9000, 9000, buckets).tolist()
        sliced = resampling.weighted_sum(resampling.words_of(resampling.count_planes(counts), buckets), resampling.gain_planes(gain))
        assert sliced == sum(c * g for c, g in zip(counts.tolist(), gain, strict=True))


def test_words_are_those_of_the_pattern():
    import regex

    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice("aZ09 _é中İ🙂 \u0085\x1c\n/:`{~") for _ in range(40))
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert [w.decode() for w in resampling.words(text)] == regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_drawn_rows_come_whole(spark):
    docs = spark.createDataFrame([(i, " ".join(["good" if i % 3 else "bad", f"w{i}"] * 15), "x") for i in range(60)], "doc_id long, text string, score string")
    target = spark.createDataFrame([("good good good",)], "text string")
    got = resampling.resample(docs, target, percent=50)
    assert got.columns == docs.columns and got.count() == 30
    assert got.where(F.col("text").contains("good")).count() > 20
