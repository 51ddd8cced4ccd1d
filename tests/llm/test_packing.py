"""Packing by the grouping genetic algorithm: pieces against the tokenizers library, bins against their bounds."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from taskcurate.llm import catalog, packing
from tests.conftest import SF_DIR

from . import fixtures


@pytest.fixture(params=["hard", "given"])
def sf_dir(request, tmp_path_factory):
    return fixtures.hard(tmp_path_factory.mktemp("hard")) if request.param == "hard" else SF_DIR


def plain_best_fit(sizes, room):
    """Best fit, longest first, one piece at a time."""
    left = []
    for s in sorted(sizes, reverse=True):
        fits = [x for x in left if x >= s]
        best = min(fits) if fits else room
        if fits:
            left.remove(best)
        left.append(best - s)
    return len(left)


def brute_pieces(texts):
    from tokenizers import Tokenizer

    t, out = Tokenizer.from_file(catalog.BYTE_BPE), []
    for d, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0] if len(ids) % 1024 else []
        cuts += range(len(ids) % 1024, len(ids) + 1, 1024)
        out += [(d, k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return out


def test_every_piece_has_its_place(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = catalog.QUERIES["op11_packing"](spark, sf_dir).collect()
    want = brute_pieces(docs)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 1024
    sizes = [x[3] for x in want]
    assert -(-sum(sizes) // 1024) <= len(bins) <= plain_best_fit(sizes, 1024)


def test_ids_stay_with_their_piece(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None), (2, "word " * 3000)], "doc_id long, text string")
    rows = packing.packed(docs, catalog.BYTE_BPE_RANKS, keep_ids=True).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32 for r in rows)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) and sum(r.doc_id == 1 for r in rows) == 2


def used(genes):
    out = defaultdict(int)
    for p, n in genes:
        for s, c in p:
            out[s] += n * c
    return dict(out)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_by_counts_is_best_fit_by_pieces(seed):
    r = random.Random(seed)
    sizes = [r.choice((r.randrange(1, 101), r.randrange(30, 60), 100)) for _ in range(200)]
    counts = {s: sizes.count(s) for s in sizes}
    genes = packing.best_fit(counts, 100)
    assert used(genes) == counts and all(packing.filled(p) <= 100 for p, _ in genes)
    assert packing.fitness(genes, 100)[0] == plain_best_fit(sizes, 100)


@pytest.mark.parametrize("seed", range(4))
def test_crossover_and_mutation_keep_every_piece_once(seed):
    r = random.Random(seed)
    counts = {r.randrange(1, 101): r.randrange(1, 40) for _ in range(30)}
    one, other = packing.best_fit(counts, 100), packing.best_fit(counts, 100, (), r)
    child = packing.crossover(one, other, counts, 100, r)
    left, genes = packing.swapped({44: 3, 31: 2}, [(((40, 1), (30, 1), (10, 1)), 2), (((25, 2), (20, 1)), 4)], 100)
    assert Counter(used(genes)) + Counter(left) == Counter({44: 3, 31: 2, 40: 2, 30: 2, 10: 2, 25: 8, 20: 4}) and all(packing.filled(p) <= 100 for p, _ in genes)
    for genes in (child, packing.mutated(child, 100, r)):
        assert used(genes) == counts and all(packing.filled(p) <= 100 for p, _ in genes)


@pytest.mark.parametrize("seed", range(6))
def test_evolution_beats_best_fit(seed):
    """Pieces cut from 25 full bins: best fit needs 26."""
    r, counts = random.Random(seed), defaultdict(int)
    for _ in range(25):
        left = 100
        while left:
            s = min(left, r.randrange(8, 45))
            s = left if left - s < 8 else s
            counts[s] += 1
            left -= s
    population = packing.evolve([], dict(counts), 100, random.Random(1), 60)
    assert used(population[0]) == counts
    assert packing.fitness(population[0], 100)[0] == 25 < packing.fitness(packing.best_fit(counts, 100), 100)[0]


def test_islands_give_one_result(spark):
    r = random.Random(5)
    counts = {s: r.randrange(1, 9) for s in r.sample(range(1, 1025), 150)}
    found = [packing.solution(spark, counts, islands=3, epochs=2, generations=3) for _ in range(2)]
    assert found[0] == found[1] and used(found[0]) == counts
    assert packing.fitness(found[0], 1024)[0] <= plain_best_fit([s for s, n in counts.items() for _ in range(n)], 1024)
