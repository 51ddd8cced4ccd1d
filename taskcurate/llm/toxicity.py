"""Toxicity of texts, after undoing disguises with a noisy channel.

1. A character trigram model counts the words of all documents (letters of the
   Latin alphabets, which bounds it).
2. Tokens that look disguised become a lattice, marks at their ends included: a leet
   character may stand for a letter or, at an end, be a mark and go; a repeated
   letter may stand once or twice; ``*`` between letters may be any letter;
   characters set apart by blanks or marks are one run in which a word may end
   at every place.  Viterbi's best path under the model is the restored text.
   A token with digits or marks is only rewritten if that path is likelier than the
   token as it stands, where each such character costs ``AS_IS``.
3. A document has the features *piece at level*: a restored word or a leading
   piece of it of 3 to 7 letters, met 1, 2, 4 or 8 times.  ``FEATURES`` of them
   with the largest chi-square on the training rows are kept, and a logistic
   regression gives the score.

Training rows are labelled rows whose crc32(doc_id) mod 5 is not 0, at most
about ``MAX_FIT`` of them (a share by hash beyond that); only rows in training
are read with their labels.  Everything else covers all rows.

Null and empty texts get the score of a text without features.  A null doc_id
counts as an empty string and is held out.  Labels other than 0 and 1, null
labels and documents with both labels are not used.  Without usable labels of both kinds
on given documents every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch

MAX_FIT, FEATURES, LEVELS, PREFIXES, MAX_WORDS = 20_000, 4096, (1, 2, 4, 8), range(3, 8), 200_000
#: Letters that a character may stand for, with the cost of the disguise as a log probability.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "(": "c"}
ANY = "abcdefghijklmnopqrstuvwxyz"
COST, COST_ANY, COST_TWICE, COST_ONCE, COST_AGAIN, COST_BREAK, AS_IS, DIGIT = -0.5, -3.0, -1.0, -2.0, -2.0, -1.0, -7.0, -2.3
#: Cost of taking a leet mark at an end of a token as a mark: punctuation is free.
AS_MARK = {"!": 0.0, "(": 0.0, "*": 0.0, "|": -1.0, "+": -3.0, "$": -9.0, "@": -9.0, "€": -9.0}
#: Marks that are never letters, cut from the ends of a token.
ENDS = ".,;:?\"'()[]{}%&#<>~-_=/\\"
HEADS = ENDS.replace("(", "")
_RUN = r"(?<![\w.\-*])(?:[^\W_]|[@$!|+€*(])(?:[ .\-_*](?:[^\W_]|[@$!|+€(])){3,}(?!\w)"
SPACED = re.compile(_RUN)
#: What every run holds: three marks or blanks with one character between.
SET_APART = re.compile(r"[ .\-_*]\S[ .\-_*]\S[ .\-_*]\S")
SUSPECT = re.compile(r"(.)\1\1|(\w)\2(\w)\3|[0-9@$!|+€(*]")
NO_LETTER = re.compile(r"[^a-zß-ÿĀ-ɏ]")


def stripped(token: str) -> str:
    return token.rstrip(ENDS).lstrip(HEADS)


def trigrams(counted: Iterable[tuple[str, int]]) -> Counter:
    """Character trigrams of words of Latin letters; a word begins with two marks and ends with one."""
    kept = [(w, n) for w, n in counted if w and not NO_LETTER.search(w)]
    chars = np.frombuffer("".join(f"^^{w}." for w, _ in kept).encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(chars):
        return Counter()
    times = np.repeat([n for _, n in kept], [len(w) + 3 for w, _ in kept])[:-2]
    within = (chars[:-2] != ord(".")) & (chars[1:-1] != ord("."))  # of one word
    grams, at = np.unique((chars[:-2] << np.uint64(42) | chars[1:-1] << np.uint64(21) | chars[2:])[within], return_inverse=True)
    sums = np.bincount(at, weights=times[within])
    mask = (1 << 21) - 1
    return Counter({chr(g >> 42) + chr(g >> 21 & mask) + chr(g & mask): int(n) for g, n in zip(grams.tolist(), sums.tolist(), strict=True)})


Place = list[tuple[str, float]]  # the strings that may have stood at a place, with their costs


class Restorer:
    """Viterbi over disguised words, under log probabilities from trigram counts."""

    def __init__(self, counts: dict[str, int]):
        pairs: Counter = Counter()
        for t, n in counts.items():
            pairs[t[:2]] += n
        letters = len({t[2] for t in counts}) or 1
        self.p = {t: math.log((n + 0.1) / (pairs[t[:2]] + 0.1 * letters)) for t, n in counts.items()}
        self.unseen = {t: math.log(0.1 / (n + 0.1 * letters)) for t, n in pairs.items()}
        self.none = -math.log(letters)

    def step(self, two: str, c: str) -> float:
        return self.p.get(two + c) or self.unseen.get(two, self.none)

    def lattice(self, token: str) -> list[Place]:
        """Per place, the strings that may have stood there."""
        out = []
        for m in re.finditer(r"(.)\1*", token):
            c, n, inner = m[1], len(m[0]), 0 < m.start() and m.end() < len(token)
            if c == "*" and inner:
                out += [[(x, COST_ANY) for x in ANY]] * n
                continue
            options = [(x, COST) for x in LEET.get(c, "")] or [(c, 0.0)]
            again = 0.0 if c.isalpha() else COST_AGAIN  # for each one that goes
            once = [(x, cost + (COST_ONCE if n == 2 else again * (n - 1))) for x, cost in options if n > 2 or c.isalpha()]
            twice = [(x + x, cost + (0.0 if n == 2 else COST_TWICE + again * (n - 2))) for x, cost in options]
            place = options if n == 1 else once + twice
            if c in AS_MARK and not inner:
                place = place * (c != "*") + [("", AS_MARK[c] * n)]
            out.append(place)
        return out

    def best(self, places: list[Place], breaks: bool = False) -> tuple[float, str]:
        """Score and text of the best path; with ``breaks`` a word may end before any place."""
        best: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
        for i, options in enumerate(places):
            if breaks and i:
                ended = max((score + self.step(two, ".") + COST_BREAK, f"{said} ") for two, (score, said) in best.items())
                best["^^"] = max(ended, best["^^"]) if "^^" in best else ended
            after: dict[str, tuple[float, str]] = {}
            for two, (score, said) in best.items():
                for x, cost in options:
                    s, at = score + cost, two
                    for c in x:
                        s += self.step(at, c)
                        at = at[1] + c
                    if at not in after or (s, said + x) > after[at]:
                        after[at] = (s, said + x)
            best = after
        return max((score + self.step(two, "."), said) for two, (score, said) in best.items())

    def as_is(self, token: str) -> float:
        """Score of a token as it stands: letters under the model, each other character at a fixed cost; the digits of a number are cheap."""
        if token.isdigit():
            return len(token) * DIGIT
        score, two = 0.0, "^^"
        for c in token:
            score, two = (score + self.step(two, c), two[1] + c) if c.isalpha() else (score + AS_IS, "^^")
        return score + (self.step(two, ".") if two != "^^" else 0.0)

    def restore(self, token: str) -> str:
        """A token without marks at its ends that are never letters, restored if it looks disguised."""
        if not SUSPECT.search(token):
            return token
        bare = token.rstrip("!*|+(").lstrip("*|+(")
        score, said = self.best(self.lattice(token))
        if bare.isalpha():  # nothing but letters and common marks: repetition is all there is to undo
            return said
        return said if score > self.as_is(bare) else bare

    def run(self, run: str) -> str:
        """Characters set apart by blanks or marks, as words."""
        letters = re.sub(r"[ .\-_*]", "", run)
        places = [[(x, COST) for x in LEET.get(c, "")] or [(c, 0.0)] for c in letters]
        score, said = self.best(places, breaks=True)
        return said if any(c.isalpha() for c in letters) and score > sum(AS_IS for c in letters if not c.isalpha()) + sum(self.step("^^", c) + self.step("^" + c, ".") for c in letters if c.isalpha()) else letters

    def words(self, text: str | None) -> Counter:
        """Tokens of a text as they stand, and the words of its runs, restored."""
        text = (text or "").lower()
        found = Counter(text.split())
        runs = SPACED.findall(text) if SET_APART.search(text) else ()
        if runs:
            found = Counter(SPACED.sub(" ", text).split())
            for x in runs:
                found.update(self.run(x).split())
        return found


def pieces(word: str) -> list[str]:
    """The features of a word: itself, and its leading pieces."""
    return [f"={word}", *(word[:n] for n in PREFIXES if n <= len(word))]


class Scorer:
    """Features of texts, restricted to those of a model if there is one."""

    def __init__(self, counts: dict[str, int], weights: dict[str, float] | None = None):
        self.restorer, self.weights, self.known = Restorer(counts), weights, {}
        self.wanted = None if weights is None else {f.rpartition("#")[0] for f in weights}
        self.heads = None if weights is None else {p.lstrip("=")[:3] for p in self.wanted}

    def of_word(self, token: str) -> list[str]:
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= MAX_WORDS:
                self.known.clear()
            word = self.restorer.restore(stripped(token))
            if self.wanted is None:
                found = pieces(word)
            else:
                found = [p for p in pieces(word) if p in self.wanted] if word[:3] in self.heads else []
            self.known[token] = found
        return found

    def features(self, text: str | None) -> list[str]:
        met: Counter = Counter()
        known, of_word = self.known, self.of_word
        for token, n in self.restorer.words(text).items():
            # most tokens have no feature of the model
            for p in known[token] if token in known else of_word(token):
                met[p] += n
        return [f"{p}#{level}" for p, n in met.items() for level in LEVELS if n >= level]

    def score(self, text: str | None) -> float:
        x = self.weights.get("#", 0.0) + sum(self.weights.get(f, 0.0) for f in self.features(text))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def _trigram_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    words, found = Counter(), Counter()
    for i, t in enumerate(b.column(0)):
        words.update((t.as_py() or "").lower().split())
        if len(words) > MAX_WORDS or i + 1 == b.num_rows:
            found.update(trigrams((stripped(w), n) for w, n in words.items()))
            words.clear()
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["gram", "n"])


def language_model(docs: DataFrame) -> dict[str, int]:
    """Trigram counts over all documents; as many entries as letters allow, whatever the input."""
    counted = per_batch(docs.select("text"), _trigram_batch, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in counted.collect()}


def fit_logistic(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, width: int, l2: float = 1e-3, rounds: int = 400) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression over sparse 0/1 features, by accelerated gradient steps."""
    n = len(y)
    w = v = np.zeros(width + 1)
    most = np.bincount(rows, minlength=n).max(initial=0) + 1
    rate = 4.0 / most
    for k in range(rounds):
        z = np.bincount(rows, weights=v[cols], minlength=n) + v[-1]
        miss = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        grad = np.append(np.bincount(cols, weights=miss[rows], minlength=width), miss.sum()) / n
        grad[:-1] += l2 * v[:-1]
        after = v - rate * grad
        w, v = after, after + k / (k + 3) * (after - w)
    return w


def fit(docs: DataFrame, labels: DataFrame, counts: dict[str, int], max_fit: int = MAX_FIT, n_features: int = FEATURES) -> dict[str, float]:
    """Feature -> weight, and ``#`` -> bias, from the training rows."""
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    train = train.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    train = train.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high").drop("high")
    share = min(1.0, max_fit / max(1, train.count()))
    train = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    model = docs.sparkSession.sparkContext.broadcast(counts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part, n, t = b.slice(i, 200), Counter(), Counter()
                for text, y in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    found = scorer.features(text)
                    n.update(found)
                    if y:
                        t.update(found)
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([t[f] for f in n], pa.int64())], ["f", "n", "t"])

    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(train), "doc_id")  # max_fit rows of two numbers
    total, toxic = few.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < total:
        return {}
    seen = few.mapInArrow(features, "f string, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where("n >= 3")
    # chi-square of a feature against the label
    gap = F.col("t") * F.lit(float(total)) - F.col("n") * F.lit(float(toxic))
    best = seen.select("f", (gap * gap / (F.col("n") * (F.lit(float(total)) - F.col("n") + 1))).alias("chi")).orderBy(F.desc("chi"), "f").limit(n_features)
    names = [r["f"] for r in best.collect()]
    number = {f: i for i, f in enumerate(names)}
    chosen = docs.sparkSession.sparkContext.broadcast({f: 0.0 for f in names})

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value, chosen.value)
        for b in batches:
            found = [[number[f] for f in scorer.features(t) if f in number] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "toxic", "found"])

    sample = few.mapInArrow(present, "doc_id long, toxic int, found array<int>").orderBy("doc_id").collect()  # max_fit rows
    rows = np.repeat(np.arange(len(sample)), [len(r["found"]) for r in sample])
    cols = np.array([c for r in sample for c in r["found"]], np.int64)
    w = fit_logistic(rows, cols, np.array([r["toxic"] for r in sample], float), len(names))
    return {f: float(x) for f, x in zip([*names, "#"], w, strict=True)}


def scores(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``."""
    counts = language_model(docs)
    weights = fit(docs, labels, counts, max_fit)
    model = docs.sparkSession.sparkContext.broadcast((counts, weights or {"#": -math.inf}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([scorer.score(t) for t in b.column("text").to_pylist()], pa.float64())], ["doc_id", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = slim.mapInArrow(run, "doc_id long, score double")
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return found.select("doc_id", (F.crc32(number) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
