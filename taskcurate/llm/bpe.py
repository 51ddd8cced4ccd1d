"""BPE encoding and decoding by a prefix-sharing trie.

The encoding of a prefix of a word is a prefix of encodings: if a word encodes
to t1 .. tn, its bytes up to the end of tk encode to t1 .. tk.  So one *last
token* per prefix describes all encodings, and the last token of a prefix is
the one vocabulary entry that ends there and may follow the last token of what
it leaves.  Two tokens may follow one another if no merge across their boundary
comes before the merges that made them.

New distinct words go into a trie, which is walked depth first: in sorted order
a word shares the path of the word before it up to their common prefix, so
the path's last-token states stay on a stack and each shared prefix is computed
once.  Encodings are kept for later batches, up to ``MAX_WORDS`` words (and
``MAX_PAIRS`` answers on neighbours); beyond that they start anew.

Words are cut as the vocabulary's byte-level pattern does; strings of added
tokens in a text are their ids.  Null texts count as empty, with no ids.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Fixed value: how the byte-level vocabulary cuts texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts whose letters, digits and spaces are those of the standard library, alternatives without a common first character in order of use.
_PLAIN_CUT = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_PLAIN_UPTO = 0x0250  # Latin letters
MAX_WORDS, MAX_PAIRS = 300_000, 200_000
_FOREVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache
def _odd_letters() -> str:
    """A class of the characters that the two expressions may take for different kinds, and of all behind the Latin letters."""
    kinds = [(regex.compile(a).match, re.compile(b).match) for a, b in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"), (r"[^\s\p{L}\p{N}]", r"[^\s\w]|_"))]
    odd = [c for c in map(chr, range(_PLAIN_UPTO)) if any(bool(a(c)) != bool(b(c)) for a, b in kinds)]
    return "[" + "".join(map(re.escape, odd)) + chr(_PLAIN_UPTO) + "-" + chr(0x10FFFF) + "]"


class Codec:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.rank: dict[tuple[int, int], int] = {}  # of a merge of two ids
        self.halves: dict[int, tuple[int, int, int]] = {}  # id -> its two parts and the rank of their merge
        for r, m in enumerate(spec["model"]["merges"]):
            x, y = m if isinstance(m, list) else m.split(" ")
            a, b, ab = vocab[x], vocab[y], vocab[x + y]
            self.rank[a, b] = r
            self.halves[ab] = (a, b, r)
        self.cut_any = regex.compile(PATTERN).findall
        self.odd = re.compile(_odd_letters()).search
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        skip = set(self.added.values())
        self.follows: dict[int, bool] = {}
        self.right, self.left = functools.lru_cache(1 << 16)(self._right), functools.lru_cache(1 << 16)(self._left)
        # an entry whose parts cannot stand side by side until they merge is never reached
        self.id_of = {self.bytes_of[i]: i for i in sorted(vocab.values()) if i not in skip and (i not in self.halves or self._reached(i))}
        self.reach: dict[bytes, int] = {}  # of the last two bytes of entries: the longest entry that ends so
        for entry in self.id_of:
            self.reach[entry[-2:]] = max(len(entry), self.reach.get(entry[-2:], 0))
        self.known: dict[str, bytes] = {}
        size = max(self.bytes_of) + 1
        self.length = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.size_of = self.length.tolist()
        self.start = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.blob = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)

    def _right(self, t: int) -> list[tuple[int, int]]:
        """Tokens that form the right end of t over time, and the rank at which each is merged away."""
        out, until = [], _FOREVER
        while True:
            out.append((t, until))
            if t not in self.halves:
                return out
            _, t, until = self.halves[t]

    def _left(self, t: int) -> list[tuple[int, int]]:
        out, until = [], _FOREVER
        while True:
            out.append((t, until))
            if t not in self.halves:
                return out
            t, _, until = self.halves[t]

    def _apart(self, p: int, t: int, before: int = _FOREVER) -> bool:
        """Whether no merge crosses the boundary of p and t earlier than ``before``.

        A crossing merge needs both of its parts at the boundary at its rank;
        among merges of one rank the leftmost goes first.
        """
        for x, x_until in self.right(p):
            for y, y_until in self.left(t):
                r = self.rank.get((x, y))
                if r is not None and r < before and r < x_until and r <= y_until:
                    return False
        return True

    def _reached(self, i: int) -> bool:
        a, b, r = self.halves[i]
        return self._apart(a, b, r) and all(x not in self.halves or self._reached(x) for x in (a, b))

    def may_follow(self, p: int, t: int) -> bool:
        pair = p << 32 | t
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) >= MAX_PAIRS:
                self.follows.clear()
            known = self.follows[pair] = self._apart(p, t)
        return known

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Encodings of distinct words: a depth-first walk of their trie."""
        entry, reach, follows = self.id_of.get, self.reach.get, self.follows.get
        may_follow, size_of = self.may_follow, self.size_of
        path, last = b"", [0]  # per depth: last token
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                begin = max(0, end - reach(word[max(0, end - 2) : end], 1))
                while True:  # a single byte always is an entry, and may follow if no longer one does
                    t = entry(word[begin:end])
                    if t is not None:
                        if not begin:
                            break
                        known = follows(last[begin] << 32 | t)
                        if known or (known is None and may_follow(last[begin], t)):
                            break
                    begin += 1
                last.append(t)
            path, at, ids = word, len(word), []
            while at:
                t = last[at]
                ids.append(t)
                at -= size_of[t]
            yield word, ids[::-1]

    def encode_texts(self, texts: list[str | None], added: bool = True) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers; ``added``: strings of added tokens are their ids."""
        pieces = [self.pieces(t, added) if t else [] for t in texts]
        new = set().union(*(x for text in pieces for kind, x in text if not kind))
        if len(self.known) + len(new) > MAX_WORDS:
            self.known.clear()
        else:
            new = {w for w in new if w not in self.known}
        known = self.known
        for word, ids in self.encode_words([w.encode() for w in new]):
            known[word.decode()] = struct.pack(f"<{len(ids)}I", *ids)
        return [b"".join([part if kind else b"".join([known[w] for w in part]) for kind, part in text]) for text in pieces]

    def pieces(self, text: str, added: bool = True) -> list[tuple[bool, list[str] | bytes]]:
        """Words of a text (False, list), and added tokens in it (True, ids)."""
        if not added or not self.split_added or not any(x in text for x in self.added):
            return [(False, self.cut(text))]
        return [(True, np.array([self.added[x]], "<u4").tobytes()) if k % 2 else (False, self.cut(x)) for k, x in enumerate(self.split_added(text))]

    def cut(self, text: str) -> list[str]:
        """The words of a text; where all its characters are of one kind for both, by the faster expression."""
        return self.cut_any(text) if self.odd(text) else _PLAIN_CUT(text)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become replacement characters."""
        out, block = [], 1 << 18
        every = np.frombuffer(ids, "<u4")
        for i in range(0, len(every), block):
            t = every[i : i + block]
            n = self.length[t]
            ends = np.cumsum(n)
            out.append(self.blob[np.repeat(self.start[t] - (ends - n), n) + np.arange(int(ends[-1]))].tobytes())
        raw = b"".join(out)
        return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def codec(file: str) -> Codec:
    """One codec for each worker process."""
    return Codec(file)


def text_runs(b: pa.RecordBatch, most: int = 1 << 21) -> Iterator[list[str | None]]:
    """The texts of a batch in runs of about ``most`` characters; a longer text is a run of its own."""
    run, size = [], 0
    for x in b.column("text"):
        run.append(x.as_py())
        size += len(run[-1] or "")
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encoded(docs: DataFrame, file: str, keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of each row; ``file`` is readable on every executor."""

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + keep_ids]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary())[: 3 + keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for b in batches:
            at = 0
            for texts in text_runs(b):  # results leave run by run, so a worker holds one run of them
                every = c.encode_texts(texts)
                columns = ([len(x) // 4 for x in every], [hashlib.sha256(x).hexdigest() for x in every], [hashlib.sha256(c.decode(x)).hexdigest() for x in every], every)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(texts)), *(pa.array(v, k) for v, k in zip(columns, kinds, strict=False))], names)
                at += len(texts)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids)
