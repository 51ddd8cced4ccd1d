"""Small tables with hard rows, and brute-force versions to compare with."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq

TABLES = {
    "documents": [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())],
    "benchmark": [("item_id", pa.int64()), ("text", pa.string())],
    "labels": [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())],
    "conversations": [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())],
}
#: Columns beside those of the tables, named like what the operators make.
CLASHES = ("key", "host", "print", "n", "start", "kept", "size", "grp", "shard", "slot", "score", "ids", "h", "line", "item", "doc", "found", "n_words", "hs", "len", "dropped")

VERSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix extraordinary potions beneath the old stone bridge near town"
LICENCE = "Permission is granted to use copy and share this work version 2.0 under the usual terms."


def prose(seed: int, n: int) -> str:
    """Words that no other seed shares in order."""
    x, out = seed * 7919 + 13, []
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bcdfghklmnprst"[(x >> s) % 14] + "aeiou"[(x >> s + 3) % 5] for s in (4, 9, 14)))
        if i % 17 == 16:
            out[-1] += ".\n"
    return " ".join(out)


def rows() -> list[tuple]:
    texts: list[str | None] = [None, "", " \n\t ", "x", "word " * 40, prose(1, 90), prose(1, 90), prose(1, 90).replace("a", "A", 1)]
    texts += [f"{prose(10 + i, 60)}\n{LICENCE.replace('2.0', f'{i}.1')}" for i in range(14)]
    texts += [f"{prose(40, 30)} {VERSE} {prose(41, 30)}", VERSE.upper() + ".", prose(50, 6000), "same line here now\n" * 3 + prose(51, 40)]
    texts += ["naïve ﬁ İstanbul 🙂 <|endoftext|> x<|endoftext|>'re 12", "password = 'abcdefghijkl' token:short AKIA" + "A1" * 8 + " 0123456789abcdef0", "a" * 5000, "ab" * 3000]
    texts += [f"you {w} are a clown and {prose(70 + i, 25)}" for i, w in enumerate(("1d10t", "i d i o t", "idiooot", "idiot"))]
    found = [(i, t, "en", None if i % 7 == 3 else f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return found + [found[5], found[5], (None, prose(90, 40), None, None, 5), (None, None, None, None, None), (10_000_000_000, prose(91, 30), "en", "src0", 1)]


def write(folder, data: dict[str, list[tuple]], clash: bool) -> str:
    for name, columns in TABLES.items():
        got = data.get(name, [])
        cols = {c: pa.array([r[i] for r in got], kind) for i, (c, kind) in enumerate(columns)}
        if clash:
            cols |= {c: pa.array([f"{c}{i}" for i in range(len(got))], pa.string()) for c in CLASHES if c not in cols}
        pq.write_table(pa.table(cols), folder / f"{name}.parquet")
    return str(folder)


def turns() -> list[tuple]:
    """Conversations with shared openings, copies, empty turns, a null turn number and rows of none."""
    out = [(c, t, ("user", "assistant", None)[t % 3], ("hello there", "", None, f"what of {c % 4}?")[(c * t + t) % 4]) for c in (*range(45), 60, 10**10) for t in range(c % 6)]
    return out + [(100 + 20 * k, t, "user", f"long {t} talk") for k in range(3) for t in range(40)] + [(7, None, "user", "before all"), (None, 0, "user", "lost"), (46, 3, None, None)]


def hard(folder) -> str:
    docs = rows()
    items = [(1, VERSE), (2, None), (3, ""), (4, "only three words"), (5, VERSE), (None, prose(10, 20))]
    labels = [(i, 1, int(t is not None and "clown" in t)) for i, t, *_ in docs if i is not None and i < 40] + [(None, 0, 1), (7, None, None), (999, 1, 1)]
    return write(folder, {"documents": docs, "benchmark": items, "labels": labels, "conversations": turns()}, clash=True)


def connect(folder: str):
    """DuckDB over the tables that the folder has."""
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con
