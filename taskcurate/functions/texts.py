"""Shortening, cleaning and assembling text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import strip

DIVIDER = "-" * 50


def _lines(text: Column) -> Column:
    """Lines of a text; a final line break does not open another line."""
    return F.filter(F.split(F.regexp_replace(text, r"\n\z", ""), "\n"), lambda _: text != "")


def middle_cut(text: Column, n: int = 40) -> Column:
    """First and last ``n`` lines with a note between, if there are more than ``2 n``."""
    ls = _lines(text)
    note = f"\n{DIVIDER}\n<Observation truncated in middle for saving context>\n{DIVIDER}\n"
    cut = F.concat(F.array_join(F.slice(ls, 1, n), "\n"), F.lit(note), F.array_join(F.slice(ls, -n, n), "\n"))
    return F.when(F.size(ls) > 2 * n, cut).otherwise(text)


def numbered_log(text: Column, limit: int = 600) -> Column:
    """Lines with right-aligned numbers; the middle of a long log is left out."""
    ls = _lines(text)
    n = F.size(ls)
    width = F.length(n.cast("string"))
    head, tail = limit // 2, limit - limit // 2

    def row(line: Column, at: Column) -> Column:
        return F.concat(F.lpad((at + 1).cast("string"), width, F.lit(" ")), F.lit("   "), line)

    rows = F.transform(ls, row)
    gap = F.concat(F.repeat(F.lit(" "), width), F.lit("   [..., "), (n - head - tail).cast("string"), F.lit(" lines omitted ...]"))
    short = F.array_join(F.concat(F.slice(rows, 1, head), F.array(gap), F.slice(rows, -tail, tail)), "\n")
    return F.when(n > limit, short).otherwise(F.array_join(rows, "\n"))


def half_cut(text: Column, limit: int = 30000) -> Column:
    """First and last half of the allowed characters."""
    half = limit // 2
    note = F.concat(F.lit("\n\n... [TRUNCATED "), (F.length(text) - limit).cast("string"), F.lit(" chars] ...\n\n"))
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(half)), note, F.right(text, F.lit(half)))).otherwise(text)


def preview(text: Column, max_lines: int = 80, max_chars: int = 4000) -> Column:
    """Head of a command's output, within lines and characters."""
    body = strip(text)
    short = F.left(body, F.lit(max_chars))
    ls = _lines(short)
    over = (F.length(body) > max_chars) | (F.size(ls) > max_lines)
    shown = F.array_join(F.slice(ls, 1, max_lines), "\n")
    note = F.when(over, F.lit("\n... (truncated)")).otherwise(F.lit(""))
    return F.when(body == "", F.lit("(command produced no output)")).otherwise(F.concat(shown, note))


def unquoted(text: Column) -> Column:
    """Text in matching quotes loses them, and its escapes become characters."""
    quoted = (F.length(text) >= 2) & text.rlike(r"""(?s)^(".*"|'.*')\z""")
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    # a backslash pair is parked first, so that it does not take part in other escapes
    parked = F.replace(inner, F.lit("\\\\"), F.lit("\u0000"))
    for code, char in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r"), ('\\"', '"'), ("\\'", "'")):
        parked = F.replace(parked, F.lit(code), F.lit(char))
    return F.when(quoted, F.replace(parked, F.lit("\u0000"), F.lit("\\"))).otherwise(text)


# Accepted spellings of booleans.
TRUE_WORDS = ("yes", "true", "t", "y", "1")
FALSE_WORDS = ("no", "false", "f", "n", "0")


def to_bool(text: Column) -> Column:
    t = F.lower(text)
    return F.when(t.isin(*TRUE_WORDS), True).when(t.isin(*FALSE_WORDS), False)


def json_list(text: Column) -> Column:
    """A column that may hold a JSON list as text; missing is an empty list."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def issue_text(answer: Column) -> Column:
    """Text between the issue tags; without an opening tag the text up to the closing one."""
    opened = F.when(answer.contains("[ISSUE]"), F.get(F.split(answer, r"\[ISSUE\]"), F.lit(1))).otherwise(answer)
    return strip(F.substring_index(opened, "[/ISSUE]", 1))


def tagged_files(answer: Column) -> Column:
    """(path, content) of each ``<test_file path="...">`` element."""
    pattern = F.lit(r"""(?s)<test_file\s+path=["']([^"']+)["']>(.*?)</test_file>""")
    zipped = F.arrays_zip(F.regexp_extract_all(answer, pattern, 1).alias("p"), F.regexp_extract_all(answer, pattern, 2).alias("c"))
    rows = F.transform(zipped, lambda z: F.struct(strip(z["p"]).alias("path"), F.regexp_replace(z["c"], r"^\n", "").alias("content")))
    return F.filter(rows, lambda r: r["path"] != "")


# -- scripts with here-documents ---------------------------------------------------

_BLOCK = r"(?s)cat\s+<<'(EOF_TEST_\d+)'\s*>\s*\"([^\"]+)\"\s*\n(.*?)\n\1"
_ANY_BLOCK = r"(?m)^[^\n]*cat\s+<<['\"]?([A-Za-z0-9_]+)['\"]?[^\n]*(?:\n(?s:.*?)^[ \t]*\1[ \t]*$|(?s:.*)\z)"


def heredoc_files(script: Column) -> Column:
    """(path, content) of the files a script writes."""
    zipped = F.arrays_zip(
        F.regexp_extract_all(script, F.lit(_BLOCK), 2).alias("path"), F.regexp_extract_all(script, F.lit(_BLOCK), 3).alias("content")
    )
    return F.transform(zipped, lambda z: F.struct(z["path"].alias("path"), z["content"].alias("content")))


def heredoc_script(files: Column) -> Column:
    """Commands that create the directories and write the (path, content) files."""
    dirs = F.array_sort(F.array_distinct(F.filter(F.transform(files, lambda f: F.regexp_extract(f["path"], "^(.*)/[^/]*$", 1)), lambda d: d != "")))
    make = F.when(
        F.size(dirs) > 0,
        F.array(F.concat(F.lit("mkdir -p "), F.array_join(F.transform(dirs, lambda d: F.concat(F.lit('"'), d, F.lit('"'))), " "))),
    ).otherwise(F.array().cast("array<string>"))

    def block(f: Column, i: Column) -> Column:
        end = F.concat(F.lit("EOF_TEST_"), i.cast("string"))
        return F.concat(F.lit("cat <<'"), end, F.lit("' > \""), f["path"], F.lit('"\n'), f["content"], F.lit("\n"), end)

    return F.array_join(F.concat(make, F.transform(files, block)), "\n")


def replace_heredocs(script: Column, contents: Column) -> Column:
    """Put the contents of a (path -> content) map into the here-documents of a script.

    The script is cut at its here-documents; each is rebuilt or kept and put
    back between the pieces.
    """
    doc = r"(?m)^(cat\s+<<['\"]?(\w+)['\"]?\s*>\s*[\"']?([^\"'\n]+?)[\"']?\s*)\n(?s:.*?)\n\2[ \t]*$"
    pieces = F.split(script, doc)
    old, head, end, path = (F.regexp_extract_all(script, F.lit(doc), i) for i in range(4))

    def rebuilt(z: Column) -> Column:
        new = F.element_at(contents, strip(z["p"]))
        return F.coalesce(F.concat(z["h"], F.lit("\n"), new, F.lit("\n"), z["e"]), z["o"])

    blocks = F.transform(F.arrays_zip(old.alias("o"), head.alias("h"), end.alias("e"), path.alias("p")), rebuilt)
    return _interleave(pieces, blocks)


def _interleave(pieces: Column, blocks: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(blocks, i), F.lit("")))), "")


def embedded_patch(script: Column, delimiter: str) -> Column:
    """Patch a script applies from a here-document; "" if there is none."""
    return F.regexp_extract(script, rf"(?s)git apply -v - <<'{delimiter}'\n(.*?)\n{delimiter}", 1)


def sanitised_script(script: Column) -> Column:
    """Comment out commands that would undo the environment, outside here-documents."""

    def line(l: Column) -> Column:
        bare = strip(l)
        low = F.lower(bare)
        data = low.contains("test-data/") | low.contains("tests/data/") | low.contains("test_resource")
        bad = low.contains("git reset --hard") | low.contains("git clean -fdx") | (low.contains("git checkout") & ~data)
        return F.when(bad & ~bare.startswith("#"), F.concat(F.lit("# [sanitized] removed unsafe command: "), bare)).otherwise(l)

    outside = F.transform(F.split(script, _ANY_BLOCK), lambda p: F.array_join(F.transform(F.split(p, "\n"), line), "\n"))
    return _interleave(outside, F.regexp_extract_all(script, F.lit(_ANY_BLOCK), 0))


# -- code --------------------------------------------------------------------------


# -- requests ----------------------------------------------------------------------


def judge_request(statement: Column, patch: Column, context: Column) -> Column:
    """Body of a judge request; null without a patch."""
    shown = F.when(F.size(context) > 0, F.array_join(context, "\n\n")).otherwise(F.lit("(no code context available)"))
    said = F.coalesce(F.nullif(statement, F.lit("")), F.lit("(no problem statement)"))
    body = F.concat(F.lit("Problem statement:\n"), said, F.lit("\n\nPatch:\n"), patch, F.lit("\n\nCode context:\n"), shown)
    return F.when(patch.rlike(r"\S"), body)


def version_from_tag(tag: Column, committed: Column) -> Column:
    """``major.minor`` of a tag, else the commit month, else ``0.0``."""
    return F.coalesce(
        F.nullif(F.regexp_extract(tag, r"(\d+\.\d+)(?:\.\d+)?", 1), F.lit("")), F.date_format(committed, "yyyy.MM"), F.lit("0.0")
    )
