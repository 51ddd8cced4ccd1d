"""Unified diffs held in one string cell: all of it works inside the row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import paths
from .common import let

FILE_HEAD = "diff --git a/"


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def is_added(line: Column) -> Column:
    return line.startswith("+") & ~line.startswith("+++")


def is_removed(line: Column) -> Column:
    return line.startswith("-") & ~line.startswith("---")


def n_starting(text: Column, start: str) -> Column:
    """Number of lines behind a line end that begin with ``start``, told by the length that the text loses without one byte of each."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n" + start), F.lit(("\n" + start)[:-1])))


def n_added(patch: Column) -> Column:
    text = F.concat(F.lit("\n"), patch)
    return n_starting(text, "+") - n_starting(text, "+++")


def n_removed(patch: Column) -> Column:
    text = F.concat(F.lit("\n"), patch)
    return n_starting(text, "-") - n_starting(text, "---")


def n_changed(patch: Column) -> Column:
    return n_added(patch) + n_removed(patch)


def is_blank(text: Column) -> Column:
    return F.coalesce(~text.rlike(r"\S"), F.lit(True))


def is_trivial(patch: Column, threshold: int = 2) -> Column:
    return F.coalesce(n_changed(patch) <= threshold, F.lit(True))


def has_real_tests(test_patch: Column, threshold: int = 4) -> Column:
    return ~is_trivial(test_patch, threshold)


# -- segmentation ------------------------------------------------------------------


def _parts(text: Column, start: str) -> Column:
    """The parts of a text that begin with a line start ``start``; only the first one may begin otherwise."""
    return F.slice(F.split(text, f"\n(?={start})"), F.when(text.startswith(start), 1).otherwise(2), F.lit(1 << 30))


def files(patch: Column) -> Column:
    """File segments of a patch; text before the first header is dropped."""
    return _parts(patch, FILE_HEAD)


def file_path(segment: Column) -> Column:
    return F.trim(F.substring_index(F.substring_index(segment, "\n", 1), " b/", -1))


def file_head(segment: Column) -> Column:
    """A file segment up to its first hunk."""
    return F.substring_index(segment, "\n@@ ", 1)


def hunks(segment: Column) -> Column:
    return _parts(segment, "@@ ")


def file_paths(patch: Column) -> Column:
    return F.transform(files(patch), file_path)


def is_readme_only(patch: Column) -> Column:
    """Read off the header lines without cutting the patch: there is one, and none whose file name begins otherwise."""
    other = r"(?:\A|\n)diff --git a/(?!(?:[^\n]*/)?(?i:readme)[^\n/]*(?:\n|\z))(?![^\n]* b/ +(?i:readme)[^\n/]*(?:\n|\z))"
    return (patch.startswith(FILE_HEAD) | patch.contains("\n" + FILE_HEAD)) & ~patch.rlike(other)


def select_files(patch: Column, keep) -> Column:
    """Patch restricted to the files whose path satisfies ``keep``; "" if none."""
    return joined(F.filter(files(patch), lambda s: keep(file_path(s))))


def joined(segments: Column) -> Column:
    return let(segments, lambda k: F.when(F.size(k) > 0, F.concat(F.array_join(k, "\n"), F.lit("\n"))).otherwise(F.lit("")))


def _drop_index_lines(patch: Column) -> Column:
    return F.when(patch.contains("index "), F.regexp_replace(patch, r"(?m)^index .*\n?", "")).otherwise(patch)


def _by_header_words(patch: Column, test: bool) -> Column:
    body = _drop_index_lines(F.when(patch.endswith("\n"), F.substr(patch, F.lit(1), F.length(patch) - 1)).otherwise(patch))
    kept = F.filter(
        files(body),
        lambda s: (lambda hit: hit if test else ~hit)(paths.is_test_by_words(F.substring_index(s, "\n", 1))),
    )
    return joined(kept)


def test_part(patch: Column) -> Column:
    """The files whose header line holds a test word."""
    return _by_header_words(patch, True)


def code_part(patch: Column) -> Column:
    return _by_header_words(patch, False)


# -- parsing of single lines -------------------------------------------------------

_RANGES = r"^@@ -\d+(?:,\d+)? \+\d+(?:,\d+)? @@"
_HUNK = r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@(.*)"
_HEAD = r'^diff --git "?a/([^"]+)"? "?b/([^"]+)"?'


def hunk_header(line: Column) -> Column:
    """Struct of ranges; a missing length is null.  The pattern is tried once, the numbers are cut at blanks and commas."""
    ok = line.rlike(_RANGES)

    def num(word: int, part: int) -> Column:
        both = F.substring_index(F.substring_index(line, " ", word), " ", -1)
        text = F.substr(F.substring_index(both, ",", 1), F.lit(2)) if part == 0 else F.substring_index(both, ",", -1)
        return F.when(ok if part == 0 else ok & both.contains(","), text).cast("int")

    return F.struct(
        num(2, 0).alias("old_start"),
        num(2, 1).alias("old_length"),
        num(3, 0).alias("new_start"),
        num(3, 1).alias("new_length"),
        F.ltrim(F.regexp_extract(line, _HUNK, 5)).alias("section"),
    )


def file_header(line: Column) -> Column:
    """Path of a header line; null if it is malformed or a rename."""
    old, new = F.regexp_extract(line, _HEAD, 1), F.regexp_extract(line, _HEAD, 2)
    return F.when((old != "") & (old == new), old)


def line_type(line: Column) -> Column:
    return (
        F.when((line == "") | line.startswith(" "), "context")
        .when(line.startswith("-"), "deleted")
        .when(line.startswith("+"), "added")
        .when(line.startswith("\\"), "note")
    )


def line_content(line: Column) -> Column:
    return F.when(line.startswith("\\"), F.substr(line, F.lit(3))).otherwise(F.substr(line, F.lit(2)))


def range_text(start: Column, length: Column) -> Column:
    return F.concat(start.cast("string"), F.coalesce(F.concat(F.lit(","), length.cast("string")), F.lit("")))


def header_text(head: Column) -> Column:
    """Render the struct of :func:`hunk_header` back to its line."""
    return F.concat(
        F.lit("@@ -"),
        range_text(head["old_start"], head["old_length"]),
        F.lit(" +"),
        range_text(head["new_start"], head["new_length"]),
        F.lit(" @@"),
        F.when(head["section"] != "", F.concat(F.lit(" "), head["section"])).otherwise(F.lit("")),
    )


def render(patch: Column) -> Column:
    """Parse every hunk header and line of a patch and write them out again."""

    # a line of a hunk that is no text, note or header goes; an empty line is context; headers are written from their numbers
    other = r"\n(?![ +\-\\]|\n|\z|@@ -\d+(?:,\d+)? \+\d+(?:,\d+)? @@)[^\n]*"
    header = r"\n@@ -0*(\d+)(?:(,)0*(\d+))? \+0*(\d+)(?:(,)0*(\d+))? @@ *+([^\n\r\u0085\u2028\u2029]*)[^\n]*"
    unknown = r"\n(?!diff --git |index |old mode|new mode|deleted file mode|new file mode|\+\+\+ |--- |Binary files)[^\n]*"

    def rebuilt(body: Column) -> Column:
        known = F.regexp_replace(body, other, "")
        spaced = F.when(known.contains("\n\n") | known.endswith("\n"), F.regexp_replace(known, r"\n(?=\n|\z)", "\n ")).otherwise(known)
        noted = F.when(spaced.contains("\n\\"), F.regexp_replace(spaced, r"\n\\[^\n]?", "\n\\\\ ")).otherwise(spaced)
        return F.regexp_replace(F.regexp_replace(noted, header, "\n@@ -$1$2$3 +$4$5$6 @@ $7"), r"(\n@@ [^@\n]*@@) (?=\n|\z)", "$1")

    def rebuilt_file(s: Column) -> Column:
        head = file_head(s)
        body = F.substr(s, F.length(head) + 1)
        return F.concat(F.regexp_replace(head, unknown, ""), F.when(body == "", "").otherwise(rebuilt(body)))

    return F.array_join(F.transform(files(patch), rebuilt_file), "\n")


# -- per-file and per-commit metrics -----------------------------------------------


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0), lambda a, x: a + x)


def file_stats(patch: Column) -> Column:
    """Per-file figures of a patch, from the lengths of its file segments.

    An edit is a line inside a hunk that begins with ``+`` or ``-``; ``chars`` counts line ends.
    All commit filters read this struct, so a plan parses a patch once.
    """

    def figures(segment: Column, path: Column) -> Column:
        head = file_head(segment)
        n_edits = lambda text: n_starting(text, "+") + n_starting(text, "-")
        return F.struct(
            path.alias("path"), paths.is_test_file(path).alias("is_test"), paths.is_python(path).alias("is_python"),
            paths.is_case_file(path).alias("is_case"), paths.extension(path).alias("extension"), n_starting(segment, "@@ ").alias("hunks"),
            (n_edits(segment) - n_edits(head)).alias("edited"), (F.length(segment) + 1).alias("chars"),
        )

    placed = F.transform(files(patch), lambda s: F.struct(s.alias("segment"), file_path(s).alias("path")))
    return F.transform(placed, lambda f: figures(f["segment"], f["path"]))


def edited_lines(
    stats: Column,
    test_files: bool = True,
    code_files: bool = True,
    include: list[str] | None = None,
    exclude: list[str] = (),
    only_python: bool = True,
) -> Column:
    def wanted(f: Column) -> Column:
        ok = F.lit(True)
        if exclude:
            ok = ok & ~f["path"].isin(*exclude)
        if include:
            ok = ok & f["path"].isin(*include)
        if only_python:
            ok = ok & f["is_python"]
        return ok & ((f["is_test"] & F.lit(test_files)) | (~f["is_test"] & F.lit(code_files)))

    return _sum(F.transform(F.filter(stats, wanted), lambda f: f["edited"]))


def commit_metrics(stats: Column) -> dict[str, Column]:
    code = F.filter(stats, lambda f: ~f["is_test"])
    return {
        "n_files": F.size(stats),
        "n_test_files": F.size(F.filter(stats, lambda f: f["is_test"])),
        "n_code_files": F.size(code),
        "n_hunks": _sum(F.transform(stats, lambda f: f["hunks"])),
        "n_edited": _sum(F.transform(stats, lambda f: f["edited"])),
        "n_code_edited": _sum(F.transform(code, lambda f: f["edited"])),
        "n_python_chars": _sum(F.transform(F.filter(stats, lambda f: f["is_python"]), lambda f: f["chars"])),
    }


def is_small_commit(stats: Column, max_files: int = 5, max_lines: int = 200, max_chars: int = 10000) -> Column:
    def small(s: Column) -> Column:
        m = commit_metrics(s)
        return (
            (m["n_code_files"] > 0)
            & (m["n_hunks"] > 0)
            & (m["n_code_edited"] > 0)
            & (m["n_code_files"] < max_files)
            & (m["n_code_edited"] < max_lines)
            & (m["n_python_chars"] < max_chars)
        )

    return let(stats, small)


def is_python_only(patch: Column) -> Column:
    allowed = F.array(*[F.lit(e) for e in ("py", *paths.NON_CODE_ENDINGS)])
    return let(
        F.transform(file_paths(patch), paths.extension),
        lambda exts: (F.size(F.array_except(exts, allowed)) == 0) & F.array_contains(exts, "py"),
    )


def has_python_only(stats: Column) -> Column:
    """:func:`is_python_only` from the figures of :func:`file_stats`."""
    allowed = F.array(*[F.lit(e) for e in ("py", *paths.NON_CODE_ENDINGS)])
    return let(F.transform(stats, lambda f: f["extension"]), lambda exts: (F.size(F.array_except(exts, allowed)) == 0) & F.array_contains(exts, "py"))


def listed_files(patch: Column, want_tests: bool = False, excluded: tuple[str, ...] = paths.NON_CODE_ENDINGS) -> Column:
    """``(test and wanted) or (not test and not excluded)``."""
    return F.filter(
        file_paths(patch),
        lambda p: (paths.is_test_file(p) & F.lit(want_tests)) | (~paths.is_test_file(p) & ~paths.ends_with_any(p, excluded)),
    )


def touches_case_file(patch: Column) -> Column:
    return F.exists(file_paths(patch), paths.is_case_file)


def _all_hunks(patch: Column) -> Column:
    return F.flatten(F.transform(files(patch), hunks))


def _insert_only(h: Column) -> Column:
    return ~F.exists(lines(h), lambda l: l.startswith("-"))


def _delete_only(h: Column) -> Column:
    return ~F.exists(lines(h), lambda l: l.startswith("+"))


def _import_only(h: Column) -> Column:
    ls = lines(h)
    old_side = F.filter(F.slice(ls, 2, F.greatest(F.size(ls) - 1, F.lit(0))), lambda l: line_type(l).isin("context", "deleted"))
    return F.forall(
        old_side,
        lambda l: ~line_content(l).rlike(r"\S")
        | line_content(l).startswith("import")
        | (line_content(l).startswith("from ") & line_content(l).contains("import")),
    )


def hunk_kinds(patch: Column) -> Column:
    """Struct of flags that hold for every hunk of the patch."""
    flags = F.transform(
        _all_hunks(patch),
        lambda h: F.struct(_insert_only(h).alias("ins"), _delete_only(h).alias("del"), _import_only(h).alias("imp")),
    )
    return let(
        flags,
        lambda hs: F.struct(
            F.forall(hs, lambda h: h["ins"]).alias("all_insert"),
            F.forall(hs, lambda h: h["del"]).alias("all_delete"),
            F.forall(hs, lambda h: h["imp"]).alias("all_import"),
            F.forall(hs, lambda h: h["ins"] | h["del"]).alias("all_insert_or_delete"),
        ),
    )


# -- rewriting ---------------------------------------------------------------------


def added_source(file_patch: Column) -> Column:
    """Contents of a file whose lines were all added."""
    kept = F.filter(lines(file_patch), is_added)
    return F.array_join(F.transform(kept, lambda l: F.substr(l, F.lit(2))), "\n")


def new_file_diff(path: Column, content: Column) -> Column:
    ls = lines(F.regexp_replace(content, r"\n\z", ""))
    head = F.concat(
        F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\nnew file mode 100644\n--- /dev/null\n+++ b/"), path,
        F.lit("\n@@ -0,0 +1,"), F.size(ls).cast("string"), F.lit(" @@\n"),
    )
    return F.concat(head, F.array_join(F.transform(ls, lambda l: F.concat(F.lit("+"), l)), "\n"))


#: An end of line that is not the end of the text; all kinds of line ends count, and stay.
_INNER_END = r"((?>\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]))(?=(?s:.))"


def creation_patch(files: Column) -> Column:
    """One diff that creates the (path, content) files, by rising path; of one path the last content counts. "" without files."""

    def one(f: Column) -> Column:
        path, content = f["path"], f["content"]
        n = F.when(content == "", 0).otherwise(F.size(F.regexp_extract_all(content, F.lit(_INNER_END), 1)) + 1)
        head = F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\nnew file mode 100644\n--- /dev/null\n+++ b/"), path, F.lit("\n@@ -0,0 +1,"), n.cast("string"), F.lit(" @@\n"))
        body = F.concat(F.lit("+"), F.regexp_replace(content, _INNER_END, "$1+"), F.when(content.endswith("\n"), "").otherwise("\n"))
        return F.concat(head, F.when(content == "", "").otherwise(body))

    placed = F.transform(files, lambda f, i: F.struct(f["path"].alias("path"), i.alias("at"), f["content"].alias("content")))
    last = lambda fs: F.filter(fs, lambda f, i: ~F.get(fs, i + 1)["path"].eqNullSafe(f["path"]))
    return let(F.array_sort(placed), lambda fs: F.array_join(F.transform(last(fs), one), "\n"))


def omit_bodies(patch: Column, marker: str = "[HUNK CONTENT OMITTED]") -> Column:
    """Keep file headers; one marker stands for all hunks of a file."""
    return F.array_join(
        F.transform(
            files(patch),
            lambda s: F.when(
                F.size(hunks(s)) > 0, F.concat(F.regexp_extract(s, r"(?s)^(.*?)\n@@ ", 1), F.lit("\n" + marker))
            ).otherwise(s),
        ),
        "\n",
    )


def old_paths(patch: Column) -> Column:
    return F.filter(F.regexp_extract_all(patch, F.lit(r"--- a/(.*)"), 1), lambda p: ~p.startswith("/dev/null"))


def new_paths(patch: Column) -> Column:
    return F.filter(F.regexp_extract_all(patch, F.lit(r"\+\+\+ b/(.*)"), 1), lambda p: ~p.startswith("/dev/null"))


def touched_paths(patch: Column) -> Column:
    """Old then new paths, text after a tab cut, first occurrence kept."""
    both = F.transform(F.concat(old_paths(patch), new_paths(patch)), lambda p: F.substring_index(p, "\t", 1))
    return F.array_distinct(both)


def case_selector(test_patch: Column) -> Column:
    """``[case a]`` lines -> ``a or b``."""
    return F.array_join(F.regexp_extract_all(test_patch, F.lit(r"\[case ([^\]]+)\]"), 1), " or ")
