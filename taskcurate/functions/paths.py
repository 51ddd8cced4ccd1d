"""Predicates and names taken from file paths and ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes treated as binary.
BINARY_SUFFIXES = (
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".ico", ".webp", ".bmp", ".tiff",
    ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
    ".zip", ".tar", ".gz", ".bz2", ".7z", ".rar",
    ".mp3", ".mp4", ".wav", ".avi", ".mov",
    ".ttf", ".otf", ".woff", ".woff2", ".eot",
    ".pkl", ".pt", ".pth", ".bin", ".dat", ".db", ".sqlite", ".npy", ".npz",
)

# Endings that do not count as code when files are listed, and
# (with "py") the only extensions a Python-only commit may touch.
NON_CODE_ENDINGS = (
    "rst", "yml", "toml", "sh", "md", "txt", "test", "gitignore", "feature", "removal",
    "bugfix", "cfg", "misc", "doc", "dat", "ini", "Makefile", "pip", "treerc", "xml",
    "pylintrc", "html", "in", "css",
)

CONTEXT_STATUSES = ("modified", "added", "renamed", "copied")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def extension(path: Column) -> Column:
    """Text after the last dot; the whole path if there is none."""
    return F.substring_index(path, ".", -1)


def is_test_by_words(path: Column) -> Column:
    """The path, cut at blanks, ``_``, ``/`` and ``.``, holds a test word."""
    return F.lower(path).rlike(r"(?:\A|[ _/.])test(?:s|ing)?(?:[ _/.]|\z)")


def is_test_header(path: Column) -> Column:
    return path.endswith("_test.py") | path.startswith("test_") | F.array_contains(F.split(path, "/"), "tests")


def is_test_file(path: Column) -> Column:
    return path.endswith("_test.py") | path.rlike(r"(?:\A|/)(?:[tT]ests?(?:/|\z)|test_[^/]*\z)|\Atest_")


def is_case_file(path: Column) -> Column:
    return path.endswith(".test")


def is_python(path: Column) -> Column:
    return path.endswith(".py")


def is_binary(path: Column) -> Column:
    ext = F.regexp_extract(F.lower(basename(path)), r"(?<=.)(\.[^.]*)$", 1)
    return ext.isin(*BINARY_SUFFIXES)


def is_readme(path: Column) -> Column:
    return F.lower(basename(path)).startswith("readme")


def ends_with_any(path: Column, endings: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [path.endswith(e) for e in endings])


def test_stem(path: Column) -> Column:
    """Base name of a test file without ``.py``, ``test_`` and ``_test``."""
    return F.replace(F.replace(F.replace(basename(path), F.lit(".py"), F.lit("")), F.lit("test_"), F.lit("")), F.lit("_test"), F.lit(""))


def code_stem(path: Column) -> Column:
    return F.replace(basename(path), F.lit(".py"), F.lit(""))


def normalise(path: Column) -> Column:
    """Drop any run of leading ``.`` and ``/`` characters."""
    return F.regexp_replace(path, r"^[./]+", "")


def instance_id(repo: Column, number: Column, sha: Column) -> Column:
    return F.replace(F.concat_ws("-", repo, number.cast("string"), F.substring(sha, 1, 8)), F.lit("/"), F.lit("__"))


def pull_id(repo: Column, number: Column) -> Column:
    return F.replace(F.concat_ws("-", repo, number.cast("string")), F.lit("/"), F.lit("__"))


def image_name(instance: Column, prefix: str, tag: str = "latest") -> Column:
    """Lower-cased image reference of an instance id."""
    return F.concat(F.lit(prefix + "/"), F.lower(F.replace(instance, F.lit("__"), F.lit("_"))), F.lit(":" + tag))


def image_repo(image: Column) -> Column:
    """``host/owner__name.sha`` -> ``owner/name``."""
    return F.replace(F.regexp_extract(basename(image), r"^(.*)\.[^.]*$", 1), F.lit("__"), F.lit("/"))


def image_commit(image: Column) -> Column:
    return F.element_at(F.split(basename(image), r"\."), -1)
