"""Console output of test runs: markers, statuses and names, per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let, strip

# Hints that a failure comes from the environment, not the code.
INFRA_KEYWORDS = (
    "no such file or directory", "command not found", "modulenotfounderror", "importerror", "import error", "pytest",
    ".venv", "xdist", "--cov", "dependency", "pip install", "uv sync", "git apply", "patch failed", "environment", "docker",
)

# Result lines of the three log dialects.
_TWO_STATUS = r"(?m)^(\S+::\S+)\s+(PASSED|FAILED)\s"
_FOUR_STATUS = r"(?m)^(\S+::\S+)\s+(PASSED|FAILED|ERROR|SKIPPED)"
_WITH_SUMMARY = r"(?m)^(?:([\w/._-]+::[\w:._-]+)\s+(PASSED|FAILED)|FAILED\s+([\w/._-]+::[\w:._-]+))"

RESULT = "array<struct<test_id:string,status:string>>"


def exit_code(log: Column) -> Column:
    """Number after ``<NAME>_EXIT_CODE=``; null if the marker is missing."""
    return F.nullif(F.regexp_extract(log, r"\w+_EXIT_CODE=(\d+)", 1), F.lit("")).cast("long")


def exit_code_reward(log: Column) -> Column:
    return F.when(exit_code(log) == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def classify_exit_codes(pre: Column, post: Column) -> Column:
    return F.when(pre.isNull() | post.isNull(), F.lit("ERROR")).otherwise(_transition(pre == 0, post == 0))


def _transition(pre_ok: Column, post_ok: Column) -> Column:
    return (
        F.when(~pre_ok & post_ok, "FAIL2PASS")
        .when(pre_ok & post_ok, "PASS2PASS")
        .when(~pre_ok & ~post_ok, "FAIL2FAIL")
        .otherwise("PASS2FAIL")
    )


def classify_statuses(pre: Column, post: Column) -> Column:
    return _transition(pre == "PASSED", post == "PASSED")


def _pairs(ids: Column, statuses: Column) -> Column:
    return F.transform(
        F.arrays_zip(ids.alias("a"), statuses.alias("b")), lambda z: F.struct(z["a"].alias("test_id"), z["b"].alias("status"))
    )


def verbose_results(log: Column) -> Column:
    """Ordered (test_id, status) pairs, PASSED and FAILED only."""
    return _pairs(F.regexp_extract_all(log, F.lit(_TWO_STATUS), 1), F.regexp_extract_all(log, F.lit(_TWO_STATUS), 2))


def full_results(log: Column) -> Column:
    return _pairs(F.regexp_extract_all(log, F.lit(_FOUR_STATUS), 1), F.regexp_extract_all(log, F.lit(_FOUR_STATUS), 2))


def results_with_summary(log: Column) -> Column:
    """As :func:`verbose_results`, and ``FAILED x`` summary lines count too."""
    parts = [F.regexp_extract_all(log, F.lit(_WITH_SUMMARY), i).alias(f"g{i}") for i in (1, 2, 3)]
    return F.transform(
        F.arrays_zip(*parts),
        lambda z: F.when(z["g3"] != "", F.struct(z["g3"].alias("test_id"), F.lit("FAILED").alias("status"))).otherwise(
            F.struct(z["g1"].alias("test_id"), z["g2"].alias("status"))
        ),
    )


def last_results(results: Column) -> Column:
    """Results by rising test id, of each test the last one; sorted once, no map look-ups."""
    numbered = F.transform(results, lambda r, i: F.struct(r["test_id"].alias("test_id"), i.alias("at"), r["status"].alias("status")))
    last = lambda rs: F.filter(rs, lambda r, i: ~F.get(rs, i + 1)["test_id"].eqNullSafe(r["test_id"]))
    return let(F.array_sort(numbered), lambda rs: F.transform(last(rs), lambda r: F.struct(r["test_id"].alias("test_id"), r["status"].alias("status"))))


def matched_results(pre: Column, post: Column) -> Column:
    """(test_id, pre, post) of the tests in both lists of :func:`last_results`, by rising id: neighbours of one sorted array."""
    side = lambda rs, n: F.transform(rs, lambda r: F.struct(r["test_id"].alias("test_id"), F.lit(n).alias("side"), r["status"].alias("status")))

    def pairs(rs: Column) -> Column:
        both = F.transform(rs, lambda r, i: F.struct(r["test_id"].alias("test_id"), r["status"].alias("pre"), F.when(F.get(rs, i + 1)["test_id"] == r["test_id"], F.get(rs, i + 1)["status"]).alias("post")))
        return F.filter(both, lambda b: b["post"].isNotNull())

    return let(F.array_sort(F.concat(side(pre, 0), side(post, 1))), pairs)


def matched_ids(matched: Column, pre: str, post: str) -> Column:
    """Ids of :func:`matched_results` with these two statuses."""
    return F.transform(F.filter(matched, lambda m: (m["pre"] == pre) & (m["post"] == post)), lambda m: m["test_id"])


def dotted_name(test: Column) -> Column:
    """What follows the first ``::`` of a test name, joined by dots."""
    parts = F.split(test, "::")
    return F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), ".")


def short_summary_results(log: Column) -> Column:
    """Pairs from the text between the first and second summary marker."""
    section = F.element_at(F.split(log, "short test summary info"), 2)
    rows = F.when(log.contains("short test summary info"), F.split(strip(section), "\n")).otherwise(F.array().cast("array<string>"))

    def result(line: Column) -> Column:
        cut = F.substring_index(dotted_name(line), " - ", 1)
        return (
            F.when(line.contains("PASSED"), F.struct(dotted_name(line).alias("test_id"), F.lit("PASSED").alias("status")))
            .when(line.contains("FAILED"), F.struct(cut.alias("test_id"), F.lit("FAILED").alias("status")))
            .when(line.contains("ERROR"), F.struct(cut.alias("test_id"), F.lit("ERROR").alias("status")))
        )

    return F.filter(F.transform(rows, result), lambda r: r.isNotNull())


# Log parsers by repository; unknown repositories use the default.
PARSERS: dict[str, Callable[[Column], Column]] = {
    name: short_summary_results
    for name in (
        "sympy", "pandas", "pillow", "scrapy", "pyramid", "tornado", "datalad", "aiohttp", "coveragepy", "numpy", "orange3",
    )
}


def parser_for(repo: str) -> Callable[[Column], Column]:
    return PARSERS.get(repo, short_summary_results)


def without_colour(text: Column) -> Column:
    return F.regexp_replace(text, "\u001b\\[\\d+m", "")


def without_control(text: Column) -> Column:
    """Whole text: colour codes with any parameters and carriage returns go."""
    return F.regexp_replace(text, "\u001b\\[[0-9;]*m|\r", "")


def colourless_keys(results: Column) -> Column:
    return F.transform_keys(results, lambda k, _: without_colour(k))


def infra_failure(classification: Column, *guidance: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *guidance))
    hit = F.lit(False)
    for word in INFRA_KEYWORDS:
        hit = hit | text.contains(word)
    return F.coalesce(classification.isin("FAIL2FAIL", "ERROR"), F.lit(False)) | hit


def import_error(log: Column) -> Column:
    """Some line names "attribute" or "import", and such a line says error or fail."""
    return F.exists(
        F.split(F.lower(log), "\n"),
        lambda l: (l.contains("attribute") | l.contains("import")) & (l.contains("error") | l.contains("fail")),
    )


def failure_sections(log: Column) -> Column:
    """Array of (test, body) from the ERRORS and FAILURES parts of a log.

    The part before the warnings summary and the PASSES header counts.
    Parameters in brackets are cut from the test name.
    """
    text = F.substring_index(F.substring_index(log, "====== warnings summary =========", 1), "============================= PASSES ", 1)
    parts = F.split(strip(text), r"\n=+\s+(?:ERRORS|FAILURES)\s+=+\n")
    sections = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    blocks = F.filter(F.flatten(F.transform(sections, lambda s: F.split(s, r"\n__+\s+|^__+\s+"))), lambda b: b.rlike(r"\S"))

    def parsed(b: Column) -> Column:
        first = F.regexp_replace(F.substring_index(strip(b), "\n", 1), r"^[_\s]+", "")
        first = F.regexp_replace(first, r"^ERROR at setup of ", "")
        test = F.substring_index(F.element_at(F.split(strip(first), r"\s+"), 1), "[", 1)
        body = F.when(b.contains("\n"), strip(F.regexp_replace(b, r"^[^\n]*\n", ""))).otherwise(F.lit(""))
        return F.struct(test.alias("test"), body.alias("body"))

    return F.transform(blocks, parsed)
