"""Selecting pull requests, commits and task instances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patches as P
from ..functions import paths, titles
from .matching import containing
from .ordered import numbered

NUMBER_BLOCK = 4096


def valid_pulls(pulls: DataFrame, n_issues: Column) -> DataFrame:
    """Merged, and either linked to an issue or titled like a code change."""
    return pulls.filter(F.col("merged_at").isNotNull() & ((n_issues > 0) | titles.is_code_change(F.col("title"))))


def before_cutoff(df: DataFrame, cutoff: Column, column: str = "created_at") -> DataFrame:
    return df.filter(F.col(column) < cutoff)


def without_merges(commits: DataFrame) -> DataFrame:
    return commits.filter(F.col("n_parents") == 1)


def valid_instances(df: DataFrame) -> DataFrame:
    """Patch and context must be there; a missing statement is written later."""
    return df.filter((F.coalesce("patch", F.lit("")) != "") & (F.coalesce(F.size("patch_context"), F.lit(0)) > 0))


def keep_when(df: DataFrame, *predicates) -> DataFrame:
    """Row predicates of the user: callables from DataFrame to boolean Column."""
    return reduce(lambda d, p: d.filter(p(d)), predicates, df)


def funnel(df: DataFrame, steps: dict[str, Column], switched_off: Sequence[str] = ()) -> DataFrame:
    """Rows left after each step, all counted in one pass."""
    so_far, counts = F.lit(True), [F.count(F.lit(1)).alias("loaded")]
    for name, flag in steps.items():
        if name not in switched_off:
            so_far = so_far & F.coalesce(flag, F.lit(False))
            counts.append(F.count_if(so_far).alias(name))
    return df.agg(*counts)


def search_paths(df: DataFrame, keyword: str, limit: int = 50) -> DataFrame:
    """First ``limit`` paths whose file name holds the keyword in any case (a report, so limited)."""
    hits = df.filter(F.lower(paths.basename(F.col("path"))).contains(keyword.lower())).select("path").distinct()
    return hits.orderBy("path").limit(limit)


def select_ids(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id was asked for, and the asked-for ids that do not exist."""
    return df.join(ids, key, "left_semi"), ids.join(df, key, "left_anti")


def not_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(seen.select(*keys), list(keys), "left_anti")


def first_n(df: DataFrame, order: Sequence[Column], n: int, start: int = 0) -> DataFrame:
    out = df.orderBy(*order)
    return (out.offset(start) if start else out).limit(n)


def todo_after_limit(df: DataFrame, done: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Take the first ``n`` (0 = all), then drop what is finished."""
    head = first_n(df, order, n) if n else df
    return head.join(done.select(*keys), list(keys), "left_anti")


def batches(df: DataFrame, order: Sequence[Column], block: Sequence[Column], size: int) -> DataFrame:
    """Number the rows globally and cut slices of ``size``; no single-task sort."""
    return numbered(df, [], order, block, "_rank").withColumn("batch", F.floor((F.col("_rank") - 1) / size)).drop("_rank")


def near_equal_parts(df: DataFrame, order: Sequence[Column], block: Sequence[Column], n: int) -> DataFrame:
    """``n`` consecutive parts whose sizes differ by at most one, longer parts first."""
    ranked = numbered(df, [], order, block, "_rank").withColumn("_total", df.agg(F.count(F.lit(1))).scalar())
    base, extra, at = F.floor(F.col("_total") / n), F.col("_total") % n, F.col("_rank") - 1
    part = F.when(at < extra * (base + 1), F.floor(at / (base + 1))).otherwise(
        extra + F.floor((at - extra * (base + 1)) / F.greatest(base, F.lit(1)))
    )
    return ranked.withColumn("part", part.cast("long")).drop("_rank", "_total")


def decompose(files: DataFrame, key: str, threshold: int = 6, size: int = 4) -> DataFrame:
    """Big commits are cut into groups of ``size`` files; the group number is added.

    Small commits get a null group.  ``file_pos`` counts from 1 per key.  The
    files of a commit, one cell in its patch, meet in one window: one shuffle, none
    for files that are dealt by their key already.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    group = F.when(F.col("_n") > threshold, F.floor((F.col("file_pos") - 1) / size))
    return files.filter(F.col(key).isNotNull()).withColumn("_n", n).withColumn("group_no", group).drop("_n")


def group_id(instance: Column, group_no: Column) -> Column:
    return F.when(group_no.isNull(), instance).otherwise(F.concat(instance, F.lit("-g"), group_no.cast("string")))


def _nested_dirs(t_dirs: DataFrame, c_dirs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Directory pairs where one name is part of the other."""
    inner_test = containing(c_dirs, "code_dir", t_dirs, "test_dir", keys).select(*c_dirs.columns, "test_dir")
    return inner_test.unionByName(containing(t_dirs, "test_dir", c_dirs, "code_dir", keys)).distinct()


def match_tests(tests: DataFrame, code: DataFrame, keys: Sequence[str], target: Sequence[str] = ()) -> DataFrame:
    """Test files that belong to a code file of the same key.

    They match by equal stem, or because one directory name is part of the
    other.  Code files are first reduced to their distinct stems and
    directories (per ``target`` if given), so no file pairs are built.
    """
    t = tests.select(*keys, F.col("path").alias("test_path")).distinct().withColumns(
        {"stem": paths.test_stem(F.col("test_path")), "test_dir": paths.dirname(F.col("test_path"))}
    )
    c = code.select(*keys, *target, paths.code_stem(F.col("path")).alias("stem"), paths.dirname(F.col("path")).alias("code_dir"))
    by_stem = t.join(c.select(*keys, *target, "stem").distinct(), [*keys, "stem"])
    t_dirs = t.select(*keys, "test_dir").filter("test_dir <> ''").distinct()
    c_dirs = c.select(*keys, *target, "code_dir").filter("code_dir <> ''").distinct()
    dirs = _nested_dirs(t_dirs, c_dirs, keys).select(*keys, *target, "test_dir").distinct()
    by_dir = t.join(dirs, [*keys, "test_dir"])
    cols = [*keys, *target, "test_path"]
    return by_stem.select(*cols).unionByName(by_dir.select(*cols)).distinct()


def _dealt(groups: DataFrame, tests: DataFrame, key: str) -> DataFrame:
    """Rows of ``tests`` (key, path, more) with (group_no, matched): one for each group they go to, null for a small commit.

    The stems and directories of a commit become one cell, so test and code files meet
    once, by ``key``, and a test looks its groups up in the row.  The rules are those of :func:`match_tests`.
    """
    big, path = F.col("group_no").isNotNull(), F.col("path")
    code = groups.groupBy(key).agg(
        F.bool_or(big).alias("_big"),
        F.collect_set(F.when(big, F.struct(paths.code_stem(path).alias("name"), "group_no"))).alias("_stems"),
        F.collect_set(F.when(big, F.struct(paths.dirname(path).alias("name"), "group_no"))).alias("_dirs"),
    )
    named = tests.withColumns({"_stem": paths.test_stem(path), "_folder": paths.dirname(path)})  # before the join: once a row, not once a comparison
    stem, folder = F.col("_stem"), F.col("_folder")
    nested = lambda d: (folder != "") & (d != "") & (folder.contains(d) | d.contains(folder))
    hits = F.concat(F.filter("_stems", lambda c: c["name"] == stem), F.filter("_dirs", lambda c: nested(c["name"])))
    to = F.when(F.col("_big"), F.array_distinct(F.transform(hits, lambda c: c["group_no"]))).otherwise(F.array(F.lit(None).cast("long")))
    out = named.join(code, key).select(*tests.columns, F.posexplode_outer(to).alias("_i", "_to"))
    matched = F.col("_i").isNotNull()
    return out.select(*tests.columns, F.when(matched, F.col("_to")).otherwise(F.lit(0)).cast("long").alias("group_no"), matched.alias("matched"))


def assign_tests(groups: DataFrame, tests: DataFrame, key: str) -> DataFrame:
    """Give each test file to every group it matches; unmatched ones go to group 0 (``matched`` is false).

    ``groups`` is :func:`decompose` output.  Only decomposed keys take part.
    """
    files = tests.select(key, "path").repartition(key).distinct()
    dealt = _dealt(groups.filter("group_no IS NOT NULL"), files, key)
    return dealt.select(key, "group_no", F.col("path").alias("test_path"), "matched")


def sub_instances(groups: DataFrame, code: DataFrame, tests: DataFrame, key: str) -> DataFrame:
    """Instances after decomposition: (key, group_no, patch_context, patch, test_patch).

    ``groups`` is :func:`decompose` output, ``code`` and ``tests`` are the file
    diffs of the patch and the test patch (key, path, at, diff).  A group gets
    the diffs of its files and of the tests that match them, in order of
    ``at``; unmatched tests follow in group 0.  A small commit (null group) keeps all.
    Patches are text cells, so no longer than the commit.

    All rows are dealt by ``key`` alone and grouped, not joined, so a diff is moved once.
    """

    def text(parts: Column) -> Column:
        diffs = F.transform(F.array_sort(parts), lambda x: x["diff"])
        return F.when(F.size(diffs) > 0, F.concat(F.array_join(diffs, "\n"), F.lit("\n"))).otherwise(F.lit(""))

    group = F.coalesce(F.col("group_no"), F.lit(-1).cast("long"))
    place = groups.select(key, "path", F.struct(group.alias("_g"), "file_pos").alias("_place"))
    diff = code.filter(F.col("path").isNotNull()).select(key, "path", F.struct("at", "diff").alias("_diff"))
    # a file has its diff once in a group, at the first of its places there
    by_path = place.unionByName(diff, allowMissingColumns=True).groupBy(key, "path").agg(
        F.array_sort(F.collect_list("_place")).alias("_places"), F.collect_list("_diff").alias("_diffs")
    )
    first = lambda i: (i == 0) | (F.get("_places", i - 1)["_g"] != F.get("_places", i)["_g"])
    rows = F.transform("_places", lambda p, i: F.struct(p["_g"].alias("_g"), p["file_pos"].alias("file_pos"), F.when(first(i), F.col("_diffs")).alias("_patch")))
    files = by_path.select(key, "path", F.inline(rows)).select(key, "_g", F.struct("file_pos", "path").alias("_file"), "_patch")
    dealt = _dealt(groups, tests, key).select(key, group.alias("_g"), F.struct((~F.col("matched")).alias("_last"), "at", "diff").alias("_test"))
    out = files.unionByName(dealt, allowMissingColumns=True).groupBy(key, "_g").agg(
        F.transform(F.array_sort(F.collect_list("_file")), lambda x: x["path"]).alias("patch_context"),
        text(F.flatten(F.collect_list("_patch"))).alias("patch"), text(F.collect_list("_test")).alias("test_patch"),
    )
    return out.filter(F.size("patch_context") > 0).select(key, F.when(F.col("_g") >= 0, F.col("_g")).alias("group_no"), "patch_context", "patch", "test_patch")


# Names of the test file of a module or of a folder.
TEST_NAMES = ("test_%s.py", "test%s.py", "%s_test.py", "%stest.py")


def _ending_with(files: DataFrame, name: str, tests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns of ``files`` and test_path: the test files of the same keys whose path ends with the file name in ``name``.

    A mark at both ends makes the end of a path a part of it, so files meet by their rarest part.
    """
    ends = F.concat(paths.basename(F.col("test_path")), F.lit("\n"))
    wanted = files.withColumn("_name", F.concat(F.col(name), F.lit("\n")))
    met = containing(tests.withColumn("_base", ends), "_base", wanted.select(*keys, "_name").distinct(), "_name", keys)
    return wanted.join(met.select(*keys, "_name", "test_path"), [*keys, "_name"]).drop("_name")


def _modules(code: DataFrame, tests: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Of distinct code files: (keys, path, target) of those with a test file of their name, and the others."""
    name = F.regexp_replace(paths.basename(F.col("path")), r"^[.py]+|[.py]+$", "")
    src = code.select(*keys, "path").distinct()
    wanted = src.withColumn("ending", F.explode(F.array(*[F.format_string(f, name) for f in TEST_NAMES])))
    named = _ending_with(wanted, "ending", tests, keys).groupBy(*keys, "path").agg(F.min("test_path").alias("target"))
    return named, src.join(named, [*keys, "path"], "left_anti").withColumn("parent", paths.basename(paths.dirname(F.col("path"))))


def _first_folders(tests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, parent, first): the first test file, with its folder, among the folders of one last name."""
    folder = paths.dirname(F.col("test_path"))
    return tests.select(*keys, paths.basename(folder).alias("parent"), F.struct("test_path", folder.alias("folder")).alias("_t")).groupBy(*keys, "parent").agg(F.min("_t").alias("first"))


def candidate_tests(code: DataFrame, tests: DataFrame, keys: Sequence[str] = ("repo",)) -> DataFrame:
    """A test target for each code file: a test file by name, else a test directory.

    A test file fits if its name ends in ``test_x.py``, ``testx.py``,
    ``x_test.py`` or ``xtest.py``.  Otherwise the directory of a test file
    with the same parent name is taken.  The alphabetically first hit wins.
    """
    keys = list(keys)
    known = tests.select(*keys, F.col("path").alias("test_path")).distinct()
    named, rest = _modules(code, known, keys)
    folders = _first_folders(known, keys).select(*keys, "parent", F.col("first.folder").alias("target"))
    return named.unionByName(rest.join(folders, [*keys, "parent"]).select(*keys, "path", "target"))


def test_targets(code: DataFrame, tests: DataFrame, patched_tests: DataFrame, key: str, keys: Sequence[str] = ("repo",)) -> DataFrame:
    """(key, rule, target): what to run for each instance, by the first of three rules that gives anything.

    1. ``test_patch``: all test files whose path ends with the name of a file of the test patch (key, keys, path).
    2. ``name``, for each file of the patch (``code``: key, keys, path): the first test file named after it.
    3. For a file without one, in the order of the test files up to the first whose
       folder is named like the folder of the file: ``parent`` for each test file named
       after that folder, then ``folder`` for the folder found.

    Test files in a folder that is itself a target of the instance are left out.
    ``tests`` is (keys, path).  Files are resolved once for all instances that share them.
    """
    keys = list(keys)
    known = tests.select(*keys, F.col("path").alias("test_path")).distinct()
    given = patched_tests.select(key, *keys, paths.basename(F.col("path")).alias("_file")).distinct()
    by_patch = _ending_with(given, "_file", known, keys).select(key, F.lit("test_patch").alias("rule"), F.col("test_path").alias("target"))

    named, rest = _modules(code, known, keys)
    placed = rest.join(_first_folders(known, keys), [*keys, "parent"], "left")
    called = placed.withColumn("_base", F.explode(F.array(*[F.format_string(f, F.col("parent")) for f in TEST_NAMES])))
    by_parent = called.filter("parent <> ''").join(known.withColumn("_base", paths.basename(F.col("test_path"))), [*keys, "_base"]).filter("first IS NULL OR test_path < first.test_path")
    found = (
        named.withColumn("rule", F.lit("name")).select(*keys, "path", "rule", "target")
        .union(by_parent.select(*keys, "path", F.lit("parent"), "test_path"))
        .union(placed.filter("first IS NOT NULL").select(*keys, "path", F.lit("folder"), "first.folder"))
    )
    by_code = code.select(key, *keys, "path").join(found, [*keys, "path"]).select(key, "rule", "target")
    # the targets of an instance meet once, and the rules between them are applied there
    targets = by_patch.unionByName(by_code).groupBy(key).agg(F.collect_set(F.struct("rule", "target")).alias("_all"))
    of = lambda rule: F.filter("_all", lambda t: t["rule"] == rule)
    targets = targets.withColumns({"_listed": of("test_patch"), "_folders": F.transform(of("folder"), lambda t: t["target"])})
    apart = F.filter("_all", lambda t: (t["rule"] == "folder") | ~F.coalesce(F.array_contains("_folders", paths.dirname(t["target"])), F.lit(False)))
    kept = F.when(F.col(key).isNull(), F.col("_all")).when(F.size("_listed") > 0, F.col("_listed")).otherwise(apart)  # rows without a key are no instance
    return targets.select(key, F.inline(kept))
