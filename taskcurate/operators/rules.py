"""Ordered rule tables: the first rule that fits decides.

The tables are fixed and short (their size is known here), so they become one
chain of conditions inside the projection: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import let
from ..functions.paths import basename

# File name pattern, test module, suite, prefix; in order of precedence.
SUITES = (
    ("check-*.test", "testcheck.py", "TypeCheckSuite", "mypy"),
    ("cmdline*.test", "testcmdline.py", "PythonCmdlineSuite", "mypy"),
    ("daemon.test", "testdaemon.py", "DaemonSuite", "mypy"),
    ("fine-grained-cache*.test", "testfinegrainedcache.py", "FineGrainedCacheSuite", "mypy"),
    ("fine-grained*.test", "testfinegrained.py", "FineGrainedSuite", "mypy"),
    ("semanal-error*.test", "testsemanal.py", "SemAnalErrorSuite", "mypy"),
    ("semanal-symtable*.test", "testsemanal.py", "SemAnalSymtableSuite", "mypy"),
    ("semanal-typeinfo*.test", "testsemanal.py", "SemAnalTypeInfoSuite", "mypy"),
    ("semanal-*.test", "testsemanal.py", "SemanticAnalyzerSuite", "mypy"),
    ("deps.test", "testdeps.py", "GetDependenciesSuite", "mypy"),
    ("deps-*.test", "testdeps.py", "GetDependenciesSuite", "mypy"),
    ("diff.test", "testdiff.py", "ASTDiffSuite", "mypy"),
    ("pep561.test", "testpep561.py", "PEP561Suite", "mypy"),
    ("pythoneval*.test", "testpythoneval.py", "PythonEvaluationSuite", "mypy"),
    ("ref-info.test", "test_ref_info.py", "RefInfoSuite", "mypy"),
    ("reports.test", "testreports.py", "CoberturaReportSuite", "mypy"),
    ("stubgen.test", "teststubgen.py", "StubgenPythonSuite", "mypy"),
    ("errorstream.test", "testerrorstream.py", "ErrorStreamSuite", "mypy"),
    ("merge.test", "testmerge.py", "ASTMergeSuite", "mypy"),
    ("outputjson.test", "testoutput.py", "OutputJSONsuite", "mypy"),
    ("python2eval.test", "testpythoneval.py", "PythonEvaluationSuite", "mypy"),
    ("parse*.test", "testparse.py", "ParseSuite", "mypy"),
    ("typexport-basic*.test", "testtypegen.py", "TypeExportSuite", "mypy"),
    ("alwaysdefined.test", "test_alwaysdefined.py", "TestAlwaysDefined", "mypyc"),
    ("analysis.test", "test_analysis.py", "TestAnalysis", "mypyc"),
    ("commandline.test", "test_commandline.py", "TestCommandLine", "mypyc"),
    ("exceptions*.test", "test_exceptions.py", "TestExceptionTransform", "mypyc"),
    ("irbuild-*.test", "test_irbuild.py", "TestGenOps", "mypyc"),
    ("lowering-*.test", "test_lowering.py", "TestLowering", "mypyc"),
    ("opt-copy-propagation.test", "test_optimizations.py", "TestCopyPropagation", "mypyc"),
    ("opt-flag-elimination.test", "test_optimizations.py", "TestFlagElimination", "mypyc"),
    ("refcount.test", "test_refcount.py", "TestRefCountTransform", "mypyc"),
    ("run-*.test", "test_run.py", "TestRun", "mypyc"),
    ("tuplename.test", "test_tuplename.py", "TupleNameSuite", "mypyc"),
    ("typeops.test", "test_typeops.py", "TypeOpsSuite", "mypyc"),
)


def _like(glob: str) -> str:
    return glob.replace("_", r"\_").replace("*", "%")


def test_suite_command(path: Column) -> Column:
    """``<prefix>/test/<module>::<suite>::<file>``; null if no rule fits the file name."""
    name, chain = basename(path), None
    for glob, module, suite, prefix in SUITES:
        value = F.concat(F.lit(f"{prefix}/test/{module}::{suite}::"), name)
        hit = name.like(_like(glob))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


# Version patterns by repository, in order of precedence.
_DUNDER = r"""__version__ = ['"](.*)['"]"""
_DUNDER_ALIAS = r"""__version__ = version = ['"](.*)['"]"""
_TUPLE = r"VERSION = \((.*)\)"
_JSON = r'"version":\s*"([^"]+)"'
_POM = (r"<version>(\d+(?:\.\d+)*\.[A-Za-z][A-Za-z0-9\-]*)</version>", r"<version>(\d+\.\d+\.\d+(?:-\w+)?)</version>")
VERSION_PATTERNS: dict[str, tuple[str, ...]] = {
    "dbt-labs/dbt-core": (_DUNDER, _TUPLE),
    "django/django": (_DUNDER, _TUPLE),
    "huggingface/transformers": (_DUNDER, _TUPLE),
    "marshmallow-code/marshmallow": (_DUNDER, _TUPLE),
    "mwaskom/seaborn": (_DUNDER, _TUPLE),
    "pallets/flask": (_DUNDER, _TUPLE),
    "psf/requests": (_DUNDER, _TUPLE),
    "pyca/cryptography": (_DUNDER, _TUPLE),
    "pylint-dev/astroid": (_DUNDER, _TUPLE),
    "pylint-dev/pylint": (_DUNDER, _TUPLE),
    "scikit-learn/scikit-learn": (_DUNDER, _TUPLE),
    "sphinx-doc/sphinx": (_DUNDER, _TUPLE),
    "sympy/sympy": (_DUNDER, _TUPLE),
    "python/mypy": (_DUNDER, _TUPLE),
    "iamkun/dayjs": (r"\[\s*(\d+\.\d+\.\d+)\s*\]",),
    "statsmodels/statsmodels": (r"version(\d+\.\d+(?:\.\d+)?(?:-\d+)?)",),
    "prettier/prettier": (_JSON,),
    "tailwindlabs/tailwindcss": (_JSON,),
    "jestjs/jest": (_JSON,),
    "webpack/webpack": (_JSON,),
    "babel/babel": (_JSON,),
    "apollographql/apollo-client": (_JSON,),
    "netty/netty": _POM,
    "assertj/assertj": _POM,
    "google/gson": _POM,
    "pytest-dev/pytest": (_DUNDER, _DUNDER_ALIAS, _TUPLE),
    "matplotlib/matplotlib": (_DUNDER, _DUNDER_ALIAS, _TUPLE),
    "dateutil/dateutil": (r"Version\s+(\d+\.\d+(?:\.\d+)?)",),
    "Qiskit/qiskit": (r"(.*)",),
    "pyvista/pyvista": (r"version_info = ([\d]+,[\d\s]+),",),
    "tqdm/tqdm": (r"version_info = ([\d]+, [\d]+, [\d\s]+)",),
    "redis/redis-py": (r'version="(.*?)"', _DUNDER),
}

# Files that tell the version, by repository, in order of precedence.
VERSION_PATHS: dict[str, tuple[str, ...]] = {
    "dbt-labs/dbt-core": ("core/dbt/version.py", "core/dbt/__init__.py"),
    "django/django": ("django/__init__.py",),
    "huggingface/transformers": ("src/transformers/__init__.py",),
    "marshmallow-code/marshmallow": ("src/marshmallow/__init__.py",),
    "mwaskom/seaborn": ("seaborn/__init__.py",),
    "pallets/flask": ("src/flask/__init__.py", "flask/__init__.py"),
    "psf/requests": ("requests/__version__.py", "requests/__init__.py"),
    "pyca/cryptography": ("src/cryptography/__about__.py", "src/cryptography/__init__.py"),
    "pylint-dev/astroid": ("astroid/__pkginfo__.py", "astroid/__init__.py"),
    "pylint-dev/pylint": ("pylint/__pkginfo__.py", "pylint/__init__.py"),
    "pytest-dev/pytest": ("src/_pytest/_version.py", "_pytest/_version.py"),
    "pyvista/pyvista": ("pyvista/_version.py", "pyvista/__init__.py"),
    "Qiskit/qiskit": ("qiskit/VERSION.txt",),
    "scikit-learn/scikit-learn": ("sklearn/__init__.py",),
    "sphinx-doc/sphinx": ("sphinx/__init__.py",),
    "sympy/sympy": ("sympy/release.py", "sympy/__init__.py"),
    "pillow/pillow": ("src/PIL/_version.py",),
    "dateutil/dateutil": ("NEWS",),
    "python/mypy": ("mypy/version.py",),
    "redis/redis-py": ("setup.py", "redis/__init__.py"),
    "tqdm/tqdm": ("tqdm/_version.py",),
    "prettier/prettier": ("package.json",),
    "tailwindlabs/tailwindcss": ("package.json",),
    "jestjs/jest": ("lerna.json", "package.json"),
    "webpack/webpack": ("package.json",),
    "apollographql/apollo-client": ("package.json",),
    "iamkun/dayjs": ("CHANGELOG.md",),
    "babel/babel": ("package.json",),
    "statsmodels/statsmodels": ("docs/source/release/index.rst",),
    "assertj/assertj": ("pom.xml",),
    "netty/netty": ("pom.xml",),
    "google/gson": ("pom.xml",),
}

# What a repository gets if no file tells its version.
VERSION_FALLBACKS = {"tqdm/tqdm": "get_version"}

# Pull requests whose version is known beforehand (repository, first, last, version).
VERSION_OVERRIDES = (("dateutil/dateutil", 510, 624, "2.7"), ("pyca/cryptography", 8390, 8390, "40.0"))


def version_in_text(repo: Column, text: Column) -> Column:
    """``major.minor`` by the patterns of the repository; null if none fits.

    Strings in triple double quotes are left out of the search.
    """
    body = F.regexp_replace(text, r'(?s)""".*?"""', "")
    by_patterns: dict[tuple[str, ...], list[str]] = {}
    for name, patterns in VERSION_PATTERNS.items():
        by_patterns.setdefault(patterns, []).append(name)
    raw = None
    for patterns, names in by_patterns.items():
        found = F.coalesce(*[F.when(body.rlike(p), F.regexp_extract(body, p, 1)) for p in patterns])
        raw = F.when(repo.isin(*names), found) if raw is None else raw.when(repo.isin(*names), found)

    def short(found: Column) -> Column:
        compact = F.replace(found, F.lit(" "), F.lit(""))
        sep = F.when(compact.contains("."), F.lit(".")).otherwise(F.lit(","))
        pair = F.array_join(F.slice(F.split(compact, r"[.,]"), 1, 2), ".")
        return F.when(compact.contains(sep), F.regexp_replace(pair, r"[^0-9.]", "")).otherwise(F.regexp_replace(compact, r"[^0-9.]", ""))

    return let(raw, short)


def known_version(repo: Column, number: Column) -> Column:
    """Version of a pull request that is known beforehand, else null."""
    known = F.lit(None).cast("string")
    for name, first, last, version in VERSION_OVERRIDES:
        known = F.when((repo == name) & number.between(first, last), version).otherwise(known)
    return known


def version_from_text(df: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """Version of each row (repo, number, text), the known ones first."""
    return df.select(*keys, F.coalesce(known_version(F.col("repo"), F.col(number)), version_in_text(F.col("repo"), F.col("text"))).alias("version"))


def _by_repository(repo: Column, values: dict, empty: Column) -> Column:
    out = None
    for name, value in values.items():
        out = F.when(repo == name, value) if out is None else out.when(repo == name, value)
    return empty if out is None else out


def path_rank(repo: Column, path: Column) -> Column:
    """Place of a path, from 1, among the files that tell the version of its repository; null for any other file."""
    wanted = _by_repository(repo, {n: F.array(*map(F.lit, ps)) for n, ps in VERSION_PATHS.items()}, F.array().cast("array<string>"))
    return F.nullif(F.array_position(wanted, path), F.lit(0))


def version_from_files(instances: DataFrame, files: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """(keys, version) of each instance (keys, repo, number, base_commit) from the files (repo, commit, path, text) of its commit.

    Only the version files of a repository take part.  Each is read where it
    lies; what moves is its rank and its version, never its text.  Of the files that
    tell a version the first in precedence counts, whether or not the ones before it exist.
    Then come the fallback of the repository, and null.
    """
    ranked = files.select("repo", F.col("commit").alias("base_commit"), path_rank(F.col("repo"), F.col("path")).alias("_rank"), "text").filter("_rank IS NOT NULL")
    told = ranked.select("repo", "base_commit", "_rank", version_in_text(F.col("repo"), F.col("text")).alias("_told"))
    best = told.filter("_told IS NOT NULL").groupBy("repo", "base_commit").agg(F.min_by("_told", "_rank").alias("_told"))
    found = instances.select(*keys, "repo", "base_commit", known_version(F.col("repo"), F.col(number)).alias("_known")).join(best, ["repo", "base_commit"], "left")
    rest = _by_repository(F.col("repo"), {n: F.lit(v) for n, v in VERSION_FALLBACKS.items()}, F.lit(None).cast("string"))
    return found.select(*keys, F.coalesce("_known", "_told", rest).alias("version"))
