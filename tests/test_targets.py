"""What to run for an instance, and which version it has, against plain readings of the rules."""

import os
import random


from taskcurate.operators import instances as I
from taskcurate.operators import rules


def plain_targets(code, tests, patched):
    """The rule for one instance, path by path."""
    tests = sorted(set(tests))
    rv = {("test_patch", t) for x in patched for t in tests if t.endswith(os.path.basename(x))}
    if rv:
        return rv
    found = set()
    for path in code:
        name, parent = os.path.basename(path).strip(".py"), os.path.basename(os.path.dirname(path))
        names = [f % name for f in I.TEST_NAMES]
        hit = next((t for t in tests if any(t.endswith(n) for n in names)), None)
        if hit:
            found.add(("name", hit))
            continue
        for t in tests:
            if os.path.basename(os.path.dirname(t)) == parent:
                found.add(("folder", os.path.dirname(t)))
                break
            if parent and os.path.basename(t) in [f % parent for f in I.TEST_NAMES]:
                found.add(("parent", t))
    folders = {t for r, t in found if r == "folder"}
    return {(r, t) for r, t in found if r == "folder" or os.path.dirname(t) not in folders}


def test_targets_by_rule(spark):
    r = random.Random(2)
    dirs = ["", "a", "src/a", "tests", "tests/a", "b/c", "lib/util"]
    stems = ["a", "b", "util", "c", "happy", "x_y"]
    names = [f % s for s in stems for f in I.TEST_NAMES] + ["mytest_a.py", "conftest.py", "other.py"]
    join = lambda d, n: f"{d}/{n}" if d else n
    tests = {repo: [join(r.choice(dirs), r.choice(names)) for _ in range(r.choice((2, 5, 9)))] for repo in "pqrst"}
    code, patched, want = [], [], {}
    for i in range(80):
        repo = r.choice("pqrst")
        own = [join(r.choice(dirs), r.choice(stems) + ".py") for _ in range(r.randrange(4))]
        listed = [join(r.choice(dirs), r.choice(names)) for _ in range(2)] if i % 4 == 0 else []
        code += [(i, repo, p) for p in own]
        patched += [(i, repo, p) for p in listed]
        want[i] = plain_targets(own, tests[repo], listed)
    schema = "id int, repo string, path string"
    got = {}
    known = spark.createDataFrame([(k, t) for k, v in tests.items() for t in v], "repo string, path string")
    for row in I.test_targets(spark.createDataFrame(code, schema), known, spark.createDataFrame(patched, schema), "id").collect():
        got.setdefault(row.id, set()).add((row.rule, row.target))
    assert got == {i: t for i, t in want.items() if t}
    assert {rule for t in want.values() for rule, _ in t} == {"test_patch", "name", "parent", "folder"}


def test_targets_meet_once(spark):
    """The rules between the targets of an instance need no joins; rows that come twice count once, rows without an instance keep all."""
    code = [(1, "r", "lib/a.py"), (1, "r", "lib/a.py"), (2, "r", "lib/a.py"), (None, "r", "lib/a.py"), (None, "r", "x/tests/util.py"), (3, "r", "x/tests/util.py"), (3, "r", "lib/a.py")]
    tests = [("r", "x/tests/test_a.py"), ("r", "x/tests/test_a.py"), ("r", "y/test_b.py")]
    schema = "id int, repo string, path string"
    df = I.test_targets(spark.createDataFrame(code, schema), spark.createDataFrame(tests, "repo string, path string"), spark.createDataFrame([(2, "r", "z/test_b.py"), (2, "r", "q/test_b.py")], schema), "id")
    a, folder = "x/tests/test_a.py", "x/tests"
    want = [(1, "name", a), (2, "test_patch", "y/test_b.py"), (3, "folder", folder), (None, "folder", folder), (None, "name", a)]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline(") == 1


def test_version_by_the_first_file_that_tells(spark):
    instances = spark.createDataFrame(
        [(1, "psf/requests", 1, "c1"), (2, "psf/requests", 2, "c2"), (3, "tqdm/tqdm", 3, "c3"), (4, "pyca/cryptography", 8390, "c4"), (5, "nobody/else", 5, "c5"), (6, "tqdm/tqdm", 6, "c6"), (7, "django/django", 7, "c7")],
        "id int, repo string, number int, base_commit string",
    )
    files = spark.createDataFrame(
        [
            ("psf/requests", "c1", "requests/__init__.py", "__version__ = '9.9.9'"), ("psf/requests", "c1", "requests/__version__.py", "__version__ = '1.2.3'"),
            ("psf/requests", "c2", "requests/__version__.py", '"""__version__ = \'1.1.1\'"""'), ("psf/requests", "c2", "requests/__init__.py", "__version__ = '4.5.6rc1'"),
            ("tqdm/tqdm", "c3", "tqdm/_version.py", "nothing"), ("tqdm/tqdm", "c6", "tqdm/_version.py", "version_info = 4, 11, 2 "),
            ("pyca/cryptography", "c4", "src/cryptography/__about__.py", "__version__ = '1.0'"), ("django/django", "c7", "django/version.py", "VERSION = (3, 1)"), ("django/django", "other", "django/__init__.py", "VERSION = (3, 1)"),
        ],
        "repo string, commit string, path string, text string",
    )
    df = rules.version_from_files(instances, files, ["id"])
    assert {r.id: r.version for r in df.collect()} == {1: "1.2", 2: "4.5", 3: "get_version", 4: "40.0", 5: None, 6: "4.11", 7: None}
    shuffled = [l for l in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in l]
    assert shuffled and not any("text" in l for l in shuffled)
