"""Which lines are one template."""

from taskcurate.llm import templates


def dropped(spark, lines):
    """Texts of one line each that lose it; doc_id is the place in ``lines``."""
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {lines[r.doc_id] for r in templates.recurring_lines(docs).collect()}


def test_clean_lines_that_share_an_opening_stay(spark):
    ends = ("good dog here", "long way home", "small red boat", "quiet old town", "very bad idea", "fine new road", "cold dark night", "warm summer day", "rather odd story", "simple little song", "great big house", "poor lost child")
    short = ("dog", "cat", "boat", "town", "idea", "road", "night", "day", "story", "song", "house", "child")
    assert dropped(spark, [f"This is a {e}" for e in ends]) == set()
    assert dropped(spark, [f"This is a {e}" for e in short]) == set()
    assert dropped(spark, [f"This is a {e} {short[-i]}" for i, e in enumerate(short)]) == set()


def test_every_template_of_a_leaf_has_fields(spark):
    names = ("anna", "bert", "cleo", "dora", "emil", "fritz", "gerd", "hans", "ida", "jan", "karl", "lena")
    cities = ("london",) * 5 + ("paris", "rome", "oslo", "bern", "kyiv", "wien", "graz")
    one = ["user session was closed for the account {} by the scheduler today".format(n) for n in names]
    two = ["user session was opened from a host in {} over some network".format(c) for c in cities]
    three = ["user session was moved to that new rack near london as planned"] * 20
    other = [f"user session was {' '.join(names[(i + k) % 12] + 'x' * k for k in range(8))}" for i in range(9)]
    assert len({len(x.split()) for x in (*one, *two, *three, *other)}) <= 3
    lines = one + two + other
    assert dropped(spark, lines) == set(one[1:]) | set(two[1:])
    assert dropped(spark, three + two) == {three[0]} | set(two[1:])


def test_long_exact_lines_need_two_documents(spark):
    from . import fixtures

    long = fixtures.prose(400, 55).replace("\n", " ")
    short = fixtures.prose(401, 30).replace("\n", " ")
    docs = spark.createDataFrame([(i, f"{fixtures.prose(410 + i, 5)}\n{x}") for i, x in enumerate((long, long, short, short, long.replace(long.split()[40], "other")))], "doc_id long, text string")
    assert [(r.doc_id, r.dropped) for r in templates.recurring_lines(docs, long_docs=2).collect()] == [(1, [1])]
    import corpus_pipeline as cp

    assert sum(long in r.text for r in cp.STAGES[1][1](spark, docs.selectExpr("*", "length(text) AS n_chars"), "").collect()) == 1
