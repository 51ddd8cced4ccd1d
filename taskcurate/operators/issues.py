"""Issues linked to pull requests, their text, and hints gated by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import titles
from ..functions.common import strip
from .ordered import running


def linked_issues(pulls: DataFrame, commits: DataFrame, bare_title_fallback: bool = True) -> DataFrame:
    """Distinct (number, issue) pairs from title, body and commit messages.

    Commit messages are searched one by one, so nothing is gathered per pull
    request.  Without any hit, bare ``#N`` in the title counts (if allowed).
    """
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")))
    own = pulls.select("number", F.explode(titles.resolved_issues(text)).alias("issue"))
    from_commits = commits.select("number", F.explode(titles.resolved_issues(F.col("message"))).alias("issue"))
    found = own.unionByName(from_commits.join(pulls, "number", "left_semi")).distinct()
    if not bare_title_fallback:
        return found
    bare = pulls.select("number", F.explode(titles.bare_references(F.coalesce("title", F.lit("")))).alias("issue"))
    return found.unionByName(bare.distinct().join(found.select("number").distinct(), "number", "left_anti"))


def gated_comments(comments: DataFrame, commits: DataFrame, prefix: bool = True) -> DataFrame:
    """Comments made before the first commit of the pull request.

    With ``prefix`` reading stops at the first comment that is too late, in
    list order; otherwise every early comment counts.  The stop position is a
    plain minimum per issue, so no window over the comments is needed.
    """
    first = commits.groupBy(F.col("number").alias("issue")).agg(F.min_by("authored_at", "pos").alias("_gate"))
    timed = comments.join(first, "issue")
    if not prefix:
        return timed.filter(F.col("updated_at") < F.col("_gate")).drop("_gate")
    late = timed.filter(F.col("updated_at") >= F.col("_gate"))
    stops = late.groupBy("issue").agg(F.min(F.struct("ord", "comment_id")).alias("_stop"))
    out = timed.join(stops, "issue", "left")
    return out.filter(F.col("_stop").isNull() | (F.struct("ord", "comment_id") < F.col("_stop"))).drop("_gate", "_stop")


def joined_bodies(comments: DataFrame, separator: str = "\n\n---\n\n") -> DataFrame:
    """One hint text per issue: non-empty bodies in list order."""
    body = strip(F.col("body"))
    parts = comments.select("issue", "ord", "comment_id", body.alias("body")).filter("body <> ''")
    rows = F.array_sort(F.collect_list(F.struct("ord", "comment_id", "body")))
    return parts.groupBy("issue").agg(F.array_join(F.transform(rows, lambda r: r["body"]), separator).alias("hints"))


def without_bots(comments: DataFrame) -> DataFrame:
    return comments.filter(F.col("user_type") != "Bot")


def statements(links: DataFrame, issues: DataFrame) -> DataFrame:
    """Problem statement per pull request: title and body of each linked issue, in order.

    ``links`` is (number, ord, issue); issues that do not exist are skipped.
    """
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")), F.lit("\n"))
    rows = links.join(issues.select("issue", text.alias("text")), "issue")
    ordered = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return rows.groupBy("number").agg(F.array_join(F.transform(ordered, lambda r: r["text"]), "").alias("statement"))


def commit_pull(history: DataFrame, repo: str, order: list[str], block: list[Column], reach: int = 10) -> DataFrame:
    """Pull request of each commit: ``(#N)`` in its message, else the next merge.

    ``order`` are numeric columns, oldest first, and ``block`` rises with them.
    Only the next ``reach`` merge commits are considered, the commit included.
    """
    is_merge = (F.col("n_parents") > 1).cast("long")
    seen = running(history, [repo], [F.col(c) for c in order], block, exclusive=True, _merges=("sum", is_merge))
    target = F.when(
        (F.col("n_parents") > 1) & F.col("message").contains("Merge pull request") & F.col("message").rlike(r"#\d+"),
        F.struct((F.col("_merges") + 1).alias("at"), F.regexp_extract("message", r"#(\d+)", 1).alias("pull")),
    )
    ahead = running(seen, [repo], [F.col(c).desc() for c in order], [-b for b in block], _next=("min", target))
    own = F.nullif(F.regexp_extract("message", r"\(#(\d+)\)", 1), F.lit(""))
    near = F.when(F.col("_next.at") <= F.col("_merges") + reach, F.col("_next.pull"))
    return ahead.withColumn("pull", F.coalesce(own, near)).drop("_merges", "_next")


def expand_code_links(texts: DataFrame, sources: DataFrame, key: str = "doc_id") -> DataFrame:
    """Append the linked lines to each ``/blob/<sha>/<path>#La-Lb`` link of a text.

    ``sources`` is a line table (repo, sha, path, line_no, line).  Output is one row
    per link: its position in the text and the excerpt.
    """
    pattern = F.lit(r"https://[^\s/]+/([^\s/]+/[^\s/]+)/blob/([^\s/]+)/([^\s#]+)#L(\d+)-L(\d+)")
    zipped = F.arrays_zip(
        *[F.regexp_extract_all("text", pattern, i).alias(n) for i, n in enumerate(("link", "repo", "sha", "path", "a", "b"))]
    )
    links = texts.select(key, F.posexplode(zipped).alias("link_no", "_l")).select(key, "link_no", "_l.*")
    links = links.withColumns({"first": F.col("a").cast("long"), "last": F.col("b").cast("long")}).filter("first <= last").drop("a", "b")
    # 256-line bins keep the join an equi-join however long the file is
    bins = F.sequence(F.floor(F.col("first") / 256), F.floor(F.col("last") / 256))
    spans = links.withColumn("_bin", F.explode(bins))
    rows = spans.join(sources.withColumn("_bin", F.floor(F.col("line_no") / 256)), ["repo", "sha", "path", "_bin"])
    rows = rows.filter(F.col("line_no").between(F.col("first"), F.col("last")))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return rows.groupBy(key, "link_no", "link").agg(F.array_join(F.transform(ordered, lambda r: r["line"]), "\n").alias("excerpt"))
