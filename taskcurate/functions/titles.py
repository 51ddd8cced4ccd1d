"""Titles, bodies, messages and the issue references in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import strip

# Words that mark an issue as resolved.
RESOLVING_WORDS = ("close", "closes", "closed", "fix", "fixes", "fixed", "resolve", "resolves", "resolved")

# Fixed value: a title that announces a code change.
CODE_CHANGE_TITLE = r"(?i)(?:^|\W)(?:fix(?:e[sd])?|bug|patch|hotfix|bugfix|feat|refactor|add|support|update|improvement)\b"

# Parts of a pull request body that give the solution away or are template text.
_SOLUTION = r"(?is)(?:^|\n)#+\s*(?:what changed\??|solution|implementation|changes made|how)\s*\n.*?(?=\n#+\s|\z)"
_TEMPLATE = (
    r"(?ims)^#{1,3}\s*(?:Checklist(?:\s+for\s+PR)?|Must Do|Related Issues?|Screenshots?|Type of Change)\s*$"
    r".*?(?=\n#{1,3}\s(?!#)|\z)"
)


def is_code_change(title: Column) -> Column:
    return F.coalesce(title, F.lit("")).rlike(CODE_CHANGE_TITLE)


def without_html_comments(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<!--.*?-->", "")


def references(text: Column) -> Column:
    """Array of (word, issue) pairs such as ``fixes #12``, in text order."""
    clean = without_html_comments(text)
    pattern = F.lit(r"(?U)(\w+)\s+#(\d+)")
    return F.arrays_zip(
        F.regexp_extract_all(clean, pattern, 1).alias("word"), F.regexp_extract_all(clean, pattern, 2).alias("issue")
    )


def resolved_issues(text: Column) -> Column:
    hits = F.filter(references(text), lambda r: F.lower(r["word"]).isin(*RESOLVING_WORDS))
    return F.transform(hits, lambda r: r["issue"])


def last_issue_per_word(text: Column) -> Column:
    """Variant: each spelling of a keyword keeps only the last number it is followed by."""
    refs = F.filter(references(text), lambda r: F.lower(r["word"]).isin(*RESOLVING_WORDS))
    words = F.array_distinct(F.transform(refs, lambda r: r["word"]))
    return F.transform(words, lambda w: F.element_at(F.filter(refs, lambda r: r["word"] == w), -1)["issue"])


def bare_references(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"#(\d+)"), 1)


def message_flags(message: Column) -> dict[str, Column]:
    m = F.lower(message)
    return {
        "is_bugfix": m.contains("fix") | m.contains("bug"),
        "is_feature": m.contains("feature") | m.contains("add"),
        "is_refactor": m.contains("refactor"),
    }


def statement_from_pull(title: Column, body: Column) -> Column:
    """Problem statement of a pull request without linked issue."""
    text = without_html_comments(F.coalesce(body, F.lit("")))
    text = F.regexp_replace(F.regexp_replace(text, _SOLUTION, ""), _TEMPLATE, "")
    text = strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), text))


def ticket_title(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\s+", " "))


def ticket_text(text: Column) -> Column:
    """Ticket body: blank lines out, four blanks to a tab, other runs of blanks to one."""
    text = F.regexp_replace(F.regexp_replace(text, r"\n+", "\n"), "    ", "\t")
    return strip(F.regexp_replace(text, " {2,}", " "))


# Accepted time formats, tried in this order.
TIME_FORMATS = ("M/d/yy H:m:s", "MMM d, yyyy, h:m:s a", "MMM d, yyyy, H:m:s")


def to_time(text: Column) -> Column:
    """First of three formats that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS])


def to_time_with_offset(text: Column) -> Column:
    """``Tue Mar 05 10:00:00 2024 +0100``; the weekday is not needed."""
    return F.try_to_timestamp(F.regexp_replace(text, r"^\w{3} ", ""), F.lit("MMM d HH:mm:ss yyyy Z"))
