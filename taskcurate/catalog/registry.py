"""Collects queries and the SQL they are checked against."""

from __future__ import annotations

import importlib
import pkgutil
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import SQL_VIEWS, Views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

def query(name: str, oracle: str | None = None):
    """Register ``fn(views)`` under ``name``; ``oracle`` may use any ``v_`` view."""

    def wrap(fn: Callable[[Views], DataFrame]):
        assert name not in _QUERIES, name
        _QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if oracle is not None:
            _ORACLES[name] = with_views(oracle)
        return fn

    return wrap


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the fixture views it mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for v in dict.fromkeys(re.findall(r"\bv_\w+\b", text)):
            if v in SQL_VIEWS and v not in needed:
                visit(SQL_VIEWS[v])
                needed.append(v)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v].strip()})" for v in needed)
    body = sql.strip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def _load() -> None:
    package = importlib.import_module(__package__)
    for m in sorted(i.name for i in pkgutil.iter_modules(package.__path__)):
        importlib.import_module(f"{__package__}.{m}")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
