"""Functions that queries written in SQL can call.

They are plain SQL functions, so Spark puts their bodies into the plan of the
query that calls them: no Python, and nothing that the optimizer cannot see through.
Names begin with ``task_``; :func:`register` makes them known to a session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name -> (parameters, result, body). A result that begins with TABLE can be called in FROM, also LATERAL.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "task_exit_code": (
        "log STRING", "BIGINT",
        r"CAST(nullif(regexp_extract(log, '\\w+_EXIT_CODE=(\\d+)', 1), '') AS BIGINT)",
    ),
    "task_transition": (
        "pre BIGINT, post BIGINT", "STRING",
        "CASE WHEN pre IS NULL OR post IS NULL THEN 'ERROR' WHEN pre <> 0 AND post = 0 THEN 'FAIL2PASS' WHEN pre = 0 AND post = 0 THEN 'PASS2PASS' WHEN pre <> 0 THEN 'FAIL2FAIL' ELSE 'PASS2FAIL' END",
    ),
    "task_is_python_file": ("path STRING", "BOOLEAN", "endswith(path, '.py')"),
    "task_patch_files": (
        "patch STRING", "TABLE(file_no INT, path STRING, file_patch STRING)",
        r"""SELECT pos + 1, trim(element_at(split(substring_index(part, '\n', 1), ' b/'), -1)), part
            FROM (SELECT posexplode(filter(split(patch, '\n(?=diff --git a/)'), s -> startswith(s, 'diff --git a/'))) AS (pos, part))""",
    ),
    "task_log_results": (
        "log STRING", "TABLE(place INT, test_id STRING, status STRING)",
        r"""SELECT pos, regexp_extract(line, '^(\\S+::\\S+)\\s+(PASSED|FAILED|ERROR|SKIPPED)', 1), regexp_extract(line, '^(\\S+::\\S+)\\s+(PASSED|FAILED|ERROR|SKIPPED)', 2)
            FROM (SELECT posexplode(regexp_extract_all(log, '(?m)^\\S+::\\S+\\s+(?:PASSED|FAILED|ERROR|SKIPPED)', 0)) AS (pos, line))""",
    ),
    "task_groups": (
        "files ARRAY<STRING>, threshold INT, size INT", "TABLE(group_no BIGINT, files ARRAY<STRING>)",
        """SELECT g, CASE WHEN g IS NULL THEN files ELSE slice(files, CAST(g AS INT) * size + 1, size) END
           FROM (SELECT explode(CASE WHEN cardinality(files) > threshold THEN sequence(0L, (cardinality(files) - 1) DIV size) ELSE array(CAST(NULL AS BIGINT)) END) AS g)""",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in this session, for as long as it lives; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)


def register_predicate(spark: SparkSession, name: str, parameters: str, condition: str) -> None:
    """A row predicate of the user, given in SQL, as a function."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS BOOLEAN RETURN coalesce({condition}, false)")
