"""Queries written in SQL only, over the functions of ``functions.sql``."""

from __future__ import annotations

from ..functions import sql
from .registry import query
from .views import Views


def _tables(v: Views, **frames):
    sql.register(v.spark)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return v.spark


@query("x11_exit_code", "SELECT l_orderkey AS instance, pos, CASE WHEN l_tax > 0.02 THEN cast(l_quantity AS int) % 2 END::BIGINT AS code FROM v_items")
def exit_code(v: Views):
    return _tables(v, task_logs=v.logs()).sql("SELECT instance, pos, task_exit_code(log) AS code FROM task_logs")


@query("d05_results_of_logs", "SELECT instance, pos, i::INT AS place, test_id, status FROM v_log_lines")
def results_of_logs(v: Views):
    return _tables(v, task_logs=v.logs()).sql("SELECT l.instance, l.pos, r.place, r.test_id, r.status FROM task_logs l, LATERAL task_log_results(l.log) r")


@query("d05b_files_of_patches", "SELECT number, pos, file_no::INT AS file_no, path FROM v_files WHERE path LIKE '%.py'")
def files_of_patches(v: Views):
    return _tables(v, task_patches=v.patches()).sql("SELECT p.number, p.pos, f.file_no, f.path FROM task_patches p, LATERAL task_patch_files(p.patch) f WHERE task_is_python_file(f.path)")


@query("d05c_decomposed", """
WITH n AS (SELECT *, count(*) OVER (PARTITION BY number) AS n FROM v_wide)
SELECT number, CASE WHEN n > 6 THEN (file_pos - 1) // 4 END AS group_no, string_agg(path, ',' ORDER BY file_pos) AS files FROM n GROUP BY ALL""")
def decomposed(v: Views):
    return _tables(v, task_files=v.wide()).sql("""
        SELECT w.number, g.group_no, array_join(g.files, ',') AS files
        FROM (SELECT number, transform(array_sort(collect_list(struct(file_pos, path))), f -> f.path) AS files FROM task_files GROUP BY number) w, LATERAL task_groups(w.files, 6, 4) g""")


@query("d01b_sql_predicate", "SELECT number, pos FROM v_commits WHERE n_parents = 1 AND (message LIKE 'Fixes #%' OR message = 'add feature')")
def predicate(v: Views):
    spark = _tables(v, task_commits=v.commits())
    sql.register_predicate(spark, "task_keep_commit", "n_parents INT, message STRING", r"n_parents = 1 AND (message RLIKE '^Fixes #\\d' OR message = 'add feature')")
    return spark.sql("SELECT number, pos FROM task_commits WHERE task_keep_commit(n_parents, message)")
