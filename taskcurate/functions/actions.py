"""Action markup and model responses of agent runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import strip

_FUNCTION = r"<function\s*=\s*([^>]+)>"
_PARAMETER = r"(?s)<parameter\s*=\s*([^>]+)>(.*?)</parameter>"


def function_name(action: Column) -> Column:
    return strip(F.regexp_extract(action, _FUNCTION, 1))


def parameters(action: Column) -> Column:
    """Map of the parameters; of repeated ones the last value counts, at the first place."""
    keys = F.transform(F.regexp_extract_all(action, F.lit(_PARAMETER), 1), strip)
    values = F.transform(F.regexp_extract_all(action, F.lit(_PARAMETER), 2), strip)
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    names = F.array_distinct(keys)
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda p: p["k"] == n), -1)["v"]))


def parsed(action: Column) -> Column:
    return F.struct(function_name(action).alias("name"), parameters(action).alias("params"))


def to_markup(name: Column, params: Column) -> Column:
    body = F.transform(
        F.map_entries(params), lambda e: F.concat(F.lit("  <parameter="), e["key"], F.lit(">"), e["value"], F.lit("</parameter>\n"))
    )
    return F.concat(F.lit("<function="), name, F.lit(">\n"), F.array_join(body, ""), F.lit("</function>"))


def to_json(name: Column, params: Column) -> Column:
    return F.to_json(F.struct(name.alias("function"), params.alias("parameters")))


def shell_quote(text: Column) -> Column:
    safe = text.rlike(r"^[A-Za-z0-9_@%+=:,./-]+\z")
    return F.when(safe, text).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("'\"'\"'")), F.lit("'")))


def to_shell(name: Column, params: Column) -> Column:
    rest = F.filter(F.map_entries(params), lambda e: e["key"] != "command")
    words = F.concat(
        F.array_compact(F.array(shell_quote(name), shell_quote(F.get(F.map_values(F.map_filter(params, lambda k, _: k == "command")), F.lit(0))))),
        F.flatten(F.transform(rest, lambda e: F.array(F.concat(F.lit("--"), e["key"]), shell_quote(e["value"])))),
    )
    return (
        F.when(name == "", F.lit(""))
        .when(name.isin("finish", "submit"), F.lit("echo '<<<Finished>>>'"))
        .otherwise(F.array_join(words, " "))
    )


# -- responses ---------------------------------------------------------------------


def tagged_thought(response: Column) -> Column:
    """(thought, action): the first think block and the first function block."""
    return F.struct(
        strip(F.regexp_extract(response, r"(?s)(<think>.*?</think>)", 1)).alias("thought"),
        strip(F.regexp_extract(response, r"(?s)(<function=.*?</function>)", 1)).alias("action"),
    )


def leading_thought(response: Column) -> Column:
    """(thought, action): everything before the first function block, and the block."""
    action = F.regexp_extract(response, r"(?s)(<function=.*?</function>)", 1)
    before = F.regexp_extract(response, r"(?s)^(.*?)<function=.*?</function>", 1)
    return F.struct(strip(F.when(action == "", response).otherwise(before)).alias("thought"), strip(action).alias("action"))


def single_command(response: Column) -> Column:
    """(thought, command, error): exactly one bash block is allowed."""
    blocks = F.regexp_extract_all(response, F.lit(r"(?s)```bash\s*\n(.*?)\n```"), 1)
    one = F.size(blocks) == 1
    return F.struct(
        strip(F.when(one, F.substring_index(response, "```bash", 1)).otherwise(response)).alias("thought"),
        F.when(one, strip(F.get(blocks, F.lit(0)))).alias("command"),
        F.when(~one, F.concat(F.lit("expected one bash block, found "), F.size(blocks).cast("string"))).alias("error"),
    )


def exit_reason(done: Column, step: Column, tokens: Column, seconds: Column, max_steps: int = 40, max_absolute: int = 50,
                max_tokens: int = 65536, max_seconds: float = 5400.0) -> Column:
    """Why a run stopped after a step; null while it goes on."""
    left = F.lit(max_steps) - step
    return (
        F.when(done & (left > 0), "agent")
        .when(done & (left == 0), "max_step_limit")
        .when(done, "agent_max_step_limit")
        .when(tokens >= max_tokens, "token_limit")
        .when(step >= max_absolute, "abs_step_limit")
        .when(seconds >= max_seconds, "traj_time_limit")
    )
