"""Where named queries and their reference SQL are kept."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noteflow.plans.views import VIEWS
from noteflow.sources.adapters import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def with_views(body: str) -> str:
    """Prepend the views that the SQL names as ``@view``, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"@(\w+)", text):
            if name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    strip = lambda text: re.sub(r"@(\w+)", r"\1", text)
    if not needed:
        return body
    head = "WITH RECURSIVE " if "RECURSIVE" in body else "WITH "
    body = body.replace("RECURSIVE", "", 1)
    # A recursion reads its views once for each step.
    once = "MATERIALIZED " if "RECURSIVE" in head else ""
    ctes = ",\n".join(f"{n} AS {once}({strip(VIEWS[n]).strip()})" for n in needed)
    body = strip(body).strip()
    if body.upper().startswith("WITH "):
        return f"{head}{ctes},\n{body[5:]}"
    return f"{head}{ctes}\n{body}"


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its reference SQL if there is one."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return wrap
