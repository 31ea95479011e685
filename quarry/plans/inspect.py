"""Plan inspection through the public ``DataFrame.explain`` output.

Used to check what Catalyst did with a query: how many Filter nodes survive,
which filters reached the scan (``PushedFilters``), which columns are read
(``ReadSchema``), whether a cached relation sits under the filter, and which
join / exchange operators were chosen.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def section(text: str, title: str) -> str:
    """One block of the extended explain output (e.g. 'Optimized Logical Plan')."""
    m = re.search(rf"== {re.escape(title)} ==\n(.*?)(?:\n== |\Z)", text, re.S)
    return m.group(1) if m else ""


def count_nodes(plan: str, node: str) -> int:
    return len(re.findall(rf"(?m)^[\s:+\-*!()0-9]*{re.escape(node)}\b", plan))


def pushed_filters(df: DataFrame) -> list[str]:
    """``PushedFilters`` lists of every file scan in the physical plan."""
    txt = plan_text(df, "formatted")
    return re.findall(r"PushedFilters: \[(.*?)\]", txt)


def read_schemas(df: DataFrame) -> list[str]:
    """``ReadSchema`` of every file scan (the columns actually read)."""
    return re.findall(r"ReadSchema: (struct<.*?>)", plan_text(df, "formatted"))


def operators(df: DataFrame) -> list[str]:
    """Physical operator names in the formatted plan, in print order."""
    txt = plan_text(df, "formatted")
    head = txt.split("\n\n(")[0]
    return re.findall(r"([A-Z][A-Za-z]+(?:Exec)?)(?: \(\d+\))", head)


def summary(df: DataFrame) -> dict:
    """Compact facts about a plan, for tests and the benchmark report."""
    ext = plan_text(df, "extended")
    opt = section(ext, "Optimized Logical Plan")
    phys = section(ext, "Physical Plan")
    return {
        "logical_filters": count_nodes(opt, "Filter"),
        "exchanges": len(re.findall(r"(?<!Broadcast)Exchange", phys)),
        "broadcast_joins": phys.count("BroadcastHashJoin"),
        "sort_merge_joins": phys.count("SortMergeJoin"),
        "python_udfs": phys.count("BatchEvalPython") + phys.count("ArrowEvalPython"),
        "in_memory_scans": phys.count("InMemoryTableScan"),
        "pushed_filters": pushed_filters(df),
    }
