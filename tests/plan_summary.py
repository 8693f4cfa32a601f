"""Physical plan summaries from ``DataFrame.explain("formatted")``.

Used by the plan-shape tests and when reviewing a query: which tables are
scanned with which columns and pushed filters, how many shuffles and
broadcasts the plan has, and which columns each shuffle carries.
"""
from __future__ import annotations

import contextlib
import dataclasses
import io
import re

from pyspark.sql import DataFrame


@dataclasses.dataclass
class Node:
    id: int
    name: str
    details: dict


def formatted(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def nodes(df: DataFrame) -> list[Node]:
    text = formatted(df)
    out = []
    for block in re.split(r"\n(?=\(\d+\) )", text):
        m = re.match(r"\((\d+)\) ([^\n]+)\n(.*)", block, re.S)
        if not m:
            continue
        details = {}
        for line in m.group(3).splitlines():
            k, sep, v = line.partition(": ")
            if sep:
                details[re.sub(r" \[\d+\]$", "", k.strip())] = v.strip()
        out.append(Node(int(m.group(1)), m.group(2).strip(), details))
    return out


def _cols(text: str) -> list[str]:
    return re.findall(r"(\w+)#\d+", text or "")


def summary(df: DataFrame) -> dict:
    """{'scans': [(table, columns, pushed filters)], 'shuffles': [(partitioning, input columns)],
    'broadcasts': n, 'aggregates': [names]}"""
    scans, shuffles, aggs, broadcasts = [], [], [], 0
    for n in nodes(df):
        if n.name.startswith("Scan "):
            loc = re.search(r"/([\w.-]+?)(?:\.parquet)?\]", n.details.get("Location", ""))
            schema = re.findall(r"(\w+):", n.details.get("ReadSchema", ""))
            scans.append((loc.group(1) if loc else "?", schema, n.details.get("PushedFilters", "")))
        elif n.name.startswith("Exchange"):
            shuffles.append((n.details.get("Arguments", ""), _cols(n.details.get("Input", ""))))
        elif n.name.startswith("BroadcastExchange"):
            broadcasts += 1
        elif "Aggregate" in n.name:
            aggs.append((n.name, n.details.get("Functions", "")))
    return {"scans": scans, "shuffles": shuffles, "broadcasts": broadcasts, "aggregates": aggs}
