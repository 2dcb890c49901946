"""Reports for readers: the first rows of each group, rendered as Markdown or HTML on the driver."""

from __future__ import annotations

import html
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.relational import capped


def top_rows(df: DataFrame, group: str, order: Sequence[Column], per_group: int, at_most_groups: int = 200) -> list[dict]:
    """The rows a report shows: `per_group` of each of the `at_most_groups` largest groups, in order."""
    large = df.groupBy(group).count().orderBy(F.desc("count"), group).limit(at_most_groups)
    shown = capped(df.join(large.select(group), group, "left_semi"), [F.col(group)], order, per_group, "place")
    return [r.asDict() for r in shown.orderBy(group, "place").collect()]


def _cell(v: object) -> str:
    return str("" if v is None else v).replace("|", "\\|").replace("\n", " ")


def markdown(rows: list[dict], group: str, columns: Sequence[str], title: str) -> str:
    out = [f"# {title}", ""]
    last = object()
    for r in rows:
        if r[group] != last:
            last = r[group]
            out += [f"## {_cell(last) or 'none'}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
        out.append("| " + " | ".join(_cell(r[c]) for c in columns) + " |")
    return "\n".join(out) + "\n"


def page(rows: list[dict], group: str, columns: Sequence[str], title: str) -> str:
    esc = lambda v: html.escape(str("" if v is None else v))
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[group], []).append(r)
    nav = "".join(f'<a href="#g{i}">{esc(g)} ({len(v)})</a> ' for i, (g, v) in enumerate(groups.items()))
    body = "".join(
        f'<section id="g{i}"><h2>{esc(g)}</h2><table>' + "".join("<tr>" + "".join(f"<td>{esc(r[c])}</td>" for c in columns) + "</tr>" for r in v) + "</table></section>"
        for i, (g, v) in enumerate(groups.items())
    )
    return f'<!doctype html><html><head><meta charset="utf-8"><title>{esc(title)}</title></head><body><h1>{esc(title)}</h1><nav>{nav}</nav>{body}</body></html>'
