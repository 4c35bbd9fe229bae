"""The report: small collected results as a plain dict, as Markdown and as HTML."""

from __future__ import annotations

import html
import json
import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pedalmill.plans import bi, forecast, scoring

#: Rows of a section at most; the report is for reading.
SECTION_ROWS = 12

SECTIONS: dict[str, tuple[str, Callable[[SparkSession, str], DataFrame]]] = {
    "kpis": ("Operational KPIs", bi.bi_operational_kpis),
    "signals": ("Signals", bi.report_signals),
    "products": ("Product groups", bi.bi_product_analysis),
    "places": ("Places", bi.bi_geo_analysis),
    "customers": ("Customers", bi.bi_customer_rfm),
    "forecast": ("Forecast by month", forecast.forecast_monthly),
    "groups": ("Forecast by group", forecast.forecast_group),
    "colors": ("Rising colours", forecast.rising_colors),
    "risk": ("Customers at risk", scoring.churn_priority),
}
BRANCHES = {"bi": ("kpis", "signals", "products", "places", "customers"), "predict": ("forecast", "groups", "colors", "risk"), "all": tuple(SECTIONS)}


def build(spark: SparkSession, d: str, branch: str = "all", rows: int = SECTION_ROWS) -> dict:
    """{section: {title, columns, rows}} of a branch: bi, predict or all."""
    out = {}
    for name in BRANCHES[branch]:
        title, query = SECTIONS[name]
        df = query(spark, d)
        out[name] = {"title": title, "columns": df.columns, "rows": [list(r) for r in df.limit(rows).collect()]}
    return out


def context_json(report: dict, most: int = 12_000) -> str:
    """The report as JSON of at most ``most`` characters: rows are left out from the longest sections first,
    then sections from the last on."""
    cut = {k: {**v, "rows": list(v["rows"])} for k, v in report.items()}
    while len(text := json.dumps(cut, ensure_ascii=False, default=str)) > most:
        longest = max(cut.values(), key=lambda s: len(s["rows"]), default=None)
        if longest is None:
            break
        if longest["rows"]:
            longest["rows"].pop()
        else:
            cut.popitem()
    return text


def issues(report: dict) -> list[str]:
    """What a reader would miss: sections without rows, rows without any figure."""
    found = [f"{k}: no rows" for k, v in report.items() if not v["rows"]]
    return found + [f"{k}: no figures" for k, v in report.items() if v["rows"] and not any(isinstance(x, (int, float)) for r in v["rows"] for x in r)]


def cell(value: object) -> str:
    if value is None:
        return "-"
    if isinstance(value, float):
        return f"{value:,.4f}" if abs(value) < 10 else f"{value:,.0f}"
    return f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else str(value)


def markdown(report: dict) -> str:
    parts = []
    for s in report.values():
        head = [f"## {s['title']}", "", "| " + " | ".join(s["columns"]) + " |", "|" + "---|" * len(s["columns"])]
        parts.append("\n".join(head + ["| " + " | ".join(cell(x).replace("|", "\\|") for x in r) + " |" for r in s["rows"]]))
    return "\n\n".join(parts) + "\n"


def page(report: dict) -> str:
    e = html.escape
    tables = [
        f"<h2>{e(s['title'])}</h2><table><tr>{''.join(f'<th>{e(c)}</th>' for c in s['columns'])}</tr>"
        + "".join(f"<tr>{''.join(f'<td>{e(cell(x))}</td>' for x in r)}</tr>" for r in s["rows"])
        + "</table>"
        for s in report.values()
    ]
    return '<!doctype html><meta charset="utf-8"><title>Sales report</title>' + "".join(tables)


def write(report: dict, folder: str, name: str = "report") -> list[str]:
    """The report as name.md, name.html and name.json in ``folder``, each put in place whole."""
    os.makedirs(folder, exist_ok=True)
    out = []
    for suffix, text in ((".md", markdown(report)), (".html", page(report)), (".json", json.dumps(report, ensure_ascii=False, default=str))):
        fd, part = tempfile.mkstemp(dir=folder)
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(part, path := os.path.join(folder, name + suffix))
        out.append(path)
    return out
