"""The report and the step runner."""

import json

import pytest

from pedalmill.plans import report
from pedalmill.run import step

DATA = "/root/testdata/sf0.001"


def test_report(spark, tmp_path):
    made = report.build(spark, DATA, "bi", rows=4)
    assert list(made) == list(report.BRANCHES["bi"]) and all(len(s["rows"]) <= 4 for s in made.values())
    assert report.issues(made) == [] and report.issues({"x": {"title": "x", "columns": ["a"], "rows": []}}) == ["x: no rows"]
    short = report.context_json(made, 2000)
    assert len(short) <= 2000 and set(json.loads(short)) == set(made)
    assert len(report.context_json(made, 100)) <= 100
    paths = report.write(made, str(tmp_path))
    assert [p.rsplit(".", 1)[1] for p in paths] == ["md", "html", "json"]
    assert "## Product groups" in (tmp_path / "report.md").read_text(encoding="utf-8")
    assert report.page({"x": {"title": "<b>", "columns": ["a"], "rows": [["<i>"], [None], [1234]]}}).count("&lt;") == 2


def test_steps():
    assert step("a", lambda: 3)["result"] == 3 and step("a", lambda: 1 / 0, dry_run=True)["status"] == "SKIPPED"
    assert step("a", lambda: 1 / 0, go_on=True)["status"] == "FAILED"
    with pytest.raises(ZeroDivisionError):
        step("a", lambda: 1 / 0)
