"""Functions on texts see a few rows at a time, so what a worker holds does not grow with an Arrow batch."""

import pytest

from docquarry.plans import registry

TEXTS = [None, "", "# A\nb\n1. c\nd\n**e**\nf", "x " * 80, "## B\n\nword. " * 3]


@pytest.mark.parametrize("name", ["clean_single_passes", "space_ordered_lists", "space_around_headings", "space_around_bold", "toc_align", "pipes_to_csv", "tables_moved", "summaries_made", "pluggable_token_counts"])
def test_no_arrow_batch_of_texts(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = registry.queries()[name](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and not any(x in plan for x in ("ArrowEvalPython", "MapInPandas", "MapInArrow"))
    rows = out.collect()
    assert len(rows) == len(TEXTS) * len({r["pass"] for r in rows} if "pass" in out.columns else {name})


def test_one_pass_runs_no_other(spark, monkeypatch):
    from docquarry.operators import cleaning

    def fails(lines):
        raise AssertionError("another pass")

    fails.__name__ = "space_around_bold"
    monkeypatch.setattr(cleaning, "SINGLE", [fails if s.__name__ == fails.__name__ else s for s in cleaning.SINGLE])
    rows = cleaning.single_passes(spark.createDataFrame([(1, "a\n# B")], "doc_id long, text string"), names=["space_around_headings"]).collect()
    assert [(r["pass"], r.text) for r in rows] == [("space_around_headings", "a\n\n# B")]
