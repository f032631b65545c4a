import html

import pytest

import __spark_entry__ as entry
from outlyne.plans import queries

from .twins import SF, compare


@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_twin(spark, name):
    compare(spark, name, queries.QUERIES[name], queries.TWINS[name])


def test_x18_whole_text(spark):
    long = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) > 80").select("doc_id", "text")
    got = queries.QUERIES["x18_html"](spark, SF).join(long, "doc_id").collect()
    assert got
    for r in got:
        assert html.unescape(r["html"].replace('<span class="burst">', "").replace("</span>", "")) == f"({r['text']})"


def test_without_twin(spark):
    for name in sorted(set(queries.QUERIES) - set(queries.TWINS)):
        assert queries.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity_id", "template", "text"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
