"""Every catalogued query against its SQL over the smallest tables."""

import pytest
from oracle import SMALL, connect, rows

from ledgerloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, name):
    ours = catalog.QUERIES[name](spark, SMALL).toPandas()
    theirs = connect().execute(catalog.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) or name == "apply_decisions"  # the smallest tables have too few suppliers
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_partitions_do_not_matter(spark):
    before = rows(catalog.QUERIES["edge_chains"](spark, SMALL).toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert rows(catalog.QUERIES["edge_chains"](spark, SMALL).toPandas()) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pages_are_parsed_whole(spark, monkeypatch):
    seen, parse = [], catalog.P.pages_to_statements
    monkeypatch.setattr(catalog.P, "pages_to_statements", lambda pages, *a: seen.append(pages) or parse(pages, *a))
    assert catalog.QUERIES["pages_extract"](spark, SMALL).count() > 0
    whole = catalog.read_table(spark, SMALL, "pages").selectExpr("url", "html as page")
    assert seen[0].join(whole, "url").where("not endswith(html, page)").count() == 0
