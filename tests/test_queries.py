"""Every core query against its SQL in DuckDB; queries without SQL must give rows."""

import duckdb
import pytest

from alluvium.plans import queries as Q

DIR = "/root/testdata/sf0.001"


def norm(rows):
    return sorted(tuple(repr(float(v)) if type(v).__name__ in ("Decimal", "float") else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, name):
    df = Q.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    if name not in Q.oracle_sql():
        assert rows
        return
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    rel = con.sql(Q.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    order = [rel.columns.index(c) for c in cols]
    assert norm(rows) == norm(tuple(r[i] for i in order) for r in rel.fetchall())


def test_pages_cut_within_a_reference(spark, tmp_path):
    rows = [(1, "u", "<title>a&amp</title><h1>b &lt;c&amp</h1><p>R&D &quot;x&quot; &#x27;y&#x27; &am"), (2, "u", "<h1>&amp;amp;</h1>&")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("pages_text", "page_titles"):
        rel = con.sql(Q.oracle_sql()[name])
        assert norm(Q.queries()[name](spark, str(tmp_path)).select(*rel.columns).collect()) == norm(rel.fetchall())


def test_pages_with_stray_end_tags_and_declarations(spark, tmp_path):
    """Strings on both sides of an end tag without a start, or of a declaration, are two; a comment doesn't part one."""
    rows = [(1, "u", "<p>a</i>b<!-- c -->d</p><?x y>e<!DOCTYPE z>f"), (2, "u", "<!DOCTYPE html><h1>a</h1>b</h1>c")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    rel = con.sql(Q.oracle_sql()["pages_text"])
    assert norm(Q.queries()["pages_text"](spark, str(tmp_path)).select(*rel.columns).collect()) == norm(rel.fetchall())
