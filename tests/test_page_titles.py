"""Titles equal the query's SQL on titles that are cut, quoted, repeated or missing."""

import duckdb

from marketlake import catalog


def test_titles_equal_their_sql(spark, tmp_path):
    pages = [
        "<title>a &quot;b&quot; &amp;amp; c</title>", "<title>cut &amp</title>", "<title> x\n\t y &#39;&#x27;&lt;&gt; &eacute; </title><title>z</title>",
        "<!-- <title>in a comment</title> --><title>t</title>", "<title>open", "<TITLE>big</TITLE>", "<p>none</p>", None, "<title>a <b>c</b></title>",
    ]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.sql(catalog.ORACLE_SQL["f08_page_title"]).fetchall())
    assert sorted(tuple(r) for r in catalog.QUERIES["f08_page_title"](spark, str(tmp_path)).collect()) == want and len(want) == 6
