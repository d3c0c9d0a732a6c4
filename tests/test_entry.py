import re

import pytest

SF = "/root/testdata/sf0.001"


def test_catalogue_and_sql_fit():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(re.fullmatch(r"[a-z0-9_]+", k) for k in e.queries())


@pytest.mark.parametrize("name", ["manifest_dedup_keep_first", "manifest_row_index", "queue_claim", "quality_first_reason", "lang_score", "url_filter", "rep_top_ngrams", "rep_dup_ngrams", "redact_addresses", "html_extract_text", "repair_text", "symbol_lines", "minhash_clusters", "queue_upsert_crawl", "queue_mark_done", "pipeline_reasons"])
def test_against_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import os

    import __spark_entry__ as e

    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    got = e.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({e.oracle_sql()[name]})").fetchall()

    def plain(rows):
        return sorted(tuple(str(round(v, 6) + 0.0) if isinstance(v, float) else str(v).split("+")[0] for v in r) for r in rows)

    assert plain(map(tuple, got.select(*cols).collect())) == plain(want)
