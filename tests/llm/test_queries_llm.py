import duckdb
import pytest

from racestream.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    a = sorted([tuple(r[c] for c in want.columns) for r in got.collect()], key=str)
    assert a == sorted(want.fetchall(), key=str)


def test_sharding_columns(spark):
    import zlib

    rows = QUERIES["op10_sharding"](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    for r in rows:
        b = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(b) + 16, zlib.crc32(b))
