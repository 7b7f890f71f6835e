import pytest

from passgrid.llm import prefilter
from passgrid.llm.prefilter import likely_in


@pytest.mark.parametrize("bits", [26, 7])
def test_no_row_with_a_key_is_lost(spark, monkeypatch, bits):
    monkeypatch.setattr(prefilter, "BITS", bits)
    rows = spark.range(2000).selectExpr("xxhash64(id) AS h", "id").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) h, 9999L id"))
    keys = rows.filter("id % 50 = 0").select("h")
    got = likely_in(rows, "h", keys, "h")
    assert got.columns == ["h", "id"]
    left = {r["id"] for r in got.collect()}
    assert {i for i in range(2000) if i % 50 == 0} <= left and 9999 not in left
    assert len(left) == 40 if bits == 26 else len(left) <= 2000
    assert likely_in(rows, "h", keys.limit(0), "h").count() == 0
