"""Every registered query of the corpus operators against its SQL, or against what its contract says."""

import zlib

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from questlake.llm import queries
from questlake.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    found = contract.queries()
    assert {"pipeline", *QUERIES} <= set(found) and queries
    assert [sum(n.startswith(f"op{k}_") for n in found) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF).toArrow(), connect(SF).sql(SQL[name]).to_arrow_table()) == []


def test_quality_tells_held_out_rows_apart(spark):
    got = {r.doc_id: r for r in QUERIES["op6_quality"](spark, "/root/testdata/sf0.01").collect()}
    for doc, row in got.items():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    known = [(got[d].predicted, q) for d, q in labels if got[d].held_out]
    assert sum(p == q for p, q in known) >= 0.95 * len(known)


def test_mix_meets_its_targets(spark):
    rows = QUERIES["op8_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    texts = duckdb.sql("SELECT doc_id, source, text FROM '/root/testdata/sf0.01/documents.parquet'").df()
    rows = rows.merge(texts, on="doc_id")
    assert len(rows) == len(texts) and (rows["size"] == [len(t.encode().split()) for t in rows.text]).all()
    assert (rows.taken <= 2 * rows["size"]).all()
    by_source = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by_source.index))}
    goal, capped = 1.5 * by_source["size"].sum(), set()
    while True:
        free = [s for s in weights if s not in capped]
        level = (goal - sum(2 * by_source["size"][s] for s in capped)) / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * level > 2 * by_source["size"][s]}
        if not over:
            break
        capped |= over
    for s in weights:
        assert by_source.target[s] == pytest.approx(2 * by_source["size"][s] if s in capped else weights[s] * level)
        assert by_source.taken[s] == pytest.approx(by_source.target[s], rel=0.02)


def test_shards_hold_every_row_once(spark):
    rows = QUERIES["op9_sharding"](spark, SF).toPandas()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    assert sorted(rows.doc_id) == sorted(texts)
    counts = rows.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all() and (counts["nunique"] == counts["count"]).all()
    for row in rows.itertuples():
        data = texts[row.doc_id].encode()
        assert row.text_crc32 == zlib.crc32(data) and row.size == len(data) + 1
    assert rows.sort_values(["shard", "slot"]).doc_id.tolist() != sorted(texts)
