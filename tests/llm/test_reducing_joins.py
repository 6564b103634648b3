"""Reducing joins against Spark's plain ones, dropping stages on clashing names, bags of subwords."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from creascope.llm import exact_dedup, minhash_dedup, prefilter, toxicity


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(i % 500 if i % 97 else None, f"text {i}", i, None) for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, _likely string, _slot long, _word string")


@pytest.mark.parametrize("n_ids", [0, 1, 40, 700])
@pytest.mark.parametrize("bits", [6, 26])  # 6: a full bit set, every row reaches the exact join
def test_reducing_joins(spark, wide, n_ids, bits, monkeypatch):
    monkeypatch.setattr(prefilter, "MAX_BITS", bits)
    ids = spark.createDataFrame([(3 * i if i else None,) for i in range(n_ids)], "id long")
    known = {r["id"] for r in ids.collect()}
    rows = Counter(wide.collect())
    few, rest = prefilter.only(wide, ids, "doc_id"), prefilter.without(wide, ids, "doc_id")
    assert few.columns == rest.columns == wide.columns
    assert Counter(few.collect()) == Counter({r: n for r, n in rows.items() if r["doc_id"] in known})
    assert Counter(rest.collect()) == Counter({r: n for r, n in rows.items() if r["doc_id"] not in known})
    maybe = Counter(prefilter.likely(wide, ids, "doc_id").collect())
    assert not Counter(few.collect()) - maybe
    if bits == 26 and n_ids == 40:
        assert sum(maybe.values()) < sum(Counter(few.collect()).values()) + 0.15 * sum(rows.values())


def test_wide_rows_are_not_shuffled(spark, wide):
    plan = prefilter.likely(wide, spark.range(50).toDF("id"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_dropping_with_clashing_names(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, 0), (2, base, 1), (3, base + " end", 2), (4, None, 3), (5, "", 4), (None, base, 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _id long").withColumns(
        {"_dropped": docs_null(), "n": docs_null(), "kept": docs_null()})
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and left.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert sorted(r["_id"] for r in left.collect()) == [1, 2, 4, 5]
    near = minhash_dedup.drop_near_duplicates(docs, percent=80)
    assert near.columns == docs.columns
    assert sorted(r["_id"] for r in near.collect()) == [0, 3, 4, 5]
    assert minhash_dedup.drop_near_duplicates(docs.limit(0)).count() == 0


def docs_null():
    from pyspark.sql import functions as F
    return F.lit(None).cast("string")


def test_bags_round_trip():
    texts = ["one two two three", "", None, "x y " * 9000 + "y" * 50000]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(4)), pa.array([0, 1, 0, 1], pa.int32()), pa.array(texts)], names=["id", "label", "text"])
    ids, counts, bounds, lengths = toxicity.unpack(pa.Table.from_batches(toxicity.bags(iter([rows]))))
    assert len(bounds) == 5 and bounds[1] == bounds[2] == bounds[3] and list(lengths[1:3]) == [0, 0]
    for lo, hi, n in zip(bounds[:-1], bounds[1:], lengths):
        assert (np.diff(ids[lo:hi]) > 0).all()
        assert counts[lo:hi].sum(dtype=np.int64) == n
