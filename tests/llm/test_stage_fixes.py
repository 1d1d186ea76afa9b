"""Pipeline stages on repeated and null ids, clashing column names and extreme ids."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from quotelake.llm import exact_dedup, quality_knn, simhash  # noqa: E402

A = " ".join(f"word{i % 37} token{i % 11} thing{i}" for i in range(120))
B = " ".join(f"other{i % 13} stuff{i % 7} piece{i}" for i in range(150))
CLASH = "doc_id long, text string, __row long, fp string, __kept string, __keep_id int, __size int, __id int, document int, __score int"


def _rows(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "x", "k", 2, 3, 4, 5, 6) for i, t in pairs], CLASH).repartition(3)


def test_near_dedup_keeps_one_row_per_group_with_repeated_ids(spark):
    docs = _rows(spark, [(3, A), (5, A.replace(" ", "  ")), (5, B)])
    kept = sorted((r.doc_id, r.text[:6]) for r in simhash.one_per_group(docs).collect())
    assert kept == [(3, A[:6]), (5, B[:6])]
    assert simhash.one_per_group(docs).columns == docs.columns


def test_near_dedup_with_null_ids(spark):
    docs = _rows(spark, [(3, A), (None, A + " "), (None, B), (None, B)])
    kept = sorted(((r.doc_id if r.doc_id is not None else -1), r.text[:6]) for r in simhash.one_per_group(docs).collect())
    assert kept == [(-1, B[:6]), (3, A[:6])]


def test_exact_dedup_with_clashing_names_and_extreme_ids(spark):
    least = -(2**63)
    docs = _rows(spark, [(least, A), (7, A.replace(" ", "\n")), (7, A), (None, B), (None, B), (8, "")])
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id if r.doc_id is not None else 0), r.text[:6]) for r in kept.collect())
    assert rows == [(least, A[:6]), (0, B[:6]), (8, "")]


def test_quality_stage_with_a_score_column(spark):
    docs = _rows(spark, [(i, (A if i % 2 else B) + f" n{i}") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    kept = quality_knn.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r["__score"] for r in kept.collect()} <= {6}
