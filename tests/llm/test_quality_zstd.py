"""Compression classifier: held-out accuracy on the tables, sizes against a
plain computation, folds, edge cases."""
import random
import zlib

import numpy as np
import zstandard

from llm_help import SF001, SF01, as_list, edge_docs, empty_docs, prose  # noqa: F401
from tessera.llm import quality_zstd as Q

SF1 = "/root/testdata/sf0.1"


def ranks_auc(score, label):
    order = np.argsort(score, kind="mergesort")
    s, y = np.asarray(score)[order], np.asarray(label)[order]
    rank = np.empty(len(s))
    for v in np.unique(s):
        at = s == v
        rank[at] = np.flatnonzero(at).mean() + 1
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.judge(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert ranks_auc(got["score"], got["quality"]) > 0.97
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert got[got["quality"] == 1]["predicted"].mean() > 0.98  # good documents stay
    assert got[got["quality"] == 0]["predicted"].mean() < 0.4


def test_score_is_the_curve_of_the_plain_sizes(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    fitted = Q.fit(docs, labels)
    dicts = [zstandard.ZstdCompressionDict(*[d[0]], dict_type=d[1]) for d in fitted["dictionaries"]]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, score in as_list(Q.score(docs, fitted), "doc_id", "score")[:200]:
        data = text[doc_id].encode()
        sizes = [sum(len(zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=False, write_content_size=False,
                                                  write_dict_id=False).compress(data[i:i + 512]))
                     for i in range(0, len(data), 512)) for d in dicts]
        x = (sizes[0] - sizes[1]) / len(data)
        assert abs(score - 1 / (1 + np.exp(-(fitted["curve"][0] + fitted["curve"][1] * x)))) < 1e-9


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "toxic", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, "
                               "1 - quality, quality) as quality")
    a, b = (as_list(Q.judge(docs, x), "doc_id", "held_out", "score", "predicted") for x in (labels, turned))
    assert a == b and {h for _, h, _, _ in a} == {True, False}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h, _, _ in a)


def test_edges(spark, edge_docs, empty_docs):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = Q.judge(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.judge(empty_docs, labels).count() == 0
    none = spark.createDataFrame([], labels.schema)
    assert {r["score"] for r in Q.judge(edge_docs, none).collect()} == {0.5}


def test_nulls_ties_and_one_class_in_labels(spark):
    rnd = random.Random(5)
    rows = [(i, prose(rnd, 40)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = spark.createDataFrame([(i, 1) for i in range(60)] + [(3, None), (None, 0), (4, 1)], "doc_id long, quality int")
    assert {r["score"] for r in Q.judge(docs, one).collect()} == {1.0}


def test_pieces_are_the_whole_text_and_small_samples_train():
    text = "héllo \U0001F600 " * 500
    assert b"".join(Q.pieces(text)) == text.encode() and Q.pieces(None) == [] == Q.pieces("")
    assert Q.train([]) is None and Q.train([b"ab"]) is None
    assert Q._kept(Q.train([b"x" * 70]))[0] == b"x" * 70
