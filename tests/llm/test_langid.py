import zlib

from pyspark.sql import functions as F

from recolib.llm import langid
from recolib.llm.queries import op1_language_id
from tests.llm.edge import edge_frame, edge_rows, empty_frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = op1_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    r = (out.join(docs, "doc_id").where("held_out")
         .agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first())
    assert r.n > 200 and r.right / r.n > 0.98


def test_edge_rows(spark):
    got = langid.language_ids(edge_frame(spark)).collect()
    assert len(got) == len(edge_rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for d in (0, 1, 2, 12):
        assert (by_id[d].lang_pred, by_id[d].score) == ("und", 0.0)
    assert by_id[10].lang_pred == "de" and by_id[6].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)
    for r in got:
        key = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.held_out == (zlib.crc32(key) % 4 == 2)


def test_empty_and_unlabelled(spark):
    assert langid.language_ids(empty_frame(spark)).count() == 0
    d = edge_frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.language_ids(d).collect()} == {("und", 0.0)}


def test_matrix_equals_brute_force(spark):
    import numpy as np

    rows = [("abc ab", "x"), ("bcd", "y"), ("abab", "x"), (None, "x"), ("zz", None)]
    langs, model = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert langs == ["x", "y"]
    for k, lang in enumerate(langs):
        n = np.zeros(langid.CELLS)
        for t, own in rows:
            if own == lang and t is not None:
                np.add.at(n, langid.cells(t), 1)
        want = np.log(n + langid.SMOOTHING) - np.log((n + langid.SMOOTHING).sum())
        assert np.allclose(model[:-1, k], want, atol=1e-5)
    assert np.allclose(np.exp(model[-1]), [2 / 3, 1 / 3])
