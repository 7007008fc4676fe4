"""Held-out accuracy of the trained models on the given tables, and the bounds of their samples."""

import numpy as np
from pyspark.sql import functions as F

from lonja.llm import language, quality
from lonja.llm.queries import op5_language, op9_quality

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = op5_language(spark, FOLDER).join(known, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 200 and np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98


def test_quality_of_held_out_documents(spark):
    known = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality IS NOT NULL").select("doc_id", "quality")
    rows = op9_quality(spark, FOLDER).join(known, "doc_id").where("held_out").collect()
    for label in (0, 1):
        mine = [r.predicted == label for r in rows if r.quality == label]
        assert len(mine) > 10 and np.mean(mine) >= 0.95


def test_dictionaries_are_filled_from_whole_texts(spark):
    """Short texts fill a dictionary too, a shared opening is not all that is learnt, and no language is left out."""
    rng = np.random.default_rng(3)
    words = {f"l{k}": ["".join(rng.choice(list("abcdefghijklm"), 7)) for _ in range(300)] for k in range(700)}
    docs = [(i, " ".join(rng.choice(words["l0"], 3)), "l0") for i in range(9000)]
    docs += [(10_000 + i, "licence " * 400 + " ".join(rng.choice(words["l1"], 900)), "l1") for i in range(400)]
    docs += [(20_000 + k, " ".join(words[f"l{k}"]), f"l{k}") for k in range(2, 700)]
    found = language.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    size = language.DICTIONARIES // 700
    assert len(found) == 700 and max(map(len, found.values())) <= size
    assert len(found["l0"]) == size and len(found["l1"]) == size
    assert found["l1"].count(b"licence") < size // 16


def test_sample_is_bounded_by_features(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i % 2}x{j}" for j in range(i % 7, 40)), i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int")
    every = quality._sample_features(frame.withColumn("turn", F.col("doc_id")), 18, 10**9)
    sizes = np.cumsum([len(x) for _, x in every])
    for most in (1, int(sizes[9]), int(sizes[9]) + 1, int(sizes[-1])):
        some = quality._sample_features(frame.withColumn("turn", F.col("doc_id")), 18, most)
        assert len(some) == max(1, int((sizes <= most).sum()))
