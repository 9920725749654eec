"""Pairs that share a band are checked on their texts, whatever else their signatures have in common."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from ledgerloom.llm import near_dup


def test_a_pair_that_agrees_in_few_coordinates_is_linked(spark):
    rng = random.Random(12850)
    w = [f"w{rng.randint(0, 99999)}" for _ in range(41)]
    texts = [" ".join(w[:40]), " ".join([*w[:36], *w[40:], "v0", "v1", "v2"])]
    sig = near_dup.dart_signatures(*near_dup.elements(pa.array(texts, pa.large_string())), 2, 120)
    same = sig[0] == sig[1]
    assert same.sum() == 76 and same.reshape(24, 5).all(axis=1).any()
    assert np.isclose(near_dup.similarities(pa.array(texts[:1], pa.large_string()), pa.array(texts[1:], pa.large_string())), 0.8)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs).collect()} == {0: 0, 1: 0}


def test_versions_of_an_id_stay_apart(spark):
    """One id with unrelated texts: each text is compared and kept on its own."""
    rng = random.Random(4)
    a, b = (" ".join(f"w{rng.randint(0, 9999)}" for _ in range(80)) for _ in range(2))
    rows = [(1, a, 1), (1, b, 2), (2, a, 3), (3, b + " end", 4), (3, b + " end", 5), (4, "", 6), (4, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, node INT")
    got = near_dup.near_duplicates(docs).collect()
    keys = {r.class_key for r in got}
    assert len(keys) == 3 and None in keys and sorted((r.doc_id, r.class_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1), (4, 4), (4, 4)]
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(1, a), (1, b), (4, ""), (4, "")])
    again = near_dup.drop_near_duplicates(docs.where("doc_id = 3")).collect()
    assert len(again) == 1 and again[0].text == b + " end"


def test_chunks_of_a_bucket(spark, monkeypatch):
    """Buckets in more chunks than one give the same classes."""
    rng = random.Random(6)
    w = [f"w{rng.randint(0, 99999)}" for _ in range(200)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(w)))
        for _ in range(4):
            w[rng.randrange(200)] = f"n{rng.randint(0, 99999)}"
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    want = sorted((r.doc_id, r.class_id) for r in near_dup.near_duplicates(docs).collect())
    monkeypatch.setattr(near_dup, "CHUNK", 2)
    monkeypatch.setattr(near_dup, "CHUNK_BYTES", 4000)
    assert sorted((r.doc_id, r.class_id) for r in near_dup.near_duplicates(docs).collect()) == want
