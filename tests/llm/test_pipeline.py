"""Pipeline stages on hard tables, near-dedup of documents that share an id, secrets in long texts, and BPE in groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from edilake.llm import bpe, minhash, secrets
from edilake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_hard_tables(spark, hard, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    clashing = hard.withColumnsRenamed({"digest": "spans", "fp": "text_key", "word": "lang_pred", "key": "label", "run": "ids", "pos": "__key"})
    got = stage(spark, clashing, SF)
    rows = got.collect()
    if name != "bpe":
        assert got.columns == clashing.columns
    else:
        assert len(rows) == clashing.count() and all(r.round_trip for r in rows)
    assert stage(spark, none, SF).count() == 0


def test_one_id_and_several_texts(make):
    near = " ".join(f"w{i}" for i in range(60))
    rows = make([(1, near), (1, "quite another text with more than five words in it"), (2, near + " x"), (1, None), (1, ""), (2, near), (1, near),
                 (None, near), (3, "unique words that nobody else has written down here")])
    kept = sorted(((r.doc_id, r.text) for r in minhash.keep_one(rows).collect()), key=str)
    assert kept == sorted([(1, near), (1, "quite another text with more than five words in it"), (1, None), (1, ""), (None, near),
                           (3, "unique words that nobody else has written down here")], key=str)


def test_places_of_many_findings(make):
    rng = np.random.default_rng(5)
    text = " ".join("key é= " + "".join(rng.choice(list("abcdef0123456789"), 20)) + " plain" for _ in range(3000))
    found = secrets.findings(make([(1, text)]), []).collect()
    starts = sorted(r.start for r in found)
    assert len(found) == 3000 and starts[0] == 7 and set(np.diff(starts)) == {34}


def test_groups_and_forgetting(spark, monkeypatch):
    """Cut into small groups and with a cache of a few words, the ids are the same."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    want = {r.doc_id: r.ids for r in bpe.encode(docs, tokenizer_path()).collect()}
    coder = bpe.Bpe(tokenizer_path())
    monkeypatch.setattr(bpe, "CACHED_BYTES", 20_000)
    for r in docs.limit(20).collect():
        assert coder.encode(r.text) == want[r.doc_id] and coder.cached <= 20_000
    monkeypatch.setattr(bpe, "GROUP_BYTES", 500)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 3)
    for r in docs.limit(20).collect():
        assert coder.encode(r.text) == want[r.doc_id]
    both = bpe.round_trip(docs, tokenizer_path())
    assert both.columns == ["doc_id", "text", "lang", "ids", "decoded"]
    assert both.where(F.col("decoded") != F.col("text")).isEmpty() and {r.doc_id: r.ids for r in both.collect()} == want
