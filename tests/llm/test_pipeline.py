import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cabmill.llm import common, jaccard_join, toxicity
from tests.llm.test_jaccard_join import brute_force
from tests.llm.test_secret_scan import base_spans


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "n-gram Jaccard join", "secret scans", "packing"]
    clean = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.toxicity_scores(docs, labels).where("predicted = 1").collect()}
    kept = clean.collect()
    assert {r.doc_id for r in docs.collect()} - rejected == {r.doc_id for r in kept}

    rows = [(r.doc_id, r.text) for r in kept]
    stays = {d for d, _, c in brute_force(rows) if c == d}
    single = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(kept, docs.schema), sf_dir)
    assert single.columns == docs.columns
    left = single.collect()
    assert Counter(r.doc_id for r in left) == Counter(stays)

    blank = corpus_pipeline.blank_secrets(spark, spark.createDataFrame(left, docs.schema), sf_dir)
    assert blank.columns == docs.columns and blank.dtypes == docs.dtypes
    text = {r.doc_id: r.text for r in left}
    found = 0
    for r in blank.collect():
        spans = base_spans(text[r.doc_id])
        found += bool(spans)
        assert (r.text == text[r.doc_id]) == (not spans) and len(r.text) == r.n_chars
        assert not base_spans(r.text)
    assert found


def test_near_copies_with_repeated_and_missing_ids(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, t), (2, t), (1, t), (None, t), (3, ""), (4, None), (4, None), (5, "x")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert got == Counter({(1, t): 1, (None, t): 1, (3, ""): 1, (4, None): 1, (5, "x"): 1})


def test_near_copies_are_decided_by_row(spark):
    words = [f"w{i}" for i in range(40)]
    t, near, other = " ".join(words), " ".join([*words[:-1], "x"]), "a quite different text of more than five words"
    rows = [(1, t), (2, near), (2, other), (3, other + " one"), (3, other + " two"), (5, "z " + t), (5, "y " + t),
            (None, t), (None, near), (None, other), (None, ""), (None, ""), (6, " "), (6, " "), (6, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    named = [r for r in got.elements() if r[0] is not None]
    assert sorted(named) == sorted([(1, t), (2, other), (6, " "), (6, "")])
    nameless = Counter(text for i, text in got.elements() if i is None)
    assert nameless[""] == 2 and nameless[other] == 1 and nameless[t] + nameless[near] == 1


def test_run_packs_what_is_left(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = docs
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, sf_dir)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = stage.collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in rows}
    for r in rows[:40]:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted((p for p in got if p.doc_id == r.doc_id), key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_toxicity_stage_holds_a_text_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plan = corpus_pipeline.drop_toxic(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
    sent = next(line for line in plan.splitlines() if "MapInArrow" in line)
    assert sent.count("text#") == 2  # one in, one out

    words = common.kept(("word_bpe", "x"), lambda: {"a": b"a"})
    assert common.kept(("word_bpe", "x"), dict) is words
    rows = docs.select("doc_id", "text").toPandas()
    batch = pa.RecordBatch.from_pandas(pd.concat([rows] * 3, ignore_index=True), preserve_index=False)
    out = list(toxicity._scored(SimpleNamespace(value=model), 1, True)(iter([batch, batch.slice(0, 0)])))
    assert not common._KEPT
    assert max(b.num_rows for b in out) <= 256 < batch.num_rows
    whole = pa.Table.from_batches(out)
    assert whole.select(["doc_id", "text"]).equals(pa.Table.from_batches([batch]))
    assert np.array_equal(whole["score"].to_numpy(), model.score(batch.column(1).to_pylist()))


def test_texts_reach_workers_in_small_batches(spark, sf_dir, monkeypatch):
    rows, seen, write = common._BATCH_ROWS, [], common.Work.write
    before = spark.conf.get(rows)
    count = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    with common.small_batches(spark):
        sent = spark.range(0, 3000, 1, 1).mapInArrow(count, "n long").collect()
    assert sorted(r.n for r in sent) == [952, 1024, 1024]
    spark.conf.set(rows, "100")
    with common.small_batches(spark):
        assert spark.conf.get(rows) == "100"
    spark.conf.set(rows, before)

    def noted(work, frame, keep=False):
        seen.append(spark.conf.get(rows))
        return write(work, frame, keep)

    monkeypatch.setattr(common.Work, "write", noted)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    corpus_pipeline.pack(spark, docs, sf_dir)
    assert seen == ["1024"]
    corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert seen.count("1024") >= 5  # profiles, prefixes and the sets of both checks too
    assert spark.conf.get(rows) == before


def test_toxicity_tasks_let_words_and_near_copies_let_other_words_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", "and others"]})
    first = [b.to_pylist() for b in toxicity._scored(SimpleNamespace(value=model), 1, True)(iter([batch]))]
    assert not model.features._code
    assert [b.to_pylist() for b in toxicity._scored(SimpleNamespace(value=model), 1, True)(iter([batch]))] == first
    common.kept(("word_bpe", "x"), dict)
    texts = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary())], ["doc_id", "text"])
    assert len(list(jaccard_join._profiles(5)(iter([texts])))) == 2
    assert not common._KEPT
