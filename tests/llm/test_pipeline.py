"""The pipeline's stages against plain versions, on documents written for it and on the smallest tables."""

import collections
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from eventloom.llm import catalog, fertility, order_minhash
from eventloom.llm.common import stage

SF = "/root/testdata/sf0.01"
TABLE = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_stage_does_its_part(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    words = fertility.vocabulary(catalog.PIECE_MODEL)
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, SF), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns and docs.dtypes == before.dtypes
        now, was = docs.collect(), before.collect()
        if name == "quality_rules":
            assert {r.doc_id for r in now} == {r.doc_id for r in was if fertility.judge(r.text, words, fertility.BANDS, 50, 50)[-1]}
        elif name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            ids = {r.doc_id for r in now}
            out = collections.Counter((labels.get(r.doc_id), r.doc_id in ids) for r in was)
            assert out[1, True] > 20 * out[1, False]
        elif name == "line_dedup":
            assert {r.doc_id for r in now} == {r.doc_id for r in was}
            texts = {r.doc_id: r.text for r in was}
            assert all(r.n_chars == len(r.text) and {*r.text.split("\n")} <= {*texts[r.doc_id].split("\n")} for r in now)
            assert sum(r.text != texts[r.doc_id] for r in now) > 5
        elif name == "near_duplicates":
            classes = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(before).collect()}
            assert sorted(r.doc_id for r in now) == sorted(set(classes.values())) and len(now) < len(was)
        else:
            model = Tokenizer.from_file(catalog.WORD_TOKENIZER)
            ids = {r.doc_id: [*model.encode(r.text, add_special_tokens=False).ids, 2] for r in was}
            assert sum(r.length for r in now) == sum(map(len, ids.values()))
            for r in now:
                own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
                assert r.ids == own and zlib.crc32(own) == r.ids_crc32
    run = corpus_pipeline.run(spark, SF).select("doc_id", "start", "ids_crc32")
    assert sorted(run.collect()) == sorted(kept["packing"].select("doc_id", "start", "ids_crc32").collect())


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, and an empty table."""
    rnd = random.Random(1)
    prose = " ".join("".join(rnd.choice("aeiounrstl") for _ in range(rnd.randint(2, 7))) for _ in range(400))
    rows = [(1, None, None, None, None), (None, prose, "en", "s", 3), (2, "", "en", "s", 0), (3, prose, None, "s", 3), (3, prose, None, "s", 3),
            (4, prose + " end", "en", None, 9), (5, prose.upper() + "\n" + "x" * 50_000, "en", "s", None)]
    docs = spark.createDataFrame(rows, TABLE)
    for start in (docs, docs.limit(0)):
        now = start
        for name, step in corpus_pipeline.STAGES:
            now = stage(step(spark, now, SF), name)
        assert (now.count() == 0) == start.isEmpty()
    left = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert collections.Counter(r.doc_id for r in left) == {1: 1, 2: 1, 3: 1}  # 5 differs from 3 in case and by one word


def test_kept_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame([(k, f"text {k // 2}", "en", "s", 6) for k in range(40)] * 2, TABLE)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = corpus_pipeline.near_duplicates(spark, docs, SF)
        assert "hashpartitioning(doc_id" not in left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in left.collect()) == list(range(0, 40, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
