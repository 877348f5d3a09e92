"""The stages on a small table against plain versions, and the registered queries."""

import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests import compare
from tests.llm import brute
from wardstar.llm import packing, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_run(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    held = {}
    now = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        now = corpus_pipeline.stage(function(spark, now, FOLDER), "test")
        held[name] = now
    frames = list(held.values())
    assert all(f.columns == columns for f in frames[:-1])

    good = sorted(r["doc_id"] for r in frames[0].collect())
    texts = dict(docs)
    for doc in good:
        n, _, _, _, repeat = brute.quality(texts[doc])
        assert n >= 50 and 100 * repeat <= 50 * n
    label = brute.components([(i, texts[i]) for i in good])
    single = sorted(i for i, c in label.items() if c == i)
    assert sorted(r["doc_id"] for r in frames[1].collect()) == single
    clean = [i for i in single if not brute.hits(texts[i], items)[2]]
    assert sorted(r["doc_id"] for r in frames[2].collect()) == clean

    mixed = sorted(r["doc_id"] for r in frames[3].collect())
    assert set(mixed) <= set(clean) and max(mixed.count(i) for i in set(mixed)) <= 3
    tokenizer = packing._tokenizer(packing.tokenizer_path())
    at = 0
    out = sorted(frames[4].collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == mixed
    for r in out:
        ids = np.array([*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, packing.END_ID], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_quality_stage_keeps_labelled_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, FOLDER).collect()}
    for r in docs.collect():
        if r["doc_id"] in labels and brute.quality(r["text"])[0] >= 50:
            assert (r["doc_id"] in kept) == (labels[r["doc_id"]] == 1)


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    good, note = compare.compare(spark, compare.duck(FOLDER), FOLDER, name, queries.QUERIES[name], queries.SQL[name])
    assert good, note


def test_stages_leave_little_behind(spark):
    """Tables that a stage made on its way are deleted before its result is written."""
    from wardstar.session import run_dir

    folder = run_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    single = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    clean = corpus_pipeline.benchmark(spark, docs, FOLDER)
    assert sorted(name.split("-")[0] for name in set(os.listdir(folder)) - before) == ["contaminated", "gram"]
    assert single.columns == clean.columns == docs.columns and 0 < single.count() <= docs.count() >= clean.count() > 0


def test_shuffles_go_with_their_query(spark):
    from wardstar.session import _scratch, scratch, stage

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    corpus_pipeline.mix(spark, docs, FOLDER)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    with pytest.raises(ZeroDivisionError), scratch(spark) as keep:
        gone, kept = stage(spark.range(3), "gone"), keep(spark.range(4), "kept")
        with scratch(spark) as inner:
            also_gone = inner(spark.range(5), "inner")
        assert also_gone.count() == 5
        raise ZeroDivisionError
    assert kept.count() == 4 and _scratch.get() == ()
    with pytest.raises(Exception, match="exist"):
        gone.count()
