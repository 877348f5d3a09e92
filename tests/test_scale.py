"""Work that must not grow faster than its input: what is read, held and written."""

import os
import random

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from tests.conftest import values
from wardstar import schemas
from wardstar.functions import chunks, fuzzy
from wardstar.llm import mixing
from wardstar.operators import calls, extract, loading
from wardstar.plans import standins, warehouse_queries
from wardstar.sources import sinks


def _dimension_sources(spark):
    def rows(data, names):
        return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))

    return {
        "payers": rows([("1", "Aetna"), ("2", None)], "Id NAME"),
        "organizations": rows([("1", "A", " austin ", "Texas"), ("2", "A", None, "TX")], "Id NAME CITY STATE"),
        "providers": rows([("1", " Bo ", None)], "Id NAME SPECIALITY"),
        "patients": rows([("1", "Al", "Ames", None, None, "dallas", "texas", "1")], "Id FIRST LAST GENDER BIRTHDATE CITY STATE ZIP"),
    }


def test_queries_on_dimensions_load_no_events(spark, monkeypatch):
    def never(*_):
        raise AssertionError("events are loaded")

    monkeypatch.setattr(standins, "_built", {})
    monkeypatch.setattr(standins, "sources", lambda *_: _dimension_sources(spark))
    monkeypatch.setattr(loading, "load_facts", never)
    assert values(warehouse_queries.standardise(spark, "none"), "t", "key", "city", "state") == [
        ("organization", 1, "AUSTIN", "TX"), ("organization", 2, "UNKNOWN", "TX"),
        ("patient", 1, "DALLAS", "TX"), ("provider", 1, "General Practice", None),
    ]
    assert values(warehouse_queries.duplicate_profile(spark, "none"), "dimension", "duplicates") == [
        ("organization", 0), ("payer", 1), ("provider", 0)]
    assert warehouse_queries.dim_loads(spark, "none").count() == 5


def test_a_round_of_calls_reads_its_own_texts(spark, monkeypatch):
    staged = {}

    def spy(df, label, partition_by=None, stage=calls.stage):
        staged[label] = (partition_by, stage(df, label, partition_by))
        return staged[label][1]

    monkeypatch.setattr(calls, "stage", spy)
    texts = [*(f"text {i}" for i in range(30)), None, "text 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = calls.answered(df, "text", lambda t: t.str.upper(), round_texts=7).collect()
    assert {r["id"]: r["response"] for r in got} == {i: t and t.upper() for i, t in enumerate(texts)}
    layout, rounds = staged["calls-rounds"]
    assert layout == [calls.ROUND] and rounds.count() == 31
    one = rounds.filter(F.col(calls.ROUND) == 0)
    assert 0 < len(one.inputFiles()) and all(f"{calls.ROUND}=" in f for f in rounds.inputFiles())


class _Frame:
    """Keeps the function that a DataFrame would run in its tasks."""

    schema = T.StructType([T.StructField("id", T.LongType())])

    def select(self, *_):
        return self

    def mapInArrow(self, function, schema):
        return function


def test_chunks_are_passed_on_in_small_batches():
    texts = [("word %d. " % i) * 3000 for i in range(150)] + [None, "", "short"]
    ids = [*range(150), 150, None, 152]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["id", "text"])
    out = list(chunks.chunk_documents(_Frame(), "id", "text")(iter([batch])))
    assert len(out) > 3
    assert all(sum(len(c) for c in b.column(4).to_pylist()) < chunks.OUT_CHARACTERS + chunks.CHUNK_SIZE for b in out)
    rows = [row for b in out for row in zip(*(c.to_pylist() for c in b.columns))]
    assert rows == [
        (key, i, lo, hi, text[lo:hi])
        for key, text in zip(ids, texts) if text
        for i, (lo, hi) in enumerate(chunks.chunk_spans(text))
    ]


def test_vectors_are_written_where_they_are_made(spark, tmp_path):
    data = [(i, "event" if i % 2 else "payer_profile", [float(i)]) for i in range(60)]
    corpus = spark.createDataFrame(data, "doc_id long, type string, embedding array<float>").repartition(3, "doc_id")
    before = spark.conf.get(sinks.OPEN_FILES)
    sinks.write_vectors(corpus, str(tmp_path / "v"))
    assert spark.conf.get(sinks.OPEN_FILES) == before
    files = os.listdir(tmp_path / "v" / "type=event")
    assert len([f for f in files if f.endswith(".parquet")]) == 3
    back = spark.read.parquet(str(tmp_path / "v"))
    assert values(back, "doc_id", "type") == values(corpus, "doc_id", "type")


def _plain_partial(a, b):
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0
    windows = (long[i : i + len(short)] for i in range(len(long) - len(short) + 1))
    return max(int(round(200.0 * fuzzy.common_length(short, w) / (2 * len(short)))) for w in windows)


def test_pairs_are_scored_together(monkeypatch):
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("ab cdé\U0001F600") for _ in range(n))
    sizes = [0, 1, 5, 63, 64, 65, 128, 129, 200]
    pairs = [(word(draw.choice(sizes)), word(draw.choice(sizes))) for _ in range(80)]
    expected = [_plain_partial(a, b) for a, b in pairs]
    assert fuzzy.partial_ratios(pairs) == expected
    steps = []
    plain = fuzzy._best_windows
    monkeypatch.setattr(fuzzy, "_best_windows", lambda group, *rest: (steps.append(len(group)), plain(group, *rest)))
    assert fuzzy.partial_ratios(pairs) == expected and len(steps) <= 4
    every = fuzzy.combined_scores(*zip(*pairs))
    assert every == [fuzzy.combined(*p) for p in pairs]
    cut = fuzzy.combined_scores(*zip(*pairs), 50)
    assert [s for s in cut if s >= 50] == [s for s in every if s >= 50]


def test_records_are_filled_in_after_they_are_numbered(spark, monkeypatch):
    seen = []

    def spy(df, *args, numbered=extract.with_dense_key, **named):
        seen.append(df.columns)
        return numbered(df, *args, **named)

    monkeypatch.setattr(extract, "with_dense_key", spy)
    rec = schemas.RECORD.simpleString()
    data = [(5, "a", '{"dim_patient": {"city": "Waco"}}'), (9, None, "{}"), (7, "b", "{}")]
    good = spark.createDataFrame(data, "source_row_id long, sample_name string, json string").select(
        "source_row_id", "sample_name", F.from_json("json", rec).alias("rec"))
    got = {r["record_id"]: r["rec"].asDict(True) for r in extract.records_from(good).collect()}
    assert seen == [["source_row_id", "sample_name", "rec"]]
    assert [(k, v["metadata"]["source_row_id"], v["metadata"]["sample_name"]) for k, v in sorted(got.items())] == [
        ("1500", 5, "a"), ("1501", 7, "b"), ("1502", 9, None)]
    assert got["1500"]["dim_patient"]["city"] == "Waco" and got["1501"]["dim_patient"]["state"] == "TX"


def test_texts_are_joined_to_single_and_repeated_classes_apart(spark, monkeypatch):
    labels = []

    def spy(df, label, *rest, stage=mixing.stage):
        labels.append(label)
        return stage(df, label, *rest)

    monkeypatch.setattr(mixing, "stage", spy)
    data = [(i, "w " * (i % 5 + 1), "s%d" % (i % 2)) for i in range(40)] + [(3, "x " * 4, "s1")] * 3 + [(None, "y", None)] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = mixing.mixed_documents(docs).collect()
    assert "mix-repeated-classes" in labels
    made = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert len(rows) == made and {tuple(r) for r in rows} <= set(data)
