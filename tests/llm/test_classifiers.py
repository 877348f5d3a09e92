"""Trained models on made-up classes: held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
import pytest

from wardstar.llm import quality_classifier, toxicity

DOCS = "doc_id bigint, text string, score int, toxicity int, y int, k int, t int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, 1, 1, 1, 1) for i, t in rows], DOCS)


def made(n, seed=0):
    """Rows and labels: low quality is symbols or repeats, toxic has words of two stems."""
    draw = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(5, 120))]
        quality, toxic = int(draw.random() > 0.3), int(draw.random() < 0.25)
        if not quality:
            text = [w + "***" for w in text] if i % 2 else [w for w in text for _ in range(3)]
        if toxic:
            for _ in range(1 + len(text) // 30):
                text.insert(draw.randrange(len(text)), draw.choice(["badone", f"grr{draw.choice(words)}"]))
        rows.append((i, " ".join(text)))
        labels.append((i, quality, toxic))
    return rows, labels


ODD = [(9001, None), (9002, ""), (9003, "   "), (None, "badone badone"), (9004, "x " * 60_000), (5, "badone"), (5, "badone")]


def test_quality(spark):
    rows, labels = made(900)
    labels += [(1, 0, 0), (None, 1, 1), (9001, None, None), (9002, 7, 7)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality_classifier.train(documents(spark, rows), table)
    scored = quality_classifier.scored(documents(spark, rows + ODD), model)
    held = scored.withColumn("held", quality_classifier.fold("doc_id") == 0).collect()
    assert len(held) == len(rows) + len(ODD) and all(0 <= r["score"] <= 1 for r in held)
    known = {i: q for i, q, _ in labels[:900]}
    tested = [((r["score"] >= 0.3), known[r["doc_id"]]) for r in held if r["held"] and r["doc_id"] in known and r["doc_id"] != 5]
    assert len(tested) > 100 and np.mean([a == b for a, b in tested]) > 0.97


def test_quality_without_examples(spark):
    rows, labels = made(40)
    one = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], "doc_id bigint, quality int, toxic int")
    for table, high in ((one, True), (one.filter("doc_id < 0"), False)):
        model = quality_classifier.train(documents(spark, rows), table)
        scores = {r["score"] for r in quality_classifier.scored(documents(spark, rows + ODD), model).collect()}
        assert len(scores) == 1 and (scores.pop() > 0.9) == high
    assert quality_classifier.scored(documents(spark, []), model).collect() == []


def test_quality_fits_on_up_to_8000_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda rows, labels: seen.append(len(rows)))
    for n in (5_000, 12_000):
        table = spark.range(n).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
        quality_classifier.train(spark.range(n).selectExpr("id as doc_id", "concat('a b ', id) as text"), table)
        assert seen.pop() == min(8_000, sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n)))


def test_hinge_is_fitted_to_the_end():
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 400, 25)) for _ in range(600)]
    labels = np.array([int((r < 200).mean() > 0.5) for r in rows])
    labels = np.where(draw.random(600) < 0.2, 1 - labels, labels)
    weights = quality_classifier.fit_hinge(rows, labels)[1]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality_classifier, "ROUNDS", 1000)
        best = quality_classifier.fit_hinge(rows, labels)[1]
    assert np.linalg.norm(weights - best) < 0.01 * np.linalg.norm(best)


def test_toxicity(spark):
    rows, labels = made(1500, 4)
    table = spark.createDataFrame(labels + [(None, 1, 1), (9001, None, None)], "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(documents(spark, rows), table)
    assert b"badone" in chain.known and len(chain.models) == len(toxicity.CATEGORIES)
    assert [len(m.chain) for m in chain.models] == [0, 1, 2]
    scored = toxicity.scored(documents(spark, rows + ODD), chain)
    found = scored.withColumn("held", quality_classifier.fold("doc_id") == 0).collect()
    assert len(found) == len(rows) + len(ODD)
    known = {i: t for i, _, t in labels}
    right = [
        (r["toxicity"]["toxic"] >= 0.5) == known[r["doc_id"]] for r in found if r["held"] and r["doc_id"] in known and r["doc_id"] != 5
    ]
    assert len(right) > 200 and np.mean(right) > 0.97
    assert all(r["toxicity"]["toxic"] < 0.5 for r in found if r["doc_id"] in (9001, 9002, 9003))
    assert all(r["toxicity"]["toxic"] >= 0.5 for r in found if r["doc_id"] is None)


def test_vocabulary_of_all_labelled_documents(spark):
    rows, labels = made(1500, 4)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(documents(spark, rows), table, fit_rows=60)
    assert b"badone" in chain.known
    inside = [(t, y) for (i, t), (_, _, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5]
    assert chain.known == toxicity.vocabulary(spark.createDataFrame(inside, "t string, y int"))
    assert toxicity.FIT_ROWS == 10_000


def test_toxicity_without_examples(spark):
    rows, _ = made(30)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    chain = toxicity.train(documents(spark, rows), none)
    assert chain.known == {}
    assert {tuple(r["toxicity"]) for r in toxicity.scored(documents(spark, rows), chain).collect()} == {(0.5, 0.5, 0.5)}
    assert toxicity.scored(documents(spark, []), chain).collect() == []


def test_later_categories_use_earlier_ones():
    draw = np.random.default_rng(0)
    first = draw.random(800) < 0.5
    rows = [[0] if f else [1] for f in first]
    labels = np.stack([first, first], 1).astype(int)
    chain = toxicity.fit_chain({b"a": 0, b"b": 1}, rows, labels)
    assert chain.models[1].chain[0] > 0
    assert chain.probabilities([0])[1] > 0.9 > 0.1 > chain.probabilities([1])[1]


def test_repeated_rows_are_fitted_once(spark):
    """One labelled id in many rows neither floods the fit nor loses its texts."""
    rows, labels = made(300, 4)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    inside = next(i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5)
    more = rows + [(inside, "badone again")] * 5_000 + [(inside, f"plain {n}") for n in range(50)]
    seen = []
    fit = toxicity.fit_chain
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "fit_chain", lambda known, sets, labels: seen.append(len(sets)) or fit(known, sets, labels))
        toxicity.train(documents(spark, more), table)
        toxicity.train(documents(spark, more), table, fit_rows=100)
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in rows) + 51, 100]


def test_counts_do_not_depend_on_flushes(spark, monkeypatch):
    rows, labels = made(1500, 4)
    known = spark.createDataFrame([(t, y) for (_, t), (_, _, y) in zip(rows, labels)], "t string, y int")
    whole = toxicity.vocabulary(known)
    monkeypatch.setattr(toxicity, "COUNTED_FEATURES", 10)
    assert whole and toxicity.vocabulary(known) == whole
