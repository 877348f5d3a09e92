"""Calls of slow, failing functions: order, concurrency, retries and a log that is resumed."""

import os
import time
from collections import Counter

import pandas as pd
import pytest

from wardstar.operators import calls


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def recorder(folder):
    """A function that notes every call and how many were under way; texts with 'bad' fail."""

    def fn(texts: pd.Series) -> pd.Series:
        text = texts.iloc[0]
        mark = os.path.join(folder, f"{time.monotonic_ns()}-{text}")
        open(mark, "w").close()
        busy = os.path.join(folder, f"busy-{os.getpid()}-{time.monotonic_ns()}")
        open(busy, "w").close()
        time.sleep(0.05)
        seen = sum(f.startswith("busy-") for f in os.listdir(folder))
        os.remove(busy)
        with open(os.path.join(folder, f"most-{seen}"), "w"):
            pass
        if "bad" in text:
            raise RuntimeError("no answer")
        return texts.str.upper()

    return fn


def sent(folder):
    return Counter(f.split("-", 1)[1] for f in os.listdir(folder) if f[0].isdigit())


def test_fifteen_at_a_time_in_order(spark, tmp_path):
    texts = [f"text {i}" for i in range(120)]
    got = calls.answered(table(spark, texts), "text", recorder(str(tmp_path)), tasks=1).orderBy("id").collect()
    assert [r["response"] for r in got] == [t.upper() for t in texts] and not any(r["error"] for r in got)
    assert sent(tmp_path) == Counter(texts)
    most = max(int(f.split("-")[1]) for f in os.listdir(tmp_path) if f.startswith("most-"))
    assert 10 <= most <= 15


def test_rerun_sends_only_what_has_no_answer(spark, tmp_path):
    log, first, second = str(tmp_path / "log"), tmp_path / "a", tmp_path / "b"
    first.mkdir(), second.mkdir()
    texts = [f"text {i}" for i in range(20)] + ["bad one", "text 3", "text 3"]
    got = calls.answered(table(spark, texts), "text", recorder(str(first)), log, round_texts=7)
    assert {r["id"]: r["error"] for r in got.collect() if r["error"]} == {20: "RuntimeError: no answer"}
    assert got.count() == len(texts) and sent(first) == Counter(set(texts))
    again = calls.answered(table(spark, [*texts, "new"]), "text", lambda t: t.str.upper(), log)
    assert {r["text"]: r["response"] for r in again.collect()} == {t: t.upper() for t in [*texts, "new"]}
    third = calls.answered(table(spark, texts), "text", recorder(str(second)), log)
    assert third.filter("response is null").count() == 0 and not sent(second)


def test_a_stopped_run_goes_on_after_its_last_round(spark, tmp_path):
    log, folder = str(tmp_path / "log"), tmp_path / "calls"
    folder.mkdir()
    texts = [f"text {i}" for i in range(40)]
    record = recorder(str(folder))

    def dies(batch):
        if len(sent(str(folder))) > 25:
            os._exit(1)  # the worker, as if its executor was lost
        return record(batch)

    with pytest.raises(Exception):
        calls.answered(table(spark, texts), "text", dies, log, tasks=1, parallel=2, round_texts=5).count()
    kept = spark.read.parquet(log).count()
    assert 0 < kept < 40
    before = sent(folder)
    got = calls.answered(table(spark, texts), "text", record, log, tasks=1, parallel=2, round_texts=5)
    assert got.filter("response is null").count() == 0
    assert sum((sent(folder) - before).values()) == 40 - kept


def test_retries(spark, tmp_path):
    folder = str(tmp_path)

    def flaky(texts):
        open(os.path.join(folder, f"{time.monotonic_ns()}-{texts.iloc[0]}"), "w").close()
        if sent(folder)[texts.iloc[0]] < 3:
            raise RuntimeError("busy")
        return texts

    got = calls.answered(table(spark, ["a", "b"]), "text", flaky, attempts=3, pause=0.01).collect()
    assert [r["error"] for r in got] == [None, None] and sent(folder) == {"a": 3, "b": 3}


def test_edges(spark):
    rows = table(spark, ["x", None, "", "x"])
    got = {r["id"]: (r["response"], r["error"]) for r in calls.answered(rows, "text", lambda t: t.map(lambda x: f"<{x}>")).collect()}
    assert got == {0: ("<x>", None), 1: ("<None>", None), 2: ("<>", None), 3: ("<x>", None)}
    assert calls.answered(rows.limit(0), "text", lambda t: t).count() == 0
    short = calls.answered(rows, "text", lambda t: t.iloc[:0]).collect()
    assert {r["error"] for r in short} == {"ValueError: 0 answers to 1 texts"}
    each = calls.answered(rows, "text", lambda t: t, per=["id"], texts_per_call=2).collect()
    assert [r["response"] for r in sorted(each)] == ["x", None, "", "x"]
