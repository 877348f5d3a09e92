import datetime
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import values
from wardstar.functions import scalars, text
from wardstar.functions.chunks import chunk_spans
from wardstar.functions.questions import expand, with_actor


def expected_normal(s):
    if s is None:
        return ""
    s = re.sub(r"[\s,:]+", " ", s.lower())
    s = re.sub(r"[\r\n\t\-]+", " ", s)
    return re.sub(r"\s+", " ", s).strip()


def normalised(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    once = text.normalise(F.col("t"))
    rows = df.select("i", once.alias("a"), text.normalise(once).alias("b")).orderBy("i").collect()
    return [(r["a"], r["b"]) for r in rows]


def test_normalise_edge_rows(spark):
    texts = [
        None, "", ",:,", "A\r\nB", "a\tb--c", "a,,b::c", "x y", " é  Ü", " Trim - me ", "a\x1cb\x85c d",
    ]
    assert [a for a, _ in normalised(spark, texts)] == [expected_normal(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("aB ,:\t\n\r-  é."), max_size=12), min_size=30, max_size=60))
def test_normalise_matches_and_is_idempotent(spark, texts):
    got = normalised(spark, texts)
    assert [a for a, _ in got] == [expected_normal(t) for t in texts]
    assert all(a == b for a, b in got)


def test_row_context_and_words(spark):
    df = spark.createDataFrame([(1, None, "Is it A b-c xyz?")], "a int, b string, c string")
    row = df.select(text.row_context(df).alias("ctx"), text.keywords(F.col("c")).alias("w")).first()
    assert row["ctx"] == "a: 1\nb: nan\nc: Is it A b-c xyz?"
    assert row["w"] == ["b-c", "xyz?"]


def test_safe_double_and_money(spark):
    texts = ["abc", "NaN", "Infinity", "1e12", "", None, " 5.25 ", "5d", "-3", ".5", "1e999", "2.675"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    value = scalars.safe_double(F.col("t"))
    got = [(r[0], None if r[1] is None else float(r[1])) for r in df.select(value, scalars.money(value)).collect()]
    assert got == [
        (None, None), (None, None), (None, None), (1e12, None), (None, None), (None, None), (5.25, 5.25),
        (None, None), (-3.0, -3.0), (0.5, 0.5), (None, None), (2.675, 2.68),
    ]


def test_dates_keep_the_written_day_in_any_zone(spark):
    texts = [
        "2019-01-01T23:30:00Z", "2019-01-01T23:30:00+05:00", "2019-01-01 00:10:00", "2019-1-2", "not a date", None, "",
        "2019-02-30",
    ]
    day = datetime.date(2019, 1, 1)
    wanted = [day, day, day, datetime.date(2019, 1, 2), None, None, None, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [r[0] for r in df.select(scalars.date_of(F.col("t"))).collect()] == wanted
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_plain_id(spark):
    df = spark.createDataFrame([(t,) for t in (None, "007", "3.0", "abc", "nan", "0")], "t string")
    assert [r[0] for r in df.select(scalars.plain_id(F.col("t"))).collect()] == ["0", "7", "3", "abc", "nan", "0"]
    big = spark.createDataFrame([(9007199254740993,), (None,)], "k bigint")
    assert [r[0] for r in big.select(scalars.plain_id(F.col("k"), False)).collect()] == ["9007199254740993", "0"]


def test_bucket_is_repeatable_and_spread(spark):
    df = spark.range(2000).select(scalars.bucket(F.col("id"), "s", 8).alias("b"), scalars.pick(["x", "y"], F.col("id"), "t").alias("p"))
    counts = dict(values(df.groupBy("b").count()))
    assert sorted(counts) == list(range(8)) and min(counts.values()) > 180
    assert values(df) == values(df.repartition(3))


def test_actor_detection(spark):
    wanted = {
        "What medications does patient 3 have?": ("patient", "3"),
        "patient id 007": ("patient", "7"),
        "patient number 12": ("patient", "12"),
        "Tell me about provider 1": ("provider", "1"),
        "Dr. who": ("provider", None),
        "hospital 4 and patient 5": ("patient", "5"),
        "outpatient care": ("patient", None),
        "facility 9": ("organization", "9"),
        "coverage?": ("payer", None),
        "insurance000": ("payer", "0"),
        "Show me all diabetes cases": (None, None),
    }
    df = spark.createDataFrame([(q,) for q in wanted], "query string")
    got = {r["query"]: (r["actor_type"], r["actor_id"]) for r in with_actor(df).collect()}
    assert got == wanted
    service = {r["query"]: (r["actor_type"], r["actor_id"]) for r in with_actor(df, flavour="service").collect()}
    assert service["patient number 12"] == ("patient", None)
    assert service["facility 9"] == ("organization", None)
    assert service["coverage?"] == (None, None) and service["Dr. who"] == (None, None)


def test_expansion_is_sorted_and_distinct(spark):
    df = spark.createDataFrame([("Doctor of the hospital",), ("nothing here",)], "q string")
    got = [r[0] for r in df.select(expand(F.col("q"))).collect()]
    assert got[0] == (
        "Doctor of the hospital center clinic clinician doctor dr facility hospital organization physician provider"
    )
    assert got[1] == "nothing here"


def test_chunks_cover_the_text():
    for body in ("word. " * 500, "a b\n\nc" * 300, "x" * 1234, "short", ""):
        spans = chunk_spans(body)
        assert all(0 < hi - lo <= 500 for lo, hi in spans)
        covered = set()
        for lo, hi in spans:
            covered.update(range(lo, hi))
        assert len(covered) == len(body)
        for (_, end), (start, _) in zip(spans, spans[1:]):
            assert end - 100 <= start <= end
