"""Quality rules, decontamination, packing and personal data against plain versions."""

import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from wardstar.llm import decontamination, packing, pii, quality_rules

SCHEMA = "doc_id bigint, text string, measures int, n_words int, k string, t int"
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "a b c a b c a b c"), (None, None),
    (5, "x y z\nx y z\n\n \nx y z"), (6, "É É É ** <b> |     \x1c q"), (7, "w " * 60_000), (8, "a\x0bb\x0cc\rd"),
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "k", 3) for i, t in rows], SCHEMA)


TEXT = st.text(alphabet="abAB \n\t*|é., ", max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_measures(text):
    assert quality_rules.measure(text)[:5] == brute.quality(text)


def test_quality_rows(spark):
    prose = " ".join(f"word{i} of text{i % 7}." for i in range(40))
    junk = [f"{w}*** " * 70 for w in ("aa bb", "cc dd ee")] + ["LOUD WORDS HERE!! " * 30]
    rows = ODD + [(100 + i, prose + f" tail{i}") for i in range(30)] + [(200 + i, t) for i, t in enumerate(junk)]
    held = quality_rules.measured(table(spark, rows).drop("measures"))
    judged = quality_rules.judged(held, quality_rules.fit(held)).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert tuple(r["measures"])[:5] == brute.quality(r["text"])
        n, repeat = r["measures"]["n_words"], r["measures"]["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert r["kept"] == ((r["doc_id"] or 0) // 100 == 1)
    kept = quality_rules.keep_good(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "measures", "n_words", "k", "t"] and kept.count() == 30
    assert quality_rules.keep_good(table(spark, [])).collect() == []


def test_estimate_finds_reliable_rules():
    draw = np.random.default_rng(3)
    good = draw.random(4000) < 0.8
    votes = np.stack([np.where(draw.random(4000) < r, np.where(good, 1, -1), 0) for r in (0.9, 0.5, 0.3)], 1)
    votes[draw.random(4000) < 0.02, 0] *= -1
    found, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.estimate(found, counts.astype(float), ("a", "b", "c"))
    assert abs(model.prior_good - 0.8) < 0.05
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.95


def test_decontamination(spark):
    draw = random.Random(2)
    vocabulary = ["the", "of", "été", "a1", "x", "y", "zz", "q"]
    text = lambda n: " ".join(draw.choice(vocabulary) + draw.choice(["", ".", ",", "\n"]) for _ in range(n))
    items = [(i, text(draw.choice([1, 3, 9, 10, 14, 25]))) for i in range(12)] + [(90, None), (91, ""), (92, "...")]
    rows = ODD + [(300 + i, text(80) + " " + items[i % 12][1].upper().replace("É", "é") + " " + text(30)) for i in range(24)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    index = decontamination.build_index(table(spark, rows).repartition(3), segment_words=300)
    known = [(str(i), t) for i, t in items]
    results = [decontamination.search(index, bench), decontamination.search(index, bench, block_words=20)]
    for found in results:
        found = found.withColumn("n_hit", decontamination.n_hit(found["spans"])).collect()
        assert len(found) == len(rows)
        seen = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["items"]) for r in found)
        assert seen == sorted((i or -1, *brute.hits(t, known)) for i, t in rows)
    clean = decontamination.clean_documents(table(spark, rows), bench)
    assert clean.columns == ["doc_id", "text", "measures", "n_words", "k", "t"]
    expected = sorted(str(r) for r in rows if not brute.hits(r[1], known)[2])
    assert sorted(str((r["doc_id"], r["text"])) for r in clean.collect()) == expected
    none = bench.filter("item_id < 0")
    assert decontamination.search(index, none).filter("size(items) > 0").count() == 0
    empty = decontamination.build_index(table(spark, []))
    assert decontamination.search(empty, bench).collect() == []


def test_proximity():
    words = b"alpha beta gamma delta x x x beta x alpha x gamma".split()
    postings = {w: np.array([i for i, v in enumerate(words) if v == w]) for w in set(words)}
    window = (b"alpha", b"beta", b"gamma")
    assert decontamination.starts_of(window, postings).tolist() == [0]
    assert len(decontamination.near_places(window, postings, 3)) == 1
    assert len(decontamination.near_places(window, postings, 5)) == 2


def test_near_items(spark):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(draw.sample(words, n))) for i, n in enumerate([3, 10, 17, 25, 25, 31])]
    rows = list(ODD)
    for number, (_, text) in enumerate(items):
        for first in range(0, max(1, len(text.split()) - 9)):
            passage = text.split()[first : first + 10]
            draw.shuffle(passage)
            for _ in range(draw.randrange(6)):
                passage.insert(draw.randrange(1, len(passage)), "other")
            rows.append((1000 * number + 100 + first, "before " * 20 + " ".join(passage) + " after" * 20))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    index = decontamination.build_index(table(spark, rows).repartition(3), segment_words=600)
    known = [(str(i), t) for i, t in items]
    expected = sorted(((i or -1, brute.near(t, known)) for i, t in rows), key=str)
    assert any(near and (i - 100) % 10 for i, near in expected if i >= 2100)
    for block_words in (1000, 20):
        found = decontamination.search(index, bench, block_words=block_words).collect()
        assert sorted(((r["doc_id"] or -1, r["near_items"]) for r in found), key=str) == expected


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31])
def test_packed_file(bits):
    draw = np.random.default_rng(bits)
    lengths = draw.integers(0, 900, 30)
    ids = draw.integers(0, 1 << bits, int(lengths.sum())).astype(np.uint32)
    data = packing.build_file([None, *range(29)], lengths, ids, bits, 3, 4, block=512) + packing.TRAILER
    file = packing.PackedFile(data)
    assert (file.part, file.number, file.bits, file.n_ids) == (3, 4, bits, len(ids))
    assert file.nulls.sum() == 1 and (np.diff(file.starts.astype(int)) == lengths).all()
    for a, b in [(0, len(ids)), (5, 5), (511, 513), (1000, 2900)]:
        assert (file.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        packing.PackedFile(data[:-1])


def test_encoder_equals_library():
    import pyarrow as pa

    draw = random.Random(4)
    texts = [None, "", " ", "a  b", "it's  a\n\n b", "<|endoftext|> x", "word. Next,\nline  end ", "x" * 300]
    texts += ["".join(draw.choice(" \n\ta'sé1. !ŁЖ中") for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    encoder = packing.Encoder(packing.tokenizer_path())
    flat, lengths = encoder.encode(pa.array(texts))
    ends = np.cumsum(lengths)
    for text, start, stop in zip(texts, ends - lengths, ends):
        expected = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert flat[start:stop].tolist() == expected, text


def test_packed(spark):
    rows = ODD + [(20, "some text"), (-3, "before all"), (20, "other text")]
    tokenizer = packing._tokenizer(packing.tokenizer_path())
    ids = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
    found = packing.packed(table(spark, rows).repartition(4)).collect()
    found.sort(key=lambda r: r["start"])
    assert len(found) == len(rows)
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in found]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    sums = lambda t: (len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes()))
    assert sorted((r["doc_id"] or -99, r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(
        (i or -99, *sums(t)) for i, t in rows
    )
    assert packing.packed(table(spark, []).repartition(1)).collect() == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    found = [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if good(kind, m.group())
    ]
    return sorted(found, key=pii.order)


PIECES = st.lists(
    st.sampled_from(
        ["4539578763621486", "+1 (234) 555-1234", "1.2.3.4", "300.1.1.1", "a.b@c.de", "@", "a@", "@b.c", "x@y.z@w.v", ".", " ",
         "-", "12", "+", "555-1234", "é", "\n", "1.2.3.4.5.6.7.8", "+49 30 1234567", "(", "00000000000000", "a@b.c-.d"]
    ),
    max_size=8,
)


@settings(max_examples=500, deadline=None)
@given(PIECES)
def test_base_spans(pieces):
    text = "".join(pieces)
    assert pii.base_spans(text)[0] == plain_spans(text)


def test_personal_data(spark):
    hidden = "call +1 (269) 555-3296 4539578763621486 now"
    rows = ODD + [(30, "mail me: jo@mail.example.com or 4539578763621486."), (31, hidden), (32, "9" * 100_000), (33, "a@" * 50_000)]
    rows += [(40 + i, f"w{i} +1 (269) 555-32{i:02d} x 10.0.0.{i} y jo{i}@ex.com z 4539578763621486 q") for i in range(30)]
    found = pii.read_documents(table(spark, rows))
    done = pii.accepted(found, pii.fit(found)).withColumn("text_of", pii.joined("base")).collect()
    assert len(done) == len(rows)
    by_id = {r["k"]: r for r in done if r["k"] is not None}
    for i, text in rows:
        if i is not None:
            base = [tuple(s) for s in by_id[i]["base"]]
            assert base == plain_spans(text)
            assert by_id[i]["text_of"] == ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    assert {hidden[s["start"] : s["stop"]] for s in by_id[31]["added"]} == {"+1 (269) 555-3296", "4539578763621486"}
    assert not by_id[32]["added"] and not by_id[33]["added"]
    nothing = pii.read_documents(table(spark, []))
    assert pii.accepted(nothing, pii.fit(nothing)).collect() == []


@pytest.mark.parametrize("text", ["+1 " + "( " * 500_000 + "1", "4111 1111 1111 1111 " * 20_000, "+49 (" * 50_000, "1-2 " * 100_000])
def test_personal_data_of_long_texts_in_linear_time(text):
    began = time.monotonic()
    good, bad = pii.base_spans(text)
    pii.candidates(text, good, bad)
    assert time.monotonic() - began < 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=12), st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=12))
def test_taken_places(spans, more):
    known = [(a, a + n) for a, n in spans]
    taken = pii.Taken(known)
    for a, n in more:
        free = all(a + n <= x or a >= y for x, y in known)
        assert taken.free(a, a + n) == free
        if free:
            taken.add(a, a + n)
            known.append((a, a + n))


def test_windows_are_searched_where_their_words_are_near(monkeypatch):
    words = [f"w{i}".encode() for i in range(30)]
    docs = [words[:12], words[::-1], words[12:20] + [b"x"] * 30 + words[20:], words[15:]]
    known = {w: n for n, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
    numbers = [np.array([known[w] for w in d]) for d in docs]
    rows = pd.concat([b.to_pandas() for b in decontamination._segment_rows(5, known, numbers, [1, 2, 3, None], list(map(len, docs)))])
    searched = []
    kept = decontamination.starts_of
    monkeypatch.setattr(decontamination, "starts_of", lambda w, p: searched.append(w) or kept(w, p))
    items = [("a", words[:10]), ("b", words[10:25]), ("c", [words[i] for i in range(0, 30, 3)])]
    found = decontamination._search(items, 10, 4)((5,), rows)
    assert found["items"].tolist() == [["a"], [], [], ["b"]]
    assert found["near_items"].tolist() == [["a"], ["a", "b"], [], ["b"]]
    assert found["spans"].tolist()[3] == [{"start": 0, "stop": 10}]
    # of item c the words are all there, but nowhere near one another
    assert len(searched) == 7


def test_frequent_words_stay_known(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "KNOWN_PIECES", 60)
    encoder = packing.Encoder(packing.tokenizer_path())
    encoded = []
    kept = encoder._word
    monkeypatch.setattr(encoder, "_word", lambda word, blank: encoded.append(blank + word) or kept(word, blank))
    draw = random.Random(5)
    common = ["first", "été", "word.", "a\nb", "x"]
    for n in range(40):
        texts = [" ".join([*draw.sample(common, 5), *(f"u{n}i{i}" for i in range(5 * n % 90))]) for _ in range(3)]
        flat, lengths = encoder.encode(pa.array(texts))
        for text, end, size in zip(texts, np.cumsum(lengths), lengths, strict=True):
            assert flat[end - size : end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoded.count(" first") == 1 and encoded.count(" a\nb") == 1
    assert len(encoder.place) < 200
