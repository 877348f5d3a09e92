"""Alignment of two tokenizers against a plain version on the libraries' own output."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardstar.llm import alignment
from wardstar.llm.packing import byte_letters, tokenizer_path

SCHEMA = "doc_id bigint, text string, k int, a string, text_key int, block double, n_a string"


def table(spark, rows, parts=6):
    return spark.createDataFrame([(*r, 1, "a", 2, 0.5, "n") for r in rows], SCHEMA).repartition(parts)


@cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path(alignment.TOKENIZER_A))
    first.encode_special_tokens = True
    names = {i: t for t, i in first.get_vocab().items()}
    return first, names, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.TOKENIZER_B))


def plain_groups(text):
    """Groups of (A ids, B ids), or none."""
    if not text:
        return []
    first, names, second = libraries()
    byte_of = {c: b for b, c in byte_letters().items()}
    a = [(i, bytes(byte_of[c] for c in names[i])) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    spelled = (" " + text).encode()
    if b"".join(t for _, t in a) != spelled or b"".join(t for _, t in b) != spelled:
        return []

    def ends(tokens):
        out, at = {}, 0
        for n, (_, t) in enumerate(tokens):
            at += len(t)
            out[at] = n + 1
        return out

    ends_a, ends_b = ends(a), ends(b)
    groups, p, q = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, _ in a[p : ends_a[end]]], [i for i, _ in b[q : ends_b[end]]]))
        p, q = ends_a[end], ends_b[end]
    return groups


def plain(rows):
    links = [Counter((x, y) for a, b in plain_groups(t) for x in a for y in b) for _, t in rows]
    count = Counter(p for found in links for p in found)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, t), found in zip(rows, links):
        groups = plain_groups(t)
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in found.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return out


def check(spark, rows):
    found = [tuple(r) for r in alignment.token_alignment(table(spark, rows)).collect()]
    assert sorted(found, key=repr) == sorted(plain(rows), key=repr)


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "naïve café Ünïcödé 東京 タワー emoji 🙂🙃", "tabs\tand\nlines\r\n\n  twice",
    "a<|endoftext|>b </s> <s> <0x41> <unk>", "x▁y", "  lead and trail  ", " ", " 　wide", "\x00\x01zero", "é decomposed ﬁ",
    "antidisestablishmentarianism " * 3, "https://example.org/a?b=c&d=%20 1234567890 3.14159", "don't we'll I'm they're",
]


@pytest.mark.parametrize("block", [alignment.BLOCK_TOKENS, 40])
def test_against_plain(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_TOKENS", block)
    monkeypatch.setattr(alignment, "SMALL_GROUP", 8 if block == 40 else alignment.SMALL_GROUP)
    draw = random.Random(5)
    words = " ".join(TEXTS).split()
    rows = list(enumerate(TEXTS))
    rows += [(100 + i, " ".join(draw.choices(words, k=draw.randrange(1, 60)))) for i in range(60)]
    rows += [(300 + i, TEXTS[1]) for i in range(40)]  # copies weigh as documents
    rows += [(400, None), (401, ""), (None, TEXTS[0]), (None, None), (0, TEXTS[0]), (0, TEXTS[0])]
    rows += [(500, "一龥" * 3000), (501, "\U0001f642" * 700), (502, "ab" * 4000), (503, "word " * 20_000), (504, "-=" * 999)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "x")], [(1, "x▁"), (2, "")]])
def test_edges(spark, rows):
    check(spark, rows)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text("ab \n\t'1.é一<>|", max_size=40))
def test_ids_are_those_of_the_libraries(text):
    first, _, second = libraries()
    a, b = (alignment.side_a(tokenizer_path(alignment.TOKENIZER_A)), alignment.side_b(tokenizer_path(alignment.TOKENIZER_B)))
    assert a.encode(text) == first.encode(" " + text, add_special_tokens=False).ids
    assert b.encode(text) == second.encode(text)
    found = alignment.align(text, a, b)
    expected = plain_groups(text)
    assert (found is None) == (not expected)
    if found:
        links = Counter((x << 32) | y for p, q in expected for x in p for y in q)
        assert dict(zip(found.pairs.tolist(), found.links.tolist())) == dict(links)


def test_every_plan_shuffles(spark):
    """The same joins at every size: none becomes a broadcast because its side is small."""
    aligned = alignment.aligned_texts(table(spark, list(enumerate(TEXTS))))
    known = alignment.lookup_join(
        alignment.pair_lists(aligned), alignment.pair_counts(aligned), ["a", "b"], "inner", spread=["block"], broadcast=False
    )
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
