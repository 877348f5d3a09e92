"""Benchmark passages in training documents, by a positional inverted index.

The index is a stored table of postings. It is cut by documents into segments of a bounded
number of words; a row holds one term of one segment with all its positions, counted through
the segment with GAP free places after each document, so that no match runs across documents.
A row without a term is the directory of its segment: documents and where they begin.

A search takes from the index only rows of the searched terms. In each segment, every window of
the benchmark starts from its rarest term there and keeps the starts that the lists of the
other terms, moved by their offset and taken from rare to frequent, agree on. A window whose
rarest term is missing costs one lookup. Segments are independent and bounded, so a passage
that very many documents share spreads over many tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.tasks import release, tidied
from wardstar.llm.words import plain_words
from wardstar.session import scratch, stage

WINDOW = 10
SLOP = 4
# Free places between documents: the widest span that a proximity search may ask for.
GAP = 64
SEGMENT_WORDS = 1 << 19
QUERY_BLOCK_WORDS = 1 << 20
# Anchors whose spans are tried at once.
FIT_ANCHORS = 1 << 14

INDEX_SCHEMA = "segment bigint, term binary, n_documents int, postings binary, doc_ids binary"
INDEX_FIELDS = ["segment", "term", "n_documents", "postings", "doc_ids"]


def _stored_ids(ids: list[int | None]) -> bytes:
    """The ids as 8 bytes each, then a byte each that is 1 for null."""
    known = np.array([0 if i is None else i for i in ids], "<i8")
    return known.tobytes() + bytes(i is None for i in ids)


def _loaded_ids(data: bytes) -> pd.array:
    n = len(data) // 9
    return pd.arrays.IntegerArray(np.frombuffer(data, "<i8", n).astype(np.int64), np.frombuffer(data, bool, n, 8 * n).copy())


def _segment_rows(segment: int, known: dict, numbers: list, ids: list, lengths: list) -> Iterator[pa.RecordBatch]:
    bases = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) + GAP)])
    everything = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
    place = np.arange(len(everything)) + GAP * np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(everything, kind="stable")
    counts = np.bincount(everything, minlength=len(known))
    positions = place[order].astype("<i4")
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * 4
    postings = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(known), [None, pa.py_buffer(ends), pa.py_buffer(positions)]
    ).cast(pa.binary())
    owner = np.searchsorted(bases, positions, "right")
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (np.diff(np.repeat(np.arange(len(known)), counts)) != 0)
    documents = np.add.reduceat(fresh, ends[:-1] // 4, dtype=np.int32) if len(known) else np.empty(0, np.int32)
    none = pa.nulls(len(known), pa.binary())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(known), segment)),
            pa.array(list(known), pa.binary()),
            pa.array(documents),
            postings,
            none,
        ],
        INDEX_FIELDS,
    )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([segment]),
            pa.array([None], pa.binary()),
            pa.array([len(ids)], pa.int32()),
            pa.array([bases.astype("<i4").tobytes()], pa.binary()),
            pa.array([_stored_ids(ids)], pa.binary()),
        ],
        INDEX_FIELDS,
    )


def _numbering() -> dict[bytes, int]:
    """Numbers from 0 by first look-up."""
    return defaultdict(count().__next__)


def _index(segment_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        known = _numbering()
        numbers: list[np.ndarray] = []
        ids: list[int | None] = []
        lengths: list[int] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = plain_words(text.as_py())
                numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                ids.append(doc_id)
                lengths.append(len(words))
                held += len(words) + GAP
                if held >= segment_words:
                    yield from _segment_rows(segment, known, numbers, ids, lengths)
                    segment += 1
                    known, numbers, ids, lengths, held = _numbering(), [], [], [], 0
        if ids:
            yield from _segment_rows(segment, known, numbers, ids, lengths)

    return run


def build_index(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_words: int = SEGMENT_WORDS
) -> DataFrame:
    """The stored index of all words of all ``docs``.

    Words are runs of ASCII letters (lower-cased), ASCII digits and anything beyond ASCII. A
    null text has none. Rows with equal or null ids are documents of their own.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    return stage(rows.mapInArrow(tidied(_index(segment_words)), INDEX_SCHEMA), "postings")


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words; a shorter, not empty, list is one window."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def starts_of(window: tuple[bytes, ...], postings: dict[bytes, np.ndarray]) -> np.ndarray:
    """Places where the words of ``window`` follow one another."""
    lists = []
    for offset, term in enumerate(window):
        found = postings.get(term)
        if found is None:
            return np.empty(0, np.int64)
        lists.append((len(found), offset, found))
    lists.sort(key=lambda x: x[:2])
    _, offset, rarest = lists[0]
    starts = rarest.astype(np.int64) - offset
    for n, offset, found in lists[1:]:
        at = found.searchsorted(starts + offset)
        starts = starts[(at < n) & (found[np.minimum(at, n - 1)] == starts + offset)]
        if not len(starts):
            break
    return starts


def near_places(window: Iterable[bytes], postings: dict[bytes, np.ndarray], span: int) -> np.ndarray:
    """Places of the rarest word of ``window`` that lie, with every other word of it in any
    order, within ``span`` consecutive places."""
    terms = set(window)
    if not terms <= postings.keys():
        return np.empty(0, np.int64)
    lists = sorted(map(postings.__getitem__, terms), key=len)
    anchors = lists[0].astype(np.int64)
    for found in lists[1:]:
        # the first place that is not too far before, or else the last of all
        at = found.searchsorted(anchors - span, "right")
        anchors = anchors[np.abs(found.take(at, mode="clip") - anchors) < span]
        if not len(anchors):
            return anchors
    pieces = [anchors[i : i + FIT_ANCHORS] for i in range(0, len(anchors), FIT_ANCHORS)]
    return np.concatenate([piece[_fits(piece, lists[1:], span)] for piece in pieces])


def _fits(anchors: np.ndarray, others: list[np.ndarray], span: int) -> np.ndarray:
    """Which anchors share a span of places with a word of every other list."""
    firsts = anchors[:, None] + np.arange(1 - span, 1)
    good = np.ones(firsts.shape, bool)
    for found in others:
        at = np.searchsorted(found, firsts)
        good &= (at < len(found)) & (found[np.minimum(at, len(found) - 1)] < firsts + span)
    return good.any(axis=1)


SPANS = "array<struct<start:int,stop:int>>"
FOUND_SCHEMA = (
    f"segment bigint, ordinal int, doc_id bigint, n_words bigint, spans {SPANS}, "
    "items array<string>, near_items array<string>"
)


def _search(items: list[tuple[str, list[bytes]]], size: int, slop: int):
    """A function that searches one segment: its directory and the postings of the searched terms."""
    # Windows of the same words in another order are near the same places, and each is only where they are near.
    loose: dict[tuple[frozenset[bytes], int], dict[tuple[bytes, ...], list[str]]] = {}
    for item, words in items:
        for window in windows_of(words, size):
            exact = loose.setdefault((frozenset(window), len(window) + slop), {})
            exact.setdefault(window, []).append(item)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        release()
        directory = rows[rows["term"].isna()].iloc[0]
        bases = np.frombuffer(directory["postings"], "<i4").astype(np.int64)
        n_docs = len(bases) - 1
        terms = rows[rows["term"].notna()]
        postings = {
            bytes(t): np.frombuffer(p, "<i4").astype(np.int64) for t, p in zip(terms["term"], terms["postings"], strict=True)
        }
        steps = np.zeros(int(bases[-1]) + 1, np.int32)
        found: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for (words, span), exact in loose.items():
            places = near_places(words, postings, span)
            if not len(places):
                continue
            for doc in np.unique(np.searchsorted(bases, places, "right") - 1).tolist():
                near.setdefault(doc, set()).update(*exact.values())
            for window, names in exact.items():
                starts = starts_of(window, postings)
                if len(starts):
                    steps[starts] += 1
                    steps[starts + len(window)] -= 1
                    for doc in np.unique(np.searchsorted(bases, starts, "right") - 1).tolist():
                        found.setdefault(doc, set()).update(names)
        edges = np.diff(np.concatenate([[0], np.cumsum(steps) > 0, [0]]).astype(np.int8))
        first, last = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        spans: dict[int, list[dict[str, int]]] = {}
        for doc, a, b in zip((np.searchsorted(bases, first, "right") - 1).tolist(), first, last, strict=True):
            spans.setdefault(doc, []).append({"start": int(a - bases[doc]), "stop": int(b - bases[doc])})
        return pd.DataFrame(
            {
                "segment": np.full(n_docs, key[0]),
                "ordinal": np.arange(n_docs, dtype=np.int32),
                "doc_id": _loaded_ids(directory["doc_ids"]),
                "n_words": np.diff(bases) - GAP,
                "spans": [spans.get(d, []) for d in range(n_docs)],
                "items": [sorted(found.get(d, ())) for d in range(n_docs)],
                "near_items": [sorted(near.get(d, ())) for d in range(n_docs)],
            }
        )

    return run


def _item_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list]:
    """The items with their words, in blocks of about ``block_words`` words at most."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))
    block, size = [], 0
    for row in items.toLocalIterator():
        words = plain_words(row["t"])
        if words:
            block.append((row["i"] if row["i"] is not None else "null", words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block or not size:
        yield block


def search(
    index: DataFrame,
    benchmark: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    size: int = WINDOW,
    slop: int = SLOP,
    block_words: int = QUERY_BLOCK_WORDS,
) -> DataFrame:
    """One row per indexed document: doc_id, n_words, spans, items, near_items.

    ``spans`` are the runs of words inside windows of items. ``items`` lists the items with such windows; ``near_items`` those of which a
    window's words lie, in any order, within ``size + slop`` words. Items with equal ids count as
    one item; a null id is named "null"; items without words match nothing.

    The benchmark is the query set: it is taken in blocks of bounded size, each sent to the
    tasks once and run against the whole index.
    """
    if size + slop > GAP:
        raise ValueError(f"size + slop must not exceed {GAP}")
    spark = index.sparkSession
    parts = []
    for block in _item_blocks(benchmark, item_id, text, block_words):
        terms = sorted({w for _, words in block for w in words})
        # at most block_words terms
        wanted = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in terms], "term binary"))
        rows = index.select("segment", "term", "postings", "doc_ids")
        chosen = rows.filter("term is not null").join(wanted, "term", "left_semi")
        rows = rows.filter("term is null").unionByName(chosen.select(rows.columns))
        parts.append(rows.groupBy("segment").applyInPandas(_search(block, size, slop), FOUND_SCHEMA))
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        _united(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )


def _united(spans: Column) -> Column:
    """Overlapping spans joined, in order."""
    none = F.array().cast(SPANS)

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last.start.alias("start"), F.greatest(last.stop, span.stop).alias("stop"))
        apart = (F.size(done) == 0) | (span.start > last.stop)
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        )

    return F.aggregate(F.array_sort(spans), none, add)


def n_hit(spans: Column) -> Column:
    """Words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s.stop - s.start)


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with exactly the columns of ``docs``.

    Rows are told apart by a hash of id and text, so equal rows share one verdict.
    """
    key = "_row_key"
    while key in docs.columns:
        key += "_"
    told = docs.withColumn(key, F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    with scratch(docs.sparkSession) as keep:
        found = search(build_index(told, key, text), benchmark, item_id, "text")
        hit = keep(found.filter(F.size("items") > 0).select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return told.join(hit, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
