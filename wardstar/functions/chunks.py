"""Cutting long texts into overlapping pieces at natural breaks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Default sizes and breaks, strongest break first.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 100
SEPARATORS = ("\n\n", "\n", ". ", " ", "")

OUT_CHARACTERS = 1_000_000  # of the chunks that a worker passes on at once


def _pieces(text: str, lo: int, hi: int, breaks: tuple[str, ...], size: int) -> Iterator[tuple[int, int]]:
    """Spans of at most ``size`` characters that cover ``lo..hi`` in order."""
    if hi - lo <= size:
        if hi > lo:
            yield lo, hi
        return
    separator, weaker = breaks[0], breaks[1:]
    if not separator:
        for at in range(lo, hi, size):
            yield at, min(at + size, hi)
        return
    at = lo
    while at < hi:
        found = text.find(separator, at, hi)
        end = hi if found < 0 else found + len(separator)
        yield from _pieces(text, at, end, weaker, size)
        at = end


def chunk_spans(
    text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, breaks: tuple[str, ...] = SEPARATORS
) -> list[tuple[int, int]]:
    """Spans of the chunks: whole pieces joined up to ``size``, repeating up to ``overlap``."""
    spans: list[tuple[int, int]] = []
    held: list[tuple[int, int]] = []
    for piece in _pieces(text, 0, len(text), breaks, size):
        if held and piece[1] - held[0][0] > size:
            spans.append((held[0][0], held[-1][1]))
            while held and (held[-1][1] - held[0][0] > overlap or piece[1] - held[0][0] > size):
                held.pop(0)
        held.append(piece)
    if held:
        spans.append((held[0][0], held[-1][1]))
    return spans


def chunk_documents(
    df: DataFrame, id_col: str, text_col: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """One row per chunk with its position and character span.

    A worker holds one document and some OUT_CHARACTERS of chunks beside the batch it was given.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            rows: list[tuple[int, int, int, int, str]] = []
            held = 0
            for at in range(batch.num_rows):
                text = texts[at].as_py()
                for i, (lo, hi) in enumerate(chunk_spans(text, size, overlap) if text else ()):
                    rows.append((at, i, lo, hi, text[lo:hi]))
                    held += hi - lo
                    if held >= OUT_CHARACTERS:
                        yield _batch(keys, rows, names)
                        rows, held = [], 0
            if rows:
                yield _batch(keys, rows, names)

    id_type = df.schema[id_col].dataType.simpleString()
    names = [id_col, "chunk_no", "start", "end", "chunk"]
    return df.select(id_col, text_col).mapInArrow(
        split, f"`{id_col}` {id_type}, chunk_no int, start int, end int, chunk string"
    )


def _batch(keys: pa.Array, rows: list[tuple[int, int, int, int, str]], names: list[str]) -> pa.RecordBatch:
    at, number, lo, hi, chunk = zip(*rows)
    ints = [pa.array(c, pa.int32()) for c in (number, lo, hi)]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(at)), *ints, pa.array(chunk, pa.string())], names)
