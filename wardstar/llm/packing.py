"""Token ids in fixed-width bit-packed files.

A document's ids are those of the tokenizer for its whole text, followed by an end id. Files
hold the ids of consecutive documents in ascending document order, each id in the fewest bits
that the vocabulary needs, in blocks whose places are listed, so that any range of ids is
unpacked by a few numpy operations without reading what lies before it.

One file, all numbers little-endian:

    magic "BPK1", bits u32, block u32, part u32, number u32, documents u64, ids u64
    document ids     documents x i64, and documents x u8: 1 where the id is null
    document starts  (documents + 1) x u64, in ids from the start of the file
    block offsets    (blocks + 1) x u64, in bytes from the first block
    blocks           each holds ``block`` ids (the last fewer), lowest bit first
    trailer          "BPKE" (the record separator of the writer)

Files are written by Spark's own file writer, one record each, so that a lost executor or a
second attempt of a task leaves no half file, and read as whole files of bounded size.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstar.llm.tasks import give_back, tidied
from wardstar.session import fresh_path, stage

MAGIC, TRAILER = b"BPK1", b"BPKE"
HEAD = struct.Struct("<4sIIIIQQ")
BLOCK = 4096
FILE_IDS = 1 << 20
END_ID = 2
VOCABULARY = 50257
TOKENIZER = "byte_bpe_50k.json"
KNOWN_PIECES = 400_000
SLICE_BYTES = 4 << 20


def width(vocabulary: int) -> int:
    """Bits of the largest id; at least one."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, lowest bit first, filled up to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (flat.reshape(count, bits) * weights).sum(axis=1, dtype=np.uint32)


def build_file(
    doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, bits: int, part: int, number: int, block: int = BLOCK
) -> bytes:
    """The bytes of one file without its trailer."""
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = HEAD.pack(MAGIC, bits, block, part, number, len(doc_ids), len(ids))
    return b"".join([head, keys.tobytes(), nulls.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class PackedFile:
    """Random access to the ids of one file."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.bits, self.block, self.part, self.number, docs, self.n_ids = HEAD.unpack_from(self.data)
        if magic != MAGIC or bytes(self.data[-len(TRAILER) :]) != TRAILER:
            raise ValueError("not a whole packed file")
        at = HEAD.size
        self.doc_ids = np.frombuffer(self.data, "<i8", docs, at)
        self.nulls = np.frombuffer(self.data, np.uint8, docs, at := at + 8 * docs).astype(bool)
        self.starts = np.frombuffer(self.data, "<u8", docs + 1, at := at + docs)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(self.data, "<u8", n_blocks + 1, at := at + 8 * (docs + 1))
        self.blocks = self.data[at + 8 * (n_blocks + 1) : len(data) - len(TRAILER)]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive) of this file, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        parts = [
            unpack(
                self.blocks[int(self.offsets[b]) : int(self.offsets[b + 1])],
                min(self.block, self.n_ids - b * self.block),
                self.bits,
            )
            for b in range(first, last + 1)
        ]
        joined = np.concatenate(parts)
        return joined[start - first * self.block : stop - first * self.block]


# The pre-tokenizer of the vocabulary begins a new piece at every space that follows a character
# other than white space, or that ends a run of white space before another character. Texts
# without a space elsewhere can be cut at every space: the ids of the text are those of " word"
# after " word". Other texts are encoded in one piece.
_UNSAFE = r"[\s\x0b\x1c-\x1f\x85\p{Z}] (?:[\s\x0b\x1c-\x1f\x85\p{Z}]|$)"


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints,
    else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTE_LETTERS = byte_letters()
_L = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_P = re.escape("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_PARTS = re.compile(f"([{_L}]*)([{_P}]*)(?:\n([{_L}]+)([{_P}]*))?").fullmatch


class Encoder:
    """Ids of whole texts; each distinct word is encoded once while it is known.

    The pre-tokenizer cuts a word of Latin letters and ASCII marks after the letters, and a line
    end is a piece of its own: such pieces go straight to the library's model. Any other word
    goes through the whole library. At most KNOWN_PIECES words are remembered; then all are
    forgotten but those of the texts at hand, of which the frequent words are part.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.uint16 if VOCABULARY <= 1 << 16 else np.uint32)
        self.used = 0
        self.bounds = np.zeros(1, np.int32)
        self.ends: dict[str, list[int]] = {}

    def keep(self, keys: list[str]) -> None:
        """Forget all words but those of ``keys``, which are distinct."""
        known = [k for k in keys if k in self.place]
        old = np.fromiter(map(self.place.get, known), np.int64, len(known))
        lengths = self.bounds[old + 1] - self.bounds[old]
        bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        self.ids = self.ids[np.arange(bounds[-1]) + np.repeat(self.bounds[old] - bounds[:-1], lengths)]
        self.used, self.bounds = len(self.ids), bounds
        self.place = dict(zip(known, range(len(known)), strict=True))

    def _piece(self, piece: str, blank: str = "") -> list[int]:
        """Ids of ``piece`` after ``blank``; ASCII letters and marks stand for themselves."""
        if not piece.isascii() or piece == "\n":
            piece = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [token.id for token in self.tokenize("\u0120" + piece if blank else piece)]

    def _end(self, end: str) -> list[int]:
        ids = self.ends.get(end)
        if ids is None:
            ids = self.ends[end] = self._piece(end)
        return ids

    def _word(self, word: str, blank: str) -> list[int]:
        if word.isascii() and word.isalpha():
            return self._piece(word, blank)
        parts = _PARTS(word)
        if not parts:
            return self.tokenizer.encode(blank + word, add_special_tokens=False).ids
        letters, end, more, last = parts.groups()
        if not end and not more:
            return self._piece(letters, blank)
        if not letters:
            return self.tokenizer.encode(blank + word, add_special_tokens=False).ids
        at = self.place.get(blank + letters)
        ids = self._piece(letters, blank) if at is None else self.ids[self.bounds[at] : self.bounds[at + 1]].tolist()
        if end:
            ids = ids + self._end(end)
        if more:
            ids = ids + self._end("\n") + self._piece(more)
            if last:
                ids += self._end(last)
        return ids

    def learn(self, words: list[str], blank: str) -> np.ndarray:
        """The numbers of ``words``, which are distinct and follow ``blank``, encoding new ones."""
        keys = [blank + w for w in words] if blank else words
        numbers = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int32, len(keys))
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            word, new = self._word, fresh.tolist()
            found = [word(words[i], blank) for i in new]
            lengths = np.fromiter(map(len, found), np.int32, len(found))
            grown = self.used + int(lengths.sum())
            if grown > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.used], np.empty(grown + (1 << 16), self.ids.dtype)])
            self.ids[self.used : grown] = np.fromiter(chain.from_iterable(found), self.ids.dtype, grown - self.used)
            self.used = grown
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths, dtype=np.int32)])
            first = len(self.place)
            numbers[fresh] = np.arange(first, first + len(fresh))
            self.place.update(zip([keys[i] for i in new], range(first, first + len(fresh)), strict=True))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (nulls are empty) in order, and the number of ids of each."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, _UNSAFE)
        # a text that is not cut is one piece of its own
        cut = pc.if_else(whole, "", texts)
        lists = pc.split_pattern(cut, " ")
        starts = lists.offsets.to_numpy()
        words = lists.values.dictionary_encode()
        number = words.indices.to_numpy()
        first = starts[:-1]
        uncut = [t if w else c for t, w, c in zip(texts.to_pylist(), whole.to_pylist(), _firsts(lists), strict=True)]
        heads = list(dict.fromkeys(uncut))
        vocabulary = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        # before both calls, so that no number changes between them
        if len(self.place) + len(vocabulary) + len(heads) > KNOWN_PIECES:
            spaced = [" " + w for w in vocabulary]
            self.keep(list(dict.fromkeys([*spaced, *heads])))
        pieces = self.learn(vocabulary, " ")[number]
        short = [h for h in heads if len(h) <= 64]
        place = dict(zip(short, self.learn(short, "").tolist(), strict=True))
        ids, bounds = self.ids, self.bounds
        if len(short) < len(heads):
            long = [h for h in heads if len(h) > 64]
            tail = [np.array(self.tokenizer.encode(h, add_special_tokens=False).ids, ids.dtype) for h in long]
            place |= dict(zip(long, range(len(bounds) - 1, len(bounds) - 1 + len(long)), strict=True))
            bounds = np.concatenate([bounds, bounds[-1] + np.cumsum([len(t) for t in tail], dtype=np.int32)])
            ids = np.concatenate([ids[: self.used], *tail])
        pieces[first] = [place[h] for h in uncut]
        table = pa.LargeListArray.from_arrays(bounds.astype(np.int64), ids[: int(bounds[-1])])
        taken = table.take(pa.array(pieces))
        before = taken.offsets.to_numpy()
        return taken.values.to_numpy(), before[starts[1:]] - before[first]


def _firsts(lists: pa.LargeListArray) -> list[str]:
    return lists.values.take(pa.array(lists.offsets.to_numpy()[:-1])).to_pylist()


def _write_parts(path: str, bits: int, file_ids: int, remember: bool):
    """Turns the sorted documents of one partition into files of about ``file_ids`` ids each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what earlier tasks of this worker left
        # Millions of short-lived lists: counted references are enough for them.
        gc.disable()
        try:
            yield from files(batches)
        finally:
            if not remember:
                _ENCODERS.clear()
                _tokenizer.cache_clear()
            gc.enable()
            give_back()

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for piece in slices(batch, 1):
                flat, lengths = encoder.encode(piece.column(1))
                ends = np.cumsum(lengths)
                held.append(np.insert(flat, ends, END_ID))
                counts.append(lengths + 1)
                keys += piece.column(0).to_pylist()
                size += len(flat) + len(lengths)
                if size >= file_ids:
                    yield _file_row(keys, counts, held, bits, part, number)
                    keys, held, counts, size, number = [], [], [], 0, number + 1
        if keys:
            yield _file_row(keys, counts, held, bits, part, number)

    return run


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive slices of about ``most`` bytes of ``column``, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder per worker process: the pieces it knows serve all of its tasks."""
    return _ENCODERS.setdefault(path, Encoder(path))


def _file_row(keys, counts, held, bits, part, number) -> pa.RecordBatch:
    data = build_file(keys, np.concatenate(counts), np.concatenate(held), bits, part, number)
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])


def write_packed(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    vocabulary: int = VOCABULARY,
    file_ids: int = FILE_IDS,
    remember: bool = True,
) -> None:
    """Write the ids of all ``docs`` to packed files in ``folder``.

    Documents come in ascending order of ``doc_id`` (a whole number), nulls first; equal ids in
    the order of a hash of their texts. Null texts are empty: the end id alone. A table without
    rows gives no file. Texts are shuffled before encoding, as ids would take more room.

    With ``remember`` a worker process keeps the words it knows for its next task: less work,
    and some hundred MB a worker that other stages of a job may need.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    ordered = rows.repartitionByRange("k").sortWithinPartitions("k", F.xxhash64("t"))
    files = ordered.mapInArrow(_write_parts(path or tokenizer_path(), width(vocabulary), file_ids, remember), "value binary")
    (
        files.select(F.col("value").cast("string"))
        .write.option("lineSep", TRAILER.decode())
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


READ_SCHEMA = "part int, number int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            file = PackedFile(value.as_buffer())
            starts = file.starts.astype(np.int64)
            ids = memoryview(file.ids(0, file.n_ids).astype("<u4")).cast("B")
            docs = len(starts) - 1
            sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(docs, file.part, np.int32)),
                    pa.array(np.full(docs, file.number, np.int32)),
                    pa.array(file.doc_ids, mask=file.nulls),
                    pa.array(starts[:-1]),
                    pa.array(np.diff(starts)),
                    pa.array(sums, pa.int64()),
                ],
                READ_SCHEMA.replace(",", "").split()[::2],
            )


def read_packed(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files in ``folder``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: the start within the file, plus the
    earlier files of its part, plus the earlier parts. Only sums per file and per part are
    added up, never rows per document.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("content")
    docs = stage(files.mapInArrow(tidied(_read_files), READ_SCHEMA), "packed-docs")
    sizes = docs.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    in_part = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("p"))
    # one row per part of the range partitioning
    earlier = parts.select("part", (F.sum("p").over(Window.orderBy("part")) - F.col("p")).alias("earlier"))
    offsets = in_part.join(earlier, "part").select("part", "number", (F.col("before") + F.col("earlier")).alias("offset"))
    return docs.join(offsets, ["part", "number"]).select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def packed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, remember: bool = True
) -> DataFrame:
    """Write the ids of ``docs`` to packed files in the shared folder and read them back."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "packed-ids")
    write_packed(docs, folder, doc_id, text, path, remember=remember)
    return read_packed(spark, folder)
