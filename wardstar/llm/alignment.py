"""Alignment of two tokenizers over exact-text classes.

Copies of a text are tokenised once: texts are shuffled whole and grouped, each distinct one is
encoded by both tokenizers, and what it adds to corpus counts is weighted by its number of
copies. Byte offsets where tokens of both sides end cut a text into groups; every pair of an A
and a B token inside one group is linked. The count of an id pair is the number of documents
that hold it linked.

Looking a count up for every pair of every text would shuffle all pairs twice. Instead, texts
are held in blocks of bounded size: a block lists each of its pairs once, texts name pairs by
their place in that list, and only the lists are shuffled, counted and sent back to the blocks.
A group of any size gives its distinct pairs with products of multiplicities, never all
occurrences. Every plan is the same at every size: no side is broadcast because it is small.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.packing import byte_letters, slices, tokenizer_path
from wardstar.operators.joins import lookup_join
from wardstar.session import stage

# The pieces that the pre-tokenizer of A cuts a text into.
PIECES_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLANK = "▁"

BLOCK_TOKENS = 1 << 18  # tokens of A after which a block is closed
SMALL_GROUP = 4096  # links of a group that are listed before equal ones are counted

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@dataclass
class Side:
    """Ids of texts under one tokenizer, and the bytes that each id stands for."""

    encode: object
    pieces: list[bytes]
    lengths: np.ndarray = field(init=False)
    names: list[str] = field(init=False)

    def __post_init__(self):
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.names = [str(i) for i in range(len(self.pieces))]

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@cache
def side_a(path: str) -> Side:
    """A byte-level vocabulary file. Ids of ordinary tokens follow the order of merges, so the
    vocabulary read as ranks gives the same ids as the file's own library, in a third of its time."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    special = {token["id"] for token in held.get("added_tokens", [])}
    ranks = {
        bytes(byte_of[c] for c in token): number
        for token, number in held["model"]["vocab"].items()
        if number not in special
    }
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, number in ranks.items():
        pieces[number] = piece
    ordinary = tiktoken.Encoding("a", pat_str=PIECES_A, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return Side(lambda text: ordinary(" " + text), pieces)


@cache
def side_b(path: str) -> Side:
    """A piece vocabulary file: it puts a blank before the text by itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def piece(i: int) -> bytes:
        name = model.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(BLANK, " ").encode()

    return Side(lambda text: model.encode(text, num_threads=1), [piece(i) for i in range(model.get_piece_size())])


@dataclass
class Aligned:
    """One text: ids of both sides, the tokens of each side before every group's end, and its
    distinct linked pairs (A id in the upper half) with their number of links."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    pairs: np.ndarray
    links: np.ndarray

    @property
    def n_links(self) -> int:
        return int(self.links.sum())


def _pairs(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first_a, first_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    n_a, n_b = ends_a - first_a, ends_b - first_b
    product = n_a * n_b
    single = product == 1
    codes = [(a[first_a[single]] << 32) | b[first_b[single]]]
    few = ~single & (product <= SMALL_GROUP)
    if few.any():
        size = product[few]
        group = np.repeat(np.arange(len(size)), size)
        inner = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
        width = n_b[few][group]
        codes.append((a[first_a[few][group] + inner // width] << 32) | b[first_b[few][group] + inner % width])
    large = np.flatnonzero(product > SMALL_GROUP)
    if not len(large):
        return np.unique(np.concatenate(codes), return_counts=True)
    times = [np.ones(sum(map(len, codes)), np.int64)]
    for g in large:
        ids_a, times_a = np.unique(a[first_a[g] : ends_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[first_b[g] : ends_b[g]], return_counts=True)
        codes.append(((ids_a[:, None] << 32) | ids_b).ravel())
        times.append((times_a[:, None] * times_b).ravel())
    pairs, place = np.unique(np.concatenate(codes), return_inverse=True)
    return pairs, _exact(place, np.concatenate(times))


def _exact(place: np.ndarray, links: np.ndarray) -> np.ndarray:
    out = np.zeros(int(place.max()) + 1, np.int64)
    np.add.at(out, place, links)
    return out


def align(text: str | None, a: Side, b: Side) -> Aligned | None:
    """The alignment of one text; None for a text without tokens: null, empty, or one that the
    tokens of a side do not spell byte for byte."""
    if not text:
        return None
    spelled = (" " + text).encode("utf-8", "surrogatepass")
    ids_b = b.encode(text)
    if b.bytes_of(ids_b) != spelled:
        return None
    ids_a = a.encode(text)
    if a.bytes_of(ids_a) != spelled:
        return None
    ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    shared = np.zeros(len(spelled) + 1, bool)
    shared[ends_a] = True
    meets = shared[ends_b]
    places = np.flatnonzero(meets) + 1
    last_a = np.searchsorted(ends_a, ends_b[meets], "right")
    return Aligned(ids_a, ids_b, last_a, places, *_pairs(ids_a, ids_b, last_a, places))


def groups_text(found: Aligned, a: Side, b: Side) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group, in order."""
    names_a, names_b = [a.names[i] for i in found.a.tolist()], [b.names[i] for i in found.b.tolist()]
    out, p, q = [], 0, 0
    for x, y in zip(found.ends_a.tolist(), found.ends_b.tolist()):
        if x - p == 1 == y - q:
            out.append(f"{names_a[p]}|{names_b[q]}")
        else:
            out.append(f"{','.join(names_a[p:x])}|{','.join(names_b[q:y])}")
        p, q = x, y
    return ";".join(out)


_ROW = pa.schema(
    [
        ("block", pa.int64()),
        ("text_key", pa.binary()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("places", pa.binary()),
        ("links", pa.binary()),
        ("a", pa.list_(pa.int32())),
        ("b", pa.list_(pa.int32())),
        ("documents", pa.list_(pa.int64())),
    ]
)
_ROW_DDL = (
    "block bigint, text_key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "places binary, links binary, a array<int>, b array<int>, documents array<bigint>"
)


def _block_rows(block: int, texts: list[tuple[bytes, int, Aligned, str]]) -> pa.RecordBatch:
    """A row per text, and one that lists the block's pairs with the documents that hold them."""
    pairs, place = np.unique(np.concatenate([t[2].pairs for t in texts]), return_inverse=True)
    copies = np.repeat([t[1] for t in texts], [len(t[2].pairs) for t in texts])
    documents = _exact(place, copies)
    rows, at = [], 0
    for key, _, found, digest in texts:
        to = at + len(found.pairs)
        small = int(found.links.max()) < 256
        rows.append(
            {
                "block": block,
                "text_key": key,
                "n_a": len(found.a),
                "n_b": len(found.b),
                "n_groups": len(found.ends_a),
                "n_links": found.n_links,
                "groups_sha256": digest,
                "places": place[at:to].astype("<u4").tobytes(),
                "links": found.links.astype("u1" if small else "<i8").tobytes(),
            }
        )
        at = to
    rows.append({"block": block, "a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "documents": documents})
    return pa.RecordBatch.from_pylist(rows, _ROW)


def _aligner(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side_a(path_a), side_b(path_b)
        first, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[bytes, int, Aligned, str]] = []
        tokens = 0
        for batch in batches:
            for piece in slices(batch, 0):
                for text, key, copies in zip(*(c.to_pylist() for c in piece.columns)):
                    found = align(text, a, b)
                    if found is None:
                        continue
                    digest = hashlib.sha256(groups_text(found, a, b).encode()).hexdigest()
                    held.append((key, copies, found, digest))
                    tokens += len(found.a)
                    if tokens >= BLOCK_TOKENS:
                        yield _block_rows(first + number, held)
                        held, tokens, number = [], 0, number + 1
        if held:
            yield _block_rows(first + number, held)

    return run


def _measured(texts: pa.Table, known: pa.Table) -> pa.Table:
    """Texts of one block with the measures that need the counts of its pairs."""
    place = known.column("place").to_numpy()
    counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    counts[place], best[place] = known.column("count").to_numpy(), known.column("best").to_numpy()
    n_best, total = [], []
    for places, links, n in zip(
        texts.column("places").to_pylist(), texts.column("links").to_pylist(), texts.column("n_links").to_pylist()
    ):
        at = np.frombuffer(places, "<u4")
        times = np.frombuffer(links, "u1" if len(links) == len(at) else "<i8").astype(np.int64)
        n_best.append(int(times @ best[at]))
        total.append(int(times @ counts[at]))
    kept = texts.select(["text_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
    return kept.append_column("count_sum", pa.array(total, pa.int64()))


_MEASURED_DDL = (
    "text_key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "n_best bigint, count_sum bigint"
)


def text_key(text: Column) -> Column:
    """A strong digest of a text; null for null and empty texts."""
    return F.when(F.octet_length(text) > 0, F.unhex(F.sha2(text.cast("binary"), 256)))


def aligned_texts(
    docs: DataFrame, text: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B
) -> DataFrame:
    """Stored rows of texts and of pair lists by block (see the module), each distinct text once.

    Equal texts are combined before they are shuffled, so one with any number of copies is one
    row a task.
    """
    content = F.col(f"`{text}`")
    once = docs.filter(F.octet_length(content) > 0).groupBy(content.alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    rows = once.select("text", text_key(F.col("text")).alias("text_key"), "copies")
    return stage(rows.mapInArrow(_aligner(tokenizer_path(a), tokenizer_path(b)), _ROW_DDL), "align-texts")


def pair_lists(aligned: DataFrame) -> DataFrame:
    """Columns block, place, a, b, documents: the pairs of every block."""
    lists = aligned.filter(F.col("a").isNotNull())
    return lists.select("block", F.posexplode(F.arrays_zip("a", "b", "documents")).alias("place", "p")).select(
        "block", "place", "p.a", "p.b", "p.documents"
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Columns a, b, count (documents that hold the pair linked), best (1 if no other pair of the A id counts more).

    An A id meets at most as many B ids as B's vocabulary has, which bounds its group.
    """
    counts = pair_lists(aligned).groupBy("a", "b").agg(F.sum("documents").alias("count"))
    most = F.max("count").over(Window.partitionBy("a"))
    return stage(counts.withColumn("best", (F.col("count") == most).cast("bigint")), "align-counts")


def token_alignment(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B
) -> DataFrame:
    """A row per row of ``docs``: k (id), n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that a tokenizer does not spell byte for byte (its
    normalisation changed them, or they hold U+2581), have no tokens: zeros and an empty digest.
    They count nowhere. Ids may be null or repeated: each row counts as one document. A text may
    have any length; one whose tokens exceed a block is a block of its own.
    """
    aligned = aligned_texts(docs, text, a, b)
    known = lookup_join(pair_lists(aligned), pair_counts(aligned), ["a", "b"], "inner", spread=["block"], broadcast=False)
    texts = aligned.filter(F.col("text_key").isNotNull()).drop("a", "b", "documents")
    listed = known.select(F.col("block").alias("in_block"), "place", "count", "best")
    by_block = texts.groupBy("block").cogroup(listed.groupBy("in_block"))
    measured = stage(by_block.applyInArrow(_measured, _MEASURED_DDL), "align-measures")
    keyed = docs.select(F.col(f"`{doc_id}`").alias("k"), text_key(F.col(f"`{text}`")).alias("text_key"))
    found = lookup_join(keyed, measured, "text_key", "left", spread=["k"], broadcast=False)
    return found.select(
        "k",
        *[F.coalesce(m, F.lit(0).cast("bigint")).alias(m) for m in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
