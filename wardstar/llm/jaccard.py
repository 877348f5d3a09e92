"""Exact Jaccard join of word n-gram sets by PartEnum signatures.

Sets whose sizes lie in one band and that are similar enough differ in at most k elements. The
feature domain is cut into n1 parts: at least one part holds at most one of these elements. Each
part is cut into CELLS cells; of the CELLS ways to leave one cell out, one leaves out the element
that differs. So two similar sets share the signature (band, part, cell left out, what the set
has in the rest of the part). Sets close to the upper end of a band also sign for the next band.

1. Equal sets become one class; only class representatives sign.
2. Signatures are sorted by value. Groups of up to SMALL members give their pairs. A larger group
   gives its members, and is compared in blocks of bounded size.
3. Pairs are first held against a bit vector per set: bit i is the parity of the number of
   elements in cell i of a finer cutting. Vectors that differ in more bits than similar sets may
   differ in elements rule the pair out, and nothing else does.
4. The rest is verified by the exact sets. In larger groups only pairs between different
   components are: first the closest pairs that could join all members of a block, then, as
   long as there are any, pairs that could join components not yet tied.
5. A group beyond BLOCK members is tied together in parts dealt anew in every round, so that its
   members are taken once a round. If it is not one component then, it is cut into parts that
   meet one another; with more than MOST_PARTS parts, its sets sign a second time with another
   partition of the domain instead: similar members share a second signature too, and only
   members that do are compared. So no member is repeated more often than MOST_PARTS times or it
   has signatures.

So no list of all pairs in a group of near copies is ever made, and no link between components
is missed: every pair that a signature brings together is ruled out, verified, or inside one
component already.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.llm.components import components
from wardstar.llm.tasks import release, tidied
from wardstar.llm.words import BLANKS, raw
from wardstar.operators.joins import lookup_join
from wardstar.session import scratch, stage

SHINGLE = 4
PERCENT = 85
CELLS = 3
BAND = 1.25
SMALL = 4
BLOCK = 1024
DEALS = 4  # rounds in which the parts of a large group are dealt anew
MOST_PARTS = 32  # of a group whose parts meet one another; a set has about as many second signatures
MOST_BITS = 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S27, _S30, _S31 = np.uint64(27), np.uint64(30), np.uint64(31)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


# Words are hashed as sums of byte values times powers, all words of a text at once.
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = int(_MIX2)
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
PIECE_BYTES = 1 << 18


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text.

    The hash of a word is the sum of _VALUES[byte] * _BASE ** place over its bytes, taken from one
    running sum over the text by dividing by the power of the word's place, then scrambled together
    with its length. Long texts go in pieces that end between words.
    """

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << n.bit_length()
            step = np.full(n, _BASE, np.uint64)
            back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.powers, self.inverse = np.cumprod(step), np.cumprod(back)

    def words(self, data: bytes) -> np.ndarray:
        """A hash of each word."""
        out, at = [], 0
        codes = np.frombuffer(data, np.uint8)
        while at < len(codes):
            to = at + PIECE_BYTES
            if to < len(codes):
                gap = np.flatnonzero(_BLANK[codes[to : to + PIECE_BYTES]])
                while not len(gap) and to < len(codes):
                    to += PIECE_BYTES
                    gap = np.flatnonzero(_BLANK[codes[to : to + PIECE_BYTES]])
                to += int(gap[0]) if len(gap) else 0
            out.append(self._piece(codes[at:to]))
            at = to
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def _piece(self, codes: np.ndarray) -> np.ndarray:
        self._grow(len(codes))
        inside = np.zeros(len(codes) + 2, np.int8)
        np.logical_not(_BLANK[codes], out=inside[1:-1].view(bool))
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change > 0), np.flatnonzero(change < 0)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_VALUES[codes] * self.powers[: len(codes)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mixed(words + (ends - starts).astype(np.uint64) * _ODD)

    def __call__(self, text: str | None) -> np.ndarray:
        h = self.words(raw(text).lower())
        if not len(h):
            return h
        size = min(self.size, len(h))
        grams = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            grams *= _ODD
            grams += h[i : len(h) - size + 1 + i]
        grams = mixed(grams)
        grams.sort()
        fresh = np.ones(len(grams), bool)
        np.not_equal(grams[1:], grams[:-1], out=fresh[1:])
        return grams[fresh]


def far(a: int | np.ndarray, b: int | np.ndarray, percent: int = PERCENT) -> int | np.ndarray:
    """Elements in which sets of sizes a and b differ at most if they link."""
    return (100 - percent) * (a + b) // (100 + percent)


def parity_bits(n: int) -> int:
    """Length of the bit vector of a set of ``n`` elements: about two bits per element."""
    bits = 64
    while bits < 2 * n and bits < MOST_BITS:
        bits *= 2
    return bits


def sketch(grams: np.ndarray) -> bytes:
    bits = parity_bits(len(grams))
    cells = (mixed(grams ^ _ODD) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(cells, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def folded(rows: np.ndarray, bits: int) -> np.ndarray:
    """Bit vectors (one per row, as bytes) of the same sets with ``bits`` cells."""
    odd = np.unpackbits(rows, axis=1)
    odd = odd.reshape(len(rows), bits, -1).sum(axis=2).astype(np.uint8) & 1
    return np.packbits(odd, axis=1)


class Bands:
    """Size bands [lower, upper]; sizes whose similar sets are equal sets need no signature."""

    def __init__(self, percent: int = PERCENT, ratio: float = BAND):
        self.percent = percent
        self.lower = [1]
        self.ratio = ratio
        self.cut: dict[int, np.ndarray] = {}

    def upper(self, band: int) -> int:
        while len(self.lower) < band + 2:
            last = self.lower[-1]
            self.lower.append(max(last + 1, int(np.ceil(last * self.ratio))))
        return self.lower[band + 1] - 1

    def of(self, size: int) -> list[int]:
        while self.lower[-1] <= size:
            self.upper(len(self.lower) - 1)
        band = bisect_right(self.lower, size) - 1
        # the largest set that may link with this one
        most = size * 100 // self.percent
        return [b for b in ([band, band + 1] if most > self.upper(band) else [band]) if self.distance(b)]

    def edges(self, cells: int) -> np.ndarray:
        """Where the hash range is cut into ``cells`` equal parts."""
        if cells not in self.cut:
            self.cut[cells] = (np.arange(1, cells, dtype=np.float64) * (2.0**64 / cells)).astype(np.uint64)
        return self.cut[cells]

    def distance(self, band: int) -> int:
        return int(far(self.upper(band), self.upper(band), self.percent))


def signatures(grams: np.ndarray, bands: Bands, cells: int = CELLS, seed: int = 0) -> np.ndarray:
    """All signatures of one set (sorted distinct hashes); each ``seed`` is a partition of its own."""
    out = []
    if seed:
        grams = np.sort(mixed(grams ^ mixed(np.array([seed], np.uint64))))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams + _ODD), dtype=np.uint64)])
    for band in bands.of(len(grams)):
        parts = bands.distance(band) // 2 + 1
        edges = bands.edges(parts * cells)
        bounds = np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])
        cell = (sums[bounds[1:]] - sums[bounds[:-1]]).reshape(parts, cells)
        rest = cell.sum(axis=1, keepdims=True, dtype=np.uint64) - cell
        label = np.arange(parts * cells, dtype=np.uint64).reshape(parts, cells) + np.uint64(band << 40)
        out.append(mixed(rest + mixed(label * _ODD)).ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint64)


SETS_SCHEMA = "k bigint, n bigint, s1 bigint, s2 bigint, sketch binary"


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            n, s1, s2, bits = [], [], [], []
            for text in batch.column(1):
                grams = shingles(text.as_py())
                n.append(len(grams))
                s1.append(int(grams.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(mixed(grams).sum(dtype=np.uint64).view(np.int64)))
                bits.append(sketch(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(bits, pa.binary())],
                ["k", "n", "s1", "s2", "sketch"],
            )

    return run


def _sign(size: int, percent: int, cells: int, seed: int = 0):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands = Shingler(size), Bands(percent)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                made = [signatures(shingles(t.as_py()), bands, cells, seed) for t in piece.column(1)]
                nodes = np.repeat(piece.column(0).to_numpy(zero_copy_only=False), [len(m) for m in made])
                flat = np.concatenate([*made, np.empty(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(nodes, pa.int64())], ["sig", "node"])

    return run


def _gram_bytes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            sets = [shingles(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["k", "grams"])

    return run


GROUP_SCHEMA = "a bigint, b bigint, sig bigint, members bigint"  # members: null beyond BLOCK


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature: pairs (a, b) of small groups, members (a, sig) of larger ones.

    ``members`` is a hash of the nodes of the group, so that groups of the same nodes are known.
    A group beyond BLOCK members is passed on as it comes and never held; it has no such hash.
    """
    sig, node = np.empty(0, np.int64), np.empty(0, np.int64)
    passed: int | None = None
    for batch in batches:
        sig = np.concatenate([sig, batch.column(0).to_numpy()])
        node = np.concatenate([node, batch.column(1).to_numpy()])
        if passed is not None:
            same = int(np.searchsorted(sig, passed, "right"))
            if same:
                yield _members(node[:same], np.full(same, passed))
                sig, node = sig[same:], node[same:]
            if len(sig):
                passed = None
        if not len(sig):
            continue
        last = int(np.searchsorted(sig, sig[-1], "left"))
        yield from _complete(sig[:last], node[:last])
        sig, node = sig[last:], node[last:]
        if len(sig) > BLOCK:
            passed = int(sig[0])
            yield _members(node, sig)
            sig, node = sig[:0], node[:0]
    if passed is None:
        yield from _complete(sig, node)


def _members(node: np.ndarray, sig: np.ndarray, members: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(node), pa.int64())
    names = none if members is None else pa.array(members)
    return pa.RecordBatch.from_arrays([pa.array(node), none, pa.array(sig), names], ["a", "b", "sig", "members"])


def _complete(sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(sig) < 2:
        return
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(sig)]]))
    pairs = [np.empty((0, 2), np.int64)]
    for size in range(2, SMALL + 1):
        at = starts[sizes == size]
        pairs += [np.stack([node[at + i], node[at + j]], 1) for i in range(size) for j in range(i + 1, size)]
    found = np.concatenate(pairs)
    found = np.unique(np.sort(found, axis=1), axis=0)
    if len(found):
        none = pa.nulls(len(found), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), none, none], ["a", "b", "sig", "members"])
    rows, sigs, names, seen = [], [], [], set()
    for at, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own = np.sort(node[at : at + size])
        name = xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63)
        if name in seen:
            continue
        seen.add(name)
        rows.append(own)
        sigs.append(np.full(size, sig[at]))
        names.append(np.full(size, name))
    if rows:
        yield _members(np.concatenate(rows), np.concatenate(sigs), np.concatenate(names))


def _stacked(sketches: list[bytes]) -> np.ndarray:
    """Bit vectors of different lengths, folded to the shortest, one row each."""
    bits = 8 * min(map(len, sketches))
    out = np.empty((len(sketches), bits // 8), np.uint8)
    for length in set(map(len, sketches)):
        rows = [i for i, s in enumerate(sketches) if len(s) == length]
        block = np.frombuffer(b"".join(sketches[i] for i in rows), np.uint8).reshape(len(rows), length)
        out[rows] = block if 8 * length == bits else folded(block, bits)
    return out.view(np.uint64)


def _possible(percent: int):
    @F.pandas_udf("boolean")
    def possible(n1: pd.Series, s1: pd.Series, n2: pd.Series, s2: pd.Series) -> pd.Series:
        release()
        a, b = n1.to_numpy(), n2.to_numpy()
        good = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        lengths = np.minimum(s1.map(len).to_numpy(), s2.map(len).to_numpy())
        for length in np.unique(lengths[good]).tolist() if good.any() else []:
            rows = np.flatnonzero(good & (lengths == length))
            two = [_stacked([*column.iloc[rows], bytes(length)])[:-1] for column in (s1, s2)]
            apart = np.bitwise_count(two[0] ^ two[1]).sum(axis=1)
            good[rows] = apart <= far(a[rows], b[rows], percent)
        return pd.Series(good)

    return possible


JOIN_SCHEMA = "a bigint, b bigint, sig bigint, low int, high int, more boolean"


def _joining(percent: int, closest: bool):
    """Pairs that may link and join different components, from rows sorted by block.

    ``closest``: of each block only as many as could join all its components, closest first;
    ``more`` tells whether there are others. Otherwise all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = [table.column(c).to_numpy() for c in ("sig", "low", "high")]
            starts = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
            held = table.slice(int(starts[-1]))
            yield from _block_pairs(table.slice(0, int(starts[-1])), starts, percent, closest)
        if held is not None:
            yield from _block_pairs(held, np.zeros(1, np.int64), percent, closest)

    return run


def _block_pairs(table: pa.Table, starts: np.ndarray, percent: int, closest: bool) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    sig, low, high, side, node, n, label = (
        table.column(c).to_numpy() for c in ("sig", "low", "high", "side", "node", "n", "label")
    )
    sketches = table.column("sketch").to_pylist()
    starts = starts[starts < len(sig)]
    out: list[tuple] = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sig)], strict=True):
        own = label[a:b]
        if b - a < 2 or (own == own[0]).all():
            continue
        pairs = _close_pairs(_stacked(sketches[a:b]), n[a:b], own, side[a:b], percent)
        chosen = _forest(pairs[np.argsort(pairs[:, 2], kind="stable")], own) if closest and len(pairs) else pairs
        more = len(chosen) < len(pairs)
        for i, j, _ in chosen.tolist():
            x, y = int(node[a + i]), int(node[a + j])
            out.append((min(x, y), max(x, y), int(sig[a]), int(low[a]), int(high[a]), more))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    columns = zip(*out, strict=True) if out else [[]] * len(types)
    names = ["a", "b", "sig", "low", "high", "more"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _close_pairs(bits: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """(i, j, differing bits) of the rows of one block that may link across components."""
    found = []
    step = max(1, (1 << 20) // bits.size)
    for at in range(0, len(n) - 1, step):
        rows = slice(at, min(at + step, len(n) - 1))
        apart = np.bitwise_count(bits[rows, None] ^ bits[None, at:]).sum(axis=2, dtype=np.int64)
        a, b = n[rows, None], n[None, at:]
        good = (apart <= far(a, b, percent)) & (label[rows, None] != label[None, at:])
        good &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        if side[0] >= 0:  # two parts of one group: the pairs within a part are another block's
            good &= side[rows, None] != side[None, at:]
        i, j = np.nonzero(np.triu(good, 1))
        found.append(np.stack([i + at, j + at, apart[i, j]], 1))
    return np.concatenate(found)


def _forest(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Of sorted pairs, those that join components not joined by earlier ones."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, top)
        return top

    kept = []
    for row, (i, j) in enumerate(zip(label[pairs[:, 0]].tolist(), label[pairs[:, 1]].tolist(), strict=True)):
        x, y = root(i), root(j)
        if x != y:
            above[x] = y
            kept.append(row)
    return pairs[kept]


@F.pandas_udf(T.BooleanType())
def _links(ones: pd.Series, others: pd.Series, percent: pd.Series) -> pd.Series:
    """Whether a set of one side links with a set of the other."""
    release()
    out = []
    for xs, ys, p in zip(ones, others, percent, strict=True):
        sets = [[np.frombuffer(g, np.uint64) for g in side] for side in (xs, ys)]
        out.append(any(_similar(x, y, p) for x in sets[0] for y in sets[1]))
    return pd.Series(out, dtype=bool)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or not len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The (stored) pairs whose sets link; sets are made for their texts only."""
    ends = pairs.select(F.col("a").alias("k"), "a", "b").unionByName(pairs.select(F.col("b").alias("k"), "a", "b"))
    needed = stage(ends.select("k").distinct(), "gram-needed")
    texts = rows.join(needed, "k", "left_semi")
    grams = stage(texts.mapInArrow(tidied(_gram_bytes(size)), "k bigint, grams binary"), "grams")
    sides = grams.join(ends, "k").groupBy("a", "b").agg(
        F.collect_list(F.when(F.col("k") == F.col("a"), F.col("grams"))).alias("x"),
        F.collect_list(F.when(F.col("k") == F.col("b"), F.col("grams"))).alias("y"),
    )
    return sides.filter(_links("x", "y", F.lit(percent))).select("a", "b")


KEYS = ["sig", "low", "high"]


def _whole(members: DataFrame) -> DataFrame:
    """Members (sig, node) of groups of up to BLOCK: a group is a block."""
    zero = F.lit(0)
    return members.select("sig", zero.alias("low"), zero.alias("high"), F.lit(-1).alias("side"), "node")


def _cut(members: DataFrame, seed: int | None = None) -> DataFrame:
    """Members (sig, node) of groups beyond BLOCK with their part, and the number of parts."""
    counts = members.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    cut = lookup_join(members, counts, "sig", "inner", spread=["node"])
    dealt = F.xxhash64("node") if seed is None else F.xxhash64("node", F.lit(seed))
    return cut.withColumn("part", F.pmod(dealt, F.col("parts")).cast("int"))


def _blocks(cut: DataFrame) -> DataFrame:
    """Cut members with the blocks they are compared in: every two of a group meet once.

    Every two parts of a group are a block.
    """
    met = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least("part", p).alias("low"), F.greatest("part", p).alias("high")),
    )
    each = cut.withColumn("block", F.explode(met))
    side = F.when(F.col("block.low") == F.col("block.high"), -1).otherwise(F.col("part"))
    return each.select("sig", "block.low", "block.high", side.alias("side"), "node")


def _parts(members: DataFrame, seed: int) -> DataFrame:
    """Members of groups beyond BLOCK with one block each, a part of their group."""
    part = F.col("part")
    return _cut(members, seed).select("sig", part.alias("low"), part.alias("high"), F.lit(-1).alias("side"), "node")


def _still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of groups that are not one component."""
    held = lookup_join(members, labels.select("node", "component"), "node", "left", spread=["sig"])
    label = F.coalesce("component", "node")
    mixed_groups = held.groupBy("sig").agg(F.min(label).alias("least"), F.max(label).alias("most")).filter("least <> most")
    return lookup_join(members, stage(mixed_groups.select("sig"), "gram-mixed"), "sig", "inner", spread=["node"])


def _signed_again(members: DataFrame, rows: DataFrame, size: int, percent: int, cells: int) -> DataFrame:
    """Members of large groups (sig, node) by both signatures of a pair: sig is a hash of the two."""
    nodes = stage(members.select(F.col("node").alias("k")).distinct(), "gram-again")
    texts = rows.filter("k is not null").join(nodes, "k", "left_semi")
    second = texts.mapInArrow(tidied(_sign(size, percent, cells, 1)), "second bigint, node bigint")
    both = members.join(second, "node")
    return both.select(F.xxhash64("sig", "second").alias("sig"), "node").distinct()


def _candidates(blocks: DataFrame, nodes: DataFrame, labels: DataFrame | None, percent: int, closest: bool) -> DataFrame:
    """Rows of JOIN_SCHEMA for blocks that hold more than one component."""
    if labels is None:
        held = blocks.withColumn("label", F.col("node"))
    else:
        held = lookup_join(blocks, labels.select("node", "component"), "node", "left")
        held = held.withColumn("label", F.coalesce("component", "node")).drop("component")
    described = lookup_join(held, nodes, "node", "inner", keys_from=blocks.select("node"))
    ordered = described.repartition(*KEYS).sortWithinPartitions(*KEYS)
    return ordered.mapInArrow(tidied(_joining(percent, closest)), JOIN_SCHEMA)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    for side in ("a", "b"):
        named = labels.select(F.col("node").alias(side), F.col("component").alias(f"{side}_label"))
        pairs = lookup_join(pairs, named, side, "left")
    ends = [F.coalesce(f"{side}_label", side) for side in ("a", "b")]
    return pairs.filter(ends[0] != ends[1]).select("a", "b")


def _grouped(signed: DataFrame, nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of signed sets (sig, node): possible pairs of small groups, members (sig, node) of larger
    ones, and of those beyond BLOCK."""
    ordered = signed.repartition("sig").sortWithinPartitions("sig")
    groups = stage(ordered.mapInArrow(tidied(_groups), GROUP_SCHEMA), "gram-groups")
    pairs = groups.filter("sig is null").select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(*[F.col(c).alias(side if c == "node" else f"{c}_{side}") for c in nodes.columns]), side)
    close = pairs.filter(_possible(percent)("n_a", "sketch_a", "n_b", "sketch_b")).select("a", "b")
    larger = groups.filter("sig is not null").select(F.col("a").alias("node"), "sig", "members")
    named = larger.filter("members is not null")
    chosen = named.groupBy("members").agg(F.min("sig").alias("sig"))
    middle = named.join(chosen, ["members", "sig"], "left_semi").select("sig", "node")
    return close, middle, larger.filter("members is null").select("sig", "node")


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    cells: int = CELLS,
) -> DataFrame:
    """One row per document: k (its id), n (size of its set), component.

    Two documents link when ``100 * shared >= percent * union``; component is the smallest id
    reachable by links. A text without words, or null, has an empty set and links with nothing.
    Texts of fewer words than ``size`` have one element, the whole of them. Rows with a null id
    have no component and tie nothing. Rows that share an id are one document with several sets.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    sets = stage(rows.mapInArrow(tidied(_describe(size)), SETS_SCHEMA), "gram-sets")
    own = ["n", "s1", "s2"]
    known = sets.filter("n > 0 and k is not null")
    alike = stage(
        known.groupBy(*own).agg(
            F.min("k").alias("rep"), F.max("k").alias("last"), F.any_value("sketch").alias("sketch")
        ),
        "gram-classes",
    )
    # Only one text of each class signs. The others are named, as they are fewer; texts of small
    # sets, which only have equal sets to link with, have no signatures.
    several = stage(alike.filter("rep <> last").select(*own, "rep"), "gram-copies")
    copies = lookup_join(known.select("k", *own), several, own, "inner", spread=["k"])
    named = copies.filter("k <> rep").select("k").distinct()
    others = stage(named.join(alike.select(F.col("rep").alias("k")), "k", "left_anti"), "gram-others")
    texts = rows.filter("k is not null").join(others, "k", "left_anti")
    signed = texts.mapInArrow(tidied(_sign(size, percent, cells)), "sig bigint, node bigint")
    nodes = alike.select(F.col("rep").alias("node"), "n", "sketch")
    close, middle, large = _grouped(signed, nodes, percent)
    large = stage(large, "gram-large")
    blocks = stage(_whole(middle), "gram-blocks")

    made = stage(_candidates(blocks, nodes, None, percent, True), "gram-candidates")
    first = _candidates(_parts(large, 0), nodes, None, percent, True).select("a", "b")
    tested = stage(close.unionByName(made.select("a", "b")).unionByName(first).distinct(), "gram-pairs")

    # an id with several sets ties their classes
    twice = known.groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k")
    tied = known.join(twice, "k", "left_semi").join(alike.select(*own, "rep"), own)
    tied = tied.select(F.col("k").alias("a"), F.col("rep").alias("b"))
    links = stage(_verified(tested, rows, size, percent).unionByName(tied), "gram-links")
    labels = components(links)

    def verified(candidates: DataFrame) -> bool:
        """Tests candidate pairs that were not tested before; true if they tied anything."""
        nonlocal tested, links, labels
        more = stage(candidates.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "gram-pairs")
        if more.isEmpty():
            return False
        tested = stage(tested.unionByName(more), "gram-tested")
        found = stage(_verified(more, rows, size, percent), "gram-links")
        if found.isEmpty():
            return False
        links = links.unionByName(found)
        labels = components(links)
        return True

    for deal in range(1, DEALS):
        large = stage(_still_open(large, labels), "gram-large")
        if large.isEmpty():
            break
        if not verified(_candidates(_parts(large, deal), nodes, labels, percent, True)):
            break
    large = stage(_still_open(large, labels), "gram-large")
    if not large.isEmpty():
        cut = stage(_cut(large), "gram-cut")
        met, large = cut.filter(F.col("parts") <= MOST_PARTS), cut.filter(F.col("parts") > MOST_PARTS)
        close, middle, again = _grouped(_signed_again(large.select("sig", "node"), rows, size, percent, cells), nodes, percent)
        split = _blocks(met).unionByName(_whole(middle)).unionByName(_blocks(_cut(stage(again, "gram-large"))))
        split = stage(split, "gram-blocks")
        joined = stage(_candidates(split, nodes, labels, percent, True), "gram-candidates")
        verified(_apart(close, labels).unionByName(joined.select("a", "b")))
        blocks, made = blocks.unionByName(split), made.unionByName(joined)
    for closest in (True, False):
        # Pairs of a block join what its chosen pairs join. So a block has to be looked at again
        # only if it has further pairs and one of the chosen did not tie its ends.
        failed = stage(_apart(tested, labels), "gram-failed")
        again = made.filter("more").join(failed, ["a", "b"], "left_semi").select(*KEYS).distinct()
        open_ = stage(blocks.join(stage(again, "gram-again"), KEYS, "left_semi"), "gram-open")
        if open_.isEmpty():
            break
        made = stage(_candidates(open_, nodes, labels, percent, closest), "gram-candidates")
        verified(made)
    label = alike.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    label = label.withColumn("component", F.coalesce("component", "rep")).filter("rep <> last or component <> rep")
    placed = lookup_join(sets.drop("sketch"), stage(label.select(*own, "component"), "gram-labels"), own, "left", spread=["k"])
    return placed.select("k", "n", F.when(F.col("k").isNotNull(), F.coalesce("component", "k")).alias("component"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with its columns.

    Rows with a null id stay; of rows with one id, all stay or none.
    """
    key = "_dropped_id"
    while key in docs.columns:
        key += "_"
    with scratch(docs.sparkSession) as keep:
        found = classes(docs, doc_id, text)
        dropped = keep(found.filter("k <> component").select(F.col("k").alias(key)).distinct(), "gram-dropped")
    return docs.join(dropped, F.col(f"`{doc_id}`").cast("bigint") == F.col(key), "left_anti")
