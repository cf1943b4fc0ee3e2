"""SimHash near-duplicates: a binary-trie self-join of the fingerprints within a Hamming budget.

Fingerprints are made in one pass over the texts and stored with the ids; from then on only distinct fingerprints
are compared.  The bits are cut into one block more than the budget, so two fingerprints within the budget agree in
a block: each fingerprint goes into one trie per block, rotated so that this block comes first, and there two nodes
may only differ below the block.  The nodes of the first ``depth`` levels are the groups: each fingerprint is sent
as often as there are blocks, however many there are.  Within a group a node pair carries the number of differing
bits so far, its four child pairs are made at once, and those over the budget are dropped; small node pairs are
compared directly.  A group of more than ``crowd`` fingerprints is not joined in one task: it is first taken
``STEP`` levels down to the node pairs within the budget, again and again until none is crowded.  One that still is at
the last levels (sketches alike in a whole table) is cut into blocks, and each pair of blocks is a task of its own.

A group sends no list of all its links, but a spanning forest of them, so a crowd of near copies gives as many rows
as it has fingerprints.  Components over those rows come from alternating large-star and small-star rounds, each
written to the shared folder.

``near_duplicates`` links at a number of differing bits.  ``similar_groups`` links at a Jaccard similarity of the
shingle sets: a wider sketch has several tables, a pair within the budget in any table and within ``FAR`` bits over
all is a candidate, a group sends a spanning forest of its candidates of least distance, and each link of that is
verified by the sets themselves.  That joins nearly all; an exact check follows: sets of different components that share
a shingle of their prefixes (so long that sets of that similarity must) are candidates too, so no link is lost.

Defined results: null text is empty; a text without words has fingerprint zero and links like any other (its set is
empty and similar to empty sets only); repeated rows get a row each and the same component; rows with null doc_id are
carried and take part, and a component of only such rows has a null id; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import CHARS, dropped, partitions, slices, stored, texts_of, trimmed

BUDGET = 3
#: Fingerprints that a group should hold if they are spread evenly, and above which it is taken further down.
GROUP, CROWD, STEP = 1 << 13, 1 << 17, 4
LEAF = 64
#: The sketch for similarities: tables of ``WIDTH`` bits, and differing bits in all of it that a candidate may have.
#: At a Jaccard similarity of 0.8 a bit differs with probability 0.15: 39 of 256, standard deviation 6.
TABLES, WIDTH, FAR = 8, 32, 58
#: Differing bits of the sketch up to which two neighbours in a group are linked at once; node pairs of one such crowd
#: are not looked into.  24 of 256 stand for a Jaccard similarity of 0.92, three standard deviations from 0.8.
NEAR = 24
#: Rows that the order of prefixes is taken from, and common shingles in it at most.
ORDER_ROWS, ORDER_MOST = 1 << 13, 50_000
#: Rows of each side of a shingle that meet in one task at most, and pairs that a task holds at once.
BLOCK, PAIRS = 1 << 13, 1 << 20
#: Pairs up to which the ids whose texts are needed go to all tasks; beyond that the texts are shuffled.
SENT = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(texts: list[str], size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each shingle of each text, and each text's offsets."""
    from xxhash import xxh64_intdigest as h

    coded = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join([*coded, b""]), np.uint8)
    text_end = np.cumsum(np.fromiter((len(c) + 1 for c in coded), np.int64, len(coded)))
    blank = _BLANK[raw]
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # one blank after each word
    even = np.where(blank, np.uint8(32), _LOWER[raw])[keep]
    ends = np.flatnonzero(even == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else ends
    at = np.flatnonzero(keep)[starts] if len(starts) else starts
    word = np.searchsorted(at, np.concatenate([[0], text_end]))  # first word of each text
    n = np.diff(word)
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    off = np.concatenate([[0], np.cumsum(many)])
    first = np.repeat(word[:-1] - off[:-1], many) + np.arange(off[-1])
    last = np.minimum(first + size - 1, np.repeat(word[1:] - 1, many))
    buf = even.tobytes()
    hashes = np.fromiter((h(buf[a:b], 42) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, int(off[-1]))
    return hashes, off


def majority(hashes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The 64-bit fingerprint of each text: bits set in over half of its hashes."""
    out = np.zeros(len(off) - 1, np.uint64)
    n = np.diff(off)
    full = np.flatnonzero(n)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, off[full], axis=0, dtype=np.int32)
        set_ = sums * 2 > n[full][:, None]
        out[full] = np.packbits(set_, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Other 64-bit hashes of what was hashed, for k = 1, 2, ...; k = 0 gives the hashes themselves."""
    if not k:
        return hashes
    z = hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                fp = majority(*shingle_hashes(texts_of(part), size))
                yield pa.record_batch([part.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


class Forest:
    """Union-find over positions of an array; the root of a set is its smallest position."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while True:
            two = self.up[r]
            if (two == r).all():
                self.up[x] = r
                return r
            r = two

    def roots(self) -> np.ndarray:
        return self.find(np.arange(len(self.up)))

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Join the sets of a[i] and b[i] for every i; returns the i that joined two sets."""
        at, used = np.arange(len(a)), [np.empty(0, np.int64)]
        while len(at):
            x, y = self.find(a[at]), self.find(b[at])
            differ = x != y
            at, x, y = at[differ], x[differ], y[differ]
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            roots, first = np.unique(high[order], return_index=True)  # each root goes below one smaller root
            edge = order[first]
            self.up[roots] = low[edge]
            used.append(at[edge])
        return np.concatenate(used)


def _leaf(a, b, alo, ahi, blo, bhi, budget: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) within the budget, of all pairs of the given ranges."""
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    pair = np.repeat(np.arange(len(n)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    i, j = alo[pair] + k // nb[pair], blo[pair] + k % nb[pair]
    ok = np.bitwise_count(a[i] ^ b[j]) <= budget
    if same:
        ok &= i < j
    return i[ok], j[ok]


def trie_join(
    a: np.ndarray, b: np.ndarray | None, depth: int = 0, differ: int = 0, budget: int = BUDGET, agree: int = 0, width: int = 64, crowds: tuple[np.ndarray, np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions of the sorted arrays a and b (None: a with itself) within ``budget`` differing bits.

    All of a share their first ``depth`` bits, so do all of b, and the two prefixes differ in ``differ`` bits.  Only the
    first ``width`` bits count.  Pairs that differ in their first ``agree`` bits are not looked for.  ``crowds`` numbers
    the positions of a and of b: a pair of nodes of one and the same number is passed over.
    """
    same = b is None
    b = a if same else b
    runs = [np.concatenate([[0], np.cumsum(c[1:] != c[:-1])]) for c in crowds] if crowds and len(a) and len(b) else None
    if not len(a) or not len(b):
        return
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def level(d: int) -> tuple[np.ndarray, np.ndarray]:
        if d not in ones:
            ones[d] = tuple(np.concatenate([[0], np.cumsum(x >> np.uint64(63 - d) & np.uint64(1))]).astype(np.int64) for x in (a, b))
        return ones[d]

    one = lambda x: np.array([x], np.int64)
    stack = [(depth, one(0), one(len(a)), one(0), one(len(b)), one(differ))]
    while stack:
        d, alo, ahi, blo, bhi, e = stack.pop()
        if runs:
            (ca, cb), (ra, rb) = crowds, runs
            mixed = (ra[alo] != ra[ahi - 1]) | (rb[blo] != rb[bhi - 1]) | (ca[alo] != cb[blo])
            alo, ahi, blo, bhi, e = alo[mixed], ahi[mixed], blo[mixed], bhi[mixed], e[mixed]
        small = ((ahi - alo) * (bhi - blo) <= LEAF) | (d == width)
        for k in range(0, int(small.sum()), 20_000):
            s = np.flatnonzero(small)[k : k + 20_000]
            yield _leaf(a, b, alo[s], ahi[s], blo[s], bhi[s], budget, same)
        go = ~small
        if not go.any():
            continue
        alo, ahi, blo, bhi, e = alo[go], ahi[go], blo[go], bhi[go], e[go]
        ca, cb = level(d)
        am, bm = ahi - (ca[ahi] - ca[alo]), bhi - (cb[bhi] - cb[blo])
        twin = (alo == blo) & (ahi == bhi) if same else np.zeros(len(alo), bool)
        kids = [
            (alo, am, blo, bm, e, ~np.zeros(len(e), bool)),
            (am, ahi, bm, bhi, e, ~np.zeros(len(e), bool)),
            (alo, am, bm, bhi, e + 1, ~np.zeros(len(e), bool)),
            (am, ahi, blo, bm, e + 1, ~twin),  # of a node with itself this is the same pair as the one before
        ]
        cols = [np.concatenate([k[c] for k in kids]) for c in range(6)]
        ok = cols[5] & (cols[0] < cols[1]) & (cols[2] < cols[3]) & (cols[4] <= (budget if d >= agree else differ))
        cols = [c[ok] for c in cols[:5]]
        for k in range(0, len(cols[0]), 100_000):
            stack.append((d + 1, *(c[k : k + 100_000] for c in cols)))


def _rotated(bits: Column, by: int, width: int) -> Column:
    """The low ``width`` bits rotated left, at the top of a long."""
    turned = F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, width - by)) if by else bits
    return F.shiftleft(turned, 64 - width) if width < 64 else turned


def dealt(reps: DataFrame, tables: list[Column], width: int, budget: int, depth: int) -> DataFrame:
    """``reps`` once per table and block: t (which), r (rotated bits), and its group at ``depth``: the node lo = hi."""
    block = width // (budget + 1)
    each = [F.struct(F.lit(t * (budget + 1) + k).alias("t"), _rotated(bits, k * block, width).alias("r")) for t, bits in enumerate(tables) for k in range(budget + 1)]
    node = F.shiftrightunsigned("x.r", 64 - depth)
    return reps.withColumn("x", F.explode(F.array(*each))).select(*reps.columns, "x.t", "x.r", node.alias("lo"), node.alias("hi"), F.lit(False).alias("side"))


def taken_down(work: DataFrame, depth: int, budget: int, agree: int) -> DataFrame:
    """The rows of groups of nodes of ``depth`` dealt to the node pairs ``STEP`` levels further down, within the budget."""
    masks = [m for m in range(1 << STEP) if m.bit_count() <= budget and not any(m >> (STEP - 1 - i) & 1 and depth + i < agree for i in range(STEP))]
    bits = F.shiftrightunsigned("r", 64 - depth - STEP).bitwiseAND(F.lit((1 << STEP) - 1))
    own = F.shiftleft(F.when(F.col("side"), F.col("hi")).otherwise(F.col("lo")), STEP).bitwiseOR(bits)
    other = F.shiftleft(F.when(F.col("side"), F.col("lo")).otherwise(F.col("hi")), STEP).bitwiseOR(bits.bitwiseXOR(F.col("m")))
    rest = [c for c in work.columns if c not in ("lo", "hi", "side")]
    each = work.withColumn("m", F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))).select(*rest, own.alias("own"), other.alias("other"))
    near = each.where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= budget)
    return near.select(*rest, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("side"))


def in_blocks(work: DataFrame, crowded: DataFrame, crowd: int) -> DataFrame:
    """The rows of the groups ``crowded`` (key, n), that have no levels left, once for each pair of blocks (a, b) with theirs.

    A group has so many blocks that two hold about ``crowd`` rows, and any two of its rows meet in some pair of blocks.
    """
    blocks = F.ceil(2 * F.col("n") / crowd).cast("int")
    own = F.pmod(F.xxhash64(*[c for c in work.columns if c not in ("t", "lo", "hi", "side")]), F.col("blocks")).cast("int")
    each = work.join(crowded.withColumn("blocks", blocks), ["t", "lo", "hi"]).withColumn("own", own)
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("own")))
    return each.select(*work.columns, "own", other.alias("other")).select(*work.columns, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))


def grouped_links(work: DataFrame, depth: int, width: int, budget: int, crowd: int, join: Callable[[int], Callable], out: str) -> DataFrame:
    """What ``join`` of the depth finds in each group; crowded groups are taken down first, and at the last level cut into blocks."""
    key, agree, parts = ["t", "lo", "hi"], width // (budget + 1), []
    while True:
        crowded = stored(work.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > crowd), "crowded")
        if crowded.isEmpty():
            parts.append(work.groupBy(*key).applyInArrow(join(depth), out))
            break
        parts.append(work.join(crowded, key, "left_anti").groupBy(*key).applyInArrow(join(depth), out))
        if depth + STEP >= width:
            parts.append(in_blocks(work, crowded, crowd).groupBy(*key, "a", "b").applyInArrow(join(depth), out))
            break
        work = stored(taken_down(work.join(crowded.select(*key), key, "left_semi"), depth, budget, agree), "nodes")
        depth += STEP
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def _in_group(key: tuple, table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """(order of the rows of a group by side and bits, the bits in that order, how many rows have the first side)."""
    r, side = table.column("r").to_numpy().view(np.uint64), table.column("side").to_numpy()
    order = np.lexsort((r, side))
    return order, r[order], int((~side).sum())


def _pairs(key: tuple, bits: np.ndarray, n: int, depth: int, width: int, budget: int, crowds: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places within the budget: of a node with itself, or of the two nodes of the group."""
    lo, hi = key[1].as_py(), key[2].as_py()
    agree = width // (budget + 1)
    if lo == hi:
        yield from trie_join(bits, None, depth, 0, budget, agree, width, None if crowds is None else (crowds, crowds))
    else:
        split = None if crowds is None else (crowds[:n], crowds[n:])
        for i, j in trie_join(bits[:n], bits[n:], depth, (lo ^ hi).bit_count(), budget, agree, width, split):
            yield i, j + n


def depth_for(n: int, group: int, block: int) -> int:
    return max(1, min(block, int(np.ceil(np.log2(max(1, n) / group)))))


def links(reps: DataFrame, budget: int = BUDGET, group: int = GROUP, crowd: int = CROWD) -> DataFrame:
    """Spanning links (u, v) between the distinct fingerprints of ``reps`` (fp), group by group."""
    depth = depth_for(reps.count(), group, 64 // (budget + 1))

    def join(d: int) -> Callable:
        def run(key: tuple, table: pa.Table) -> pa.Table:
            order, bits, n = _in_group(key, table)
            fp, forest = table.column("fp").to_numpy()[order], Forest(len(order))
            for i, j in _pairs(key, bits, n, d, 64, budget):
                forest.join(i, j)
            root = forest.roots()
            linked = np.flatnonzero(root != np.arange(len(root)))
            return pa.table({"u": fp[linked], "v": fp[root[linked]]})

        return run

    rows = dealt(reps.select("fp"), [F.col("fp")], 64, budget, depth)
    return grouped_links(rows, depth, 64, budget, crowd, join, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the root is the smallest node of its component."""
    e = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    facts = None
    while True:
        both = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        before, e = e, stored(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        dropped(before)
        now = tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == facts:
            break
        facts = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, budget: int = BUDGET, size: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    marked = stored(fingerprints(docs, size), "fingerprints")
    reps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "reps")
    comp = components(links(reps.select("fp"), budget)).withColumnRenamed("node", "fp")
    rooted = reps.join(comp, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def common_shingles(docs: DataFrame, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sorted; how often) of the commonest shingles of about ``ORDER_ROWS`` rows: they come last in prefixes.

    Prefixes are exact in any order; this one keeps passages that many texts share out of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                hashes, off = shingle_hashes(texts_of(part), size)
                sets = [np.unique(hashes[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.record_batch([pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))], names=["h"])

    some = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, docs.count() // ORDER_ROWS))) == 0
    found = docs.where(some).select("doc_id", "text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2")
    rows = found.orderBy(F.col("n").desc(), "h").limit(ORDER_MOST).collect()
    h, n = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def prefix_of(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray], part: int) -> np.ndarray:
    """The first shingles of a set (sorted), rare ones first: of two sets with ``part`` thousandths in common, one is in both."""
    n, (h, often) = len(shingles), common
    at = np.minimum(np.searchsorted(h, shingles), max(0, len(h) - 1))
    rank = np.where(h[at] == shingles, often[at], 0) if len(h) else np.zeros(n, np.int64)
    return shingles[np.argsort(rank, kind="stable")][: n - (part * n + 999) // 1000 + 1 if n else 0]


def parities(shingles: np.ndarray) -> np.ndarray:
    """One to two bits a member, 256 at least, in words: whether an odd number of the set falls on each.

    They differ in no more bits than the sets in members.  A fixed number of bits says nothing of sets that are larger:
    half of them differ whatever the sets.
    """
    size = max(256, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def parities_apart(a: np.ndarray, b: np.ndarray) -> int:
    """In how many bits two sets' parities differ, at the length of the shorter: a half falls on the other."""
    if len(a) < len(b):
        a, b = b, a
    apart = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0) ^ b
    return int(np.bitwise_count(apart.view(np.uint64)).sum())  # of signed numbers it counts the bits of the amount


def sketches(docs: DataFrame, size: int = 5, share: int = 800) -> DataFrame:
    """(doc_id, node, w0 .. w3, n, prefix, odd) of every row: a hash of its set of shingles, its sketch; the set's size, prefix and parities."""
    words, common = TABLES * WIDTH // 64, common_shingles(docs, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as h

        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                hashes, off = shingle_hashes(texts_of(part), size)
                sets = [np.unique(hashes[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                node = np.array([h(x.tobytes()) for x in sets], np.uint64)
                cols = [majority(remixed(hashes, k), off).view(np.int64) for k in range(words)]
                first = pa.array([prefix_of(x, common, share).view(np.int64) for x in sets], pa.list_(pa.int64()))
                odd = pa.array([parities(x) for x in sets], pa.list_(pa.int64()))
                every = [part.column(0), pa.array(node.view(np.int64)), *map(pa.array, cols), pa.array([len(x) for x in sets], pa.int64()), first, odd]
                yield pa.record_batch(every, names=["doc_id", "node", *(f"w{k}" for k in range(words)), "n", "prefix", "odd"])

    out = "doc_id long, node long, " + ", ".join(f"w{k} long" for k in range(words)) + ", n long, prefix array<long>, odd array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, out)


def shingle_sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """(node, shingles): the distinct shingle hashes of each row of ``docs`` (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                hashes, off = shingle_hashes(texts_of(part), size)
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.record_batch([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return docs.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def _neighbours(bits: np.ndarray, n: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places next to each other in the order of the bits below ``depth``: within a side, and across the two."""
    k = np.arange(len(bits) - 1)
    k = k[k != n - 1]
    if n == len(bits):
        return k, k + 1
    a, b = (x << np.uint64(depth) for x in (bits[:n], bits[n:]))
    at = np.searchsorted(b, a)
    across = [(np.arange(n)[at < len(b)], at[at < len(b)] + n), (np.arange(n)[at > 0], at[at > 0] - 1 + n)]
    return np.concatenate([k, *(x for x, _ in across)]), np.concatenate([k + 1, *(y for _, y in across)])


def _nearest_forest(size: int, a: np.ndarray, b: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The edges of a spanning forest of least distance, their distances, and the root of each place."""
    forest, keep = Forest(size), [np.empty(0, np.int64)]
    for level in np.unique(dist):
        at = np.flatnonzero(dist == level)
        keep.append(at[forest.join(a[at], b[at])])
    keep = np.concatenate(keep)
    return a[keep], b[keep], dist[keep], forest.roots()


def candidate_links(reps: DataFrame, budget: int = BUDGET, group: int = GROUP, crowd: int = CROWD, far: int = FAR) -> DataFrame:
    """(u, v): in each group of each table a spanning forest, of least distance, of the node pairs within the budget and ``far``."""
    words = [c for c in reps.columns if c != "node"]
    tables = [F.shiftrightunsigned(w, 64 - WIDTH * (k + 1)).bitwiseAND(F.lit((1 << WIDTH) - 1)) for w in words for k in range(64 // WIDTH)]
    depth = depth_for(reps.count(), group, WIDTH // (budget + 1))

    def join(d: int) -> Callable:
        def run(key: tuple, table: pa.Table) -> pa.Table:
            order, bits, n = _in_group(key, table)
            node, sketch = table.column("node").to_numpy()[order], [table.column(w).to_numpy().view(np.uint64)[order] for w in words]
            apart = lambda i, j: sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in sketch)
            i, j = _neighbours(bits, n, d)
            dist = apart(i, j)
            i, j, dist = i[dist <= NEAR], j[dist <= NEAR], dist[dist <= NEAR]
            a, b, dist, crowds = _nearest_forest(len(order), i, j, dist)
            for i, j in _pairs(key, bits, n, d, WIDTH, budget, crowds):
                own = crowds[i] != crowds[j]
                i, j = i[own], j[own]
                m = apart(i, j)
                ok = m <= far
                if ok.any():  # the forest so far and the new pairs
                    a, b, dist, _ = _nearest_forest(len(order), np.concatenate([a, i[ok]]), np.concatenate([b, j[ok]]), np.concatenate([dist, m[ok]]))
            return pa.table({"u": node[a], "v": node[b]})

        return run

    rows = dealt(reps, tables, WIDTH, budget, depth)
    found = grouped_links(rows, depth, WIDTH, budget, crowd, join, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()


def _folded(odd: pa.ListArray) -> np.ndarray:
    """The parities of each row at 256 bits, a row of four words each."""
    size = np.diff(odd.offsets.to_numpy())
    return np.stack([np.bitwise_xor.reduceat(x, np.cumsum(size // 4) - size // 4) for x in odd.flatten().to_numpy().view(np.uint64).reshape(-1, 4).T], axis=1)


def folded_parities(rows: DataFrame) -> DataFrame:
    """(node, o0 .. o3): the parities ``odd`` of each row at 256 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b for b in batches if b.num_rows):
            yield pa.record_batch([b.column(0), *map(pa.array, _folded(b.column(1)).view(np.int64).T)], names=["node", "o0", "o1", "o2", "o3"])

    return rows.select("node", "odd").mapInArrow(run, "node long, o0 long, o1 long, o2 long, o3 long")


def met(table: pa.Table, part: int) -> pa.Table:
    """(u, v) of the pairs under each shingle and pair of blocks (h, a, b) that may be similar: in different components, alike in
    size, with enough in common after the shingle, parities near enough, and not known to share an earlier shingle."""
    col = {c: table.column(c).combine_chunks() for c in table.column_names}
    of = lambda c: (col[c].fill_null(0) if col[c].null_count else col[c]).to_numpy(zero_copy_only=False)
    order = np.lexsort((of("b"), of("a"), of("h")))
    h, a, b, node, c, n, at = (of(x)[order] for x in ("h", "a", "b", "node", "c", "n", "at"))
    odd = np.stack([of(f"o{k}")[order].view(np.uint64) for k in range(4)], axis=1)
    seen = [(of(x)[order], col[x].is_valid().to_numpy(zero_copy_only=False)[order]) for x in ("p1", "p2")]
    run = np.cumsum(np.concatenate([[0], (h[1:] != h[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    left, right = np.flatnonzero(of("out")[order] & (of("own_a")[order] == a)), np.flatnonzero(of("own_b")[order] == b)
    first, last = np.searchsorted(run[right], run[left]), np.searchsorted(run[right], run[left], "right")
    ends, found, k = np.cumsum(last - first), [np.empty((0, 2), np.int64)], 0
    while k < len(left):
        to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + PAIRS, "right")))
        many = (last - first)[k:to]
        i = np.repeat(left[k:to], many)
        j = right[np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[k:to], many)]
        k = to
        for ok in (
            lambda i, j: c[i] != c[j],
            lambda i, j: (1000 * n[i] >= part * n[j]) & (1000 * n[j] >= part * n[i]),
            lambda i, j: (1000 + part) * np.minimum(n[i] - at[i], n[j] - at[j]) >= part * (n[i] + n[j]),
            lambda i, j: np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64) * (1000 + part) <= (1000 - part) * (n[i] + n[j]),
            lambda i, j: ~np.any([(x[i] == y[j]) & xs[i] & ys[j] for x, xs in seen for y, ys in seen], axis=0),
        ):
            keep = ok(i, j)
            i, j = i[keep], j[keep]
        found.append(np.unique(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], axis=1), axis=0))
    u, v = np.unique(np.concatenate(found), axis=0).T
    return pa.table({"u": u, "v": v})


def prefix_candidates(rows: DataFrame, part: int, block: int = BLOCK) -> DataFrame:
    """(u, v), u < v: nodes of ``rows`` (node, component_id, n, prefix, odd) in different components that may be similar.

    They share a shingle of their prefixes, are alike in size, and could still have enough in common after that shingle.  Shingles within one component are dropped; of
    the others, the rows outside the component that is most frequent under the shingle meet all rows.  They meet inside tasks
    that hold many shingles each, where parities of 256 bits tell most pairs apart at once, so the rows that come out are
    few; a pair comes out at its first shingle, not at each.  Both sides of a frequent shingle are cut into blocks of
    ``block`` rows, each pair of blocks for itself.
    """
    each = rows.select("node", F.col("component_id").alias("c"), "n", F.posexplode("prefix").alias("at", "h")).repartition("h")
    by_h, by_node = Window.partitionBy("h"), Window.partitionBy("node").orderBy("at")
    mixed = each.withColumns({"low": F.min("c").over(by_h), "high": F.max("c").over(by_h)}).where("low <> high").select("h", "node", "c", "n", "at")
    mixed = stored(mixed, "mixed")
    main = mixed.groupBy("h", "c").agg(F.count("*").alias("k")).groupBy("h").agg(F.max(F.struct("k", "c")).alias("main"), F.sum("k").alias("all"))
    blocks = lambda k: F.ceil(k / F.lit(block)).cast("int")
    sizes = main.select("h", F.col("main.c").alias("main"), blocks(F.col("all") - F.col("main.k")).alias("of_a"), blocks(F.col("all")).alias("of_b"))
    own = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    each = mixed.join(sizes, "h").withColumns({"out": F.col("c") != F.col("main"), "own_a": own("of_a"), "own_b": own("of_b")})
    each = each.withColumns({"p1": F.lag("h", 1).over(by_node), "p2": F.lag("h", 2).over(by_node)}).join(folded_parities(rows), "node")
    every = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    lefts = F.when(F.col("out"), F.transform(every("of_b"), lambda b: F.struct(F.col("own_a").alias("a"), b.alias("b")))).otherwise(F.array().cast("array<struct<a:int,b:int>>"))
    places = F.array_union(lefts, F.transform(every("of_a"), lambda a: F.struct(a.alias("a"), F.col("own_b").alias("b"))))
    dealt = each.withColumn("x", F.explode(places)).select("h", "node", "c", "n", "at", "out", "own_a", "own_b", "p1", "p2", "o0", "o1", "o2", "o3", "x.a", "x.b")
    tasks = F.pmod(F.xxhash64("h", "a", "b"), F.lit(max(4 * partitions(rows.sparkSession), mixed.count() >> 16))).alias("task")
    return dealt.groupBy(tasks).applyInArrow(lambda table: met(table, part), "u long, v long").distinct()


def not_too_far(pairs: DataFrame, rows: DataFrame, part: int) -> DataFrame:
    """The pairs (u, v: nodes of ``rows`` (node, n, odd)) alike in size whose parities differ in no more bits than the sets may in members."""
    u, v = (rows.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("odd").alias(f"odd_{x}")) for x in ("u", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = (1000 - part) * (b.column(2).to_numpy() + b.column(3).to_numpy())
            odd = [(x.values.to_numpy(), x.offsets.to_numpy()) for x in (b.column(4), b.column(5))]
            of = lambda k, i: odd[k][0][odd[k][1][i] : odd[k][1][i + 1]]
            near = [parities_apart(of(0, i), of(1, i)) * (1000 + part) <= most[i] for i in range(b.num_rows)]
            yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(u, "u").join(v, "v").where(f"1000 * n_u >= {part} * n_v AND 1000 * n_v >= {part} * n_u")
    return both.select("u", "v", "n_u", "n_v", "odd_u", "odd_v").mapInArrow(run, "u long, v long")


def verified(near: DataFrame, docs: DataFrame, size: int, part: int) -> DataFrame:
    """The pairs of ``near`` (u, v: doc_id of ``docs``) whose sets of shingles have ``part`` thousandths or more in common."""
    needed = near.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    needed = F.broadcast(needed) if near.count() <= SENT else needed
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(needed, "doc_id", "left_semi")
    sets = stored(shingle_sets(texts.withColumnRenamed("doc_id", "node"), size), "sets")
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("u", "v"))
    both = F.size(F.array_intersect("of_u", "of_v")).cast("long")
    true = near.join(left, "u").join(right, "v").where(both * (1000 + part) >= part * (F.size("of_u") + F.size("of_v"))).select("u", "v")
    true = stored(true, "links")
    dropped(sets)
    return true


def similar_groups(docs: DataFrame, size: int = 5, share: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of every row of ``docs`` (doc_id: unique, not null): rows of Jaccard similarity of at least
    ``share`` of their sets of shingles are linked; the component has the smallest doc_id in it."""
    part = round(1000 * share)
    marked = stored(sketches(docs, size, part), "sketches")
    words = [f"w{k}" for k in range(TABLES * WIDTH // 64)]
    # equal sets are one node, named by its smallest row: then a component's smallest node is its smallest row
    reps = marked.groupBy("node").agg(F.min(F.struct("doc_id", *words)).alias("x"))
    reps = stored(reps.select(F.col("node").alias("set"), F.col("x.doc_id").alias("node"), *[f"x.{w}" for w in words]), "reps")
    facts = marked.select(F.col("doc_id").alias("node"), "n", "odd")
    near = stored(candidate_links(reps.select("node", *words)), "candidates")
    true = verified(stored(not_too_far(near, facts, part), "candidates"), docs, size, part)
    of = reps.select("set", "node").join(components(true), "node", "left").select("set", "node", F.coalesce("root", "node").alias("component_id"))
    rows = of.join(marked.select(F.col("doc_id").alias("node"), "n", "prefix", "odd"), "node").where("n > 0")
    more = stored(prefix_candidates(rows, part), "candidates")
    more = verified(stored(not_too_far(more, facts, part), "candidates"), docs, size, part)
    rooted = reps.select("set", "node").join(components(true.union(more)), "node", "left").select(F.col("set").alias("node"), F.coalesce("root", "node").alias("component_id"))
    return marked.select("doc_id", "node").join(rooted, "node").select("doc_id", "component_id")


def with_hex(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
