"""Best-fit packing of tokenised documents into sequences, planned on the histogram of piece lengths.

Pieces above a third of the capacity are large: a sequence holds two of them at most.  They are matched
greedily, the longest left with the longest that still fits.  Smaller pieces then go, longest first, each
into the tightest gap that holds it; a new sequence opens only if no gap does.

All pieces of one length are alike, so the plan needs only how many there are of each length: at most
``capacity`` numbers, whatever the corpus.  The plan is a list of sequence kinds with multiplicities; a piece
finds its place from its length and its rank among the pieces of that length.  Ranks come from counters
kept while tokenising plus a prefix sum over (task, length) counts, so no group of equal lengths ever meets in
one task.

Defined results: null text is empty; every document ends with the end id, so an empty text is one piece of
length 1; only documents longer than the capacity are cut; repeated rows are packed each; null doc_id is
carried; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import CHARS, slices, stored, texts_of, trimmed
from .words import encoder

CAPACITY = 2048
#: Words whose ids a worker keeps.
WORDS = 120_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def cut_pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each tokenised document; ``nth`` numbers the pieces of one length within a task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, "word", WORDS)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        seen = np.zeros(capacity + 1, np.int64)
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                flat, off = enc.encode(texts_of(part))
                ids = part.column(0).to_pylist()
                rows = []
                for i, doc_id in enumerate(ids):
                    own = np.append(flat[off[i] : off[i + 1]], end_id).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        piece = own[at : at + capacity]
                        rows.append((doc_id, k, at, len(piece), zlib.crc32(piece.tobytes()), task, int(seen[len(piece)])))
                        seen[len(piece)] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def plan(hist: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(number of sequences, [(length, how many in each)])] for the given numbers of pieces by length."""
    left = {n: c for n, c in hist.items() if c > 0}
    open_: list[tuple[int, int, list[tuple[int, int]]]] = []  # gap, number, content
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        k = bisect.bisect_right(large, capacity - n) - 1
        if k < 0:
            open_.append((capacity - n, left[n], [(n, 1)]))
            large.pop()
            continue
        m = large[k]
        if m == n:
            if left[n] >= 2:
                open_.append((capacity - 2 * n, left[n] // 2, [(n, 2)]))
                left[n] %= 2
            else:  # the last one of this length: its partner is the next shorter length
                if k:
                    m = large[k - 1]
                    open_.append((capacity - n - m, 1, [(n, 1), (m, 1)]))
                    left[m] -= 1
                    if not left[m]:
                        large.remove(m)
                else:
                    open_.append((capacity - n, 1, [(n, 1)]))
                left[n] = 0
        else:
            c = min(left[n], left[m])
            open_.append((capacity - n - m, c, [(n, 1), (m, 1)]))
            left[n] -= c
            left[m] -= c
            if not left[m]:
                large.remove(m)
        if not left[n]:
            large.remove(n)

    gaps: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    for gap, c, content in open_:
        gaps.setdefault(gap, []).append((c, content))
    order = sorted(gaps)

    def put(gap: int, c: int, content: list[tuple[int, int]]) -> None:
        if gap not in gaps:
            bisect.insort(order, gap)
            gaps[gap] = []
        gaps[gap].append((c, content))

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        c = left[n]
        while c:
            k = bisect.bisect_left(order, n)
            if k == len(order):  # new sequences
                each = capacity // n
                if full := c // each:
                    put(capacity - each * n, full, [(n, each)])
                if c % each:
                    put(capacity - (c % each) * n, 1, [(n, c % each)])
                break
            gap = order[k]
            number, content = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(k)
            each = gap // n
            full = min(number, c // each)
            if full:
                put(gap - each * n, full, [*content, (n, each)])
                c -= full * each
                number -= full
            if number and 0 < c < each:
                put(gap - c * n, 1, [*content, (n, c)])
                number -= 1
                c = 0
            if number:
                put(gap, number, content)
    return [x for gap in order for x in gaps[gap]]


def slots(kinds: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For each place in each kind of sequence: length, first rank that goes there, first sequence, offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for number, content in kinds:
        offset = 0
        for n, each in content:
            for _ in range(each):
                rows.append((n, used.get(n, 0), base, offset))
                used[n] = used.get(n, 0) + number
                offset += n
        base += number
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), cols, strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with length, task, nth) with sequence_id and offset."""
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    hist = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    place = slots(plan(hist, capacity))
    key = place["length"] << 44 | place["rank"]
    rest = [f for f in pieces.schema.fieldNames() if f not in ("task", "nth")]
    ranked = pieces.join(by_task, ["task", "length"]).select(*rest, (F.col("nth") + F.col("before")).alias("rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, n << 44 | rank, side="right") - 1
            seq = place["sequence"][at] + rank - place["rank"][at]
            cols = [batch.column(i) for i in range(len(rest))]
            yield pa.record_batch([*cols, pa.array(seq), pa.array(place["offset"][at])], names=[*rest, "sequence_id", "offset"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*rest).schema)
    return ranked.mapInArrow(assign, f"{out}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(cut_pieces(docs, path, end_id, capacity), "pieces"), capacity)
