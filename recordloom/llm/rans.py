"""Token ids in compressed shard files: static range asymmetric numeral coding in interleaved blocks.

Documents are range-partitioned by doc_id, into as many ranges as the input has ``RANGE_BYTES``; each task writes its
run of documents as shard files of at most ``SHARD_TOKENS`` ids and the slice of documents that reaches them.  A shard has one static frequency table, shared by all its blocks.  A block holds
``BLOCK`` ids, dealt in turn to ``LANES`` coders whose words are interleaved in one stream.  The states at a
block's start are its checkpoint, and with the block index in the footer any block can be read alone; each block
has a CRC-32 of its bytes and one of its ids, the footer has its own.

Layout (little-endian): ``MAGIC``; u32 number of symbols, their ids (u32) and frequencies (u32), which add up to
2**SCALE; blocks (LANES u64 states, then u32 words); footer: u64 documents, per document i64 doc_id, u8 null
flag, u64 ids; u64 blocks, per block u64 place, u64 bytes, u64 ids, u32 CRC of the bytes, u32 CRC of the ids; u32
CRC of the footer, u64 place of the footer, ``MAGIC``.

Lanes of all blocks of a shard advance together in numpy, so the coder's inner step is a few array operations.

The manifest (a row a file) is a table in the shared folder; the places of the files' first ids are prefix sums within
groups of ``RANGES`` tasks and over the groups, so only one row a group meets in one task.

Defined results: null text is empty and has only the end id; rows are in ascending doc_id order, null doc_id
first, equal doc_id by the hash of the text; repeated rows are written each; an empty table writes no file and reads back empty;
other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import as_uri, drop_folder, input_bytes, make_folder, partitions, shared_dir, slices, stored, texts_of, trimmed
from .words import encoder

MAGIC = b"RLRANS01"
SCALE, LANES, BLOCK, SHARD_TOKENS = 20, 32, 1 << 16, 1 << 22
#: Input bytes (as stored, compressed) a task should write; tasks whose files are summed up together.
RANGE_BYTES, RANGES = 32 << 20, 1024
#: Folder of files that are being written.
ATTEMPTS = "_attempts"
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
SCALE64 = np.uint64(SCALE)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, and their shares of 2**SCALE, at least 1 each."""
    symbols, counts = np.unique(ids, return_counts=True)
    freq = np.maximum(1, counts * (1 << SCALE) // max(1, len(ids))).astype(np.int64)
    over = int(freq.sum()) - (1 << SCALE)
    for i in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        cut = min(over, int(freq[i]) - 1, max(1, int(freq[i]) // 2))
        freq[i] -= cut
        over -= cut
    if over < 0:
        freq[np.argmax(freq)] -= over
    return symbols.astype(np.uint32), freq.astype(np.uint32)


def encode_blocks(codes: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """codes: (blocks, steps, LANES) symbol numbers.  Returns the final states (blocks, LANES) and each block's words."""
    blocks, steps, _ = codes.shape
    f64 = freq.astype(np.uint64)
    cum = np.concatenate([[0], np.cumsum(f64)[:-1]]).astype(np.uint64)
    state = np.full((blocks, LANES), LOW, np.uint64)
    words = np.zeros((steps, blocks, LANES), np.uint32)
    sent = np.zeros((steps, blocks, LANES), bool)
    limit = (LOW >> SCALE64) << WORD
    for t in range(steps - 1, -1, -1):
        s = codes[:, t]
        f = f64[s]
        full = state >= limit * f
        words[t] = state.astype(np.uint32)
        sent[t] = full
        state = np.where(full, state >> WORD, state)
        q = state // f
        state = (q << SCALE64) + (state - q * f) + cum[s]
    return state, [words[:, b][sent[:, b]] for b in range(blocks)]


def decode_blocks(state: np.ndarray, words: list[np.ndarray], steps: int, freq: np.ndarray) -> np.ndarray:
    """The inverse: (blocks, steps, LANES) symbol numbers."""
    blocks = len(words)
    f64 = freq.astype(np.uint64)
    cum = np.concatenate([[0], np.cumsum(f64)[:-1]]).astype(np.uint64)
    of_slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    flat = np.concatenate([*words, np.zeros(1, np.uint32)])
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])[:blocks].astype(np.int64)
    out = np.empty((blocks, steps, LANES), np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    state = state.copy()
    for t in range(steps):
        slot = state & mask
        s = of_slot[slot.astype(np.int64)]
        out[:, t] = s
        state = f64[s] * (state >> SCALE64) + slot - cum[s]
        need = state < LOW
        order = np.cumsum(need, axis=1)
        place = np.where(need, at[:, None] + order - 1, len(flat) - 1)
        state = np.where(need, (state << WORD) | flat[place], state)
        at += order[:, -1]
    if (state != LOW).any():
        raise ValueError("a block ends in a wrong state")
    return out


def shard_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    symbols, freq = frequencies(ids)
    out = bytearray(MAGIC + struct.pack("<I", len(symbols)) + symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes())
    codes = np.searchsorted(symbols, ids).astype(np.uint32)
    index = []
    whole = len(ids) // BLOCK * BLOCK
    for first, last in ((0, whole), (whole, len(ids))):
        if first == last:
            continue
        part = codes[first:last]
        per = min(BLOCK, len(part))
        steps = -(-per // LANES)
        grid = np.zeros((-(-len(part) // per), steps * LANES), np.uint32)
        grid[:, :per] = part.reshape(-1, per)
        state, words = encode_blocks(grid.reshape(len(grid), steps, LANES), freq)
        for b, w in enumerate(words):
            data = state[b].astype("<u8").tobytes() + w.astype("<u4").tobytes()
            own = ids[first + b * per : first + (b + 1) * per].astype("<u4").tobytes()
            index.append(struct.pack("<QQQII", len(out), len(data), per, zlib.crc32(data), zlib.crc32(own)))
            out += data
    docs = b"".join(struct.pack("<qBQ", x or 0, x is None, int(n)) for x, n in zip(doc_ids, lengths, strict=True))
    footer = struct.pack("<Q", len(doc_ids)) + docs + struct.pack("<Q", len(index)) + b"".join(index)
    return bytes(out) + footer + struct.pack("<IQ", zlib.crc32(footer), len(out)) + MAGIC


def read_footer(data: bytes) -> tuple[list[tuple[int | None, int]], list[tuple[int, int, int, int, int]]]:
    """(documents, blocks) of a shard, checked."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a shard file")
    crc, at = struct.unpack("<IQ", data[-20:-8])
    footer = data[at:-20]
    if zlib.crc32(footer) != crc:
        raise ValueError("the footer is damaged")
    (n,) = struct.unpack_from("<Q", footer)
    docs = [(None if null else x, k) for x, null, k in struct.iter_unpack("<qBQ", footer[8 : 8 + 17 * n])]
    return docs, list(struct.iter_unpack("<QQQII", footer[16 + 17 * n :]))


def read_blocks(data: bytes, blocks: list[tuple[int, int, int, int, int]]) -> np.ndarray:
    """The ids of the given blocks (any of read_footer's), each checked."""
    (n,) = struct.unpack_from("<I", data, 8)
    symbols, freq = (np.frombuffer(data, "<u4", n, 12 + k * 4 * n) for k in (0, 1))
    out = []
    for size in dict.fromkeys(b[2] for b in blocks):  # blocks of one size advance together
        same = [b for b in blocks if b[2] == size]
        for at, length, _, crc, _ in same:
            if zlib.crc32(data[at : at + length]) != crc:
                raise ValueError("a block is damaged")
        state = np.stack([np.frombuffer(data, "<u8", LANES, b[0]) for b in same])
        words = [np.frombuffer(data, "<u4", (b[1] - 8 * LANES) // 4, b[0] + 8 * LANES) for b in same]
        codes = decode_blocks(state, words, -(-size // LANES), freq).reshape(len(same), -1)[:, :size]
        for row, b in zip(symbols[codes], same, strict=True):
            if zlib.crc32(row.tobytes()) != b[4]:
                raise ValueError("a block decodes to other ids")
            out.append((b[0], row))
    return np.concatenate([row for _, row in sorted(out, key=lambda x: x[0])]) if out else np.empty(0, np.uint32)


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder``, a URI; one manifest row per file: file, n_docs, n_tokens, first.

    ``first`` is the number of ids in all files before this one.  A file gets its name only when it is whole, so
    a task that runs twice leaves the same files; what attempts leave goes with their own folder at the end.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        enc = encoder(path, "word")
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        doc_ids: list = []
        held: list[np.ndarray] = []
        sizes: list[int] = []
        made, total = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal made, total
            name = f"shard-{task:07d}-{made:05d}.rans"
            with store.open_output_stream(f"{root}/{ATTEMPTS}/{name}.{attempt}") as f:
                f.write(shard_bytes(doc_ids, np.array(sizes), np.concatenate(held)))
            store.move(f"{root}/{ATTEMPTS}/{name}.{attempt}", f"{root}/{name}")
            kinds = [("file", pa.string()), ("task", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
            row = pa.record_batch([pa.array([x], t) for x, (_, t) in zip((name, task, len(doc_ids), total), kinds, strict=True)], names=[x for x, _ in kinds])
            doc_ids.clear(), held.clear(), sizes.clear()
            made, total = made + 1, 0
            return row

        for batch in trimmed(batches):
            for part in slices(batch):
                flat, off = enc.encode(texts_of(part))
                for i, x in enumerate(part.column(0).to_pylist()):
                    doc_ids.append(x)
                    held.append(np.append(flat[off[i] : off[i + 1]], np.uint32(end_id)).astype(np.uint32))
                    sizes.append(len(held[-1]))
                    total += sizes[-1]
                if total >= SHARD_TOKENS:
                    yield flush()
        if doc_ids:
            yield flush()

    make_folder(f"{folder}/{ATTEMPTS}")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = max(partitions(spark), -(-input_bytes(docs) // RANGE_BYTES))
    dealt = source.repartitionByRange(ranges, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    files = stored(dealt.mapInArrow(write, "file string, task int, n_docs long, n_tokens long"), "manifest")
    drop_folder(f"{folder}/{ATTEMPTS}")
    own = files.withColumn("part", F.floor(F.col("task") / RANGES))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = own.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", before("n", Window.orderBy("part")).alias("base"))
    within = own.withColumn("own", before("n_tokens", Window.partitionBy("part").orderBy("file")))
    return within.join(groups, "part").select("file", "n_docs", "n_tokens", (F.col("base") + F.col("own")).alias("first"))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(file, doc_id, place, n_tokens, ids) of every document in the shard files; place counts the ids before it in its file."""
    out = "file string, doc_id long, place long, n_tokens long, ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_py()
                docs, blocks = read_footer(data)
                ids = read_blocks(data, blocks).astype("<u4").tobytes()
                n = np.array([k for _, k in docs], np.int64)
                at = np.cumsum(n) - n
                for k in range(0, len(docs), 500):
                    own = [ids[4 * a : 4 * (a + m)] for a, m in zip(at[k : k + 500].tolist(), n[k : k + 500].tolist(), strict=True)]
                    cols = [pa.array([name] * len(own)), pa.array([x for x, _ in docs[k : k + 500]], pa.int64()), pa.array(at[k : k + 500]), pa.array(n[k : k + 500]), pa.array(own, pa.binary())]
                    yield pa.record_batch(cols, names=["file", "doc_id", "place", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.rans").load(folder)
    return files.select(F.substring_index("path", "/", -1).alias("file"), "content").mapInArrow(read, out)


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """The query's rows, from the files read back."""
    spark = docs.sparkSession
    folder = f"{as_uri(shared_dir(spark))}/shards"
    manifest = write_shards(docs, path, folder, end_id)
    read = read_shards(spark, folder).select("file", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(manifest.select("file", "first"), "file").select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
