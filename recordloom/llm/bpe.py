"""BPE encoding and decoding through a distinct-word table.

1. Every text is split into pre-tokens inside Spark tasks; each task counts its distinct ones and a shuffle of
   (word, count) leaves one row per distinct word.  All distinct words are encoded once, in parallel.
2. Ids are joined back by position.  The most frequent words (at most ``head_words``, so the table has a fixed size
   bound) go to all tasks.  All others are joined by a shuffle: a task lists the rarer words of each slice of its
   documents, in the order in which they first occur; the list meets the word table by word, and comes back to one
   file per task with the ids in the same order.  Only (slice, word) pairs move, never documents or their ids.
3. A last pass splits each slice again and reads the ids of its rarer words from the file, by their order.

The file has a digest of each slice's list.  If the last pass were dealt other rows than the one before (an input that
is not read from files), a list without its digest is encoded in place: the results are the same in every case.

A special string inside a text is a word of its own with its own id, as in the library by default; what stands before
and after it is split apart.  Decoding joins ids to the vocabulary's pieces (a table of vocabulary size, in every task)
and concatenates them by position.

Defined results: null text is the empty text; the empty text has no ids and decodes to the empty text;
repeated rows give repeated rows; null doc_id is carried; an empty table gives an empty table; columns other
than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import as_uri, make_folder, shared_dir, slices, stored, texts_of, threshold_for_head, trimmed
from .words import BYTE_CHARS, WordEncoder, tokenizer

#: Most words in the table that every task gets; about 30 bytes each.
HEAD_WORDS = 200_000
#: Words that a task counts before it sends them on, and the text of a slice.
COUNTED, SLICE = 400_000, 1_000_000


class TextEncoder(WordEncoder):
    """A word encoder for texts with special strings: they part the text, and each is a word with its own id."""

    def __init__(self, path: str, kind: str, table: dict[str, bytes] | None = None, most: int = 100_000):
        super().__init__(path, kind, table, most)
        added = self.tok.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("this vocabulary has special strings that take in what is around them")
        self.special_ids = {t.content: i for i, t in added.items()}
        longest = sorted(self.special_ids, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        if kind == "byte":
            self.specials = []

    def parts(self, texts: list[str]) -> tuple[list[str], list[list[str]] | None]:
        """(what is left of the texts without special strings, the special strings within each text); None if there are none."""
        if self.kind != "byte" or not self.special or not any(s in t for s in self.special_ids for t in texts):
            return texts, None
        cut = [self.special.split(t) for t in texts]
        return [x for c in cut for x in c[::2]], [c[1::2] for c in cut]

    def joined(self, flat: np.ndarray, off: np.ndarray, between: list[list[str]] | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and offsets of the texts from those of their parts."""
        if between is None:
            return flat, off
        out, sizes, k = [], [], 0
        for specials in between:
            own = [flat[off[k] : off[k + 1]]]
            for s in specials:
                k += 1
                own += [np.array([self.special_ids[s]], flat.dtype), flat[off[k] : off[k + 1]]]
            k += 1
            out += own
            sizes.append(sum(map(len, own)))
        return np.concatenate(out) if out else flat[:0], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, between = self.parts(texts)
        return self.joined(*self.encode(pieces), between)


#: This worker process's encoder, by the run that its table belongs to: the one before goes.
_ENCODER: dict[str, TextEncoder] = {}


def _own_encoder(run: str, path: str, kind: str, table=None) -> TextEncoder:
    if run not in _ENCODER:
        _ENCODER.clear()
        words, ids = table.value if table else (None, None)
        _ENCODER[run] = TextEncoder(path, kind, dict(zip(words.to_pylist(), ids.to_pylist(), strict=True)) if table else None)
    return _ENCODER[run]


def distinct_words(docs: DataFrame, path: str, kind: str) -> DataFrame:
    """(word, n): each distinct pre-token of the texts and how often it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, held, size = TextEncoder(path, kind), [], 0

        def summed() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")])
            return pa.record_batch([t.column("word").combine_chunks(), t.column("n_sum").combine_chunks()], names=["word", "n"])

        for batch in trimmed(batches):
            for part in slices(batch, chars=SLICE):
                _, distinct, idx, _ = enc.split(enc.parts(texts_of(part))[0])
                n = np.bincount(idx, minlength=len(distinct)).astype(np.int64)
                held.append(pa.record_batch([distinct, pa.array(n)], names=["word", "n"]))
                size += len(distinct)
                if size > COUNTED:
                    held = [summed()]
                    size = held[0].num_rows
                    if size > COUNTED // 2:
                        yield held.pop()
                        size = 0
        if held:
            yield summed()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def word_table(words: DataFrame, path: str, kind: str) -> DataFrame:
    """(word, n, ids): each distinct word encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder(path, kind)
        for batch in trimmed(batches):
            ids = enc.words(batch.column(0).to_pylist())
            enc.cache.clear()
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["word", "n", "ids"])

    return words.select("word", "n").mapInArrow(encode, "word string, n long, ids binary")


def rare_of(words: list[str], table: dict[str, bytes]) -> tuple[list[str], bytes]:
    """The words of a slice that the table lacks, in their order, and a digest of them."""
    rare = [w for w in words if w not in table]
    return rare, hashlib.md5("\x00".join(rare).encode()).digest()


def rare_pairs(docs: DataFrame, path: str, kind: str, run: str, table) -> DataFrame:
    """(part, slice, k, word, digest): the k-th of the rarer words of each slice of each task's documents."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = _own_encoder(run, path, kind, table), 0
        task = TaskContext.get().partitionId()
        for batch in trimmed(batches):
            for part in slices(batch, chars=SLICE):
                rare, digest = rare_of(enc.split(enc.parts(texts_of(part))[0])[1].to_pylist(), enc.table)
                n = len(rare)
                cols = [pa.array(np.full(n, task, np.int32)), pa.array(np.full(n, at, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(rare, pa.string())]
                yield pa.record_batch([*cols, pa.array([digest] + [None] * (n - 1) if n else [], pa.binary())], names=["part", "slice", "k", "word", "digest"])
                at += 1

    return docs.select("doc_id", "text").mapInArrow(listed, "part int, slice int, k int, word string, digest binary")


def write_rare(pairs: DataFrame, folder: str) -> None:
    """A file per task of ``pairs`` (part, slice, k, ids, digest): a row per slice with its digest, ids and their sizes, in order."""
    make_folder(folder)

    def write(key: tuple, t: pa.Table) -> pa.Table:
        import pyarrow.parquet as pq
        from pyarrow import fs

        t = t.sort_by([("slice", "ascending"), ("k", "ascending")])
        number = t.column("slice").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        off = pa.array(np.append(first, len(number)), pa.int32())
        ids = pa.ListArray.from_arrays(off, t.column("ids").combine_chunks())
        store, root = fs.FileSystem.from_uri(folder)
        name, attempt = f"{root}/{key[0].as_py()}", TaskContext.get().taskAttemptId()
        with store.open_output_stream(f"{name}.{attempt}") as f:
            pq.write_table(pa.table({"slice": number[first], "digest": t.column("digest").take(pa.array(first)), "ids": ids}), f, compression="zstd")
        store.move(f"{name}.{attempt}", f"{name}.parquet")
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32())})

    pairs.groupBy("part").applyInArrow(write, "part int").write.format("noop").mode("overwrite").save()


def read_rare(folder: str, part: int) -> dict[int, tuple[bytes, pa.Scalar]]:
    """The slices of a task's file: number, digest, ids of each word."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{part}.parquet"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return {}
    with store.open_input_file(path) as f:
        t = pq.read_table(f)
    return dict(zip(t.column("slice").to_pylist(), zip(t.column("digest").to_pylist(), t.column("ids"), strict=True), strict=True))


def _encode(docs: DataFrame, path: str, kind: str, head_words: int):
    """The function that encodes batches of (doc_id, text) of ``docs``, and the frame to run it on."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = stored(word_table(distinct_words(docs, path, kind), path, kind), "words")
    least = threshold_for_head(words, "n", head_words)
    head = words.where(F.col("n") >= least).select("word", "ids").toArrow()
    table = spark.sparkContext.broadcast((head.column(0).combine_chunks(), head.column(1).combine_chunks()))
    run, folder = uuid.uuid4().hex, f"{as_uri(shared_dir(spark))}/rare"
    pairs = rare_pairs(docs, path, kind, run, table)
    write_rare(pairs.join(words.where(F.col("n") < least).select("word", "ids"), "word").select("part", "slice", "k", "ids", "digest"), folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = _own_encoder(run, path, kind, table), 0
        have = read_rare(folder, TaskContext.get().partitionId())
        known = enc.table
        for batch in trimmed(batches):
            for part in slices(batch, chars=SLICE):
                texts = texts_of(part)
                pieces, between = enc.parts(texts)
                made = enc.split(pieces)
                rare, digest = rare_of(made[1].to_pylist(), known)
                if at in have and have[at][0] == digest:
                    enc.cache = dict(zip(rare, have[at][1].as_py(), strict=True))
                else:  # other rows than those that were listed
                    enc.cache = {}
                flat, off = enc.joined(*enc.assembled(pieces, *made), between)
                at += 1
                out = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.record_batch([part.column(0), out], names=["doc_id", "ids"])

    return encode, docs


def encode_documents(docs: DataFrame, path: str, kind: str = "byte", head_words: int = HEAD_WORDS) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text)."""
    encode, own = _encode(docs, path, kind, head_words)
    return own.mapInArrow(encode, "doc_id long, ids array<int>")


@lru_cache(None)
def pieces_of(path: str) -> pa.BinaryArray:
    """The bytes of each id of a byte-level vocabulary; ids that it lacks have none."""
    tok = tokenizer(path)
    to_byte = {c: b for b, c in BYTE_CHARS.items()}
    vocab = tok.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        pieces[i] = bytes(map(to_byte.__getitem__, piece)) if all(c in to_byte for c in piece) else piece.encode()
    return pa.array(pieces, pa.binary())


def _decode(path: str):
    """The function that puts the decoded text beside the ids of batches of (doc_id, ids)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column(1)
                flat = pieces.take(ids.flatten())
                n = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(off), flat), b"")
                text = [x.decode("utf-8", "replace") for x in joined.to_pylist()]
                yield pa.record_batch([part.column(0), ids, pa.array(text, pa.string())], names=["doc_id", "ids", "text"])

    return decode


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded ``text`` beside the ids; bytes that are no UTF-8 become U+FFFD."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids array<int>, text string")


@lru_cache(None)
def numerals(n: int) -> pa.BinaryArray:
    return pa.array([str(i).encode() for i in range(n)], pa.binary())


def digests(docs: DataFrame, path: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """The query's rows: token count and digests of the ids and of the decoded text.

    All of it happens in one Python worker a task, so neither ids nor decoded texts go back to the JVM.
    """
    encode, own = _encode(docs, path, "byte", head_words)
    decode = _decode(path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = numerals(len(pieces_of(path)))
        sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
        for part in decode(encode(batches)):
            ids = part.column(1)
            n = pc.fill_null(pc.list_value_length(ids), 0)
            off = np.concatenate([[0], np.cumsum(n.to_numpy(zero_copy_only=False))]).astype(np.int32)
            listed = pc.binary_join(pa.ListArray.from_arrays(pa.array(off), names.take(ids.flatten())), b",")
            cols = [part.column(0), n.cast(pa.int64()), sha(x.as_py() for x in listed), sha(x.as_py().encode() for x in part.column(2))]
            yield pa.record_batch(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return own.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
