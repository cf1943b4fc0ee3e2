"""Token counts without ids: pieces are counted once per distinct pre-token.

Pre-tokens end where a run of blanks begins and before line feeds.  No piece of the vocabulary spans such a
border (this is checked when the model is loaded), so the counts of a text's pre-tokens add up to the
library's count for the whole text.

1. Tasks count their distinct pre-tokens; a shuffle leaves one row per distinct pre-token, with its piece
   count, in a stored table.
2. The most frequent ones (at most ``head_words``) go to all tasks; a second pass sums their counts within
   each document and keeps the document's frequencies of the rarer ones.
3. Those frequencies join the table by word.  A word of the join is rare by construction, so no key is hot.

Defined results: null text is empty; the empty text has 0 tokens and 0 bytes; each row of the input gives one
row, repeated rows included; null doc_id is carried; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices, stored, texts_of, threshold_for_head
from .words import code_points, token_array

HEAD_WORDS = 300_000
BLANK = "▁"


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces) or any("\n" in p for p in pieces):
            raise ValueError("this vocabulary has pieces that span pre-token borders")

    def split(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """(distinct pre-tokens, index of each pre-token's distinct form, pre-token offsets of each text)."""
        cps, ends = code_points([" " + t if t else "" for t in texts])
        blank = (cps == 32) | (cps == ord(BLANK))
        start = np.zeros(len(cps), bool)
        start[:1] = True
        start[1:] = blank[1:] & ~blank[:-1]
        start |= cps == 10
        start[ends] = True
        start[ends[:-1] + 1] = True
        tokens, at = token_array(cps, start)
        keep = cps[at] != 0x110000
        tokens, at = tokens.filter(pa.array(keep)), at[keep]
        coded = tokens.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(at, np.concatenate([[0], ends]))

    def count(self, words: list[str]) -> np.ndarray:
        """Pieces of each pre-token.  The library itself puts one blank first: it stands for the pre-token's own, or is taken off."""
        asked = [w[1:] if w[0] != "\n" else w for w in words]
        n = np.fromiter(map(len, self.sp.encode(asked, num_threads=1)), np.int64, len(words))
        for i, w in enumerate(words):
            if w[0] == "\n":
                n[i] -= 1
            elif len(w) == 1:
                n[i] = 1
        return n


def count_tokens(docs: DataFrame, path: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        for batch in batches:
            for part in slices(batch, chars=4_000_000):
                distinct, idx, _ = counter.split(texts_of(part))
                n = np.bincount(idx, minlength=len(distinct)).astype(np.int64)
                yield pa.record_batch([distinct, pa.array(n)], names=["word", "n"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        for batch in batches:
            n = counter.count(batch.column(0).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n.astype(np.int32))], names=["word", "n", "pieces"])

    counts = docs.select("text").mapInArrow(tally, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    table = stored(counts.mapInArrow(pieces, "word string, n long, pieces int"), "words")
    least = threshold_for_head(table, "n", head_words)
    head = table.where(F.col("n") >= least).select("word", "pieces").toArrow()
    shared = spark.sparkContext.broadcast((head.column(0).combine_chunks(), head.column(1).combine_chunks()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        words, n = shared.value
        known = dict(zip(words.to_pylist(), n.to_pylist(), strict=True))
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in batches:
            for part in slices(batch):
                texts = texts_of(part)
                distinct, idx, at = counter.split(texts)
                each = np.fromiter((known.get(w, 0) for w in distinct.to_pylist()), np.int64, len(distinct))
                sums = np.concatenate([[0], np.cumsum(each[idx])])
                doc = np.repeat(np.arange(len(texts)), np.diff(at))
                rare = each[idx] == 0
                keys, freq = np.unique(doc[rare] * max(1, len(distinct)) + idx[rare], return_counts=True)
                of, word = keys // max(1, len(distinct)), keys % max(1, len(distinct))
                off = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)), pa.int32())
                yield pa.record_batch(
                    [
                        pa.array(np.arange(row, row + len(texts))),
                        part.column(0),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array(sums[at[1:]] - sums[at[:-1]]),
                        pa.ListArray.from_arrays(off, distinct.take(pa.array(word))),
                        pa.ListArray.from_arrays(off, pa.array(freq.astype(np.int32))),
                    ],
                    names=["row", "doc_id", "n_bytes", "known", "words", "freqs"],
                )
                row += len(texts)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    part = stored(source.mapInArrow(add, "row long, doc_id long, n_bytes long, known long, words array<string>, freqs array<int>"), "documents")
    rest = (
        part.where(F.size("words") > 0)
        .select("row", F.explode(F.arrays_zip("words", "freqs")).alias("w"))
        .select("row", F.col("w.words").alias("word"), F.col("w.freqs").alias("freq"))
        .join(table.where(F.col("n") < least).select("word", "pieces"), "word")
        .groupBy("row")
        .agg(F.sum(F.col("freq").cast("long") * F.col("pieces")).alias("rest"))
    )
    return part.select("row", "doc_id", "n_bytes", "known").join(rest, "row", "left").select("doc_id", "n_bytes", (F.col("known") + F.coalesce("rest", F.lit(0))).alias("n_tokens"))


def with_limit(counted: DataFrame, limit: int = 4096) -> DataFrame:
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
