"""Quality rules: word statistics, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and pairs of words are hashed into ``BUCKETS``.  The raw multinomial counts every document; the trusted
one counts every document of the given trusted ids.  Ids fall into ``FOLDS`` by hash, and a document is judged by the
counts of the other folds only, so neither it nor a repeated row of its id speaks for itself, be it trusted or not.
A bucket's log ratio is that of its trusted count to the one expected from its raw count, each with ``PSEUDO`` added:
what other documents do not have is neutral, and what they have rarely is nearly so.  A document's verdict is the mean
log ratio of its words and pairs against a fixed threshold.  Everything is DataFrame expressions: two passes over
the texts, one shuffle of texts and one of bucket counts.

There is no bound on trusted ids; BUCKETS rows at most come back from the counting pass.

Defined results: null text has no words and fails the base rules; repeated rows give repeated rows and count each;
null doc_id is carried and never trusted; without trusted documents every ratio is 0 and only the base rules
decide; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, FOLDS, PSEUDO = 1 << 16, 2, 10.0
#: Mean log ratio below which a document is dropped: labelled-good documents of the three tables, each judged without its
#: own fold, had -0.096 up; -0.19 up where only half of the labels (even ids) was trusted (smaller two tables).
THRESHOLD = -0.2
BLANK = "[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{BLANK}+"), "")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _window_hashes(words: Column, n: Column, size: int) -> Column:
    made = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(n >= size, made).otherwise(F.array().cast("array<bigint>"))


def _covered(order: Column, size: int) -> Column:
    """How many places lie in a window whose hash occurs twice; ``order`` is a column of (h, i) in sorted order."""
    twice = F.filter(order, lambda x, j: F.coalesce((x.h == F.get(order, j - 1).h), F.lit(False)) | F.coalesce((x.h == F.get(order, j + 1).h), F.lit(False)))
    at = F.array_sort(F.transform(twice, lambda x: x.i))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    done = F.aggregate(at, start, lambda s, p: F.struct((s.n + F.least(F.lit(size), p + size - s.end)).cast("long").alias("n"), (p + size).alias("end")))
    return done.n


def base_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, words (their hashes), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    out = out.select("doc_id", "text", F.transform(split_words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: _without(x, " \t\x0b\x0c\r") != "")
    out = out.select(
        "doc_id",
        "words",
        F.size("words").alias("n"),
        F.length(_without(F.col("text"), " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    # Each of these is a column of its own: inside a lambda an expression would run anew for every element.
    out = out.withColumn("h", _window_hashes(F.col("words"), F.col("n"), 5))
    pairs = F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.size(F.array_distinct("h")) < F.size("h")
    out = out.withColumn("order", F.when(twice, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("h")
    repeats = F.when(F.size("order") > 0, _covered(F.col("order"), 5)).otherwise(F.lit(0).cast("long"))
    out = out.select(
        "doc_id",
        "words",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _fold(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(FOLDS)), F.lit(0)).cast("int")


def _pairs(words: Column) -> Column:
    """Hashes of the neighbouring pairs of a column of word hashes."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda h, i: F.xxhash64(h, F.get(words, i + 1)))


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(b, raw_0, good_0, ..., of each fold): what all documents and what trusted ones of a fold count in a bucket.

    The join is a shuffle of texts by id with hash tables of the ids of one partition, so no table of ids goes to all
    tasks; rows without an id are spread by their text and never match.
    """
    has, ids = F.col("doc_id").isNotNull(), trusted.select(F.col("doc_id").cast("long").alias("k")).where("k IS NOT NULL").distinct()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.select(F.coalesce("doc_id", F.xxhash64("text")).alias("k"), has.alias("has"), _fold(F.col("doc_id")).alias("fold"), "text")
    own = own.join(ids.select("k", F.lit(True).alias("has"), F.lit(1).alias("good")).hint("shuffle_hash"), ["k", "has"], "left")
    kind = 2 * F.col("fold") + F.coalesce("good", F.lit(0))
    own = own.select(kind.alias("kind"), F.transform(split_words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    each = own.select("kind", F.explode(F.concat("words", _pairs(F.col("words")))).alias("h")).select((2 * FOLDS * _bucket(F.col("h")) + F.col("kind")).alias("c"))
    few = each.groupBy("c").agg(F.count("*").alias("n")).select(F.floor(F.col("c") / (2 * FOLDS)).cast("int").alias("b"), (F.col("c") % (2 * FOLDS)).alias("kind"), "n")
    total = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    cols = [c for f in range(FOLDS) for c in (total(F.floor(F.col("kind") / 2) == f).alias(f"raw_{f}"), total(F.col("kind") == 2 * f + 1).alias(f"good_{f}"))]
    return few.groupBy("b").agg(*cols)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """Log ratio of each bucket, for each fold in turn: trusted over raw in the documents of all other folds."""
    rows = bucket_counts(docs, trusted).toArrow()  # BUCKETS rows at most
    out = np.zeros((FOLDS, BUCKETS))
    b = rows.column("b").to_numpy()
    raw, good = (np.array([rows.column(f"{x}_{f}").to_numpy() for f in range(FOLDS)], float) for x in ("raw", "good"))
    raw, good = raw.sum(axis=0) - raw, good.sum(axis=0) - good
    for f in range(FOLDS):
        if good[f].sum():
            out[f, b] = np.log((good[f] + PSEUDO) / (raw[f] * (good[f].sum() / raw[f].sum()) + PSEUDO))
    return out.round(4).ravel().tolist()


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the base figures, ``ratio`` (mean log ratio) and ``kept``."""
    ratios = F.split(F.lit(",".join(map(str, log_ratios(docs, trusted)))), ",").cast("array<double>")  # folded to one literal
    out = base_rules(docs).withColumn("pairs", _pairs(F.col("words"))).withColumn("at", BUCKETS * _fold(F.col("doc_id")))
    add = lambda s, h: s + F.get(ratios, F.col("at") + _bucket(h))
    total = F.aggregate("words", F.lit(0.0), add) + F.aggregate("pairs", F.lit(0.0), add)
    out = out.withColumn("ratio", F.when(F.size("words") > 0, total / (F.size("words") + F.size("pairs"))).otherwise(F.lit(0.0)))
    return out.drop("words", "pairs", "at").withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
