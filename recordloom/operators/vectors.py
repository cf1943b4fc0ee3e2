"""TF-IDF views as postings, and cosines of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.text import tokens

MAX_DF, MIN_DF = 0.01, 2
#: view: (column, kind, smallest n, largest n, how many it may propose)
VIEWS = {"cos_name": ("name_core", "char", 2, 4, 15), "cos_full": ("full_n", "char", 3, 4, 15), "cos_addr": ("addr_n", "word", 1, 2, 5)}


def _gram(padded: Column, n: int):
    return lambda i: F.substring(padded, i, F.lit(n))


def _char_grams(word: Column, lo: int, hi: int) -> Column:
    """n-grams of the word between blanks; a padded word shorter than n is one gram, and larger n add none."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    size = F.length(word) + 2
    parts = []
    for n in range(lo, hi + 1):
        every = F.transform(F.sequence(F.lit(1), size - n + 1), _gram(padded, n))
        short = F.array(padded) if n == lo else F.array().cast("array<string>")
        parts.append(F.when(size >= n, every).otherwise(short))
    return F.concat(*parts)


def terms(norm: DataFrame, view: str) -> DataFrame:
    """(entity_id, country_n, term, tf)."""
    column, kind, lo, hi, _ = VIEWS[view]
    if kind == "char":
        each = norm.select("entity_id", "country_n", F.explode(tokens(F.col(column))).alias("w")).select("entity_id", "country_n", F.explode(_char_grams(F.col("w"), lo, hi)).alias("term"))
    else:
        base = norm.select("entity_id", "country_n", F.filter(tokens(F.col(column)), lambda t: F.length(t) >= 2).alias("t"))
        two = F.when(F.size("t") >= 2, F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.concat_ws(" ", F.element_at("t", i), F.element_at("t", i + 1)))).otherwise(F.array().cast("array<string>"))
        each = base.select("entity_id", "country_n", F.explode(F.concat("t", two)).alias("term"))
    return each.groupBy("entity_id", "country_n", "term").agg(F.count("*").alias("tf"))


def postings(norm: DataFrame, view: str, max_df: float = MAX_DF, min_df: int = MIN_DF) -> DataFrame:
    """(entity_id, country_n, term, w): sublinear tf times smooth idf, L2-normalised, fitted per country.

    Terms in fewer than ``min_df`` or more than a share ``max_df`` of the records go, unless that leaves none.
    """
    tf = terms(norm, view)
    total = norm.groupBy("country_n").agg(F.count("*").alias("total"))
    df = tf.groupBy("country_n", "term").agg(F.count("*").alias("df")).join(total, "country_n")
    fits = (F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("total"))
    pruned = df.groupBy("country_n").agg(F.count_if(fits).alias("left"))
    df = df.join(pruned, "country_n").where(fits | (F.col("left") == 0) | (max_df * F.col("total") < min_df))
    idf = F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1
    raw = tf.join(df.select("country_n", "term", idf.alias("idf")), ["country_n", "term"]).withColumn("x", (1 + F.log("tf")) * F.col("idf"))
    norms = raw.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return raw.join(norms, "entity_id").select("entity_id", "country_n", "term", (F.col("x") / F.col("norm")).alias("w"))


def cosines(pairs: DataFrame, posts: DataFrame, name: str) -> DataFrame:
    """``pairs`` with the cosine ``name``: postings are first cut down to the pairs' records."""
    a = posts.select(F.col("entity_id").alias("s1_id"), "term", F.col("w").alias("wa"))
    b = posts.select(F.col("entity_id").alias("cand_id"), "term", F.col("w").alias("wb"))
    own = pairs.select("s1_id", "cand_id")
    dots = own.join(a, "s1_id").join(b, ["cand_id", "term"]).groupBy("s1_id", "cand_id").agg(F.sum(F.col("wa") * F.col("wb")).alias(name))
    return pairs.join(dots, ["s1_id", "cand_id"], "left").withColumn(name, F.round(F.coalesce(name, F.lit(0.0)), 6))


def whole_group_top(posts: DataFrame, k: int) -> DataFrame:
    """(s1_id, cand_id, cos): the k best records of each entity over its whole country.

    Every pair that shares a term is summed, so the work grows with the square of the most frequent terms kept: a
    reference for samples, as against blocks.
    """
    a = posts.where(F.startswith("entity_id", F.lit("S1"))).select(F.col("entity_id").alias("s1_id"), "country_n", "term", F.col("w").alias("wa"))
    b = posts.where(~F.startswith("entity_id", F.lit("S1"))).select(F.col("entity_id").alias("cand_id"), "country_n", "term", F.col("w").alias("wb"))
    dots = a.join(b, ["country_n", "term"]).groupBy("s1_id", "cand_id").agg(F.round(F.sum(F.col("wa") * F.col("wb")), 6).alias("cos"))
    w = Window.partitionBy("s1_id").orderBy(F.col("cos").desc(), "cand_id")
    return dots.where("cos > 0").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("s1_id", "cand_id", "cos")


def block_top(key_pairs: DataFrame, cos: DataFrame, name: str, k: int) -> DataFrame:
    """(s1_id, cand_id, scheme, key): the k best of each entity in each block by one view."""
    w = Window.partitionBy("s1_id", "scheme", "key").orderBy(F.col(name).desc(), "cand_id")
    both = key_pairs.join(cos.select("s1_id", "cand_id", name), ["s1_id", "cand_id"]).where(F.col(name) > 0)
    return both.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("s1_id", "cand_id", "scheme", "key")
