"""Decision rules over scored pairs (s1_id, cand_id, p): each returns the kept pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def award(pairs: DataFrame, *frames: str) -> DataFrame:
    """Each candidate goes to its best entity, ties to the smaller id."""
    w = Window.partitionBy(*frames, "cand_id").orderBy(F.col("p").desc(), "s1_id")
    return pairs.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def threshold(pairs: DataFrame, t: float, one_to_one: bool) -> DataFrame:
    kept = pairs.where(F.col("p") >= t)
    return award(kept) if one_to_one else kept


def relative(pairs: DataFrame, t: float, alpha: float, one_to_one: bool = True) -> DataFrame:
    best = F.max("p").over(Window.partitionBy("s1_id"))
    return threshold(pairs, t, one_to_one).withColumn("best", best).where(F.col("p") >= alpha * F.col("best")).drop("best")


def adaptive(pairs: DataFrame, t: float, beta: float, one_to_one: bool = True) -> DataFrame:
    """The threshold rises with the logarithm of the entity's candidates; the award follows the filter."""
    n = F.count("*").over(Window.partitionBy("s1_id"))
    kept = pairs.withColumn("n", n).where(F.col("p") >= adaptive_floor("n", t, beta)).drop("n")
    return award(kept) if one_to_one else kept


def adaptive_floor(n: str, t: float, beta: float) -> Column:
    """The threshold of an entity with so many candidates."""
    return t + beta * (F.log1p(n) - F.log1p(F.lit(8)))


def expected_f05(pairs: DataFrame, floor: float = 0.0, one_to_one: bool = True) -> DataFrame:
    """The k best of each entity for the k with the largest expected F0.5, if that beats keeping none."""
    base = threshold(pairs, floor, one_to_one)
    whole = Window.partitionBy("s1_id")
    order = whole.orderBy(F.col("p").desc(), "cand_id")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    x = base.withColumns({"k": F.row_number().over(order), "top": F.sum("p").over(run), "all": F.sum("p").over(whole), "none": F.exp(F.sum(F.log1p(-F.least("p", F.lit(1 - 1e-12)))).over(whole))})
    x = x.withColumn("f", 1.25 * F.col("top") / (0.25 * F.col("all") + F.col("k")))
    x = x.withColumn("best", F.max("f").over(whole))
    x = x.withColumn("stop", F.min(F.when(F.col("f") >= F.col("best") - 1e-12, F.col("k"))).over(whole))
    return x.where((F.col("best") > F.col("none")) & (F.col("k") <= F.col("stop"))).select(*pairs.columns)


def top1(pairs: DataFrame, t: float, floor: float, store, one_to_one: bool = True) -> DataFrame:
    """The threshold rule; then each entity still without a match takes its best free record, best pairs first.

    Greedy matching by rounds of mutual best pairs.  ``store`` writes a round's table to the shared folder.
    """
    first = threshold(pairs, t, one_to_one)
    left = pairs.where(F.col("p") >= floor).join(first.select("s1_id").distinct(), "s1_id", "left_anti").join(first.select("cand_id").distinct(), "cand_id", "left_anti")
    out, left = store(first.select("s1_id", "cand_id", "p")), store(left.select("s1_id", "cand_id", "p"))
    while left.take(1):
        order = [F.col("p").desc(), F.col("s1_id"), F.col("cand_id")]
        mutual = left.withColumn("a", F.row_number().over(Window.partitionBy("s1_id").orderBy(*order))).withColumn("b", F.row_number().over(Window.partitionBy("cand_id").orderBy(*order)))
        won = store(mutual.where("a = 1 AND b = 1").select("s1_id", "cand_id", "p"))
        out = out.unionByName(won)
        left = store(left.join(won.select("s1_id"), "s1_id", "left_anti").join(won.select("cand_id"), "cand_id", "left_anti").select("s1_id", "cand_id", "p"))
    return out


def contested_share(pairs: DataFrame, t: float) -> DataFrame:
    owners = pairs.where(F.col("p") >= t).groupBy("cand_id").agg(F.count_distinct("s1_id").alias("n"))
    return owners.agg(F.count("*").alias("records"), F.round(F.coalesce(F.avg((F.col("n") > 1).cast("double")), F.lit(0.0)), 6).alias("share"))


def exact_augmented(kept: DataFrame, exact: DataFrame) -> DataFrame:
    """``kept`` plus exact-key pairs of records that no kept pair owns; a contested one goes to the smallest id."""
    free = exact.join(kept.select("cand_id").distinct(), "cand_id", "left_anti")
    w = Window.partitionBy("cand_id").orderBy("s1_id")
    won = free.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("s1_id", "cand_id")
    return kept.select("s1_id", "cand_id").unionByName(won)


def ratio6(num: Column, den: Column) -> Column:
    """num / den of whole numbers, den > 0, rounded half up at six digits by whole-number arithmetic alone."""
    return F.call_function("div", num.cast("long") * 2_000_000 + den.cast("long"), 2 * den.cast("long")) / 1e6


K_FEATURES = ["k", "n_cands", "k_frac", "cum_p", "p_k", "p1", "gap_1k", "mean_top_k", "sum_p", "p_empty", "exp_f05", "n_above_50", "n_above_80"]
K_MAX = 12


def _marked(pairs: DataFrame, truth: DataFrame | None) -> DataFrame:
    return pairs.withColumn("y", F.lit(0)) if truth is None else pairs.join(truth.select("s1_id", "cand_id").withColumn("y", F.lit(1)), ["s1_id", "cand_id"], "left").na.fill(0, ["y"])


def learn_k_rows(pairs: DataFrame, truth: DataFrame | None, most: int = K_MAX) -> DataFrame:
    """One row per entity and k = 0 .. min(n, most): thirteen features of its k best and, with ``truth``, the F0.5 they would score.

    Scores count in millionths, so sums and quotients are exact.
    """
    whole = Window.partitionBy("s1_id")
    hit = _marked(pairs, truth).withColumn("m", F.round(F.col("p") * 1e6).cast("long"))
    empty = F.exp(F.sum(F.log1p(-F.least("p", F.lit(1 - 1e-12)))).over(whole))
    x = hit.withColumns(
        {
            "n": F.count("*").over(whole), "all": F.sum("m").over(whole), "best": F.max("m").over(whole), "p_empty": empty,
            "n_above_50": F.count_if(F.col("m") >= 500_000).over(whole), "n_above_80": F.count_if(F.col("m") >= 800_000).over(whole),
        }
    )
    return _k_rows(x, truth, most)


def learn_k_from(top: DataFrame, sums: DataFrame, truth: DataFrame | None, most: int = K_MAX) -> DataFrame:
    """``learn_k_rows`` from what ``blocking.first_from`` gives: the ``most`` best pairs of each entity, and sums over all of them."""
    n = sums.select("s1_id", "n", F.col("total").alias("all"), "best", F.exp("logs").alias("p_empty"), F.col("n_50").alias("n_above_50"), F.col("n_80").alias("n_above_80"))
    return _k_rows(_marked(top, truth).join(n, "s1_id"), truth, most)


def _k_rows(x: DataFrame, truth: DataFrame | None, most: int) -> DataFrame:
    order = Window.partitionBy("s1_id").orderBy(F.col("m").desc(), "cand_id")
    x = x.withColumn("k", F.row_number().over(order))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"cum": F.sum("m").over(run), "tp": F.sum("y").over(run).cast("long")}).where(F.col("k") <= most)
    keep = ["s1_id", "n", "all", "best", "p_empty", "n_above_50", "n_above_80"]
    zero = x.where("k = 1").select(*keep, F.lit(0).alias("k"), *[F.lit(0).cast("long").alias(c) for c in ("cum", "tp", "m")])
    rows = x.select(*keep, "k", "cum", "tp", "m").unionByName(zero)
    if truth is not None:
        rows = rows.join(truth.groupBy("s1_id").agg(F.count("*").alias("nt")), "s1_id", "left").na.fill(0, ["nt"])
    k, safe = F.col("k"), F.greatest("k", F.lit(1))
    out = [
        "s1_id", k.cast("long").alias("k"), F.col("n").alias("n_cands"), ratio6(k, F.col("n")).alias("k_frac"), (F.col("cum") / 1e6).alias("cum_p"), (F.col("m") / 1e6).alias("p_k"), (F.col("best") / 1e6).alias("p1"),
        ((F.col("best") - F.col("m")) / 1e6).alias("gap_1k"), ratio6(F.col("cum"), safe * 1_000_000).alias("mean_top_k"), (F.col("all") / 1e6).alias("sum_p"), F.round("p_empty", 6).alias("p_empty"),
        F.when(k == 0, F.round("p_empty", 6)).otherwise(ratio6(5 * F.col("cum"), F.col("all") + safe.cast("long") * 4_000_000)).alias("exp_f05"), "n_above_50", "n_above_80",
    ]
    if truth is not None:
        real = F.when((F.col("nt") == 0) & (k == 0), 1.0).when((F.col("nt") == 0) | (F.col("tp") == 0), 0.0).otherwise(ratio6(5 * F.col("tp"), F.col("nt") + 4 * safe))
        out.append(real.alias("target"))
    return rows.select(*out)


def best_k(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs kept when each entity takes its k best for the k of the largest ``predicted`` of ``rows`` (s1_id, k, predicted); ties to the smaller k."""
    first = Window.partitionBy("s1_id").orderBy(F.col("predicted").desc(), "k")
    chosen = rows.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("s1_id", F.col("k").alias("take"))
    place = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.col("p").desc(), "cand_id"))
    return pairs.withColumn("at", place).join(chosen, "s1_id").where("at <= take").select(*pairs.columns)
