"""Macro F0.5 over all entities, grids of thresholds, folds, blocking figures and output checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators import decide

GRID = [round(0.2 + 0.025 * i, 3) for i in range(31)]


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    return F.when(n_true == 0, F.when(n_pred == 0, 1.0).otherwise(0.0)).when((n_pred == 0) | (tp == 0), 0.0).otherwise(1.25 * tp / (0.25 * n_true + n_pred))


def entity_counts(ids: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, tp, n_pred, n_true) of every entity of ``ids``, also those without pairs."""
    hit = pred.select("s1_id", "cand_id").join(truth.select("s1_id", "cand_id").withColumn("y", F.lit(1)), ["s1_id", "cand_id"], "left")
    p = hit.groupBy("s1_id").agg(F.count("*").alias("n_pred"), F.count("y").alias("tp"))
    t = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return ids.select("s1_id").join(p, "s1_id", "left").join(t, "s1_id", "left").select("s1_id", zero("tp"), zero("n_pred"), zero("n_true"))


def macro_f05(ids: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    c = entity_counts(ids, pred, truth)
    one = f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))
    p, r = F.sum("n_pred"), F.sum("n_true")
    return c.agg(
        F.count("*").alias("entities"), F.round(F.avg(one), 6).alias("macro_f05"), F.sum("tp").alias("tp"), p.alias("n_pred"), r.alias("n_true"),
        F.round(F.when(p == 0, 1.0).otherwise(F.sum("tp") / F.when(p == 0, 1).otherwise(p)), 6).alias("precision"),
        F.round(F.when(r == 0, 1.0).otherwise(F.sum("tp") / F.when(r == 0, 1).otherwise(r)), 6).alias("recall"),
    )


def threshold_curve(ids: DataFrame, pairs: DataFrame, truth: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """(t, macro_f05) over the grid in one job.  ``ids`` may have a column frame, then per frame.

    A pair counts at every threshold up to its score: an entity's pairs are counted by the thresholds that they reach.
    """
    steps = F.array(*[F.lit(t) for t in grid or GRID])
    frames = [c for c in ("frame",) if c in ids.columns]
    level = F.size(F.filter(steps, lambda t: t <= F.col("p"))).cast("long").alias("level")
    hit = pairs.join(truth.withColumn("y", F.lit(1)), ["s1_id", "cand_id"], "left").select(*frames, "s1_id", "y", level).where("level > 0")
    return level_curve(ids, hit.groupBy(*frames, "s1_id", "level").agg(F.count("*").alias("n"), F.count("y").alias("tp")), truth, grid)


def with_hits(counts: DataFrame, near: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, level, n, tp) from ``blocking.level_counts``."""
    hit = near.join(truth.select("s1_id", "cand_id"), ["s1_id", "cand_id"]).groupBy("s1_id", "level").agg(F.count("*").alias("tp"))
    return counts.join(hit, ["s1_id", "level"], "left").na.fill(0, ["tp"])


def counts_at(ids: DataFrame, levels: DataFrame, truth: DataFrame) -> DataFrame:
    """``entity_counts`` of all pairs of ``levels`` (s1_id, level, n, tp)."""
    p = levels.groupBy("s1_id").agg(F.sum("n").alias("n_pred"), F.sum("tp").alias("tp"))
    t = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return ids.select("s1_id").join(p, "s1_id", "left").join(t, "s1_id", "left").select("s1_id", zero("tp"), zero("n_pred"), zero("n_true"))


def level_curve(ids: DataFrame, levels: DataFrame, truth: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """``threshold_curve`` from ``levels`` (s1_id, level, n, tp): pairs, and true ones, that reach just so many thresholds of the grid; per frame of ``ids`` and, if it has the column, of ``levels``.

    Thresholds are expanded in the tasks that have all levels of an entity, so no row for an entity and a threshold is shuffled.
    """
    grid, frames = grid or GRID, [c for c in ("frame",) if c in ids.columns]
    key = [*(c for c in frames if c in levels.columns), "s1_id"]
    of = levels.groupBy(*key).agg(F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in ("level", "n", "tp")])).alias("x"))
    n = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    rows = ids.select(*frames, "s1_id").join(of, key, "left").join(n, "s1_id", "left").na.fill(0, ["n_true"])
    steps = F.array(*[F.struct(F.lit(k + 1).alias("k"), F.lit(t).alias("t")) for k, t in enumerate(grid)])
    each = rows.select(*frames, "n_true", "x", F.explode(steps).alias("s"))
    reach = lambda c: F.coalesce(F.aggregate("x", F.lit(0).cast("long"), lambda so_far, e: so_far + F.when(e["level"] >= F.col("s.k"), e[c]).otherwise(0)), F.lit(0))
    score = f05(reach("tp"), reach("n"), F.col("n_true"))
    return each.select(*frames, F.col("s.t").alias("t"), score.alias("f")).groupBy(*frames, "t").agg(F.round(F.avg("f"), 6).alias("macro_f05"))


def best_threshold(curve: DataFrame, *frames: str) -> DataFrame:
    """The first of the best thresholds."""
    w = Window.partitionBy(*frames).orderBy(F.col("macro_f05").desc(), "t") if frames else Window.orderBy(F.col("macro_f05").desc(), "t")
    return curve.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def folds(ids: DataFrame, n: int = 5) -> DataFrame:
    """(s1_id, fold): entities in the order of their digests, dealt in turn, so folds differ by one at most."""
    w = Window.partitionBy("bucket").orderBy("h", "s1_id")
    # ranks within 256 digest buckets plus the buckets' sizes: no task sees all ids
    h = ids.select("s1_id", F.md5(F.col("s1_id").cast("binary")).alias("h")).withColumn("bucket", F.left("h", F.lit(2)))
    sizes = h.groupBy("bucket").agg(F.count("*").alias("n"))
    before = sizes.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return h.withColumn("r", F.row_number().over(w)).join(F.broadcast(before), "bucket").select("s1_id", ((F.col("r") - 1 + F.col("before")) % n).cast("int").alias("fold"))


def of_counts(ids: DataFrame, n_pred: DataFrame, hit: DataFrame, truth: DataFrame) -> DataFrame:
    """``entity_counts`` from the number of predicted pairs (s1_id, n_pred) and the true ones among them ``hit`` (s1_id, cand_id)."""
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    tp, t = (x.groupBy("s1_id").agg(F.count("*").alias(n)) for x, n in ((hit, "tp"), (truth, "n_true")))
    return ids.select("s1_id").join(n_pred, "s1_id", "left").join(tp, "s1_id", "left").join(t, "s1_id", "left").select("s1_id", zero("tp"), zero("n_pred"), zero("n_true"))


def blocking_report(ids: DataFrame, cand: DataFrame, truth: DataFrame) -> DataFrame:
    return blocking_figures(entity_counts(ids, cand, truth))


def blocking_figures(c: DataFrame) -> DataFrame:
    found = F.sum("tp") / F.sum("n_true")
    cover = F.avg(F.when(F.col("n_true") > 0, (F.col("tp") == F.col("n_true")).cast("double")))
    oracle = F.when(F.col("n_true") == 0, 1.0).when(F.col("tp") == 0, 0.0).otherwise(1.25 * (F.col("tp") / F.col("n_true")) / (0.25 + F.col("tp") / F.col("n_true")))
    return c.agg(F.sum("n_pred").alias("pairs"), F.round(found, 6).alias("pair_recall"), F.round(cover, 6).alias("entity_cover"), F.round(F.avg("n_pred"), 6).alias("per_entity"), F.round(F.avg(oracle), 6).alias("oracle_f05"))


def cap_sweep(ids: DataFrame, pairs: DataFrame, truth: DataFrame, scores: dict[str, Column], caps: list[int]) -> DataFrame:
    """(score, cap, hits, recall, cover, oracle_f05) of the best ``cap`` candidates of each entity by each score; cap 0 is no cap.

    An entity's hits at all caps are counted in one row, so nothing is expanded.
    """
    place = lambda s: F.row_number().over(Window.partitionBy("s1_id").orderBy(s.desc(), "cand_id"))
    ranked = pairs.select("s1_id", "cand_id", *[place(s).alias(f"r_{i}") for i, s in enumerate(scores.values())])
    hit = ranked.join(truth.select("s1_id", "cand_id"), ["s1_id", "cand_id"])
    count = [F.count_if(F.col(f"r_{i}") <= (c or 1 << 30)).alias(f"h_{i}_{c}") for i in range(len(scores)) for c in caps]
    n = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    each = ids.select("s1_id").join(n, "s1_id", "left").join(hit.groupBy("s1_id").agg(*count), "s1_id", "left").na.fill(0)
    rows = [F.struct(F.lit(name).alias("score"), F.lit(c).alias("cap"), F.col(f"h_{i}_{c}").alias("h")) for i, name in enumerate(scores) for c in caps]
    x = each.select("n_true", F.explode(F.array(*rows)).alias("x")).select("n_true", "x.*")
    share = F.col("h") / F.col("n_true")
    best = F.when(F.col("n_true") == 0, 1.0).when(F.col("h") == 0, 0.0).otherwise(1.25 * share / (0.25 + share))
    total = F.sum("n_true")
    return x.groupBy("score", "cap").agg(
        F.sum("h").alias("hits"),
        F.round(F.sum("h") / F.when(total > 0, total), 6).alias("recall"),
        F.round(F.avg((F.col("h") == F.col("n_true")).cast("double")), 6).alias("cover"),
        F.round(F.avg(best), 6).alias("oracle_f05"),
    )


SEP = "\x1f"


def _tagged(df: DataFrame, frames: DataFrame, *columns: str) -> DataFrame:
    """``df`` once per frame (frame, s1_id) of its entity, with the frame's name before the ids: a rule sees frames as separate worlds."""
    return df.join(frames, "s1_id").withColumns({c: F.concat_ws(SEP, "frame", c) for c in columns}).drop("frame")


def cross_fitted_rule(pairs: DataFrame, truth: DataFrame, folds: DataFrame, rule: Callable[[DataFrame, object], DataFrame], grid: list, n: int = 5) -> DataFrame:
    """(fold, choice, macro_f05): per fold the first of the best parameters on the other folds, and its score on this one.

    ``rule`` maps pairs (s1_id, cand_id, p) and an element of ``grid`` to the kept pairs; ``choice`` is the place in the
    grid.  Every frame is a world of its own (an award within it, too), all frames and parameters are one job, and
    entities without pairs count.
    """
    every = F.explode(F.array(*[F.lit(i) for i in range(n)])).alias("f")
    train = folds.select("s1_id", "fold", every).where("f <> fold").select(F.concat(F.lit("t"), F.col("f").cast("string")).alias("frame"), "s1_id")
    frames = train.unionByName(folds.select(F.concat(F.lit("v"), F.col("fold").cast("string")).alias("frame"), "s1_id"))
    world, right = _tagged(pairs.select("s1_id", "cand_id", "p"), frames, "s1_id", "cand_id"), _tagged(truth.select("s1_id", "cand_id"), frames, "s1_id", "cand_id")
    kept = None
    for i, g in enumerate(grid):
        one = rule(world, g).select("s1_id", "cand_id", F.lit(i).alias("choice"))
        kept = one if kept is None else kept.unionByName(one)
    hit = kept.join(right.withColumn("y", F.lit(1)), ["s1_id", "cand_id"], "left").groupBy("s1_id", "choice").agg(F.count("*").alias("n_pred"), F.count("y").alias("tp"))
    ids = frames.select("frame", F.concat_ws(SEP, "frame", "s1_id").alias("s1_id"), F.explode(F.array(*[F.lit(i) for i in range(len(grid))])).alias("choice"))
    n_true = right.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    rows = ids.join(hit, ["s1_id", "choice"], "left").join(n_true, "s1_id", "left").na.fill(0, ["n_pred", "tp", "n_true"])
    score = rows.groupBy("frame", "choice").agg(F.round(F.avg(f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))), 6).alias("macro_f05"))
    fold = F.substring("frame", 2, 9).cast("int").alias("fold")
    first = Window.partitionBy("frame").orderBy(F.col("macro_f05").desc(), "choice")
    best = score.where(F.startswith("frame", F.lit("t"))).withColumn("rn", F.row_number().over(first)).where("rn = 1").select(fold, "choice")
    return score.where(F.startswith("frame", F.lit("v"))).select(fold, "choice", "macro_f05").join(best, ["fold", "choice"])


def verdict(base: list[float], other: list[float], noise: float | None = None, folds_needed: int = 4) -> dict:
    """Whether a rule's fold scores beat the base's: in at least ``folds_needed`` folds and, if the noise is known, by more than twice it."""
    gain = sum(other) / len(other) - sum(base) / len(base)
    wins = sum(b > a for a, b in zip(base, other, strict=True))
    enough = gain > 0 if noise is None else noise == noise and gain > 2 * noise
    return {"gain": gain, "folds_improved": wins, "needed": 0.0 if noise is None else 2 * noise, "decision": "accept" if enough and wins >= folds_needed else "inconclusive"}


def most_common(df: DataFrame, column: str, order: str) -> DataFrame:
    """(column, n): the most frequent value, of equals that with the smallest ``order``."""
    n = df.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return n.orderBy(F.col("n").desc(), "first").limit(1).select(column, "n")


def empty_baseline(ids: DataFrame, truth: DataFrame) -> DataFrame:
    """(singletons, macro_f05) of a prediction of nothing: both the share of entities without a match."""
    own = ids.select("s1_id").join(truth.select("s1_id").distinct().withColumn("y", F.lit(1)), "s1_id", "left")
    share = F.round(F.avg(F.col("y").isNull().cast("double")), 6)
    return own.agg(share.alias("singletons"), share.alias("macro_f05"))


def numbered(df: DataFrame, order: list[str], store) -> DataFrame:
    """``df`` with n = 1, 2, ... in the given order: a range sort, and a prefix sum over its partitions' sizes."""
    rows = store(df.orderBy(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("part", part).join(before, "part").withColumn("n", own + F.col("before") + 1).drop("at", "part", "before")


def output_checks(expected: DataFrame, s23: DataFrame, matched: DataFrame, cand: DataFrame) -> DataFrame:
    """(check, bad): how much of two outputs breaks each rule; all 0 in a good run.

    ``expected`` (n, s1_id): the entities in their order; ``matched`` and ``cand`` (n, s1_id, ids): lines of the outputs
    by number, ids joined by commas; ``s23`` (entity_id).
    """
    split = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x != "")
    m = matched.select("n", F.col("s1_id").alias("ms"), split(F.col("ids")).alias("m"))
    c = cand.select("n", F.col("s1_id").alias("cs"), split(F.col("ids")).alias("c"))
    rows = expected.select("n", "s1_id").join(m, "n", "full").join(c, "n", "full")
    none = F.array().cast("array<string>")
    own, allowed = F.coalesce("m", none), F.coalesce("c", none)
    bad = rows.agg(
        F.count_if(F.col("s1_id").isNotNull() & (F.col("ms").isNull() | F.col("cs").isNull())).alias("missing_rows"),
        F.count_if(F.col("s1_id").isNull()).alias("extra_rows"),
        F.count_if(F.col("s1_id").isNotNull() & ((F.col("ms") != F.col("s1_id")) | (F.col("cs") != F.col("s1_id")))).alias("misaligned"),
        F.count_if(F.size(F.array_distinct(own)) < F.size(own)).alias("dup_in_list"),
        F.count_if(F.size(F.array_except(own, allowed)) > 0).alias("not_in_candidates"),
        F.coalesce(F.sum(F.size(F.filter(own, lambda x: ~x.rlike("^S[23]-")))), F.lit(0)).cast("long").alias("bad_prefix"),
    )
    unknown = c.select(F.explode("c").alias("entity_id")).join(s23.select("entity_id").distinct(), "entity_id", "left_anti").agg(F.count("*").alias("bad"))
    repeated = m.groupBy("ms").agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("bad"))
    names = ["missing_rows", "extra_rows", "misaligned", "dup_in_list", "not_in_candidates", "bad_prefix"]
    out = bad.select(F.explode(F.array(*[F.struct(F.lit(x).alias("check"), F.col(x).alias("bad")) for x in names])).alias("x")).select("x.check", "x.bad")
    return out.unionByName(unknown.select(F.lit("unknown_ids").alias("check"), "bad")).unionByName(repeated.select(F.lit("repeated_entities").alias("check"), "bad"))


def verify(expected: DataFrame, s23: DataFrame, matched: DataFrame, cand: DataFrame, headers_right: bool = True) -> dict[str, int]:
    """Figures of two good outputs; ValueError with the broken rules otherwise."""
    bad = {r.check: r.bad for r in output_checks(expected, s23, matched, cand).collect() if r.bad}
    if not headers_right:
        bad["header"] = 1
    if bad:
        raise ValueError(f"outputs break rules: {bad}")
    n = lambda df: df.select(F.when(F.col("ids") == "", 0).otherwise(F.size(F.split("ids", ","))).alias("k"))
    m = n(matched).agg(F.count("*"), F.count_if(F.col("k") > 0), F.coalesce(F.sum("k"), F.lit(0))).first()
    return {"rows": m[0], "nonempty_rows": m[1], "matched_ids": m[2], "candidate_ids": n(cand).agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]}


#: Limits of the audit: gap of non-empty shares; rate of an unseen country against the lowest and highest of the others.
SHARE_GAP, LOW, HIGH = 0.05, 0.80, 1.30


def rate_audit(by_country: DataFrame, reference_share: Column, unseen: str) -> DataFrame:
    """(check, value, low, high, ok) from (country_n, n, nonempty): shares of entities with a prediction, against their limits."""
    rate = F.col("nonempty") / F.greatest("n", F.lit(1))
    seen = F.col("country_n") != unseen
    x = by_country.agg(
        (F.sum("nonempty") / F.greatest(F.sum("n"), F.lit(1))).alias("share"), F.max(F.when(~seen, rate)).alias("new"), F.min(F.when(seen, rate)).alias("low"), F.max(F.when(seen, rate)).alias("high")
    ).withColumn("ref", reference_share)
    r = lambda c: F.round(c.cast("double"), 6)
    row = lambda name, value, low, high: F.struct(F.lit(name).alias("check"), r(value).alias("value"), r(low).alias("low"), r(high).alias("high"))
    rows = [
        row("share_gap", F.abs(F.col("share") - F.col("ref")), F.lit(0.0), F.lit(SHARE_GAP)),
        row("unseen_not_collapsed", F.col("new"), LOW * F.coalesce("low", F.lit(0.0)), F.lit(1.0)),
        row("unseen_not_inflated", F.col("new"), F.lit(0.0), HIGH * F.coalesce("high", F.lit(1.0))),
    ]
    out = x.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    return out.withColumn("ok", F.coalesce((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")), F.lit(False)))


def cross_fitted(pairs: DataFrame, truth: DataFrame, fold_of: DataFrame, one_to_one: bool = True, n: int = 5) -> DataFrame:
    """(fold, t, macro_f05): per fold the best threshold of the other folds, and its score on this one; awards within a frame.

    An award commutes with one threshold, so it is made once for the whole grid.
    """
    every = F.explode(F.array(*[F.lit(i) for i in range(n)])).alias("frame")
    train = fold_of.select("s1_id", "fold", every).where("frame <> fold").select("frame", "s1_id")
    return _transferred(train, fold_of.select(F.col("fold").alias("frame"), "s1_id"), pairs, truth, one_to_one).withColumnRenamed("frame", "fold")


def _country_frames(country_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frame, s1_id) of the entities of all other countries, and of the country's own."""
    names = sorted(r[0] for r in country_of.select("country_n").distinct().collect())  # countries
    every = F.explode(F.array(*[F.lit(x) for x in names])).alias("frame")
    train = country_of.select("s1_id", "country_n", every).where("frame <> country_n").select("frame", "s1_id")
    return train, country_of.select(F.col("country_n").alias("frame"), "s1_id")


def by_other_countries(pairs: DataFrame, truth: DataFrame, country_of: DataFrame, one_to_one: bool = False) -> DataFrame:
    """(country_n, t, macro_f05): per country the best threshold of all others, and its score on this one."""
    return _transferred(*_country_frames(country_of), pairs, truth, one_to_one).withColumnRenamed("frame", "country_n")


def by_other_countries_levels(levels: DataFrame, truth: DataFrame, country_of: DataFrame) -> DataFrame:
    """``by_other_countries`` without an award, from ``levels`` (s1_id, level, n, tp): an entity's counts are the same in all frames."""

    def curve(ids: DataFrame) -> DataFrame:
        # a repeated id has its pairs as often as it stands in the frame
        times = ids.groupBy("frame", "s1_id").agg(F.count("*").alias("times"))
        own = levels
        if times.where("times > 1").take(1):
            own = levels.join(times, "s1_id").select("frame", "s1_id", "level", *[(F.col(c) * F.col("times")).alias(c) for c in ("n", "tp")])
        return level_curve(ids, own, truth)

    train, own = _country_frames(country_of)
    best = best_threshold(curve(train), "frame").select("frame", "t")
    return curve(own).join(best, ["frame", "t"]).withColumnRenamed("frame", "country_n")


def _transferred(train: DataFrame, own: DataFrame, pairs: DataFrame, truth: DataFrame, one_to_one: bool) -> DataFrame:
    def curve(ids: DataFrame) -> DataFrame:
        framed = pairs.join(ids, "s1_id")
        return threshold_curve(ids, decide.award(framed, "frame") if one_to_one else framed, truth)

    best = best_threshold(curve(train), "frame").select("frame", "t")
    return curve(own).join(best, ["frame", "t"])


def cv_report(ids: DataFrame, pairs: DataFrame, truth: DataFrame, fold_of: DataFrame, one_to_one: bool = True, country_of: DataFrame | None = None) -> dict:
    """Best threshold, cross-fitted score, precision and recall, baseline, curve, and each country under the others' threshold."""
    owned = decide.award(pairs) if one_to_one else pairs
    curve = sorted((r.t, r.macro_f05) for r in threshold_curve(ids, owned, truth).collect())
    best = max(curve, key=lambda x: (x[1], -x[0]))[0]
    kept = owned.where(F.col("p") >= best)
    at, per_fold = macro_f05(ids, kept, truth).first(), cross_fitted(pairs, truth, fold_of, one_to_one).orderBy("fold").collect()
    report = {
        "oof_best_t": best, "oof_macro_f05_at_best_t": at.macro_f05, "oof_pair_precision": at.precision, "oof_pair_recall": at.recall,
        "cv_macro_f05_cross_fitted": round(sum(r.macro_f05 for r in per_fold) / max(1, len(per_fold)), 6), "fold_scores": [r.macro_f05 for r in per_fold], "fold_thresholds": [r.t for r in per_fold],
        "empty_baseline_macro_f05": empty_baseline(ids, truth).first().macro_f05, "nonempty_share": round(kept.select("s1_id").distinct().count() / max(1, at.entities), 6), "threshold_curve": [list(x) for x in curve],
    }
    if country_of is not None:
        report["without_country"] = {r.country_n: {"threshold_of_others": r.t, "score": r.macro_f05} for r in by_other_countries(pairs, truth, country_of, one_to_one).collect()}
    return report
