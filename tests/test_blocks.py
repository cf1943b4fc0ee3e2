"""Queries on candidates that are scored where they meet, against the plain rules over a table of all scored candidates."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.functions import similarity as sim
from recordloom.operators import blocking, decide, evaluate, features
from recordloom.plans import catalogue, stages
from recordloom.plans.stages import stored

ALL, SMALL = (1 << 16, 1 << 15), (20, 30)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Records with repeated ids, also in several countries, an entity of a country without records, and a null id: (folder, norm, keys, scored, truth)."""
    rng, d = random.Random(9), str(tmp_path_factory.mktemp("blocks"))
    vocab = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(400)]
    names = ["same name of many a record"] * 90 + [" ".join(rng.choices(vocab, k=6)) for _ in range(60)]
    rows = [(i, f"{x} {' '.join(rng.choices(vocab, k=rng.choice([0, 3, 30])))}", rng.choice(["en", "en", "fr"])) for i, x in enumerate(names)]
    rows += [(i + 301, t + " more", c) for i, t, c in rows[::4]] + [(3, rows[4][1], "fr"), (3, rows[3][1], "en"), (None, rows[7][1], "en"), (7, rows[8][1], "fr"), (900, rows[9][1], "xx")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{d}/documents.parquet")
    norm = catalogue._norm(spark, d)
    return d, norm, stored(blocking.blocking_keys(norm)), catalogue._scored(norm), catalogue._truth(norm)


def rows_of(df):
    got = sorted(map(tuple, df.collect()))
    assert got
    return got


def plain(name, norm, scored, truth):
    s1, folds = catalogue._s1(norm), evaluate.folds(catalogue._s1(norm))
    if name == "fold_scores":
        c = evaluate.entity_counts(s1, decide.threshold(scored, 0.5, False), truth).join(folds, "s1_id")
        return c.groupBy("fold").agg(F.count("*"), F.round(F.avg(evaluate.f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))), 6))
    if name == "pair_set_comparison":
        a, b = ({(r.s1_id, r.cand_id) for r in x.collect()} for x in (decide.threshold(scored, 0.5, True), decide.expected_f05(scored, 0.1, True)))
        return [(len(a & b), len(a - b), len(b - a), round(len(a & b) / len(a | b), 6))]
    return {
        "adaptive_rule": lambda: decide.adaptive(scored, 0.4, 0.05),
        "cross_fitted": lambda: evaluate.cross_fitted(scored, truth, folds),
        "modal_threshold": lambda: evaluate.most_common(evaluate.cross_fitted(scored, truth, folds), "t", "fold"),
        "best_threshold": lambda: evaluate.best_threshold(evaluate.threshold_curve(s1, scored, truth)),
        "exact_key_augment": lambda: decide.exact_augmented(decide.threshold(scored, 0.9, True), blocking.exact_key_pairs(norm)),
        "id_lists": lambda: catalogue.records.id_lists(norm.where(blocking.is_s1()), decide.threshold(scored, 0.5, True), "ids"),
        "contested_share": lambda: decide.contested_share(scored, 0.3),
        "expected_f05_rule": lambda: decide.expected_f05(scored, 0.1, True),
        "one_to_one_rule": lambda: decide.threshold(scored, 0.5, True),
        "loco_threshold": lambda: evaluate.by_other_countries(scored, truth, catalogue._s1c(norm)),
    }[name]()


@pytest.mark.parametrize("name", ["adaptive_rule", "cross_fitted", "fold_scores", "modal_threshold", "pair_set_comparison", "best_threshold", "exact_key_augment", "id_lists", "contested_share", "expected_f05_rule", "loco_threshold", "one_to_one_rule"])
def test_query_makes_no_table_of_candidates(spark, world, monkeypatch, name):
    d, norm, _, scored, truth = world
    want = plain(name, norm, scored, truth)
    want = want if isinstance(want, list) else rows_of(want)
    monkeypatch.setattr(catalogue, "_cand", lambda norm: pytest.fail("a table of all candidates"))
    assert rows_of(catalogue.queries()[name](spark, d)) == want


@pytest.mark.parametrize("sides", [ALL, SMALL])
def test_counts_and_best_in_blocks(world, sides):
    _, norm, keys, scored, truth = world
    written = []

    def store(df):
        out = stored(df)
        written.append(out.count())
        return out

    # levels, and the true pairs among them
    grid = [0.2, 0.5, 0.8]
    level = F.size(F.filter(F.array(*map(F.lit, grid)), lambda t: t <= F.col("p"))).cast("long").alias("level")
    hit = scored.join(truth.withColumn("y", F.lit(1)), ["s1_id", "cand_id"], "left").select("s1_id", level, "y").where("level > 0")
    got = evaluate.with_hits(*blocking.level_counts(keys, norm, grid, store, sides=sides), truth)
    assert rows_of(got) == rows_of(hit.groupBy("s1_id", "level").agg(F.count("*"), F.count("y")))
    # the best of frames
    frame = norm.where(blocking.is_s1()).select("entity_id", (F.crc32("entity_id") % 3).cast("int").alias("frame")).distinct()
    w = Window.partitionBy("frame", "cand_id").orderBy(F.col("p").desc(), "s1_id")
    want = scored.where("p >= 0.2").join(frame.withColumnRenamed("entity_id", "s1_id"), "s1_id").withColumn("rn", F.row_number().over(w)).where("rn = 1")
    got = blocking.best_from(keys, norm, 0.2, 1, "cand_id", store, sides=sides, own=frame)
    assert rows_of(got.drop("rn")) == rows_of(want.select("s1_id", "cand_id", "p"))
    owners = lambda x: rows_of(x.where("p >= 0.3").groupBy("cand_id").agg(F.least(F.count_distinct("s1_id"), F.lit(2))))
    assert owners(blocking.two_owners(keys, norm, 0.3, store, sides=sides)) == owners(scored)
    if sides == ALL:
        assert max(written) < scored.count() / 2


@pytest.mark.parametrize("sides", [ALL, SMALL])
def test_learn_k_rows_from_blocks(world, sides):
    _, norm, keys, scored, truth = world
    got = decide.learn_k_from(*blocking.first_from(keys, norm, 12, stored, sides=sides), truth)
    want = decide.learn_k_rows(scored, truth)
    assert got.columns == want.columns
    # of equal pairs of a repeated id any may come first, but their scores are equal
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("sides", [blocking.SIDES, SMALL])
def test_jaro_winkler_of_all_candidates(world, monkeypatch, sides):
    _, norm, keys, _, _ = world
    names = ["nm_jw", "core_jw"]
    want = rows_of(features.string_features(catalogue._cand(norm), norm, names))
    monkeypatch.setattr(blocking.each_candidate, "__defaults__", (blocking.MAX_BLOCK, sides))
    assert rows_of(features.jaro_winkler_from(keys, norm, names, stored)) == want


def test_jaro_winkler_of_many_pairs(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abc dé", k=rng.randrange(0, 14))) for _ in range(60)] + ["x" * 64, "x" * 65, "", "acme road company", "acme raod compnay"]
    texts += ["".join(rng.choices("abcdefghij klmno", k=rng.randrange(20, 70))) for _ in range(20)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    want = [sim.jaro_winkler(texts[a], texts[b]) for a, b in zip(i, j, strict=True)]
    assert sim.jaro_winkler_many(texts, texts, i, j).tolist() == want
    monkeypatch.setattr(sim, "CELLS", 1)
    assert sim.jaro_winkler_many(texts, texts, i, j).tolist() == want


def test_blocks_share_their_slices(spark, world):
    """However many blocks there are, a record with its words is written once; and of the tables on the way only the result stays."""
    _, norm, keys, _, _ = world
    counts = []
    for sides in (ALL, SMALL):
        blocks = blocking._word_blocks(keys, norm, stored, blocking.MAX_BLOCK, sides)
        counts.append((len(blocks.blocks), spark.read.parquet(blocks.folder).count()))
    assert counts[0][0] < counts[1][0] and counts[0][1] == counts[1][1] > 0
    mark = stages.written()
    best = catalogue._best(norm, 0.2, 1, "cand_id")
    assert stages.written() == mark + 1 and best.count() > 0
