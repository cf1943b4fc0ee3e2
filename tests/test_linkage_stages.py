"""Sinks, folds, samples, candidate generation, models and reports against plain Python."""

import hashlib
import json
import math
import random
import unicodedata
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordloom.functions import similarity as sim
from recordloom.functions import text
from recordloom.operators import blocking, decide, evaluate, features, model, sampling, vectors
from recordloom.plans import stages
from recordloom.plans.stages import stored
from recordloom.sources import outputs, records

PAIR = "s1_id string, cand_id string"


def tsv(path: Path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join("\t".join(r) for r in [header, *rows]) + "\n")


@pytest.fixture(scope="module")
def split(tmp_path_factory):
    """A split in the original layout: 60 entities, 240 records."""
    root, rng = tmp_path_factory.mktemp("data"), random.Random(4)
    row = lambda i: (i, f'name "{rng.randrange(9)}" é', rng.choice(["", "NA", " 1 road\\x"]), rng.choice(["US", "FR"]))
    s1, s2, s3 = ([row(f"S{k}-{i}") for i in rng.sample(range(9000), n)] for k, n in ((1, 60), (2, 150), (3, 90)))
    for k, rows in ((1, s1), (2, s2), (3, s3)):
        tsv(root / f"train/train_source{k}.tsv", records.COLS, rows)
    pool = [r[0] for r in s2 + s3]
    truth = [(r[0], ",".join(rng.sample(pool, rng.randrange(4)))) for r in s1]
    tsv(root / "train/train_ground_truth.tsv", outputs.MATCHED, truth)
    return root, s1, s2, s3, truth


def lines(spark, folder):
    path = f"{folder}.joined"
    outputs.single_file(spark, str(folder), path)
    return Path(path).read_text()


def test_split_and_truth(spark, split):
    root, s1, s2, s3, truth = split
    one, rest = records.load_split(spark, str(root), "train")
    assert [tuple(r) for r in one.collect()] == s1 and sorted(map(tuple, rest.collect())) == sorted(s2 + s3)
    got = {(r.s1_id, r.cand_id) for r in records.truth_pairs(records.load_truth(spark, f"{root}/train/train_ground_truth.tsv")).collect()}
    assert got == {(i, x) for i, ids in truth for x in ids.split(",") if x}
    assert records.row_count(one).first().rows == 60


def test_sinks_byte_for_byte(spark, split, tmp_path):
    root, s1, _, _, truth = split
    one = records.read_tsv(spark, f"{root}/train/train_source1.tsv", with_place=True)
    pairs = [(i, x) for i, ids in truth for x in ids.split(",") if x]
    df = spark.createDataFrame(pairs + pairs[:5], PAIR).repartition(3)
    outputs.write_matched(one, df, f"{tmp_path}/m")
    want = "source1_entity_id\tmatched_entity_ids\n" + "".join(f"{i}\t{','.join(sorted(filter(None, ids.split(','))))}\n" for i, ids in truth)
    assert lines(spark, tmp_path / "m") == want
    outputs.write_candidates(one, df, f"{tmp_path}/c")
    assert lines(spark, tmp_path / "c") == want.replace("matched_entity_ids", "candidate_entity_ids")
    outputs.write_empty(one, f"{tmp_path}/empty")
    assert lines(spark, tmp_path / "empty/matching_results.tsv") == "source1_entity_id\tmatched_entity_ids\n" + "".join(f"{r[0]}\t\n" for r in s1)
    assert lines(spark, tmp_path / "empty/candidate_pairs.tsv").startswith("source1_entity_id\tcandidate_entity_ids\n")
    records.copy_some(spark, f"{root}/train/train_source1.tsv", spark.createDataFrame([(r[0],) for r in s1[::3]], "entity_id string"), f"{tmp_path}/some")
    assert lines(spark, tmp_path / "some") == "\n".join("\t".join(r) for r in [tuple(records.COLS), *s1[::3]]) + "\n"
    # the outputs read back pass the checks, and spoilt ones raise
    expected = evaluate.numbered(one.select("place", F.col("entity_id").alias("s1_id")), ["place"], stored)
    s23 = records.load_split(spark, str(root), "train")[1]

    def read(name, header):
        rows, right = outputs.read_lists(spark, f"{tmp_path}/{name}", header)
        return evaluate.numbered(rows, ["place"], stored), right

    (m, good), (c, also) = read("m.joined", outputs.MATCHED), read("c.joined", outputs.CANDIDATES)
    got = evaluate.verify(expected, s23, m, c, good and also)
    assert got == {"rows": 60, "nonempty_rows": sum(bool(x) for _, x in truth), "matched_ids": len(pairs), "candidate_ids": len(pairs)}
    assert not read("m.joined", outputs.CANDIDATES)[1]
    for spoilt in (m.where("n <> 7"), m.withColumn("ids", F.concat_ws(",", "ids", F.lit("S2-no"))), m.withColumn("s1_id", F.when(F.col("n") == 3, "S1-x").otherwise(F.col("s1_id")))):
        with pytest.raises(ValueError, match="break rules"):
            evaluate.verify(expected, s23, spoilt, c)
    with pytest.raises(ValueError, match="header"):
        evaluate.verify(expected, s23, m, c, False)


def test_files_and_packages(spark, tmp_path):
    outputs.write_report(spark, f"{tmp_path}/report.json", {"cv": 0.5, "test": {"rows": 12345}})
    report = json.loads((tmp_path / "report.json").read_text())
    assert report == {"cv": 0.5, "test": {"rows": 12345}}
    assert outputs.summary(report, "Run 1") == "Run 1\n=====\ncv: 0.5\ntest:\n  rows: 12,345\n"
    want = hashlib.sha256((tmp_path / "report.json").read_bytes()).hexdigest()
    assert [tuple(r) for r in outputs.sha256_files(spark, f"{tmp_path}/report.json").collect()] == [("report.json", (tmp_path / "report.json").stat().st_size, want)]
    outputs.package(str(tmp_path), ["report.json"], f"{tmp_path}/out.zip", {"report.json": want})
    both = [outputs.Bundle(f"{tmp_path}/out.zip"), outputs.Bundle(str(tmp_path))]
    assert all(b.sha256("report.json") == want and "report.json" in b.names() for b in both) and both[0].names() == ["report.json"]
    with pytest.raises(ValueError, match="missing"):
        outputs.package(str(tmp_path), ["none.tsv"], f"{tmp_path}/no.zip")
    with pytest.raises(ValueError, match="digest"):
        outputs.package(str(tmp_path), ["report.json"], f"{tmp_path}/no.zip", {"report.json": "0"})
    assert not (tmp_path / "no.zip").exists()
    tsv(tmp_path / "pairs.tsv", ("any", "names", "more"), [("S1-1", "S2-1", "x"), ("S1-2", "", "y")])
    assert sorted(tuple(r) for r in records.read_pair_tsv(spark, f"{tmp_path}/pairs.tsv").collect()) == [("S1-1", "S2-1"), ("S1-2", "")]
    pairs = spark.createDataFrame([("a", "b", "fr"), ("c", "d", "us")], f"{PAIR}, country_n string")
    outputs.write_pairs(pairs, f"{tmp_path}/spill")
    assert [tuple(r) for r in outputs.read_pairs(spark, f"{tmp_path}/spill", "us", ["s1_id"]).collect()] == [("c",)]


def test_folds_in_a_file(spark, tmp_path):
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "s1_id string")
    every = [f"S1-{i}" for i in range(200)]
    path = f"{tmp_path}/folds.csv"
    first = {r.s1_id: r.fold for r in sampling.kept_folds(spark, ids(every), path).collect()}
    assert sorted(first) == sorted(every) and set(Counter(first.values()).values()) == {40}
    again = {r.s1_id: r.fold for r in sampling.kept_folds(spark, ids(every[::7]), path).collect()}
    assert again == {x: first[x] for x in every[::7]}
    with pytest.raises(ValueError, match="1 entities"):
        sampling.kept_folds(spark, ids(["S1-3", "S1-zzz"]), path)


def test_mini_dataset(spark, split, tmp_path):
    root, s1, s2, s3, truth = split
    sampling.mini_dataset(spark, str(root), str(tmp_path), {"train": 15})
    read = lambda name: [x.split("\t") for x in lines(spark, tmp_path / f"train/{name}").splitlines()]
    got = {k: read(f"train_source{k}.tsv") for k in (1, 2, 3)}
    whole = {1: s1, 2: s2, 3: s3}
    for k, rows in got.items():
        order = [tuple(r) for r in whole[k] if list(r) in rows]
        assert tuple(rows[0]) == tuple(records.COLS) and [tuple(r) for r in rows[1:]] == order
    kept = {r[0] for r in got[1][1:]}
    assert len(kept) == 15 and len(got[2]) + len(got[3]) - 2 == 60
    own = {x for i, ids in truth if i in kept for x in ids.split(",") if x}
    assert own <= {r[0] for k in (2, 3) for r in got[k]} and {r[0] for r in read("train_ground_truth.tsv")[1:]} == kept


def test_accents_of_all_characters(spark):
    """Every assigned character of the first three planes, decomposed, marks dropped."""
    chars = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Cc") and not (0x4E00 <= c < 0x9FA0 or 0x20000 <= c < 0x2F800 or 0xAC80 <= c < 0xD780)]
    parts = ["x".join(chars[k : k + 400]) for k in range(0, len(chars), 400)]
    plain = lambda s: "".join(ch for x in s for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch))
    got = [r[0] for r in spark.createDataFrame([(p,) for p in parts], "x string").select(text.strip_accents(F.col("x"))).collect()]
    assert got == [plain(p) for p in parts]


def test_partial_ratio_by_all_windows():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(0, 14))) for _ in range(2))
        x, y = sorted((a, b), key=len)
        windows = [y[max(0, i) : i + len(x)] for i in range(1 - len(x), len(y))] if x else []
        want = max((sim.ratio(x, w) for w in windows), default=100.0 if not y else 0.0)
        assert abs(sim.partial(a, b) - want) < 1e-9, (a, b)


def test_scorers_of_repeated_pairs(spark):
    rows = [("ab", "b"), ("ab", "b"), (None, ""), ("ab", "ba"), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    got = [r[0] for r in df.select(sim.scorer("ratio")(F.col("a"), F.col("b"))).collect()]
    assert [round(x, 6) for x in got] == [round(sim.ratio(a or "", b or ""), 6) for a, b in rows]


def norm_frame(spark, rows):
    """(entity_id, country, name, address) normalised."""
    return text.normalised(spark.createDataFrame([(i, n, a, c) for i, c, n, a in rows], "entity_id string, business_name string, business_address string, country string"))


@pytest.fixture(scope="module")
def norm(spark):
    rng = random.Random(8)
    w = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(90):
        base = rng.sample(w, rng.randrange(1, 9))
        if i % 3 and rows:
            base = (rows[-1][2] + " " + rows[-1][3]).split()
            base[rng.randrange(len(base))] = rng.choice(w)
        rows.append((f"S{i % 3 + 1}-{i}", rng.choice(["US", "Fr."]) if i % 3 == 0 else rows[-1][1], " ".join(base[:3]), " ".join(base[3:]) + (f" {10000 + i // 3}" if i % 2 else "")))
    rows += [("S1-900", "xx", "lone w1", "w2"), ("S1-901", "US", "", ""), ("S2-902", "US", "", "")]
    return stored(norm_frame(spark, rows))


def test_similar_pairs_by_all_pairs(norm):
    rows = [(r.entity_id, r.country_n, set((r.name_n + " " + r.addr_n).split())) for r in norm.collect()]
    for share in (0.5, 0.7):
        want = {(a, b) for a, c, x in rows for b, d, y in rows if a[1] == "1" and b[1] != "1" and c == d and x and y and len(x & y) >= share * len(x | y) - 1e-12}
        assert {(r.s1_id, r.cand_id) for r in blocking.similar_pairs(norm, share).collect()} == want and want


def test_generate_by_plain_blocks(norm):
    keys = [(r.entity_id, r.country_n, r.scheme, r.key) for r in blocking.with_fallback(blocking.blocking_keys(norm)).collect()]
    post = {v: {} for v in vectors.VIEWS}
    for v in vectors.VIEWS:
        for r in vectors.postings(norm, v).collect():
            post[v].setdefault(r.entity_id, {})[r.term] = r.w
    dot = lambda v, a, b: round(sum(w * post[v].get(b, {}).get(t, 0.0) for t, w in post[v].get(a, {}).items()), 6)
    blocks = {}
    for e, c, s, k in keys:
        blocks.setdefault((c, s, k), ([], []))[e[1] != "1"].append(e)
    found, k, cap = set(), (2, 1, 1), 3
    for a_side, b_side in blocks.values():
        if len(b_side) > 9:
            continue
        for a in a_side:
            for n, v in zip(k, vectors.VIEWS, strict=True):
                best = sorted(((-dot(v, a, b), b) for b in b_side if dot(v, a, b) > 0))
                found |= {(a, b) for _, b in best[:n]}
    want = set()
    for a in {x for x, _ in found}:
        own = sorted((-(dot("cos_full", a, b) + dot("cos_addr", a, b)), b) for x, b in found if x == a)
        want |= {(a, b) for _, b in own[:cap]}
    got = blocking.generate(norm, stored, k, 9, cap)
    assert {(r.s1_id, r.cand_id) for r in got.collect()} == want and len(want) > 30
    assert any(a == "S1-900" for a, _ in want)  # its country has no records
    assert blocking.generate(norm.limit(0), stored).count() == 0


def test_small_vocabulary_is_not_pruned(norm):
    """Under 200 records, no term can be in a share of 0.01 and in two of them: all terms stay."""
    terms = vectors.terms(norm, "cos_addr").select("entity_id", "term").distinct().count()
    assert vectors.postings(norm, "cos_addr").count() == terms > 0


def test_all_features(spark, norm):
    cos = blocking.generate(norm, stored).join(norm.select(F.col("entity_id").alias("s1_id"), "country_n"), "s1_id")
    rows = features.all_features(cos, norm)
    assert rows.columns[-28:] == features.FEATURES and rows.count() == cos.count() == rows.na.drop().count()
    with pytest.raises(Exception, match="no record of a pair"):
        features.looked_up(spark.createDataFrame([("S1-0", "S2-none")], PAIR), norm, ["name_n"]).collect()
    one = features.looked_up(cos.select("s1_id", "cand_id"), norm, ["name_n"])
    assert one.columns == ["s1_id", "cand_id", "name_n_a", "name_n_b"] and one.count() == cos.count()


def scored(spark, rows):
    return spark.createDataFrame(rows, f"{PAIR}, p double")


def test_expected_f05_by_hand(spark):
    keep = lambda rows, floor=0.0: sorted((r.s1_id, r.cand_id) for r in decide.expected_f05(scored(spark, rows), floor).collect())
    a, b = [("A", "x", 0.9), ("A", "y", 0.8), ("A", "z", 0.1)], [("B", "u", 0.05), ("B", "v", 0.02)]
    assert keep(a + b) == [("A", "x"), ("A", "y")] and keep([("C", "x", 1.0), ("C", "y", 0.01)]) == [("C", "x")]
    assert len(keep([("D", str(i), 0.5) for i in range(5)])) == 5 and keep(a, 0.95) == []
    empty = spark.createDataFrame([], f"{PAIR}, p double")
    rules = (decide.expected_f05, lambda x: decide.relative(x, 0.5, 0.5), lambda x: decide.adaptive(x, 0.5, 0.1), lambda x: decide.threshold(x, 0.5, True), lambda x: decide.top1(x, 0.5, 0.2, stored))
    assert [f(empty).count() for f in rules] == [0] * 5


def test_adaptive_counts_before_the_filter(spark):
    rows = [("A", "a", 0.9), ("A", "b", 0.85)] + [("A", f"c{i}", 0.01) for i in range(8)]
    assert decide.adaptive(scored(spark, rows), 0.88, 0.5).count() == 0 and decide.adaptive(scored(spark, rows), 0.128, 0.0).count() == 2


@pytest.fixture(scope="module")
def world(spark):
    """(ids, pairs, truth, folds) and the same as Python."""
    rng = random.Random(31)
    ids = [f"S1-{i}" for i in range(40)]
    pairs = {(rng.choice(ids), f"S2-{rng.randrange(60)}"): rng.randrange(1, 20) / 20 for _ in range(260)}
    truth = {k for k, p in pairs.items() if rng.random() < p**2} | {(i, "S2-none") for i in ids[:3]}
    idf, tf = spark.createDataFrame([(i,) for i in ids], "s1_id string"), spark.createDataFrame(sorted(truth), PAIR)
    fold = {r.s1_id: r.fold for r in evaluate.folds(idf).collect()}
    return ids, pairs, truth, fold, idf, scored(spark, [(a, b, p) for (a, b), p in pairs.items()]), tf


def plain_f05(pred, truth, ids):
    total = 0.0
    for i in ids:
        p, t = {b for a, b in pred if a == i}, {b for a, b in truth if a == i}
        hit = len(p & t)
        total += (not p) if not t else (1.25 * hit / (0.25 * len(t) + len(p)) if hit else 0.0)
    return round(total / len(ids), 6)


def plain_relative(pairs, g):
    best = {}
    for (a, b), p in pairs.items():
        if p >= g[0] and (b not in best or (-p, a) < best[b]):
            best[b] = (-p, a)
    own = {(a, b): -p for b, (p, a) in best.items()}
    top = {a: max(p for (x, _), p in own.items() if x == a) for a, _ in own}
    return {k for k, p in own.items() if p >= g[1] * top[k[0]]}


def test_cross_fitted_rule_by_loops(world):
    ids, pairs, truth, fold, idf, df, tf = world
    grid = [(0.2, 0.5), (0.5, 0.5), (0.5, 0.9), (0.8, 0.1)]
    folds = evaluate.folds(idf)
    got = {r.fold: (r.choice, r.macro_f05) for r in evaluate.cross_fitted_rule(df, tf, folds, lambda p, g: decide.relative(p, *g), grid).collect()}
    for f in range(5):
        train, own = [i for i in ids if fold[i] != f], [i for i in ids if fold[i] == f]
        score = [plain_f05(plain_relative({k: p for k, p in pairs.items() if k[0] in train}, g), truth, train) for g in grid]
        best = score.index(max(score))
        assert got[f] == (best, plain_f05(plain_relative({k: p for k, p in pairs.items() if k[0] in own}, grid[best]), truth, own))


def test_cv_report(world):
    ids, pairs, truth, fold, idf, df, tf = world
    country = idf.withColumn("country_n", F.when(F.pmod(F.hash("s1_id"), F.lit(2)) == 0, "fr").otherwise("us"))
    r = evaluate.cv_report(idf, df, tf, evaluate.folds(idf), True, country)
    rule = lambda t: plain_relative(pairs, (t, 0.0))
    curve = [[t, plain_f05(rule(t), truth, ids)] for t in evaluate.GRID]
    assert r["threshold_curve"] == curve and r["oof_macro_f05_at_best_t"] == max(s for _, s in curve)
    assert r["oof_best_t"] == next(t for t, s in curve if s == max(x for _, x in curve))
    kept = rule(r["oof_best_t"])
    assert r["oof_pair_precision"] == round(len(kept & truth) / len(kept), 6) and r["oof_pair_recall"] == round(len(kept & truth) / len(truth), 6)
    assert r["empty_baseline_macro_f05"] == plain_f05(set(), truth, ids) and len(r["fold_scores"]) == 5 and sorted(r["without_country"]) == ["fr", "us"]
    assert abs(sum(r["fold_scores"]) / 5 - r["cv_macro_f05_cross_fitted"]) < 1e-6


def test_verdicts(spark):
    base = [0.5, 0.5, 0.5, 0.5, 0.5]
    assert evaluate.verdict(base, [0.6, 0.6, 0.6, 0.6, 0.4])["decision"] == "accept"
    assert evaluate.verdict(base, [0.9, 0.9, 0.9, 0.4, 0.4])["decision"] == "inconclusive"
    assert evaluate.verdict(base, [0.51] * 5, noise=0.01)["decision"] == "inconclusive" and evaluate.verdict(base, [0.53] * 5, noise=0.01)["decision"] == "accept"
    assert evaluate.verdict(base, [0.9] * 5, noise=float("nan"))["decision"] == "inconclusive"
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "c")], "fold int, t string")
    assert tuple(evaluate.most_common(df, "t", "fold").first()) == ("b", 2)


def test_cap_sweep(world):
    ids, pairs, truth, _, idf, df, tf = world
    got = {r.cap: r for r in evaluate.cap_sweep(idf, df, tf, {"p": F.col("p")}, [1, 3, 0]).collect()}
    for cap in (1, 3, 0):
        kept = set()
        for i in ids:
            own = sorted((-p, b) for (a, b), p in pairs.items() if a == i)
            kept |= {(i, b) for _, b in own[: cap or None]}
        hits = kept & truth
        n = Counter(a for a, _ in truth)
        h = Counter(a for a, _ in hits)
        oracle = sum(1.0 if not n[i] else 1.25 * (h[i] / n[i]) / (0.25 + h[i] / n[i]) if h[i] else 0.0 for i in ids) / len(ids)
        assert got[cap].hits == len(hits) and got[cap].recall == round(len(hits) / len(truth), 6) and abs(got[cap].oracle_f05 - oracle) < 1e-6
        assert got[cap].cover == round(sum(h[i] == n[i] for i in ids) / len(ids), 6)


@pytest.fixture(scope="module")
def separable(spark):
    """Pairs that two features tell apart, but for some noise."""
    rng = random.Random(2)
    rows = []
    for i in range(600):
        y = float(rng.random() < 0.4)
        rows.append((f"S1-{i // 4}", f"S2-{i}", y * 0.6 + rng.random() * 0.5, rng.random(), "fr" if i % 3 else "us", y if rng.random() > 0.03 else 1 - y, (i // 4) % 5))
    return stored(spark.createDataFrame(rows, f"{PAIR}, a double, b double, country_n string, y double, fold int"))


def test_models(spark, separable, tmp_path):
    names, few = ["a", "b"], {"trees": 4, "depth": 3, "leaf": 5}
    models = model.fold_models(separable, names, **few)
    oof = sorted(tuple(r) for r in model.out_of_fold(separable, models, names).collect())
    assert len(oof) == 600 and sorted(tuple(r) for r in model.out_of_fold(separable, model.fold_models(separable, names, **few), names).collect()) == oof
    assert sum((p >= 0.5) == y for _, _, p, y, _ in oof) > 540
    model.save(models[0], f"{tmp_path}/m")
    again = model.load(f"{tmp_path}/m")
    own = lambda ms: {(r.s1_id, r.cand_id): r.p for r in model.scored(ms, separable, names).collect()}
    one, two = own([models[0]]), own([models[1]])
    assert own([again]) == one
    assert all(abs(p - (one[k] + two[k]) / 2) < 2e-6 for k, p in own(models[:2]).items())
    pairs = spark.createDataFrame(oof, f"{PAIR}, p double, y int, fold int")
    assert model.early_drop(pairs).count() == sum(p >= 0.15 for _, _, p, _, _ in oof)
    fixed = {(r.s1_id, r.cand_id): (r.p, r.fold) for r in model.calibrated(pairs).collect()}
    for f in range(5):  # order is kept within a fold
        order = sorted((p, fixed[a, b][0]) for a, b, p, _, k in oof if k == f)
        assert all(x[1] <= y[1] + 1e-9 for x, y in zip(order, order[1:], strict=False))
    assert model.fold_models(separable.where("y = 1"), names, **few) == [None] * 5
    loco = model.without_each_country(separable, names, **few)
    assert loco.count() == 600 and loco.select("country_n").distinct().count() == 2


def test_pair_sample(spark):
    pairs = spark.range(4000).selectExpr("concat('S1-', id % 50) AS s1_id", "concat('S2-', id) AS cand_id")
    some = model.pair_sample(pairs, 4000, 1000)
    want = {(f"S1-{i % 50}", f"S2-{i}") for i in range(4000) if int(hashlib.md5(f"42|S1-{i % 50}|S2-{i}".encode()).hexdigest()[:8], 16) % 1_000_000 < 250_000}
    assert {tuple(r) for r in some.collect()} == want and 850 < len(want) < 1150
    assert model.pair_sample(pairs, 4000, 5000).count() == 4000


def test_learned_k(world):
    ids, pairs, _, _, idf, df, tf = world
    got = model.learned_k(df, tf, evaluate.folds(idf), stored, trees=3, depth=3, leaf=2)
    kept = {(r.s1_id, r.cand_id): r.p for r in got.collect()}
    assert kept and all(pairs[k] == p for k, p in kept.items()) and len({b for _, b in kept}) <= len(kept)
    rows = decide.learn_k_rows(df, tf)
    best = decide.best_k(rows.withColumn("predicted", F.col("target")), df)  # the true target picks the best prefix
    by = {}
    for r in rows.collect():
        by.setdefault(r.s1_id, []).append((-r.target, r.k))
    take = Counter(r.s1_id for r in best.collect())
    assert {i: take[i] for i in by} == {i: min(x)[1] for i, x in by.items()}
    assert set(decide.K_FEATURES) == set(decide.learn_k_rows(df, None).columns) - {"s1_id"}


def test_subsample_without_truth(spark):
    s1, s23 = (spark.range(n).selectExpr(f"concat('{k}-', id) AS entity_id") for k, n in (("S1", 50), ("S2", 200)))
    a, b = sampling.subsample(s1, s23, 10)
    assert (a.count(), b.count()) == (10, 40)
    assert [x.count() for x in sampling.subsample(s1, s23, 50)] == [50, 200]


def test_stages_and_tables(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(7)

    for _ in range(2):
        assert stages.stage(spark, "t", ["x", str(tmp_path)], make).count() == 7
    assert len(made) == 1
    mark = stages.written()
    path = stored(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert Path(path).exists()
    stages.drop_since(spark, mark)
    assert not Path(path).exists() and stages.written() == mark


def test_records_without_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b c d e f g h", "fr"), (-1, None, "us"), (4, "", None), (4, "x", "us")], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.entity_id, r.src, r.business_name, r.business_address) for r in records.from_documents(spark, str(tmp_path)).collect())
    assert [(x[1], x[2], x[3]) for x in got] == [("S2", "", ""), ("S2", "x", ""), ("S3", "", ""), ("S3", "a b c d e f", "g h")]
    assert [x[0] for x in got[:3]] == ["S2-4", "S2-4", "S3--1"] and got[3][0].startswith("S3-none-")


def test_stream(spark, tmp_path):
    """A stream of records gets the columns that a batch gets."""
    from recordloom.streaming import normalise_stream

    tsv(tmp_path / "in/a.tsv", records.COLS, [("S1-1", "ABC Pvt. Ltd.", "10 St Martin Rd 75001", "Fr.")])
    schema = ", ".join(f"{c} string" for c in records.COLS)
    stream = spark.readStream.schema(schema).option("sep", "\t").option("header", True).csv(f"{tmp_path}/in")
    q = normalise_stream(stream).writeStream.format("memory").queryName("norm_out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("norm_out").first()
    assert (got.name_core, got.addr_n, got.postal1, got.country_n) == ("abc", "10 street martin road 75001", 75001, "fr") and math.isclose(1, 1)


def test_written_records_hold_no_text_twice(spark):
    from recordloom.plans import catalogue

    norm = catalogue._norm(spark, "/root/testdata/sf0.001")
    kept = set(spark.read.parquet(*norm.inputFiles()).columns)
    assert not kept & {"business_name", "business_address", "full_n"} and "full_n" in norm.columns


def test_similar_pairs_of_copies(spark):
    """Copies are one set until the end: all their pairs are there, and none across countries."""
    from recordloom.operators import blocking

    rows = [(f"S{k % 3 + 1}-{k}", "fr" if k % 7 == 0 else "en", "a b c" if k % 2 else "c b a", "d e f g" if k % 5 else "d e f x y") for k in range(60)] + [("S1-none", "en", "", "")]
    norm = spark.createDataFrame(rows, "entity_id string, country_n string, name_n string, addr_n string")
    words = {r[0]: (r[1], set(f"{r[2]} {r[3]}".split())) for r in rows}
    want = {(a, b) for a, (c, x) in words.items() for b, (d, y) in words.items() if a[:2] == "S1" and b[:2] != "S1" and c == d and x and y and len(x & y) >= 0.7 * len(x | y)}
    got = [tuple(r) for r in blocking.similar_pairs(norm).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_parity_pairs_in_blocks_and_of_all_sizes(spark):
    """Sets of 1 to 3,000 words at and about 0.7, in blocks of 5: all pairs, also those of an id with two texts."""
    rng, rows = random.Random(12), [("S1-1", "fr", "alpha beta gamma", ""), ("S1-1", "fr", "delta epsilon zeta", ""), ("S2-9", "fr", "gamma beta alpha", ""), ("S3-9", "fr", "zeta delta epsilon", "")]
    for k, n in enumerate([1, 2, 3, 10, 17, 40, 500, 511, 513, 700, 1000, 3000] * 3):
        base = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        for j, share in enumerate((1.0, 0.9, 0.7, 0.69)):
            rows.append((f"S{rng.choice([1, 1, 2, 3])}-{10 + 4 * k + j}", rng.choice(["fr", "fr", "de"]), " ".join(base[: max(1, round(n * share))]), "x" if j else ""))
    norm = spark.createDataFrame(rows, "entity_id string, country_n string, name_n string, addr_n string")
    sets = [(i, c, set(f"{a} {b}".split())) for i, c, a, b in rows]
    want = {(i, k) for i, c, x in sets for k, d, y in sets if i < "S2" <= k and c == d and len(x & y) >= 0.7 * len(x | y)}
    got = [tuple(r) for r in blocking.similar_pairs(norm, block=5).collect()]
    assert len(got) == len(set(got)) > 20 and set(got) == want


@pytest.mark.parametrize("sides", [(1 << 14, 1 << 17), (23, 31)])
def test_crowds_of_candidates_are_counted_and_not_written(spark, tmp_path, sides):
    """Counts and contested records by plain candidates, while no table that is written has a row for each candidate."""
    from recordloom.plans import catalogue

    rng = random.Random(8)
    vocab = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(400)]
    names = ["same name of many a record"] * 150 + [" ".join(rng.choices(vocab, k=6)) for _ in range(60)]
    rows = [(i, f"{x} {' '.join(rng.choices(vocab, k=rng.choice([0, 3, 30])))}", rng.choice(["en", "en", "fr"])) for i, x in enumerate(names)]
    rows += [(i + 300, t + " more", c) for i, t, c in rows[::5]] + [(3, rows[4][1], "fr"), (3, rows[3][1], "en"), (None, rows[7][1], "en"), (7, rows[8][1], "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    norm, written = catalogue._norm(spark, str(tmp_path)), []

    def store(df):
        out = stages.stored(df)
        written.append(out.count())
        return out

    keys, scored = stages.stored(blocking.blocking_keys(norm)), [tuple(r) for r in catalogue._scored(norm).collect()]
    counts, kids = blocking.candidate_counts(keys, norm, store, sides=sides)
    pairs = {(a, b) for a, b, _ in scored}
    want = {a: (sum(x == a for x, _ in pairs), sum(x == a for x, _, _ in scored)) for a, _ in pairs}
    assert {r.s1_id: (r.n, r.n_rows) for r in counts.collect()} == want
    own = {r.entity_id: set(r.kids) for r in kids.collect()}
    assert {(a, b) for a in own for b in own if a[:2] == "S1" != b[:2] and own[a] & own[b]} == pairs
    got = [tuple(r) for r in blocking.owners_from(keys, norm, 0.3, catalogue._with_p, store, sides=sides).collect()]
    owners = lambda x: {b: min(2, len({a for a, c, p in x if c == b and p >= 0.3})) for _, b, p in x if p >= 0.3}
    assert owners(got) == owners(scored) and {(a, b) for a, b, _ in got} <= pairs
    assert max(written) < len(pairs) / 2


@pytest.mark.parametrize("sides", [(1 << 16, 1 << 15), (20, 30)])
@pytest.mark.parametrize(("floor", "most", "by"), [(0.0, 7, "s1_id"), (0.5, 7, "s1_id"), (0.5, 1, "cand_id")])
def test_best_of_candidates_scored_in_blocks(spark, tmp_path, sides, floor, most, by):
    """The best pairs by windows over all scored candidates, while no table that is written has a row for each candidate."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from recordloom.plans import catalogue

    rng = random.Random(9)
    vocab = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(400)]
    names = ["same name of many a record"] * 150 + [" ".join(rng.choices(vocab, k=6)) for _ in range(60)]
    rows = [(i, f"{x} {' '.join(rng.choices(vocab, k=rng.choice([0, 3, 30])))}", rng.choice(["en", "en", "fr"])) for i, x in enumerate(names)]
    rows += [(i + 300, t + " more", c) for i, t, c in rows[::5]] + [(3, rows[4][1], "fr"), (3, rows[3][1], "en"), (None, rows[7][1], "en"), (7, rows[8][1], "fr"), (900, rows[9][1], "xx")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    norm, written = catalogue._norm(spark, str(tmp_path)), []

    def store(df):
        out = stages.stored(df)
        written.append(out.count())
        return out

    scored = catalogue._scored(norm).where(F.col("p") >= floor)
    w = Window.partitionBy(by).orderBy(F.col("p").desc(), "cand_id" if by == "s1_id" else "s1_id")
    want = scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)
    got = blocking.best_from(stages.stored(blocking.blocking_keys(norm)), norm, floor, most, by, store, sides=sides)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    if sides[0] > len(rows):
        assert max(written) < scored.count() / 2
