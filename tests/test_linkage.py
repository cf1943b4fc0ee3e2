"""Normalisation, similarities, rules and the catalogue against plain Python or SQL."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from recordloom.functions import similarity as sim
from recordloom.functions import text
from recordloom.operators import blocking, decide, evaluate
from recordloom.plans.stages import stored
from recordloom.sources import records

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def one(spark, f, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_normalisation(spark):
    assert one(spark, text.basic_clean, "Société Générale", "A&B", "p.v.t.", "  ", None, "ﬁne ½") == ["societe generale", "a and b", "pvt", "", "", "fine 1 2"]
    core = lambda c: text.core_of(text.norm_name(c))
    assert one(spark, core, "ABC Pvt. Ltd.", "The Company Ltd", "St Martin SARL") == ["abc", "the company ltd", "saint martin"]
    assert one(spark, text.norm_addr, "10 St Martin Road", "Bat E, Apt 15") == ["10 street martin road", "bat e apartment 15"]
    assert one(spark, text.postal_codes, "Paris 75001", "1234", "1234567", "Mumbai 400001") == [["75001"], [], [], ["400001"]]
    assert [sorted(x) for x in one(spark, text.numbers, "12 Rue de Paris 75001", "")] == [["12", "75001"], []]


def test_similarity():
    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(0, 12))) for _ in range(2))
        assert sim.lcs(a, b) == lcs(a, b)
        assert abs(sim.jaro_winkler(a, b) - duckdb.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchall()[0][0]) < 1e-9 or not a or not b
    assert sim.ratio("", "") == 100 and sim.token_set("", "a") == 0 and sim.token_sort("b a", "a b") == 100
    assert sim.partial("abc", "xxabcxx") == 100 and sim.token_set("a b", "a b c") == 100


def test_tsv_round_trip(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"NA"\t\tUS\nS1-2\tNA\t a\\b\tFR\n')
    got = [tuple(r) for r in records.read_tsv(spark, str(p)).collect()]
    assert got == [("S1-1", '"NA"', "", "US"), ("S1-2", "NA", " a\\b", "FR")]
    t = tmp_path / "t.tsv"
    t.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2,S2-1\nS1-2\t\n")
    assert {r[0]: r[1] for r in records.load_truth(spark, str(t)).collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": []}


def pairs(spark, seed, n=120):
    rng = random.Random(seed)
    rows = {(f"S1-{rng.randrange(12)}", f"S2-{rng.randrange(30)}"): rng.randrange(1, 10) / 10 for _ in range(n)}
    return rows, spark.createDataFrame([(a, b, p) for (a, b), p in rows.items()], "s1_id string, cand_id string, p double")


@pytest.mark.parametrize("floor", [0.0, 0.3])
def test_expected_f05(spark, floor):
    rows, df = pairs(spark, 5)
    best = {}
    for (a, b), p in rows.items():
        if p >= floor and (b not in best or (-p, a) < best[b]):
            best[b] = (-p, a)
    want = set()
    for s in {a for a, _ in rows}:
        own = sorted((np_, b) for b, (np_, a) in best.items() if a == s)
        total = -sum(x for x, _ in own)
        f = [1.25 * -sum(x for x, _ in own[:k]) / (0.25 * total + k) for k in range(1, len(own) + 1)]
        if f and max(f) > math.prod(1 - min(-x, 1 - 1e-12) for x, _ in own):
            k = next(i for i, v in enumerate(f, 1) if v >= max(f) - 1e-12)
            want |= {(s, b) for _, b in own[:k]}
    assert {(r[0], r[1]) for r in decide.expected_f05(df, floor).select("s1_id", "cand_id").collect()} == want


def test_top1_equals_sequential_greedy(spark):
    rows, df = pairs(spark, 9)
    got = {(r[0], r[1]) for r in decide.top1(df, 0.85, 0.2, stored).select("s1_id", "cand_id").collect()}
    first = {(r[0], r[1]) for r in decide.threshold(df, 0.85, True).select("s1_id", "cand_id").collect()}
    s, c, want = {a for a, _ in first}, {b for _, b in first}, set(first)
    for (a, b), p in sorted(rows.items(), key=lambda x: (-x[1], x[0])):
        if p >= 0.2 and a not in s and b not in c:
            want.add((a, b)), s.add(a), c.add(b)
    assert got == want


def test_adaptive_without_slope_is_threshold(spark):
    _, df = pairs(spark, 11)
    key = lambda x: sorted((r[0], r[1]) for r in x.select("s1_id", "cand_id").collect())
    assert key(decide.adaptive(df, 0.5, 0.0)) == key(decide.threshold(df, 0.5, True))


def test_macro_f05(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "s1_id string")
    pred = spark.createDataFrame([("a", "S2-47"), ("a", "S2-193"), ("a", "S3-812"), ("c", "x")], "s1_id string, cand_id string")
    truth = spark.createDataFrame([("a", "S2-47"), ("a", "S3-812")], "s1_id string, cand_id string")
    assert evaluate.macro_f05(ids, pred, truth).first().macro_f05 == round((1.25 * 2 / (0.5 + 3) + 1) / 3, 6)


def test_oversized_keys_and_fallback(spark):
    keys = spark.createDataFrame([("S1-1", "fr", "p", "k"), ("S2-1", "us", "p", "k"), ("S2-2", "us", "p", "k"), ("S1-2", "us", "p", "k")], "entity_id string, country_n string, scheme string, key string")
    got = lambda m: sorted((r[0], r[1]) for r in blocking.candidates(keys, m).collect())
    assert got(2) == [("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S2-1"), ("S1-2", "S2-2")] and got(1) == []


@pytest.mark.parametrize("name", ["norm_names", "postal_numbers", "rare_tokens", "blocking_join", "true_pairs", "tfidf_name", "set_features", "linkage_macro_f05", "folds"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    a = entry.queries()[name](spark, SF)
    cols = sorted(a.columns)
    got = sorted(map(repr, (tuple(r) for r in a.select(*cols).collect())))
    want = sorted(map(repr, con.execute(f"select {', '.join(cols)} from ({entry.oracle_sql()[name]})").fetchall()))
    assert got == want
