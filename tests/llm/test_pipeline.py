"""Each stage of the corpus pipeline, and all of it, against plain Python on a small table."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as c
from recordloom.llm import quality, toxicity, words

from test_operators import edited, jaccard_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, component_id string, score string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """500 documents: clean, toxic, poor, copies, near copies; null ids and texts, an id with two texts; columns that clash."""
    rng = random.Random(40)
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    texts, labels = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(rng.randrange(30, 90))]
        kind = i % 8
        if kind == 1:
            w[5] = w[20] = "blockhead" if i % 3 else "bl0ckh3ad"
        t = " ".join(x + "%%$$" for x in w) if kind == 2 else " ".join(w) + "."
        texts.append((i, t))
        labels.append((i, int(kind != 2), int(kind == 1)))
    for _ in range(60):
        i, t = rng.choice(texts[:400:8])
        w = t.split()
        texts.append((len(texts), " ".join(edited(rng, w, rng.choice([0, 0, 1, 2])))))
    texts += [(None, None), (None, texts[0][1]), (7, "another text of the id " + " ".join(vocab[:40])), (None, "lone text without an id " + " ".join(vocab[40:90])), (900, ""), (901, " \n")]
    rows = [(i, t, "en", "s", len(t or ""), "z", "z", "z") for i, t in texts]
    rng.shuffle(rows)
    sf = str(tmp_path_factory.mktemp("corpus"))
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf, spark.read.parquet(f"{sf}/documents.parquet"), [(r[0], r[1]) for r in rows], dict((i, (q, t)) for i, q, t in labels)


def held(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_toxic_documents_go(spark, corpus):
    sf, docs, rows, labels = corpus
    kept = c.drop_toxic(spark, docs, sf)
    assert kept.columns == c.COLUMNS
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    reader, want = toxicity.Reader(model["counts"], lambda f: f), Counter()
    for i, t in rows:  # one text at a time, every feature looked up
        z = model["prior"] + sum(model["lexicon"].get(f, 0.0) for f in reader.read([t or ""])[0])
        want[i, t] += 1 / (1 + math.exp(-z)) < 0.5
    assert held(kept) == +want
    left = {i for i, _ in held(kept)}
    assert not [i for i, (_, t) in labels.items() if t and i in left] and not [i for i, (q, t) in labels.items() if q and not t and i not in left]


def test_poor_documents_go(spark, corpus):
    sf, docs, rows, labels = corpus
    kept = c.drop_poor(spark, docs, sf)
    assert kept.columns == c.COLUMNS
    m = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = Counter()
    for i, t in rows:
        x = np.clip((quality.figures([t or ""])[0] - m["mean"]) / m["dev"], -6, 6)
        z = sum(a * b for a, b in zip(np.tanh(x @ m["w"][0] + m["w"][1]), m["w"][2], strict=True)) + m["w"][3][0]
        want[i, t] += 1 / (1 + math.exp(-z)) >= 0.3
    assert held(kept) == +want
    left = {i for i, _ in held(kept)}
    poor, good = ([i for i, (q, _) in labels.items() if q == k] for k in (0, 1))
    assert sum(i in left for i in poor) <= 0.1 * len(poor) and sum(i in left for i in good) >= 0.95 * len(good)


def test_one_of_each_group_stays(spark, corpus):
    """Exactly one row of each group by all pairs of texts, of the smallest id."""
    sf, docs, rows, _ = corpus
    kept = c.drop_near_duplicates(spark, docs, sf)
    assert kept.columns == c.COLUMNS
    group = jaccard_groups([t for _, t in rows])
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        key = (i is None, i or 0)
        least[g] = min(least.get(g, key), key)
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter(None if none else i for none, i in least.values())
    texts = {t for _, t in held(kept)}
    assert len(set(jaccard_groups([*texts]))) == len(texts)


def test_rows_without_an_id_and_ids_with_two_texts(spark):
    vocab = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    texts = [" ".join(random.Random(k).choices(vocab, k=50)) for k in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[3]), (None, texts[4]), (5, texts[4])]
    df = spark.createDataFrame([(i, t, "en", "s", len(t), "z", "z", "z") for i, t in rows], SCHEMA).repartition(3)
    assert held(c.drop_near_duplicates(spark, df, "")) == Counter([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (5, texts[4])])


def check_packed(out, rows):
    tok, want = words.tokenizer(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[i, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    seq = {}
    for r in out:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seq.values():
        ends = [0, *(o + n for o, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048
    # best fit, longest first, one piece at a time
    gaps = []
    for n in sorted((x[3] for x in want.elements()), reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps[gaps.index(min(fit))] -= n
        else:
            gaps.append(2048 - n)
    assert len(seq) <= len(gaps)


def test_packing(spark, corpus):
    sf, docs, rows, _ = corpus
    check_packed(c.pack(spark, docs, sf).collect(), rows)


def test_all_stages(spark, corpus):
    """run() gives what the plain stages give one after the other."""
    sf, docs, rows, _ = corpus
    for name, stage in c.STAGES[:-1]:
        docs = c.stored(stage(spark, docs, sf), name)
        assert docs.columns == c.COLUMNS
    out = c.run(spark, sf).collect()
    check_packed(out, [(r.doc_id, r.text) for r in docs.collect()])
    assert [n for n, _ in c.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]


def test_nothing(spark, corpus):
    sf, docs, _, _ = corpus
    none = docs.limit(0)
    assert [stage(spark, none, sf).count() for _, stage in c.STAGES] == [0] * 4
