"""Corpus operators against brute force, on small tables with nulls, ties, repeats, empty texts and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from recordloom.llm import bpe, licences, packing, quality, quality_rules, rans, simhash, token_counts, topk, toxicity, words

SCHEMA = "doc_id long, text string, score string, ids string, words string, fp string, n string, y string"
WORD, BYTE, PIECE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "gamma's", "é", "12", "x", "don't", "  ", "\n", "…", "漢字", "mit", "license", "🙂", "<|endoftext|>", "▁a", "İ"]
    texts = [None, "", " ", "\n\n", "one", "one two", "one two three", "a b c d e a b c d e f g h", "MIT License and the MIT-license; cc by", "long " * 3000]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += [texts[12], texts[12], texts[13] + " tail", "word " * 700 + "end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "\n\n")]
    return rows, spark.createDataFrame([(i, t, *["z"] * 6) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(path, text):
    tok = words.tokenizer(path)
    return tok.encode(text or "", add_special_tokens=False).ids


def test_op1(spark):
    rng = random.Random(2)
    vec = [(i, [rng.choice([-0.5, 0.25, 0.1, 0.9]) for _ in range(4)]) for i in range(160)]
    vec += [(200, None), (201, [0.1, None, 0.2, 0.3]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, [1.0] * 4), (204, [1.0, 2.0]), (7, [0.9] * 4), (8, [0.9] * 4)]
    df = spark.createDataFrame(vec, "vec_id long, embedding array<float>").repartition(4)
    got = sorted(tuple(r) for r in topk.search(df, df.vec_id % 50 == 0, 5, block=2).select("query_id", "rank", "vec_id", "score").collect())
    ok = [(i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(int)) for i, v in vec if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q, x in ok:
        if q % 50 == 0:
            s = sorted((-int(x @ y), i) for i, y in ok if i != q and len(x) == len(y))[:5]
            want += [(q, k, i, -t) for k, (t, i) in enumerate(s, 1)]
    assert got == sorted(want)
    assert topk.search(df.where("false"), df.vec_id % 50 == 0).count() == 0
    clash = df.selectExpr("*", "'z' AS query_id", "'z' AS score", "'z' AS v", "1 AS rank", "2 AS q", "3 AS bucket", "4 AS n")
    assert sorted(tuple(r) for r in topk.search(clash, clash.vec_id % 50 == 0, 5, block=2).select("query_id", "rank", "vec_id", "score").collect()) == got


@pytest.mark.parametrize("head", [0, 20, 200_000])
def test_op2(table, nothing, head):
    rows, df = table
    tok = words.tokenizer(BYTE)
    got = Counter(tuple(r) for r in bpe.digests(df, BYTE, head).collect())
    want = Counter()
    for i, t in rows:
        ids = ids_of(BYTE, t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want
    assert bpe.digests(nothing, BYTE).count() == 0


def test_op2_words_are_encoded_once(table, monkeypatch):
    """In the last pass no word is left to encode: the head table and the files have them all."""
    rows, df = table
    encode, own = bpe._encode(df, BYTE, "byte", 10)

    def left(batches):
        import pyarrow as pa

        bpe._ENCODER.clear()
        for _ in encode(batches):
            pass
        yield pa.record_batch([pa.array([e.encoded for e in bpe._ENCODER.values()], pa.int64())], names=["n"])

    assert sum(r.n for r in own.mapInArrow(left, "n long").collect()) == 0


def test_op2_special_strings_and_planes():
    tok = words.tokenizer(BYTE)
    enc = bpe.TextEncoder(BYTE, "byte")
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|endoftext", " <|endoftext|> ", "a", " b", "'s", "\n", chr(0x30001), chr(0x10FFFD), chr(0xE0101), "1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(400)]
    ids, off = enc.encode_texts(texts)
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("kind,path", [("byte", BYTE), ("word", WORD)])
def test_vectorised_encoder(kind, path):
    rng = random.Random(1)
    alpha = list("aabbcdestrvlm'''   \n\t1234.,!?-_%éß") + ["’", "　", "漢", "🙂", "İ", "Σ", "é", "<|endoftext|>", "½", "²", "'s", "'ll", "'re", "한", "\0"]
    texts = ["".join(rng.choice(alpha) for _ in range(rng.randrange(0, 30))) for _ in range(3000)] + ["", "'", "'s", "a'l"]
    enc = words.WordEncoder(path, kind)
    ids, off = enc.encode(texts)
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_op3(spark, nothing):
    rng = random.Random(6)
    clean = ["the", "river", "runs", "over", "stone", "and", "green", "field"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = [rng.choice(clean) for _ in range(30)]
        if toxic:
            w[7] = "blockhead" if i % 12 else "bl0ckh3ad"
        rows.append((i, " ".join(w), *["z"] * 6))
        labels.append((i, int(toxic), 1))
    rows += [(1000, "the river " + s, *["z"] * 6) for s in ("bl0ckhead", "b l o c k h e a d", "blockheeead", "bl.ock.head")] + [(2000, "", *["z"] * 6), (2001, None, *["z"] * 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    out = toxicity.score(df, toxicity.fit(df, lab)).select("doc_id", "score", "predicted", "ids").collect()
    truth = {i: t for i, t, _ in labels}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.ids == "z" for r in out)
    assert all(r.predicted == truth[r.doc_id] for r in out if r.doc_id in truth)
    assert all(r.predicted == 1 for r in out if r.doc_id == 1000) and all(r.predicted == 0 for r in out if r.doc_id >= 2000)
    assert toxicity.score(nothing, toxicity.fit(nothing, lab.where("false"))).count() == 0


def test_op3_shared_beginnings(spark):
    """A stem with changing endings marks a text that has it often in little room, not one that has it once or rarely."""
    rng = random.Random(9)
    end = lambda: "".join(rng.choice("aeioulnrst") for _ in range(4))
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        w = [rng.choice(["river", "runs", "over", "stone", "field"]) for _ in range(40)]
        for k in range(3 if toxic else i % 3 == 0):
            w[5 + 9 * k] = "grumpf" + end()
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(1000, "over stone grumpfabab runs grumpfotot field grumpfusus"), (1001, "grumpfabab " + "river " * 900 + "grumpfotot"), (1002, "grumpfabab runs grumpfabab over")]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(df, toxicity.fit(df, lab)).collect()}
    assert got == dict(labels) | {1000: 1, 1001: 0, 1002: 0}


@pytest.fixture(scope="module")
def channel():
    text = "you are an idiot and a moron said the man in an old house; scum of the river runs over a stone and an inn " * 50
    counts, c = np.zeros(1 << 18, np.int64), [toxicity.CODE.get(x, 0) for x in text]
    for a, b, d in zip(c, c[1:], c[2:], strict=False):
        counts[a << 12 | b << 6 | d] += 1
    return toxicity.Channel(counts)


def test_op3_spaced_runs_are_read_whole(channel):
    found = set()
    reader = toxicity.Reader(np.ones(1 << 18, np.int64), lambda f: found.add(f) or f)
    reader.channel = channel
    reader.read(["a " * 70 + "i d i o t", "w o r d", "y o u r e a n i d i o t"])
    assert "idiot" in found
    assert "idiot" in channel.spaced("anidiot") and "idiot" in channel.spaced("theriverrunsoverastoneandanoldhouse" * 3 + "idiot")


def test_op3_long_tokens_are_decoded(channel):
    assert "idiot" in channel.restore("id" + "i" * 60 + "ot") and {"idiot", "moron"} <= set(channel.restore("the-old-house-of-the-river-runs-over-1d10t.m0r0n"))
    assert "moron" in channel.restore("runs_over_1d10t_m0r0n") and "idiot" in channel.restore("idi" + "0" * 30_000 + "t")


def test_op3_decoder_against_all_paths(channel):
    """Viterbi decoding finds a path of the lattice with the best score of all."""
    import itertools

    def worth(letters, cost):
        a = b = 0
        s = -cost
        for c in letters:
            s += channel.log[a, b, toxicity.CODE[c]]
            a, b = b, toxicity.CODE[c]
        return s + channel.log[a, b, 0]

    rng = random.Random(17)
    for _ in range(150):
        token = "".join(rng.choice("idot013$@!*mnrscu--") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randrange(1, 7)))
        paths = [("".join(x for x, _ in p), sum(c for _, c in p)) for p in itertools.product(*channel.lattice(token))]
        best, got = max(worth(*p) for p in paths), channel.decode(token)
        assert any(letters == got and abs(worth(letters, cost) - best) < 1e-9 for letters, cost in paths), token


@pytest.mark.parametrize("size", [39, 41, 61, 5000])
def test_op3_any_length(channel, size):
    """Neither a token's nor a spaced run's length keeps a word from being read."""
    river = ("the-old-river-runs-over-a-stone-" * 200)[: size - 6].rstrip("-") + "-"
    assert "idiot" in channel.restore(river + "1d10t")
    assert "idiot" in channel.spaced("theriverrunsoverastoneandanoldhouse" * (size // 35 + 1) + "idiot")


def test_op3_score_by_hand(spark):
    """A score is the logistic of the prior and of what the distinct entries of the text add to it."""
    counts = np.ones(1 << 18, np.int64)
    model = {"counts": counts, "prior": -2.0, "lexicon": {"blockhead": 3.0, "^grum": 1.5, "2^grum": 0.25, "2~^grum": 0.125}}
    texts = {1: "a river", 2: "blockhead blockhead", 3: "grumpy river", 4: "grumpy grumble", 5: "grumpy grumble blockhead", 6: "grumpy " + "river " * 500 + "grumble", 7: None}
    add = {1: 0, 2: 3, 3: 1.5, 4: 1.875, 5: 4.875, 6: 1.75, 7: 0}
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    for i, x in add.items():
        want = 1 / (1 + np.exp(2.0 - x))
        assert abs(got[i].score - want) < 1e-9 and got[i].predicted == int(want >= 0.5)


def test_op3_doubled_letters(channel):
    for token, word in (("iiddiioott", "idiot"), ("mmoron", "moron"), ("scuum", "scum")):
        assert {token, word} <= set(channel.restore(token))


def test_op4(spark, nothing):
    rng = random.Random(8)
    w = ["the", "river", "runs", "over", "stone", "and", "green", "field", "quiet", "evening"]
    rows, labels = [], []
    for i in range(800):
        good = i % 5 != 0
        t = " ".join(rng.choice(w) for _ in range(40)) + "."
        rows.append((i, t if good else " ".join(x + rng.choice(["%%%", "$$$"]) for x in t.split()), *["z"] * 6))
        labels.append((i, int(good)))
    rows += [(2000, "", *["z"] * 6), (None, None, *["z"] * 6)]
    df, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.score(df, quality.fit(df, lab)).collect()
    truth = dict(labels)
    assert len(out) == len(rows) and np.mean([r.predicted == truth[r.doc_id] for r in out if r.doc_id in truth]) > 0.97
    assert quality.score(nothing, quality.fit(nothing, lab)).count() == 0


@pytest.mark.parametrize("risks,step", [(quality.logistic_risks, quality.logistic_step), (quality.bounded_risks, quality.bounded_step)])
def test_op4_gradients(risks, step):
    """The steps against differences of the risks, on both sides of 0."""
    rng, signs = np.random.default_rng(3), set()
    for prior in (0.3, 0.9):
        for shift in (-2.0, 0.0, 2.0):
            p, u = rng.normal(1, 1, 7), rng.normal(shift, 1, 9)
            below = risks(p, u, prior)[1] < 0
            signs.add(bool(below))
            goal = lambda z: -risks(z[:7], z[7:], prior)[1] if below else sum(risks(z[:7], z[7:], prior))  # noqa: B023, E731
            z = np.concatenate([p, u])
            want = [(goal(z + h) - goal(z - h)) / 2e-6 for h in np.eye(16) * 1e-6]
            assert np.allclose(step(p, u, prior), want, atol=1e-7)
    assert signs == {True, False}


def test_op4_scores_by_a_loop(table):
    """Scores of whole texts against figures and network one text at a time."""
    rows, df = table
    rng = np.random.default_rng(0)
    net = quality.Net(quality.FIGURES, 5, rng)
    model = {"mean": rng.normal(size=quality.FIGURES), "dev": np.full(quality.FIGURES, 2.0), "w": net.w, "prior": 0.5}
    got = Counter((r.doc_id, round(r.score, 9), r.predicted) for r in quality.score(df, model).collect())
    want = Counter()
    for i, t in rows:
        x = np.clip((quality.figures([t or ""])[0] - model["mean"]) / 2.0, -6, 6)
        h = [np.tanh(sum(x[a] * net.w[0][a, b] for a in range(len(x))) + net.w[1][b]) for b in range(5)]
        z = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(h, net.w[2], strict=True)) + net.w[3][0])))
        want[i, round(z, 9), int(z >= 0.3)] += 1
    assert got == want


def test_op4_figures():
    """Some figures by plain counting."""
    for t in ("", "one", "a b a b a", "Hello, World! ## 12\nHello, World!", "x " * 50, "é漢 🙂"):
        f, w = quality.figures([t, "other text"])[0], t.split()
        n = max(1, len(t))
        assert np.isclose(f[0], np.log1p(n)) and np.isclose(f[1], np.log1p(len(w)))
        assert np.isclose(f[2], max(1, sum(c.isalpha() for c in t)) / n) and np.isclose(f[6], sum(c in quality.SYMBOLS for c in t) / n)
        assert np.isclose(f[11], sum(map(len, w)) / max(1, len(w))) and np.isclose(f[13], len(set(w)) / max(1, len(w)))
        assert np.isclose(f[14], sum(a == b for a, b in zip(w, w[1:], strict=False)) / max(1, len(w)))
        assert np.isclose(f[15], len(set(zip(w, w[1:], strict=False))) / max(1, len(w) - 1))


def test_op4_model_does_not_depend_on_order(spark):
    """A labelled id with two texts, nulls and repeats among the labels: any order of the rows gives the same model."""
    rng = random.Random(12)
    rows = [(i % 150, " ".join(rng.choice(["the", "river", "runs", "%%", "stone."]) for _ in range(rng.randrange(3, 30)))) for i in range(300)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(150)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (5, None, None), (5, 1, 1)]
    weights = []
    for k in range(2):
        rng.shuffle(rows), rng.shuffle(labels)
        df, lab = spark.createDataFrame(rows, "doc_id long, text string").repartition(2 + k), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        m, t = quality.fit(df, lab), toxicity.fit(df, lab)
        weights.append([x.tolist() for x in m["w"]] + [t["lexicon"], t["prior"]])
    assert weights[0] == weights[1]


def test_op5(table, nothing, spark):
    rows, df = table
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(df, df.select("doc_id")).collect()}
    want = set()
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        g = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        c = Counter(g)
        cover = {k + j for k, x in enumerate(g) if c[x] > 1 for j in range(5)}
        want.add((i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    assert got == want
    assert quality_rules.judge(nothing, nothing.select("doc_id")).count() == 0


def test_op5_ratio_and_verdict(table, spark):
    """ratio and kept by loops over words, pairs and folds."""
    rows, df = table
    trusted = [i for i, _ in rows if i is not None and i % 3]
    h = lambda *xs: _spark_hash(*xs)
    B, folds = quality_rules.BUCKETS, quality_rules.FOLDS

    def grams(t):
        w = [h(x.encode()) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        return [x % B for x in w] + [h(a, b) % B for a, b in zip(w, w[1:], strict=False)]

    fold = lambda i: 0 if i is None else h(i, b"fold") % folds
    raw, good = [Counter() for _ in range(folds)], [Counter() for _ in range(folds)]
    for i, t in rows:
        for f in range(folds):
            if f != fold(i):
                raw[f].update(grams(t))
                if i in trusted:
                    good[f].update(grams(t))
    want = Counter()
    for i, t in rows:
        f, g = fold(i), grams(t)
        share = sum(good[f].values()) / max(1, sum(raw[f].values()))
        # an n-gram that no other document has is in no bucket
        seen = raw[0] | raw[1] if folds == 2 else None
        each = [round(float(np.log((good[f][x] + quality_rules.PSEUDO) / (raw[f][x] * share + quality_rules.PSEUDO))), 4) if x in seen else 0.0 for x in g]
        want[i, round(sum(each) / len(each), 6) if each else 0.0] += 1
    found = quality_rules.judge(df, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()
    assert Counter((r.doc_id, round(r.ratio, 6)) for r in found) == want
    assert all(r.kept == (not r.base_failed and r.ratio >= quality_rules.THRESHOLD) for r in found)


def _spark_hash(*values):
    """xxhash64 of columns: the hash of each seeds the next; longs as eight little-endian bytes."""
    seed = 42
    for v in values:
        data = v if isinstance(v, bytes) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def test_op5_good_text_outside_the_trusted(spark):
    """Of documents of one kind, mostly of words of their own, all are kept and not only the trusted ones."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    rows = [(i, " ".join(word() if k % 3 else "river" for k in range(80))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.kept for r in quality_rules.judge(df, df.where("doc_id % 2 = 0")).collect())


def test_op5_all_trusted_ids_count(spark):
    """Where every document is trusted, beyond 20,000 as well, trusted and raw text are the same."""
    df = spark.range(25_000).selectExpr("id AS doc_id", "concat('w', id % 7, ' w', id % 11, ' w', id % 13) AS text")
    assert quality_rules.judge(df, df.select("doc_id")).where("ratio <> 0").count() == 0


def plain_licences(text):
    """(base places, found templates with best share and start) by loops over all templates and windows."""
    w = licences.words_of(text or "")
    places = [(k, label) for p, label in licences.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    entry, found = licences.index(), {}
    for t, e in enumerate(entry["templates"]):
        posts = {}
        for word, own in entry["postings"].items():
            posts.setdefault(word, []).extend(p for k, p in own if k == t)
        for o in (0, 1):
            votes = Counter((i - p + 8 * o) // 16 for i, x in enumerate(w) for p in posts.get(x, []))
            for b, n in votes.items():
                if n >= e["need"]:
                    ok = [s for s in range(16 * b - 8 * o, 16 * b - 8 * o + 16) if s + e["at"] >= 0 and w[s + e["at"] : s + e["at"] + len(e["phrase"])] == e["phrase"]]
                    if ok:
                        found.setdefault(e["label"], []).append((-min(1.0, n / e["postings"]), ok[0]))
    return w, places, {k: min(v) for k, v in found.items()}


def check_licences(df, rows):
    got = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9), [(s.label, s.first_word) for s in r.spans]) for r in licences.scan(df).collect())
    want = []
    for i, t in rows:
        w, places, found = plain_licences(t)
        first, base = [k for k, _ in places], {x for _, x in places}
        score = 1.0 if places else max((-s for s, _ in found.values()), default=0.0)
        order = [e["label"] for e in licences.index()["templates"] if e["label"] in found]
        want.append((i is None, i, len(w), len(places), min(first, default=None), max(first, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(found))), round(score, 9), [(x, found[x][1]) for x in order]))
    assert got == sorted(want, key=lambda x: x[:2])
    return got


def test_op6(table, nothing):
    rows, df = table
    key = lambda rows: sorted(rows, key=lambda x: (x[0] is None, x[0] or 0))
    assert len({i for i, _ in rows}) < len(rows)
    once = key([r for r in rows if r[0] not in (3, None)])
    check_licences(df.where("doc_id IS NOT NULL AND doc_id <> 3"), once)
    assert licences.scan(df).count() == len(rows) and licences.scan(nothing).count() == 0


def test_op6_planted(spark):
    """Every wording, whole and damaged, alone and several, in the middle of other words, against loops."""
    rng = random.Random(14)
    filler = ["river", "software", "the", "notice", "copyright", "K", "İstanbul", "ſoft", "a", "license", "of", "permission"]
    texts = []
    for _ in range(250):
        out = []
        for _ in range(rng.randrange(3)):
            out += [rng.choice(filler) for _ in range(rng.randrange(40))]
            t = rng.choice(licences.TEMPLATES)[1].split()
            for _ in range(min(len(t) - 1, rng.choice([0, 0, 1, 3, 12]))):
                k = rng.randrange(len(t))
                t[k : k + 1] = rng.choice([[], ["holder"], [t[k], "holder"]])
            out += t
        texts.append(" ".join(out + [rng.choice(filler) for _ in range(rng.randrange(10))]))
    texts += [t for _, t, _ in licences.TEMPLATES] + [" ".join(t for _, t, _ in licences.TEMPLATES), "x " * 200_000 + licences.TEMPLATES[6][1]]
    rows = list(enumerate(texts))
    got = check_licences(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)
    by = {g[1]: g for g in got}
    for k, (label, _, _) in enumerate(licences.TEMPLATES):
        assert label in by[250 + k][7].split(","), label
    assert by[len(texts) - 1][9][0] == ("mit-grant", 200_000)


def test_op7(table, nothing):
    rows, df = table
    out = packing.pack_documents(df, WORD, capacity=64).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array([*ids_of(WORD, t), 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            piece = ids[at : at + 64]
            want[i, k, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    seq = {}
    for r in out:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seq.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 64
    assert packing.pack_documents(nothing, WORD).count() == 0


def test_op7_plan():
    rng = random.Random(5)
    for _ in range(200):
        cap = rng.choice([7, 20, 64])
        hist = {n: rng.randrange(0, 40) for n in range(1, cap + 1) if rng.random() < 0.6}
        used = Counter()
        for number, content in packing.plan(hist, cap):
            assert number > 0 and sum(n * k for n, k in content) <= cap and sum(k for n, k in content if 3 * n > cap) <= 2
            for n, k in content:
                used[n] += number * k
        assert used == Counter({n: c for n, c in hist.items() if c})


def test_op8(table, nothing, spark, tmp_path):
    rows, df = table
    out = rans.round_trip(df, WORD).orderBy("start").collect()
    want = {}
    for i, t in rows:
        ids = np.array([*ids_of(WORD, t), 1], "<u4")
        want.setdefault(i, Counter())[len(ids), zlib.crc32(ids.tobytes())] += 1
    got, at = {}, 0
    for r in out:
        assert r.start == at
        at += r.n_tokens
        got.setdefault(r.doc_id, Counter())[r.n_tokens, r.ids_crc32] += 1
    assert got == want
    order = [r.doc_id for r in out if r.doc_id is not None]
    assert order == sorted(order)
    assert rans.round_trip(nothing, WORD).count() == 0


def test_op8_format():
    rng = np.random.default_rng(1)
    for n in (1, 31, 1000, rans.BLOCK * 2 + 77):
        ids = np.minimum(rng.geometric(0.01, n), 49_000).astype(np.uint32)
        data = rans.shard_bytes([5, None], np.array([n - 1, 1]), ids)
        docs, blocks = rans.read_footer(data)
        assert docs == [(5, n - 1), (None, 1)] and (rans.read_blocks(data, blocks) == ids).all()
        assert (rans.read_blocks(data, blocks[-1:]) == ids[(len(blocks) - 1) * rans.BLOCK :]).all()
        bad = bytearray(data)
        bad[blocks[0][0] + 3] ^= 1
        with pytest.raises(ValueError):
            rans.read_blocks(bytes(bad), blocks)


def test_op9(table, nothing):
    import sentencepiece

    rows, df = table
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for head in (5, 1000):
        got = Counter(tuple(r) for r in token_counts.count_tokens(df, PIECE, head).collect())
        assert got == Counter((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in rows)
    assert token_counts.count_tokens(nothing, PIECE).count() == 0


def brute_fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op10(table, nothing):
    rows, df = table
    got = Counter(tuple(r) for r in simhash.near_duplicates(df).collect())
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (fps[a] ^ fps[b]).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    comp = {r: min((i for (i, _), x in zip(rows, root, strict=True) if x == r and i is not None), default=None) for r in root}
    assert got == Counter((i, int(np.uint64(f).view(np.int64)), comp[r]) for (i, _), f, r in zip(rows, fps, root, strict=True))
    assert simhash.near_duplicates(nothing).count() == 0


def test_op10_trie_join():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    near = np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False))) for b in np.repeat(base, 20)], np.uint64)
    a = np.unique(np.concatenate([base, near]))
    got = {(int(x), int(y)) for i, j in simhash.trie_join(a, None) for x, y in zip(i, j, strict=True)}
    assert got == {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 3}
    b = np.unique(near[::2] ^ np.uint64(1))
    got = {(int(x), int(y)) for i, j in simhash.trie_join(a, b) for x, y in zip(i, j, strict=True)}
    assert got == {(i, j) for i in range(len(a)) for j in range(len(b)) if int(a[i] ^ b[j]).bit_count() <= 3}


def test_op10_rotated_tries():
    """Pairs that agree in a block are found in the trie that starts with it; all blocks together find all pairs."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**32, 30).astype(np.uint64)
    near = np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(32, rng.integers(0, 6), replace=False))) for b in np.repeat(base, 20)], np.uint64)
    v, found = np.unique(np.concatenate([base, near])), set()
    for by in (0, 8, 16, 24):
        r = (v << np.uint64(by) | v >> np.uint64(32 - by)) << np.uint64(32)
        order = np.argsort(r)
        for i, j in simhash.trie_join(r[order], None, 0, 0, 3, 8, 32):
            found |= {(min(x, y), max(x, y)) for x, y in zip(order[i].tolist(), order[j].tolist(), strict=True)}
    assert found == {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= 3}


@pytest.mark.parametrize("group,crowd", [(1 << 13, 1 << 17), (8, 12)])
def test_op10_crowded_prefix(spark, group, crowd):
    """One crowded prefix, taken down level by level, gives the same components as all pairs."""
    rng = np.random.default_rng(7)
    base = np.concatenate([rng.integers(0, 2**40, 60), rng.integers(0, 2**62, 40)]).astype(np.uint64)  # 60 share their first 24 bits
    near = np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False))) for b in np.repeat(base, 4)], np.uint64)
    v = np.unique(np.concatenate([base, near]))
    reps = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long").repartition(4)
    root = list(range(len(v)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(v)):
        for j in range(i):
            if int(v[i] ^ v[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = {}
    for i, x in enumerate(v.view(np.int64).tolist()):
        want.setdefault(find(i), set()).add(x)
    got = {}
    for r in simhash.components(simhash.links(reps, 3, group, crowd)).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_crowd_of_near_copies_is_not_paired():
    """Thousands of copies of one text with one word replaced: far fewer pairs are looked at than there are."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 4, dtype=np.uint64)
    crowd = np.repeat(base[None], 6000, axis=0)
    for row in crowd:  # six of 256 bits each
        for k in rng.choice(256, 6, replace=False):
            row[k // 64] ^= np.uint64(1) << np.uint64(k % 64)
    other = rng.integers(0, 2**64, (3000, 4), dtype=np.uint64)
    sketch = np.concatenate([crowd, other])
    r = np.concatenate([sketch[:, 0] >> np.uint64(32) << np.uint64(32)])
    order = np.argsort(r)
    i, j = simhash._neighbours(r[order], len(r), 0)
    apart = np.bitwise_count(sketch[order][i] ^ sketch[order][j]).sum(axis=1)
    near = apart <= simhash.NEAR
    _, _, _, crowds = simhash._nearest_forest(len(r), i[near], j[near], apart[near])
    seen = sum(len(x) for x, _ in simhash.trie_join(r[order], None, 0, 0, 3, 8, 32, (crowds, crowds)))
    every = sum(len(x) for x, _ in simhash.trie_join(r[order], None, 0, 0, 3, 8, 32))
    assert every > 5_000_000 and seen < every / 10


def test_sketches_alike_in_a_whole_table(spark):
    """A crowd with one word of the sketch in common, cut into blocks: the same groups as by all pairs, every link a true one."""
    rng = np.random.default_rng(17)
    sketch = np.repeat(rng.integers(0, 1 << 63, (12, 4)).astype(np.uint64), 8, axis=0)
    for row in sketch:
        for bit in rng.integers(32, 256, rng.integers(0, 30)):
            row[bit // 64] ^= np.uint64(1) << np.uint64(63 - bit % 64)
    sketch[:, 0] = sketch[:, 0] & np.uint64((1 << 32) - 1) | np.uint64(0xABCD0123 << 32)
    rows = [(k, *x) for k, x in enumerate(sketch.view(np.int64).tolist())]
    reps = spark.createDataFrame(rows, "node long, w0 long, w1 long, w2 long, w3 long")
    got = {tuple(r) for r in simhash.candidate_links(reps, group=1, crowd=50).collect()}
    apart = np.bitwise_count(sketch[:, None] ^ sketch[None]).astype(int).sum(axis=2)  # all agree in the first table
    assert got and all(apart[u, v] <= simhash.FAR for u, v in got)

    def roots(pairs):
        up = list(range(len(rows)))
        for u, v in pairs:
            x, y = up[u], up[v]
            up = [min(x, y) if r in (x, y) else r for r in up]
        return up

    want = roots((u, v) for u in range(len(rows)) for v in range(u) if apart[u, v] <= simhash.FAR)
    assert roots(got) == want and 1 < len(set(want)) < len(rows)


def jaccard_groups(texts, size=5, share=0.8):
    """For each text the smallest place of its component, by all pairs."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a == sets[j] or 1000 * both >= 1000 * share * (len(a) + len(sets[j]) - both) and both:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(texts))]


def edited(rng, words, most):
    """A copy with up to ``most`` words replaced, dropped or added."""
    out = list(words)
    for _ in range(rng.randrange(most + 1)):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([["neu"], [], [out[k], "zwei"]])
    return out


def test_similar_groups(spark, nothing):
    """Groups by five words at 0.8 against all pairs: no group too large, and nearly all links found."""
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", "one", "One", "one two three", "one two three"]
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randrange(30, 300))]
        texts += [" ".join(base), *(" ".join(edited(rng, base, len(base) // 40 + 1)) for _ in range(rng.randrange(4)))]
    texts += [" ".join(vocab * 40), " ".join([*vocab * 40, "tail"])]  # 16,000 words
    want = jaccard_groups(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    assert sorted(got) == list(range(len(texts)))
    assert all(want[i] == want[r] for i, r in got.items())  # nothing unlike is joined
    linked = [i for i, r in enumerate(want) if i != r]
    assert len(linked) > 60 and sum(got[i] == want[i] for i in linked) >= 0.95 * len(linked)
    assert simhash.similar_groups(nothing).count() == 0


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_links_that_sketches_miss(spark):
    """Pairs of texts at just 0.8, in crowds of copies and alone: all are linked, whatever their sketches say."""
    rng, texts = random.Random(7), []
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    for _ in range(300):  # 36 of 45 shingles (44 words are 40) or 36 of 44 in common
        base = [word() for _ in range(44)]
        texts += [" ".join(base), " ".join(base[:40] + [word() for _ in range(4 + (len(texts) % 4) // 2)])]
    crowd = [word() for _ in range(400)]
    for k in range(40):  # alike to their neighbours only
        crowd = crowd[12:] + [word() for _ in range(12)]
        texts.append(" ".join(crowd))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()}
    want = {i: i // 2 * 2 if i < 600 else 600 for i in range(len(texts))}
    assert got == want


def test_parities_grow_with_the_set():
    """No more bits differ than members, at the length of the shorter; sets at 0.75 are told from those at 0.8 whatever their size."""
    rng = np.random.default_rng(5)
    for n in (3, 100, 257, 5_000, 40_000):
        h = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        for a, b in ((h[:n], h[n // 9 : n + n // 9]), (h[:n], h[n // 7 : n + n // 7]), (h[:n], h[n // 2 :]), (h[:n], h[: n + n // 5]), (h, h[:3])):
            got = simhash.parities_apart(simhash.parities(a), simhash.parities(b))
            assert got == simhash.parities_apart(simhash.parities(b), simhash.parities(a)) <= len(np.setxor1d(a, b))
        if n >= 257:
            assert simhash.parities_apart(simhash.parities(h[:n]), simhash.parities(h[n // 7 : n + n // 7])) * 1800 > 200 * 2 * n


def test_long_texts_with_a_common_passage_are_not_compared(spark, monkeypatch):
    """Texts of 1,500 words with 300 in common, and two alike: only these two come to the comparison of whole sets."""
    rng, seen, check = random.Random(8), [], simhash.verified
    words = lambda n: ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(n)]
    passage = words(300)
    texts = [" ".join(words(600) + passage + words(600)) for _ in range(12)]
    texts.append(" ".join(texts[0].split()[:1400]))

    def watched(near, *args):
        seen.extend((r.u, r.v) for r in near.collect())
        return check(near, *args)

    monkeypatch.setattr(simhash, "verified", watched)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()} == {i: i % 12 for i in range(13)}
    assert set(seen) == {(0, 12)}


@pytest.mark.parametrize("block", [1 << 13, 7])
def test_texts_that_share_a_passage_do_not_come_out_in_pairs(spark, block):
    """Of sets that share most of their prefixes, the similar pairs come out and few others, whatever the blocks."""
    rng = np.random.default_rng(12)
    shared = rng.integers(0, 2**60, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 2**62, 30, dtype=np.uint64)])) for _ in range(70)]
    for k in range(10):  # some that are similar: up to 12 of about 90 replaced
        own = np.setdiff1d(sets[k], shared)
        sets.append(np.unique(np.concatenate([np.setdiff1d(sets[k], own[: k + 2]), rng.integers(0, 2**62, k + 2, dtype=np.uint64)])))
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = [(i, i % 37, len(x), simhash.prefix_of(x, none, 800).view(np.int64).tolist(), simhash.parities(x).tolist()) for i, x in enumerate(sets)]
    df = spark.createDataFrame(rows, "node long, component_id long, n long, prefix array<long>, odd array<long>").repartition(3)
    got = [(r.u, r.v) for r in simhash.prefix_candidates(df, 800, *([block] if block < 1 << 13 else [])).collect()]
    jaccard = lambda i, j: len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j]))
    want = {(i, j) for j in range(len(sets)) for i in range(j) if i % 37 != j % 37 and 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))}
    assert len(got) == len(set(got)) and want <= set(got) and len(want) >= 8
    assert len(got) <= len(want) + 20 and all(jaccard(i, j) > 0.6 for i, j in got)


def test_workers_hold_little(spark, tmp_path, monkeypatch):
    """Batches of texts are small while the stages of the pipeline run, and features are sent on in parts with the same model."""
    import corpus_pipeline
    from recordloom.llm import shared, toxicity

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["bad", "worse", "vile"] if i % 3 == 0 else ["good", "fine", "kind"], k=4) + [f"w{chr(97 + i % 26)}x"])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(200)], "doc_id long, toxic int, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get(key)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, 10_000)
            stage(spark, docs, str(tmp_path))
            assert int(spark.conf.get(key)) == shared.ROWS
    finally:
        spark.conf.set(key, before)
    whole = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "HELD", 3)
    parts = toxicity.fit(docs, labels)
    assert whole["lexicon"] and whole["lexicon"] == parts["lexicon"] and whole["prior"] == parts["prior"]


def test_toxicity_takes_apart_only_words_with_a_wanted_feature(monkeypatch):
    """A lexicon's reader finds what a reader of all features finds and the lexicon wants, and looks at no other word's features."""
    rng, whole = random.Random(8), toxicity.features
    words = ["".join(rng.choices("abcdeéll01@.", k=rng.randrange(1, 11))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(20)]
    counts = np.array([rng.randrange(9) for _ in range(1 << 18)])
    everything = toxicity.Reader(counts, lambda f: f).read(texts)
    lexicon = sorted(set().union(*everything))[::97]
    pick, seen = toxicity.lexicon_picker(lexicon), []
    monkeypatch.setattr(toxicity, "features", lambda w: seen.append(w) or whole(w))
    found = toxicity.Reader(counts, pick).read(texts)
    assert [x & set(lexicon) for x in found] == [x & set(lexicon) for x in everything] and any(x & set(lexicon) for x in found)
    heads = {f[1:5] for f in pick.wanted if f[0] == "^"}
    assert seen and all(w in pick.wanted or w[:4] in heads for w in seen)


@pytest.mark.parametrize("name", ["op2_bpe", "op8_token_files"])
def test_query_sends_small_batches(spark, table, tmp_path, name):
    """A worker never gets thousands of long texts at once, and what the query returns does not depend on that."""
    from recordloom.llm import queries, shared

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    table[1].write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get(key)
    try:
        got = []
        for rows in (10_000, 7):
            spark.conf.set(key, rows)
            got.append(sorted(map(str, queries.queries()[name](spark, str(tmp_path)).collect())))
            assert int(spark.conf.get(key)) == min(rows, shared.ROWS)
        assert got[0] == got[1] and len(got[0]) == len(table[0])
    finally:
        spark.conf.set(key, before)
