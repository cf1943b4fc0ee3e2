"""Toxicity scores on deobfuscated text (a noisy-channel decoder over character lattices).

1. A character trigram model is counted over all texts: tasks send their trigram counts, at most 64**3 of them.
2. A token that is no plain word, or has a doubled letter, becomes a lattice: a letter stands for itself, a digit or sign for the letters it
   may imitate or for nothing, a run of one letter for one or two of it; a run of single-letter tokens is one lattice,
   read as one word and with word ends inside, whatever its length, and so are long tokens.  Viterbi decoding finds the likeliest letters under the trigram model.
3. Words, word beginnings, and beginnings that two or three different words of a text share are counted in toxic and
   other documents of at most ``SAMPLE`` labelled rows (in hash order).  A greedy cover takes those that explain toxic
   documents not yet explained, so words of a group of copies bring nothing once its cause is found.  A document's score is the
   logistic of the prior log odds (of texts without an entry) and of what its distinct entries add to them.

Defined results: null text is empty; an empty text scores the prior of texts without an entry; repeated rows give
repeated rows, and of several texts of a labelled id that with the smallest hash is learnt from; an id with several
labels counts with the largest; null doc_id is carried (and is in no labelled row); without labelled rows of both kinds every score is 0;
an empty table gives an empty table; all columns of the input are kept, and an input column named like a
result column is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import CHARS, slices, stored, texts_of, trimmed
from .words import END, SPACE, class_table, code_points, token_array

SAMPLE = 12_000
#: A lexicon entry explains at least so many toxic documents of the sample, and this share of those it is in.
LEAST, PRECISION = 6, 0.8
#: Near the end of the cover, an entry may explain as few as FEW new documents if it is in OFTEN toxic ones, at this share.
FEW, OFTEN, SURE = 2, 30, 0.95

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
#: Letters that a sign may stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou"}
SWAP, SKIP, REPEAT = 1.5, 1.0, 0.5
CODE = {c: i + 1 for i, c in enumerate(ALPHABET)}

PLAIN = re.compile(rf"[{ALPHABET}]+")
EDGES = re.compile(rf"^[^{ALPHABET}0-9@$|!+€*]+|[.,;:?!)\]}}\"'…»%&#*$|<>]+$")
RUN, DOUBLE = re.compile(r"(.)\1\1+"), re.compile(r"(.)\1")
#: Signs between words glued together: neither letters nor signs that imitate one.
GLUE = re.compile(rf"[^{ALPHABET}{re.escape(''.join(LOOKS))}]+")
#: Longer tokens are also parted into words, and not kept in memory.
LONG = 40
#: Tokens whose features a task keeps, and features that it counts before it sends them on.
WORDS, HELD = 100_000, 150_000


def _codes() -> np.ndarray:
    table = np.zeros(0x110001, np.int64)
    for c, i in CODE.items():
        table[ord(c)] = i
        if len(c.upper()) == 1:
            table[ord(c.upper())] = i
    return table


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(g, n): counts of letter trigrams, 0 for anything that is no letter, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _codes(), np.zeros(1 << 18, np.int64)
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                c = table[code_points(texts_of(part))[0]]
                if len(c) > 2:
                    total += np.bincount(c[:-2] << 12 | c[1:-1] << 6 | c[2:], minlength=1 << 18)
        g = np.flatnonzero(total)
        yield pa.record_batch([pa.array(g.astype(np.int32)), pa.array(total[g])], names=["g", "n"])

    return docs.select("text").mapInArrow(count, "g int, n long").groupBy("g").agg(F.sum("n").alias("n"))


class Channel:
    """The decoder: log probabilities of a letter after two others, and the lattice of a token."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(64, 64, 64).astype(float) + 0.01
        self.log = np.log(cube / cube.sum(axis=2, keepdims=True))
        self.flat = self.log.ravel().tolist()  # of a, b, k at a << 12 | b << 6 | k: a list is read faster one by one
        self.cache: dict[tuple[str, bool], str] = {}

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        out, i = [], 0
        while i < len(token):
            c, j = token[i], i
            while j < len(token) and token[j] == c:
                j += 1
            n = j - i
            if c in CODE:
                out.append([(c, 0.0)] if n == 1 else [(c, REPEAT * (n - 1)), (c * 2, REPEAT * (n - 2))])
            else:
                options = [("", SKIP)]
                for x in LOOKS.get(c, ""):
                    options += [(x * min(n, 2), SWAP)] if n < 3 else [(x, SWAP)]
                out.append(options)
            i = j
        return out

    def decode(self, token: str, bounds: bool = False) -> str:
        """The likeliest letters; with ``bounds`` words may end anywhere, and blanks part them."""
        log = self.flat
        paths: dict[int, tuple[float, tuple]] = {0: (0.0, ())}  # by a << 6 | b, the last two letters; back pointers, so that cost is linear
        for options in self.lattice(token):
            nxt: dict[int, tuple[float, tuple]] = {}
            for ab, (score, back) in paths.items():
                starts = [(score, ab, "")]
                if bounds and ab & 63:
                    starts.append((score + log[ab << 6], (ab & 63) << 6, " "))
                for first, pq, blank in starts:
                    for letters, cost in options:
                        s, xy = first - cost, pq
                        for c in letters:
                            xyk = xy << 6 | CODE[c]
                            s += log[xyk]
                            xy = xyk & 4095
                        if xy not in nxt or nxt[xy][0] < s:
                            nxt[xy] = (s, (back, blank + letters))
            paths = nxt
        back, out = max(((s + log[ab << 6], t) for ab, (s, t) in paths.items()), key=lambda x: x[0])[1], []
        while back:
            back, letters = back
            out.append(letters)
        return "".join(reversed(out))

    def decoded(self, token: str, bounds: bool = False) -> str:
        if len(token) > LONG:
            return self.decode(token, bounds)
        if len(self.cache) > WORDS // 3:
            self.cache.clear()
        key = (token, bounds)
        if key not in self.cache:
            self.cache[key] = self.decode(token, bounds)
        return self.cache[key]

    def restore(self, token: str) -> tuple[str, ...]:
        """The words of a lower-case token."""
        plain = token.isascii() and token.isalpha() and token.islower()  # a word as it stands
        core = token if plain else EDGES.sub("", token)
        if (plain or PLAIN.fullmatch(core)) and not DOUBLE.search(core):
            return (core,) if len(core) <= LONG else (core, *self.decoded(core, True).split())
        words = (core,) if PLAIN.fullmatch(core) and not RUN.search(core) else tuple(w for w in re.findall(rf"[{ALPHABET}]+", token) if len(w) > 1)
        bare = core or token
        if any(c in CODE for c in bare):
            words += (self.decoded(bare),)
            parts = [x for x in GLUE.split(bare) if x]
            if len(parts) > 1:  # words glued by signs that imitate no letter
                words += tuple(self.decoded(x) for x in parts if len(x) > 1)
            if len(bare) > LONG:
                words += tuple(self.decoded(bare, True).split())
        return tuple(dict.fromkeys(w for w in words if w))

    def spaced(self, letters: str) -> tuple[str, ...]:
        """The words of a run of single letters: all of it as one, and parted where words are likely to end."""
        return tuple(dict.fromkeys(w for w in (*self.restore(letters), *self.decoded(letters, True).split()) if w))


#: A beginning is a feature anew when so many different words of a text have it, and again when they are one in RATE of its words.
SHARED, RATE = (2, 3), 200


def features(word: str) -> list[str]:
    return [word, *(f"^{word[:n]}" for n in range(4, 8) if len(word) > n)]


class lexicon_picker:
    """What to read for a lexicon: its entries, and the beginnings that its entries count."""

    def __init__(self, entries):
        self.wanted = set(entries) | {f[f.index("^") :] for f in entries if "^" in f}
        self.heads = {f[1:5] for f in self.wanted if f[0] == "^"}  # no longer beginning is wanted of a word that begins otherwise

    def __call__(self, f: str) -> str | None:
        return f if f in self.wanted else None

    def some(self, word: str) -> bool:
        """Whether any of the word's features may be wanted."""
        return word in self.wanted or word[:4] in self.heads


class Reader:
    """Distinct restored features of texts; ``pick`` maps a feature to what is kept of it (None: nothing)."""

    def __init__(self, counts: np.ndarray, pick):
        self.channel, self.pick, self.some = Channel(counts), pick, getattr(pick, "some", None)
        self.cache: dict[str, tuple] = {}

    def picked(self, words: tuple[str, ...]) -> tuple:
        if self.some:
            words = tuple(w for w in words if self.some(w))
            if not words:
                return ()
        found = (self.pick(f) for w in words for f in features(w))
        return tuple(dict.fromkeys(x for x in found if x is not None))

    def of_token(self, token: str) -> tuple:
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) > WORDS:
                self.cache.clear()
            got = self.picked(self.channel.restore(token))
            if len(token) <= LONG:
                self.cache[token] = got
        return got

    def read(self, texts: list[str]) -> list[set]:
        cps, ends = code_points(texts)
        space = np.isin(class_table()[cps], (SPACE, END))
        start = np.empty(len(cps), bool)
        start[:1] = True
        start[1:] = space[1:] != space[:-1]
        start[ends[:-1] + 1] = True
        tokens, at = token_array(cps, start)
        keep = ~space[at]
        length = np.diff(np.append(at, len(cps)))[keep]
        tokens, at = pc.utf8_lower(tokens.filter(pa.array(keep))), at[keep]
        coded = tokens.dictionary_encode()
        idx = coded.indices.to_numpy(zero_copy_only=False)
        found = [self.of_token(t) for t in coded.dictionary.to_pylist()]
        has = np.fromiter(map(bool, found), bool, len(found))
        doc = np.searchsorted(ends, at)
        out: list[set] = [set() for _ in texts]
        hit = np.flatnonzero(has[idx])
        shared: list[Counter] = [Counter() for _ in texts]
        for d, k in set(zip(doc[hit].tolist(), idx[hit].tolist(), strict=True)):
            out[d].update(found[k])
            shared[d].update(f for f in found[k] if f[0] == "^")
        for own, counts, words in zip(out, shared, np.bincount(doc, minlength=len(texts)).tolist(), strict=True):
            for f, c in counts.items():
                for n in SHARED:
                    if c >= n:
                        own.update((f"{n}{f}", f"{n}~{f}") if c * RATE >= words else (f"{n}{f}",))
        # runs of four or more single letters within one text are one word spaced out
        one = (length == 1) & (np.concatenate([[1], np.diff(doc)]) == 0) if len(doc) else np.zeros(0, bool)
        run = np.flatnonzero(one)
        for part in np.split(run, np.flatnonzero(np.diff(run) > 1) + 1) if len(run) else []:
            if len(part) >= 3:
                first = part[0] - 1 if length[part[0] - 1] == 1 else part[0]
                if part[-1] - first >= 3:
                    out[doc[part[0]]].update(self.picked(self.channel.spaced("".join(tokens.slice(first, part[-1] - first + 1).to_pylist()))))
        return out


def training_ids(labels: DataFrame, column: str, most: int) -> DataFrame:
    """(doc_id, y) of at most ``most`` labelled rows outside the held-out fold, in hash order."""
    good = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    one = good.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def one_text(docs: DataFrame, *marks: str) -> DataFrame:
    """One row per doc_id: of several texts that with the smallest hash, so every run learns from the same."""
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")
    return docs.groupBy("doc_id").agg(least, *[F.max(m).alias(m) for m in marks]).select("doc_id", "x.text", *marks)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model: trigram counts, lexicon with weights, prior."""
    counts = np.zeros(1 << 18, np.int64)
    for r in trigram_counts(docs).collect():  # at most 64**3 rows
        counts[r.g] = r.n
    ids = training_ids(labels, "toxic", sample)
    own = one_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id"), "y")
    own = stored(own.select("doc_id", "text", "y"), "sample")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts, lambda f: f)
        bad, good = Counter(), Counter()

        def counted() -> pa.RecordBatch:
            names = list(bad.keys() | good.keys())
            out = pa.record_batch([pa.array(names, pa.string()), pa.array([bad[x] for x in names], pa.int64()), pa.array([good[x] for x in names], pa.int64())], names=["f", "bad", "good"])
            bad.clear()
            good.clear()
            return out

        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                for y, found in zip(part.column(2).to_pylist(), reader.read(texts_of(part)), strict=True):
                    (bad if y else good).update(found)
                if len(bad) + len(good) > HELD:
                    yield counted()
        yield counted()

    total = own.mapInArrow(tally, "f string, bad long, good long").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    able = total.where(f"bad >= {LEAST} AND bad >= {PRECISION} * (bad + good)")
    odds = {r.f: (r.bad, r.good) for r in able.collect()}  # bounded by the sample

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts, lexicon_picker(odds))
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                found = [sorted(f for f in x if f in odds) for x in reader.read(texts_of(part))]
                yield pa.record_batch([part.column(2), pa.array(found, pa.list_(pa.string()))], names=["y", "found"])

    rows = own.mapInArrow(hold, "y int, found array<string>").collect()
    bad_n, good_n = sum(r.y == 1 for r in rows), sum(r.y != 1 for r in rows)
    holders: dict[str, set[int]] = {}
    for i, r in enumerate(rows):
        if r.y:
            for f in r.found:
                holders.setdefault(f, set()).add(i)
    lexicon: dict[str, float] = {}
    left = {i for i, r in enumerate(rows) if r.y}
    for gain_needed, often, precision in ((LEAST, LEAST, PRECISION), (FEW, OFTEN, SURE)):
        able_now = {f: h for f, h in holders.items() if f not in lexicon and odds[f][0] >= often and odds[f][0] >= precision * sum(odds[f])}
        while able_now:
            gain, f = max(((len(h & left), f) for f, h in able_now.items()), key=lambda x: (x[0] - odds[x[1]][1], x[0], -len(x[1]), x[1]))
            if gain < gain_needed:
                break
            bad, good = odds[f]
            lexicon[f] = math.log((bad + 0.5) / (good + 0.5))
            left -= able_now.pop(f)
    plain = sum(1 for r in rows if not r.y and not any(f in lexicon for f in r.found))
    prior = math.log((len(left) + 0.5) / (plain + 0.5)) if bad_n and good_n else None
    if prior is not None:  # a text with one entry gets that entry's odds
        lexicon = {f: w - prior for f, w in lexicon.items()}
    return {"counts": counts, "lexicon": lexicon, "prior": prior}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    rest = docs.select(*[F.col(f"`{f.name}`") for f in kept])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weights = Reader(m["counts"], lexicon_picker(m["lexicon"]))
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                found = weights.read(texts_of(part))
                if m["prior"] is None:
                    s = np.zeros(len(found))
                else:
                    s = np.array([1 / (1 + math.exp(-max(-50.0, min(50.0, m["prior"] + sum(m["lexicon"].get(f, 0.0) for f in sorted(x)))))) for x in found])
                yield pa.record_batch([*part.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*part.schema.names, "score", "predicted"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rest.mapInArrow(run, f"{out}, score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
