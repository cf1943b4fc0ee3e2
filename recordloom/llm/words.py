"""Vectorised pre-tokenisation and a word-cached encoder for the public tokenizers.

A slice of documents is laid out as one array of code points with a sentinel after every document.  Token
borders are found by comparing character classes with numpy, the tokens become an Arrow string array that
points into the same bytes, and Arrow's dictionary encoding leaves each distinct token once.  Only those
reach Python or the tokenizer library.

The character classes are read from the library itself (its own regular expression engine decides what a
letter is), so the split is the library's for every code point.  Texts that the vectorised split does not
cover (special strings inside the text, characters that normalisation may join or lengthen) go whole through
the library, so results are the library's in all cases.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, NUMBER, SPACE, OTHER, END = 1, 2, 3, 4, 5
#: Code points from here on are neither letters nor numbers nor blanks: marks, tags, private use, or not assigned.
PLANES = 0x34000


#: The byte-level alphabet: printable bytes stand for themselves, the rest for code points from 256 on.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _OWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(_OWN))}


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(None)
def class_table() -> np.ndarray:
    """uint8 class of every code point, as the library's regular expressions see it; END marks the sentinel."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    table = np.full(0x110001, OTHER, np.uint8)
    for first in range(0, PLANES, 0x4000):
        cps = [c for c in range(first, first + 0x4000) if not 0xD800 <= c < 0xE000]
        text = "".join(map(chr, cps))
        if not text:
            continue
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for piece, (a, b) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text):
                table[cps[a] : cps[b - 1] + 1] = kind
    table[0xD800:0xE000] = OTHER
    table[0x110000] = END
    return table


@lru_cache(None)
def lower_table() -> np.ndarray:
    """Lower-case code point of each that NFC leaves alone in any context and that has a one-character lower case; else 0x110000."""
    table = np.full(0x110001, 0x110000, np.uint32)
    joins = set()
    for c in range(PLANES):
        d = unicodedata.decomposition(chr(c))
        if d and d[0] != "<" and len(parts := d.split()) == 2:
            joins.add(int(parts[1], 16))
    for c in range(PLANES):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or 0x1100 <= c < 0x1200 or c == 0x3A3 or c in joins:
            continue
        if unicodedata.category(ch) in ("Cn", "Mn", "Mc", "Me") or unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
            continue
        low = ch.lower()
        if len(low) == 1:
            table[c] = ord(low)
    table[0x110000] = 0x110000
    return table


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a sentinel after each; and the sentinels' places."""
    cps = np.frombuffer("".join(x for t in texts for x in (t, "\0")).encode("utf-32-le"), np.uint32).copy()
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    cps[ends] = 0x110000
    return cps, ends


def byte_layout(cps: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The byte place of each code point in the UTF-8 form, and that form (sentinels as NUL)."""
    plain = np.where(cps == 0x110000, 0, cps).astype(np.uint32)
    place = np.zeros(len(cps) + 1, np.int64)
    width = np.ones(len(cps), np.int8)
    if len(plain) and plain.max() > 0x7F:
        width += plain > 0x7F
        width += plain > 0x7FF
        width += plain > 0xFFFF
    np.cumsum(width, out=place[1:])
    return place, plain.tobytes().decode("utf-32-le").encode()


def _runs(cls: np.ndarray, ends: np.ndarray) -> np.ndarray:
    new = np.empty(len(cls), bool)
    new[:1] = True
    new[1:] = cls[1:] != cls[:-1]
    new[ends] = True
    new[ends[:-1] + 1] = True
    return new


def _contractions(cps: np.ndarray, cls: np.ndarray, start: np.ndarray) -> None:
    """Cut 's 't 'm 'd 're 've 'll off where an apostrophe starts a token and letters follow."""
    p = np.flatnonzero((cps[:-3] == 39) & start[:-3] & (cls[1:-2] == LETTER)) if len(cps) > 3 else np.empty(0, np.int64)
    tail = [p] if len(p) else []
    # the last places of the array, where two more characters may be missing
    tail.append(np.array([i for i in range(max(0, len(cps) - 3), len(cps) - 1) if cps[i] == 39 and start[i] and cls[i + 1] == LETTER], np.int64))
    p = np.concatenate(tail)
    if not len(p):
        return
    a = cps[p + 1]
    b = cps[np.minimum(p + 2, len(cps) - 1)]
    one = np.isin(a, [ord(x) for x in "stmd"])
    two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    start[p[one | two] + 1] = False
    start[p[one] + 2] = True
    start[np.minimum(p[two] + 3, len(cps) - 1)] = True


def byte_starts(cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Token starts of the byte-level pattern: contractions, one space before a run of a class, white space."""
    cls = class_table()[cps]
    start = _runs(cls, ends)
    b = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] != SPACE) & (cls[1:] != END)) + 1
    start[b - 1] = True
    start[b[cps[b - 1] == 32]] = False
    _contractions(cps, cls, start)
    return start


def word_starts(cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Token starts of the word pattern: contractions, letter runs, single digits, other runs."""
    cls = class_table()[cps]
    start = _runs(cls, ends)
    start |= cls == NUMBER
    _contractions(cps, cls, start)
    return start


def blank_starts(cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Token starts where a run of blanks begins, at each line feed, and at each document's start."""
    start = np.zeros(len(cps), bool)
    blank = cps == 32
    start[1:] = blank[1:] & ~blank[:-1]
    start[:1] = True
    start |= cps == 10
    start[ends] = True
    start[ends[:-1] + 1] = True
    return start


def token_array(cps: np.ndarray, start: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The tokens as a string array over one buffer, and the place (in code points) where each starts."""
    at = np.flatnonzero(start)
    place, data = byte_layout(cps)
    offsets = np.append(place[at], len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data)), at


def ragged_take(flat: np.ndarray, offsets: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Join flat[offsets[i]:offsets[i+1]] over i in idx."""
    n = (offsets[1:] - offsets[:-1])[idx]
    total = int(n.sum())
    if not total:
        return flat[:0]
    before = np.cumsum(n) - n
    return flat[np.repeat(offsets[idx] - before, n) + np.arange(total)]


class WordEncoder:
    """Encodes whole texts as the library does, each distinct token once while it stays in the cache.

    kind: "byte" (byte-level pattern) or "word" (lower-cased word pattern).  ``table`` is a given
    distinct-word table (word -> ids as little-endian 32-bit bytes), looked up before anything is encoded.
    The cache holds ``most`` words and is emptied when full: memory is bounded whatever the corpus holds.
    """

    def __init__(self, path: str, kind: str, table: dict[str, bytes] | None = None, most: int = 300_000):
        self.tok, self.kind, self.table, self.most = tokenizer(path), kind, table or {}, most
        self.model = self.tok.model
        self.cache: dict[str, bytes] = {}
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.encoded = 0

    def words(self, words: list[str]) -> list[bytes]:
        table, cache = self.table, self.cache
        if len(cache) > self.most:
            cache.clear()
        out = [table.get(w) or cache.get(w) for w in words] if table else list(map(cache.get, words))
        lack = [i for i, x in enumerate(out) if x is None]
        merges = self.model.tokenize
        for i in lack:  # a pre-token needs no more normalising or splitting: straight to the merges
            w = words[i]
            # ASCII letters and digits are their own byte characters
            merged = merges(w if w.isascii() and w.isalnum() else "".join(map(BYTE_CHARS.__getitem__, w.encode())))
            out[i] = cache[w] = array("I", [t.id for t in merged]).tobytes()
        self.encoded += len(lack)
        return out

    def covered(self, texts: list[str], cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts the vectorised split covers."""
        odd = np.zeros(len(cps), bool)
        if self.kind == "word":
            odd = (cps >= PLANES) | (lower_table()[cps] == 0x110000)
            odd[ends] = False
        ok = np.ones(len(texts), bool)
        ok[np.searchsorted(ends, np.flatnonzero(odd))] = False
        for s in self.specials:
            for i, t in enumerate(texts):
                if s in t:
                    ok[i] = False
        return ok

    def split(self, texts: list[str]) -> tuple[np.ndarray, pa.StringArray, np.ndarray, np.ndarray]:
        """(covered texts, distinct tokens, index of each token's distinct form, token offsets of each text).

        Texts that are not covered have no tokens here.
        """
        cps, ends = code_points(texts)
        ok = self.covered(texts, cps, ends)
        if not ok.all():
            cps, ends = code_points([t if k else "" for t, k in zip(texts, ok, strict=True)])
        if self.kind == "word":
            cps = lower_table()[cps]
            tokens, at = token_array(cps, word_starts(cps, ends))
            keep = ~np.isin(class_table()[cps[at]], (SPACE, END))
        else:
            tokens, at = token_array(cps, byte_starts(cps, ends))
            keep = cps[at] != 0x110000
        tokens, at = tokens.filter(pa.array(keep)), at[keep]
        coded = tokens.dictionary_encode()
        offsets = np.searchsorted(at, np.concatenate([[0], ends]))
        return ok, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), offsets

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and each text's offsets in it."""
        return self.assembled(texts, *self.split(texts))

    def assembled(self, texts: list[str], ok: np.ndarray, distinct: pa.StringArray, idx: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same from what ``split`` gave for the texts."""
        ids = self.words(distinct.to_pylist())
        flat = np.frombuffer(b"".join(ids), np.uint32)
        off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        out = ragged_take(flat, off, idx)
        per_token = np.concatenate([[0], np.cumsum((off[1:] - off[:-1])[idx])])
        offsets = per_token[at].astype(np.int64)
        if ok.all():
            return out, offsets
        parts = []
        for i, t in enumerate(texts):
            parts.append(out[offsets[i] : offsets[i + 1]] if ok[i] else np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32))
        return np.concatenate(parts) if parts else out, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str, kind: str, most: int = 300_000) -> WordEncoder:
    """This worker process's encoder: its cache serves all tasks that the process runs."""
    key = (path, kind, most)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, kind, most=most)
    return _ENCODERS[key]
