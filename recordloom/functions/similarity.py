"""String similarities that Spark lacks, as Arrow-batched functions over aligned pairs.

Empty against empty: ratios 100 (token set 0), Jaro-Winkler 1.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel addition on one long integer."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs(a, b) / total


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    p, q = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not p or not q):
        return 100.0
    left, right = (f"{both} {p}".strip(), f"{both} {q}".strip())
    best = ratio(left, right)
    return max(best, ratio(both, left), ratio(both, right)) if both else best


def window_lcs(a: str, b: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """LCS lengths of ``a`` (no longer than ``b``) with every window of its length in ``b``, and with the shorter windows at b's ends.

    (whole windows by their start, prefixes of b by their length - 1, suffixes by their start from len(b) - len(a) + 1).
    One strand enters at each character; two strands cross at a cell at most once, and not where the characters are
    equal.  A window's LCS is its length less the strands that enter and leave within it.  Cells of one
    anti-diagonal do not depend on each other, so a diagonal is a few array operations.
    """
    m, n = len(a), len(b)
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a[::-1], b))
    left, top = np.arange(m), np.arange(m, m + n)
    for d in range(m + n - 1):
        first, last, off = max(0, d - m + 1), min(d, n - 1) + 1, m - 1 - d
        h, v = left[off + first : off + last], top[first:last]
        cross = (x[off + first : off + last] == y[first:last]) | (h > v)
        left[off + first : off + last], top[first:last] = np.where(cross, v, h), np.where(cross, h, v)
    start = top - m  # where the strand that leaves at r entered; below 0: at the left
    end = np.full(n, n)
    end[start[start >= 0]] = np.flatnonzero(start >= 0)
    inside = np.cumsum(start >= 0)  # strands of the prefix that end by r
    own = np.arange(n - m)
    gone = np.concatenate([[0], np.cumsum(end[: n - m] < own + m)])
    came = np.concatenate([[0], np.cumsum(start[m:] >= own + 1)])
    whole = m - (inside[m - 1] - gone + came)
    prefix = np.arange(1, m) - inside[: m - 1]
    tail = np.arange(n - m + 1, n)
    within = np.cumsum((end < n)[::-1])[::-1]
    return whole, prefix, (n - tail) - within[tail]


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter with a window of its length in the longer, cut at the longer's ends too."""
    a, b = sorted((a, b), key=len)
    m = len(a)
    if not m:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    whole, prefix, suffix = window_lcs(a, b)
    size = np.arange(1, m)
    best = [200.0 * whole.max() / (2 * m)]
    if m > 1:
        best += [(200.0 * prefix / (m + size)).max(), (200.0 * suffix / (m + size[::-1])).max()]
    return float(max(best))


def jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    hit_a, hit_b = [False] * len(a), [False] * len(b)
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not hit_b[j] and b[j] == c:
                hit_a[i] = hit_b[j] = True
                break
    x, y = [c for c, h in zip(a, hit_a, strict=True) if h], [c for c, h in zip(b, hit_b, strict=True) if h]
    m = len(x)
    if not m:
        return 0.0
    swaps = sum(p != q for p, q in zip(x, y, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    head = 0
    for p, q in zip(a[:4], b[:4], strict=False):
        if p != q:
            break
        head += 1
    return jaro + 0.1 * head * (1 - jaro) if jaro > 0.7 else jaro


#: Cells of the table of letters that ``jaro_winkler_many`` holds at most; beyond that pairs are compared one by one.
CELLS = 1 << 24


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and code points in rows of 64 (0 after the end; a longer text has an empty row)."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), 64), np.uint32)
    short = n <= 64
    flat = np.frombuffer("".join(t for t, ok in zip(texts, short.tolist(), strict=True) if ok).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[short[:, None] & (np.arange(64) < n[:, None])] = flat
    return n, out


def jaro_winkler_many(left: list[str], right: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``jaro_winkler`` of left[i] and right[j] for all pairs of places (i, j), the places of a text as bits of a 64-bit word; pairs with a text of more than 64 characters one by one."""
    (n_a, a), (n_b, b) = _letters(left), _letters(right)
    symbols, codes = np.unique(np.concatenate([a.ravel(), b.ravel(), np.zeros(1, np.uint32)]), return_inverse=True)
    a, b = codes[: a.size].reshape(a.shape), codes[a.size : -1].reshape(b.shape)  # 0 is no letter
    out = np.zeros(len(i))
    fast = (n_a[i] <= 64) & (n_b[j] <= 64) & (len(right) * len(symbols) <= CELLS)
    for k in np.flatnonzero(~fast).tolist():
        out[k] = jaro_winkler(left[i[k]], right[j[k]])
    at = np.flatnonzero(fast)
    if not len(at):
        return out
    one, where = np.uint64(1), np.zeros((len(right), len(symbols)), np.uint64)  # where in the text a letter is
    for p in range(int(n_b[n_b <= 64].max(initial=0))):
        where[np.arange(len(right)), b[:, p]] |= one << np.uint64(p)
    where[:, 0] = 0
    below = np.array([(1 << p) - 1 for p in range(65)], np.uint64)
    at = at[np.argsort(-n_a[i[at]], kind="stable")]
    x, y = i[at], j[at]
    la, lb = n_a[x], n_b[y]
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    used, hit = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for p in range(int(la.max(initial=0))):
        k = int(np.searchsorted(-la, -p, "left"))  # those longer than p
        window = below[np.minimum(p + reach[:k] + 1, 64)] & ~below[np.maximum(p - reach[:k], 0).clip(max=64)]
        free = where[y[:k], a[x[:k], p]] & window & ~used[:k]
        used[:k] |= free & (~free + one)
        hit[:k] |= (free != 0).astype(np.uint64) << np.uint64(p)
    m = np.bitwise_count(hit).astype(np.int64)
    swaps, rest, mine, theirs = np.zeros(len(at), np.int64), np.flatnonzero(m), hit.copy(), used.copy()
    while len(rest):
        u, v = mine[rest], theirs[rest]
        p, q = (np.bitwise_count((z & (~z + one)) - one) for z in (u, v))
        swaps[rest] += a[x[rest], p] != b[y[rest], q]
        mine[rest], theirs[rest] = u & (u - one), v & (v - one)
        rest = rest[mine[rest] != 0]
    some = m > 0
    k, la_, lb_ = m[some], la[some], lb[some]
    jaro = (k / la_ + k / lb_ + (k - swaps[some] // 2) / k) / 3
    alike = (a[x[some], :4] == b[y[some], :4]) & (a[x[some], :4] != 0)
    head = np.logical_and.accumulate(alike, axis=1).sum(axis=1)
    value = np.zeros(len(at))
    value[some] = np.where(jaro > 0.7, jaro + 0.1 * head * (1 - jaro), jaro)
    value[(la == 0) & (lb == 0)] = 1.0
    out[at] = value
    return out


#: Scorers that take all pairs of a batch at once.
MANY = {jaro_winkler: jaro_winkler_many}


def _lift(f):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        # each distinct pair of strings of a batch once
        (x, left), (y, right) = (pd.factorize(c.fillna("")) for c in (a, b))
        code, first, back = np.unique(x.astype(np.int64) * max(1, len(right)) + y, return_index=True, return_inverse=True)
        values = MANY[f](list(left), list(right), x[first], y[first]) if f in MANY else np.array([f(left[x[i]], right[y[i]]) for i in first], np.float64)
        return pd.Series(values[back] if len(code) else [], dtype="float64")

    return F.pandas_udf(run, "double")


SCORERS = {"ratio": ratio, "token_sort": token_sort, "token_set": token_set, "partial": partial, "jaro_winkler": jaro_winkler}


def scorer(name: str):
    """The column function of a scorer; also what to give spark.udf.register."""
    return _lift(SCORERS[name])
