"""A gap-weighted subsequence kernel on words, with Nyström landmarks, for operator 1.

A word's features are its subsequences of three letters within eight, each occurrence weighted by DECAY to the power
of its span, divided by the norm that different letters would give a word of that length, and by their own norm where
repeated letters make that greater than 1.  The kernel of two
words is the product of their features, so inserted, doubled and dropped letters cost little.
"""

from __future__ import annotations

import numpy as np

LETTERS, SPAN, DECAY = 59, 8, 0.7

# Codes of bytes: a-z in either case 1-26; the last bytes of other letters 27-58, folding the two cases
# of Latin letters; 0 for all else.  First bytes of longer letters count as nothing within a word.
CODE = np.zeros(256, np.uint8)
CODE[97:123] = np.arange(1, 27)
CODE[65:91] = np.arange(1, 27)
CODE[128:192] = 27 + (np.arange(128, 192) & 31)
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def _norms(most: int) -> np.ndarray:
    lengths = np.arange(most + 1)
    total = np.zeros(most + 1)
    for last in range(2, SPAN):
        total += np.maximum(lengths - last, 0) * (last - 1) * DECAY ** (2 * (last + 1))
    return np.sqrt(np.maximum(total, 1e-12))


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes of some texts, where each unit begins, and the text number of each unit.

    A unit is the letters of a blank-separated word, other signs left out; words of one letter in a row make
    one unit, so spelt-out words are seen whole.
    """
    codes = CODE[data]
    at = np.flatnonzero(codes)
    if len(at) == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none
    text = np.searchsorted(offsets[1:], at, side="right")
    blanks = np.cumsum(BLANK[data])[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (blanks[1:] != blanks[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(fresh)
    of = text[starts]
    single = np.diff(starts, append=len(at)) == 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (of[1:] == of[:-1])
    return codes[at], starts[~joined], of[~joined]


def _triples(codes: np.ndarray, starts: np.ndarray):
    """For each pair of gaps: where triples begin, and their codes."""
    ends = np.append(starts[1:], len(codes))
    left = np.repeat(ends, ends - starts) - np.arange(len(codes)) - 1
    wide = codes.astype(np.int32)
    where = np.arange(len(codes))
    for last in range(2, SPAN):
        where = where[left[where] >= last]
        if len(where) == 0:
            return
        outer = wide[where] * (LETTERS * LETTERS) + wide[where + last]
        for middle in range(1, last):
            yield last, where, outer + wide[where + middle] * LETTERS


def decisions(codes: np.ndarray, starts: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """The value of a linear function of the features for each unit."""
    if len(starts) == 0:
        return np.zeros(0)
    sums = np.zeros(len(codes), np.float32)
    for last, where, triple in _triples(codes, starts):
        sums[where] += weights[triple] * np.float32(DECAY ** (last + 1))
    lengths = np.diff(starts, append=len(codes))
    value = np.add.reduceat(sums, starts) / _norms(int(lengths.max()))[lengths]
    # Repeated letters make a word's features longer than 1; where that could tell, it is scaled back.
    ends = np.append(starts[1:], len(codes))
    blob = codes.tobytes()
    high = np.flatnonzero(np.abs(value) > 1.5)
    for begin in range(0, len(high), 4096):
        part = high[begin: begin + 4096]
        value[part] /= np.maximum(1, own_norms([blob[starts[i]: ends[i]] for i in part]))
    return value + bias


def _sparse(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, subsequence codes and values of the features of a bounded list of words."""
    codes = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    parts = [(owner[where], triple, np.full(len(where), DECAY ** (last + 1)))
             for last, where, triple in _triples(codes, starts[lengths > 0])]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rows, triples, values = (np.concatenate(x) for x in zip(*parts))
    return rows, triples.astype(np.int64), values / _norms(int(lengths.max()))[lengths[rows]]


def own_norms(words: list[bytes]) -> np.ndarray:
    """The length of each word's features."""
    rows, triples, values = _sparse(words)
    keys, place = np.unique(rows * LETTERS ** 3 + triples, return_inverse=True)
    sums = np.bincount(place, weights=values, minlength=len(keys))
    return np.sqrt(np.bincount(keys // LETTERS ** 3, weights=sums ** 2, minlength=len(words)))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of a bounded list of words, and the subsequence that each column stands for; others are 0."""
    rows, triples, values = _sparse(words)
    columns, place = np.unique(triples, return_inverse=True)
    out = np.zeros((len(words), len(columns)))
    np.add.at(out, (rows, place), values)
    return out / np.maximum(1, np.linalg.norm(out, axis=1))[:, None], columns


def kernel(words: list[bytes], landmarks: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Kernel values of words with landmarks, given by their features, a block at a time."""
    out = np.zeros((len(words), len(landmarks)))
    for begin in range(0, len(words), 512):
        rows, triples, values = _sparse(words[begin: begin + 512])
        place = np.minimum(np.searchsorted(columns, triples), len(columns) - 1)
        known = columns[place] == triples
        block = np.zeros((min(512, len(words) - begin), len(columns)))
        np.add.at(block, (rows[known], place[known]), values[known])
        own = np.maximum(1, own_norms(words[begin: begin + 512]))
        out[begin: begin + 512] = block @ landmarks.T / own[:, None]
    return out


def spread_out(words: list[bytes], n: int) -> list[bytes]:
    """Up to ``n`` landmarks: the first word, then again and again the one least like those taken."""
    words = words[:400]
    if len(words) <= n:
        return words
    feats, _ = features(words)
    gram = feats @ feats.T
    own = np.sqrt(np.maximum(np.diag(gram), 1e-12))
    likeness = gram / own[:, None] / own
    taken = [0]
    nearest = likeness[0].copy()
    while len(taken) < n:
        nxt = int(np.argmin(nearest))
        taken.append(nxt)
        nearest = np.maximum(nearest, likeness[nxt])
    return [words[i] for i in sorted(taken)]


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, turns: int = 40) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge loss, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weight = weight / weight.sum()
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-8
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        inside = y * (x @ w) < 1
        part, share = x[inside], weight[inside]
        new = np.linalg.solve((part * share[:, None]).T @ part + np.diag(ridge), (part * share[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, turns: int = 60) -> np.ndarray:
    """Weights and intercept of a logistic regression, by damped Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    ridge = np.full(x.shape[1], penalty * len(x))
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step / max(1.0, np.abs(step).max() / 3)
        if np.abs(step).max() < 1e-8:
            break
    return w
