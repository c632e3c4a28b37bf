"""Operator 3: repeated passages by MinHash bands over sliding paragraphs.

A paragraph is any run of 50 words, wherever it stands, so passages inside longer lines count.  Two
paragraphs are alike when the sets of their five-word shingles have a Jaccard similarity of at least 0.8 (equal, one
word replaced, inserted or deleted, or clauses swapped).

1. Bands.  Each of three hash functions picks the least shingle of every paragraph.  Neighbours mostly
   share their pick, so a text falls into few runs of paragraphs with one pick, about one per 23 words
   and band.  Equal paragraphs always collide, those at a similarity of 0.8 miss all bands of one
   paragraph with a chance of 0.008, and a passage of more than 50 words has several.
2. Runs that are equal as a whole form one node, counted with partial aggregates.
3. Different runs around one pick meet in shards and are verified: runs whose paragraphs hold too many shingles
   that no other run around the pick has are done; the others are compared by their shingle sets, in larger
   groups hubs first, and then all pairs that are not connected yet or may add words.  Groups of more than ``GROUP``
   runs are dealt over blocks, and every pair of blocks is settled by itself, so no task holds more than a shard or two blocks.
   Paragraphs that are alike mark their common words and link their runs.
4. Components of linked runs form a cluster.  Its first occurrence (by id, then place) stays; all
   other occurrences lose the common words of their alike paragraphs, except words that some kept occurrence needs.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import HASHED_BYTES, filled, join_documents, parts_for, text_bytes, text_slices
from tidemark.llm.components import components
from tidemark.llm.rolling import FOLDED, Hashed, least_runs, mix, numbers, word_grams, word_ranges
from tidemark.session import checkpointed

WORDS, SHINGLE, BANDS, PERCENT = 50, 5, 3, 80
_SEEDS = numbers(BANDS, 11)
_LEFT, _RIGHT = WORDS - SHINGLE, WORDS
_PER = WORDS - SHINGLE + 1
GROUP, SHARD, SMALL = 8192, 4000, 16

_RUNS = "k bigint, s bigint, d bigint, h bigint, at bigint"
_CONTEXTS = "k bigint, s bigint, u bigint, at bigint, words binary"
# The keeper of spans that only rows without id keep.
_NOBODY = np.iinfo(np.int64).max
_FOUND = "s bigint, u bigint, other bigint, x int, y int"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end of every word of some texts, and where each text's words begin and end."""
    data, offsets = text_bytes(texts)
    begin, end, text = word_ranges(data, offsets)
    if len(begin) == 0:
        return np.zeros(0, np.uint64), begin, end, np.zeros(len(offsets), np.int64)
    words = mix(Hashed(FOLDED[data]).ranges(begin, end))
    return words, begin, end, np.searchsorted(text, np.arange(len(offsets)))


def _runs(docs: DataFrame, keys_only: bool = False) -> DataFrame:
    """The runs of all texts; ``keys_only`` gives the column ``k`` alone, at less cost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch, "text")
            for begin, end in text_slices(texts, HASHED_BYTES):
                words, _, _, offsets = _words(texts.slice(begin, end - begin))
                grams, whole = word_grams(words, SHINGLE), None if keys_only else Hashed(words)
                for seed in _SEEDS:
                    picked = mix(grams ^ seed)
                    of, lo, windows, (place,) = least_runs([picked], WORDS - SHINGLE + 1, offsets, WORDS)
                    k = picked[place]
                    if keys_only:
                        yield pa.record_batch([pa.array(k.view(np.int64))], names=["k"])
                        continue
                    s = mix(whole.ranges(lo, lo + windows + WORDS - 1) + k)
                    at = ((lo - offsets[of]) << 16) | (windows << 8) | (place - lo)
                    rows = pa.array(of + begin)
                    yield pa.record_batch(
                        [pa.array(k.view(np.int64)), pa.array(s.view(np.int64)), batch.column(0).take(rows),
                         batch.column(1).take(rows), pa.array(at)], names=["k", "s", "d", "h", "at"])

    return docs.mapInArrow(run, "k bigint" if keys_only else _RUNS)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted runs, as 32-bit hashes."""
    for batch in batches:
        texts = filled(batch, "text")
        lists = batch.column(batch.schema.get_field_index("list"))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        wanted = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets -= offsets[0]
        at = wanted.field("at").to_numpy()
        for begin, end in text_slices(texts, HASHED_BYTES):
            words, _, _, places = _words(texts.slice(begin, end - begin))
            low = words.astype(np.uint32) | np.uint32(1)
            some = slice(int(offsets[begin]), int(offsets[end]))
            first = np.repeat(places[:-1], np.diff(offsets[begin: end + 1])) + (at[some] >> 16)
            lengths = ((at[some] >> 8) & 255) + WORDS - 1
            upto = np.append(0, np.cumsum(lengths))
            taken = low[np.repeat(first - upto[:-1], lengths) + np.arange(upto[-1])]
            column = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer((upto * 4).astype(np.int32)), pa.py_buffer(taken)])
            mine = wanted.slice(some.start, some.stop - some.start)
            yield pa.record_batch([*(mine.field(c) for c in ("k", "s", "u", "at")), column], names=["k", "s", "u", "at", "words"])


def alike(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which paragraphs of rows of aligned words (0: none) are alike with the one at the same place: a flag for each
    first word."""
    n = len(one)
    runs = Runs(np.concatenate([one, two]), np.tile(np.arange(n), 2))
    return runs.compare(np.arange(n), np.arange(n, 2 * n))[2]


class Runs:
    """Shingle sets of the paragraphs of runs (rows of words, 0: none); runs are compared within their group only."""

    def __init__(self, table: np.ndarray, group: np.ndarray):
        rows, places = len(table), table.shape[1] - SHINGLE + 1
        grams = np.zeros((rows, places), np.uint64)
        words = table.astype(np.uint64)
        for j, factor in enumerate(numbers(SHINGLE, 2) | np.uint64(1)):
            grams += words[:, j: j + places] * factor
        ids, names = pd.factorize((grams + mix(group.astype(np.int64).view(np.uint64))[:, None]).ravel())
        # The number of the shingle at each place, and where the run holds it before; -1: none.
        self.ids = ids.reshape(rows, places).astype(np.int32)
        whole = (table[:, :places] > 0) & (table[:, SHINGLE - 1:] > 0)
        self.earlier = np.full((rows, places), -1, np.int16)
        apart = np.where(whole, self.ids, -1 - np.arange(places, dtype=np.int32))
        ranked = np.sort(apart, axis=1)
        several = np.flatnonzero((ranked[:, 1:] == ranked[:, :-1]).any(axis=1))
        order = np.argsort(apart[several], axis=1, kind="stable")
        ranked = np.take_along_axis(apart[several], order, axis=1)
        row, at = np.nonzero(ranked[:, 1:] == ranked[:, :-1])
        self.earlier[several[row], order[row, at + 1]] = order[row, at]
        self.keys = np.sort((np.arange(rows)[:, None] * len(names) + self.ids)[whole])
        self.names = len(names)
        self.inside = (table[:, : table.shape[1] - WORDS + 1] > 0) & (table[:, WORDS - 1:] > 0)
        self.sizes = self._different(whole)
        _, of = np.unique(group, return_inverse=True)
        self.possible = self.inside
        held = self._narrow(whole, of)
        self.central = np.where(whole, held[self.ids], 0).sum(axis=1)
        self.equal, self.links = self._equal_sets(np.where(whole, mix(names)[self.ids], np.uint64(0)))
        # Sets of fewer shingles than this are alike with equal ones only, and those are found.
        self.possible = self.possible & (self.sizes * (100 - PERCENT) >= PERCENT)
        self._narrow(whole, of)
        self.ids[~whole] = -1
        # Shingles that some other run of the group may still show to be common.
        self.open = self.shared & _spread(self.possible, _PER)
        # Only these paragraphs can be alike with any: the first of a run, and where they end.
        self.alikely = self.possible | self.equal
        self.begin = self.alikely.argmax(axis=1)
        self.end = np.where(self.alikely.any(axis=1), self.alikely.shape[1] - self.alikely[:, ::-1].argmax(axis=1), self.begin + 1)

    def _narrow(self, whole: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Leave the paragraphs that may be alike with one of another run; how many runs hold each shingle.

        Sets of a and b shingles are alike if 100 + PERCENT times the common ones are at least PERCENT times a + b, and b is no less
        than the smallest set of the group.  Paragraphs beyond hold too many shingles that no other
        run of the group has; without their runs, more do, and the smallest set may grow.
        """
        left = -1
        while left != (left := self.possible.sum()):
            new = whole & (self.earlier < 0) & self.possible.any(axis=1)[:, None]
            held = np.bincount(self.ids[new], minlength=self.names)
            self.shared = whole & (held[self.ids] > 1)
            places = whole.shape[1]
            smallest = np.full(of.max(initial=0) + 1, places)
            np.minimum.at(smallest, of, np.where(self.possible, self.sizes, places).min(axis=1))
            self.needed = (self.sizes + smallest[of][:, None]) * PERCENT
            self.possible = self.possible & (self._different(self.shared) * (100 + PERCENT) >= self.needed)
        return held

    def _equal_sets(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flags of the paragraphs whose set another run holds as a paragraph's set too, and links of such runs.

        A set goes by the sum of its shingles' hashes, and one run per set links to all others.
        """
        row, at = np.nonzero(self.possible)
        sums = np.zeros((weights.shape[0], weights.shape[1] + 1), np.uint64)
        np.cumsum(weights, axis=1, out=sums[:, 1:])
        total = sums[:, _PER:] - sums[:, :-_PER]
        again, begin, last, place = _again(self.earlier, self.earlier >= 0, total.shape[1])
        if len(again):
            less = np.zeros((total.shape[0], total.shape[1] + 1), np.uint64)
            np.add.at(less, (again, begin), weights[again, place])
            np.subtract.at(less, (again, last + 1), weights[again, place])
            total = total - np.cumsum(less, axis=1, dtype=np.uint64)[:, :-1]
        names = total[row, at]
        order = np.lexsort((row, names))
        names, rows = names[order], row[order]
        fresh = np.append(True, names[1:] != names[:-1]) if len(names) else np.zeros(0, bool)
        first = rows[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(names) else rows
        apart = rows != first
        links = np.unique(np.stack([first[apart], rows[apart]], axis=1), axis=0)
        several = np.bincount(np.cumsum(fresh) - 1, weights=apart, minlength=1)[np.cumsum(fresh) - 1] > 0 if len(names) else apart
        flags = np.zeros(self.possible.shape, bool)
        flags[row[order][several], at[order][several]] = True
        return flags, links

    def _different(self, flags: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """How many different flagged shingles each paragraph of some runs holds, if all places of a shingle are flagged."""
        counts = _sums(flags)
        earlier = self.earlier[rows]
        row, begin, last, _ = _again(earlier, flags & (earlier >= 0), counts.shape[1])
        if len(row):
            wide = counts.shape[1] + 1
            less = (np.bincount(row * wide + begin, minlength=len(counts) * wide)
                    - np.bincount(row * wide + last + 1, minlength=len(counts) * wide))
            counts -= np.cumsum(less.reshape(len(counts), wide), axis=1)[:, :-1].astype(np.int32)
        return counts

    def compare(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """For pairs of runs: flags of the paragraphs of the first and of the second that are alike with some paragraph
        of the other, flags of those alike with the one at the same place, and which shingles of either the other holds.

        Paragraphs are alike if the Jaccard similarity of their shingle sets suffices, wherever the shingles stand.
        Those not at the same place must share the first and last shingle of one of them: else what
        they have in common is a shorter passage at the end of a text.
        """
        aligned = (self.ids[a] == self.ids[b]) & (self.ids[a] >= 0)
        mine, other = self._elsewhere(a, b, aligned), self._elsewhere(b, a, aligned)
        moved = (mine | other | aligned & ((self.earlier[a] >= 0) | (self.earlier[b] >= 0))).any(axis=1)
        hits = aligned | mine, aligned | other
        # No more shingles can be common than are held by the other run.
        near = np.ones(len(a), bool)
        for rows, hit in zip((a, b), hits):
            near &= (self.alikely[rows] & (self._different(hit, rows) * 100 >= self.sizes[rows] * PERCENT)).any(axis=1)
        flags = np.zeros((3, len(a), self.inside.shape[1]), bool)
        plain = np.flatnonzero(near & ~moved)
        one, two = a[plain], b[plain]
        # Shingles that only stand at the same place make no other paragraphs alike.
        flags[:, plain] = self.inside[one] & self.inside[two] & _enough(_sums(aligned[plain]), self.sizes[one], self.sizes[two])
        mixed = np.flatnonzero(near & moved)
        low, high = np.minimum(self.begin[a], self.begin[b])[mixed], np.maximum(self.end[a], self.end[b])[mixed]
        mixed = mixed[np.lexsort((high, low))]
        for at in range(0, len(mixed), 128):
            some = mixed[at: at + 128]
            one, two = a[some], b[some]
            begin = min(self.begin[one].min(), self.begin[two].min())
            end = max(self.end[one].max(), self.end[two].max())
            flags[:, some, begin: end] = self._all_paragraphs(one, two, begin, end)
        return *flags, *hits

    def _elsewhere(self, rows: np.ndarray, others: np.ndarray, aligned: np.ndarray) -> np.ndarray:
        """Which shingles of some runs stand in others, but not at the same place."""
        found = self.shared[rows] & ~aligned
        pair, place = np.nonzero(found)
        sought = others[pair] * self.names + self.ids[rows[pair], place]
        at = np.minimum(np.searchsorted(self.keys, sought), len(self.keys) - 1)
        found[pair, place] = self.keys[at] == sought
        return found

    def _all_paragraphs(self, a: np.ndarray, b: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flags of the paragraphs from ``begin`` to ``end`` of both runs that are alike with any of the other's, and
        with the one at the same place.

        A shingle at place i of the first run and j of the second is common to a rectangle of paragraphs: those where it
        does not stand before.  Sums of rectangles, pairs of runs innermost, give what each two paragraphs have in common.
        """
        windows, places, n = end - begin, end - begin + _PER - 1, len(a)
        ids, others = (self.ids[r, begin: begin + places] for r in (a, b))
        at = np.flatnonzero(ids[:, :, None] == np.where(others < 0, -2, others)[:, None, :]).astype(np.int32)
        pair_i, j = np.divmod(at, np.int32(places))
        pair, i = np.divmod(pair_i, np.int32(places))
        x, y = np.maximum(i - _PER + 1, 0), np.maximum(j - _PER + 1, 0)
        last_x, last_y = np.minimum(i, windows - 1) + 1, np.minimum(j, windows - 1) + 1
        # held[i, y]: paragraph y of the second run holds shingle i of the first; holds[j, x]: the other way round.
        held = _steps((places, windows + 1, n), (i, y, pair), (i, last_y, pair)) > 0
        holds = _steps((places, windows + 1, n), (j, x, pair), (j, last_x, pair)) > 0
        # A shingle counts only where its paragraph does not hold it before.
        before, other = (self.earlier[r, begin: begin + places].ravel() for r in (a, b))
        if max(before.max(), other.max()) >= begin:
            x, y = np.maximum(x, before[pair_i] + 1 - begin), np.maximum(y, other[pair * np.int32(places) + j] + 1 - begin)
        fit = (x < last_x) & (y < last_y)
        pair, x, y, last_x, last_y = pair[fit], x[fit], y[fit], last_x[fit], last_y[fit]
        common = _steps((windows + 1, windows + 1, n), (np.append(x, last_x), np.append(y, last_y), np.append(pair, pair)),
                        (np.append(x, last_x), np.append(last_y, y), np.append(pair, pair)))
        for step in range(1, windows):
            common[step] += common[step - 1]
        common = common[:windows, :windows].astype(np.int16)
        # Paragraphs that leave the run count as too large for any.
        sizes = [np.where(self.inside[r, begin: end], self.sizes[r, begin: end], 2 * _PER).astype(np.int16).T * np.int16(PERCENT) for r in (a, b)]
        common *= np.int16(100 + PERCENT)
        alike = common >= sizes[0][:, None] + sizes[1][None]
        ends = held[:windows, :windows] & held[_PER - 1: _PER - 1 + windows, :windows]
        ends |= (holds[:windows, :windows] & holds[_PER - 1: _PER - 1 + windows, :windows]).transpose(1, 0, 2)
        same = np.arange(windows)
        ends[same, same] = True
        alike &= ends
        return alike.any(axis=1).T, alike.any(axis=0).T, alike[same, same].T


def _steps(shape: tuple[int, int, int], begin: tuple[np.ndarray, ...], end: tuple[np.ndarray, ...]) -> np.ndarray:
    """Sums along the middle axis of 1 at some places and -1 at others; no sum may leave 8 bits in the end."""
    table = np.zeros(shape, np.int8)
    flat = table.reshape(-1)
    for (one, two, three), add in ((begin, np.add), (end, np.subtract)):
        add.at(flat, (one * np.int32(shape[1]) + two) * np.int32(shape[2]) + three, np.int8(1))
    for step in range(1, shape[1]):
        table[:, step] += table[:, step - 1]
    return table


def _again(earlier: np.ndarray, flags: np.ndarray, windows: int) -> tuple[np.ndarray, ...]:
    """For flagged shingles that a run holds before: row, first and last paragraph that holds both, and place."""
    row, place = np.nonzero(flags)
    begin, last = np.maximum(place - _PER + 1, 0), np.minimum(earlier[row, place], windows - 1)
    fit = begin <= last
    return row[fit], begin[fit], last[fit], place[fit]


def _enough(common: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return common * 100 >= (one + two - common) * PERCENT


def _sums(flags: np.ndarray) -> np.ndarray:
    """Flags within every paragraph of each row."""
    sums = np.zeros(flags.size + 1, np.int32)
    np.cumsum(flags.ravel(), out=sums[1:])
    return sums[1:].reshape(flags.shape)[:, _PER - 1:] - sums[:-1].reshape(flags.shape)[:, : flags.shape[1] - _PER + 1]


def common_words(one: np.ndarray, two: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Which words of the first row go with its alike paragraphs: those equal to the aligned word of the second,
    and up to ``SHINGLE`` replaced ones between two such; so words that merely border on a passage stay."""
    return _bridged(_spread(flags, WORDS) & (one == two) & (one > 0))


def _spread(flags: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in flagged stretches of ``length`` words."""
    covered = np.zeros((len(flags), flags.shape[1] + length - 1), bool)
    covered[:, : flags.shape[1]] = flags
    span = 1
    while span < length:
        step = min(span, length - span)
        covered[:, step:] |= covered[:, :-step].copy()
        span += step
    return covered


def _bridged(equal: np.ndarray) -> np.ndarray:
    """Marked words, and up to ``SHINGLE`` between two of them."""
    marked = equal.copy()
    width = equal.shape[1]
    for gap in range(2, SHINGLE + 2):
        both = equal[:, : width - gap] & equal[:, gap:]
        for inside in range(1, gap):
            marked[:, inside: width - gap + inside] |= both
    return marked


def _compared(runs: Runs, table: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of alike paragraphs, and links of runs, as all pairs of runs of one group give them.

    Groups of up to ``SMALL`` runs compare all pairs.  In larger ones one run after the other, the most central first, meets
    the later ones, except those already connected with it where neither holds a shingle of the other that is still open.
    """
    extra = np.zeros(table.shape, bool)
    # Paragraphs with equal sets are settled by name.
    settled = _spread(runs.equal, _PER)[:, : runs.open.shape[1]]
    marked, links = _spread(settled, SHINGLE), [runs.links]
    runs.open &= ~settled
    joined = _roots(len(table), runs.links)

    def compare(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        linked = np.zeros(len(one), bool)
        for begin in range(0, len(one), 512):
            a, b = one[begin: begin + 512], two[begin: begin + 512]
            mine, other, same, *hits = runs.compare(a, b)
            linked[begin: begin + 512] = fit = mine.any(axis=1)
            a, b, same = a[fit], b[fit], same[fit]
            for rows, others, flags, hit in ((a, b, mine[fit], hits[0][fit]), (b, a, other[fit], hits[1][fit])):
                common = hit & _spread(flags, _PER)
                for whole, found, value in ((runs.open, common, False), (marked, _spread(common, SHINGLE), True),
                                            (extra, common_words(table[rows], table[others], same), True)):
                    row, at = np.nonzero(found)
                    whole[rows[row], at] = value
            links.append(np.stack([a, b], axis=1))
        return linked

    left = np.flatnonzero(runs.possible.any(axis=1))
    left = left[np.lexsort((-runs.central[left], group[left]))]
    first = np.flatnonzero(np.diff(group[left], prepend=group[left][:1] - 1)) if len(left) else left
    sizes = np.diff(np.append(first, len(left)))
    small = np.repeat(sizes <= SMALL, sizes)
    pairs = [(left[:-step][fit], left[step:][fit]) for step in range(1, SMALL)
             for fit in [(group[left[:-step]] == group[left[step:]]) & small[:-step]]]
    compare(*(np.concatenate(side) for side in zip(*pairs)))
    # The fewest shingles that a possible paragraph of the run must share.
    least = np.where(runs.possible, runs.needed, 2 * _PER * PERCENT).min(axis=1)
    sets = np.zeros((2, runs.names + 1), bool)
    asked = [(turn, next(turn, None)) for begin, size in zip(first[sizes > SMALL], sizes[sizes > SMALL])
             for turn in [_turns(runs, left[begin: begin + size], joined, least, sets)]]
    # The large groups take their turns together, so that many pairs are compared at a time.
    while asked := [(turn, pair) for turn, pair in asked if pair is not None]:
        linked = compare(*(np.concatenate(side) for side in zip(*(pair for _, pair in asked))))
        parts = np.split(linked, np.cumsum([len(one) for _, (one, _) in asked])[:-1])
        asked = [(turn, _answer(turn, part)) for (turn, _), part in zip(asked, parts)]
    return _bridged(marked) | extra, np.concatenate(links)


def _answer(turn: Generator, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    try:
        return turn.send(linked)
    except StopIteration:
        return None


def _turns(runs: Runs, rows: np.ndarray, joined: np.ndarray, least: np.ndarray, sets: np.ndarray) -> Generator:
    """Pairs of a group's runs to compare, turn by turn; gets back which of them are linked.

    A run only meets those that hold one of its rarest shingles: so many of these that a run without them holds too few of the rest.
    """
    size, (held, sought) = len(rows), sets
    comp, ids, once, least = joined[rows], runs.ids[rows], runs.earlier[rows] < 0, least[rows]
    owner, place = np.nonzero(runs.shared[rows] & once)
    name = ids[owner, place]
    order = np.argsort(name, kind="stable")
    names, first, times = np.unique(name[order], return_index=True, return_counts=True)
    holders, name = owner[order], np.searchsorted(names, name)
    own = np.searchsorted(owner, np.arange(size + 1))
    wanting = runs.open[rows].any(axis=1)
    at, hubs = 0, 1
    # The first hub settles most groups; if not, several hubs take their turn together.
    while at < size - 1 and (wanting.any() or (comp != comp[0]).any()):
        pairs = []
        for hub in range(at, min(at + hubs, size - 1)):
            later = np.ones(size, bool) if wanting[hub] else wanting | (comp != comp[hub])
            later[: hub + 1] = False
            if not later.any():
                continue
            mine = name[own[hub]: own[hub + 1]]
            rarest = np.argsort(times[mine])[: max(len(mine) - -(-least[hub] // (100 + PERCENT)) + 1, 0)]
            met = np.zeros(size, bool)
            for one in mine[rarest]:
                met[holders[first[one]: first[one] + times[one]]] = True
            met = np.flatnonzero(met & later)
            if len(met) == 0:
                continue
            mine = ids[hub]
            held[mine] = True
            held[-1] = False
            others = ids[met]
            common = held[others]
            useful = (comp[met] != comp[hub]) | (common & runs.open[rows[met]]).any(axis=1)
            if wanting[hub]:
                still = mine[runs.open[rows[hub]]]
                sought[still] = True
                useful |= sought[others].any(axis=1)
                sought[still] = False
            useful &= (common & once[met]).sum(axis=1) * (100 + PERCENT) >= np.maximum(least[met], least[hub])
            held[mine] = False
            pairs.append((np.full(useful.sum(), hub), met[useful]))
        at, hubs = at + hubs, max(1, min(2 * hubs, 4096 // size))
        if sum(len(two) for _, two in pairs):
            one, two = (np.concatenate(side) for side in zip(*pairs))
            linked = yield rows[one], rows[two]
            for hub in np.unique(one[linked]):
                comp[np.isin(comp, comp[two[linked & (one == hub)]])] = comp[hub]
            met = np.unique(np.append(one, two))
            wanting[met] = runs.open[rows[met]].any(axis=1)


def _roots(n: int, links: np.ndarray) -> np.ndarray:
    """The smallest row that each row is linked with, over any number of links."""
    root = np.arange(n)
    while len(links):
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        new = root.copy()
        np.minimum.at(new, links[:, 0], low)
        np.minimum.at(new, links[:, 1], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _verified(rows: pd.DataFrame) -> pd.DataFrame:
    """Words of alike paragraphs (``s, x, y``: from, up to) of a shard's runs, and for all but one of the runs
    that are linked over any number of others, the one that is left (``s, other``)."""
    # In an order that does not depend on how the rows came, so that reruns agree.
    rows = rows.drop_duplicates(["k", "s"]).sort_values(["k", "s"])
    group, names, sizes = (rows[c].to_numpy(np.int64) for c in ("k", "s", "u"))
    start = _LEFT - (rows["at"].to_numpy(np.int64) & 255)
    table = np.zeros((len(rows), _LEFT + _RIGHT), np.uint32)
    words = rows["words"].tolist()
    lengths = np.array([len(w) // 4 for w in words], np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    table[row, np.arange(len(row)) + (start - np.cumsum(lengths) + lengths)[row]] = np.frombuffer(b"".join(words), np.uint32)
    marked, links = _compared(Runs(table, group), table, group)
    root = _roots(len(rows), links)
    apart = np.flatnonzero(root != np.arange(len(rows)))
    edges = np.diff(marked.astype(np.int8), axis=1, prepend=np.int8(0), append=np.int8(0))
    (row, begin), (_, end) = np.nonzero(edges > 0), np.nonzero(edges < 0)
    of, none = np.concatenate([apart, row]), np.ones(len(apart), bool)
    out = {"s": names[of], "u": sizes[of], "other": names[root[of]], "x": np.append(apart, begin) - start[of], "y": np.append(apart, end) - start[of]}
    out = pd.DataFrame(out)
    marks = np.append(~none, np.ones(len(row), bool))
    for column, kind, missing in (("other", "Int64", marks), ("x", "Int32", ~marks), ("y", "Int32", ~marks)):
        out[column] = out[column].astype(kind).mask(missing)
    return out


def clusters(keyed: DataFrame, group: int = GROUP) -> DataFrame:
    """``d, h, begin, end, keep, keeper``: word spans of clustered paragraphs in every text that holds some.

    ``keyed`` has ``d`` (id), ``h`` (hash of the text) and ``text``; ``keeper`` is the id that keeps the cluster.
    """
    # Written once: hashing the words costs more than reading the runs again.
    runs = checkpointed(_runs(keyed), "hashed")
    # Lists of keys are written before they are joined: a join straight on an aggregate cannot split a hot key.
    keys = checkpointed(runs.groupBy("k").agg(F.count("*").alias("c")).filter("c > 1").select("k"), "keys")
    shared = checkpointed(runs.join(keys.hint("shuffle_hash"), "k"), "runs")
    place = F.struct(F.col("d").isNull().alias("none"), "d", "h", "at")
    nodes = checkpointed(shared.groupBy("k", "s").agg(F.count("*").alias("n"), F.min(place).alias("first")), "nodes")
    groups = checkpointed(nodes.groupBy("k").agg(F.count("*").alias("u")).filter("u > 1"), "groups")
    lists = checkpointed(
        nodes.join(groups, "k").groupBy(F.col("first.d").alias("d"), F.col("first.h").alias("h"))
        .agg(F.collect_list(F.struct("k", "s", "u", F.col("first.at").alias("at"))).alias("list")), "wanted")
    contexts = checkpointed(join_documents(keyed, lists, "inner", 40, 4 << 20).select("d", "h", "text", "list")
                            .mapInArrow(_contexts, _CONTEXTS), "contexts")
    small = F.pmod(F.xxhash64("k"), F.lit(parts_for(contexts.count(), SHARD)))
    # A group too large for one shard goes there by pairs of blocks, which hold ``group`` runs together.
    blocks = F.ceil(F.col("u") * 2 / group)
    block = F.pmod(F.xxhash64("s"), blocks)
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), blocks - 1), lambda other: other != block)
    pairs = F.transform(others, lambda other: F.xxhash64("k", F.least(block, other), F.greatest(block, other)))
    shards = F.explode(F.when(F.col("u") <= group, F.array(small)).otherwise(pairs))
    found = checkpointed(contexts.withColumn("shard", shards).groupBy("shard").applyInPandas(_verified, _FOUND), "found")
    # Links stay within a group, so only those of groups that were dealt over blocks go on from shard to shard.
    inside = F.when(F.col("u") <= group, F.col("other"))
    marks = found.groupBy("s").agg(F.min(inside).alias("root"), F.collect_set(F.when(F.col("x").isNotNull(), F.struct("x", "y"))).alias("marks"))
    if not groups.filter(F.col("u") > group).isEmpty():
        linked = components(found.filter((F.col("u") > group) & F.col("other").isNotNull()).select(F.col("s").alias("a"), F.col("other").alias("b")))
        marks = (marks.join(linked.select(F.col("node").alias("s"), F.col("root").alias("over")), "s", "left")
                 .select("s", F.coalesce("over", "root").alias("root"), "marks"))
    windows = F.shiftright("first.at", 8).bitwiseAND(F.lit(255)).cast("int")
    whole = F.when(F.col("n") > 1, F.array(F.struct(F.lit(0).alias("x"), (windows + (WORDS - 1)).alias("y"))))
    clustered = (
        nodes.join(marks, "s", "left").withColumn("marks", F.coalesce(whole, "marks")).filter("size(marks) > 0")
        .withColumn("root", F.coalesce("root", "s")))
    clustered = checkpointed(clustered.select("k", "s", "first", "marks", "root"), "clustered")
    kept = clustered.groupBy("root").agg(F.min("first").alias("kept"))
    table = clustered.join(kept, "root").select("k", "s", "marks", "kept")
    lo = F.shiftright("at", 16)
    return (
        shared.join(table, ["k", "s"])
        .select("d", "h", lo.alias("lo"), F.coalesce(place == F.col("kept"), F.lit(False)).alias("keep"),
                F.col("kept.d").alias("keeper"), F.explode("marks").alias("m"))
        .select("d", "h", (F.col("lo") + F.col("m.x")).alias("begin"), (F.col("lo") + F.col("m.y")).alias("end"),
                "keep", "keeper"))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans to remove per text: the union of what goes without the union of what stays, and the keeper of each."""
    for batch in batches:
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        spans = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        text = np.repeat(np.arange(len(lists)), np.diff(offsets))
        begin, end, keep = (spans.field(c).to_numpy(zero_copy_only=False) for c in ("begin", "end", "keep"))
        keeper = spans.field("keeper").fill_null(_NOBODY).to_numpy()
        # All texts one behind the other, each with a word more than its spans.
        words = np.zeros(len(lists), np.int64)
        np.maximum.at(words, text, end.astype(np.int64) + 1)
        base = np.cumsum(words) - words
        begin, end = base[text] + begin, base[text] + end
        gone, kept = (_covered(begin[some], end[some], int(words.sum())) for some in (~keep, keep))
        edges = np.diff((gone & ~kept).astype(np.int8), prepend=np.int8(0), append=np.int8(0))
        first, last = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        # The spans that go, each with the runs of words it has a part in.
        begin, end, keeper = begin[~keep], end[~keep], keeper[~keep]
        low, high = np.searchsorted(last, begin, side="right"), np.searchsorted(first, end)
        times = np.maximum(high - low, 0)
        each = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        least = np.full(len(first), _NOBODY)
        np.minimum.at(least, each, np.repeat(keeper, times))
        of = np.searchsorted(base, first, side="right") - 1
        flat = np.stack([first - base[of], last - base[of], least], axis=1).ravel()
        upto = 3 * np.searchsorted(of, np.arange(len(lists) + 1))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat))],
                              names=["d", "h", "list"])


def _covered(begin: np.ndarray, end: np.ndarray, words: int) -> np.ndarray:
    """Which words lie in some span."""
    steps = np.bincount(begin, minlength=words + 1) - np.bincount(end, minlength=words + 1)
    return np.cumsum(steps)[:words] > 0


def _removals(docs: DataFrame, doc_id: str, text: str, group: int) -> DataFrame:
    """``d, h, list``: begin, end (in words) and keeper of each span that goes, per text."""
    spans = clusters(_keyed(docs, doc_id, text), group).groupBy("d", "h").agg(
        F.collect_set(F.struct("begin", "end", "keep", "keeper")).alias("list"))
    settled = spans.mapInArrow(_settle, "d bigint, h bigint, list array<bigint>")
    return checkpointed(settled.filter(F.size("list") > 0), "removals")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("d"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))


def _spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed spans with their text, whole words from the first to the last."""
    for batch in batches:
        texts = filled(batch, "text")
        ids, lists = batch.column(0).to_pylist(), batch.column(batch.schema.get_field_index("list")).to_pylist()
        rows: list[tuple] = []
        for low, high in text_slices(texts, HASHED_BYTES):
            data, offsets = text_bytes(texts.slice(low, high - low))
            begin, end, text = word_ranges(data, offsets)
            places, data = np.searchsorted(text, np.arange(high - low)), data.tobytes()
            for i in range(low, high):
                triples, at = zip(lists[i][::3], lists[i][1::3], lists[i][2::3]), int(places[i - low])
                for number, (b, e, keeper) in enumerate(triples):
                    passage = data[int(begin[at + b]): int(end[at + e - 1])].decode("utf-8", "replace")
                    rows.append((ids[i], number, b, e - b, keeper if keeper < _NOBODY else None, passage))
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                              names=["doc_id", "span", "first_word", "n_words", "kept_in", "passage"])


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """``doc_id, span, first_word, n_words, kept_in, passage``: every maximal run of words that goes, with its text.

    ``kept_in`` is the smallest id that keeps a copy (null if only rows without id do).  Texts that
    repeat nothing have no row.  Texts of fewer than 50 words, null and empty ones, hold no paragraph.  Of rows alike in
    id and text, which cannot be told apart, all stay whole unless another row comes first; null ids come last.
    Other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    removals = _removals(docs, doc_id, text, group)
    return join_documents(_keyed(docs, doc_id, text), removals, "inner", 8).mapInArrow(
        _spans_of, "doc_id bigint, span int, first_word bigint, n_words bigint, kept_in bigint, passage string")


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; all rows and other columns stay.

    What is left keeps its own white space.  A text that changes nothing stays as it is, null included.
    """
    removals = _removals(docs, doc_id, text, group)
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    at_text = names.index(text)
    keyed = docs.select(row.alias("row"), F.col(doc_id).cast("bigint").alias("d"), F.xxhash64(F.col(text)).alias("h"))
    joined = join_documents(keyed, removals, "left", 8)
    schema = "row " + docs.select(row.alias("r")).schema["r"].dataType.simpleString() + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            texts = rows.flatten()[at_text]
            lists = batch.column(1).to_pylist()
            out = []
            for i, spans in enumerate(lists):
                if not spans:
                    out.append(texts[i].as_py())
                    continue
                one = texts.slice(i, 1)
                data = text_bytes(one)[0].tobytes()
                _, begin, _, _ = _words(one)
                starts = [*begin.tolist(), len(data)]
                parts, at = [], 0
                for b, e in zip(spans[::3], spans[1::3]):
                    parts.append(data[at: starts[b]])
                    at = starts[e]
                out.append(b"".join([*parts, data[at:]]).decode("utf-8", "replace"))
            yield pa.record_batch([rows, pa.array(out, pa.string())], names=["row", "text"])

    cut = joined.select("row", "list").mapInArrow(run, schema)
    return cut.select(*[(F.col("text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in names])
