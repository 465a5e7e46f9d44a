"""Passages of benchmark items in documents, by q-gram counts in diagonal bands and banded alignment."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F, types as T

from .batches import fresh, pieces, texts
from .files import pack, share, unpack

# The code points of white space.
_BLANK = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_IS_BLANK = np.zeros(0x3002, bool)
_IS_BLANK[_BLANK] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Limits:
    """What counts as a leak.

    A passage of at least ``least`` characters of an item (or all of a shorter
    item), within ``error`` edits per character, is found for certain.  Items
    of fewer than ``fuzzy`` characters are found where they stand verbatim as
    whole words; those of fewer than ``shortest`` cannot be told from chance
    and are not searched for, unless it is set lower.  ``q`` is the length of
    the grams; an item's passage of length n with e edits shares at least
    n - q + 1 - q * e of them.  ``q2`` is that of a second, stricter count.
    """

    q: int = 10
    error: float = 0.08
    least: int = 100
    fuzzy: int = 40
    shortest: int = 10
    q2: int = 4

    def edits(self, length):
        return np.floor(np.asarray(length) * self.error).astype(np.int64)

    def shared(self, length, q: int | None = None):
        q = q or self.q
        return np.maximum(1, np.asarray(length) - q + 1 - q * self.edits(length))


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with single blanks, and where each one lies in ``text``."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = _IS_BLANK[np.minimum(points, len(_IS_BLANK) - 1)]
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    place = np.flatnonzero(keep)
    return np.where(blank[place], 32, points[place]).astype(np.int32), place


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each run of q code points, by doubling."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    power = {1: (points.astype(np.uint64) + np.uint64(1)) * _MIX}
    size = 1
    while 2 * size <= q:
        one = power[size]
        mixed = (one ^ (one >> np.uint64(29))) * _MIX
        power[2 * size] = mixed[: len(one) - size] * np.uint64(31) + one[size:]
        size *= 2
    out, done = None, 0
    for size in sorted(power, reverse=True):
        if q - done >= size:
            part = power[size][done : done + len(points) - q + 1]
            out = part.copy() if out is None else (out ^ (out >> np.uint64(31))) * _MIX + part
            done += size
    return out


def _trimmed(points: np.ndarray) -> np.ndarray:
    """Without the blank at either end."""
    word = np.flatnonzero(points != 32)
    return points[word[0] : word[-1] + 1] if len(word) else points[:0]


class ItemIndex:
    """All q-grams of a block of items, and the first gram of each short one.  A null id is kept as such."""

    def __init__(self, items: Sequence[tuple[int | None, str]], limits: Limits):
        normals = [(i, normal(t)[0]) for i, t in items]
        short = [(i, _trimmed(p)) for i, p in normals if len(p) < max(limits.fuzzy, limits.q)]
        short = [(i, p) for i, p in short if len(p) >= max(1, limits.shortest)]
        normals = [(i, p) for i, p in normals if len(p) >= max(limits.fuzzy, limits.q)]
        self.ids = np.array([i or 0 for i, _ in normals + short], np.int64)
        self.named = np.array([i is not None for i, _ in normals + short], bool)
        lengths = np.array([len(p) for _, p in normals + short], np.int64)
        self.points = np.concatenate([np.zeros(0, np.int32), *[p for _, p in normals + short]])
        self.ends = np.cumsum(lengths)
        self.long = np.array([len(normals)])
        hashes = [gram_hashes(p, limits.q) for _, p in normals]
        counts = np.array([len(h) for h in hashes], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(flat, kind="stable")
        self.grams = flat[order]
        self.item = np.repeat(np.arange(len(normals)), counts)[order].astype(np.int32)
        self.place = np.concatenate([np.zeros(0, np.int64), *[np.arange(c) for c in counts]])[order].astype(np.int32)
        # A short item is looked up by its first gram, one shorter than a gram by all of it.
        self.head_length = np.array([min(len(p), limits.q) for _, p in short], np.int32)
        self.heads = np.array([gram_hashes(p, min(len(p), limits.q))[0] for _, p in short], np.uint64)
        self.bits = max(16, int(len(flat)).bit_length() + 4)
        self.seen = np.zeros(1 << self.bits, np.uint8)
        whole = np.concatenate([self.grams, self.heads[self.head_length == limits.q]])
        self.seen[(whole >> np.uint64(64 - self.bits)).astype(np.int64)] = 1

    FIELDS = ("ids", "named", "points", "ends", "long", "grams", "item", "place", "head_length", "heads", "seen")

    def packed(self) -> tuple[bytes, list[tuple]]:
        return pack({name: getattr(self, name) for name in self.FIELDS})

    @classmethod
    def mapped(cls, path: str, layout: list[tuple], bits: int) -> "ItemIndex":
        index = cls.__new__(cls)
        index.bits = bits
        for name, array in unpack(path, layout).items():
            setattr(index, name, array)
        return index


class Searcher:
    """Searches texts for the items of one block."""

    MOST_HITS = 4_000_000

    def __init__(self, index: ItemIndex, limits: Limits):
        self.index, self.limits = index, limits
        every = np.diff(np.append(0, index.ends))
        self.lengths, self.short = every[: int(index.long[0])], every[int(index.long[0]) :]
        self.certain = np.minimum(self.lengths, limits.least)
        self.need = limits.shared(self.certain)
        # Bands are two strips wide and a strip is wider than the edits of the whole item.
        self.strip = 1 << np.ceil(np.log2(limits.edits(self.lengths) + 1)).astype(np.int64)

    def search(self, text: str) -> list[tuple]:
        """(item id, start, end, item start, item end, edits), the best passage for each item.

        The longest and closest passage counts, of equals that of the first band.
        """
        points, origin = normal(text)
        hashes = gram_hashes(points, self.limits.q)
        at = np.flatnonzero(self.index.seen[(hashes >> np.uint64(64 - self.index.bits)).astype(np.int64)])
        best: dict[int, tuple] = {}
        for found in self._verbatim(points, hashes, at):
            best.setdefault(found[0], found)
        if len(at) >= self.need.min(initial=1 << 60):
            low = np.searchsorted(self.index.grams, hashes[at], "left")
            high = np.searchsorted(self.index.grams, hashes[at], "right")
            at, low, count = at[high > low], low[high > low], (high - low)[high > low]
            grams = gram_hashes(points, self.limits.q2) if len(at) else None
            for a, b in self._windows(at, count):
                self._regions(points, grams, at[a:b], low[a:b], count[a:b], best)
        out = []
        for item in sorted(best):
            _, start, end, first, last, edits = best[item]
            name = int(self.index.ids[item]) if self.index.named[item] else None
            out.append((name, int(origin[start]), int(origin[end - 1]) + 1, first, last, edits))
        return out

    def _verbatim(self, points: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
        """The first place of every short item that stands in the text as whole words."""
        index, q = self.index, self.limits.q
        first = len(self.lengths)
        for size in np.unique(index.head_length).tolist():
            own = np.flatnonzero(index.head_length == size)
            made, places = (hashes, at) if size == q else (gram_hashes(points, size), None)
            known = np.sort(index.heads[own])
            places = np.arange(len(made)) if places is None else places
            near = np.minimum(np.searchsorted(known, made[places]), len(known) - 1)
            places = places[known[near] == made[places]]
            if not len(places):
                continue
            # A short item begins and ends with a word, so both ends must be the ends of words.
            by_hash: dict[int, list[int]] = {}
            for i in own.tolist():
                by_hash.setdefault(int(index.heads[i]), []).append(i)
            open_ = set(own.tolist())
            for place in places.tolist():
                if not open_:
                    break
                if place and chr(points[place - 1]).isalnum() and chr(points[place]).isalnum():
                    continue
                for i in by_hash[int(made[place])]:
                    length = int(self.short[i])
                    end = place + length
                    if i not in open_ or end > len(points):
                        continue
                    begin = int(index.ends[first + i]) - length
                    if not np.array_equal(points[place:end], index.points[begin : begin + length]):
                        continue
                    if end < len(points) and chr(points[end]).isalnum() and chr(points[end - 1]).isalnum():
                        continue
                    open_.discard(i)
                    yield first + i, place, end, 0, length, 0

    def _windows(self, at: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of hits; where a text has very many, overlapping by more than an item is long."""
        total = np.cumsum(count)
        start, reach = 0, int(self.lengths.max(initial=0) + 4 * self.strip.max(initial=1))
        while start < len(at):
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + self.MOST_HITS, "right")))
            if stop < len(at):
                stop = max(stop, int(np.searchsorted(at, at[start] + 2 * reach)))
            yield start, stop
            if stop >= len(at):
                return
            # No passage crosses a pause longer than an item; else the next run begins behind this one's beginning.
            apart = at[stop] - at[stop - 1] > reach
            start = stop if apart else max(start + 1, int(np.searchsorted(at, at[stop - 1] - reach)))

    def _regions(self, points: np.ndarray, grams: np.ndarray, at: np.ndarray, low: np.ndarray, count: np.ndarray, best: dict) -> None:
        """Enter into ``best`` the passages among the hits of a run.

        A band that shares enough q-grams with its item is counted again by the
        shorter grams, which few unrelated bands meet: first all neighbouring
        bands of an item as one, then each.  Only what is left is aligned, the
        band with the longest reach of hits first, and no band is that cannot
        hold a longer passage than the one found.
        """
        # A run of equal grams in the text meets a place of an item on neighbouring diagonals: one entry for each strip.
        head = np.append(0, np.flatnonzero((np.diff(at) != 1) | (np.diff(low) != 0)) + 1)
        tail = at[np.append(head[1:], len(at)) - 1]
        at, low, count = at[head], low[head], count[head]
        which = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        item = self.index.item[which].astype(np.int64)
        enough = np.bincount(item, np.repeat(tail - at + 1, count), len(self.lengths)) >= self.need
        use = enough[item]
        if not use.any():
            return
        item, place = item[use], self.index.place[which][use].astype(np.int64)
        wide = self.strip[item]
        lowest = (np.repeat(at, count)[use] - place) // wide
        # Each hit lies in two bands, the one that begins with its strip and the one before.
        bands = (np.repeat(tail, count)[use] - place) // wide - lowest + 2
        step = np.arange(int(bands.sum())) - np.repeat(np.cumsum(bands) - bands, bands)
        item, place, band = np.repeat(item, bands), np.repeat(place, bands), np.repeat(lowest - 1, bands) + step
        order = np.lexsort((place, band, item))
        item, place, band = item[order], place[order], band[order]
        # Several hits of one place are one: of a repeated gram no more count than the item has.
        twice = np.append(False, (item[1:] == item[:-1]) & (band[1:] == band[:-1]) & (place[1:] == place[:-1]))
        item, place, band = item[~twice], place[~twice], band[~twice]
        new = np.append(True, (item[1:] != item[:-1]) | (band[1:] != band[:-1]))
        starts = np.append(np.flatnonzero(new), len(item))
        sizes = np.diff(starts)
        chosen = np.flatnonzero(sizes >= self.need[item[starts[:-1]]])
        if not len(chosen):
            return
        begins, stops = starts[chosen], starts[chosen + 1]
        of, number = item[begins], band[begins]
        reach = np.maximum(self.certain[of], place[stops - 1] - place[begins] + self.limits.q)
        run = np.cumsum(np.append(True, (of[1:] != of[:-1]) | (number[1:] != number[:-1] + 1))) - 1
        firsts = np.append(np.flatnonzero(np.append(True, run[1:] != run[:-1])), len(run))
        alive = np.ones(len(chosen), bool)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            i, lowest_, highest = int(of[a]), int(number[a]), int(number[b - 1]) + 2
            alive[a:b] = len(self._possible(grams, i, lowest_, highest)) > 0
            if alive[a]:  # a verbatim copy of all that is hit needs no alignment
                first = int(min(place[begins[a:b]]))
                last = int(max(place[stops[a:b] - 1])) + self.limits.q
                copy = self._copy(points, i, first, last, lowest_, highest) if last - first >= self.certain[i] else None
                held = best.get(i)
                if copy is not None and (held is None or held[4] - held[3] - 10 * held[5] < last - first):
                    best[i] = copy
        ranked = np.flatnonzero(alive)
        for k in ranked[np.lexsort((number[ranked], -reach[ranked], of[ranked]))].tolist():
            i, b = int(of[k]), int(number[k])
            held = best.get(i)
            if held is not None and int(reach[k]) <= held[4] - held[3] - 10 * held[5]:
                continue
            for found in self._band(points, grams, i, b, place[begins[k] : stops[k]]):
                if held is None or held[4] - held[3] - 10 * held[5] < found[4] - found[3] - 10 * found[5]:
                    held = best[i] = found

    def _possible(self, grams: np.ndarray, item: int, low: int, high: int) -> np.ndarray:
        """Where windows of the item's certain length may begin that have a passage on strips ``low`` to ``high``.

        Such a passage shares enough of the shorter grams, each on a diagonal that the edits keep in the band.
        """
        q2 = self.limits.q2
        length, size, strip = int(self.lengths[item]), int(self.certain[item]), int(self.strip[item])
        need = int(self.limits.shared(size, q2))
        begin = int(self.index.ends[item]) - length
        own = gram_hashes(self.index.points[begin : begin + length], q2)
        edits = int(self.limits.edits(size))
        left, width = low * strip - edits, (high - low) * strip + 2 * edits
        if len(own) * width <= 1 << 18:
            padded = np.zeros(len(own) + width, np.uint64)
            part = grams[max(0, left) : max(0, left + len(padded))]
            padded[max(0, -left) : max(0, -left) + len(part)] = part
            shared = (np.lib.stride_tricks.sliding_window_view(padded, width)[: len(own)] == own[:, None]).any(1)
        else:  # many bands at once: anywhere on them
            shared = np.isin(own, grams[max(0, left) : max(0, left + len(own) + width)])
        sums = np.append(0, np.cumsum(shared))
        span = size - q2 + 1
        return np.flatnonzero(sums[span:] - sums[: len(sums) - span] >= need)

    def _band(self, points: np.ndarray, grams: np.ndarray, item: int, band: int, place: np.ndarray) -> Iterator[tuple]:
        """Passages of one item in one band that meet both counts and then the alignment."""
        size, need, q = int(self.certain[item]), int(self.need[item]), self.limits.q
        inside = np.searchsorted(place, place + size - q, "right") - np.arange(len(place))
        dense = np.flatnonzero(inside >= need)
        if not len(dense):
            return
        possible = self._possible(grams, item, band, band + 2)
        if not len(possible):
            return
        length = int(self.lengths[item])
        spans: list[list[int]] = []
        for d in dense.tolist():
            first, last = int(place[d]), int(place[d + inside[d] - 1]) + q
            if last - first < size:  # the window of the lemma, not only its hits
                first = max(0, min(first, length - size))
                last = max(last, min(length, first + size))
            if spans and first <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], last)
            else:
                spans.append([first, last])
        for first, last in spans:
            if (found := self._align(points, item, band, first, last)) is not None:
                yield found
                continue
            some = dense[(place[dense] >= first) & (place[dense] < last)]
            # Windows that hold the hits from d on begin in [low, high]; a place may lie in many of these ranges.
            low = np.maximum(0, place[some + inside[some] - 1] + q - size)
            high = np.minimum(length - size, place[some])
            covered = np.zeros(length - size + 2, np.int64)
            fits = low <= high
            np.add.at(covered, low[fits], 1)
            np.add.at(covered, high[fits] + 1, -1)
            starts = possible[np.cumsum(covered)[possible] > 0]
            if len(starts):
                yield from self._any_window(points, item, band, starts.tolist(), size)

    def _any_window(self, points: np.ndarray, item: int, band: int, starts: list[int], size: int) -> Iterator[tuple]:
        """The window of the certain length with the fewest edits, if these are few enough."""
        begin = int(self.index.ends[item] - self.lengths[item])
        edits, strip = int(self.limits.edits(size)), int(self.strip[item])
        width = 2 * strip + 2 * edits
        best = None
        for part in range(0, len(starts), 256):
            some = np.array(starts[part : part + 256])
            patterns = self.index.points[begin + some[:, None] + np.arange(size)]
            at = some[:, None] + band * strip - edits + np.arange(size + width + 1)
            inside = (at >= 0) & (at < len(points))
            regions = np.where(inside, points[np.clip(at, 0, len(points) - 1)], -1)
            distance, _ = banded(patterns, regions, width)
            k = int(distance.argmin())
            if best is None or distance[k] < best[0]:
                best = (int(distance[k]), int(some[k]))
        if best is not None and best[0] <= edits:
            if (found := self._align(points, item, band, best[1], best[1] + size)) is not None:
                yield found

    def _copy(self, points: np.ndarray, item: int, first: int, last: int, low: int, high: int) -> tuple | None:
        """The verbatim copy of a stretch of the item on strips ``low`` to ``high``, if there is one."""
        begin, strip = int(self.index.ends[item] - self.lengths[item]), int(self.strip[item])
        pattern = self.index.points[begin + first : begin + last].astype("<u4").tobytes()
        left = max(0, first + low * strip)
        region = points[left : max(0, last + high * strip)].astype("<u4").tobytes()
        exact = region.find(pattern)
        while exact >= 0 and exact % 4:
            exact = region.find(pattern, exact + 1)
        return None if exact < 0 else (item, left + exact // 4, left + exact // 4 + last - first, first, last, 0)

    def _align(self, points: np.ndarray, item: int, band: int, first: int, last: int) -> tuple | None:
        begin = int(self.index.ends[item] - self.lengths[item])
        pattern = self.index.points[begin + first : begin + last]
        edits = int(self.limits.edits(len(pattern)))
        strip = int(self.strip[item])
        left = first + band * strip - edits
        right = last + (band + 2) * strip + edits
        region = points[max(0, left) : max(0, right)]
        exact = region.astype("<u4").tobytes().find(pattern.astype("<u4").tobytes())
        while exact >= 0 and exact % 4:
            exact = region.astype("<u4").tobytes().find(pattern.astype("<u4").tobytes(), exact + 1)
        if exact >= 0:
            start = max(0, left) + exact // 4
            return item, start, start + len(pattern), first, last, 0
        width = right - left - len(pattern)
        padded = np.full(right - left, -1, np.int32)
        padded[max(0, -left) : max(0, -left) + len(region)] = region
        padded = np.append(padded, -1)
        (distance,), (end,) = banded(pattern[None], padded[None], width)
        if distance > edits:
            return None
        # Backwards from that end; fewer characters than the pattern has are a drift to the left of the anchor.
        backwards = np.concatenate([np.full(edits, -1, np.int32), padded[:end][::-1], np.full(len(padded), -1, np.int32)])
        _, (back,) = banded(pattern[None, ::-1], backwards[None, : len(padded)], width, edits)
        back -= edits
        return item, max(0, left + int(end - back)), min(len(points), left + int(end)), first, last, int(distance)


def banded(patterns: np.ndarray, regions: np.ndarray, width: int, anchor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edits of each pattern against its best place in its region, and where that place ends.

    A region is ``width + 1`` longer than its pattern.  The place may begin at
    any of its first ``width + 1`` positions, or at ``anchor`` alone, and drifts within that band.
    """
    count, n = patterns.shape
    steps = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((count, width + 1), np.int32)
    if anchor is not None:
        row += np.where(steps < anchor, 1 << 20, steps - anchor).astype(np.int32)
    for i in range(n):
        moved = row + (regions[:, i : i + width + 1] != patterns[:, i : i + 1])
        moved[:, :-1] = np.minimum(moved[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(moved - steps, axis=1) + steps
    best = row.argmin(axis=1)
    return row[np.arange(count), best], best + n


PASSAGES = T.ArrayType(
    T.StructType(
        [T.StructField("item_id", T.LongType())]
        + [T.StructField(n, T.IntegerType()) for n in ("start", "end", "item_start", "item_end", "edits")]
    )
)
_ARROW = pa.list_(
    pa.struct([("item_id", pa.int64())] + [(n, pa.int32()) for n in ("start", "end", "item_start", "item_end", "edits")])
)
_loaded: dict[str, Searcher] = {}


def _worker(name: str, layout: list[tuple], bits: int, limits: Limits) -> Searcher:
    if name not in _loaded:
        _loaded[name] = Searcher(ItemIndex.mapped(SparkFiles.get(name), layout, bits), limits)
    return _loaded[name]


def item_blocks(items: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars``, by a hash of the id; one block is on the driver at a time."""
    given = items.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    total = given.agg(F.sum(F.char_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // block_chars))
    for block in range(blocks):
        part = given.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        yield sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r))


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    limits: Limits = Limits(),
    text: str = "text",
    name: str = "passages",
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = 4_000_000,
) -> DataFrame:
    """``docs`` with the benchmark passages of every whole text.

    ``name`` holds an array of (item_id, start, end, item_start, item_end,
    edits): for each item that the text has a passage of, the longest and
    closest one.  start and end are code points of the text; item_start and
    item_end refer to the item in lower case with single blanks, the form in
    which both are compared.

    Hits of the item's q-grams are counted in overlapping bands of diagonals;
    a band goes on if it has a window with as many hits as a passage within the
    edit budget must share, and is then aligned.  Items are compared in blocks
    of about ``block_chars``, each of which is indexed, shipped as a mapped
    file and searched in the same pass over the documents, so what lies on the
    driver and in a worker is bounded by the block.  Documents are not shuffled.

    A null or empty text, and one without a passage, has an empty array; items
    with a null text are ignored, those without an id are reported with a null
    item_id, repeated items once for each row.  Repeated documents are kept, empty
    tables give empty results, a column called ``name`` is replaced.

    Repeated characters make many hits.  All neighbouring bands of an item are
    counted at once before any is looked at by itself, and bands that cannot
    hold a longer passage than one already found are left, so a text costs
    about its hits, and one alignment for each of its bands that may differ.
    """
    spark = docs.sparkSession
    shipped = []
    for block in item_blocks(items, item_id, item_text, block_chars):
        index = ItemIndex(block, limits)
        content, layout = index.packed()
        if len(index.ids):
            shipped.append((share(spark, content, "benchmark"), layout, index.bits))
    kept = [c for c in docs.columns if c != name]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(name, PASSAGES)])
    keys = ("item_id", "start", "end", "item_start", "item_end", "edits")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = [_worker(*s, limits) for s in shipped]
        for piece in pieces(batches, text):
            found = [
                [dict(zip(keys, hit)) for s in searchers for hit in (s.search(t) if t else ())] for t in texts(piece, text)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in kept], pa.array(found, _ARROW)], names=[*kept, name]
            )

    return docs.mapInArrow(run, schema)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document and item that leaks into it."""
    light = docs.select(doc_id, options.get("text", "text"))
    found = find_passages(light, items, name="_passages", **options)
    return found.select(doc_id, F.explode("_passages").alias("_p")).select(doc_id, "_p.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark passage, with their own columns."""
    name = fresh("_passages", docs)
    return find_passages(docs, items, name=name, **options).where(F.size(name) == 0).drop(name)
