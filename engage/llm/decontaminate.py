"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are compared in lower case with white space run
together.  An item of ``m`` characters counts as leaked where a region of a
text is within ``k = m * MAX_EDIT`` edits of it.  Such a region shares at
least ``m + 1 - q * (k + 1)`` of the item's q-grams with it, and their
diagonals (place in the text less place in the item) span at most ``k``.
Shared q-grams are counted in bands of ``2 * (k + 1)`` diagonals, overlapping
by half, so the diagonals of a match lie in one band whole; bands that reach
the bound are verified by a banded edit-distance alignment.  Each item has the
largest ``q`` up to ``Q`` that keeps its bound positive.

Items of fewer than ``MIN_CHARS`` characters are matched without edits, and
only as whole words: where white space or an end of the text stands on both
sides (a few letters inside other words are no evidence).

The benchmark is a query set: it comes through the driver to the tasks in
blocks of at most ``BLOCK_CHARS`` characters (one item at least).  Each block
is one pass over the texts, and what it found is staged before the next block
is read, so the driver and a task hold one block.  Texts are never shuffled.

Defined cases: null and empty texts and items match nothing; repeated rows
are judged each; null ids stay; an empty benchmark marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, map_batches, staged

Q = 10
MAX_EDIT = 0.08
MIN_CHARS = 20
BLOCK_CHARS = 4_000_000
SLOTS = 22                      # log2 of the slots of the gram filter
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

MATCH = "array<struct<item_id:long,start:long,end:long,edits:long>>"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Rolling hash of every q-gram (a window of ``q`` code points)."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    h, width, out, done = codes.astype(np.uint64) + np.uint64(1), 1, None, 0
    base = 0x100000001B3
    while True:
        if q & width:
            if out is None:
                out, done = h, width
            else:
                factor = np.uint64(pow(base, width, 1 << 64))
                n = min(len(out), len(h) - done)
                out, done = out[:n] * factor + h[done:done + n], done + width
        width *= 2
        if width > q:
            return out[:len(codes) - q + 1]
        half = width // 2
        h = h[:-half] * np.uint64(pow(base, half, 1 << 64)) + h[half:]


def alignment(item: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int, int] | None:
    """Least edits of ``item`` against a part of ``region``, with the part's
    start and end, if ``k`` or fewer; ends of the region are free.

    Row by row over the item; a row holds the cells of the band only, as the
    region is no longer than the item and the band.
    """
    n = len(region)
    dist, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    band = n - len(item)
    for i, c in enumerate(item.tolist(), 1):
        lo, hi = max(0, i - k - 1), min(n, i + max(band, 0) + k + 1)
        new, start = np.full(n + 1, k + 1, np.int64), np.zeros(n + 1, np.int64)
        cells = slice(max(lo, 1), hi + 1)
        prev = slice(cells.start - 1, hi)
        down, across = dist[cells] + 1, dist[prev] + (region[prev] != c)
        take = across <= down
        new[cells], start[cells] = np.where(take, across, down), np.where(take, begin[prev], begin[cells])
        if lo == 0:
            new[0], start[0] = i, 0
        # an insertion chain: the least of (value - place) so far, plus the place
        span = np.arange(cells.start, hi + 1)
        lead = new[cells] - span
        least = np.minimum.accumulate(lead)
        better = least + span < new[cells]
        if better.any():
            first = np.maximum.accumulate(np.where(lead == least, np.arange(len(span)), 0))
            start[cells] = np.where(better, start[cells][first], start[cells])
            new[cells] = np.where(better, least + span, new[cells])
        dist, begin = new, start
        if dist[lo:hi + 1].min() > k:
            return None
    end = int(np.argmin(dist))
    return (int(dist[end]), int(begin[end]), end) if dist[end] <= k else None


class Grams:
    """q-grams of the items that share one ``q``: ``(item_id, text, k)``."""

    def __init__(self, items: list[tuple[int | None, str, int]], q: int):
        self.q = q
        self.items = [(i, t, points(t)) for i, t, _ in items]
        m = np.array([len(p) for _, _, p in self.items], np.int64)
        self.longest = int(m.max(initial=0))
        self.k = np.array([k for _, _, k in items], np.int64)
        self.bound = m + 1 - q * (self.k + 1)
        grams = [gram_hashes(p, q) for _, _, p in self.items]
        flat = np.concatenate(grams)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(flat, kind="stable")
        self.gram, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.filter = np.zeros(1 << SLOTS, bool)
        self.filter[self._slot(self.gram)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * MULTIPLIER) >> np.uint64(64 - SLOTS)

    def matches(self, text: str, codes: np.ndarray) -> list[tuple]:
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.filter[self._slot(h)])
        found = np.searchsorted(self.gram, h[at])
        found[found == len(self.gram)] = 0
        hit = self.gram[found] == h[at]
        at, found = at[hit], found[hit]
        if not len(at):
            return []
        times = self.count[found]
        within = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[found], times) + within
        item = self.item[entry]
        diagonal = np.repeat(at, times) - self.place[entry]
        band = diagonal // (self.k[item] + 1)
        shift = np.int64(len(codes) + self.longest + 2)
        key = np.concatenate([item * (2 * shift) + band + shift, item * (2 * shift) + band - 1 + shift])
        keys, counts = np.unique(key, return_counts=True)
        items = keys // (2 * shift)
        keep = counts >= self.bound[items]
        best: dict[int, tuple] = {}
        for i, b in zip(items[keep].tolist(), (keys[keep] % (2 * shift) - shift).tolist(), strict=True):
            item_id, plain, p = self.items[i]
            k = int(self.k[i])
            lo, hi = max(0, b * (k + 1) - k), min(len(codes), (b + 2) * (k + 1) + len(p) + k)
            if len(p) < MIN_CHARS:
                exact = whole_words(text, plain, lo, hi)
                got = (0, exact - lo, exact - lo + len(p)) if exact >= 0 else None
            else:
                exact = text.find(plain, lo, hi)
                got = (0, exact - lo, exact - lo + len(p)) if exact >= 0 else alignment(p, codes[lo:hi], k)
            if got and (i not in best or (got[0], lo + got[1]) < (best[i][3], best[i][1])):
                best[i] = (item_id, lo + got[1], lo + got[2], got[0])
        return list(best.values())


def whole_words(text: str, plain: str, lo: int, hi: int) -> int:
    """First place of ``plain`` in ``text[lo:hi]`` between white space or the
    ends of the text (-1: none)."""
    at = text.find(plain, lo, hi)
    while at >= 0:
        end = at + len(plain)
        if (at == 0 or text[at - 1] == " ") and (end == len(text) or text[end] == " "):
            return at
        at = text.find(plain, at + 1, hi)
    return -1


class Index:
    """A block of benchmark items, by their ``q``."""

    def __init__(self, items: list[tuple[int | None, str]]):
        by_q: dict[int, list] = {}
        for item_id, text in items:
            plain = normalised(text or "")
            m = len(plain)
            if m:
                k = int(m * MAX_EDIT + 1e-9) if m >= MIN_CHARS else 0
                by_q.setdefault(min(Q, m // (k + 1)), []).append((item_id, plain, k))
        self.parts = [Grams(group, q) for q, group in sorted(by_q.items())]

    def matches(self, text: str) -> list[tuple]:
        """``(item_id, start, end, edits)`` of the best match of each leaked item."""
        codes = points(text)
        found = [m for part in self.parts if len(codes) >= part.q for m in part.matches(text, codes)]
        return sorted(found, key=lambda r: (r[0] is not None, r))


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """Items in blocks of at most ``block_chars`` characters (or one item)."""
    held, chars = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        size = len(row[1] or "")
        if held and chars + size > block_chars:
            yield held
            held, chars = [], 0
        held.append((row[0], row[1]))
        chars += size
    if held:
        yield held


def _finder(items: list[tuple]):
    made: list[Index] = []

    def run(batch: pa.RecordBatch) -> list[list[dict]]:
        if not made:
            made.append(Index(items))
        names = ("item_id", "start", "end", "edits")
        return [[dict(zip(names, m, strict=True)) for m in made[0].matches(normalised(t.decode("utf-8", "replace")))]
                for t in batch.column("text").to_pylist()]
    return run


MATCHES_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "edits")]))


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, matches`` for every row of ``docs``: the leaked items with the
    region of the normalised text and its edits, by item id."""
    rows = id_and_bytes(docs).withColumn("matches", F.lit(None).cast(MATCH))
    for n, items in enumerate(blocks(benchmark, block_chars)):
        find = _finder(items)

        def run(batch: pa.RecordBatch, find=find) -> pa.RecordBatch:
            new = [(a or []) + b for a, b in zip(batch.column("matches").to_pylist(), find(batch), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"),
                                               pa.array(new, MATCHES_TYPE)], names=["doc_id", "text", "matches"])
        rows = map_batches(staged(rows, "leaks") if n else rows, run, f"doc_id long, text binary, matches {MATCH}")
    return rows.select("doc_id", F.array_sort(F.coalesce("matches", F.array().cast(MATCH))).alias("matches"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without a leak, with all their columns."""
    out = docs
    for n, items in enumerate(blocks(benchmark, block_chars)):
        find = _finder(items)
        out = staged(out, "clean") if n else out

        def run(batch: pa.RecordBatch, find=find) -> pa.RecordBatch:
            text = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            found = find(pa.RecordBatch.from_arrays([text], names=["text"]))
            return batch.filter(pa.array([not m for m in found], pa.bool_()))
        out = map_batches(out, run, out.schema)
    return out
