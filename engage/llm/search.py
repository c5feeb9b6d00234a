"""Ranked lexical search: MaxScore with bounds on pairs of terms.

*Index.*  Each scan task cuts its documents into shards (at most
``SHARD_BYTES`` of text and 65,536 documents) and writes one row per term of a
shard: its document numbers and frequencies; a header row of the shard holds
the ids and lengths.  No text is shuffled, and a frequent term is a row of
bounded size in every shard.

*Pair lists.*  The distinct terms of an item, by falling weight, are taken two
by two.  For each such pair and shard the intersection of the two postings is
listed with its joint impacts and their maximum.  Sums over the lists of an
item are lower bounds of document scores; the ``k``-th best of them over all
shards is the threshold that every shard starts from.

*Query.*  A document that holds both terms of a pair scores at most the joint
maximum there, any other at most the larger of the two single maxima, so a
pair is bounded by the largest of the three, which is never above the sum of
the two maxima.  Pairs are ordered by this bound; those whose bounds together
stay below the threshold are not essential: their postings name no candidate
and are looked up only for candidates that can still reach the threshold,
which rises on the way.  Impacts are whole numbers, so the result is exact.

Items are read in blocks of ``ITEM_BLOCK`` items and ``BLOCK_BYTES``; a task holds one shard's postings
of a block's terms.  Every block runs on its own and is staged.

Defined cases: a null or empty text (or item) has no terms, matches nothing
and counts in no statistic; terms are cut at ASCII bytes other than letters
and digits, everything from U+0080 on belongs to a term; each row is a
document of its own, so a repeated ``doc_id`` can be listed several times, and
a null one comes last among equal scores; each item row is a query of its own;
empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, staged

SHARD_BYTES = 1 << 24
SHARD_DOCS = 1 << 16            # document numbers of a shard fit 16 bits
ITEM_BLOCK = 1024               # items of a block
BLOCK_BYTES = 1 << 22           # and bytes of their distinct terms (one item at least)
ROWS_OUT = 1 << 15
TOP = 20

_INDEX = ("shard long, term binary, df long, total long, docs binary, tfs binary, "
          "ids array<long>, lengths array<long>")


def _term_bytes() -> np.ndarray:
    """0 for bytes that end a term, else the byte itself, A-Z lower-cased."""
    to = np.zeros(256, np.uint8)
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        to[first:last + 1] = np.arange(first, last + 1)
    to[0x41:0x5B] += 32
    return to


TERM_BYTES = _term_bytes()
_SPACED = bytes(int(b) or 32 for b in TERM_BYTES)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_SPACED).split()


def shards(batches: Iterable[pa.RecordBatch], max_bytes: int, max_docs: int) -> Iterator[pa.Table]:
    """The rows in runs of at most ``max_bytes`` of text (one row at least)."""
    held, size, rows = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start, n = 0, batch.num_rows
        while start < n:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + max_bytes - size, "right"))
            stop = min(stop, start + max_docs - rows)
            if stop <= start:
                if held:
                    yield pa.Table.from_batches(held)
                    held, size, rows = [], 0, 0
                    continue
                stop = start + 1
            held.append(batch.slice(start, stop - start))
            size, rows, start = size + int(ends[stop - 1]) - before, rows + stop - start, stop
    if held:
        yield pa.Table.from_batches(held)


def postings(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, ends of their postings, document numbers, frequencies, lengths
    of the documents) of the texts of a shard."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    body = texts.buffers()[2]
    raw = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    low = TERM_BYTES[raw]
    inside = low != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(raw)]
    begins[first] = inside[first]               # a term ends with its text
    per_doc = np.diff(np.searchsorted(np.flatnonzero(begins), offsets))
    starts = np.flatnonzero(begins[inside])
    packed = low[inside]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(np.append(starts, len(packed)).astype(np.int32)), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keys, tfs = np.unique(codes * n + np.repeat(np.arange(n), per_doc), return_counts=True)
    ends = np.cumsum(np.bincount(keys // max(n, 1), minlength=len(coded.dictionary)))
    return coded.dictionary, ends, keys % max(n, 1), tfs, per_doc


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array of runs of a numpy array."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)),
                                                          pa.py_buffer(np.ascontiguousarray(values))])


def _index_rows(batches: Iterator[pa.RecordBatch], max_bytes: int, max_docs: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() << 32
    numbers = pa.list_(pa.int64())
    names = ["shard", "term", "df", "total", "docs", "tfs", "ids", "lengths"]
    for k, table in enumerate(shards(batches, max_bytes, max_docs)):
        terms, ends, docs, tfs, lengths = postings(pa.concat_arrays(table.column("text").chunks))
        yield pa.RecordBatch.from_arrays(
            [pa.array([task + k], pa.int64()), pa.nulls(1, pa.binary()), pa.array([int((lengths > 0).sum())], pa.int64()),
             pa.array([int(lengths.sum())], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
             pa.array([table.column("doc_id").to_pylist()], numbers), pa.array([lengths], numbers)], names=names)
        n = len(terms)
        rows = pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, task + k)), terms, pa.array(np.diff(ends, prepend=0)), pa.nulls(n, pa.int64()),
             _packed(docs.astype("<u2"), ends), _packed(tfs.astype("<u4"), ends),
             pa.nulls(n, numbers), pa.nulls(n, numbers)], names=names)
        for i in range(0, n, ROWS_OUT):
            yield rows.slice(i, ROWS_OUT)


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The index of all terms of all texts, staged."""
    if not 0 < shard_docs <= SHARD_DOCS:
        raise ValueError("document numbers of a shard have 16 bits")
    rows = id_and_bytes(docs).mapInArrow(lambda b: _index_rows(b, shard_bytes, shard_docs), _INDEX)
    return staged(rows, "search-index")


class Block:
    """A block of items with their terms, weights and pairs."""

    def __init__(self, items: list[tuple], n_docs: int, total: int, df: dict[bytes, int]) -> None:
        self.n_docs, self.total = n_docs, total
        self.weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
        self.items = []                 # (number, item id, units: (term, times, term or None, times))
        for number, item_id, counts in items:
            known = sorted((t for t in counts if t in self.weights), key=lambda t: (-self.weights[t], t))
            units = [(a, counts[a], b, counts.get(b, 0))
                     for a, b in zip(known[::2], [*known[1::2], None], strict=False)]
            self.items.append((number, item_id, units))
        self.pairs = sorted({(a, b) for _, _, units in self.items for a, _, b, _ in units if b is not None})

    def impacts(self, table: pa.Table) -> tuple[dict, pa.Array, int]:
        """({term: (document numbers, impacts)}, ids, documents) of a shard."""
        header = table.filter(pc.is_null(table.column("term")))
        lengths = np.asarray(header.column("lengths")[0].values, dtype=np.int64)
        m = 75 + (25 * lengths * self.n_docs) // max(self.total, 1)
        lists = {}
        rows = table.filter(pc.is_valid(table.column("term")))
        for term, docs, tfs in zip(*(rows.column(c).to_pylist() for c in ("term", "docs", "tfs")), strict=True):
            d = np.frombuffer(docs, "<u2").astype(np.int64)
            tf = np.frombuffer(tfs, "<u4").astype(np.int64)
            lists[term] = d, self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[d]))
        return lists, header.column("ids")[0].values, len(lengths)


def intersect(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Documents of both postings and their joint impacts."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    hit = b[0][at] == a[0]
    return a[0][hit], a[1][hit] + b[1][at[hit]]


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    return np.partition(values, len(values) - k)[len(values) - k:] if len(values) > k else values


_PAIRS = "shard long, a binary, b binary, docs binary, joint binary, joint_max long, item int, best array<long>"


def pair_lists(chosen: DataFrame, block: Block, k: int) -> DataFrame:
    """Per shard: the intersection list of each pair with its joint maximum,
    and per item the best sums over its lists (``item``, ``best``)."""
    def run(key, table):
        lists, _, n = block.impacts(table)
        out, found = [], {}
        for a, b in block.pairs:
            if a in lists and b in lists:
                docs, joint = found[a, b] = intersect(lists[a], lists[b])
                if len(docs):
                    out.append({"a": a, "b": b, "docs": docs.astype("<u2").tobytes(),
                                "joint": joint.astype("<i8").tobytes(), "joint_max": int(joint.max())})
        for number, _, units in block.items:
            sums = np.zeros(n, np.int64)
            for a, _, b, _ in units:
                docs, joint = found.get((a, b), ((), ()))
                if len(docs):
                    sums[docs] += joint
            best = _largest(sums[sums > 0], k)
            if len(best):
                out.append({"item": number, "best": best.tolist()})
        schema = pa.schema([("shard", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("docs", pa.binary()),
                            ("joint", pa.binary()), ("joint_max", pa.int64()), ("item", pa.int32()),
                            ("best", pa.list_(pa.int64()))])
        for r in out:
            r["shard"] = key[0].as_py()
        return pa.Table.from_pylist(out, schema=schema)
    return chosen.groupBy("shard").applyInArrow(run, _PAIRS)


def thresholds(pairs: DataFrame, k: int) -> dict[int, int]:
    """Per item the ``k``-th best lower bound over all shards, where so many
    documents have one."""
    best = pairs.filter("item is not null").select("item", F.explode("best").alias("low"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low"))))
    ranked = ranked.filter(F.col("rank") <= k).groupBy("item").agg(F.max("rank").alias("n"), F.min("low").alias("low"))
    return {r["item"]: r["low"] for r in ranked.filter(F.col("n") == k).collect()}


def unit_bound(unit: tuple, highest: dict[bytes, int], joint: dict[tuple, int]) -> int:
    """Largest score that the terms of a pair give any document."""
    a, qa, b, qb = unit
    ma, mb = highest.get(a, 0), highest.get(b, 0)
    both = joint.get((a, b), 0)
    if both:
        c = min(qa, qb)
        both = c * both + (qa - c) * ma + (qb - c) * mb
    return max(qa * ma, qb * mb, both)


def top_of_shard(units: list[tuple], lists: dict, n: int, highest: dict, joint: dict, theta: int,
                 k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(document numbers, scores, postings read) of documents that may be among
    the ``k`` best; the true scores of all that reach ``theta``."""
    bounded = sorted(((unit_bound(u, highest, joint), i, u) for i, u in enumerate(units)
                      if u[0] in lists or u[2] in lists), reverse=True)
    rest = np.cumsum([b for b, _, _ in bounded][::-1])[::-1]        # of this unit and all smaller ones
    # bounds of the first units that are not essential add up to less than theta
    split = next((i for i in range(len(bounded)) if rest[i] < theta), len(bounded))
    scores = np.zeros(n, np.int64)
    read = 0
    for _, _, (a, qa, b, qb) in bounded[:split]:
        for t, q in ((a, qa), (b, qb)):
            if t in lists:
                scores[lists[t][0]] += q * lists[t][1]
                read += len(lists[t][0])
    docs = np.flatnonzero(scores)
    s = scores[docs]
    for i in range(split, len(bounded)):
        if len(s) >= k:
            theta = max(theta, int(_largest(s, k).min()))
        alive = s + rest[i] >= theta
        docs, s = docs[alive], s[alive]
        if not len(docs):
            break
        _, _, (a, qa, b, qb) = bounded[i]
        for t, q in ((a, qa), (b, qb)):
            if t in lists:
                d, imp = lists[t]
                at = np.searchsorted(d, docs)
                at[at == len(d)] = 0
                s = s + np.where(d[at] == docs, q * imp[at], 0)
                read += len(docs)
    return docs, s, read


def _search_shard(block: Block, theta: dict[int, int], k: int, table: pa.Table, pairs: pa.Table) -> pa.Table:
    lists, ids, n = block.impacts(table)
    highest = {t: int(imp.max()) for t, (_, imp) in lists.items()}
    pairs = pairs.filter(pc.is_valid(pairs.column("a")))
    joint = dict(zip(zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True),
                     pairs.column("joint_max").to_pylist(), strict=True))
    null = ids.is_null().to_numpy(zero_copy_only=False)
    order = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    out = []
    for number, item_id, units in block.items:
        docs, s, _ = top_of_shard(units, lists, n, highest, joint, theta.get(number, 0), k)
        best = np.lexsort((order[docs], null[docs], -s))[:k]
        best = best[s[best] > 0]
        out.append(pa.table({"item": pa.array([number] * len(best), pa.int32()),
                             "item_id": pa.array([item_id] * len(best), pa.int64()),
                             "doc_id": ids.take(pa.array(docs[best])), "score": pa.array(s[best], pa.int64())}))
    return pa.concat_tables(out)


def _search_block(index: DataFrame, items: list[tuple], n_docs: int, total: int, k: int) -> DataFrame:
    spark = index.sparkSession
    wanted = sorted({t for _, _, counts in items for t in counts})
    # staged, so that its size is known and the join needs no hint
    terms = staged(spark.createDataFrame([(bytearray(t),) for t in wanted], "term binary"), "search-wanted")
    headers = index.filter("term is null")
    chosen = staged(index.join(terms, "term", "left_semi").select(*index.columns).unionByName(headers), "search-terms")
    df = {bytes(r.term): r.df for r in chosen.filter("term is not null").groupBy("term")
          .agg(F.sum("df").alias("df")).collect()}
    block = Block(items, n_docs, total, df)
    pairs = staged(pair_lists(chosen, block, k), "search-pairs")
    theta = thresholds(pairs, k)

    def run(table, bounds):
        return _search_shard(block, theta, k, table, bounds)
    hits = chosen.groupBy("shard").cogroup(pairs.select("shard", "a", "b", "joint_max").groupBy("shard")).applyInArrow(
        run, "item int, item_id long, doc_id long, score long")
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def search(index: DataFrame, items: DataFrame, k: int = TOP, block: int = ITEM_BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item
    with a score above 0, equal scores by ascending ``doc_id``."""
    spark = index.sparkSession
    stats = index.filter("term is null").agg(F.sum("df").alias("n"), F.sum("total").alias("t")).first()
    n_docs, total = stats.n or 0, stats.t or 0
    out, held, size = [], [], 0

    def flush() -> None:
        if held:
            out.append(staged(_search_block(index, held, n_docs, total, k), "search-top"))
            held.clear()
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for number, (item_id, text) in enumerate(rows.toLocalIterator()):
        counts = Counter(terms_of(text))
        if not counts or not n_docs:
            continue
        more = sum(map(len, counts))
        if len(held) == block or size + more > BLOCK_BYTES:
            flush()
            size = 0
        held.append((number, item_id, dict(counts)))
        size += more
    flush()
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
