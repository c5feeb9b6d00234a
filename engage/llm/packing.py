"""Best-fit packing into sequences of several permitted lengths.

Documents become pieces of at most the largest permitted length.  Pieces are
spread over pools by a hash of their row number, and each pool is packed on
its own: pieces by falling length, each into the open bin that it leaves with
the least room.  Where no open bin has room, a bin is opened at the permitted
size of least cost per token.  All permitted sizes are tried as the smallest
size to open, since larger bins fill better and smaller ones waste less at
the end; every bin is finally cut down to the smallest permitted size that
holds its contents, and the choice of least total cost stays.

The cost of a sequence of ``s`` tokens is ``s + OVERHEAD + s * s / QUADRATIC``:
its tokens, a fixed cost, and attention.

The pool count follows the number of pieces, so a pool's size does not grow
with the corpus; only lengths are shuffled.  Defined cases: a null or empty
text is the end id alone; repeated rows are packed each; null ids are kept;
empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, staged
from engage.llm.tokens import default_tokenizer, encoder

SIZES = (512, 1024, 2048, 4096)
OVERHEAD = 16
QUADRATIC = 8192
POOL = 20_000                   # pieces of a pool, on average

PACKED = ("doc_id long, piece long, start long, n_tokens long, pool long, bin long, offset long, "
          "bin_size long")


def cost(size: np.ndarray | int):
    return size + OVERHEAD + size * size / QUADRATIC


def best_fit(lengths: np.ndarray, sizes: tuple[int, ...], smallest: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each length, and the tokens of each bin.

    ``lengths`` fall; bins are opened at ``smallest`` or more.  Open bins are
    kept by their room, and a bit set of rooms finds the tightest fit.
    """
    rate = {s: cost(s) / s for s in sizes if s >= smallest}
    opened = {}
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used: list[int] = []
    room: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            if n not in opened:
                opened[n] = min((s for s in rate if s >= n), key=lambda s: (rate[s], s))
            b, r = len(used), opened[n]
            used.append(0)
            room.append(r)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        r -= n
        if r:
            by_room.setdefault(r, []).append(b)
            rooms |= 1 << r
    return bins, offsets, used


def pack(lengths: np.ndarray, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and final bin size of each of the falling ``lengths``."""
    permitted = np.array(sorted(sizes))
    best = None
    for smallest in sorted(sizes):
        bins, offsets, used = best_fit(lengths, tuple(sorted(sizes)), smallest)
        final = permitted[np.searchsorted(permitted, used)]
        total = float(cost(final.astype(float)).sum())
        if best is None or total < best[0]:
            best = total, bins, offsets, final
    _, bins, offsets, final = best
    return bins, offsets, final[bins]


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens`` (with the end id) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            n = pa.array(enc.lengths(b.column("text")) + 1, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n], names=["doc_id", "n_tokens"])
    return id_and_bytes(docs).mapInArrow(run, "doc_id long, n_tokens long")


def pack_lengths(lengths: DataFrame, sizes: tuple[int, ...] = SIZES, pool: int = POOL) -> DataFrame:
    """One row per piece of ``lengths (doc_id, n_tokens)``: its place in the
    document, its bin, its offset there and the bin's final size."""
    most = max(sizes)
    rows = lengths.select("doc_id", "n_tokens", F.explode(F.sequence(
        F.lit(0), F.greatest((F.col("n_tokens") - 1).cast("long"), F.lit(0)), F.lit(most))).alias("start"))
    pieces = rows.select(
        "doc_id", F.expr(f"start div {most}").alias("piece"), F.col("start").cast("long").alias("start"),
        F.least(F.lit(most), F.col("n_tokens") - F.col("start")).cast("long").alias("n_tokens"))
    # numbered once and written, so that a second reading deals the same pools
    pieces = staged(pieces.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    pools = max(1, -(-pieces.count() // pool))

    def run(rows):
        # in Arrow, where a null id beside large ones leaves them whole
        rows = rows.sort_by([("n_tokens", "descending"), ("row", "ascending")])
        for name, column in zip(("bin", "offset", "bin_size"), pack(rows["n_tokens"].to_numpy(), sizes), strict=True):
            rows = rows.append_column(name, pa.array(column, pa.int64()))
        return rows.select([f.split()[0] for f in PACKED.split(", ")])
    dealt = pieces.withColumn("pool", F.pmod(F.xxhash64("row"), F.lit(pools)))
    return dealt.groupBy("pool").applyInArrow(run, PACKED)


def pack_documents(docs: DataFrame, sizes: tuple[int, ...] = SIZES, tokenizer: str | None = None,
                   pool: int = POOL) -> DataFrame:
    """Pieces of all documents, packed; lengths are token counts."""
    return pack_lengths(token_lengths(docs, tokenizer or default_tokenizer()), sizes, pool)
