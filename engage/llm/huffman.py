"""Token ids as canonical length-limited Huffman codes.

``encode_table`` turns texts into ids, counts every id over all documents,
builds code lengths by package-merge under a length limit, and writes the ids
in ascending ``doc_id`` order as independent blocks; ``decode_table`` reads a
written folder back.

File format: ``codes`` holds one row per id in use (``id``, ``n_bits``; the
codes follow from the lengths).  ``blocks`` holds one row per block: its place
(``shard``, ``block``), ids of the shard before it, the documents' ids and
token counts, the bits as little-endian 64-bit words filled from the top, and
the bit offset of every ``STRIDE``-th id.  A block holds whole documents, and
closes at ``BLOCK_IDS`` ids; decoding runs from all its bit offsets at once,
each step reading one id per lane from a table of ``2 ** limit`` entries.
Shards are ranges of ``doc_id``.  The folder is written by Spark, so any store
Spark can write to will do, and a failed task leaves no half of a file.

Memory: a task holds one block (``AT_ONCE`` ids of them where it decodes) and
one batch of texts; a document larger than a block makes a block of its own.
To the driver go the id counts (bounded by the vocabulary) and one row per shard.

Defined cases: null and empty texts hold the end id alone; rows with one
``doc_id`` follow each other by their ids; null ``doc_id`` comes first; an
empty table gives empty files and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, new_path, staged
from engage.llm.tokens import END_ID, default_tokenizer, encoder

LIMIT = 18
STRIDE = 128
BLOCK_IDS = 1 << 16
AT_ONCE = 1 << 20               # ids decoded at once
U64 = np.uint64

ENCODED = "doc_id long, n_tokens long, ids binary"
BLOCKS = ("shard int, block int, before long, n_ids long, doc_ids array<long>, "
          "doc_tokens array<long>, offsets binary, bits binary")
DECODED = "doc_id long, start long, n_tokens long, ids_crc32 long"


# ---- codes
def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge).

    Ids with count zero get no code.  The limit is raised where the ids in use
    would not fit in it.
    """
    out = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    n = len(used)
    if n <= 2:
        out[used] = 1
        return out
    limit = max(limit, int(n - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    coins, from_leaf = leaves, []
    for _ in range(limit - 1):
        even = len(coins) // 2 * 2
        both = np.concatenate([leaves, coins[0:even:2] + coins[1:even:2]])
        order = np.argsort(both, kind="stable")
        from_leaf.append(order < n)
        coins = both[order]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(from_leaf):
        k = int(is_leaf[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    lengths[:take] += 1
    out[used] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: ordered by length, then id."""
    codes = np.zeros(len(lengths), U64)
    order = [i for i in np.lexsort((np.arange(len(lengths)), lengths)) if lengths[i]]
    code = last = 0
    for i in order:
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


class Coder:
    """Packs and unpacks ids under given code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical(self.lengths)
        self.width = int(self.lengths.max(initial=0)) or 1
        order = np.lexsort((np.arange(len(lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        spans = 1 << (self.width - self.lengths[order])
        size = 1 << self.width
        self.symbol = np.zeros(size, np.uint32)
        self.step = np.ones(size, U64)
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(order, spans)
        self.step[:filled] = np.repeat(self.lengths[order], spans)

    def pack(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Bits and the bit offsets of every ``STRIDE``-th id."""
        size = self.lengths[ids]
        end = np.cumsum(size)
        at = end - size
        words = np.zeros((int(end[-1]) if len(ids) else 0) // 64 + 2, U64)
        if len(ids):
            word, over = at >> 6, (at & 63) + size - 64
            code = self.codes[ids]
            head = np.where(over <= 0, code << np.maximum(-over, 0).astype(U64),
                            code >> np.maximum(over, 0).astype(U64))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.bitwise_or.reduceat(head, first)
            cut = np.flatnonzero(over > 0)
            words[word[cut] + 1] |= code[cut] << (64 - over[cut]).astype(U64)
        return at[::STRIDE].astype("<u8").tobytes(), words.astype("<u8").tobytes()

    def unpack(self, bits: bytes, offsets: bytes, n: int) -> np.ndarray:
        """All ``n`` ids of a block."""
        return self.unpack_blocks([(bits, offsets, n)])[0]

    def unpack_blocks(self, blocks: list[tuple[bytes, bytes, int]]) -> list[np.ndarray]:
        """All ids of each block, one lane per bit offset of all of them."""
        parts = [np.frombuffer(bits, "<u8") for bits, _, _ in blocks]
        words = np.concatenate(parts)
        before = np.cumsum([0, *map(len, parts)]) * 64
        at = [np.frombuffer(offsets, "<u8") + U64(b) for (_, offsets, _), b in zip(blocks, before)]
        ends = np.cumsum([0, *map(len, at)])
        at = np.concatenate(at).astype(U64)
        out = np.empty((STRIDE, len(at)), "<u4")
        last, shift = len(words) - 2, U64(64 - self.width)
        for j in range(STRIDE):
            # (a block's last lane may read on behind its end; that is cut off)
            word, s = np.minimum((at >> U64(6)).view(np.int64), last), at & U64(63)
            view = (words[word] << s) | ((words[word + 1] >> U64(1)) >> (U64(63) - s))
            view = (view >> shift).view(np.int64)
            out[j] = self.symbol[view]
            at += self.step[view]
        return [out[:, a:b].T.ravel()[:n] for a, b, (_, _, n) in zip(ends, ends[1:], blocks)]


# ---- Spark jobs
def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` with the end id after each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            first = 0
            for ids, ends in enc.encode(b.column("text")):
                # the end id goes behind each text
                ids = np.insert(ids, ends, END_ID)
                bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                packed = pa.Array.from_buffers(pa.binary(), len(ends), [
                    None, pa.py_buffer((bounds * enc.dtype.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, len(ends)), pa.array(np.diff(bounds)), packed],
                    names=["doc_id", "n_tokens", "ids"])
                first += len(ends)
    return id_and_bytes(docs).mapInArrow(run, ENCODED)


def _values(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """All bytes of a binary column (no nulls) as one array of ``dtype``."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(dtype)


def id_counts(encoded: DataFrame, dtype: np.dtype, size: int) -> np.ndarray:
    """How often each id occurs in all documents; summed per task before the
    shuffle, and bounded by the vocabulary at the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(_values(b.column("ids"), dtype), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])
    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    got = rows.toPandas()
    counts[got["id"].to_numpy()] = got["n"].to_numpy()
    return counts


def _blocks(encoded: DataFrame, lengths: np.ndarray, dtype: np.dtype) -> DataFrame:
    """Blocks of rows that are sorted within their range partition."""
    packed_lengths = lengths.astype(np.uint8).tobytes()
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()),
                        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("doc_tokens", pa.list_(pa.int64())), ("offsets", pa.binary()),
                        ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(packed_lengths, np.uint8))
        shard = TaskContext.get().partitionId()
        state = {"block": 0, "before": 0, "held": 0}
        docs, sizes, parts = [], [], []

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), dtype)
            offsets, bits = coder.pack(ids)
            row = [shard, state["block"], state["before"], len(ids), list(docs), list(sizes), offsets, bits]
            state["block"] += 1
            state["before"] += len(ids)
            state["held"] = 0
            for x in (docs, sizes, parts):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for b in batches:
            for doc, n, ids in zip(b.column("doc_id").to_pylist(), b.column("n_tokens").to_pylist(),
                                   b.column("ids").to_pylist(), strict=True):
                docs.append(doc)
                sizes.append(n)
                parts.append(ids)
                state["held"] += n
                if state["held"] >= BLOCK_IDS:
                    yield close()
        if docs:
            yield close()
    return encoded.mapInArrow(run, BLOCKS)


def encode_table(docs: DataFrame, path: str, tokenizer: str | None = None,
                 limit: int = LIMIT, shards: int | None = None) -> None:
    """Write the ids of all texts under ``path`` (``codes`` and ``blocks``)."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    enc = encoder(tokenizer)
    encoded = staged(tokenized(docs, tokenizer), "huffman-ids")
    lengths = code_lengths(id_counts(encoded, enc.dtype, enc.size), limit)
    used = np.flatnonzero(lengths)
    codes = [(int(i), int(lengths[i])) for i in used]
    spark.createDataFrame(codes, "id int, n_bits int").coalesce(1).write.parquet(f"{path}/codes")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (encoded.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids"))
    # block bits are already as short as they get
    _blocks(ordered, lengths, enc.dtype).write.option("compression", "none").parquet(f"{path}/blocks")


def _groups(blocks: pa.RecordBatch) -> Iterator[list[dict]]:
    """Rows of a batch, some at a time, of ``AT_ONCE`` ids or one block."""
    some, held = [], 0
    for i in range(blocks.num_rows):
        row = blocks.slice(i, 1).to_pylist()[0]
        if some and held + row["n_ids"] > AT_ONCE:
            yield some
            some, held = [], 0
        some.append(row)
        held += row["n_ids"]
    if some:
        yield some


def decode_table(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files under ``path``."""
    codes = spark.read.schema("id int, n_bits int").parquet(f"{path}/codes").toPandas()
    lengths = np.zeros(int(codes["id"].max()) + 1 if len(codes) else 1, np.uint8)
    lengths[codes["id"].to_numpy()] = codes["n_bits"].to_numpy()
    packed_lengths = lengths.tobytes()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).toPandas().sort_values("shard")
    base = dict(zip(sums["shard"].tolist(), (sums["n"].cumsum() - sums["n"]).tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(packed_lengths, np.uint8))
        for some in (g for b in batches for g in _groups(b)):
            got = coder.unpack_blocks([(r["bits"], r["offsets"], r["n_ids"]) for r in some])
            for row, ids in zip(some, got, strict=True):
                ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
                starts = ends - np.array(row["doc_tokens"], np.int64)
                crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["before"] + base[row["shard"]]),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return blocks.mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to a fresh folder and read it back."""
    path = new_path(docs.sparkSession, "huffman")
    encode_table(docs, path, tokenizer)
    return decode_table(docs.sparkSession, path)
