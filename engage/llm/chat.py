"""Chat formatting by columnar byte assembly.

Turns are sorted by conversation and turn over range partitions.  For each
Arrow batch, the byte length of every segment (marks, role, text) gives the
segments' places by a cumulative sum; one buffer of the whole length is
allocated, constant marks and contents are scattered into it by index, and
the buffer becomes the Arrow column as it is.

Template of a turn: ``<|turn|>`` role ``<|text|>`` text ``<|end|>`` and a line
feed.  Control strings in roles and texts (``<|``, ``<s>``, ``</s>``,
``[INST]``, ``[/INST]``) get one backslash after their first character, those
that already have backslashes there get one more; taking one away restores
the content, whatever it was.

A conversation is written as one part or, where it crosses a batch, a range
partition or ``PART_BYTES``, as several parts in order: a conversation of any
length takes bounded memory, and formatting it is spread over tasks.  The
loss mask is the byte spans of the assistant texts in each part.

Defined cases: null roles and texts are empty; a null conversation id is a
conversation of its own, and null turns come first; turns with one number
follow each other by role and text; repeated rows are turns; empty tables
give no parts; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.llm.common import new_path

TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>\n"
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\])")
TURNS = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
PART_BYTES = 1 << 18
LOSS_ROLE = "assistant"

PARTS = "conv_id long, shard int, part long, n_turns long, formatted string, loss array<long>"
READ_BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and data of a string column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, the turns' ends, and the texts' starts."""
    n = len(role)
    (r_off, r_data), (t_off, t_data) = _bytes_of(role), _bytes_of(text)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(TURN), len(TEXT), len(END)
    lengths[:, 1], lengths[:, 3] = np.diff(r_off), np.diff(t_off)
    ends = np.cumsum(lengths.reshape(-1)).reshape(n, 5)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]), np.uint8)
    for k, mark in ((0, TURN), (2, TEXT), (4, END)):
        out[starts[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    for k, off, data in ((1, r_off, r_data), (3, t_off, t_data)):
        source = np.arange(off[0], off[-1])
        out[source + np.repeat(starts[:, k] - off[:-1], lengths[:, k])] = data[source]
    return out, ends[:, 4], starts[:, 3]


def parts_of(batch: pa.RecordBatch, shard: int, first: int) -> pa.RecordBatch:
    """The parts of one batch of sorted turns."""
    conv, is_loss = batch.column("conv_id"), pc.equal(batch.column("role"), LOSS_ROLE)
    out, ends, texts = assemble(escape(batch.column("role")), escape(batch.column("text")))
    starts = np.concatenate([[0], ends[:-1]])
    ids = pc.fill_null(conv, 0).to_numpy(zero_copy_only=False)
    none = pc.is_null(conv).to_numpy(zero_copy_only=False)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])
    conv_start = starts[np.flatnonzero(new)][np.cumsum(new) - 1]
    slab = (starts - conv_start) // PART_BYTES
    new[1:] |= slab[1:] != slab[:-1]
    at = np.flatnonzero(new)
    bounds = np.append(starts[at], len(out))
    of = np.cumsum(new) - 1
    loss = is_loss.to_numpy(zero_copy_only=False)
    spans = np.stack([texts, ends - len(END)], 1)[loss] - bounds[of[loss], None]
    per_part = np.bincount(of[loss], minlength=len(at)) * 2
    formatted = pa.Array.from_buffers(pa.large_string(), len(at),
                                      [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)])
    loss_lists = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(per_part)).astype(np.int32)), pa.array(spans.reshape(-1), pa.int64()))
    return pa.RecordBatch.from_arrays(
        [conv.take(pa.array(at)), pa.array(np.full(len(at), shard, np.int32)),
         pa.array(np.arange(first, first + len(at))), pa.array(np.diff(np.append(at, len(ids)))),
         formatted.cast(pa.string()), loss_lists],
        names=["conv_id", "shard", "part", "n_turns", "formatted", "loss"])


def format_table(turns: DataFrame) -> DataFrame:
    """Parts of all conversations of ``turns (conv_id, turn, role, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                out = parts_of(batch, shard, first)
                first += out.num_rows
                yield out
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    shards = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
            .select("conv_id", "role", "text").mapInArrow(run, PARTS))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Digests of every conversation, parsed from the written parts.

    A digest runs over a whole conversation in order, so the parts of one are
    streamed through one task, a part at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in READ_BACK.split(", ")]
        state: dict = {}

        def done() -> list:
            return [state["id"], state["turns"], state["all"].hexdigest(), state["chars"],
                    state["loss"].hexdigest(), state["formatted"]]

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            rows = []
            for conv, formatted, loss in zip(batch.column("conv_id").to_pylist(),
                                             batch.column("formatted").to_pylist(),
                                             batch.column("loss").to_pylist(), strict=True):
                if not state or state["id"] != conv:
                    if state:
                        rows.append(done())
                    state = {"id": conv, "turns": 0, "chars": 0, "formatted": 0,
                             "all": hashlib.sha256(), "loss": hashlib.sha256()}
                for role, text in TURNS.findall(formatted):
                    state["turns"] += 1
                    state["all"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                raw = formatted.encode()
                for s, e in zip(loss[::2], loss[1::2], strict=True):
                    text = unescape(raw[s:e].decode())
                    state["chars"] += len(text)
                    state["loss"].update(text.encode())
                state["formatted"] += len(formatted)
            if rows:
                yield batch_of(rows)
        if state:
            yield batch_of([done()])
    parts = spark.read.schema(PARTS).parquet(path)
    return (parts.repartition("conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "shard", "part")
            .select("conv_id", "formatted", "loss").mapInArrow(run, READ_BACK))


def round_trip(turns: DataFrame) -> DataFrame:
    """Format ``turns`` into a fresh folder and read it back."""
    path = new_path(turns.sparkSession, "chat")
    format_table(turns).write.parquet(path)
    return read_back(turns.sparkSession, path)
