"""Interaction audit of five document filters.

Five filters judge whole texts: A short, B repetitive words, C upper-case
letters, D symbols, E a text that a smaller ``doc_id`` already holds.  The
audit counts, for each part of the corpus and each order of the filters, what
every step keeps and removes.  Which filters a document fails is one mask of
five bits, so the corpus is reduced once to counts of (part, mask, labels);
all 120 orders follow from these few rows.

Filter E is decided by compressed radix tries.  Each scan task puts its texts,
in slices of at most ``SLICE_BYTES``, into a trie whose terminals hold the
smallest id and are numbered; documents keep only their terminal's number,
and each distinct text of a slice goes on once (this pre-aggregates groups of
copies).  Text prefixes are then refined where they carry more than
``RANGE_BYTES``: a heavy prefix is extended to what all of its texts share and
one byte more, until every prefix is light or holds one text only.  The
texts are dealt by these ranges, each task merges its ranges in one trie, and
reads it again for the smallest id of each terminal, which goes back to the
documents by the terminal's number: no id list of a group of copies is ever
built.  A range meets a hot text once per slice that holds it.

Bounds: a task holds one slice, or the distinct texts of the ranges dealt to
it (``RANGE_BYTES`` each unless a single text is longer); the driver holds one
prefix of a few bytes per range.

Defined cases: a null text is empty (and equals an empty one); a null
``doc_id`` is smaller than none, so its row never makes another a copy and is
no copy itself; rows that repeat an id are not copies of each other; a null
part is the empty string; a document with several labels counts as good
(toxic) if one of them says so, one without labels as neither; an empty table
has no parts and gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, map_batches, staged

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PCT = 80
MAX_UPPER_PCT = 10
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))
CONTINUATION = bytes(range(0x80, 0xC0))     # UTF-8 bytes that start no code point
SLICE_BYTES = 1 << 24
RANGE_BYTES = 1 << 25
HEAD = 32                       # bytes of a text kept beside it to refine prefixes

_SLICED = ("text binary, size long, head binary, min_id long, doc_id long, part string, mask int, "
           "slice long, terminal int")


def text_mask(text: bytes) -> int:
    """Bits of the failed filters among A to D (A is bit 0)."""
    words = text.split()
    n = len(words)
    points = len(text.translate(None, CONTINUATION))
    return ((n < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PCT * n) << 1
            | (100 * (len(text) - len(text.translate(None, UPPER))) > MAX_UPPER_PCT * points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Trie:
    """Compressed radix trie over bytes.

    A node is ``[label, children by first byte, terminal]``; terminals are
    numbered from 0 and hold the smallest id (None: no id yet).
    """

    def __init__(self) -> None:
        self.root: list = [b"", {}, -1]
        self.min_ids: list[int | None] = []

    def insert(self, text: bytes, doc_id: int | None) -> int:
        """Number of the text's terminal, new or old."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, -1]
                node[1][text[at]] = child
                node = child
                break
            label = child[0]
            if not text.startswith(label, at):
                k = common_length(label, text[at:at + len(label)])
                upper = [label[:k], {label[k]: child}, -1]
                child[0] = label[k:]
                node[1][text[at]] = upper
                child, label = upper, upper[0]
            node, at = child, at + len(label)
        if node[2] < 0:
            node[2] = len(self.min_ids)
            self.min_ids.append(doc_id)
        elif doc_id is not None:
            least = self.min_ids[node[2]]
            if least is None or doc_id < least:
                self.min_ids[node[2]] = doc_id
        return node[2]

    def terminals(self) -> Iterator[tuple[int, bytes]]:
        """(terminal, text) in the order of the texts."""
        stack = [(self.root, b"")]
        while stack:
            node, above = stack.pop()
            text = above + node[0]
            if node[2] >= 0:
                yield node[2], text
            stack.extend((node[1][b], text) for b in sorted(node[1], reverse=True))


def slices(batches: Iterable[pa.RecordBatch], max_bytes: int) -> Iterator[list[dict]]:
    """The rows in runs of at most ``max_bytes`` of text (one row at least)."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["text"]) + 1
            if held and size + n > max_bytes:
                yield held
                held, size = [], 0
            held.append(row)
            size += n
    if held:
        yield held


def _slice_rows(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Documents with their terminal, and the terminals with their texts."""
    task = TaskContext.get().partitionId() << 32
    schema = pa.schema([("text", pa.binary()), ("size", pa.int64()), ("head", pa.binary()), ("min_id", pa.int64()),
                        ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
                        ("slice", pa.int64()), ("terminal", pa.int32())])
    for k, rows in enumerate(slices(batches, max_bytes)):
        trie, masks, terminals = Trie(), [], []
        for r in rows:
            t = trie.insert(r["text"], r["doc_id"])
            if t == len(masks):
                masks.append(text_mask(r["text"]))
            terminals.append(t)
        n = len(rows)
        none = lambda kind: pa.nulls(n, kind)
        yield pa.RecordBatch.from_arrays(
            [none(pa.binary()), none(pa.int64()), none(pa.binary()), none(pa.int64()),
             pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["part"] for r in rows], pa.string()),
             pa.array([masks[t] for t in terminals], pa.int32()),
             pa.array([task + k] * n, pa.int64()), pa.array(terminals, pa.int32())], schema=schema)
        del rows
        numbers, texts = zip(*trie.terminals(), strict=True)
        n = len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.binary()), pa.array(map(len, texts), pa.int64()),
             pa.array([t[:HEAD] for t in texts], pa.binary()),
             pa.array([trie.min_ids[i] for i in numbers], pa.int64()),
             none(pa.int64()), none(pa.string()), none(pa.int32()),
             pa.array([task + k] * n, pa.int64()), pa.array(numbers, pa.int32())], schema=schema)


def _cells(batches: Iterator[pa.RecordBatch], column: str, heavy: list[bytes],
           lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """Sizes and ends of the texts below heavy prefixes, by longer prefix."""
    for batch in batches:
        found: dict[bytes, list] = {}
        for t, size in zip(batch.column(column).to_pylist(), batch.column("size").to_pylist(), strict=True):
            i = bisect_right(heavy, t) - 1
            if i >= 0 and t.startswith(heavy[i]):
                cell = found.setdefault(t[:lengths[i]], [0, t, t])
                cell[0] += size + 1
                cell[1], cell[2] = min(cell[1], t), max(cell[2], t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), pa.array([c[0] for c in found.values()], pa.int64()),
             pa.array([c[1] for c in found.values()], pa.binary()),
             pa.array([c[2] for c in found.values()], pa.binary())], names=["prefix", "size", "least", "most"])


def range_starts(terminals: DataFrame, range_bytes: int = RANGE_BYTES) -> list[bytes]:
    """First prefixes of the ranges, ascending, the empty one first.

    A prefix that carries more than ``range_bytes`` is extended to what its
    texts share and one byte more; as long as ``HEAD`` bytes tell the texts
    apart only these are read.  Light neighbours are put together.
    """
    light: list[tuple[bytes, int]] = []
    heavy = {b"": (0, "head")}                  # prefix: bytes that its texts share, column to read
    while heavy:
        found = {}
        for column in {c for _, c in heavy.values()}:
            keys = sorted(p for p, (_, c) in heavy.items() if c == column)
            lengths = [heavy[p][0] + 1 for p in keys]
            rows = terminals.select(column, "size").mapInArrow(
                lambda b, column=column, keys=keys, lengths=lengths: _cells(b, column, keys, lengths),
                "prefix binary, size long, least binary, most binary")
            for r in rows.groupBy("prefix").agg(F.sum("size").alias("size"), F.min("least").alias("least"),
                                                F.max("most").alias("most")).collect():
                found[bytes(r.prefix)] = (r.size, bytes(r.least), bytes(r.most), column)
        heavy = {}
        for prefix, (size, least, most, column) in found.items():
            cut = column == "head" and len(least) == len(most) == HEAD and least == most
            if size <= range_bytes or (least == most and not cut):
                light.append((prefix, size))
            else:
                heavy[prefix] = (HEAD - 1 if cut else common_length(least, most), "text" if cut else column)
    starts, held = [b""], 0
    for prefix, size in sorted(light):
        if held and held + size > range_bytes:
            starts.append(prefix)
            held = 0
        held += size
    return starts


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest id of each terminal's text, over one range after the other."""
    def flags(trie: Trie, refs: list[list]) -> pa.RecordBatch:
        out = [(s, t, trie.min_ids[i]) for i, _ in trie.terminals() for s, t in refs[i]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64()), strict=True)],
            names=["slice", "terminal", "least"])
    trie, refs, now = Trie(), [], None
    for batch in batches:
        for r in batch.to_pylist():
            if r["range"] != now:
                if refs:
                    yield flags(trie, refs)
                trie, refs, now = Trie(), [], r["range"]
            i = trie.insert(r["text"], r["min_id"])
            if i == len(refs):
                refs.append([])
            refs[i].append((r["slice"], r["terminal"]))
    if refs:
        yield flags(trie, refs)


def failure_masks(docs: DataFrame, part: str = "lang", slice_bytes: int = SLICE_BYTES,
                  range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``doc_id, part, mask``: the filters that each document fails (A is bit
    0, E bit 4)."""
    src = id_and_bytes(docs.select("doc_id", "text", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")),
                       "part")
    marked = staged(src.mapInArrow(lambda b: _slice_rows(b, slice_bytes), _SLICED), "audit-slices")
    rows = marked.filter("text is null").select("doc_id", "part", "mask", "slice", "terminal")
    terminals = marked.filter("text is not null")
    starts = range_starts(terminals, range_bytes)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = [bisect_right(starts, t) - 1 for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())],
                                          names=[*batch.schema.names, "range"])
    dealt = map_batches(terminals.select("slice", "terminal", "min_id", "text"), deal,
                        "slice long, terminal int, min_id long, text binary, range int")
    # one range a partition
    least = (dealt.repartitionById(len(starts), "range").sortWithinPartitions("range")
             .mapInArrow(_merged, "slice long, terminal int, least long"))
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    return rows.join(least, ["slice", "terminal"]).select(
        "doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(copy, 4)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: the corpus as a few counts."""
    said = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (masks.join(said, masks.doc_id == said.id, "left")
            .groupBy("part", "mask", flag("good"), flag("toxic")).agg(F.count(F.lit(1)).alias("n")))


def filter_steps(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    steps = len(FILTERS)
    k = F.col("k")
    cells = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(orders) * steps - 1))).alias("k"))
    cells = cells.select("part", "mask", "good", "toxic", "n", (F.pmod(k, F.lit(steps)) + 1).alias("step"),
                         F.element_at(F.lit(orders), F.floor(k / steps).cast("int") + 1).alias("filter_order"))
    bit = [F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, {j}, 1)) - 1)") for j in range(1, steps + 1)]
    own = F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)")
    before = sum((F.when(F.col("step") > j + 1, b).otherwise(0) for j, b in enumerate(bit)), F.lit(0))
    cells = cells.withColumn("own", own).withColumn("fails_before", F.col("mask").bitwiseAND(before) != 0)
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    here = fails & ~F.col("fails_before")

    def total(when, name):
        return F.sum(F.when(when, F.col("n")).otherwise(0)).cast("long").alias(name)
    out = cells.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~F.col("fails_before"), "kept"), total(here, "removed"),
        total(fails & F.col("fails_before"), "redundant"), total(F.col("mask") == F.col("own"), "unique_fails"),
        total(here & (F.col("good") == 1), "good_lost"), total(here & (F.col("toxic") == 1), "toxic_lost"))
    letter = F.expr("substring(filter_order, step, 1)")
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", slice_bytes: int = SLICE_BYTES,
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The counts of every step of every order, by part."""
    masks = failure_masks(docs, part, slice_bytes, range_bytes)
    return filter_steps(staged(mask_counts(masks, labels), "audit-counts"))
