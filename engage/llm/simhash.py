"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is cut into 16 segments of 4 bits and mapped to the
vector of their bit counts.  The Manhattan distance of two such vectors never
exceeds the Hamming distance of the fingerprints, so fingerprints at two or
fewer differing bits have vectors at Manhattan distance two or less.  On the
integer grid two such vectors always share a cell at distance one or less
from both, and each distinct fingerprint is put into its cell and the up to
32 neighbours.  The range join is then an equi-join on cells, with the exact
bit distance verified inside the join.

Exact copies are one fingerprint.  A cell with more than ``DENSE``
fingerprints (a large group of near copies) is never paired within itself:
its members are linked exactly through their single-bit variants, since two
fingerprints differ in at most two bits if and only if they share a variant.

Defined cases: a null or empty text has fingerprint zero and is linked like
any other; fewer words than a shingle are hashed as one sequence; repeated
rows are copies; rows with a null id belong to their component, whose id is
the smallest id that is not null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, map_batches, staged
from engage.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
DENSE = 64
BLOCK = 1 << 16                 # shingles whose bits are unpacked at a time
_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """Majority fingerprint of the k-word shingles (repeats included)."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= k:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BLOCK):
        part = h[i:i + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, extra: tuple = ()) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) and further columns."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, k) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(fp.view(np.int64)), *(batch.column(c) for c in extra)],
            names=["doc_id", "fp", *extra])
    src = id_and_bytes(docs, *extra)
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name in extra]
    return map_batches(src, run, ", ".join(["doc_id long", "fp long", *kept]))


def _popcounts(x):
    """Bit counts of the 16 nibbles, packed into the nibbles of a long."""
    ones = F.lit(0x1111111111111111)
    bits = [x if i == 0 else F.shiftrightunsigned(x, i) for i in range(4)]
    return sum((b.bitwiseAND(ones) for b in bits[1:]), bits[0].bitwiseAND(ones))


def cells(fps: DataFrame) -> DataFrame:
    """``cell, fp``: the popcount cell of each fingerprint and its neighbours
    at Manhattan distance one."""
    v = F.col("v")
    near = [v]
    for i in range(16):
        step = F.lit(1 << (4 * i))
        seg = F.shiftrightunsigned(v, 4 * i).bitwiseAND(F.lit(15))
        near += [F.when(seg < 4, v + step), F.when(seg > 0, v - step)]
    return (fps.select("fp", _popcounts(F.col("fp")).alias("v"))
            .select("fp", F.explode(F.array_compact(F.array(*near))).alias("cell")))


def _distance(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, max_bits: int = MAX_BITS, dense: int = DENSE) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all pairs at
    ``max_bits`` or fewer differing bits (at most 2, the reach of the grid)."""
    if max_bits != 2:
        raise ValueError("the grid and the variants are made for two differing bits")
    placed = cells(fps)
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"),
                                       F.max("fp").alias("b"))
    sizes = staged(sizes.filter("n > 1"), "simhash-cells")
    two = sizes.filter("n = 2").select("a", "b")
    more = staged(placed.join(sizes.filter("n > 2").select("cell", "n"), "cell"), "simhash-placed")
    left = more.filter(F.col("n") <= dense)
    right = left.select("cell", F.col("fp").alias("b"))
    pairs = (left.select("cell", F.col("fp").alias("a"))
             .join(right, (left.cell == right.cell) & (F.col("a") < F.col("b"))
                   & (_distance(F.col("a"), F.col("b")) <= max_bits))
             .select("a", "b"))
    crowd = more.filter(F.col("n") > dense).select("fp").distinct()
    variants = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit((1 << i) - ((1 << 64) if i == 63 else 0)))
                                for i in range(64)]
    seen = staged(crowd.select(F.col("fp").alias("b"), F.explode(F.array(*variants)).alias("variant")),
                  "simhash-variants")
    first = seen.groupBy("variant").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n"))
    first = staged(first.filter("n > 1").select("variant", "a"), "simhash-first")
    stars = (seen.join(first, "variant")
             .filter("a < b").select("a", "b").distinct())
    close = two.filter(_distance(F.col("a"), F.col("b")) <= max_bits)
    return close.unionByName(pairs).unionByName(stars).distinct()


def components(marked: DataFrame) -> DataFrame:
    """``fp, root, component_id`` of staged rows ``doc_id, fp``; the root
    fingerprint names the component."""
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = connected_components(links(classes.select("fp")))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = staged(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return staged(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components")


def simhash_groups(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs``."""
    marked = staged(fingerprints(docs, k), "simhash-fp")
    of = components(marked).select(F.col("fp").alias("__fp"), "component_id")
    return marked.join(of, F.col("fp") == F.col("__fp")).drop("__fp")


def keep_first(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One row of each component: the one with the smallest id (null ids come
    last), of rows that share it the one with the smallest row hash.

    The rows are numbered and written once; all joins run on numbers and
    fingerprints, and the rows that go leave by one anti join on the number.
    """
    whole = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    hashed = whole.withColumn("__hash", F.xxhash64(*[F.col(c) for c in docs.columns]))
    marked = staged(fingerprints(hashed, k, ("__row", "__hash")), "simhash-fp")
    of = components(marked.select("doc_id", "fp")).select(F.col("fp").alias("__fp"), "root")
    rooted = staged(marked.join(of, F.col("fp") == F.col("__fp"))
                    .select("root", "doc_id", "__hash", "__row"), "simhash-rooted")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__hash", "__row")
    kept = staged(rooted.groupBy("root").agg(F.min(order)["__row"].alias("__row")).select("__row"), "simhash-kept")
    gone = staged(rooted.select("__row").join(kept, "__row", "left_anti"), "simhash-gone")
    return whole.join(gone, "__row", "left_anti").select(*docs.columns)
