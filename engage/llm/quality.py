"""Quality rules with host-level verdicts.

Each document is measured and held against a few rules.  Failures are summed
by host (``source``), each host's failure rate is shrunk towards a beta prior
fitted to all hosts by the method of moments, and the verdict of the hosts
goes back to the documents by a join: a document that fails a rule is dropped
when its host is bad, and a clean document is kept wherever it comes from.
Documents that fail a base rule are dropped on any host.

Defined cases: a null text has no words; a null host is a host of its own; a
repeated row is measured and counted each time it occurs; empty tables give
empty results; other columns are carried through by ``filter_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from engage.llm.common import id_and_bytes, map_batches, staged

WINDOW = 8                      # words in a window of the repetition rule
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MAX_SYMBOLS_PER_100_WORDS = 10
MAX_DUP_LINE_PCT = 30
WORD_CHARS = (2.0, 16.0)        # accepted mean word length
MAX_HOST_RATE = 0.25            # shrunk failure rate above which a host is bad
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
FEATURES = ("doc_id long, source string, " + ", ".join(f"{m} long" for m in MEASURES))


def repeat_words(words: list[bytes]) -> int:
    """Words covered by windows of eight that occur twice or more.

    Window hashes find out whether anything repeats at all (equal windows have
    equal hashes); ranks by doubling (1, 2, 4, 8 words) then decide exactly.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    h = ids
    for width in (1, 2, 4):
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + (h[width:] ^ (h[width:] >> np.uint64(29)))
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    order: dict[bytes, int] = {}
    rank = np.fromiter((order.setdefault(w, len(order)) for w in words), np.int64, n)
    for width in (1, 2, 4):
        rank = np.unique(rank[:-width] * (int(rank.max()) + 1) + rank[width:], return_inverse=True)[1]
    starts = np.bincount(rank)[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    edge[:n - WINDOW + 1] += starts
    edge[WINDOW:] -= starts
    return int((np.cumsum(edge[:n]) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = text.split()
    packed = text.translate(None, SPACES)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(packed.decode("utf-8", "replace")),
            len(packed) - len(packed.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeat_words(words))


def _measure_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [measure(t) for t in batch.column("text").to_pylist()]
    cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), *cols],
                                      names=["doc_id", "source", *MEASURES])


def base_failed(col=F.col):
    n = col("n_words")
    return (n < MIN_WORDS) | (col("n_repeat_words") * 100 > n * MAX_REPEAT_PCT)


def rules(col=F.col) -> dict:
    """Document rules by name; true means that the document fails.  ``col``
    gives the column of a measure."""
    n, chars = col("n_words"), col("word_chars")
    return {
        "short": n < MIN_WORDS,
        "repetitive": col("n_repeat_words") * 100 > n * MAX_REPEAT_PCT,
        "symbols": col("n_symbols") * 100 > n * MAX_SYMBOLS_PER_100_WORDS,
        "dup_lines": col("n_dup_lines") * 100 > col("n_lines") * MAX_DUP_LINE_PCT,
        "word_length": (chars < n * WORD_CHARS[0]) | (chars > n * WORD_CHARS[1]),
    }


def n_failed(col=F.col):
    return sum((r.cast("int") for r in rules(col).values()), F.lit(0)).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """Measures, base verdict and number of failed rules of each document."""
    src = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", src.alias("source"))
    f = map_batches(id_and_bytes(rows, "source"), _measure_batch, FEATURES)
    return f.withColumn("base_failed", base_failed()).withColumn("n_failed", n_failed())


def beta_prior(mean: float, var: float) -> tuple[float, float]:
    """Beta prior with this mean and variance (method of moments).

    The strength is kept within [1, 1e6], so that hosts that all agree, or a
    single host, still give a proper prior.
    """
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    strength = mean * (1 - mean) / var - 1 if var > 0 else 1e6
    strength = min(max(strength, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def host_verdicts(feats: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Hosts with documents, failures, shrunk failure rate and verdict.

    The prior needs two moments of the host rates: one row comes to the driver.
    """
    hosts = feats.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum((F.col("n_failed") > 0).cast("long")).alias("n_bad"))
    rate = F.col("n_bad") / F.col("n_docs")
    m = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("var")).first()
    a, b = beta_prior(m["mean"] or 0.0, m["var"] or 0.0)
    shrunk = (F.col("n_bad") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_bad", shrunk > max_rate)


def _with_verdict(rows: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """Adds ``__host_bad``.  Only bad hosts are joined, one row each, written
    first so that the join knows their size and whole texts stay in place."""
    bad = staged(hosts.filter("host_bad").select(F.col("source").alias("__host"), F.lit(True).alias("__bad")),
                 "quality-hosts")
    j = rows.join(bad, F.col(host).eqNullSafe(F.col("__host")), "left")
    return (j.withColumn("__host_bad", F.coalesce(F.col("__bad"), F.lit(False)))
            .drop("__host", "__bad"))


def quality(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: measures, ``base_failed``, ``n_failed``,
    ``host_bad`` and ``kept``."""
    feats = staged(features(docs), "quality")
    j = _with_verdict(feats, host_verdicts(feats, max_rate))
    kept = ~F.col("base_failed") & ~(F.col("__host_bad") & (F.col("n_failed") > 0))
    return j.withColumn("host_bad", F.col("__host_bad")).withColumn("kept", kept).drop("__host_bad")


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures (``__q_`` before their names), staged: texts
    are measured once."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        cols = zip(*(measure(t or b"") for t in texts), strict=True)
        return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in cols)],
                                          names=[*batch.schema.names, *(f"__q_{m}" for m in MEASURES)])
    schema = StructType([*docs.schema.fields, *(StructField(f"__q_{m}", LongType()) for m in MEASURES)])
    return staged(map_batches(docs, run, schema), "quality-rows")


def filter_documents(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The kept documents with all their columns.

    Rows are never matched by id (ids may repeat or be null): the measures
    stand beside the row, and the host's verdict is joined to it.
    """
    def col(name):
        return F.col(f"__q_{name}")
    host = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = _measured(docs).withColumn("__q_failed", n_failed(col)).withColumn("__q_host", host)
    hosts = host_verdicts(rows.select(F.col("__q_host").alias("source"), F.col("__q_failed").alias("n_failed")), max_rate)
    marked = _with_verdict(rows, hosts, "__q_host")
    return marked.filter(~base_failed(col) & ~(F.col("__host_bad") & (F.col("__q_failed") > 0))).select(*docs.columns)
