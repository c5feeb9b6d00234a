"""Token counts that follow edits.

The pre-tokens of a document are kept in a segment tree: leaves hold runs of
pre-tokens with their characters and tokens, inner nodes hold the sums of
their subtrees.  An edit finds its place by descending over the character
sums, re-cuts the text from a few characters before the edit until a cut falls
on an old one behind it, encodes the pre-tokens of that region only, and
updates the sums above the touched leaves.

Why that is whole: a byte-level BPE encodes each pre-token on its own; the
pre-token pattern looks no further back than the cut it starts from, and at
most one character past a pre-token's end.  So pre-tokens that end ``REACH``
characters before an edit stay, and once a new cut meets an old cut in the
unchanged rest, all later ones are the same.

``build_trees`` keeps the leaves of all documents in a table, and
``apply_edits`` applies a table of edits to it, round after round.

Defined cases: null and empty texts have no tokens; an edit past the end is
cut to the text; a very long pre-token is one leaf entry; rows are counted
each, repeated or not; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, map_batches, staged
from engage.llm.tokens import default_tokenizer, encoder

#: The pre-token pattern of the byte-level tokenizers, a fixed value.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
REACH = 4
LEAF = 64                       # pre-tokens of a new leaf
CACHE = 300_000

COUNTED = ("doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_chars_edited long, "
           "n_reencoded long")


class PieceCounts:
    """Tokens of pre-tokens, in a bounded table per worker."""

    def __init__(self, path: str):
        self.enc = encoder(path)
        self.known: dict[str, int] = {}

    def of(self, pieces: list[str]) -> list[int]:
        new = [x for x in set(pieces) if x not in self.known]
        if len(self.known) + len(new) > CACHE:
            use = set(pieces)
            self.known = {x: n for x, n in self.known.items() if x in use}
            new = [x for x in use if x not in self.known]
        if new:
            got = self.enc.tok.encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, (len(e.ids) for e in got), strict=True))
        return list(map(self.known.__getitem__, pieces))


class DocTree:
    """Segment tree over the pre-tokens of one document."""

    def __init__(self, text: str, counts: PieceCounts):
        self.counts = counts
        self.reencoded = 0
        self._build(PATTERN.findall(text))

    def _build(self, pieces: list[str], tokens: list[int] | None = None) -> None:
        tokens = self.counts.of(pieces) if tokens is None else tokens
        self.leaves = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.tokens = [tokens[i:i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = np.zeros(2 * self.size, np.int64)
        self.sums = np.zeros(2 * self.size, np.int64)
        n = len(self.leaves)
        self.chars[self.size:self.size + n] = [sum(map(len, x)) for x in self.leaves]
        self.sums[self.size:self.size + n] = [sum(x) for x in self.tokens]
        half = self.size
        while half > 1:
            for a in (self.chars, self.sums):
                a[half // 2:half] = a[half:2 * half:2] + a[half + 1:2 * half:2]
            half //= 2

    @classmethod
    def stored(cls, text: str, lengths: np.ndarray, tokens: np.ndarray, counts: PieceCounts) -> DocTree:
        """The tree of a text whose pre-tokens' characters and tokens are known:
        nothing is cut or encoded."""
        tree = cls.__new__(cls)
        tree.counts, tree.reencoded = counts, 0
        ends = np.cumsum(lengths).tolist()
        tree._build([text[a:b] for a, b in zip([0, *ends], ends, strict=False)], tokens.tolist())
        return tree

    def total(self) -> int:
        return int(self.sums[1])

    def length(self) -> int:
        return int(self.chars[1])

    def text(self) -> str:
        return "".join(map("".join, self.leaves))

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf that holds character ``at`` (the last one at the end), and the
        characters before it."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if at >= before + self.chars[node] and self.chars[node + 1]:
                before += int(self.chars[node])
                node += 1
        return node - self.size, before

    def _update(self, leaf: int) -> None:
        node = leaf + self.size
        self.chars[node] = sum(map(len, self.leaves[leaf]))
        self.sums[node] = sum(self.tokens[leaf])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end`` of the present text by ``new``."""
        start = min(max(start, 0), self.length())
        end = min(max(end, start), self.length())
        leaf, before = self._find(max(0, start - REACH))
        first, i = leaf, 0
        while i < len(self.leaves[leaf]) and before + len(self.leaves[leaf][i]) <= start - REACH:
            before += len(self.leaves[leaf][i])
            i += 1
        head, head_tokens = self.leaves[leaf][:i], self.tokens[leaf][:i]
        # take old pre-tokens until the region reaches past the edit, then on
        # until a new cut meets an old one
        old: list[str] = []
        place = before
        queue = self._from(leaf, i)
        last = (leaf, i)
        shift = len(new) - (end - start)
        while place < end + REACH:
            got = next(queue, None)
            if got is None:
                break
            old.append(got[0])
            place += len(got[0])
            last = got[1]
        while True:
            joined = "".join(old)
            region = joined[:start - before] + new + joined[end - before:]
            more = next(queue, None)
            ahead = more[0] if more else ""
            pieces, at, met = [], before, more is None
            for m in PATTERN.finditer(region + ahead):
                if more is not None and at == place + shift:
                    met = True
                    break
                pieces.append(m[0])
                at = before + m.end()
            if met or (more is not None and at == place + shift):
                break
            old.append(more[0])
            place += len(more[0])
            last = more[1]
        self.reencoded += len(pieces)
        tail, tail_tokens = self.leaves[last[0]][last[1]:], self.tokens[last[0]][last[1]:]
        if last[0] == first:
            tail, tail_tokens = self.leaves[first][last[1]:], self.tokens[first][last[1]:]
        for j in range(first + 1, last[0] + 1):
            self.leaves[j], self.tokens[j] = [], []
            self._update(j)
        self.leaves[first] = head + pieces + tail
        self.tokens[first] = head_tokens + self.counts.of(pieces) + tail_tokens
        if len(self.leaves[first]) > 8 * LEAF:
            self._build([p for x in self.leaves for p in x], [t for x in self.tokens for t in x])
        else:
            self._update(first)

    def _from(self, leaf: int, i: int) -> Iterator[tuple[str, tuple[int, int]]]:
        """Pre-tokens from a place on, each with the place behind it."""
        for k in range(leaf, len(self.leaves)):
            row = self.leaves[k]
            for j in range(i if k == leaf else 0, len(row)):
                yield row[j], (k, j + 1)


#: Edits of the registered query: number runs that may identify a person go.
REDACT = regex.compile(r"[0-9](?:[ .()-]{0,2}[0-9]){6,}|[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")
MASK = "[redacted]"


def redactions(text: str) -> Iterable[tuple[int, int, str]]:
    """Edits in the text as it stands, last one first, so places stay valid."""
    return [(m.start(), m.end(), MASK) for m in reversed(list(REDACT.finditer(text)))]


_COUNTS: dict[str, PieceCounts] = {}


def count_edited(docs: DataFrame, edits=redactions, tokenizer: str | None = None) -> DataFrame:
    """Tokens of each text before and after its edits, and the pre-tokens
    that the edits made it encode anew.  ``edits(text)`` gives the edits in the
    order in which they are made."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _COUNTS.setdefault(path, PieceCounts(path))
        for b in batches:
            rows = []
            for raw in b.column("text").to_pylist():
                text = raw.decode("utf-8", "replace")
                tree = DocTree(text, counts)
                n, made = tree.total(), list(edits(text))
                for e in made:
                    tree.edit(*e)
                rows.append((n, len(made), tree.total(), tree.length(), tree.reencoded))
            cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols],
                                             names=[f.split()[0] for f in COUNTED.split(", ")])
    return id_and_bytes(docs).mapInArrow(run, COUNTED)


# ---- kept trees
TREES = "doc_id long, text string, lengths binary, tokens binary, n_reencoded long"


def _tree_row(doc_id: int | None, tree: DocTree) -> dict:
    lengths = np.array([len(p) for x in tree.leaves for p in x], "<u4")
    tokens = np.array([n for x in tree.tokens for n in x], "<u4")
    return {"doc_id": doc_id, "text": tree.text(), "lengths": lengths.tobytes(), "tokens": tokens.tobytes(),
            "n_reencoded": tree.reencoded}


def _tree_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("doc_id", pa.int64()), ("text", pa.string()), ("lengths", pa.binary()), ("tokens", pa.binary()),
        ("n_reencoded", pa.int64())]))


def build_trees(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The leaves of every document's tree as a staged table: the text with the
    characters and tokens of its pre-tokens."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _COUNTS.setdefault(path, PieceCounts(path))
        for b in batches:
            texts = zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
            yield _tree_batch([_tree_row(d, DocTree(t.decode("utf-8", "replace"), counts)) for d, t in texts])
    return staged(id_and_bytes(docs).mapInArrow(run, TREES), "token-trees")


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The trees after a round of edits, staged.

    ``edits`` has ``doc_id, seq, start, end, text``: characters ``start`` to
    ``end`` of the document's present text become ``text`` (null: empty), in the
    order of ``seq``.  Only the regions that edits touch are cut and encoded
    (``n_reencoded`` of the round); a document without edits passes as it is.
    A document's edits are one list.  Every row with the id is edited; edits
    with a null id or of unknown documents do nothing.
    """
    path = tokenizer or default_tokenizer()
    edit = F.struct(*[F.col(c).cast("long").alias(c) for c in ("seq", "start", "end")],
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("new"))
    lists = edits.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.sort_array(F.collect_list(edit)).alias("edits"))
    rows = trees.join(lists, F.col("doc_id") == F.col("__id"), "left").drop("__id", "n_reencoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _COUNTS.setdefault(path, PieceCounts(path))
        for b in batches:
            out = []
            for r in b.to_pylist():
                made = r.pop("edits")
                if made:
                    tree = DocTree.stored(r["text"], np.frombuffer(r["lengths"], "<u4").astype(np.int64),
                                          np.frombuffer(r["tokens"], "<u4").astype(np.int64), counts)
                    for e in made:
                        tree.edit(e["start"], e["end"], e["new"])
                    r = _tree_row(r["doc_id"], tree)
                out.append({"n_reencoded": 0, **r})
            yield _tree_batch(out)
    return staged(rows.mapInArrow(run, TREES), "token-trees")


def tree_counts(trees: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_chars, n_reencoded`` of kept trees."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [int(np.frombuffer(t, "<u4").sum()) for t in batch.column("tokens").to_pylist()]
        c = [int(np.frombuffer(t, "<u4").sum()) for t in batch.column("lengths").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(c, pa.int64()),
                                           batch.column("n_reencoded")], names=["doc_id", "n_tokens", "n_chars", "n_reencoded"])
    return map_batches(trees, run, "doc_id long, n_tokens long, n_chars long, n_reencoded long")
