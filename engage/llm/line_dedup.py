"""Line dedup by an exact set-similarity join, in DataFrame functions only.

The tokens of a line are its distinct lower-case words.  Two lines match at a
Jaccard similarity of ``NUM / DEN`` (0.8) or more.  A line is removed when an
earlier line of the corpus (by document, then line) matches it; lines of fewer
than ``MIN_TOKENS`` distinct words (those without any) stay.

* Tokens become longs whose high bits are the rarity rank of a hash bucket of
  words, so that sorting the longs orders a line's tokens by rarity.  The rank
  table has a fixed size.  (A token keeps 63 bits of its 64-bit hash; words
  are taken to differ where these do.)
* Lines with equal token sets are one class, which stands for its first line.
  Sets of fewer than ``NUM / (DEN - NUM)`` words match equal ones only (a set
  of four lies at 4/5 of a set of five), so their classes take no part in the
  join.
* Two matching sets share a token within their prefixes of
  ``n * (DEN - NUM) / DEN + 1`` rarest tokens.  The join on prefix tokens
  applies the length filter, the positional filter (what can still follow the
  first shared token) and a 128-bit parity signature, which bounds the
  symmetric difference from below.
* A token with more than ``DENSE`` classes is not paired within itself at
  once: its classes without a match are held against its most copied class
  first, and only those still without one against all others.
* What is left is verified on the whole token sets.

Defined cases: null and empty texts have no lines and stay as they are; rows
with one id are ordered by text, and rows that repeat id and text are one
document and keep the same lines; null ids come first; a document all of
whose worded lines go becomes empty (``dedup_documents`` drops it); empty
tables give empty results; other columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.llm.common import discard, new_path, staged

NUM, DEN = 4, 5                 # similarity of 0.8
MIN_TOKENS = 1
DENSE = 512
RANK_BITS = 14
SPACE = r"[\x20\x09-\x0D]+"
NO_ID = -(1 << 63)              # stands for a null id, first in order


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the keys ``__d, __t`` that tell its documents apart."""
    return docs.withColumns({
        "__d": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "__t": F.xxhash64(F.col("text").cast("string"))})


def _words(line: Column) -> Column:
    """Lower-case words of a line; a line with plain spaces only is cut without
    a regular expression."""
    low = F.lower(line)
    cut = F.when(low.rlike(r"[\x09-\x0D]"), F.split(low, SPACE)).otherwise(F.split(low, " "))
    return F.array_remove(cut, "")


def rarity(docs: DataFrame) -> Column:
    """Rarity rank of every word bucket, in a token's high bits, as one constant
    array of fixed size."""
    size = 1 << RANK_BITS
    one = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(" "))      # words do not reach over lines
    words = docs.select(F.explode(_words(one)).alias("w"))
    bucket = F.xxhash64("w").bitwiseAND(F.lit(size - 1)).cast("int")
    n = dict(map(tuple, words.groupBy(bucket.alias("b")).count().collect()))
    rank = [0] * size
    for place, b in enumerate(sorted(range(size), key=lambda b: (n.get(b, 0), b))):
        rank[b] = place << (63 - RANK_BITS)
    return F.split(F.lit(",".join(map(str, rank))), ",").cast("array<bigint>")


def _tokens(line: Column, ranks: Column) -> Column:
    """Sorted distinct tokens of a line, the rarest first."""
    def token(h: Column) -> Column:
        rank = F.get(ranks, h.bitwiseAND(F.lit((1 << RANK_BITS) - 1)).cast("int"))
        return rank.bitwiseOR(F.shiftrightunsigned(h, RANK_BITS + 1))
    hashes = F.transform(_words(line), lambda w: F.xxhash64(w))     # once for each word
    return F.sort_array(F.array_distinct(F.transform(hashes, token)))


def _signature(toks: Column, half: int) -> Column:
    """Parity of the tokens by 128 slots; the low or the high 64 slots."""
    one, slot = F.lit(1).cast("long"), lambda x: x.bitwiseAND(F.lit(63)).cast("int")
    mine = F.filter(toks, lambda x: x.bitwiseAND(F.lit(64)) == F.lit(64 * half))
    return F.aggregate(mine, F.lit(0).cast("long"),
                       lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", one, slot(x))))


def _lines(docs: DataFrame, ranks: Column, min_tokens: int) -> DataFrame:
    """Lines that can match, with class key, size, signature and prefix."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = _keyed(docs).select("__d", "__t", F.posexplode(F.split(text, "\n")).alias("line", "s"))
    # through a generator, so that the filter below does not compute the tokens again
    toks = rows.select(F.struct(F.col("__d").alias("d"), F.col("__t").alias("t"), "line").alias("p"),
                       F.explode(F.array(_tokens(F.col("s"), ranks))).alias("toks"))
    toks = toks.filter(F.size("toks") >= min_tokens)
    n = F.size("toks")
    return toks.select(
        "p", F.xxhash64("toks").alias("k1"), F.xxhash64(F.lit(1), "toks").alias("k2"), n.alias("n"),
        _signature(F.col("toks"), 0).alias("sig"), _signature(F.col("toks"), 1).alias("sig2"),
        F.slice("toks", F.lit(1), F.floor(n * (DEN - NUM) / DEN).cast("int") + 1).alias("prefix"))


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """``a, b, far``: postings ``tok, id, n, i, sig, sig2`` that pass all filters, the
    earlier class first, with the signatures' distance."""
    cols = ("tok", "id", "n", "i", "sig", "sig2")
    a = left.select(*[F.col(c).alias(f"a_{c}") for c in cols])
    b = right.select(*[F.col(c).alias(f"b_{c}") for c in cols])
    both = F.col("a_n") + F.col("b_n")
    far = sum(F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in ("sig", "sig2"))
    on = ((F.col("a_tok") == F.col("b_tok")) & (F.col("a_id") < F.col("b_id"))
          & (F.least("a_n", "b_n") * DEN >= F.greatest("a_n", "b_n") * NUM)
          & (F.least(F.col("a_n") - F.col("a_i"), F.col("b_n") - F.col("b_i")) * (NUM + DEN) >= both * NUM)
          & (far * (NUM + DEN) <= both * (DEN - NUM)))
    return a.join(b, on).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), far.alias("far")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _token_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, ranks: Column, work: str,
                few: bool = False) -> DataFrame:
    """``id, toks`` of the given classes, read from the texts once more."""
    places = ids.join(classes.select(F.col("id").alias("c_id"), "p"), F.col("id") == F.col("c_id")).select("id", "p.*")
    wanted = places.groupBy("d", "t").agg(F.collect_list(F.struct("line", "id")).alias("lines"))
    if few:     # written first: its size is known then, and the texts stay where they are if it is small
        wanted = staged(wanted, "wanted", work)
    text = F.split(F.col("text").cast("string"), "\n")
    keyed = _keyed(docs.select("doc_id", "text"))
    cut = (keyed.join(wanted, (F.col("__d") == F.col("d")) & (F.col("__t") == F.col("t")))
           .select("d", "t", "lines", F.explode(F.array(text)).alias("all")))
    lines = cut.select("d", "t", F.explode(F.transform("lines", lambda x: F.struct(
        x["line"].alias("line"), x["id"].alias("id"), F.get("all", x["line"]).alias("s")))).alias("x"))
    toks = lines.select("x.id", _tokens(F.col("x.s"), ranks).alias("toks"))
    return staged(toks.groupBy("id").agg(F.first("toks").alias("toks")), "tokens", work)


def _holding(pairs: DataFrame, toks: DataFrame) -> DataFrame:
    """``id``: later classes of the pairs that hold on the whole token sets."""
    x = toks.select(F.col("id").alias("xi"), F.col("toks").alias("x"))
    y = toks.select(F.col("id").alias("yi"), F.col("toks").alias("y"))
    joined = pairs.select("a", "b").join(x, F.col("a") == F.col("xi")).join(y, F.col("b") == F.col("yi"))
    shared = F.size(F.array_intersect("x", "y"))
    holds = shared * (DEN + NUM) >= (F.size("x") + F.size("y")) * NUM
    return joined.filter(holds).select(F.col("b").alias("id")).distinct()


def _verified(pairs: DataFrame, toks: DataFrame, work: str) -> DataFrame:
    """``id``: classes with an earlier match.  One is enough, so each class is
    held against its closest candidate first, and against the others only if
    that one fails."""
    best = pairs.groupBy("b").agg(F.min(F.struct("far", "a")).alias("m")).select("m.a", "b")
    found = staged(_holding(best, toks), "closest", work)
    others = pairs.join(found, F.col("b") == F.col("id"), "left_anti")
    return staged(found.unionByName(_holding(others, toks)), "found", work)


def removed_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, dense: int = DENSE) -> DataFrame:
    """``d, t, gone``: the removed lines of each document that loses any.

    What is staged on the way goes when the result is written, so it does not
    take disk beside later work."""
    work = new_path(docs.sparkSession, "lines")
    ranks = rarity(docs)
    lines = staged(_lines(docs, ranks, min_tokens), "all", work)
    classes = lines.groupBy("k1", "k2").agg(
        F.min("p").alias("p"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("sig").alias("sig"), F.first("sig2").alias("sig2"), F.first("prefix").alias("prefix"))
    # numbered by place, once, and written; the numbers stand for the classes
    classes = classes.repartitionByRange("p").sortWithinPartitions("p")
    classes = staged(classes.withColumn("id", F.monotonically_increasing_id()), "classes", work)
    joined = classes.filter(F.col("n") * (DEN - NUM) >= NUM)
    posted = joined.select("id", "n", "sig", "sig2", F.posexplode("prefix").alias("i", "tok"))
    hot = staged(joined.select(F.explode("prefix").alias("h_tok")).groupBy("h_tok").agg(
        F.count(F.lit(1)).alias("m")).filter(F.col("m") > dense).select("h_tok"), "hot", work)
    few = posted.join(hot, F.col("tok") == F.col("h_tok"), "left_anti")
    many = joined.select("id", "n", "sig", "sig2", "copies", F.posexplode("prefix").alias("i", "tok"))
    many = staged(many.join(hot, F.col("tok") == F.col("h_tok"), "left_semi"), "many", work)
    entry = F.struct("id", "n", "sig", "sig2", "i")
    heads = many.groupBy("tok").agg(F.max_by(entry, "copies").alias("hub"), F.min(entry).alias("first"))
    heads = heads.select("tok", F.explode(F.array_distinct(F.array("hub", "first"))).alias("e")).select("tok", "e.*")
    pairs = staged(_pairs(few, few).unionByName(_pairs(heads, many)).distinct(), "pairs", work)
    toks = _token_sets(_ends(pairs), classes, docs, ranks, work)
    found = _verified(pairs, toks, work)
    rest = many.join(found.withColumnRenamed("id", "f_id"), F.col("id") == F.col("f_id"), "left_anti")
    pairs = staged(_pairs(many, rest), "rest", work)
    later = found.limit(0)
    if not pairs.isEmpty():
        new = _ends(pairs).join(toks.select(F.col("id").alias("t_id")), F.col("id") == F.col("t_id"), "left_anti")
        later = _verified(pairs, toks.unionByName(_token_sets(new, classes, docs, ranks, work, few=True)), work)
    matched = found.unionByName(later).distinct()
    matched = matched.select(F.col("id").alias("m_id"))
    copied = classes.join(matched, F.col("id") == F.col("m_id"), "left").filter("copies > 1 or m_id is not null")
    copied = staged(copied.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("p").alias("first"),
                                  F.col("m_id").isNotNull().alias("hit")), "copied", work)
    gone = (lines.select("p", "k1", "k2").join(copied, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")))
            .filter(F.col("hit") | (F.col("p") > F.col("first"))))
    gone = staged(gone.select("p.*").groupBy("d", "t").agg(F.collect_set("line").alias("gone")), "lines-gone")
    discard(docs.sparkSession, work)
    return gone


def dedup_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, dense: int = DENSE) -> DataFrame:
    """``docs`` with removed lines cut from ``text``, and ``n_lines`` and
    ``n_removed`` beside it."""
    gone = removed_lines(docs, min_tokens, dense).select(
        F.col("d").alias("__gd"), F.col("t").alias("__gt"), F.col("gone").alias("__gone"))
    # the packed size of the removed lines says little of what a broadcast would hold
    j = _keyed(docs).join(gone.hint("merge"), (F.col("__d") == F.col("__gd")) & (F.col("__t") == F.col("__gt")), "left")
    parts = F.split(F.col("text").cast("string"), "\n")
    left = F.filter(parts, lambda x, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return (j.withColumn("n_lines", F.coalesce(F.size(parts), F.lit(0)).cast("long"))
            .withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
            .withColumn("text", text).drop("__d", "__t", "__gd", "__gt", "__gone"))


def dedup_documents(docs: DataFrame, min_tokens: int = MIN_TOKENS, dense: int = DENSE) -> DataFrame:
    """The documents with removed lines cut (and ``n_chars`` renewed); those
    that lost lines and have no word left are dropped."""
    inner = docs.withColumnsRenamed({c: f"__own_{c}" for c in ("n_lines", "n_removed") if c in docs.columns})
    out = dedup_lines(inner, min_tokens, dense)
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    out = out.filter(~((F.col("n_removed") > 0) & empty))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    out = out.drop("n_lines", "n_removed")
    out = out.withColumnsRenamed({f"__own_{c}": c for c in ("n_lines", "n_removed") if c in docs.columns})
    return out.select(*docs.columns)
