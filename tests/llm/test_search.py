import math
import random
import re
from collections import Counter

import llm_cases as cases
import numpy as np
import pyarrow as pa
import pytest
from engage.llm import search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=20):
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    tfs = [(d, c, sum(c.values())) for d, c in tfs if c]
    n_docs, total = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(t for _, c, _ in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in tfs:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def found(spark, docs, items, k=20, block=S.ITEM_BLOCK, **shard):
    d = spark.createDataFrame([(*r, "x", 3) for r in docs], "doc_id long, text string, term string, shard int").repartition(3)
    i = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, rank int").coalesce(1)
    got = S.search(S.build_index(d, **shard), i, k, block).collect()
    return sorted(str((r.item_id, r["rank"], r.doc_id, r.score)) for r in got)


def collection(seed=2, n=250):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve", "x1", "THE"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(rng.choice([None, *range(900)]), " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for _ in range(n)]
    docs += [(5000 + i, "copy of w7, w9; w30") for i in range(60)] + [r[:2] for r in cases.rows()]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(30)]
    items += [(90, "W7-w9 copy"), (91, None), (92, " .,"), (93, "unheard words"), (7, "w7 w7 w7"), (7, "w7 w7 w7"),
              (None, "w0 the"), (95, cases.BASE), (96, "w0 " * 5000 + "w1"), (97, "a")]
    return docs, items


@pytest.mark.parametrize("k, block, shard", [(20, 1024, {}), (20, 7, {"shard_bytes": 900, "shard_docs": 16}),
                                             (3, 1024, {"shard_bytes": 1}), (1, 1024, {"shard_docs": 64})])
def test_equals_brute_force(spark, k, block, shard):
    docs, items = collection()
    assert found(spark, docs, items, k, block, **shard) == brute(docs, items, k)


def test_whole_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in cases.small(spark).collect()]
    items = [(r.item_id, r.text) for r in cases.small(spark, "benchmark").collect()]
    assert found(spark, docs, items) == brute(docs, items)


def test_terms_end_with_their_text():
    texts = ["ab", "cd", "", None, "E9-é", "\x7fx\x00y", "ab"]
    arr = pa.array([(t or "").encode() for t in texts], pa.binary())
    for a, ts in ((arr, texts), (arr.slice(1, 4), texts[1:5]), (arr.slice(2, 1), [""])):
        words, ends, docs, tfs, lengths = S.postings(a)
        starts = [0, *ends[:-1]]
        got = {(int(d), w.as_py().decode()): int(f) for w, s, e in zip(words, starts, ends)
               for d, f in zip(docs[s:e], tfs[s:e])}
        assert got == {(i, t): n for i, x in enumerate(ts) for t, n in Counter(terms(x)).items()}
        assert list(lengths) == [len(terms(x)) for x in ts]


def test_pair_bounds_skip_more_than_single_maxima():
    rng = np.random.default_rng(4)
    n, lists = 4000, {}
    for i in range(12):                         # maxima of a pair never meet in one document
        docs = np.flatnonzero(rng.random(n) < 0.4)
        lists[b"%d" % i] = docs, rng.integers(1, 40, len(docs)) + np.where(docs % 2 == i % 2, 100, 0)
    rare = np.array([5, 6, 7, 900])
    lists[b"r"] = rare, np.array([900, 800, 700, 600])
    units = [(b"%d" % i, 1, b"%d" % (i + 1), 1) for i in range(0, 12, 2)] + [(b"r", 1, None, 0)]
    high = {t: int(v.max()) for t, (_, v) in lists.items()}
    joint = {(a, b): int(S.intersect(lists[a], lists[b])[1].max()) for a, _, b, _ in units if b}
    loose = {p: high[p[0]] + high[p[1]] for p in joint}
    true = np.zeros(n, np.int64)
    for d, v in lists.values():
        true[d] += v
    theta = int(np.sort(true)[-3])
    want = sorted(zip(-np.sort(-true)[:3], np.argsort(-true, kind="stable")[:3]))
    reads = []
    for j in (joint, loose):
        docs, s, read = S.top_of_shard(units, lists, n, high, j, theta, 3)
        order = np.lexsort((docs, -s))[:3]
        assert sorted(zip(s[order], docs[order])) == want
        reads.append(read)
    assert reads[0] < reads[1]
    assert all(S.unit_bound(u, high, joint) <= sum(high.get(t, 0) for t in u[::2] if t) for u in units)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    index = S.build_index(cases.small(spark))
    assert S.search(index, none).collect() == []
    empty = S.build_index(cases.no_documents(spark))
    assert S.search(empty, cases.small(spark, "benchmark")).collect() == []
    blank = S.build_index(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"))
    assert S.search(blank, cases.small(spark, "benchmark")).collect() == []
