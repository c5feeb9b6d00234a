import random

import numpy as np
import xxhash

import llm_cases as cases
from engage.llm import simhash as S
from engage.llm.components import connected_components


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(fps):
    nodes = sorted(set(fps))
    root = {f: f for f in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in nodes}


def check(groups, rows):
    fps = {}
    for d, t in rows:
        fps.setdefault(t, brute_fp(t))
    roots = brute_roots(fps.values())
    least = {}
    for d, t in rows:
        if d is not None:
            r = roots[fps[t]]
            least[r] = min(d, least.get(r, d))
    want = sorted((str(d), fps[t], str(least.get(roots[fps[t]]))) for d, t in rows)
    assert sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in groups.collect()) == want


def test_groups_equal_brute_force(spark):
    for docs in (cases.documents(spark), cases.small(spark)):
        check(S.simhash_groups(docs), [(r.doc_id, r.text) for r in docs.collect()])


def _clusters():
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        c = rng.getrandbits(64)
        fps.add(c)
        for _ in range(40):
            x = c
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    return sorted(fps)


def test_links_connect_as_brute_force_with_and_without_dense_cells(spark):
    fps = _clusters()
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute_roots(fps)
    classes = {}
    for f, r in want.items():
        classes.setdefault(r, set()).add(f)
    for dense in (2, 5, 64):
        links = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in S.links(table, dense=dense).collect()]
        assert all(bin(a ^ b).count("1") <= 2 for a, b in links)
        got = {f: f for f in fps}
        for a, b in links * 8:
            got[a] = got[b] = min(got[a], got[b])
        for _ in range(60):
            for a, b in links:
                got[a] = got[b] = min(got[a], got[b])
        found = {}
        for f, r in got.items():
            found.setdefault(r, set()).add(f)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, classes.values()))


def test_components_of_a_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1200), 1000)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_first_keeps_one_row_of_each_group(spark):
    docs = cases.documents(spark)
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    roots = brute_roots({brute_fp(r.text) for r in docs.collect()})
    of = {}
    for r in docs.collect():
        of.setdefault(roots[brute_fp(r.text)], []).append(r.doc_id)
    assert len(rows) == len(of)
    want = [min((i for i in ids if i is not None), default=None) for ids in of.values()]
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, want))
    assert {roots[brute_fp(r.text)] for r in rows} == set(of)


def test_repeated_and_null_ids_lose_no_group(spark):
    a, b = cases.BASE, "quite another text of its own with some words"
    assert bin(brute_fp(a) ^ brute_fp(b)).count("1") > 2
    rows = [(1, a), (1, b), (2, a), (3, b)]
    got = S.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted([(1, a), (1, b)])
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=3000)
    near = next(" ".join(x) for x in (base[:i] + ["new"] + base[i + 1:] for i in range(3000))
                if 0 < bin(brute_fp(" ".join(x)) ^ brute_fp(" ".join(base))).count("1") <= 2)
    rows = [(None, " ".join(base)), (None, near), (None, a), (7, a)]
    got = S.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 2 and (7, a) in map(tuple, got) and (None, a) not in map(tuple, got)


def test_empty_table(spark):
    assert S.simhash_groups(cases.no_documents(spark)).collect() == []
    assert S.keep_first(cases.no_documents(spark)).collect() == []
