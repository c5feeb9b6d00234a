import numpy as np

import llm_cases as cases
from engage.llm import packing as P
from engage.llm.tokens import default_tokenizer


def plain(lengths, sizes, smallest):
    rate = {s: P.cost(s) / s for s in sizes if s >= smallest}
    bins, out = [], []
    for n in lengths:
        fit = [(cap - used, i) for i, (used, cap) in enumerate(bins) if cap - used >= n]
        if fit:
            least = min(fit)[0]
            i = max(j for r, j in fit if r == least)
        else:
            i = len(bins)
            bins.append([0, min((s for s in rate if s >= n), key=lambda s: (rate[s], s))])
        out.append(i)
        bins[i][0] += n
    return bins, out


def test_best_fit_leaves_the_least_room():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = np.sort(rng.integers(1, 65, rng.integers(1, 200)))[::-1]
        for smallest in (16, 32, 64):
            bins, offsets, used = P.best_fit(lengths, (16, 32, 64), smallest)
            want, _ = plain(lengths.tolist(), (16, 32, 64), smallest)
            assert sorted(used) == sorted(u for u, _ in want)


def test_joint_sizes_are_no_dearer_than_any_single_choice():
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = np.sort(rng.integers(1, 4097, 300))[::-1]
        bins, offsets, size = P.pack(lengths)
        total = sum(P.cost(float(s)) for s in dict(zip(bins.tolist(), size.tolist())).values())
        for only in P.SIZES[-1:]:
            _, _, used = P.best_fit(lengths, P.SIZES, only)
            assert total <= P.cost(float(only)) * len(used) + 1e-6


def test_pack_documents_places_every_token_once(spark):
    sizes = (64, 128, 256)
    for docs in (cases.documents(spark), cases.small(spark)):
        rows = P.pack_documents(docs, sizes, pool=50).collect()
        lengths = P.token_lengths(docs, default_tokenizer()).collect()
        assert sum(r.n_tokens for r in rows) == sum(r.n_tokens for r in lengths)
        bins, pieces = {}, {}
        for r in rows:
            bins.setdefault((r.pool, r.bin), []).append(r)
            pieces.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
        for got in bins.values():
            got.sort(key=lambda r: r.offset)
            at = 0
            for r in got:
                assert r.offset == at
                at += r.n_tokens
            assert {r.bin_size for r in got} == {min(s for s in sizes if s >= at)}
        for r in lengths:
            if r.doc_id is not None and r.doc_id != 12:
                at = 0
                for start, n in sorted(pieces[r.doc_id]):
                    assert start == at
                    at += n
                assert at == r.n_tokens


def test_large_ids_beside_a_null_id_stay_whole(spark):
    big = (1 << 60) + 1
    docs = spark.createDataFrame([(big, "some words"), (None, "other words"), (big + 2, None), (big, "x")],
                                 "doc_id long, text string")
    got = sorted(str(r.doc_id) for r in P.pack_documents(docs, pool=100).collect())
    assert got == sorted(map(str, [big, None, big + 2, big]))


def test_empty_table(spark):
    assert P.pack_documents(cases.no_documents(spark)).collect() == []
