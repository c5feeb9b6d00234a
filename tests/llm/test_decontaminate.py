import random

import numpy as np

import llm_cases as cases
from engage.llm import decontaminate as D


def edits(item, text):
    """Least edits of item against any part of text (plain dynamic program)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    return min(row)


def mutate(rng, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcxyz ")
        elif kind == 1:
            out.insert(at, rng.choice("abcxyz "))
        else:
            del out[at]
    return "".join(out)


def test_matches_equal_brute_force():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 30)))) for i in range(12)]
    index = D.Index(items)
    filler = lambda n: " ".join(word() for _ in range(n))
    some = 0
    for trial in range(60):
        i, plain = items[trial % 12]
        k = int(len(plain) * D.MAX_EDIT)
        text = D.normalised(f"{filler(rng.randrange(20))} {mutate(rng, plain, rng.randrange(0, 2 * k + 3))} {filler(10)}")
        got = {m[0]: m for m in index.matches(text)}
        for j, p in items:
            e = edits(p, text)
            assert (j in got) == (e <= budget(p)), (j, e, p)
            if j in got:
                some += 1
                assert got[j][3] == e
                assert edits(p, text[got[j][1]:got[j][2]]) == e
    assert some > 20


def budget(item):
    """The rule as stated, not as the index holds it."""
    return len(item) * 8 // 100


def test_items_of_every_length_are_found_at_their_whole_budget():
    rng = random.Random(6)
    draw = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    for m in range(20, 64):
        item = draw(m)
        index = D.Index([(1, item)])
        for trial in range(12):
            text = draw(30) + mutate(rng, item, trial % 4 + budget(item) - 1) + draw(30)
            e = edits(item, text)
            got = index.matches(text)
            assert bool(got) == (e <= budget(item)) and (not got or got[0][3] == e), (item, text)


def test_short_items_match_whole_words_only():
    rng = random.Random(7)
    items = [(i, D.normalised(" ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
                                       for _ in range(rng.randint(1, 4))))) for i in range(60)]
    index = D.Index(items)
    seen = 0
    for _ in range(300):
        text = D.normalised(" ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
                                     for _ in range(rng.randint(0, 12))))
        got = {m[0]: m for m in index.matches(text)}
        for j, p in items:
            if len(p) < 20:
                assert (j in got) == (f" {p} " in f" {text} "), (p, text)
                seen += j in got
                assert j not in got or text[got[j][1]:got[j][2]] == p and got[j][3] == 0
    assert seen > 100


def test_alignment_equals_plain_program():
    rng = random.Random(5)
    for _ in range(200):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(5, 30)))
        region = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 4))) + mutate(rng, item, rng.randrange(4)) \
            + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 4)))
        e = edits(item, region)
        got = D.alignment(D.points(item), D.points(region), 5)
        assert (got is None) == (e > 5) and (got is None or got[0] == e)


def test_gram_hashes_tell_grams_apart():
    codes = D.points("abcdefghijabcdefghijk")
    for q in (1, 2, 3, 7, 10, 12):
        h = D.gram_hashes(codes, q)
        assert len(h) == len(codes) - q + 1
        grams = [codes[i:i + q].tobytes() for i in range(len(h))]
        assert len(set(h.tolist())) == len(set(grams))
        assert all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(h)) for j in range(i))
    assert len(D.gram_hashes(np.empty(0, np.uint32))) == 0


def test_documents_with_items_go_and_others_stay(spark):
    bench = cases.small(spark, "benchmark")
    items = bench.collect()
    rows = [(i, f"Some words before. {r.text.upper()}  and   after it.", 1) for i, r in enumerate(items)]
    rows += [(1000 + i, cases.BASE, 1) for i in range(3)] + [(2000, None, 1), (None, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches long")
    for block in (D.BLOCK_CHARS, 500):
        found = {r.doc_id: [m.item_id for m in r.matches] for r in D.leaks(docs, bench, block).collect()}
        assert all(items[i].item_id in found[i] for i in range(len(items)))
        assert all(found[k] == [] for k in (1000, 1001, 1002, 2000, None))
        kept = D.clean_documents(docs, bench, block)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1000", "1001", "1002", "2000", "None"])


def test_empty_tables(spark):
    bench = cases.small(spark, "benchmark")
    assert D.leaks(cases.no_documents(spark), bench).collect() == []
    assert all(r.matches == [] for r in D.leaks(cases.documents(spark), bench.limit(0)).collect())
    edge = spark.createDataFrame([(1, None), (2, ""), (None, "tiny")], "item_id long, text string")
    assert all(r.matches == [] for r in D.leaks(cases.documents(spark), edge).collect())
