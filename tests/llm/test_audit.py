import itertools
import random
import re
from collections import defaultdict

import llm_cases as cases
from engage.llm import audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_masks(rows):
    first = defaultdict(set)
    for d, t, _ in rows:
        if d is not None:
            first[t or ""].add(d)
    out = []
    for d, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        m = ((len(w) < 100) + 2 * (100 * len(set(w)) < 80 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
             + 8 * bool(re.search(r"[#$%&*|]", t)) + 16 * (d is not None and min(first[t], default=d) < d))
        out.append((d, part or "", m))
    return out


def brute_audit(rows, labels):
    masks = brute_masks(rows)
    out, shap = {}, defaultdict(int)
    for part in {p for _, p, _ in masks}:
        for order in itertools.permutations("ABCDE"):
            alive = [True] * len(masks)
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                c = dict.fromkeys(["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"], 0)
                for i, (d, p, m) in enumerate(masks):
                    if p != part:
                        continue
                    c["unique_fails"] += m == bit
                    if m & bit:
                        c["redundant"] += not alive[i]
                        if alive[i]:
                            alive[i] = False
                            c["removed"] += 1
                            c["good_lost"] += any(q == 1 for q, _ in labels.get(d, []))
                            c["toxic_lost"] += any(x == 1 for _, x in labels.get(d, []))
                    c["kept"] += alive[i]
                out[part, "".join(order), step] = c
                shap[part, f] += c["removed"]
    for (part, order, step), c in out.items():
        c["shapley"] = shap[part, order[step - 1]]
    return out


def varied():
    rng = random.Random(5)
    base = [r[:3] for r in cases.rows()]
    words = [f"w{i}" for i in range(150)]
    texts = [" ".join(rng.choices(words, k=rng.choice([30, 120]))) for _ in range(12)] + ["", None, "Ab", "A b"]
    long = "shared header " * 300
    texts += [long + x for x in ("a", "ab", "b", "")] + [" ".join(words), " ".join(words) + " $"]
    return base + [(rng.choice([None, *range(40, 90)]), rng.choice(texts), rng.choice(["en", "de", None, ""]))
                   for _ in range(150)]


LABELS = {1: [(1, 0)], 5: [(0, 1), (1, 1)], 40: [(1, 1)], 41: [(None, None)], 44: [(1, 0), (1, 0)], 9999: [(1, 1)]}


def label_frame(spark):
    return spark.createDataFrame([(d, q, t, "x") for d, v in LABELS.items() for q, t in v] + [(None, 1, 1, "x")],
                                 "doc_id long, quality int, toxic int, text string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "s") for r in rows], "doc_id long, text string, lang string, part int, slice string")


def test_trie_holds_what_was_put_in():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 9))) for _ in range(3000)]
    trie, least, number = A.Trie(), {}, {}
    for i, t in enumerate(texts):
        d = rng.choice([None, i, -i])
        number.setdefault(t, len(number))
        assert trie.insert(t, d) == number[t]
        least[t] = min([x for x in (least.get(t), d) if x is not None], default=None)
    assert [(t, trie.min_ids[i]) for i, t in trie.terminals()] == sorted(least.items())
    assert A.common_length(b"abc", b"abd") == 2 and A.common_length(b"", b"x") == 0 and A.common_length(b"ab", b"abc") == 2


def test_masks_equal_brute_force_over_slices_and_ranges(spark):
    rows = varied()
    want = sorted(map(str, brute_masks(rows)))
    for slice_bytes, range_bytes in ((1 << 24, 1 << 25), (3000, 2000), (1, 1)):
        got = A.failure_masks(frame(spark, rows).repartition(4), "lang", slice_bytes, range_bytes).collect()
        assert sorted(str((r.doc_id, r.part, r["mask"])) for r in got) == want


def test_prefixes_are_refined_until_light(spark):
    texts = [b"common start %04d" % i for i in range(400)] + [b"z"] * 50 + [b"y" * 100 + b"%d" % i for i in range(40)]
    t = spark.createDataFrame([(x, len(x), x[:A.HEAD]) for x in texts], "text binary, size long, head binary")
    starts = A.range_starts(t, 400)
    assert starts == sorted(set(starts)) and starts[0] == b""
    load = defaultdict(list)
    for x in texts:
        load[A.bisect_right(starts, x)].append(x)
    assert all(sum(len(x) + 1 for x in v) <= 400 or len(set(v)) == 1 for v in load.values())
    assert len(load) > 15


def test_audit_equals_brute_force(spark):
    rows = varied()
    got = A.audit(frame(spark, rows), label_frame(spark)).collect()
    want = brute_audit(rows, LABELS)
    assert len(got) == len(want) == 600 * len({r[2] or "" for r in rows})
    for r in got:
        assert {k: r[k] for k in want[r.part, r.filter_order, r.step]} == want[r.part, r.filter_order, r.step]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(cases.no_documents(spark), none).collect() == []
    assert A.audit(cases.small(spark), none).count() == 600 * cases.small(spark).select("lang").distinct().count()
