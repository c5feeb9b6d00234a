import hashlib
import random
import re

import llm_cases as cases
from engage.llm import pii as P

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def test_base_spans_equal_brute_force():
    rng = random.Random(2)
    alphabet = ["a", "@", ".", "1", "25", "255", "-", " ", "+", "(", ")", "b.c", "é", "4111111111111111", "0", "%"]
    for _ in range(6000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(25)))
        assert [(P.KINDS[k], s, e) for k, s, e in P.base_spans(t)] == brute(t), t


def test_table_equals_brute_force(spark):
    for docs in (cases.documents(spark), cases.small(spark)):
        want = []
        for r in docs.collect():
            b = brute(r.text)
            n = [sum(k == x for k, _, _ in b) for x in BASE]
            want.append((str(r.doc_id), *n, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()))
        rows = P.pii(docs).collect()
        got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)
        assert got == sorted(want)
        for r in rows:
            spans = [x for x in r.spans.split(",") if x]
            assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added


def test_votes_pack():
    for kind in range(len(P.KINDS)):
        for v in ((1, 0, 1, -1, 0), (-1, 1, 0, 0, -1)):
            assert P.unpack_votes(P.pack_votes(kind, v)) == (kind, v)


def test_held_out_accuracy_on_planted_spans(spark):
    rng = random.Random(7)
    rows, truth = [], {}
    filler = lambda n: " ".join(rng.choice(["river", "stone", "green", "walks", "paper", "seven"]) for _ in range(n))
    for i in range(600):
        kind, yes = rng.choice(["phone", "secret", "email"]), rng.random() < 0.5
        digits = "".join(rng.choice("0123456789") for _ in range(10))
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(32))
        if kind == "phone":
            s = (f"please call ({digits[:3]}) {digits[3:6]}-{digits[6:]}" if yes
                 else f"see version {digits[:2]}.{digits[2:6]}.{digits[6:9]}")
        elif kind == "secret":
            s = f'api token = "{hexes}"' if yes else f"commit sha {hexes[:1] * 30}"
        else:
            s = f"mail joe.{i} [at] example [dot] com" if yes else f"we met at noon dot then{i}"
        rows.append((i, f"{filler(8)} {s} {filler(8)}"))
        truth[i] = yes
    out = P.pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    right = sum((r.n_added > 0) == truth[r.doc_id] for r in out)
    assert right / len(rows) > 0.95


def test_plain_at_is_proposed_whatever_else_the_text_holds():
    for t in ("write to jane at example.com", "an anecdote: write to jane AT example.com", "mail jane(at)example.com"):
        assert [t[s:e].lower() for k, s, e in P.candidates(t, []) if k == 0] == [
            P.HIDDEN_EMAIL.search(t)[0].lower()], t


def test_votes_tell_plain_at_from_prose(spark):
    rows = [(i, f"please write to jane{i} at example{i}.com soon" if i % 2 else f"they met at noon{i}. then all went home")
            for i in range(200)]
    out = P.pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((r.n_added > 0) == (r.doc_id % 2 == 1) for r in out)


def test_empty_table(spark):
    assert P.pii(cases.no_documents(spark)).collect() == []


def test_candidates_equal_a_plain_overlap_test():
    rng = random.Random(4)
    parts = ["call 555-123-4567", "mail joe at home dot com", "a@b.co", "10.0.0.1", "+1 555 123 4567", "x", "4111111111111111",
             "key_abcdefghijklmnop12", "deadbeef" * 4, "deadbeef" * 40, " ", ", "]
    for _ in range(300):
        text = " ".join(rng.choices(parts, k=rng.randint(0, 12)))
        base = P.base_spans(text)
        got = P.candidates(text, base)
        assert all(e <= s2 or e2 <= s for _, s, e in got for _, s2, e2 in base)
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:]))
    assert (4, 6, 6 + 320) in P.candidates("token=" + "deadbeef" * 40, [])


def test_very_long_texts_take_time_in_proportion():
    import time
    part = "call (555) 123-4567 or mail joe at home dot com, 10.0.0.1 a@b.co deadbeefdeadbeefdeadbeef01 "
    took = []
    for n in (2_000, 20_000):
        t0 = time.process_time()
        P.judge(part * n)
        took.append(time.process_time() - t0)
    assert took[1] < 25 * took[0] + 2
