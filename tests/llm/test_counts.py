import random

from tokenizers import Tokenizer

import llm_cases as cases
from engage.llm import counts as C
from engage.llm.tokens import default_tokenizer

TOK = Tokenizer.from_file(default_tokenizer())
TOK.encode_special_tokens = True


def tokens(text):
    return len(TOK.encode(text, add_special_tokens=False).ids)


def test_edits_equal_counting_anew(monkeypatch):
    monkeypatch.setattr(C, "LEAF", 3)
    rng = random.Random(9)
    pieces = C.PieceCounts(default_tokenizer())
    alphabet = ["a", "word", " ", "  ", "\n", "'ll", "'", "s", "1", "23", ".", "é", " the", "\t", "'re"]
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    for _ in range(400):
        text = make(rng.randrange(60))
        tree = C.DocTree(text, pieces)
        assert tree.total() == tokens(text)
        for _ in range(4):
            a = rng.randrange(len(text) + 3)
            b, new = a + rng.randrange(8), make(rng.randrange(5))
            tree.edit(a, b, new)
            a, b = min(a, len(text)), min(b, len(text))
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.length() == len(text)
            assert [p for x in tree.leaves for p in x] == C.PATTERN.findall(text)
            assert tree.total() == tokens(text)


def test_an_edit_encodes_its_region_only():
    text = "some words here and there " * 2000
    tree = C.DocTree(text, C.PieceCounts(default_tokenizer()))
    tree.edit(20000, 20010, "xyz")
    assert tree.reencoded < 12


def test_table_equals_counting_anew(spark):
    for docs in (cases.documents(spark), cases.small(spark)):
        want = []
        for r in docs.collect():
            text = r.text or ""
            edited = C.REDACT.sub(C.MASK, text)
            want.append((str(r.doc_id), tokens(text), len(C.REDACT.findall(text)), tokens(edited), len(edited)))
        got = sorted((str(r.doc_id), r.n_tokens, r.n_edits, r.n_tokens_edited, r.n_chars_edited)
                     for r in C.count_edited(docs).collect())
        assert got == sorted(want)
        assert any(w[2] for w in want)


def test_kept_trees_follow_rounds_of_edits(spark):
    rng = random.Random(3)
    docs = cases.documents(spark)
    now = [(d, t) for d, t in ((r.doc_id, r.text or "") for r in docs.collect())]
    trees = C.build_trees(docs)
    for _ in range(3):
        edits = []
        for d in (1, 2, 5, 12, 13, 14, 77, None):
            for seq in range(rng.randrange(4)):
                a = rng.randrange(200)
                edits.append((d, seq, a, a + rng.randrange(9), rng.choice([None, "", "new words", "'s", " 12 "])))
        frame = spark.createDataFrame(edits, "doc_id long, seq int, start long, end long, text string")
        trees = C.apply_edits(trees, frame.repartition(3))
        after = []
        for d, t in now:
            for _, seq, a, b, new in sorted((e for e in edits if e[0] == d and d is not None), key=lambda e: e[1]):
                a, b = min(a, len(t)), min(b, len(t))
                t = t[:a] + (new or "") + t[b:]
            after.append((d, t))
        now = after
        got = C.tree_counts(trees).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.n_chars) for r in got) == sorted((str(d), tokens(t), len(t)) for d, t in now)
        assert sorted((str(r.doc_id), r.text) for r in trees.collect()) == sorted((str(d), t) for d, t in now)
    # long documents are not encoded anew: an edit costs its region
    one = spark.createDataFrame([(14, 0, 5, 6, "y"), (13, 0, 1000, 1001, "z")], frame.schema)
    cost = {r.doc_id: r.n_reencoded for r in C.apply_edits(trees, one).collect()}
    assert 0 < cost[13] < 20 and cost[1] == 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, seq int, start long, end long, text string")
    assert C.tree_counts(C.apply_edits(C.build_trees(cases.no_documents(spark)), none)).collect() == []
    assert C.count_edited(cases.no_documents(spark)).collect() == []
