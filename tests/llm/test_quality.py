import re
from collections import Counter

import llm_cases as cases
from engage.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(wins)
    covered = {i + j for i, w in enumerate(wins) if times[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark):
    for docs in (cases.documents(spark), cases.small(spark)):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        want = sorted((str(d), *brute(t)) for d, t in texts)
        out = Q.quality(docs).collect()
        got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                     for r in out)
        assert got == want
        for r in out:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.base_failed and not (r.host_bad and r.n_failed > 0))


def test_filter_agrees_with_verdicts_and_keeps_columns(spark):
    docs = cases.documents(spark)
    kept = Q.filter_documents(docs, max_rate=0.1)
    assert kept.schema == docs.schema
    want = sorted((str(r.doc_id), r.n_words) for r in Q.quality(docs, max_rate=0.1).filter("kept").collect())
    got = sorted((str(r.doc_id), len(WORD.findall(r.text))) for r in kept.collect())
    assert got == want and got


def test_bad_host_loses_failing_documents_only(spark):
    good = cases.BASE
    symbols = " ".join(f"{w}#" for w in good.split())
    rows = [(i, symbols if i % 3 else good, "bad") for i in range(60)]
    rows += [(100 + i, symbols if i == 0 else good, f"fine{i % 4}") for i in range(80)]
    out = {r.doc_id: r for r in Q.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[i].host_bad for i in range(60))
    assert [i for i in range(60) if out[i].kept] == list(range(0, 60, 3))
    assert all(out[100 + i].kept for i in range(80))


def test_prior_shrinks_small_hosts():
    a, b = Q.beta_prior(0.2, 0.01)
    assert abs(a / (a + b) - 0.2) < 1e-9
    assert (1 + a) / (1 + a + b) < 1 and (100 + a) / (100 + a + b) > (1 + a) / (1 + a + b)
    assert Q.beta_prior(0.0, 0.0)[0] > 0


def test_empty_table(spark):
    assert Q.quality(cases.no_documents(spark)).collect() == []
    assert Q.filter_documents(cases.no_documents(spark)).collect() == []
