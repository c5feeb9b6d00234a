import random
import re

import pytest

import llm_cases as cases
from engage.llm import common
from engage.llm import line_dedup as L


def brute(rows):
    """Kept text and removed lines of each (doc_id, text), all pairs."""
    seen, out = [], {}
    for d, t in rows:
        if (d, t) in out:
            continue
        out[d, t] = None
    order = []
    for d, t in out:
        for i, line in enumerate((t or "").split("\n")):
            s = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            order.append((d is not None, d or 0, d, t, i, line, s))
    by_doc = {}
    order.sort(key=lambda r: (r[0], r[1], r[4]))
    for _, _, d, t, i, line, s in order:
        hit = len(s) >= L.MIN_TOKENS and any(
            5 * len(s & o) >= 4 * len(s | o) for o in seen if 5 * min(len(s), len(o)) >= 4 * max(len(s), len(o)))
        if len(s) >= L.MIN_TOKENS:
            seen.append(s)
        by_doc.setdefault((d, t), []).append((line, hit))
    return by_doc


def distinct_ids(rows):
    ids = {}
    for d, t in rows:
        ids.setdefault(d, set()).add(t)
    return [(d, t) for d, t in rows if len(ids[d]) == 1]


def check(spark, rows, dense):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = L.dedup_lines(docs, dense=dense).collect()
    assert len(got) == len(rows)
    left = sorted((str(d), "\n".join(x for x, h in want[d, t] if not h), sum(h for _, h in want[d, t]))
                  for d, t in rows)
    assert sorted((str(r.doc_id), r.text or "", r.n_removed) for r in got) == left
    return left


def near_copies():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    bases = [rng.sample(vocab, rng.randrange(5, 40)) for _ in range(12)]
    rows = []
    for d in range(150):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            w = list(rng.choice(bases)) if rng.random() < .7 else rng.sample(vocab, rng.randrange(1, 12))
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            lines.append(" ".join(w))
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("dense", [2, 64])
def test_near_copies_equal_brute_force(spark, dense):
    left = check(spark, near_copies(), dense)
    assert sum(n for _, _, n in left) > 30


def test_tables_equal_brute_force(spark):
    for docs in (cases.documents(spark), cases.small(spark)):
        check(spark, distinct_ids([(r.doc_id, r.text) for r in docs.collect()]), 64)


def test_documents_keep_columns_and_drop_emptied_rows(spark):
    docs = cases.documents(spark).withColumnRenamed("node", "n_lines").withColumnRenamed("v", "n_removed")
    out = L.dedup_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    ids = [r.doc_id for r in rows]
    assert 2 not in ids and {4, 5, 6, 7, 8} <= set(ids)
    assert [r.text for r in rows if r.doc_id == 15] == ["line one is here now\n\nend"]
    assert all(r.n_chars == len(r.text or "") for r in rows)
    assert all(r.n_lines == "n" and r.n_removed == 5 for r in rows)


def test_copies_of_lines_of_few_words_go(spark):
    rows = [(1, "see more\nla " + "la li " * 40 + "\n \none two three four"), (2, "More  see\n" + "li la " * 30 + "\n \nkept"),
            (3, "one two three\none two three four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_removed) for r in L.dedup_lines(docs).collect())
    assert got == [(1, rows[0][1], 0), (2, " \nkept", 2), (3, "one two three", 1)]


def test_four_words_match_five(spark):
    rows = [(1, "alpha beta gamma delta\nzeta eta theta iota kappa"), (2, "alpha beta gamma delta epsilon"),
            (3, "eta zeta iota theta\none two three"), (4, "one two three four"), (5, "delta beta alpha gamma epsilon x")]
    left = check(spark, rows, 64)
    assert [n for _, _, n in left] == [0, 1, 1, 0, 1]


def test_short_lines_equal_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(9)]
    rows = [(d, "\n".join(" ".join(rng.choices(vocab, k=rng.randint(0, 7))) for _ in range(rng.randint(0, 3))))
            for d in range(120)]
    for dense in (2, 512):
        check(spark, rows, dense)


def test_plan_has_no_python(spark):
    plan = L.dedup_lines(cases.documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark):
    assert L.dedup_lines(cases.no_documents(spark)).collect() == []
    assert L.dedup_documents(cases.no_documents(spark)).collect() == []


def test_staged_tables_go_when_the_removed_lines_are_written(spark, monkeypatch):
    """They would take disk beside all later stages of a pipeline."""
    folders = []
    monkeypatch.setattr(L, "discard", lambda s, folder: folders.append(folder) or common.discard(s, folder))
    docs = spark.createDataFrame([(i, f"one two three four five {i % 3}\nsix seven eight nine ten") for i in range(9)],
                                 "doc_id long, text string")
    gone = L.removed_lines(docs)
    assert len(folders) == 1
    path = spark._jvm.org.apache.hadoop.fs.Path(folders[0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert not any(f.startswith(folders[0]) for f in gone.inputFiles())
    assert sorted((r.d, sorted(r.gone)) for r in gone.collect()) == [(i, [1] if i < 3 else [0, 1]) for i in range(1, 9)]


def test_shuffle_files_go_with_the_staged_write(tmp_path):
    """They would take disk beside all later steps (own process: a context has
    one local folder)."""
    import os
    import subprocess
    import sys
    code = """
import os, sys, time
from pathlib import Path
from pyspark.sql import functions as F
from engage.llm import common
from engage.session import local_session
here = sys.argv[1]
spark = local_session(2, 4, extra={"spark.local.dir": here})
before = spark.conf.get(common.CLEANUP, None)
df = spark.range(20000).groupBy(F.xxhash64("id").alias("k")).count()
out = common.staged(df, "t")
left = lambda: sum(p.stat().st_size for p in Path(here).rglob("shuffle_*.data"))
for _ in range(50):
    if not left():
        break
    time.sleep(0.2)
print("left", left(), "rows", out.count(), "same", spark.conf.get(common.CLEANUP, None) == before)
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(L.__file__ + "/..")))
    run = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=120,
                         env={**os.environ, "PYTHONPATH": repo})
    assert "left 0 rows 20000 same True" in run.stdout, run.stdout + run.stderr[-2000:]
