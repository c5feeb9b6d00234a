"""Property tests against plain-Python brute force (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from engage.operators.interactions import parse_impressions
from engage.operators.ordering import with_global_position, with_prefix_sums
from engage.schemas import BEH_SCHEMA

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

token = st.one_of(
    st.builds(lambda n, c: f"N{n}-{c}", st.integers(0, 50), st.integers(0, 1)),
    st.builds(lambda n: f"N{n}", st.integers(0, 50)),
    st.sampled_from(["", "N-4-0", "N3-x", "x-1-2-3", "-1", "N7-"]),
)
impressions = st.one_of(st.none(), st.lists(token, max_size=6).map(" ".join))


def _py_parse(imp, strict):
    out = []
    if imp is None:
        return out
    for tok in imp.split(" "):
        parts = tok.split("-")
        if strict and len(parts) != 2:
            continue
        if len(parts) < 2:
            continue
        try:
            click = int(parts[1])
        except ValueError:
            continue
        out.append((parts[0], click))
    return out


@SETTINGS
@given(st.lists(impressions, min_size=1, max_size=6), st.booleans())
def test_parse_matches_python(spark, rows, strict):
    data = [(str(i), f"U{i}", "t", "", imp) for i, imp in enumerate(rows)]
    beh = spark.createDataFrame(data, BEH_SCHEMA)
    got = sorted((r.NewsID, r.Click) for r in parse_impressions(beh, strict=strict).collect())
    want = sorted(x for imp in rows for x in _py_parse(imp, strict))
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=300, unique=True),
       st.integers(1, 9))
def test_global_position_is_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.pos for r in with_global_position(df, [F.col("k")], n=parts).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@SETTINGS
@given(st.lists(st.tuples(st.floats(-1e3, 1e3, allow_nan=False), st.integers(0, 5)),
                min_size=1, max_size=200, unique_by=lambda t: t[0]),
       st.integers(1, 7))
def test_prefix_sums(spark, rows, parts):
    df = spark.createDataFrame([(float(s), v) for s, v in rows], "s double, v long")
    got = {r.s: r.v_before for r in with_prefix_sums(df, "s", ["v"], n=parts).collect()}
    ordered = sorted(rows)
    want, acc = {}, 0
    for s, v in ordered:
        want[float(s)] = acc
        acc += v
    assert got == want


# ---- unseen positions (ranges and the first of them) against plain Python
seen_sets = st.dictionaries(st.sampled_from(["U1", "U2", "U3", "U4"]),
                            st.lists(st.integers(1, 14), max_size=14), min_size=1)


@SETTINGS
@given(seen=seen_sets, m=st.one_of(st.none(), st.integers(0, 16)),
       mode=st.sampled_from(["catalogue", "empty"]))
def test_unseen_positions_match_brute_force(spark, seen, m, mode):
    from engage.operators import recommend as RC
    n = 12  # catalogue positions 1..12; ids 13, 14 are not in the catalogue
    cat = spark.createDataFrame([(f"N{i}", i, "c") for i in range(1, n + 1)],
                                "NewsID string, pos long, Category string")
    ds = spark.createDataFrame([(u, f"N{i}") for u, ids in seen.items() for i in ids] +
                               [(u, "N99") for u in seen], "UserID string, NewsID string")
    if m is None:
        got = [(r.UserID, p, r.exhausted) for r in RC.unseen_ranges(ds, cat, exhausted=mode).collect()
               for p in range(r.first_pos, r.last_pos + 1)]
    else:
        got = [(r.UserID, r.pos, r.exhausted) for r in RC.first_unseen(ds, cat, m, exhausted=mode).collect()]
    want = []
    for u, ids in seen.items():
        seen_pos = {i for i in ids if i <= n}
        limit = n if m is None else m
        if len(seen_pos) == n:
            want += [(u, p, True) for p in range(1, min(limit, n) + 1)] if mode == "catalogue" else []
        else:
            want += [(u, p, False) for p in [p for p in range(1, n + 1)
                                              if p not in seen_pos][:limit]]
    assert sorted(got) == sorted(want)
