"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Activity buckets by impression count and title-length buckets
# by word count, both closed on the right; the bounded variant's outer edges.
ACTIVITY_EDGES = (5, 15, 30)
ACTIVITY_MAX = 9999
TITLE_EDGES = (6, 10, 15)
TITLE_MAX = 999
ACTIVITY_LABELS = ("Low", "Medium", "High", "Very High")


def step_bucket(x, edges) -> Column:
    """0..len(edges): first edge with ``x <= edge``, else the last code.

    A null ``x`` falls through to the last code, as a ``when`` chain does.
    """
    x = _c(x)
    expr = None
    for code, edge in enumerate(edges):
        expr = (F.when(x <= edge, F.lit(code)) if expr is None
                else expr.when(x <= edge, F.lit(code)))
    return expr.otherwise(F.lit(len(edges)))


def bounded_bucket(x, edges, upper) -> Column:
    """Bins ``(0,e1] (e1,e2] ... (ek,upper]``; outside (or null) gives null."""
    x = _c(x)
    bounds = (0, *edges, upper)
    expr = None
    for code in range(len(bounds) - 1):
        cond = (x > bounds[code]) & (x <= bounds[code + 1])
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def activity_code(impressions) -> Column:
    return step_bucket(impressions, ACTIVITY_EDGES)


def title_len_code(words) -> Column:
    return step_bucket(words, TITLE_EDGES)


def word_count(title, mode: str = "single_space") -> Column:
    """Words of a title; a null title counts -1.

    ``single_space`` splits on one space, so ``""`` is 1 word and ``"a  b"``
    3; ``whitespace`` counts non-empty runs of non-space characters.
    """
    t = _c(title)
    if mode == "single_space":
        n = F.size(F.split(t, " "))
    elif mode == "whitespace":
        n = F.size(F.filter(F.split(F.trim(t), r"\s+"), lambda w: w != ""))
    else:
        raise ValueError(f"unknown word-count mode {mode!r}")
    return F.when(t.isNull(), F.lit(-1)).otherwise(n)


def ratio(num, den, places: int | None = 4, half_even: bool = False) -> Column:
    """``num / den`` as double, rounded half-up (or half-even) when asked."""
    q = _c(num).cast("double") / _c(den)
    if places is None:
        return q
    return F.bround(q, places) if half_even else F.round(q, places)


def safe_ratio(num, den) -> Column:
    """``num / max(den, 1)``: the guard used by the collection statistics."""
    return _c(num).cast("double") / F.greatest(_c(den), F.lit(1))


def token_news_id(tok) -> Column:
    return F.get(F.split(_c(tok), "-"), 0)


def token_click(tok) -> Column:
    """Second dash-separated part as int, null when missing or not a number."""
    return F.get(F.split(_c(tok), "-"), 1).try_cast("int")


def token_is_strict(tok) -> Column:
    return F.size(F.split(_c(tok), "-")) == 2


def short_title(title, n: int = 40) -> Column:
    return F.concat(F.substring(_c(title), 1, n), F.lit("..."))
