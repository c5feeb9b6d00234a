"""Personal data by weak supervision.

Base spans (email, ip, card, phone) come from fixed patterns and stay.  Wider
patterns propose further candidates, and labelers of three sorts vote on every
span, base spans included: patterns (shape of the span), gazetteers (mail
domains, names of secret fields) and context (cue words before it, figures or
units around it).  A vote is for, against, or none.

Vote patterns are counted over all documents.  Expectation-maximisation on the
counts estimates each labeler's reliability and each pattern's probability
(no labels are needed), and a logistic regression on span features is trained
on these probabilities; a candidate that it accepts, and that does not overlap
a base span of its document, is added.  Patterns and features take a few
values each, so their counts are bounded whatever the corpus holds; the texts
are read once and never shuffled.

Defined cases: null and empty texts have no spans; repeated rows are judged
each; without any candidate the model is empty and only base spans stay;
offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import id_and_bytes, staged

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret",)
KINDS = BASE_KINDS + MORE_KINDS

# ---- base patterns
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# ---- wider patterns that propose candidates
HIDDEN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}"
                          r"(?: ?(?:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z0-9-]{1,63}){1,4}", re.I)
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-])")
SECRET = re.compile(r"(?<![A-Za-z0-9_-])(?:[0-9a-f]{24,}+|[A-Z]{2,5}[0-9A-Z]{14,}+|"
                    r"(?:sk|pk|ghp|key)[-_][0-9A-Za-z_-]{12,}+)(?![A-Za-z0-9_-])")

# ---- gazetteers and cues, fixed values
DOMAIN_ENDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "biz")
SECRET_FIELDS = ("token", "secret", "password", "passwd", "key", "apikey", "api_key", "auth", "bearer")
CONTACT_CUES = ("call", "phone", "tel", "mobile", "fax", "mail", "e-mail", "email", "contact", "write", "reach")
AGAINST_CUES = ("version", "v", "isbn", "sha", "sha1", "sha256", "md5", "commit", "checksum", "page", "hash")
CONTEXT = 24                    # characters read before a span

LABELERS = ("shape", "gazetteer", "cue", "against", "repeated")
FEATURES = len(LABELERS) * 2 + len(KINDS)

FOUND = ("doc_id long, base array<struct<kind:int,start:long,end:long>>, "
         "more array<struct<kind:int,start:long,end:long,votes:int>>, votes array<int>")
SPANS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "spans string, n_added long")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards: the part before it
    is the run of its characters since the last match."""
    floor, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        if m:
            start = at
            while start > floor and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, m.end()
                floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base patterns, by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if "." in text:
        out += [(1, *m.span()) for m in IP.finditer(text)
                if all(int(x[-4:]) <= 255 and (len(x) < 4 or not x[:-3].strip("0")) for x in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the wider patterns that overlap no base span or one another."""
    found = []
    low = text.lower()
    if " at " in low or "[at]" in low or "(at)" in low:     # every match holds one of them
        found += [(0, *m.span()) for m in HIDDEN_EMAIL.finditer(text)]
    found += [(3, *m.span()) for m in LOCAL_PHONE.finditer(text)]
    found += [(4, *m.span()) for m in SECRET.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    out = []
    for k, s, e in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        i = bisect_left(starts, e)
        if i and reach[i - 1] > s:
            continue
        if out and out[-1][2] > s:
            continue
        out.append((k, s, e))
    return out


def votes(kind: int, span: str, before: str, after: str, times: int) -> tuple[int, ...]:
    """One vote (1 for, -1 against, 0 none) of each labeler."""
    words = re.findall(r"[a-z0-9_-]+", before.lower())
    digits, near = _digits(span), words[-3:]
    shape = {
        0: 1 if re.search(r"(\[|\()at(\]|\))", span.lower()) or "@" in span else -1,
        1: 1 if not span.startswith("0") else -1,
        2: 1 if len(digits) == 16 else 0,
        3: 1 if span.startswith("+") or re.fullmatch(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", span) else -1,
        4: 1 if len(set(span)) >= 8 and digits and len(digits) < len(span) else -1,
    }[kind]
    ends = re.split(r"[^a-z0-9]+", span.lower())
    gazetteer = int(kind == 0 and ends[-1] in DOMAIN_ENDS or kind == 4 and any(w in SECRET_FIELDS for w in near))
    cue = int(any(w in CONTACT_CUES for w in near)) if kind != 4 else int(before.rstrip(" \"'")[-1:] in ("=", ":"))
    against = -1 if any(w in AGAINST_CUES for w in near) or after[:1] in ("%", "$") else 0
    return shape, gazetteer, cue, against, -1 if times > 3 else 0


def pack_votes(kind: int, v: tuple[int, ...]) -> int:
    code = kind
    for x in v:
        code = code * 3 + x + 1
    return code


def unpack_votes(code: int) -> tuple[int, tuple[int, ...]]:
    out = []
    for _ in LABELERS:
        code, x = divmod(code, 3)
        out.append(x - 1)
    return code, tuple(reversed(out))


def judge(text: str) -> tuple[list, list, list]:
    """Base spans, candidates with their vote codes, and the base spans' codes."""
    base = base_spans(text)
    more = candidates(text, base)
    times = Counter(text[s:e] for _, s, e in base + more)

    def code(k: int, s: int, e: int) -> int:
        v = votes(k, text[s:e], text[max(0, s - CONTEXT):s], text[e:e + 2], times[text[s:e]])
        return pack_votes(k, v)
    return base, [(k, s, e, code(k, s, e)) for k, s, e in more], [code(*x) for x in base]


# ---- reliabilities and classifier, from pattern counts
def posteriors(codes: list[int], counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability of personal data by vote pattern (Dawid-Skene by EM).

    Starts from the majority vote; a labeler's table says how often it votes
    each way on spans that are and are not personal data, smoothed by one.
    """
    kinds = np.array([unpack_votes(c)[0] for c in codes])
    v = np.array([unpack_votes(c)[1] for c in codes]) + 1
    p = np.clip(0.5 + 0.2 * (v - 1).sum(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        w1, w0 = counts * p, counts * (1 - p)
        prior = np.array([(w1[kinds == k].sum() + 1) / (counts[kinds == k].sum() + 2)
                          for k in range(len(KINDS))])
        ll = np.log(prior[kinds]) - np.log(1 - prior[kinds])
        for j in range(v.shape[1]):
            t1, t0 = (np.bincount(v[:, j], w, minlength=3) + 1 for w in (w1, w0))
            ll += np.log(t1 / t1.sum())[v[:, j]] - np.log(t0 / t0.sum())[v[:, j]]
        new = 1 / (1 + np.exp(-np.clip(ll, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            return new
        p = new
    return p


def feature_rows(codes: list[int]) -> np.ndarray:
    x = np.zeros((len(codes), FEATURES + 1))
    for i, c in enumerate(codes):
        k, v = unpack_votes(c)
        for j, vote in enumerate(v):
            x[i, 2 * j] = vote == 1
            x[i, 2 * j + 1] = vote == -1
        x[i, 2 * len(LABELERS) + k] = 1
        x[i, -1] = 1
    return x


def train(codes: list[int], counts: np.ndarray, target: np.ndarray, ridge: float = 1.0,
          rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels (Newton steps)."""
    x = feature_rows(codes)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - target)) + ridge * w
        hess = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def accepted(counted: list[tuple[int, int]]) -> frozenset[int]:
    """Vote patterns that the trained classifier takes for personal data."""
    if not counted:
        return frozenset()
    codes = [c for c, _ in sorted(counted)]
    counts = np.array([n for _, n in sorted(counted)], float)
    w = train(codes, counts, posteriors(codes, counts))
    score = feature_rows(codes) @ w
    return frozenset(c for c, s in zip(codes, score, strict=True) if s > 0)


# ---- Spark jobs
SPAN3 = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
SPAN4 = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                            ("votes", pa.int32())]))


def find_spans(docs: DataFrame) -> DataFrame:
    """Base spans, candidates and vote codes of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [judge(t.decode("utf-8", "replace")) for t in b.column("text").to_pylist()]
            base = [[{"kind": k, "start": s, "end": e} for k, s, e in x[0]] for x in got]
            more = [[{"kind": k, "start": s, "end": e, "votes": v} for k, s, e, v in x[1]] for x in got]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(base, SPAN3), pa.array(more, SPAN4),
                 pa.array([x[2] for x in got], pa.list_(pa.int32()))], names=["doc_id", "base", "more", "votes"])
    return id_and_bytes(docs).mapInArrow(run, FOUND)


def pii(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans, for each row."""
    found = staged(find_spans(docs), "pii-spans")
    codes = found.select(F.explode(F.concat(
        "votes", F.transform("more", lambda m: m["votes"]))).alias("code"))
    # bounded: kinds x votes ** labelers patterns
    take = accepted([(r[0], r[1]) for r in codes.groupBy("code").count().collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SPANS.split(", ")]
        for b in batches:
            rows = []
            for base, more in zip(b.column("base").to_pylist(), b.column("more").to_pylist(), strict=True):
                spans = [(x["kind"], x["start"], x["end"]) for x in base]
                added = [(x["kind"], x["start"], x["end"]) for x in more if x["votes"] in take]
                kinds = Counter(k for k, _, _ in spans)
                join = lambda xs: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(xs))
                rows.append((*(kinds[k] for k in range(4)), hashlib.sha256(join(spans).encode()).hexdigest(),
                             join(spans + added), len(added)))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else \
                [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=names)
    return found.mapInArrow(run, SPANS)
