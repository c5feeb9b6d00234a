"""URL filter rules, indexed by their rarest literal token.

Two kinds of rules decide on a URL:

* *host rules* ``host/path``: fit the host and all its subdomains where the
  URL's path starts with the rule's path (case kept).  The longest that fits
  wins, and any host rule goes before the pattern rules;
* *pattern rules* on the lower-cased URL after its first ``://``: ``*`` stands
  for anything, ``^`` for a separator or the end, a leading ``||`` for the
  start of the host or of one of its parents, ``|`` for the start or the end.
  A rule that starts with ``@@`` allows, others block; what allows wins, then
  the longer rule, then the smaller text.

A *token* is a maximal run of ``a-z0-9``.  A run inside a rule is a token of
every URL that the rule fits if nothing can extend it on either side (a
separator, a fixed other character or an anchor stands there).  Each rule is
filed under the one of its tokens that the fewest URLs hold; the
tokens of a URL fetch the rules filed under them by an equi-join, and only
those run their regular expression.  Rules without such a token (as ``*ad*``)
are tried on every URL, in blocks of ``BLOCK`` rules.

The URLs are staged once with a row number, and what belongs to a URL comes
back to it by that number, which no hot host can skew.  A hot token is one key
of a join without hints: the rule side is broadcast by its measured size, else
the skew handling splits the URLs' side.

Defined cases: a null URL or one without ``://`` has an empty host and path
(no host rule fits) and runs the pattern rules on the whole of it; a null or
empty rule, or a host rule without a host, is left out; repeated rules count
once; repeated pages and null page ids are kept row by row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"(?:[^a-z0-9_.%-]|\z)"
BLOCK = 32                      # rules without a token that one expression tries
DEFAULT_VERDICT = "allow"

#: Host rules of the contract: (rule, verdict).
HOST_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
              ("com/fr/", "allow"), ("com/de/", "block")]

#: Pattern rules used where none are given: link farms, shops of doubtful
#: goods, gambling, adult pages, trackers and files that are no pages.
PATTERN_RULES = [
    "||spam-farm.", "cheap-pills.", "-pills.", "^viagra^", "^casino^", "^poker^", "^betting^", "^porn^", "^xxx^",
    "^escort^", "^torrent^", "^warez^", "||ads.", "||adserver.", "^adclick^", "^popunder^", "/track/*/pixel^",
    "^payday^*^loan^", "link-farm", "free-followers", ".exe|", ".apk|", ".torrent|", "@@||example.org/en/9*.html|",
]

_RULES = "kind string, rule string, action string, length int, regex string, tokens array<string>"


def _run_is_token(piece: str, start: int, end: int, open_left: bool, open_right: bool) -> bool:
    """Nothing can extend the run ``piece[start:end]``: inside the piece it is
    maximal, so only the open ends of the piece matter."""
    return (start > 0 or not open_left) and (end < len(piece) or not open_right)


def _quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9\x80-\U0010FFFF])", r"\\\1", literal)


def compile_pattern(rule: str) -> tuple[str, str, list[str]] | None:
    """(action, regular expression, tokens) of a pattern rule."""
    body = rule.translate(str.maketrans(UPPER, LOWER))
    action = "block"
    if body.startswith("@@"):
        action, body = "allow", body[2:]
    head, tail = "", ""
    if body.startswith("||"):
        head, body = "||", body[2:]
    elif body.startswith("|"):
        head, body = "|", body[1:]
    if body.endswith("|"):
        tail, body = r"\z", body[:-1]
    if not body.strip("*"):
        return None
    pieces = body.split("*")
    regex, tokens = r"(?s)\A", []
    for i, piece in enumerate(pieces):
        first, last = i == 0, i == len(pieces) - 1
        open_left, open_right = not (first and head), not (last and tail)
        for m in re.finditer("[a-z0-9]+", piece):
            if _run_is_token(piece, m.start(), m.end(), open_left, open_right):
                tokens.append(m.group())
        match = "".join(SEPARATOR if c == "^" else _quoted(c) for c in piece)
        skip = {"": ".*?", "|": "", "||": r"(?:[^/?#]*?\.)??"}[head if first else ""]
        if last and tail:
            regex += skip + match + tail
        else:
            # the first place where a piece fits leaves most room for the rest,
            # so each piece is settled once: no backtracking on long URLs
            regex += "(?>" + skip + match + ")"
    return action, regex, sorted(set(tokens))


def compile_host_rule(rule: str) -> tuple[str, list[str]] | None:
    """(regular expression on host and path, tokens) of a host rule."""
    host, slash, path = rule.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))
    if not host:
        return None
    regex = r"(?s)^(?:[^/]*\.)?" + _quoted(host) + (_quoted(slash + path) if slash else r"(?:/.*)?\z")
    text = (host + slash + path).translate(str.maketrans(UPPER, LOWER))
    tokens = [m.group() for m in re.finditer("[a-z0-9]+", text)
              if _run_is_token(text, m.start(), m.end(), False, bool(slash))]
    return regex, sorted(set(tokens))


def rules_table(spark: SparkSession, host_rules: Iterable[tuple[str, str]] = HOST_RULES,
                patterns: Iterable[str] = PATTERN_RULES) -> DataFrame:
    """``kind, rule, action`` of rules given as lists."""
    rows = [("host", r, a) for r, a in host_rules] + [("pattern", r, None) for r in patterns]
    return spark.createDataFrame(rows, "kind string, rule string, action string")


def compile_rules(rules: DataFrame) -> DataFrame:
    """Rules (``kind, rule, action``) with their expression and tokens."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["kind"] == "host":
                    got = compile_host_rule(r["rule"])
                    if got:
                        out.append({**r, "regex": got[0], "tokens": got[1]})
                else:
                    got = compile_pattern(r["rule"])
                    if got:
                        out.append({**r, "action": got[0], "regex": got[1], "tokens": got[2]})
            for r in out:
                r["length"] = len(r["rule"])
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("kind", pa.string()), ("rule", pa.string()), ("action", pa.string()), ("length", pa.int32()),
                ("regex", pa.string()), ("tokens", pa.list_(pa.string()))]))
    # where one rule is given with both actions, the one that allows stays
    once = (rules.filter("rule is not null and rule <> ''").groupBy("kind", "rule")
            .agg(F.min("action").alias("action")))
    return once.mapInArrow(run, _RULES)


def split_urls(urls: DataFrame) -> DataFrame:
    """Adds ``host``, ``path`` and ``subject`` (what pattern rules run on)."""
    text = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(text, "://")
    after = F.when(at > 0, F.expr("substring(coalesce(cast(url AS string), ''), "
                                  "instr(coalesce(cast(url AS string), ''), '://') + 3)"))
    raw_host = F.regexp_extract(F.coalesce(after, F.lit("")), r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(after, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)
    return urls.select(
        "*", F.translate(raw_host, UPPER, LOWER).alias("host"), path.alias("path"),
        F.translate(F.coalesce(after, text), UPPER, LOWER).alias("subject"))


def url_tokens(urls: DataFrame) -> DataFrame:
    """``uid, token``: the distinct tokens of each URL."""
    words = F.split(F.regexp_replace("subject", "[^a-z0-9]+", " "), " ")
    return (urls.select("uid", F.explode(F.array_distinct(words)).alias("token"))
            .filter("token <> ''"))


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule with ``token``, the one of its tokens held by the fewest URLs
    (ties: the smaller), null where it has none."""
    wanted = rules.select("kind", "rule", F.explode("tokens").alias("token"))
    held = (tokens.join(wanted.select("token").distinct(), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("held")))
    ranked = wanted.join(held, "token", "left").select(
        "kind", "rule", F.struct(F.coalesce("held", F.lit(0)).alias("held"), "token").alias("at"))
    best = ranked.groupBy("kind", "rule").agg(F.min("at")["token"].alias("token"))
    return rules.join(best, ["kind", "rule"], "left")


def _fits():
    """The rule of the row fits the URL of the row."""
    return F.when(F.col("kind") == "host", F.expr("concat(host, path) rlike regex")).otherwise(
        F.expr("subject rlike regex"))


def matches(urls: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``uid`` and rule of every rule that fits, ``uid`` and ``n_candidates``
    for the URLs whose tokens fetched a rule) of staged ``urls``."""
    tokens = url_tokens(urls)
    index = staged(index_rules(rules, tokens), "url-rules")
    filed = index.filter("token is not null").select("token", "kind", "rule", "action", "length", "regex")
    fetched = tokens.join(filed, "token").drop("token")
    tried = staged(fetched.join(urls.select("uid", "host", "path", "subject"), "uid")
                   .select("uid", "kind", "rule", "action", "length", _fits().alias("fits")), "url-candidates")
    found = tried.filter("fits").drop("fits")
    loose = index.filter("token is null").select("kind", "rule", "action", "length", "regex")
    n = loose.count()
    if n:
        # each block is one row of a few rules; a URL meets one block a row
        block = F.pmod(F.xxhash64("kind", "rule"), F.lit(-(-n // BLOCK)))
        blocks = loose.groupBy(block.alias("block")).agg(F.collect_list(F.struct(*loose.columns)).alias("rules"))
        runs = urls.select("uid", "host", "path", "subject",
                           F.explode(F.sequence(F.lit(0), F.lit(-(-n // BLOCK) - 1))).alias("block"))
        hit = runs.join(blocks, "block").select("uid", F.explode(F.expr(
            "filter(rules, r -> if(r.kind = 'host', concat(host, path), subject) rlike r.regex)")).alias("r"))
        found = found.unionByName(hit.select("uid", "r.kind", "r.rule", "r.action", "r.length"))
    return found, tried.groupBy("uid").agg(F.count(F.lit(1)).alias("n_candidates"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: ``page_id, host, path, rule`` (the host rule that
    decided), ``verdict``, ``pattern`` (the pattern rule that decided) and
    ``n_candidates`` (rules that the URL's tokens fetched)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    urls = staged(split_urls(rows).drop("url").withColumn("uid", F.monotonically_increasing_id()), "urls")
    found, tried = matches(urls, staged(compile_rules(rules), "url-compiled"))
    rank = F.struct(F.when(F.col("kind") == "host", 0).otherwise(1).alias("k"),
                    F.when((F.col("kind") == "host") | (F.col("action") == "allow"), 0).otherwise(1).alias("a"),
                    (-F.col("length")).alias("l"), F.col("rule"), F.col("action"))
    best = found.groupBy("uid").agg(F.min(rank).alias("best"))
    return (urls.select("uid", "page_id", "host", "path").join(best, "uid", "left").join(tried, "uid", "left")
            .select("page_id", "host", "path",
                    F.when(F.col("best.k") == 0, F.col("best.rule")).alias("rule"),
                    F.coalesce("best.action", F.lit(default)).alias("verdict"),
                    F.when(F.col("best.k") == 1, F.col("best.rule")).alias("pattern"),
                    F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates")))
