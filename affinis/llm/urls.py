"""URL filters: allow and block rules, and logistic regression on hashed n-grams of host and path."""

from __future__ import annotations

import hashlib
import re
from functools import cache
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.tables import let

#: Hash buckets of the n-grams (three hexadecimal digits), their lengths, and the unit of weights.
BUCKETS, GRAMS, UNIT = 4096, (3, 4, 5), 1000
#: Log odds above which the model blocks; strings of few known n-grams stay below.
BLOCK_ABOVE = 500

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A small labelled table: names of sites that a corpus does not want, and of others.
BLOCKED = """
casino-royal best-casino online-casino-win casino-win free-casino free-bets sports-bets bets-now live-bets best-bets
cheap-pills buy-pills pills-store diet-pills cheap-meds adult-x adult-video xxx-adult adult-cams adult-chat
spam-farm link-farm seo-spam spam-links click-farm ads-track click-ads track-ads ads-server pop-ads
poker-win jackpot-win win-prize lottery-win payday-loans cheap-loans viagra-cheap replica-cheap cheap-watches
porn-tube free-porn hot-escorts free-spins slots-free
""".split()
ALLOWED = """
news daily-news city-library museum garden weather recipes university history science travel music linux python
hospital school tension therapist thunder nothing other earth mother national question station engineer father method
winter window better alphabet farmer freedom address roads tractor cheese thermal sonata theatre another theory
thing there then shed when wing tone enter ring heat hear ether north south shore thread ashen tether handed
thresh reason orient action notion winner trace adults freely tracks farmland betting-history open-library
""".split()
#: Paths that either kind has, and those that tell; a site is seen with several.
PLAIN_PATHS = ["", "/", "/en/{}", "/de/{}/", "/fr/{}.html", "/es/{}", "/en/{}/", "/{}/{}"]
TELLING = {1: ["/casino/{}", "/bets/free/{}", "/pills/{}", "/adult/{}", "/ads/track?{}"], 0: ["/news/{}", "/article/{}", "/wiki/{}", "/blog/{}", "/docs/{}"]}


def training_urls() -> list[tuple[str, str, int]]:
    """(host, path, label): every name under several sub- and top-level domains and paths."""
    out = []
    for label, names in ((1, BLOCKED), (0, ALLOWED)):
        for i, name in enumerate(names):
            for j, (sub, end) in enumerate(product(("", "www.", "m.", "blog."), ("com", "net", "org"))):
                n = 7919 * (i + 1) * (j + 3) % 1000
                paths = PLAIN_PATHS[(i + j) % len(PLAIN_PATHS)], PLAIN_PATHS[(i + 3 * j + 1) % len(PLAIN_PATHS)]
                paths += (TELLING[label][j % 5],) if j % 6 == 0 else ()
                out += [(f"{sub}{name}.example.{end}", p.format(n, j), label) for p in paths]
    return out


@cache
def weights() -> tuple[tuple[int, ...], int]:
    """(weight of each bucket, bias), in thousandths, from the labelled table."""
    rows = training_urls()
    marks = [[bucket(g) for g in sorted(grams(host, path))] for host, path, _ in rows]
    row, col = np.repeat(np.arange(len(rows)), [len(m) for m in marks]), np.concatenate(marks)
    y = np.array([label for _, _, label in rows], float)
    w, bias = np.zeros(BUCKETS), 0.0
    for _ in range(200):
        odds = np.bincount(row, w[col], len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(odds, -50, 50))) - y
        w -= 0.002 * (np.bincount(col, error[row], BUCKETS) + w)
        bias -= 0.002 * error.sum()
    return tuple(int(v) for v in np.round(w * UNIT)), round(bias * UNIT)


def grams(host: str, path: str) -> set[str]:
    """Distinct n-grams, marked by where they come from; a shorter string is one gram."""
    out = set()
    for mark, s in (("h", f"^{host}$"), ("p", path)):
        for n in GRAMS:
            out |= {mark + s[i : i + n] for i in range(max(1, len(s) - n + 1))}
    return out


def bucket(gram: str) -> int:
    return int(hashlib.md5(gram.encode()).hexdigest()[:3], 16)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def score(host: Column, path: Column) -> Column:
    """The model's log odds that a URL is unwanted, in thousandths, as a whole number."""
    by_bucket, bias = weights()

    def of(mark: str, s: Column) -> Column:
        def cut(n: int) -> Column:
            places = F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1)))
            return F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(s, i, F.lit(n))))

        return F.array_distinct(F.concat(*[cut(n) for n in GRAMS]))

    all_grams = F.concat(of("h", F.concat(F.lit("^"), host, F.lit("$"))), of("p", path))
    table = F.lit(list(by_bucket))
    place = lambda g: F.conv(F.substring(F.md5(g), 1, 3), 16, 10).cast("int")
    return let(all_grams, lambda g: F.aggregate(g, F.lit(bias).cast("bigint"), lambda s, x: s + F.get(table, place(x)).cast("bigint")))


#: (verdict, host and path of the rule)
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def longest_first(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1]), r[1]))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, score, verdict)`` for every row.

    A rule fits its host and all subdomains, for paths that begin with the rule's; the longest
    rule decides, else the model. A null URL or one without ``://`` has an empty host and path,
    so no rule fits. ``rules`` is a list of the caller, checked in one expression. Null ids and
    repeated rows are kept; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
    rows = rows.select(F.col("_id").alias(id_col), host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rule = verdict = None
    for kind, text in longest_first(rules):
        host, slash, rest = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    rule = F.lit(None).cast("string") if rule is None else rule
    scored = rows.select("*", rule.alias("rule"), score(F.col("host"), F.col("path")).alias("score"))
    model = F.when(F.col("score") > BLOCK_ABOVE, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", model if verdict is None else verdict.otherwise(model))


def sql(rules: list[tuple[str, str]]) -> str:
    """The same in SQL."""
    by_bucket, bias = weights()
    cases = {"rule": "", "verdict": ""}
    for kind, text in longest_first(rules):
        host, slash, rest = text.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + rest}')"
        cases["rule"] += f" WHEN {fits} THEN '{text}'"
        cases["verdict"] += f" WHEN {fits} THEN '{kind}'"
    cut = " || ".join(
        f"list_transform(range(1, greatest(length({s}) - {n} + 1, 1) + 1), lambda i: '{mark}' || substr({s}, i, {n}))"
        for mark, s in (("h", "('^' || host || '$')"), ("p", "path"))
        for n in GRAMS
    )
    return f"""
WITH raw AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(u, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path
  FROM raw
), scored AS (
  SELECT *, {bias} + list_sum(list_transform(list_distinct({cut}),
         lambda g: ({list(by_bucket)})[('0x' || substr(md5(g), 1, 3))::INT + 1]::BIGINT))::BIGINT AS score
  FROM parts
)
SELECT page_id, host, path, CASE {cases['rule']} END AS rule,
       CASE {cases['verdict']} WHEN score > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END AS verdict
FROM scored
"""


def split(url: str | None) -> tuple[str, str]:
    """Host and path of one URL, as the columns above have them."""
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
