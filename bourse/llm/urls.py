"""URL filters (operator 6): host and path rules, then a blocked Bloom filter before an exact join; SQL functions only.

A rule fits its host and all subdomains if the path starts with the rule's path; the longest rule decides (of equally
long ones that with the longer host). URLs without a rule are looked up in a list. The list's canonical URLs set four
bits in one 64-bit word each; the words, a sixteenth of a listed URL's hash bits, are the filter. A URL of which a bit is
missing is not listed and leaves without a shuffle. The possible hits go to an exact join on the canonical URL, which
removes the filter's false positives. The words are broadcast only up to `BROADCAST_BYTES`, by a count of the list;
beyond it the same join is left to the planner, which shuffles.

Canonical: no scheme, host without ``www.`` or ``m.``, path without a closing slash or ``.html``, no query, no fragment.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and is allowed; repeated URLs get
equal verdicts; an empty list blocks nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.tables import stored

# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Names of hosts whose pages make up the list.
LISTED_NAMES = "casino|pills|bets|ads"
BROADCAST_BYTES = 64 << 20
WORD_BYTES = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    known = F.contains(F.col(url), F.lit("://"))
    rest = F.substring(F.col(url), F.locate("://", F.col(url)) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return tuple(F.when(known, c).otherwise(F.lit("")) for c in (host, path))


def canonical(host: str = "host", path: str = "path") -> Column:
    bare = F.regexp_replace(F.col(host), r"^(www|m)\.", "")
    return F.concat(bare, F.regexp_replace(F.regexp_replace(F.col(path), r"/$", ""), r"\.html$", ""))


def rule_of(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The deciding rule as text and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _mask(key: str) -> Column:
    bits = [F.shiftright(F.col(key), s).bitwiseAND(F.lit(63)).cast("int") for s in (0, 6, 12, 18)]
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, b) for b in bits]
    return masks[0].bitwiseOR(masks[1]).bitwiseOR(masks[2]).bitwiseOR(masks[3])


def possible(urls: DataFrame, listed: DataFrame, n_listed: int) -> DataFrame:
    """``urls`` with ``maybe``: false where the filter proves that ``canonical`` is not in ``listed``."""
    words = 1 << max(4, (max(1, n_listed) // 4).bit_length())
    block = F.pmod(F.shiftright("key", 24), F.lit(words))
    key = F.xxhash64("canonical")
    table = listed.select(key.alias("key")).select(block.alias("word_at"), _mask("key").alias("mask"))
    table = table.groupBy("word_at").agg(F.bit_or("mask").alias("word"))
    if words * WORD_BYTES <= BROADCAST_BYTES:
        table = F.broadcast(table)
    asked = urls.withColumn("key", key).withColumn("mask", _mask("key")).withColumn("at", block)
    hit = F.coalesce(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    return asked.join(table, F.col("at") == F.col("word_at"), "left").select(*urls.columns, hit.alias("maybe"))


def judged(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``listed`` has a column ``canonical``."""
    listed = stored(listed.where("canonical <> ''").select("canonical").distinct(), "listed-urls")
    host, path = host_and_path()
    name, verdict = rule_of(rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("canonical", canonical()).withColumn("rule", name).withColumn("by_rule", verdict)
    asked = possible(urls.where("by_rule is null"), listed, listed.count())
    result = ("page_id", "host", "path", "rule")
    hits = asked.where("maybe").join(listed.withColumn("is_listed", F.lit(True)), "canonical", "left")
    return urls.where("by_rule is not null").select(*result, F.col("by_rule").alias("verdict")).union(
        asked.where(~F.col("maybe")).select(*result, F.lit("allow").alias("verdict"))).union(
        hits.select(*result, F.when(F.col("is_listed"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict")))


def listed_by_name(pages: DataFrame, names: str = LISTED_NAMES) -> DataFrame:
    """The canonical URLs of pages on hosts of which a label has one of the names."""
    host, path = host_and_path()
    urls = pages.select(host.alias("host"), path.alias("path"))
    return urls.where(F.col("host").rlike(rf"(^|[.-])({names})([.-]|$)")).select(canonical().alias("canonical"))
