"""URL filters: rules are found by their rarest literal token, and only those run their pattern."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.llm.tables import bounded_broadcast, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"


@dataclass(frozen=True)
class Rule:
    """``host/path`` rules give their verdict to a host, its subdomains and paths below; ``wild`` rules
    (``*`` any text, ``^`` a separator or the end, ``|`` at either end an anchor) match anywhere in the url."""

    text: str
    verdict: str
    wild: bool = False

    def pattern(self) -> str:
        if not self.wild:
            host, _, path = self.text.partition("/")
            return r"^(?:[^/]*\.)?" + re.escape(host) + "/" + re.escape(path)
        body = self.text.strip("|")
        parts = {"*": ".*", "^": SEPARATOR}
        body = "".join(parts.get(c) or re.escape(c) for c in body)
        return "^" * self.text.startswith("|") + body + "$" * self.text.endswith("|")

    def tokens(self) -> list[str]:
        """Lower-case runs of letters and digits that every matching url has as whole runs."""
        text = self.text.lower()
        if not self.wild:
            host, _, path = text.partition("/")
            # the last run of a path may go on in the url
            path = re.sub(r"[a-z0-9]+$", "", path)
            return re.findall(r"[a-z0-9]+", f"{host}/{path}")
        open_left, open_right = not text.startswith("|"), not text.endswith("|")
        body = text.strip("|")
        found = []
        for m in re.finditer(r"[a-z0-9]+", body):
            left = body[m.start() - 1 : m.start()]
            right = body[m.end() : m.end() + 1]
            if left != "*" and right != "*" and (left or not open_left) and (right or not open_right):
                found.append(m[0])
        return found


HOST_RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)
# what urls without a host rule are held against
PATTERN_RULES = (
    Rule("/login^", "block", wild=True),
    Rule("/cart^", "block", wild=True),
    Rule("*://ads.*^", "block", wild=True),
    Rule("?utm_source=feed", "block", wild=True),
    Rule("&sessionid=*", "block", wild=True),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path after the first ``://``; both empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.translate(url, UPPER, LOWER), "[^a-z0-9]+", -1), lambda t: t != ""))


def judge_urls(
    pages: DataFrame,
    host_rules: tuple[Rule, ...] = HOST_RULES,
    pattern_rules: tuple[Rule, ...] = PATTERN_RULES,
    url: str = "url",
    key: str = "page_id",
) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, patterns (number of wild rules that match).

    The longest host rule that fits decides and is returned as ``rule``. Without
    one, the verdict is ``block`` if any wild rule matches, else ``allow``. Null
    urls and urls without ``://`` have an empty host and path; wild rules still
    look at the latter. Rows are judged one by one, so repeated keys and null keys
    do no harm; an empty table gives an empty result.

    Each rule is filed under the one of its literal tokens that fewest urls have.
    Every distinct url is split into tokens, tokens fetch candidate rules, and only
    candidates run their pattern. Rules without any token are tried on every distinct url, in one expression.
    """
    spark = pages.sparkSession
    urls = saved(pages.filter(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct(), "urls")
    rules = [(i, r.text, r.verdict, r.wild, r.pattern(), r.tokens()) for i, r in enumerate((*host_rules, *pattern_rules))]
    table = spark.createDataFrame(rules, "rule_id int, rule string, verdict string, wild boolean, pattern string, tokens array<string>")
    filed = _filed(spark, urls, table)
    host, path = host_and_path(F.col("url"))
    parts = urls.select("url", host.alias("host"), path.alias("path"), F.explode_outer(url_tokens(F.col("url"))).alias("token"))
    candidates = parts.join(bounded_broadcast(filed), "token").drop("token")
    subject = F.when(F.col("wild"), F.col("url")).otherwise(F.concat("host", "path"))
    hits = candidates.filter(F.regexp_like(subject, F.col("pattern"))).select("url", "rule", "verdict", "wild")
    if free := [r for r in (*host_rules, *pattern_rules) if not r.tokens()]:
        hits = hits.unionByName(urls.select("url", F.inline(_matching(free, host, path))))
    longest = F.max(F.when(~F.col("wild"), F.struct(F.length("rule").alias("n"), "rule", F.col("verdict").alias("by_rule"))))
    found = hits.groupBy("url").agg(
        longest.alias("best"),
        F.count(F.when(F.col("wild") & (F.col("verdict") == "block"), 1)).alias("patterns"),
    )
    found = found.select(F.col("url").alias("hit_url"), F.col("best.rule").alias("rule"), F.col("best.by_rule").alias("by_rule"), "patterns")
    host, path = host_and_path(F.col("u_url"))
    rows = pages.select(F.col(key).alias("u_key"), F.col(url).alias("u_url"))
    rows = rows.join(found, F.col("u_url") == F.col("hit_url"), "left")
    return rows.select(
        F.col("u_key").alias(key),
        host.alias("host"),
        path.alias("path"),
        "rule",
        F.coalesce("by_rule", F.when(F.col("patterns") > 0, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("patterns", F.lit(0).cast("long")).alias("patterns"),
    )


def _matching(rules: list[Rule], host: Column, path: Column) -> Column:
    """The rules (rule, verdict, wild) that fit the row's url."""

    def one(rule: Rule) -> Column:
        subject = F.col("url") if rule.wild else F.concat(host, path)
        found = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"), F.lit(rule.wild).alias("wild"))
        return F.when(F.regexp_like(subject, F.lit(rule.pattern())), found)

    return F.array_compact(F.array(*map(one, rules)))


def _filed(spark: SparkSession, urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules under their rarest token; those without a token are left out."""
    by_token = rules.select("*", F.explode("tokens").alias("token")).drop("tokens")
    wanted = by_token.select("token").distinct()
    seen = urls.select(F.explode(url_tokens(F.col("url"))).alias("token")).join(bounded_broadcast(wanted), "token", "left_semi")
    seen = seen.groupBy("token").agg(F.count("*").alias("n"))
    counted = by_token.join(seen, "token", "left").fillna({"n": 0})
    rarest = counted.groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("at"))
    filed = by_token.join(rarest, "rule_id").filter(F.col("token") == F.col("at.token")).drop("at").dropDuplicates(["rule_id"])
    return saved(filed, "url-rules")
