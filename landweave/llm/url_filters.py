"""URL filters: longest matching rule, else trust and distrust propagated over the links between hosts. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules of the contract: (verdict, host and path).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"
FOLLOW, SETTLED, LEAST, DIGITS = 0.85, 1e-7, 0.5, 4


def rounds(follow: float = FOLLOW) -> int:
    """After so many rounds what still moves is below ``SETTLED``, whatever the graph."""
    return math.ceil(math.log(SETTLED) / math.log(follow))



def parsed(df: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` and ``path`` of a url column; both empty where it is null or has no ``://``."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    return (
        df.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
        .withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0))
        .withColumn("host", F.translate("_host", UPPER, LOWER))
        .drop("_rest", "_host")
    )


def matched(rules: list[tuple[str, str]], verdict: bool) -> Column:
    """The longest rule (or its verdict) that fits ``host`` and ``path``."""
    out = F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        host, _, rest = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + rest)
        out = F.when(fits, F.lit(what if verdict else rule)).otherwise(out)
    return out


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, follow: float = FOLLOW, least: float = LEAST) -> DataFrame:
    """Per page: ``host``, ``path``, ``rule``, ``verdict``, and ``trust`` and ``distrust`` of its host.

    Seeds of a host are the shares of its pages that rules allow and block. Trust is personalised PageRank along links between hosts,
    distrust the same against them, both as multiples of what a seed of 1 has by itself; links of a host to itself say nothing and are left
    out. Rounds go on until no host's trust or distrust moves by more than ``SETTLED``. A page without a rule is blocked if its host's
    distrust is ``least`` or more and above its trust.
    Links come from ``href`` of ``html``; relative ones lead to the page's own host. Null urls have an empty host and path, no links and no
    seed: allowed. A null ``html`` has no links. Repeated rows are judged each. Other columns are ignored.
    Links and seeds are counted before shuffles, so a host with most pages is one row a task; html is never shuffled. Pages meet their
    host's figures by a join of page_id, host and path that can be split for a large host.
    """
    judged = parsed(pages.select("page_id", "url", "html"), "url").withColumn("rule", matched(rules, False)).withColumn("verdict", matched(rules, True))
    links = (
        judged.filter("host <> ''")
        .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
        .withColumn("link", F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    )
    edges = (
        parsed(links, "link")
        .select("src", F.when(F.col("host") != "", F.col("host")).when(F.instr("link", ":") > 0, F.lit(None)).otherwise(F.col("src")).alias("dst"))
        .filter("dst IS NOT NULL AND dst <> src")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )
    edges = written(edges, "host-links")
    seeds = (
        judged.filter("host <> ''")
        .groupBy("host")
        .agg((F.count_if(F.col("verdict") == "allow") / F.count("*")).alias("s"), (F.count_if(F.col("verdict") == "block") / F.count("*")).alias("b"))
    )
    hosts = edges.select(F.col("dst").alias("host")).distinct().join(seeds, "host", "full").fillna(0.0, ["s", "b"])
    hosts = written(hosts, "host-seeds")
    out_n, in_n = edges.groupBy("src").agg(F.sum("n").alias("out_n")), edges.groupBy("dst").agg(F.sum("n").alias("in_n"))
    weighed = written(edges.join(out_n, "src").join(in_n, "dst").select("src", "dst", (F.col("n") / F.col("out_n")).alias("wt"), (F.col("n") / F.col("in_n")).alias("wd")), "host-weights")
    state = hosts.select("host", "s", "b", F.col("s").alias("t"), F.col("b").alias("d"))
    for k in range(rounds(follow)):
        along = weighed.join(state.select(F.col("host").alias("src"), "t"), "src").select(F.col("dst").alias("host"), (F.col("t") * F.col("wt")).alias("dt"), F.lit(0.0).alias("dd"))
        against = weighed.join(state.select(F.col("host").alias("dst"), "d"), "dst").select(F.col("src").alias("host"), F.lit(0.0).alias("dt"), (F.col("d") * F.col("wd")).alias("dd"))
        got = along.unionByName(against).groupBy("host").agg(F.sum("dt").alias("dt"), F.sum("dd").alias("dd"))
        before = state.select("host", F.col("t").alias("t0"), F.col("d").alias("d0"))
        state = hosts.join(got, "host", "left").join(before, "host").select(
            "host", "s", "b", (F.col("s") + follow * F.coalesce("dt", F.lit(0.0))).alias("t"), (F.col("b") + follow * F.coalesce("dd", F.lit(0.0))).alias("d"), "t0", "d0"
        )
        state = written(state, f"host-trust-{k}")
        moved = state.agg(F.max(F.greatest(F.abs(F.col("t") - F.col("t0")), F.abs(F.col("d") - F.col("d0"))))).first()[0]
        if (moved or 0) < SETTLED:
            break
    ranks = state.select("host", F.round("t", DIGITS).alias("trust"), F.round("d", DIGITS).alias("distrust"))
    by_method = F.when((F.col("distrust") >= least) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return judged.drop("url", "html").join(ranks, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "trust", "distrust")
