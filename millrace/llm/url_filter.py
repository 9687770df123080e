"""URL filter: rules first, then trust that spreads over links between hosts.

A rule is a host and the start of a path; it fits the host and its subdomains, and the
longest rule wins. Hosts with pages that a rule allows are trusted seeds, hosts with pages
that a rule blocks are distrusted ones, both weighted by those pages. Trust is personalised
PageRank from the trusted seeds along links; distrust is the same from the distrusted seeds
against the links, so who links to bad hosts is suspect. A page without a rule gets its
host's verdict: block if the host's share of distrust reaches ``threshold`` of the sum.

Edges are pairs of hosts, counted on the map side, so a hot host or link is a row. Ranks are
whole numbers of tiny units, so no sum depends on the order of rows. They grow from what the
seeds hold at home until no host is new and none changes by more than ``settled``; a rank is
followed down to 1 / (UNITS * FINE) of the whole, and given in units of 1 / UNITS.

Defined results: a null URL or one without ``://`` has an empty host and path and, having no
neighbours, is allowed; null pages link to nothing; repeated rows are judged alike and weigh
twice; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import keep, session
from millrace.llm.license_scan import LOWER, UPPER

# Fixed values of the contract.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UNITS = 10**15
FINE = 10**16  # parts of a unit; a rank in them has 31 digits


@dataclass(frozen=True)
class Spread:
    damping_percent: int = 85
    rounds: int = 8  # that the SQL spells out; ``propagate`` goes on until ranks are settled
    settled: int = 1_000_000  # a host's rank may still change by this part of it
    threshold_percent: int = 75
    salts: int = 16


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    part = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(part, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """``rule, verdict`` of the longest rule that fits, or null."""
    fits = F.array(*[
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"),
                     F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ])
    return F.array_max(F.array_compact(fits))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between different hosts, from the absolute links of whole pages."""
    links = F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"(?i)(?:href|src)\s*=\s*[\"']?\s*((?:https?:)?//[^\s\"'<>]+)"),
        F.lit(1),
    )
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    each = pages.select("host", F.explode(links).alias("link")).select(
        F.col("host").alias("src"), host_of(target).alias("dst")
    )
    return each.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(
        F.count("*").alias("n")
    )


def propagate(edges: DataFrame, seeds: DataFrame, how: Spread) -> DataFrame:
    """``host, rank``: rank that starts at the seeds (``host, seed``, together UNITS) and flows
    along the edges by their counts; a host without edges keeps none of what it would send.

    Ranks, in parts of a unit, never fall from round to round and are bounded, so the loop ends."""
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    spread = edges.join(out, "src").select("src", "dst", "n", "out")
    home = keep(seeds.select("host", _share(
        F.col("seed").cast("decimal(38,0)") * F.lit(FINE).cast("decimal(17,0)"),
        F.lit(100 - how.damping_percent), F.lit(100),
    ).alias("rank")), "ranks")
    rank = home
    while True:
        sent = rank.join(spread, rank["host"] == spread["src"]).select(
            F.col("dst").alias("host"),
            _share(F.col("rank"), F.lit(how.damping_percent) * F.col("n"), F.lit(100) * F.col("out")).alias("rank"),
        )
        new, old = F.sum("rank").cast(RANK), F.coalesce(F.sum("old"), F.lit(0)).cast(RANK)
        none = F.lit(None).cast(RANK).alias("old")
        both = sent.select("host", "rank", none).union(home.select("host", "rank", none)).union(
            rank.select("host", F.lit(0).cast(RANK), F.col("rank").alias("old"))
        )
        rank = keep(both.groupBy("host").agg(new.alias("rank"), old.alias("old")).filter("rank > 0"), "ranks")
        moving = rank.filter((F.col("rank") - F.col("old")) > F.col("rank") / F.lit(how.settled))
        rank = rank.drop("old")
        if moving.isEmpty():
            return rank


RANK = "decimal(38,0)"


def _share(whole: Column, part: Column, of: Column) -> Column:
    """``whole * part / of``, rounded down to a whole number, for ``part`` up to ``of``: no
    product is larger than ``whole`` or ``of`` squared."""
    part, of = part.cast("decimal(18,0)"), of.cast("decimal(18,0)")
    rest = whole % of
    small = rest.cast("decimal(18,0)") * part
    return (((whole - rest) / of).cast(RANK) * part + ((small - small % of) / of).cast(RANK)).cast(RANK)


def seeds_of(pages: DataFrame, verdict: str) -> DataFrame:
    """``host, seed``: hosts by their pages with a rule of that verdict; together UNITS."""
    counted = pages.filter(F.col("rule.verdict") == verdict).groupBy("host").agg(F.count("*").alias("n"))
    total = counted.select(F.coalesce(F.sum("n"), F.lit(1))).scalar()
    return counted.select("host", _share(F.lit(UNITS).cast(RANK), F.col("n"), total).alias("seed"))


def judge(pages: DataFrame, rules=RULES, how: Spread = Spread()) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    session(pages.sparkSession)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    judged = parsed.withColumn("rule", best_rule(F.col("host"), F.col("path"), rules))
    narrow = keep(judged.select("page_id", "host", "path", "rule"), "judged")
    edges = keep(host_edges(parsed), "edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = propagate(edges, seeds_of(narrow, "allow"), how).withColumnRenamed("rank", "trust")
    distrust = propagate(back, seeds_of(narrow, "block"), how).withColumnRenamed("rank", "distrust")
    # A host with very many pages is spread by a salt; the ranks of a host are one row.
    ranks = trust.join(distrust, "host", "full").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(how.salts - 1)))
    )
    salt = F.pmod(F.xxhash64("page_id", "path"), F.lit(how.salts)).cast("int")

    def units(rank: Column) -> Column:
        return ((rank - rank % F.lit(FINE)) / F.lit(FINE)).cast("long")

    met = narrow.withColumn("salt", salt).join(ranks, ["host", "salt"], "left")
    t, d = (F.coalesce(x, F.lit(0).cast(RANK)) for x in ("trust", "distrust"))
    suspect = (d > 0) & ((100 - how.threshold_percent) * d >= how.threshold_percent * t)
    return met.select(
        "page_id", "host", "path", F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        units(t).alias("trust"), units(d).alias("distrust"),
    )
