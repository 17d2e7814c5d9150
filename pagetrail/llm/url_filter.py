"""URL rules, and for all other pages a verdict by trust along the links between hosts.

Trust starts at hosts of pages that a rule allows and follows their links; distrust
starts at hosts of pages that a rule blocks and goes against the links, to the hosts
that point there. Both are personalised PageRanks, computed as joins and sums over the
distinct edges between hosts, and their shares decide for each host.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.text import ascii_lower
from pagetrail.sources.scratch import scratch_table

DAMPING = 0.85
TOLERANCE = 1e-6  # by which a host's value may still change, in parts of it, when steps end
THRESHOLD = 0.8  # the share of distrust from which a host is blocked

_AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINKS = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """Fits its host and the subdomains, for paths that start with its path."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        inside = (host == self.host) | host.endswith("." + self.host)
        return inside & path.startswith(self.path)


# The rules that pages are judged by.
RULES = (
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``; empty without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _AUTHORITY, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AUTHORITY, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The text of the longest rule that fits, and whether it allows; null without one."""
    text, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = rule.fits(host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        allow = F.when(fits, F.lit(rule.allow)).otherwise(allow)
    return text, allow


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src``, ``dst`` and ``n``: the links from the pages of one host to another's.

    Relative links stay on the host; links of other schemes (``mailto:``) are no edges.
    """
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINKS), 1)).alias("link"),
    ).filter("src <> ''")
    link = F.col("link")
    target = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), host_of(link))
        .when(link.startswith("//"), host_of(F.concat(F.lit("http:"), link)))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(""))
        .otherwise(F.col("src"))
    )
    found = links.select("src", target.alias("dst")).filter("dst <> ''")
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    iterations: int | None = None,
    damping: float = DAMPING,
) -> DataFrame:
    """``node``, ``trust`` and ``distrust`` of every host that any of it reaches.

    ``edges`` has src, dst and n; ``seeds`` has node, ``allowed`` and ``blocked`` (how
    much of each starts there; each is scaled to a sum of one). A step passes a host's
    value on in proportion to its links; what has no link to follow is lost. Without
    ``iterations`` steps go on until none reaches another host and no host's value
    changes by more than ``TOLERANCE`` of itself, however small it is.
    """
    ahead = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    back = edges.select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"
    )
    both = ahead.union(back)
    total = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    both = both.join(total, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")
    )
    both = scratch_table(both, "host-edges")
    sums = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    start = [
        seeds.filter(F.col(column) > 0).select(
            F.lit(kind).alias("kind"), "node", (F.col(column) / float(total or 1)).alias("value")
        )
        for kind, column, total in (
            ("trust", "allowed", sums["a"]),
            ("distrust", "blocked", sums["b"]),
        )
    ]
    start = scratch_table(start[0].union(start[1]), "seeds")
    again = start.withColumn("value", (1 - damping) * F.col("value"))
    ranks = written = start
    for step in itertools.count() if iterations is None else range(iterations):
        share = damping * F.col("share") * F.col("value")
        passed = both.join(ranks.withColumnRenamed("node", "src"), ["kind", "src"])
        passed = passed.select("kind", F.col("dst").alias("node"), share.alias("value"))
        ranks = passed.union(again).groupBy("kind", "node").agg(F.sum("value").alias("value"))
        if step % 5 == 4 or step + 1 == iterations:
            ranks = scratch_table(ranks, "ranks")
            if iterations is None and _settled(written, ranks):
                break
            written = ranks
    sides = {
        kind: F.sum(F.when(F.col("kind") == kind, F.col("value")).otherwise(0.0)).alias(kind)
        for kind in ("trust", "distrust")
    }
    return ranks.groupBy("node").agg(*sides.values())


def _settled(before: DataFrame, after: DataFrame) -> bool:
    """Whether all values of ``after`` were there before, but for the tolerance."""
    old = before.withColumnRenamed("value", "old")
    change = F.abs(F.col("value") - F.coalesce("old", F.lit(0.0)))
    changed = after.join(old, ["kind", "node"], "left").filter(change > TOLERANCE * F.col("value"))
    return changed.isEmpty()


def judge_pages(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) of each row.

    Where no rule fits, a host is blocked if distrust is at least ``threshold`` of its
    trust and distrust; a host that neither reaches is allowed. A null url or one
    without ``://`` has an empty host and path and is allowed. A null html has no links.
    Repeated rows are judged each, and their links count each.
    """
    split = pages.select(
        F.col(key).alias(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    rule, allow = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "_allow": allow})
    seeds = ruled.filter("_allow is not null").groupBy(F.col("host").alias("node")).agg(
        F.count(F.when(F.col("_allow"), 1)).alias("allowed"),
        F.count(F.when(~F.col("_allow"), 1)).alias("blocked"),
    )
    seeds = scratch_table(seeds, "rule-hosts")
    ranks = propagate(host_edges(pages, url, html), seeds, iterations=None)
    share = F.col("distrust") / F.nullif(F.col("trust") + F.col("distrust"), F.lit(0.0))
    bad = ranks.filter(share >= threshold).select(
        F.col("node").alias("host"), F.lit(True).alias("_bad")
    )
    blocked = F.coalesce(~F.col("_allow"), F.col("_bad"), F.lit(False))
    verdict = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(bad, "host", "left").select(
        key, "host", "path", "rule", verdict.alias("verdict")
    )
