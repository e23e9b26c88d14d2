"""Judge URLs by rules, and by a tree of path templates per host where no rule fits.

1. Host and path are cut out of the URL; the longest rule that fits decides.
2. Paths become templates, level by level: numbers, hexadecimal and long mixed segments turn into wildcards at once;
   other segments turn into one where the place in the tree (host and template so far) shows many different values, few
   times each. A branch of fewer than ``VARIABLE_VALUES`` different paths has no such place, so its paths are done at
   once. There is no limit of depth: levels are added while any branch has more.
3. URLs that a rule decides are the labelled ones. From the deepest level up, each branch is held against the other
   branches of its place. One whose share of blocked URLs differs significantly (two-proportion test) is split off, and
   counts as one URL of that share for its place; all others are merged into their place, which is then held against the
   branches beside it. Branches without labelled URLs cannot differ, so they belong to the nearest place with labels.
4. A template is rejected if the smoothed share of blocked URLs of what it was merged into, (blocked + ``PRIOR_WEIGHT`` *
   ``PRIOR``) / (labelled + ``PRIOR_WEIGHT``), exceeds ``MOST_BLOCKED``. Without labels on its host that is the prior, so
   unknown templates stay.

Every step is an aggregate with partial sums over (host, template), so one host may hold most URLs; results go back to
the URLs by joins on those keys. Each level is a few small aggregates: going down as many as the deepest place that many
paths share, going up as many as the deepest place with two labelled branches. Null URLs and URLs without "://" have empty host and path and are allowed. Null ids
and repeated rows pass through; repeated URLs count as often as they occur. No pages, no rows. Extra columns are kept by
``judge``. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name, staged

#: A place with at least so many different segments, each so many times on average at most, is variable.
VARIABLE_VALUES, VARIABLE_USES = 20, 8.0
PRIOR, PRIOR_WEIGHT, MOST_BLOCKED = 0.1, 4.0, 0.5
#: Two-sided 1% limit of the normal distribution.
SIGNIFICANT = 2.576
WILD = "*"
COUNTS = ["n", "labelled", "blocked"]


@dataclass(frozen=True)
class Rule:
    """Fits a host with all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first "://", empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Text and verdict of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _segment(raw: Column) -> Column:
    """A segment, or a wildcard where its form alone shows that it varies."""
    bare = F.regexp_replace(raw, r"\.[A-Za-z0-9]{1,5}$", "")
    varies = bare.rlike(r"^[0-9]+$") | bare.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$") | bare.rlike(r"^(?=.*[0-9]).{24,}$")
    return F.when(varies, F.lit(WILD)).otherwise(raw)


def templates(urls: DataFrame) -> DataFrame:
    """Template of each distinct (host, segments), with counts; ``urls``: host, segments, n, labelled, blocked."""
    tree, level, done = urls.withColumn("template", F.lit("")), 0, []
    ended = F.size("segments") <= F.col("level")
    rest = F.expr("slice(segments, level + 1, greatest(size(segments) - level, 0))")
    whole = F.when(ended, F.col("template")).otherwise(F.concat("template", F.lit("/"), F.array_join(rest, "/")))
    while True:
        tree = tree.withColumn("level", F.lit(level))
        paths = tree.filter(~ended).groupBy("host", "template").agg(F.count("*").alias("paths"))
        many = paths.filter(F.col("paths") >= VARIABLE_VALUES).select(
            F.col("host").alias("m_host"), F.col("template").alias("m_template")
        )
        at = (F.col("host") == F.col("m_host")) & (F.col("template") == F.col("m_template")) & ~ended
        told = staged(tree.join(many, at, "left").withColumn("more", F.col("m_host").isNotNull()), "url_level")
        done.append(told.filter("not more").withColumn("template", whole).select(*urls.columns, "template"))
        tree = told.filter("more").select(*urls.columns, "template")
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, done)
        tree = tree.withColumn("here", F.get("segments", F.lit(level)))
        values = tree.groupBy("host", "template", "here").agg(F.sum("n").alias("n"))
        places = (
            values.groupBy("host", "template")
            .agg(F.count("*").alias("values"), F.sum("n").alias("uses"))
            .filter((F.col("values") >= VARIABLE_VALUES) & (F.col("uses") <= VARIABLE_USES * F.col("values")))
            .select(F.col("host").alias("v_host"), F.col("template").alias("v_template"))
        )
        same = (F.col("host") == F.col("v_host")) & (F.col("template") == F.col("v_template"))
        step = F.when(F.col("v_host").isNotNull(), F.lit(WILD)).otherwise(F.col("here"))
        tree = tree.join(places, same, "left").select(
            *urls.columns, F.concat("template", F.lit("/"), step).alias("template")
        )
        level += 1


def _upto(depth: Column) -> Column:
    """The first ``depth`` levels of ``template``; 0 for the root."""
    return F.array_join(F.slice(F.split("template", "/", -1), F.lit(1), depth + 1), "/")


def purity(tree: DataFrame) -> DataFrame:
    """Smoothed share of blocked URLs of each (host, template), after merging similar branches from the leaves up."""
    depth = F.size(F.split("template", "/", -1)) - 1
    sums = [F.sum(c).cast("double").alias(c) for c in ("labelled", "blocked")]
    leaves = tree.groupBy("host", "template").agg(*sums)
    pool = staged(leaves.filter("labelled > 0").withColumn("depth", depth), "url_labels")
    levels = pool.withColumn("at", F.explode(F.when(F.col("depth") > 0, F.sequence(F.lit(1), "depth"))))
    branches = levels.select("host", "at", _upto(F.col("at") - 1).alias("place"), _upto(F.col("at")).alias("branch"))
    forks = branches.distinct().groupBy("host", "at", "place").count().filter("count > 1")
    deepest = forks.agg(F.max("at")).first()[0] or 0
    split = []
    n, k = F.col("labelled"), F.col("blocked")
    m, j = F.col("all_labelled") - n, F.col("all_blocked") - k
    share = F.col("all_blocked") / F.nullif(F.col("all_labelled"), F.lit(0.0))
    spread = F.sqrt(share * (1 - share) * (1 / n + 1 / F.nullif(m, F.lit(0.0))))
    distance = F.abs(k / n - j / F.nullif(m, F.lit(0.0)))
    differs = F.coalesce((n > 0) & (m > 0) & (distance > SIGNIFICANT * spread), F.lit(False))
    for at in range(deepest, 0, -1):
        here = pool.filter(F.col("depth") >= at).withColumn("template", _upto(F.lit(at)))
        here = here.groupBy("host", "template").agg(*sums).withColumn("place", _upto(F.lit(at - 1)))
        places = here.groupBy("host", "place").agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
        here = staged(here.join(places, ["host", "place"]).withColumn("differs", differs), "url_branches")
        split.append(here.filter("differs").select("host", "template", "labelled", "blocked"))
        one = F.col("differs")
        merged = here.select(
            "host", F.col("place").alias("template"), F.lit(at - 1).alias("depth"),
            F.when(one, F.lit(1.0)).otherwise(n).alias("labelled"), F.when(one, k / n).otherwise(k).alias("blocked"),
        )
        pool = staged(pool.filter(F.col("depth") < at).unionByName(merged), "url_pool")
    roots = pool.groupBy("host").agg(*sums).withColumn("template", F.lit(""))
    closed = reduce(DataFrame.unionByName, split, roots).select(
        F.col("host").alias("c_host"), F.col("template").alias("c_template"),
        ((F.col("blocked") + PRIOR * PRIOR_WEIGHT) / (F.col("labelled") + PRIOR_WEIGHT)).alias("blocked_share"),
    )
    # A template belongs to the nearest branch above it (or itself) that was split off.
    above = leaves.select("host", "template").withColumn("at", F.explode(F.sequence(F.lit(0), F.least(depth, F.lit(deepest)))))
    above = above.withColumn("branch", _upto(F.col("at")))
    same = (F.col("host") == F.col("c_host")) & (F.col("branch") == F.col("c_template"))
    nearest = F.max(F.when(F.col("blocked_share").isNotNull(), F.struct("at", "blocked_share")))["blocked_share"]
    found = above.join(closed, same, "left").groupBy("host", "template").agg(nearest.alias("blocked_share"))
    return found.withColumn("blocked_share", F.coalesce("blocked_share", F.lit(PRIOR)))


def judge(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``blocked_share`` (columns of these names
    are replaced)."""
    added = {"host", "path", "rule", "verdict", "template", "blocked_share"}
    row = free_name(pages, "row")
    kept = [c for c in pages.columns if c.lower() not in added or c == url]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    cut = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias(row), host.alias("host"), path.alias("path"))
    segments = F.transform(F.filter(F.split("path", "/", -1), lambda s: s != ""), _segment)
    cut = cut.withColumns({"rule": rule_of(F.col("host"), F.col("path"), rules), "segments": segments})
    counted = cut.groupBy("host", "segments").agg(
        F.count("*").alias("n"),
        F.count("rule").alias("labelled"),
        F.sum(F.when(F.col("rule.verdict") == "block", 1).otherwise(0)).alias("blocked"),
    )
    tree = staged(templates(staged(counted, "urls")), "templates")
    known = tree.join(purity(tree), ["host", "template"]).select(
        F.col("host").alias("k_host"), F.col("segments").alias("k_segments"), "template", "blocked_share"
    )
    own = F.when(F.col("blocked_share") > MOST_BLOCKED, F.lit("block")).otherwise(F.lit("allow"))
    same = (F.col("host") == F.col("k_host")) & (F.col("segments") == F.col("k_segments"))
    return cut.join(known, same, "left").select(
        f"{row}.*", "host", "path", F.col("rule.text").alias("rule"),
        F.coalesce("rule.verdict", own).alias("verdict"), "template", "blocked_share",
    )


def query(pages: DataFrame) -> DataFrame:
    judged = judge(pages.select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("blocked_share", 9).alias("blocked_share"))
