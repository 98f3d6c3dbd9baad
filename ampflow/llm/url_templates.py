"""URL filter: a tree of path templates per host, judged by labels, under a list of rules.

Paths of a host form a tree by segments. Level by level, segments that vary become wildcards of their shape, except
those whose own labels tell them from their parent; and sibling branches whose labels do not differ from their
parent's beyond chance are merged, as there is no reason to tell them apart. A template (a path through that tree) is rejected if its purity, the share of good pages among its
labelled ones drawn to the overall share, is too low. Rules come first: the longest rule that fits decides.

Counts combine before every shuffle. The tree is built over distinct paths; what a level decides is written, and
joined to the paths by host, template so far and segment, where adaptive execution splits a very common branch.

Below ``DEPTH`` segments the tree grows only where labels of both kinds are left to tell apart, as deep as such paths
go; segments that are not told apart there, and the end of a path among them, share one ``~``.

Corner cases: a null URL or one without ``://`` has an empty host and path, like any other host. Repeated rows are judged alike. Without labels no template is
rejected. Several labels of one page: it is bad if any is. An empty table gives no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.llm.common import read_table, written

#: Levels that every template spells out; deeper ones it shows only where labels tell them apart.
DEPTH = 8
#: A node's segments vary if there are so many; then those with less than this share of its pages become wildcards,
#: unless their labels would differ so much from the parent's with at most ``CHANCE``, shared among all segments.
LEAST_VARIANTS = 5
LITERAL_SHARE = 0.1
CHANCE = 0.05
#: Standard deviations by which a branch must differ from its parent to stay apart.
APART = 1.96
#: Pages' worth of the overall share in a template's purity, and the purity below which it is rejected.
SMOOTHING = 5.0
#: Stands for the end of a path among longer ones; no segment holds a slash.
END = "/{end}"
LEAST_PURITY = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/``, ``?``, ``#`` or the end, in lower case; then the path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(known, pattern, 2)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null; of equally long ones the first by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Segments of a path, which are the levels of the tree."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(parts)


def wildcard(segment: Column) -> Column:
    """The shape that stands for a varying segment: a number, or anything, with its file extension."""
    shown = F.when(segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$"), F.lit("{number}")).otherwise(F.lit("*"))
    return F.concat(shown, F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1))


def told_apart(labelled: Column, bad: Column, rate: Column, variants: Column) -> Column:
    """Whether ``bad`` of ``labelled`` is beyond chance at ``rate``, by Chernoff's bound, which also holds for few labels."""

    def share(own: Column, expected: Column) -> Column:
        return F.when(own > 0, own * F.ln(own / expected)).otherwise(F.lit(0.0))

    surprise = share(bad, labelled * rate) + share(labelled - bad, labelled * (1 - rate))
    return surprise > F.ln(2 * variants / CHANCE)


def grown(paths: DataFrame, level: int) -> DataFrame:
    """``paths`` with the template one segment longer where the path goes on.

    Below ``DEPTH`` levels, ``paths`` are those to be told apart; the end of a path is a branch like any other.
    """
    key = ["host", "template"]
    segment = F.coalesce(F.get("segments", F.lit(level)), F.lit(END))
    goes_on = F.lit(True) if level > DEPTH else F.size("segments") > level
    going = paths.where(goes_on)
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "bad")]
    children = written(going.groupBy(*key, segment.alias("segment")).agg(*sums), "children")
    nodes = children.groupBy(*key).agg(
        F.count("*").alias("variants"),
        F.sum("pages").alias("all_pages"),
        F.sum("labelled").alias("all_labelled"),
        F.sum("bad").alias("all_bad"),
    )
    rate = F.when(F.col("all_labelled") > 0, F.col("all_bad") / F.col("all_labelled")).otherwise(F.lit(0.0))
    rare = (F.col("variants") >= LEAST_VARIANTS) & (F.col("pages") < LITERAL_SHARE * F.col("all_pages"))
    apart = told_apart(F.col("labelled"), F.col("bad"), rate, F.col("variants"))
    named = children.join(nodes, key).withColumn(
        "branch", F.when(rare & ~apart, wildcard(F.col("segment"))).otherwise(F.col("segment"))
    )
    named = written(named, "named")
    branches = named.groupBy(*key, "branch").agg(
        F.sum("labelled").alias("branch_labelled"),
        F.sum("bad").alias("branch_bad"),
        F.max("all_labelled").alias("all_labelled"),
        F.max("all_bad").alias("all_bad"),
    )
    expected = F.col("branch_labelled") * rate
    spread = F.sqrt(expected * (1 - rate))
    alike = F.abs(F.col("branch_bad") - expected) <= APART * spread
    merged = branches.select(*key, "branch", F.when(alike, F.lit("~")).otherwise(F.col("branch")).alias("shown"))
    decided = written(named.select(*key, "segment", "branch").join(merged, [*key, "branch"]).drop("branch"), "decided")
    longer = going.withColumn("segment", segment).join(decided, [*key, "segment"])
    # In the depths, what is not told apart from a template that already ends so adds nothing to it.
    same = F.lit(level > DEPTH) & (F.col("shown") == "~") & F.col("template").endswith("/~")
    template = F.when(same, F.col("template")).otherwise(F.concat("template", F.lit("/"), "shown"))
    longer = longer.withColumn("template", template).select(*paths.columns)
    return written(longer.union(paths.where(~goes_on)), "paths")


def deeper(paths: DataFrame, level: int) -> tuple[DataFrame, DataFrame, int | None]:
    """``paths`` that are settled, those that may still be told apart from ``level`` on, and at which level the first are.

    A branch can differ by ``APART`` only from a parent with labels of both kinds, and more than ``APART`` squared of
    one: a branch with all the bad ones alone differs most, by the root of the number of good ones, and the reverse.
    """
    key = ["host", "template"]
    rest = F.slice("segments", level + 1, F.greatest(F.size("segments"), F.lit(1)))
    nodes = paths.groupBy(*key).agg(
        F.sum("bad").alias("bads"),
        F.sum(F.col("labelled") - F.col("bad")).alias("goods"),
        F.min(rest).alias("least"),
        F.max(rest).alias("most"),
    )
    # All between the least and the most begin with what these two have in common.
    differs = F.array_position(F.zip_with("least", "most", lambda a, b: a.eqNullSafe(b)), False)
    mixed = (F.col("bads") > 0) & (F.col("goods") > 0) & (F.greatest("bads", "goods") > APART**2)
    splitting = nodes.where(mixed).withColumn("differs", differs.cast("int")).where("differs > 0").select(*key, "differs")
    splitting = written(splitting, "splitting")
    first = splitting.agg(F.min("differs")).first()[0]
    if first is None:
        return paths, paths.limit(0), None
    found = paths.join(splitting, key, "left").select(*paths.columns, F.col("differs").isNotNull().alias("splits"))
    found = written(found, "deep")
    return found.where("NOT splits").drop("splits"), found.where("splits").drop("splits"), level + first - 1


def judged_paths(pages: DataFrame) -> DataFrame:
    """``(host, path, template, purity, verdict)`` of the distinct paths in ``(host, path, label)``.

    ``label`` is 1 for a bad page, 0 for a good one, null where unknown.
    """
    counted = pages.groupBy("host", "path").agg(
        F.count("*").alias("pages"),
        F.count("label").alias("labelled"),
        F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("bad"),
    )
    paths = counted.withColumn("segments", segments(F.col("path"))).withColumn("template", F.lit(""))
    paths = written(paths, "paths")
    depth, labelled, bad = paths.agg(F.max(F.size("segments")), F.sum("labelled"), F.sum("bad")).first()
    for level in range(min(depth or 0, DEPTH + 1)):
        paths = grown(paths, level)
    settled, level = [], DEPTH + 1
    while level < (depth or 0):
        done, paths, first = deeper(paths, level)
        settled.append(done)
        if first is None:
            break
        level = first + 1
        paths = grown(paths, first)
    for done in settled:
        paths = paths.union(done)
    if settled:
        paths = written(paths, "paths")
    share = 1 - bad / labelled if labelled else 1.0
    templates = paths.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("labelled") - F.col("bad") + SMOOTHING * share) / (F.col("labelled") + SMOOTHING)
    templates = templates.select("host", "template", purity.alias("purity"))
    verdict = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    found = paths.select("host", "path", "template").join(templates, ["host", "template"])
    return found.select("host", "path", "template", "purity", verdict.alias("verdict"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Host, path, rule, template and verdict of every row of ``(page_id, url)``; labels are ``(page_id, label)``."""
    host, path = host_and_path(F.col("url"))
    known = labels.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("label").alias("label"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    learned = split.join(known, "page_id", "left").select("host", "path", "label")
    judged = written(judged_paths(learned), "judged")
    rule, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    # Every path is among those judged; the left join keeps the rows whatever the judgement holds.
    found = split.join(judged, ["host", "path"], "left")
    return found.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decided, F.col("verdict")).alias("verdict"), "template", "purity"
    )


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page. A page is bad if the label of its number says low quality or toxic."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url")
    bad = F.greatest(1 - F.col("quality"), F.col("toxic")).cast("int")
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("page_id"), bad.alias("label"))
    return filter_urls(pages, labels)
