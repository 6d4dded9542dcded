"""URL filters: rules first, then a tree of path templates judged by labelled purity.

A path is first brought to its shape: digits and long hexadecimal parts of a segment become marks. The
shapes of a host form a tree, which is generalised level by level from the root. Among the branches
below one node,

* if there are ``MANY`` or more, those with fewer than ``FEW`` pages each are values of a variable and
  become the wildcard ``*``;
* of all others, whatever their siblings, those whose labelled share does not differ from that of the
  whole node by ``Z`` standard errors are merged under ``*``, and those that differ keep their name.

The leaves are the host's templates. A template's purity is its share of good labels, smoothed by
``WEIGHT`` labels of the overall share; templates below ``PURITY`` are rejected. Only DataFrame functions
are used, and beyond the pages themselves only distinct shapes are moved.

Defined cases: a null url, or one without ``://``, has an empty host and path; pages without a label
count for a template's size alone; several labels of a page count as their mean; repeated pages each
have their row; no labels block nothing. Paths are followed as deep as they go; below ``DEPTH`` segments
only where the labelled pages of a node differ, else what follows is one wildcard ``**``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.operators.storage import remove, staged

MANY, FEW = 20, 3
Z = 2.0
WEIGHT = 5.0
PURITY = 0.5
DEPTH = 8
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = _behind_scheme(url)
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """All segments with their variable parts marked."""
    def shaped(part: Column) -> Column:
        hexadecimal = part.rlike(r"^[0-9a-fA-F-]{8,}\z") & part.rlike("[0-9]") & part.rlike("[a-fA-F-]")
        return F.when(hexadecimal, "<x>").otherwise(F.regexp_replace(part, "[0-9]+", "<n>"))

    return F.transform(F.filter(F.split(path, "/"), lambda p: p != ""), shaped)


def templates(shapes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``host, shape, template`` from ``host, shape, pages, labelled, good`` (one row per shape).

    Below ``depth`` segments only nodes whose labelled pages differ are followed, as far as they go; the
    rest of any other node is one ``**``.
    """
    tree = shapes.withColumns({"template": F.lit(""), "open": F.lit(True)})
    copy, level = None, 0
    while not tree.where(F.col("open") & (F.size("shape") > level)).isEmpty():
        tree = tree.withColumn("branch", F.when(F.col("open"), F.get("shape", F.lit(level))))
        below = tree.where("branch IS NOT NULL")
        branches = below.groupBy("host", "template", "branch").agg(*[F.sum(c).alias(c) for c in ("pages", "labelled", "good")])
        nodes = branches.groupBy("host", "template").agg(
            F.count("*").alias("ways"),
            F.sum("labelled").alias("all_labelled"),
            F.sum("good").alias("all_good"),
        )
        share = (F.col("all_good") + 1) / (F.col("all_labelled") + 2)
        error = F.sqrt(share * (1 - share) * F.greatest("labelled", F.lit(1)))
        alike = F.abs(F.col("good") - F.col("labelled") * share) <= Z * error
        rare = (F.col("ways") >= MANY) & (F.col("pages") < FEW)
        wild = (F.col("ways") > 1) & (rare | alike)
        differ = (F.col("all_good") > 0) & (F.col("all_good") < F.col("all_labelled"))
        ends = F.lit(False) if level < depth else ~differ
        # AQE splits the node of a host that has very many shapes
        named = branches.join(nodes, ["host", "template"]).select(
            "host",
            "template",
            "branch",
            F.when(ends, "**").when(wild, "*").otherwise(F.col("branch")).alias("name"),
            (~ends).alias("goes_on"),
        )
        tree = tree.join(named, ["host", "template", "branch"], "left").withColumns(
            {
                "template": F.concat("template", F.coalesce(F.concat(F.lit("/"), "name"), F.lit(""))),
                "open": F.coalesce("goes_on", F.lit(False)),
            }
        )
        new, new_copy = staged(tree.drop("branch", "name", "goes_on"), "templates")
        if copy:
            remove(tree.sparkSession, copy)
        tree, copy, level = new, new_copy, level + 1
    return tree.drop("open")


def judged_urls(pages: DataFrame, labels: DataFrame, rules=RULES, depth: int = DEPTH) -> DataFrame:
    """``page_id, host, path, rule, template, purity, verdict``, one row per page.

    ``labels`` has ``doc_id`` (the page) and ``quality``, 1 for good.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    placed = parts.withColumn("shape", shape_of(F.col("path")))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("page_id"))
    known = known.agg(F.avg("quality").alias("good"))
    labelled = placed.select("page_id", "host", "shape").join(known, "page_id", "left")
    shapes = labelled.groupBy("host", "shape").agg(
        F.count("*").alias("pages"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good")
    )
    shapes, copy = staged(shapes, "shapes")
    total = shapes.agg(F.sum("labelled").alias("n"), F.sum("good").alias("good")).first()
    prior = (total["good"] or 0.0) / total["n"] if total["n"] else 1.0
    tree = templates(shapes, depth)
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("good").alias("good"))
    purity = (F.col("good") + WEIGHT * prior) / (F.col("n") + WEIGHT)
    sums = sums.select("host", "template", purity.alias("purity"))
    found, _ = staged(tree.join(sums, ["host", "template"]).select("host", "shape", "template", "purity"), "purity")
    remove(pages.sparkSession, copy)
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = placed.join(found, ["host", "shape"])
    pure = F.when(F.col("purity") >= PURITY, "allow").otherwise("block")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), "template", "purity", F.coalesce(action, pure).alias("verdict")
    )
