"""URL filters: rules by host and path, and where no rule fits the verdict of a tree of path templates.

The tree is grown for each host, level by level, from counts: segments of a path that are seen too seldom under their
parent are variable and become a wildcard; frequent ones whose labelled pages don't differ in their share of bad pages
from those of their siblings are merged into one branch; of the others, those that are better than their siblings are
merged where they are alike among themselves, and so are those that are worse; what is like no sibling stays apart. The share of bad pages of a template is
smoothed towards that of its parent, up to the host's and to all pages', and templates above a threshold are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, written

# Wildcards: a variable segment, siblings that were merged (all alike; better and worse than the others), all deeper than the tree.
VARIABLE, MERGED, BETTER, WORSE, TAIL = "/*", "/~", "/~good", "/~bad", "/**"
# Two shares differ where the squared z of their difference reaches this.
APART = 3.84
# Segments of a path that are levels of their own.
DEPTH = 6
# A value that is seen on fewer pages under its parent is variable.
SUPPORT = 20
# Labelled pages that a parent's share counts for.
PRIOR = 4.0
MOST_BAD = 0.4
SALTS = 16
# Tables of rejected paths up to this many rows go to every task; larger ones are joined by key.
BROADCAST_ROWS = 100_000

Rule = tuple[str, str, str]
# Host, path and verdict of the rules that the registered query applies.
URL_RULES: list[Rule] = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with host (A-Z lower-cased) and path of the url; both empty where it is null or has no `://`."""
    at = f"locate('://', `{url_col}`)"
    rest = F.expr(f"IF({at} > 0, substr(`{url_col}`, {at} + 3), '')")
    out = pages.withColumn("rest of url", F.coalesce(rest, F.lit("")))
    raw = F.regexp_extract("rest of url", "^[^/?#]*", 0)
    return out.withColumn("host", F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", F.regexp_extract("rest of url", "^[^/?#]*([^?#]*)", 1)).drop("rest of url")


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """pages (host, path) with `rule` (host and path of the longest rule that fits) and its verdict; both null where none fits.

    A rule (host, path, verdict) fits its host and all subdomains where the path starts with the rule's; of two as long
    the first by text is taken. Rules are a short list, written into the projection.
    """
    if not rules:
        return pages.selectExpr("*", "CAST(NULL AS string) AS rule", "CAST(NULL AS string) AS rule_verdict")
    listed = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    known = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(p).alias("p"), F.lit(v).alias("v")) for h, p, v in listed])
    fits = F.filter(known, lambda r: ((F.col("host") == r["h"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["h"]))) & F.startswith(F.col("path"), r["p"]))
    first = pages.withColumn("first rule", F.get(fits, F.lit(0)))
    return first.withColumn("rule", F.concat("first rule.h", "first rule.p")).withColumn("rule_verdict", F.col("first rule.v")).drop("first rule")


def with_shape(pages: DataFrame) -> DataFrame:
    """pages (host, path) with `shape`: the segments of the path, each with its slash, as the tree reads them.

    Runs of digits, and segments of eight or more hexadecimal characters with a digit among them, are variable by their
    looks. A path of more than DEPTH segments ends in a wildcard for the rest.
    """
    looks = "IF(rlike(s, '^[0-9a-fA-F-]{8,}$') AND rlike(s, '[0-9]'), '*', regexp_replace(s, '[0-9]+', '*'))"
    parts = F.expr(f"transform(slice(split(path, '/'), 2, {DEPTH}), s -> concat('/', {looks}))")
    tail = F.when(F.size(F.split("path", "/")) > DEPTH + 1, F.lit(TAIL)).otherwise(F.lit(""))
    return pages.withColumn("shape", F.concat(F.array_join(parts, ""), tail))


def labelled_by_id(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, shape, n, labelled and bad of pages (host, shape, number): labels (number, bad) are joined by the number.

    Pages are counted before the join, so pages that repeat a path are one row in it.
    """
    counted = pages.groupBy("host", "shape", "number").agg(F.count("*").alias("n"))
    known = labels.where("number IS NOT NULL AND bad IS NOT NULL").groupBy("number").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    both = counted.join(known, "number", "left")
    return both.groupBy("host", "shape").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bad").isNotNull(), F.col("n")).otherwise(0)).alias("labelled"), F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("bad"))


def salted_join(rows: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """rows left join kept; a key with very many rows is dealt out to SALTS partitions."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    many = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(many, [*keys, "salt"], "left").drop("salt")


def differs(all_labelled: str, all_bad: str) -> Column:
    """Whether the share of bad of a row (labelled, bad) differs from that of the rest of its group; never where either has no labelled page."""
    b1, n1 = F.col("bad").cast("double"), F.col("labelled").cast("double")
    b2, n2 = F.col(all_bad).cast("double") - b1, F.col(all_labelled).cast("double") - n1
    gap = b1 * n2 - b2 * n1
    # The squared z of two shares, multiplied out.
    return (n1 > 0) & (n2 > 0) & (gap != 0) & (gap * gap * (n1 + n2) >= F.lit(APART) * (b1 + b2) * (n1 + n2 - b1 - b2) * n1 * n2)


def templates(paths: DataFrame, support: int = SUPPORT) -> DataFrame:
    """paths (host, shape, n, labelled, bad) with their template.

    One level a round: the values under each parent are counted, rare ones become VARIABLE, frequent ones whose share of
    bad pages is like that of their siblings together become MERGED, the others BETTER or WORSE where there are several
    alike, or keep their text. What a level decides is the parent of the next.
    """
    rows = paths.withColumn("segments", F.expr("transform(slice(split(shape, '/'), 2, 99), s -> concat('/', s))")).withColumn("template", F.lit(""))
    depth = min(DEPTH + 1, rows.agg(F.max(F.size("segments"))).first()[0] or 0)
    held: DataFrame | None = None
    for level in range(depth):
        # The end of a path is a value like others, but is never variable.
        rows = rows.withColumn("value", F.coalesce(F.get("segments", F.lit(level)), F.lit("")))
        values = rows.groupBy("host", "template", "value").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")]).where((F.col("n") >= support) & (F.col("value") != ""))
        parents = rows.groupBy("host", "template").agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
        against = values.join(parents, ["host", "template"]).withColumn("side", F.when(differs("all_labelled", "all_bad"), F.signum(F.col("bad") * F.col("all_labelled") - F.col("all_bad") * F.col("labelled"))).otherwise(0.0))
        apart = against.where("side <> 0").groupBy("host", "template", "side").agg(F.sum("labelled").alias("side_labelled"), F.sum("bad").alias("side_bad"))
        alike = (F.col("side_labelled") > F.col("labelled")) & ~differs("side_labelled", "side_bad")
        named = F.when(F.col("side") == 0, F.lit(MERGED)).when(alike, F.when(F.col("side") < 0, F.lit(BETTER)).otherwise(F.lit(WORSE))).otherwise(F.col("value"))
        kept = against.join(apart, ["host", "template", "side"], "left").select("host", "template", "value", named.alias("branch"))
        branch = F.coalesce("branch", F.when(F.col("value") == "", F.lit("")).otherwise(F.lit(VARIABLE)))
        rows = salted_join(rows, kept, ["host", "template", "value"]).withColumn("template", F.concat("template", branch)).drop("branch", "value")
        rows = written(rows, "templates")
        if held:
            dropped(held)
        held = rows
    return rows.drop("segments")


def smoothed(rows: DataFrame, prior: float = PRIOR) -> DataFrame:
    """host, template and share: the bad share of each template's labelled pages, smoothed along the way down from all pages."""
    leaves = rows.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    pieces = F.slice(F.split("template", "/"), 2, 99)
    above = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.size(pieces))))
    above = above.withColumn("node", F.when(F.col("level") == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(F.slice(pieces, F.lit(1), F.col("level")), "/"))))
    nodes = above.groupBy("host", "level", "node").agg(F.sum("labelled").alias("node_labelled"), F.sum("bad").alias("node_bad"))
    whole = leaves.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()
    start = (whole["b"] or 0) / whole["l"] if whole["l"] else 0.0
    lines = above.join(nodes, ["host", "level", "node"]).groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("level", "node_labelled", "node_bad"))).alias("way"))
    share = F.aggregate("way", F.lit(float(start)), lambda up, x: (x["node_bad"] + F.lit(float(prior)) * up) / (x["node_labelled"] + F.lit(float(prior))))
    return lines.select("host", "template", share.alias("share"))


def path_tree(pages: DataFrame, labels: DataFrame, support: int = SUPPORT, prior: float = PRIOR, most_bad: float = MOST_BAD) -> DataFrame:
    """host, shape, n, labelled, bad, template, share and rejected of every host and shape of pages (host, shape, number)."""
    rows = written(templates(written(labelled_by_id(pages, labels), "paths"), support), "path-templates")
    return salted_join(rows, smoothed(rows, prior), ["host", "template"]).withColumn("rejected", F.col("share") > most_bad)


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule], support: int = SUPPORT, prior: float = PRIOR, most_bad: float = MOST_BAD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule and verdict (allow or block) of every row of pages.

    labels (number, bad) marks pages by the first number in their path; a number with several labels is bad if one is.
    The longest rule that fits decides, else the template tree: block where the smoothed share of bad pages is above
    most_bad. Null urls and those without `://` have an empty host and path, and are judged by that. Urls are taken whole,
    however long; rows that repeat each give a row, null ids too; without labels nothing is rejected; an empty table
    gives no rows. Columns besides id and url are ignored, whatever their names.
    """
    parts = with_shape(with_rule(with_parts(pages.select(F.col(id_col).alias("rid"), F.col(url_col).alias("own url")), "own url"), rules))
    number = F.expr("try_cast(nullif(regexp_extract(path, '[0-9]+', 0), '') AS bigint)")
    tree = written(path_tree(parts.select("host", "shape", number.alias("number")), labels, support, prior, most_bad), "path-tree")
    rejected = tree.where("rejected").select("host", "shape", F.lit(True).alias("rejected"))
    judged = parts.join(F.broadcast(rejected), ["host", "shape"], "left") if rejected.count() <= BROADCAST_ROWS else salted_join(parts, rejected, ["host", "shape"])
    verdict = F.coalesce("rule_verdict", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select(F.col("rid").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
