"""URL filters by a path-template tree (operator 2), in DataFrame functions only.

Explicit rules decide the urls they fit.  They also label pages, from which a tree of
path templates per host is learned, level by level: segments that look like
identifiers, or that take very many values under one parent, become wildcards.
Sibling branches of one shape whose share of blocked pages does not differ
significantly from that of all such siblings are merged.  A template is rejected when
its smoothed share of blocked labelled pages is high enough.

The tree is built on counts by host and path shape, never on pages; pages only meet
the finished templates by their shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import Stash

#: Levels of the tree (deeper segments are one wildcard), values and share of distinct values from which a segment is variable.
DEPTH, MANY, VARIED = 6, 12, 0.3
#: Labelled pages a branch needs to be compared, and the normal quantile under which it counts as similar.
COMPARED, SIMILAR = 5, 1.96
#: Labelled pages' worth of prior, and the smoothed purity from which a template is rejected.
PRIOR, REJECT = 4.0, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict (null if none fits).

    A rule is ``(verdict, "host/path")``.  It fits its host and all subdomains if the path
    starts with the rule's, its slash included.  Of equally long ones the first wins.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])) if rules else ():
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def shape_of(path: Column) -> Column:
    """The path with identifier-like segments as wildcards, and what lies beyond the deepest level as one."""
    def kind(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^[0-9]+$"), "{num}")
            .when(s.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.concat(F.lit("{num}"), F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)))
            .when(s.rlike(r"^[0-9A-Fa-f]{8,}$|^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"), "{hex}")
            .when(s.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z_-]{16,}$"), "{id}")
            .otherwise(s)
        )

    parts = F.split(path, "/", -1)
    kept = F.transform(F.slice(parts, 2, DEPTH), kind)
    return F.when(path == "", "").otherwise(F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(F.size(parts) > DEPTH + 1, "/{rest}").otherwise("")))


def _templates(shapes: DataFrame, stash: Stash) -> DataFrame:
    """Shapes with the template each belongs to: ``host, shape, template, labelled, blocked``.

    Level by level, a literal segment turns into ``*`` where its parent has at least
    ``MANY`` different ones and they are ``VARIED`` of its pages or more.
    """
    rows = shapes.withColumn("segments", F.split(F.substring("shape", 2, 1 << 30), "/", -1)).withColumn("template", F.lit(""))
    deepest = rows.agg(F.max(F.when(F.col("shape") == "", 0).otherwise(F.size("segments")))).first()[0] or 0
    for level in range(1, deepest + 1):
        segment = F.get("segments", F.lit(level - 1))
        here = rows.withColumn("segment", F.when(F.col("shape") != "", segment))
        children = here.where("segment is not null").groupBy("host", "template", "segment").agg(F.sum("n").alias("n"))
        parents = children.groupBy("host", "template").agg(((F.count("*") >= MANY) & (F.count("*") >= VARIED * F.sum("n"))).alias("variable"))
        joined = here.join(parents, ["host", "template"], "left")
        name = F.when(F.col("variable") & ~F.startswith("segment", F.lit("{")), "*").otherwise(F.col("segment"))
        grown = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), name))
        rows = stash.put(joined.withColumn("template", grown).drop("segment", "variable"))
    return rows.select("host", "shape", "template", "labelled", "blocked")


def _merged(own: DataFrame) -> DataFrame:
    """Templates ``(host, template, labelled, blocked)`` with the counts after merging similar branches, as ``m_labelled, m_blocked, merged_into``."""
    literal = F.filter(F.transform(F.split("template", "/", -1), lambda s, i: F.when((i > 0) & (s != "*") & ~F.startswith(s, F.lit("{")) & (s != ""), i)), lambda i: i.isNotNull())
    parts = F.split("template", "/", -1)
    wider = F.array_join(F.transform(parts, lambda s, i: F.when(i == F.col("at"), "*").otherwise(s)), "/")
    branches = own.withColumn("at", F.explode(literal)).withColumn("wider", wider)
    pooled = branches.groupBy("host", "wider").agg(F.count("*").alias("k"), F.sum("labelled").alias("t_labelled"), F.sum("blocked").alias("t_blocked")).where("k > 1")
    tested = branches.join(pooled, ["host", "wider"])
    rate = F.col("t_blocked") / F.col("t_labelled")
    spread = F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-9)) / F.col("labelled"))
    similar = tested.where((F.col("labelled") >= COMPARED) & (F.abs(F.col("blocked") / F.col("labelled") - rate) < SIMILAR * spread))
    groups = similar.groupBy("host", "wider").agg(F.count("*").alias("k"), F.sum("labelled").alias("m_labelled"), F.sum("blocked").alias("m_blocked")).where("k > 1")
    chosen = similar.select("host", "template", "at", "wider").join(groups.drop("k"), ["host", "wider"])
    chosen = chosen.groupBy("host", "template").agg(F.min(F.struct("at", "wider", "m_labelled", "m_blocked")).alias("c"))
    return own.join(chosen, ["host", "template"], "left").select("host", "template", F.coalesce("c.m_labelled", "labelled").alias("m_labelled"), F.coalesce("c.m_blocked", "blocked").alias("m_blocked"), F.coalesce("c.wider", "template").alias("merged_into"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict, template, purity, labelled``.

    ``rule`` is the longest fitting rule (null if none), and its verdict stands.  Other
    rows get ``block`` if their template has labelled pages and its smoothed share of
    blocked ones is ``REJECT`` or more, else ``allow``.  ``template`` is the merged one.

    A null url, or one without ``://``, has an empty host and path and is judged like any
    other.  Null ids, ties and repeated rows pass through, one row out for each row in;
    other columns are not looked at; an empty table gives an empty one.  Urls are read
    twice; the joins are on host and shape, and a hot one is split by adaptive
    execution as the side with the templates has one row for it.
    """
    stash = Stash(pages.sparkSession, "urls")
    url = F.col(url_col)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), shape_of(F.col("path")).alias("shape"))
    shapes = stash.put(rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked")))
    total = shapes.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = (total[1] or 0) / total[0] if total[0] else 0.0
    placed = _templates(shapes, stash)
    own = stash.put(placed.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    purity = (F.col("m_blocked") + PRIOR * prior) / (F.col("m_labelled") + PRIOR)
    judged = _merged(own).select("host", "template", "merged_into", purity.alias("purity"), F.col("m_labelled").alias("labelled"))
    known = stash.put(placed.select("host", "shape", "template").join(judged, ["host", "template"]).drop("template"))
    reject = (F.col("labelled") > 0) & (F.col("purity") >= REJECT)
    out = rows.join(known, ["host", "shape"], "left")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(reject, "block").otherwise("allow")).alias("verdict"),
        F.col("merged_into").alias("template"), "purity", "labelled",
    )
