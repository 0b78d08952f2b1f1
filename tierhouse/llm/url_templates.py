"""URL filter: explicit rules first, then templates of each host's paths.

Each host's paths form a tree of segments. A segment with a digit is a
variable; so are the children of a node that rarely repeat, if it has very many
of them (children that do repeat are left to the next test). Branches of a node that do not differ statistically from their
siblings in labelled purity are merged into one wildcard branch, level by
level; branches that do differ stay. Each remaining template gets the share of
bad labelled pages, smoothed towards its host's share, which is smoothed
towards that of all pages. Templates whose purity falls below the cutoff are
rejected.

The tree is a table of (host, path shape) with counts: it is pre-aggregated
before anything else, so a host with a third of all pages is a few rows.
Levels are settled one by one, as deep as a node still holds labelled pages of
different paths; further down no label can part anything, and all segments are
wildcards. Wildcards at the end that go beyond `DEPTH` are one, `**`, for paths
of all lengths, unless the labelled shares of the lengths differ.

Defined cases: a null url, or one without `://`, has an empty host and path
and is judged like any other host's page; A-Z of the host are lower-cased;
repeated rows count each; without labels nothing is rejected; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierhouse.llm.common import written

#: (action, host, path)
Rule = tuple[str, str, str]
#: How many segments a template shows at least before its end may be `**`.
DEPTH = 5
#: Where a node has more than WIDE children of fewer than REPEATS pages each, those are variable.
WIDE, REPEATS = 20, 4.0
#: Branches differ if their shares are so many standard errors apart.
DIFFERS = 3.0
#: How many labelled pages a parent's share is worth to a child.
STRENGTH = 10.0
ANY = "*"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _CAPITALS, _SMALL), path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, action) of the longest rule that fits, else null; of equally long ones the first listed."""
    made = F.lit(None).cast("struct<rule:string,action:string>")
    for action, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        made = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(action).alias("action"))).otherwise(made)
    return made


def shape(path: Column) -> Column:
    """The path's segments, those with a digit as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("[0-9]"), F.lit(ANY)).otherwise(s))


def _prefix(levels: int) -> Column:
    return F.slice("__template", 1, levels)


def _replace(level: int) -> Column:
    """The template with a wildcard at the level (from 0)."""
    return F.transform("__template", lambda s, i: F.when(i == level, F.lit(ANY)).otherwise(s))


def _generalised(tree: DataFrame, level: int) -> DataFrame:
    """Wildcards for the rare children of nodes that have very many of them at this level."""
    here = tree.where(F.size("__template") > level).select("__host", _prefix(level).alias("__above"), F.get("__template", F.lit(level)).alias("__child"), "__n")
    rare = here.groupBy("__host", "__above", "__child").agg(F.sum("__n").alias("__n")).where(F.col("__n") < REPEATS).drop("__n")
    wide = rare.groupBy("__host", "__above").agg(F.count(F.lit(1)).alias("__children")).where(F.col("__children") > WIDE).drop("__children")
    variable = rare.join(wide, ["__host", "__above"]).withColumn("__variable", F.lit(True))
    joined = (
        tree.withColumns({"__above": _prefix(level), "__child": F.get("__template", F.lit(level))})
        .join(variable, ["__host", "__above", "__child"], "left")
    )
    new = F.when(F.col("__variable"), _replace(level)).otherwise(F.col("__template"))
    return joined.select("__host", "__shape", new.alias("__template"), "__n", "__known", "__bad")


def _apart(here: DataFrame) -> DataFrame:
    """(__host, __above, __child) of the children whose labelled share differs from their siblings'."""
    branch = here.groupBy("__host", "__above", "__child").agg(F.sum("__known").alias("__bk"), F.sum("__bad").alias("__bb"))
    node = branch.groupBy("__host", "__above").agg(F.sum("__bk").alias("__nk"), F.sum("__bb").alias("__nb"))
    rest_k, rest_b = F.col("__nk") - F.col("__bk"), F.col("__nb") - F.col("__bb")
    pooled = F.col("__nb") / F.col("__nk")
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("__bk") + 1 / rest_k))
    differs = F.when(
        (F.col("__bk") > 0) & (rest_k > 0) & (F.col("__nb") > 0) & (F.col("__nb") < F.col("__nk")),
        F.abs(F.try_divide("__bb", "__bk") - F.try_divide(rest_b, rest_k)) > DIFFERS * F.coalesce(error, F.lit(0.0)),
    ).otherwise(F.lit(False))
    return branch.join(node, ["__host", "__above"]).where(differs).select("__host", "__above", "__child", F.lit(True).alias("__own"))


def _merged(tree: DataFrame, level: int) -> DataFrame:
    """One wildcard branch for the children that do not differ from their siblings at this level."""
    here = tree.withColumns({"__above": _prefix(level), "__child": F.get("__template", F.lit(level))})
    joined = here.join(_apart(here.where(F.size("__template") > level)), ["__host", "__above", "__child"], "left")
    new = F.when(F.col("__own").isNull() & (F.size("__template") > level), _replace(level)).otherwise(F.col("__template"))
    return joined.select("__host", "__shape", new.alias("__template"), "__n", "__known", "__bad")


def _settled(tree: DataFrame, level: int) -> bool:
    """Whether no node at this level holds labelled pages of different paths."""
    known = tree.where("__known > 0").select("__host", _prefix(level).alias("__above"), "__template")
    return known.groupBy("__host", "__above").agg(F.min("__template").alias("a"), F.max("__template").alias("b")).where("a <> b").isEmpty()


def _ended(tree: DataFrame, level: int) -> DataFrame:
    """Wildcards from this level on; at the end and beyond DEPTH they are one for all lengths that do not differ."""
    whole = F.transform("__template", lambda s, i: F.when(i >= level, F.lit(ANY)).otherwise(s))
    named = F.aggregate(
        F.transform("__child", lambda s, i: F.when(s != ANY, i + 1).otherwise(F.lit(0))), F.lit(0), lambda a, x: F.greatest(a, x)
    )
    here = tree.withColumn("__child", whole).withColumn("__keep", F.greatest(named, F.lit(DEPTH)))
    here = here.withColumn("__above", F.slice("__child", F.lit(1), F.col("__keep"))).withColumn("__long", F.size("__child") > F.col("__keep"))
    joined = here.join(_apart(here.where("__long")), ["__host", "__above", "__child"], "left")
    one = F.col("__long") & F.col("__own").isNull()
    new = F.when(one, F.concat("__above", F.array(F.lit(ANY * 2)))).otherwise(F.col("__child"))
    return joined.select("__host", "__shape", new.alias("__template"), "__n", "__known", "__bad")


def templates(pages: DataFrame) -> DataFrame:
    """(__host, __shape) with its __template and __purity. `pages` has __host, __shape, __is_bad (null: not labelled)."""
    tree = written(
        pages.groupBy("__host", "__shape").agg(
            F.count(F.lit(1)).alias("__n"),
            F.count("__is_bad").alias("__known"),
            F.coalesce(F.sum(F.col("__is_bad").cast("long")), F.lit(0)).alias("__bad"),
        ).withColumn("__template", F.col("__shape")),
        "url-shapes",
    )
    level = 0
    while not _settled(tree, level):
        for step in (_generalised, _merged):  # written, as each level reads the one above twice
            tree = written(step(tree, level), f"url-level{level}")
        level += 1
    tree = written(_ended(tree, level), "url-ended")
    counts = (F.sum("__known").alias("__k"), F.sum("__bad").alias("__b"))
    whole = tree.agg(*counts).first()
    base = (whole["__b"] or 0) / (whole["__k"] or 1)
    hosts = tree.groupBy("__host").agg(*counts).select("__host", ((F.col("__b") + STRENGTH * base) / (F.col("__k") + STRENGTH)).alias("__host_bad"))
    purity = 1 - (F.col("__b") + STRENGTH * F.col("__host_bad")) / (F.col("__k") + STRENGTH)
    made = tree.groupBy("__host", "__template").agg(*counts).join(hosts, "__host").select("__host", "__template", purity.alias("__purity"))
    return tree.select("__host", "__shape", "__template").join(made, ["__host", "__template"])


def url_verdicts(
    pages: DataFrame, labels: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", cutoff: float = 0.5
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, template, purity. `labels` has page_id and bad (boolean)."""
    host, path = host_and_path(F.col(url))
    truth = labels.where("page_id IS NOT NULL").groupBy(F.col("page_id").alias("__id")).agg(F.max("bad").alias("__is_bad"))
    rows = pages.select(F.col(page_id).alias("__page"), host.alias("__host"), path.alias("__path"))
    rows = rows.withColumn("__shape", shape(F.col("__path")))
    found = templates(rows.join(truth, F.col("__page") == F.col("__id"), "left").select("__host", "__shape", "__is_bad"))
    made = rows.withColumn("__rule", rule_of(F.col("__host"), F.col("__path"), rules)).join(found, ["__host", "__shape"], "left")
    return made.select(
        F.col("__page").alias("page_id"),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.action", F.when(F.col("__purity") < cutoff, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.concat(F.col("__host"), F.lit("/"), F.array_join("__template", "/")).alias("template"),
        F.col("__purity").alias("purity"),
    )
