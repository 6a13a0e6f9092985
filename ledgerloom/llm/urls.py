"""URL filter: rules first, then a tree of path templates learned from labelled urls.

For every host the paths form a tree of segments. Segments that look like an id (a digit
in the stem, or very long) become wildcards, and the children of a node whose share of
blocked urls is statistically like that of all its children are merged into one wildcard
branch; children that differ stay as they are. Urls without a label count as
alike. A template is rejected if its share of blocked urls, smoothed towards that of its
host and that towards all hosts, is over a limit.

The tree is built over distinct paths, by grouped sums that are combined before the shuffle, so a
hot host or a hot url is no large group. An only child never differs from its
parent, so runs of only children are merged at one go: a round takes every node to the next
place where paths part, and past it. The number of rounds is that of the places where
paths part one below the other, not the depth of the paths.

Defined results: a null url, or one without ``://``, has an empty host and path, which
only the templates judge; repeated rows get one verdict each; with no label at all
nothing is rejected; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, free_name

LONG = 25
#: Chi-square with one degree of freedom, 5 %.
DIFFERS = 3.84
SMOOTHING = 4.0
REJECT_OVER = 0.5
ALLOW, BLOCK = "allow", "block"

Rule = tuple[str, str, str]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest of the rules (verdict, host, path) that fit, as a struct."""
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for verdict, domain, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r)):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        named = F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _shaped(segment: Column) -> Column:
    """Ids as a wildcard; an extension stays."""
    stem = F.regexp_extract(segment, r"^([^.]*)", 1)
    variable = stem.rlike("[0-9]") | (F.length(stem) >= LONG)
    return F.when(variable, F.concat(F.lit("*"), F.substr(segment, F.length(stem) + 1))).otherwise(segment)


def _merged(part: Column) -> Column:
    """The branch that a shaped segment is merged into. An extension tells templates apart
    even there."""
    return F.when(part.startswith("*"), part).otherwise(F.lit("*"))


def _text(parts: Column) -> Column:
    """A run of segments as it is in a template, all of them merged."""
    return F.array_join(F.transform(parts, lambda x: F.concat(F.lit("/"), _merged(x))), "")


def templates(paths: DataFrame) -> DataFrame:
    """Of rows (host, path, labelled, blocked), one for each host and path: host, path,
    template."""
    parts = F.transform(F.split(F.regexp_replace("path", "^/", ""), "/", -1), _shaped)
    rows = paths.withColumn("parts", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(parts))
    rows, done, node = cut(rows.withColumn("template", F.lit(""))), [], ["host", "template"]
    while True:
        done.append(rows.where(F.size("parts") == 0))
        rows = rows.where(F.size("parts") > 0)
        if rows.isEmpty():
            break
        rows = cut(_parted(_jumped(rows, node), node))
    out = done[0]
    for some in done[1:]:
        out = out.unionByName(some)
    return out.drop("parts")


def _jumped(rows: DataFrame, node: list[str]) -> DataFrame:
    """Every node taken to the first segment in which two of its paths differ; where one
    path is the beginning of another they agree. The last path in order differs from each
    other one no later than any two of them do."""
    rows = rows.join(rows.groupBy(*node).agg(F.max("parts").alias("last")), node)
    differ = F.array_position(F.zip_with("parts", "last", lambda a, b: a != b), F.lit(True))
    rows = rows.withColumn("same", F.when(differ > 0, differ - 1).cast("int"))
    rows = rows.join(rows.groupBy(*node).agg(F.min("same").alias("run")), node)
    run = F.least(F.coalesce("run", F.size("parts")), F.size("parts"))
    begun = F.concat("template", _text(F.slice("parts", F.lit(1), run)))
    rest = F.slice("parts", run + 1, F.greatest(F.size("parts") - run, F.lit(0)))
    return rows.withColumns({"template": begun, "parts": rest}).drop("last", "same", "run")


def _parted(rows: DataFrame, node: list[str]) -> DataFrame:
    """Every node taken past its next segment."""
    rows = rows.withColumn("part", F.get("parts", F.lit(0)))
    children = rows.where("part is not null").groupBy(*node, "part").agg(
        F.sum("labelled").alias("seen"), F.sum("blocked").alias("bad")
    )
    pooled = children.groupBy(*node).agg(F.sum("seen").alias("all_seen"), F.sum("bad").alias("all_bad"))
    share = (F.col("all_bad") + 0.5) / (F.col("all_seen") + 1)
    far = F.pow(F.col("bad") - F.col("seen") * share, 2) / (F.greatest("seen", F.lit(1)) * share * (1 - share))
    stays = children.join(pooled, node).where(far > DIFFERS).select(*node, "part", F.lit(True).alias("stays"))
    rows = rows.join(stays, [*node, "part"], "left")
    step = F.concat("template", F.lit("/"), F.when(F.col("stays"), F.col("part")).otherwise(_merged(F.col("part"))))
    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    moved = {"template": F.when(F.col("part").isNull(), F.col("template")).otherwise(step), "parts": rest}
    return rows.withColumns(moved).drop("part", "stays")


def judge(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
    labels: Column | None = None, smoothing: float = SMOOTHING, reject_over: float = REJECT_OVER,
) -> DataFrame:
    """A row for each page: page_id, host, path, rule, verdict, template, purity (the
    smoothed share of blocked urls). Templates learn from ``labels`` (1 to block, 0
    to allow, null unknown), by default the verdicts of the rules."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    label = free_name(pages, "label")
    rows = pages.withColumn(label, labels if labels is not None else F.lit(None).cast("int"))
    rows = rows.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(label).alias("label"))
    rows = rows.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    if labels is None:
        ruled = F.when(F.col("found.verdict") == BLOCK, 1).when(F.col("found.verdict") == ALLOW, 0)
        rows = rows.withColumn("label", ruled)
    paths = rows.groupBy("host", "path").agg(
        F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked")
    )
    tree = cut(templates(paths))
    sums = (F.sum("labelled").alias("seen"), F.sum("blocked").alias("bad"))
    seen, bad = tree.agg(*sums).first()
    prior = (bad or 0) / ((seen or 0) + smoothing)
    hosts = tree.groupBy("host").agg(*sums)
    hosts = hosts.select("host", ((F.col("bad") + smoothing * prior) / (F.col("seen") + smoothing)).alias("host_share"))
    leaves = tree.groupBy("host", "template").agg(*sums).join(hosts, "host")
    share = (F.col("bad") + smoothing * F.col("host_share")) / (F.col("seen") + smoothing)
    leaves = leaves.select("host", "template", share.alias("purity"))
    known = cut(tree.select("host", "path", "template").join(leaves, ["host", "template"]))
    learned = F.when(F.col("purity") > reject_over, BLOCK).otherwise(ALLOW)
    return rows.join(known, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), learned).alias("verdict"),
        "template",
        "purity",
    )
