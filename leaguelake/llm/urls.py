"""URL filter by rules and, where none fits, by the purity of path templates.

The paths of a host form a tree, one level for each segment. Level by level, positions that hold many
values, each rarely, become wildcards that keep the file extension; values frequent even there stay. A
node of the tree is thus a template such as /de/*.html. The addresses that a rule decides are the labels. Sister
branches whose share of blocked labels does not differ significantly are merged, from the deepest level up; a template
is rejected if its share of blocked labels, smoothed towards one half, reaches PURITY. A template without
labels is at one half, so it is allowed: nothing is known against it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import ascii_lower, attach, in_tasks
from leaguelake.sources.store import cut

#: A position is variable from so many values on, if a value has fewer distinct paths than REPEATS on average,
#: leaving out the values that stay: those with FREQUENT of the rows, or with more than that of the paths.
VALUES = 16
REPEATS = 4
FREQUENT = 1 / 16
#: Marks of merged wildcards and of merged names; no template has such a segment.
MERGED_WILD, MERGED_NAMES = "*~", "**"
#: Labels that the smoothing adds, and the smoothed share of blocked ones that rejects.
SMOOTHING = 2.0
PURITY = 0.8
#: Deviations by which shares differ significantly.
SIGNIFICANT = 2.6
#: Rules are held by every task; this bounds them.
MAX_RULES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Decides the addresses of a host and its subdomains whose path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _ruled(batches: Iterator[pa.RecordBatch], rules: dict[str, list[Rule]]) -> Iterator[pa.RecordBatch]:
    """Adds the longest rule that fits. Rules are looked up by every ending of the host at a dot."""
    for batch in batches:
        texts, verdicts = [], []
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
            best, ending = None, host
            while ending:
                for rule in rules.get(ending, ()):
                    if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                        best = rule
                ending = ending.partition(".")[2]
            texts.append(best and best.text)
            verdicts.append(best and best.verdict)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string()), pa.array(verdicts, pa.string())],
            [*batch.schema.names, "rule", "ruled"],
        )


def _literal(segment: Column) -> Column:
    """The segment itself; one that begins like a wildcard, or like this mark, is marked by a backslash."""
    return F.regexp_replace(segment, r"^(?=[*\\])", r"\\")


def _wildcard(segment: Column) -> Column:
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})?$", 0))


def _is_wild(segment: Column | str) -> Column:
    return F.startswith(segment, F.lit("*"))


def with_templates(paths: DataFrame) -> DataFrame:
    """Adds `template` and `parent` to distinct (host, path) with their number of rows `n`.

    A node with fewer than VALUES paths has no variable position below it, so the rest of these paths is literal
    and they are finished. Each level works on the others alone, and the levels end when none is left: there are
    as many as templates with VALUES paths are deep. The empty path has the empty template.
    """
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = paths.withColumn("segments", segments).withColumns({"template": F.lit(""), "parent": F.lit("")})
    columns, level = [*paths.columns, "template", "parent"], 0
    rows, empty = cut(rows, "level"), F.col("path") == ""
    finished, rows = [rows.where(empty).select(columns)], rows.where(~empty)
    while True:
        rows = rows.withColumn("segment", F.get("segments", F.lit(level)))
        there = rows.where("segment is not null")
        # Rows repeat addresses and grow with the crawl; what tells ids from names is distinct paths.
        values = there.groupBy("host", "template", "segment").agg(F.sum("n").alias("n"), F.count("*").alias("paths"))
        wide = values.groupBy("host", "template").agg(
            F.sum("n").alias("total"), F.sum("paths").alias("all_paths"), F.count("*").alias("values")
        ).where(F.col("all_paths") >= VALUES)
        many = wide.where(F.col("values") >= VALUES)
        often = (F.col("n") >= FREQUENT * F.col("total")) | (F.col("paths") > FREQUENT * F.col("all_paths"))
        # At most 2 / FREQUENT values of a node stay.
        stays = attach(values, many, ["host", "template"], F.col("segment"), "inner").where(often).groupBy("host", "template").agg(
            F.collect_list("segment").alias("stays"), F.sum("paths").alias("stay_paths")
        )
        rest_paths = F.col("all_paths") - F.coalesce("stay_paths", F.lit(0))
        rest_values = F.col("values") - F.coalesce(F.size("stays"), F.lit(0))
        nodes = wide.join(stays, ["host", "template"], "left").select(
            "host", "template", "stays",
            ((F.col("values") >= VALUES) & (rest_paths < REPEATS * rest_values)).alias("varied"),
        )
        rows = attach(rows, nodes, ["host", "template"], F.col("path"))
        stayed = F.coalesce(F.array_contains("stays", F.col("segment")), F.lit(False))
        variable = F.col("varied") & ~stayed & (F.col("segment") != "")
        chosen = F.when(variable, _wildcard(F.col("segment"))).otherwise(_literal(F.col("segment")))
        there, open_, last = F.col("segment").isNotNull(), F.col("varied").isNotNull(), F.size("segments") - 1
        rest = F.transform(F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0))), _literal)
        above = F.slice(rest, 1, F.greatest(F.size(rest) - 1, F.lit(0)))

        def below(found: Column) -> Column:
            return F.concat("template", F.array_join(F.transform(found, lambda s: F.concat(F.lit("/"), s)), ""))

        grown = F.when(~there, F.col("template")).when(open_, F.concat("template", F.lit("/"), chosen)).otherwise(below(rest))
        parent = F.when(~there, F.col("parent")).when(open_, F.col("template")).otherwise(below(above))
        placed = rows.select(
            *paths.columns, "segments", grown.alias("template"), parent.alias("parent"),
            (there & open_ & (last > level)).alias("open"),
        )
        placed = cut(placed, "level")
        finished.append(placed.where("not open").select(columns))
        rows, level = placed.where("open").drop("open"), level + 1
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, finished)


def rejected_templates(paths: DataFrame) -> DataFrame:
    """(host, template) that labels speak against. paths: host, template, parent, labelled, blocked.

    Branches are merged from the deepest level up. Sisters are templates of a host that differ in one level only;
    those whose share of blocked labels does not differ significantly from that of all sisters become one there, and
    what they hold is counted together. Wildcards join wildcards, unlabelled ones too; names join names if both
    have labels. So /news/2020/* and /news/2021/* are one template if labels speak alike of both. Templates
    without a wildcard are single addresses, which a rule decides or nothing is known of: none is rejected,
    nor is any of a host without blocked labels.
    """
    nodes = paths.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    places = F.transform(F.split("template", "/"), lambda s, i: F.when(_is_wild(s), i))
    wild = nodes.withColumn("deepest", F.array_max(places)).where("deepest is not null")
    known = wild.groupBy("host").agg(F.sum("blocked").alias("known")).where("known > 0").select("host")
    wild = cut(attach(wild, known, ["host"], F.col("template"), "inner"), "wild")
    deepest = wild.agg(F.max("deepest")).first()[0] or 0
    # Below the deepest wildcard of all, names are not told apart one by one.
    rows = wild.select("host", "template", "labelled", "blocked", F.split("template", "/", deepest + 2).alias("branch"))
    for level in range(deepest + 1, 0, -1):
        families = _families(rows, level)
        if not families.isEmpty():
            rows = cut(_merged(rows, cut(families, "families"), level), "branches")
    classes = rows.groupBy("host", "branch").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    purity = (F.col("blocked") + SMOOTHING / 2) / (F.col("labelled") + SMOOTHING)
    impure = classes.where(purity >= PURITY).select("host", "branch")
    return attach(rows.select("host", "branch", "template"), impure, ["host", "branch"], F.col("template"), "inner").select(
        "host", "template"
    )


FAMILY = ["host", "wild", "others"]


def _sisters(rows: DataFrame, level: int) -> DataFrame:
    """rows (host, template, labelled, blocked, branch) that can be merged at a level, with the name they have there."""
    others = F.transform("branch", lambda s, i: F.when(i == level, F.lit("")).otherwise(s))
    named = rows.withColumns({"own": F.get("branch", F.lit(level)), "others": others}).withColumn("wild", _is_wild("own"))
    return named.where("own is not null and (wild or labelled > 0)")


def _families(rows: DataFrame, level: int) -> DataFrame:
    """Labels of the sisters of a level, where there are several and any labels."""
    sums = [F.sum(c).alias(f"all_{c}") for c in ("labelled", "blocked")]
    found = _sisters(rows, level).groupBy(*FAMILY).agg(*sums, F.min("own").alias("one"), F.max("own").alias("other"))
    return found.where("all_labelled > 0 and one <> other").drop("one", "other")


def _merged(rows: DataFrame, families: DataFrame, level: int) -> DataFrame:
    """rows with similar sisters of a level as one branch."""
    classes = _sisters(rows, level).groupBy(*FAMILY, "own", "branch").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    found = attach(classes, families, FAMILY, F.col("own"), "inner")
    share, rest = F.col("all_blocked") / F.col("all_labelled"), F.col("blocked") / F.col("labelled")
    deviation = F.sqrt(share * (1 - share) / F.col("labelled")) + 1 / F.col("labelled")
    similar = (F.col("labelled") == 0) | (F.abs(share - rest) <= SIGNIFICANT * deviation)
    mark = F.when(F.col("wild"), MERGED_WILD).otherwise(MERGED_NAMES)
    one = F.transform("branch", lambda s, i: F.when(i == level, mark).otherwise(s))
    joined = attach(rows, found.where(similar).select("host", "branch", one.alias("one")), ["host", "branch"], F.col("template"))
    return joined.select("host", "template", "labelled", "blocked", F.coalesce("one", "branch").alias("branch"))


def judged(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, template of every row.

    A null address, or one without ://, has empty host and path. The longest rule that fits decides (of equal
    ones that of the longer host); `rule` is its text, else null. Otherwise a rejected template blocks
    and any other allows. Rows are judged by their address alone, so null or repeated ids and
    other columns, whatever their names, do not matter. Without pages there are no rows.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    by_host: dict[str, list[Rule]] = {}
    for rule in sorted(rules, key=lambda r: -len(r.host)):
        by_host.setdefault(rule.host, []).append(rule)
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    kind = dict(rows.dtypes)["id"]
    ruled = in_tasks(
        rows, partial(_ruled, rules=by_host), f"id {kind}, host string, path string, rule string, ruled string"
    )
    paths = ruled.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.count("ruled").alias("labelled"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
    )
    placed = with_templates(paths)
    rejected = rejected_templates(placed).withColumn("rejected", F.lit(True))
    verdicts = attach(placed.select("host", "path", "template"), rejected, ["host", "template"], F.col("path"))
    found = attach(ruled, verdicts, ["host", "path"], F.struct("id", "rule"))
    other = F.when(F.col("rejected"), "block").otherwise("allow")
    return found.select("id", "host", "path", "rule", F.coalesce("ruled", other).alias("verdict"), "template")
