"""Site-relative boilerplate: lines that stand on a large share of a site's pages are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgauge.llm.workspace import Workspace, fresh

EDGE = " \t\r"
#: Share of a site's pages above which a line is boilerplate. Lines that templates repeat stand on 8 % of
#: the pages and more in the test tables, lines that people repeat on less than 5 % (see the README).
RATIO = 0.06


def line_key(line: Column) -> Column:
    """Lines are equal if they are so without blanks at their ends."""
    return F.xxhash64(F.btrim(line, F.lit(EDGE)))


def boilerplate(docs: DataFrame, text: str, site: str, ratio: float, keys: str) -> DataFrame:
    """(site, keys): for each site, the keys of the lines on more than ``ratio`` of its pages; a line that
    only one page has repeats nothing and is none. A line counts once for each page; blank lines don't
    count. The pages of a site that have the same set of lines are one page, so a page with many copies
    keeps its lines.

    A site has at most (mean distinct lines of its pages) / ratio such lines, so the list is no
    longer than a few pages, however many pages the site has.
    """
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(F.btrim(x, F.lit(EDGE))) > 0)
    page_keys = F.array_distinct(F.transform(lines, line_key))
    # copies are combined before the shuffle
    pages = docs.select(F.col(site).alias("site"), F.array_sort(page_keys).alias("keys")).distinct()
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    on = pages.select("site", F.explode("keys").alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("on"))
    often = on.where(F.col("on") > 1).alias("l").join(totals.alias("t"), F.expr("l.site <=> t.site"))
    return (
        often.where(F.col("on") > F.lit(ratio) * F.col("pages"))
        .groupBy("l.site")
        .agg(F.collect_list("key").alias(keys))
    )


def drop_boilerplate(
    docs: DataFrame,
    work: Workspace,
    text: str = "text",
    site: str = "source",
    ratio: float = RATIO,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """The rows with boilerplate lines taken out of ``text``; every row stays.

    ``counts`` names two further columns for the number of lines and of dropped lines. A null text
    stays null and has no lines, an empty one has one blank line; blank lines always stay. Rows with
    a null site are one site. Rows of a site with the same lines count as one page. Other columns are
    kept.
    """
    keys, of = fresh(docs.columns, "keys"), fresh(docs.columns, "of_site")
    sites = boilerplate(docs, text, site, ratio, keys).withColumnRenamed("site", of)
    sites = work.table(sites, "boilerplate")
    # few lines: Spark broadcasts them if they are small, and splits hot sites if they are not
    joined = docs.join(sites, docs[site].eqNullSafe(sites[of]), "left").drop(of)
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda x: ~F.array_contains(keys, line_key(x)))
    # sites without boilerplate keep their text as it is
    joined = joined.withColumn(keys, F.when(F.size(keys) > 0, F.col(keys)))
    changed = {text: F.when(F.col(keys).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))}
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0))
        n = F.when(F.col(text).isNull(), 0).otherwise(n)
        dropped = F.when(F.col(keys).isNull() | F.col(text).isNull(), 0).otherwise(F.size(lines) - F.size(kept))
        changed |= {counts[0]: n.cast("long"), counts[1]: dropped.cast("long")}
    return joined.withColumns(changed).drop(keys)
