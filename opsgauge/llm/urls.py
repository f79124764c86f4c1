"""URL filter: rules first, then the ratio of two character language models.

DataFrame functions only. The models are Markov models of variable order (up to three characters of
context, each order smoothed with the one below by Witten-Bell's rule), one of the accepted urls and
one of the rejected ones, as the rules judge them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgauge.llm.workspace import Workspace, fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 4
ALPHABET = 256
BEGIN, END = "\u0002", "\u0003"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and how the path begins."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest) + 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(after, "^[^?#]*", 0)


def judge_by_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    longest = sorted(rules, key=lambda r: -len(r.name))
    first = lambda value: F.coalesce(*(F.when(r.fits(host, path), value(r)) for r in longest), F.lit(None))
    return first(lambda r: r.name).cast("string"), first(lambda r: r.verdict).cast("string")


def grams(url: Column) -> Column:
    """A gram for each character and for the end: the character after its three predecessors."""
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), F.translate(url, UPPER, LOWER), F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - ORDER + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, log_ratio) from (gram, allow, block), the counts of each gram in either class: natural
    logarithm of the character's probability after its context in the one model over the other."""
    lower = None
    for k in range(1, ORDER + 1):
        table = counts.groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(
            F.sum("allow").alias("allow"), F.sum("block").alias("block")
        )
        context = F.left("gram", F.lit(k - 1))
        seen = table.groupBy(context.alias("context")).agg(
            *(F.sum(c).alias(f"{c}_n") for c in ("allow", "block")),
            *(F.count_if(F.col(c) > 0).alias(f"{c}_t") for c in ("allow", "block")),
        )
        table = table.withColumn("context", context).join(seen, "context")
        if lower is None:
            table = table.withColumns({f"{c}_p": F.lit(1.0 / ALPHABET) for c in ("allow", "block")})
        else:
            table = table.withColumn("tail", F.right("gram", F.lit(k - 1))).join(lower, "tail")
        smooth = lambda c: F.when(
            F.col(f"{c}_n") > 0, (F.col(c) + F.col(f"{c}_t") * F.col(f"{c}_p")) / (F.col(f"{c}_n") + F.col(f"{c}_t"))
        ).otherwise(F.col(f"{c}_p"))
        lower = table.select(F.col("gram").alias("tail"), *(smooth(c).alias(f"{c}_p") for c in ("allow", "block")))
    return lower.select(F.col("tail").alias("gram"), (F.log("allow_p") - F.log("block_p")).alias("log_ratio"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], work: Workspace, url: str = "url") -> DataFrame:
    """The rows with host, path, rule, verdict (allow or block) and score.

    The verdict is that of the longest fitting rule, else of the models: allow if the score is not
    below 0. The score of a url is the mean log ratio of its characters and its end, less the
    midpoint between the two classes' mean scores (each page counts); it is rounded to 9 places.
    Without training urls of both classes the midpoint is 0. A null url is judged as an empty one.
    Columns of the table named like a new one are replaced; others are kept, and all rows stay.
    """
    key = fresh(pages.columns, "url_key")
    names = ("host", "path", "rule", "verdict", "score")
    host, path = host_and_path(F.col(url))
    rule, verdict = judge_by_rules(host, path, rules)
    text = F.coalesce(url, F.lit(""))
    # equal urls are scored once, with their number as weight
    distinct = (
        pages.groupBy(text.alias("url"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("class", judge_by_rules(*host_and_path(F.col("url")), rules)[1])
    )
    distinct = work.table(distinct, "urls")
    # a gram counts once for each place: rows are summed by gram in every task before the shuffle
    weight = lambda c: F.sum(F.when(F.col("class") == c, F.col("n")).otherwise(0)).alias(c)
    counts = distinct.select("class", "n", F.explode(grams(F.col("url"))).alias("gram")).groupBy("gram")
    counts = work.table(counts.agg(weight("allow"), weight("block")), "counts")
    ratios = work.table(log_ratios(counts), "ratios")
    # grams that many urls share are hot keys: both sides are plain tables, so Spark splits them
    each = distinct.select(
        F.xxhash64("url").alias(key), F.col("class"), F.col("n"), F.explode(grams(F.col("url"))).alias("gram")
    )
    scores = each.join(ratios, "gram").groupBy(key, "class", "n").agg(F.avg("log_ratio").alias("raw"))
    scores = work.table(scores, "scores")
    mean = lambda c: F.sum(F.when(F.col("class") == c, F.col("raw") * F.col("n"))) / F.sum(F.when(F.col("class") == c, F.col("n")))
    middle = scores.agg(F.coalesce((mean("allow") + mean("block")) / 2, F.lit(0.0)).alias("m")).first()["m"]
    scored = scores.select(key, F.round(F.col("raw") - F.lit(middle), 9).alias("score"))
    rows = pages.drop(*(c for c in pages.columns if c.lower() in names and c.lower() != url.lower()))
    rows = rows.withColumns({"host": host, "path": path, "rule": rule, "verdict": verdict, key: F.xxhash64(text)})
    out = rows.join(scored, key, "left").drop(key)
    return out.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= 0, "allow").otherwise("block")))
