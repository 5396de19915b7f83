"""Judges URLs by given rules and by association rules mined from labelled ones.

DataFrame functions only; the frequent token combinations come from Spark's FP-growth.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.workspace import Workspace
from tillwork.operators.hot import spread

BLOCKED = "=block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: host, its labels, the words of compound labels, path
    segments, file type, names of query arguments, and whether there is a fragment. Digits are all one."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)

    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    plain = F.regexp_replace(path, r"\.[A-Za-z0-9]+$", "")
    segments = F.split(F.regexp_replace(_lower(plain), "[0-9]+", "#"), "/")
    kind = F.array(_lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)))
    names = F.regexp_extract_all(query, F.lit("([^&=]+)(=[^&]*)?"), F.lit(1))
    fragment = F.array(F.when(F.contains(url, F.lit("#")), "yes").otherwise(""))
    return F.array_sort(
        F.array_distinct(
            F.concat(
                marked("host:", F.array(host)),
                marked("label:", F.split(host, r"\.")),
                marked("word:", F.split(F.regexp_replace(host, r"(^|\.)[^.-]+(?=\.|$)", "."), r"[.-]")),
                marked("path:", segments),
                marked("type:", kind),
                marked("query:", names),
                marked("fragment:", fragment),
            )
        )
    )


def mine(
    labelled: DataFrame, least_support: float = 0.002, least_count: int = 5, confidence: float = 0.7
) -> DataFrame:
    """Token combinations that mean a blocked URL: ``tokens, confidence, support``.

    ``labelled`` has ``url`` and ``blocked``. A combination must be in ``least_support`` of
    the labelled URLs, and ``least_count`` of them, and that share of the URLs that have
    it must be blocked.
    """
    rows = (
        labelled.filter("url IS NOT NULL AND blocked IS NOT NULL")
        .select(tokens_of(F.col("url")).alias("tokens"), "blocked")
        .select(
            F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCKED)))
            .otherwise(F.col("tokens"))
            .alias("items")
        )
        .filter(F.size("items") > 0)
    )
    rows = Workspace(labelled.sparkSession).put(rows)
    n = rows.count()
    if not n:
        return rows.select(
            F.col("items").alias("tokens"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")
        )
    support = min(1.0, max(least_support, least_count / n))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    return model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCKED))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )


def _mined_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct token lists that some mined rule fits, with ``hit``.

    The rules are an inverted index under one token each, the one that the fewest URLs
    have, so a very common token is looked up only for rules made of such tokens.
    """
    lists = urls.groupBy("tokens", spread("tokens")).agg(F.count(F.lit(1)).alias("n"))
    shown = lists.select("tokens", "n", F.explode("tokens").alias("token"))
    common = shown.groupBy("token", spread("token")).agg(F.sum("n").alias("n"))
    numbered = rules.select("tokens", F.explode("tokens").alias("token"))
    index = (
        numbered.join(common.select("token", "n"), "token")
        .groupBy("tokens")
        .agg(F.min(F.struct("n", "token")).alias("by"))
        .select(F.col("tokens").alias("rule"), F.col("by.token").alias("token"))
    )
    fits = F.size(F.array_intersect("rule", "tokens")) == F.size("rule")
    found = shown.join(index, "token").filter(fits)
    # Shuffled once more, so that a join can split the rows of a list that very many URLs have.
    return found.groupBy("tokens", spread("tokens")).agg(F.lit(True).alias("hit")).drop("_spread")


def judge(urls: DataFrame, mined: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Whether each URL is allowed or blocked, as ``page_id, host, path, rule, verdict``.

    ``urls`` has ``page_id`` and ``url``; other columns are not read. A given rule fits its
    host and all subdomains if the path starts with the rule's; the longest that fits
    decides and is named. Without one, a URL is blocked if it has all tokens of a rule of
    ``mine``, else allowed.

    A missing URL, or one without ``://``, has an empty host and path; no given rule fits
    an empty host. One row for each input row.
    """
    url = F.col("url")
    rows = urls.select(
        F.col("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.coalesce(tokens_of(url), F.array().cast("array<string>")).alias("tokens"),
    )
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        within = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
        fits = within & F.startswith("path", F.lit(rule.path))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return rows.join(_mined_hits(rows, mined), "tokens", "left").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
    )


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The URLs of pages that show a labelled document, whose number ends their path.

    A URL counts as blocked if a label of its document says toxic or of no quality.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(/|\.[A-Za-z0-9]+)?$", 1)
    shown = pages.select("url", number.alias("number")).select(
        "url", F.expr("try_cast(number AS long)").alias("of")
    )
    marks = (
        labels.select(
            F.col("doc_id").cast("long").alias("of"),
            (F.col("toxic") == 1).alias("toxic"),
            (F.col("quality") == 0).alias("poor"),
        )
        .filter("of IS NOT NULL AND (toxic IS NOT NULL OR poor IS NOT NULL)")
        .groupBy("of")
        .agg(F.max(F.coalesce("toxic", F.lit(False)) | F.coalesce("poor", F.lit(False))).alias("blocked"))
    )
    return shown.join(marks, "of").select("url", "blocked")
