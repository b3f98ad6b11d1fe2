"""Verdicts on URLs: rules by host and path first, gradient-boosted trees on lexical features otherwise.

A null URL or one without ``://`` has an empty host and path; no rule fits it and the trees see its letters only.
Repeated URLs are judged alike. The trees are trained on URLs that a rule decides, at most ``sample`` of
each verdict, chosen by a hash of the URL. If only one verdict occurs it is that of all others; if none, ``allow``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 5_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "labels", "depth", "digits", "letters", "hyphens", "entropy", "parameters",
            "fragment", "secure", "suffix_length", "suffix_share", "first_share", "last_digits")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits the host or one of its parents and the path's start."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last that fits wins
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))).cast("double"))
    return F.coalesce(F.aggregate(counts, F.lit(0.0), lambda total, k: total - F.when(k > 0, k / n * F.log2(k / n)).otherwise(0.0)), F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the lexical features that need no other rows."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    per = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    suffix = F.element_at(F.split(host, r"\."), -1)
    values = {
        "length": F.length(url), "host_length": F.length(host), "labels": F.size(F.split(host, r"\.")),
        "depth": F.regexp_count(path, F.lit("/[^/]")), "digits": F.regexp_count(url, F.lit("[0-9]")) / per,
        "letters": F.regexp_count(url, F.lit("[A-Za-z]")) / per, "hyphens": F.regexp_count(url, F.lit("-")),
        "entropy": _entropy(url), "parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "fragment": F.instr(url, "#") > 0, "secure": url.startswith("https"), "suffix_length": F.length(suffix),
        "last_digits": F.regexp_count(F.element_at(F.split(path, "/"), -1), F.lit("[0-9]")),
    }
    return urls.select("*", suffix.alias("suffix"), F.concat_ws("/", suffix, F.get(F.split(path, "/"), F.lit(1))).alias("first"),
                       *(F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in values.items()))


def _shares(labelled: DataFrame, key: str, into: str) -> DataFrame:
    """Share of blocked URLs per key, drawn towards a half where there are few."""
    blocked = F.sum((F.col("verdict") == "block").cast("double"))
    return labelled.groupBy(key).agg(((blocked + 1) / (F.count(F.lit(1)) + 2)).alias(into))


def _with_shares(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    for key, into in (("suffix", "suffix_share"), ("first", "first_share")):
        rows = rows.join(_shares(labelled, key, into), key, "left").withColumn(into, F.coalesce(into, F.lit(0.5)))
    return rows


def train(labelled: DataFrame, sample: int = SAMPLE, trees: int = 12, depth: int = 4) -> PipelineModel | str:
    """Trees fitted on a bounded sample of labelled rows, or the one verdict that occurs."""
    sizes = {r["verdict"]: r["n"] for r in labelled.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return next(iter(sizes), "allow")
    share = F.create_map(*(F.lit(x) for verdict, n in sizes.items() for x in (verdict, min(1.0, sample / n))))
    drawn = labelled.where(F.pmod(F.xxhash64("url", "page"), F.lit(1 << 30)) < share[F.col("verdict")] * (1 << 30))
    rows = drawn.withColumn("label", (F.col("verdict") == "block").cast("double"))
    stages = [VectorAssembler(inputCols=list(FEATURES), outputCol="_features"),
              GBTClassifier(featuresCol="_features", maxIter=trees, maxDepth=depth, seed=1, stepSize=0.3)]
    return Pipeline(stages=stages).fit(rows.select("label", *FEATURES))


def judge(pages: DataFrame, rules: Sequence[Rule], sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score (that of the trees, 1 is block)."""
    urls = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = lexical(urls.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))).select("*", "ruled.rule", "ruled.verdict")
    labelled = ruled.where(F.col("verdict").isNotNull())
    rows = _with_shares(ruled, labelled)
    model = train(rows.where(F.col("verdict").isNotNull()), sample)
    if isinstance(model, str):
        scored = rows.withColumn("score", F.lit(1.0 if model == "block" else 0.0))
    else:
        scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    verdict = F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("page").alias("page_id"), "host", "path", "rule", verdict.alias("verdict"), F.round("score", 6).alias("score"))
