"""URL filters: rules first, then gradient-boosted trees on lexical features, trained from labelled URLs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "dots", "hyphens", "digit_ratio", "entropy", "parameters",
    "longest_label", "suffix_odds",
]


@dataclass(frozen=True)
class UrlFilter:
    """``rules`` are (verdict, host, path): a list of a size that fits an expression. ``sample`` bounds the labelled URLs
    the trees are fitted on, in expectation; they are chosen by hash. ``suffix_buckets`` bounds the table of suffixes."""

    rules: tuple[tuple[str, str, str], ...] = ()
    sample: int = 20_000
    trees: int = 15
    depth: int = 4
    suffix_buckets: int = 1024
    threshold: float = 0.5
    seed: int = 7

    def __post_init__(self):
        if min(self.sample, self.trees, self.depth, self.suffix_buckets) < 1:
            raise ValueError("sizes are 1 at least")
        if any(v not in ("allow", "block") for v, _, _ in self.rules) or len(self.rules) > 1000:
            raise ValueError("up to 1000 rules that allow or block")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: tuple[tuple[str, str, str], ...], host: Column, path: Column) -> Column:
    """The longest rule that fits (struct ``rule, verdict``), or null."""
    chosen = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return none if chosen is None else chosen.otherwise(none)


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    characters = F.array_distinct(F.split(text, ""))
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    bits = F.transform(F.filter(characters, lambda c: c != ""), lambda c: -share(c) * F.log2(share(c)))
    return F.when(size > 0, F.aggregate(bits, F.lit(0.0), lambda s, x: s + x)).otherwise(0.0)


def lexical(df: DataFrame, how: UrlFilter) -> DataFrame:
    """Features of ``url, host, path``, and the bucket of the host's last label."""
    url = F.coalesce(F.col("url"), F.lit(""))
    count = lambda chars, c=url: F.length(c) - F.length(F.translate(c, chars, ""))
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    return df.select(
        "*",
        F.length(url).cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        count("/", F.col("path")).cast("double").alias("depth"),
        count(".", F.col("host")).cast("double").alias("dots"),
        count("-").cast("double").alias("hyphens"),
        (count("0123456789") / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"),
        entropy(url).alias("entropy"),
        F.when(F.length(query) > 0, count("&", query) + 1).otherwise(0).cast("double").alias("parameters"),
        F.array_max(F.transform(F.split("host", "\\."), lambda x: F.length(x))).cast("double").alias("longest_label"),
        F.pmod(F.xxhash64(F.substring_index("host", ".", -1)), F.lit(how.suffix_buckets)).cast("int").alias("_bucket"),
    )


def url_filter(pages: DataFrame, how: UrlFilter) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages`` (``page_id``, ``url``).

    A URL that a rule fits gets the rule's verdict and is a labelled example; the others get ``block`` when the trees'
    ``score`` reaches the threshold, else ``allow``. When no rule has fitted, or all gave the same verdict, there is
    nothing to learn: scores are null and the verdict is ``allow``. A null url, or one without ``://``, has empty host and
    path. Repeated rows come back as often as they came, other columns are ignored; an empty table gives an empty result.
    """
    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    parts = asked.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    judged = parts.withColumn("_rule", rule_of(how.rules, F.col("host"), F.col("path")))
    ready = lexical(judged, how)
    known = ready.filter("_rule is not null").withColumn("label", (F.col("_rule.verdict") == "block").cast("double"))
    # One row per bucket of suffixes, however many suffixes there are.
    suffixes = known.groupBy("_bucket").agg(F.sum("label").alias("blocked"), F.count("*").alias("n")).collect()
    total, blocked = sum(r["n"] for r in suffixes), sum(r["blocked"] for r in suffixes)
    result = ["page_id", "host", "path", F.col("_rule.rule").alias("rule")]
    if blocked == 0 or blocked == total:
        verdict = F.coalesce(F.col("_rule.verdict"), F.lit("allow"))
        return ready.select(*result, verdict.alias("verdict"), F.lit(None).cast("double").alias("score"))
    # Share of blocked URLs per bucket, drawn towards the share of all.
    odds = [blocked / total] * how.suffix_buckets
    for r in suffixes:
        odds[r["_bucket"]] = (r["blocked"] + 10 * blocked / total) / (r["n"] + 10)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in odds)), ",")
    with_odds = lambda df: df.withColumn("suffix_odds", F.get(table, F.col("_bucket")).cast("double"))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    scale = 1 << 24
    chosen = F.pmod(F.xxhash64("url", F.lit(how.seed)), F.lit(scale)) < F.lit(min(1.0, how.sample / total) * scale)
    sample = stored(with_odds(known.filter(chosen)).select("label", *FEATURES), "url-sample")
    if sample.select("label").distinct().count() < 2:
        sample = stored(with_odds(known).select("label", *FEATURES), "url-sample")
    trees = GBTClassifier(maxIter=how.trees, maxDepth=how.depth, stepSize=0.2, seed=how.seed)
    model = trees.fit(vector.transform(sample))
    scored = model.transform(vector.transform(with_odds(ready)))
    score = vector_to_array("probability")[1]
    own = F.when(score >= how.threshold, "block").otherwise("allow")
    return scored.select(*result, F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), score.alias("score"))
