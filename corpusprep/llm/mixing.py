"""Mixing sources to target weights by iterative proportional fitting: DataFrame functions only.

Tokens are summed per cell, a combination of source, language and topic. Raking scales the cells' weights to one
marginal after the other until all fit; documents are then sampled with probabilities calibrated to a token budget. Only
cells, never documents, go through the iterations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyed import measured_lookup
from ..session import materialize
from .common import SPACE, stored


@dataclass(frozen=True)
class Mixing:
    """``rounds`` of raking over all dimensions, the last of which fits exactly; ``share`` of all tokens to sample;
    ``capping`` rounds move tokens from cells that give all they have to the others; ``seed`` of the sample."""

    dimensions: tuple[str, ...] = ("source", "lang", "topic")
    rounds: int = 10
    share: float = 0.5
    capping: int = 8
    seed: int = 7

    def __post_init__(self):
        if not self.dimensions or min(self.rounds, self.capping) < 1 or not 0 < self.share <= 1:
            raise ValueError("some dimension, a round at least, a share above 0 up to 1")


def n_tokens(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.size(F.array_remove(F.split(text.cast("string"), SPACE), "")), F.lit(0)).cast("long")


def text_form(text: Column) -> Column:
    """A topic for tables without one: what most of a text's marks are."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    count = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    size = F.greatest(F.length(t), F.lit(1))
    return (
        F.when(count("#*$%&|<>") * 20 > size, "marks")
        .when(count("0123456789") * 20 > size, "numbers")
        .when(F.length(t) < 1000, "short")
        .otherwise("prose")
    )


def tempered(cells: DataFrame, dimension: str, exponent: float) -> DataFrame:
    """``value, target``: the dimension's shares of tokens raised to a power, so that small values gain."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("_t"))
    return sums.filter("_t > 0").select("value", F.pow(F.col("_t").cast("double"), F.lit(exponent)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], how: Mixing) -> DataFrame:
    """Cells with ``weight``: shares of the mixture that fit the targets.

    A target of a value without tokens is ignored and a value without target keeps no weight; the targets that remain
    are scaled to one. Cells without tokens have weight 0.
    """
    for name in how.dimensions:
        present = cells.groupBy(name).agg(F.sum("tokens").alias("_t")).filter("_t > 0").select(name)
        target = targets[name].select(F.col("value").alias(name), F.col("target").cast("double").alias(f"_{name}"))
        target = stored(target.join(present, name), "mixing-targets")
        scale = target.agg(F.sum(f"_{name}")).first()[0] or 1.0
        cells = measured_lookup(cells, target, [name], [d for d in how.dimensions if d != name] or [name])
        cells = cells.withColumn(f"_{name}", F.coalesce(F.col(f"_{name}") / scale, F.lit(0.0)))
    # Raking fits sums to shares, so weights may start as tokens.
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(how.rounds):
        for name in how.dimensions:
            marginal = F.sum("weight").over(Window.partitionBy(name))
            cells = cells.withColumn(
                "weight", F.when(marginal > 0, F.col("weight") * F.col(f"_{name}") / marginal).otherwise(0.0)
            )
        cells = materialize(cells)
    return cells.drop(*[f"_{name}" for name in how.dimensions])


def calibrated(cells: DataFrame, how: Mixing) -> DataFrame:
    """Cells with ``probability``: tokens in expectation are ``weight`` of the budget, or all that the cell has."""
    budget = (cells.agg(F.sum("tokens")).first()[0] or 0) * how.share
    cells = materialize(cells.withColumn("probability", F.lit(0.0)))
    full, capped = F.col("probability") >= 1, -1
    for _ in range(how.capping):
        given, open_weight, count = cells.agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count_if(full),
        ).first()
        if count == capped or open_weight <= 0:
            break
        capped = count
        asked = F.col("weight") * F.lit((budget - given) / open_weight) / F.col("tokens")
        bounded = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), asked))).otherwise(0.0)
        cells = materialize(cells.withColumn("probability", F.when(full, 1.0).otherwise(bounded)))
    return cells


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def mix(docs: DataFrame, targets: dict[str, DataFrame] | float, how: Mixing = Mixing()) -> DataFrame:
    """``docs`` with ``n_tokens``, ``probability`` and ``kept`` for every row.

    ``targets`` gives for each dimension a DataFrame ``value, target``, or is the exponent that tempers the shares that
    the tokens have. Dimensions are columns of ``docs``; a null value counts as the empty string. A text without words
    has no tokens and its cell's probability; rows with the same doc_id are kept or not together, null ids too. Columns
    of ``docs`` named like the new ones are replaced. An empty table gives an empty result.
    """
    spark_docs = docs.drop("n_tokens", "probability", "kept")
    keys = [f"_cell_{d}" for d in how.dimensions]
    counted = spark_docs.withColumn("n_tokens", n_tokens(F.col("text")))
    for d, key in zip(how.dimensions, keys, strict=True):
        counted = counted.withColumn(key, F.coalesce(F.col(d).cast("string"), F.lit("")))
    cells = stored(
        counted.groupBy(*[F.col(k).alias(d) for d, k in zip(how.dimensions, keys, strict=True)]).agg(
            F.sum("n_tokens").alias("tokens")
        ),
        "mixing-cells",
    )
    if isinstance(targets, (int, float)):
        targets = {d: tempered(cells, d, float(targets)) for d in how.dimensions}
    weighed = calibrated(rake(cells, targets, how), how)
    named = weighed.select(*[F.col(d).alias(k) for d, k in zip(how.dimensions, keys, strict=True)], "probability")
    joined = measured_lookup(counted, named, keys, ["doc_id"])
    kept = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), how.seed) < F.col("probability")
    return joined.select(*spark_docs.columns, "n_tokens", "probability", kept.alias("kept"))
