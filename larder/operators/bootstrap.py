"""How sure the metrics of classifiers and their differences are: a Poisson bootstrap in one pass.

In each replicate a row counts as often as a Poisson number of mean one, taken
from a hash of its key and the replicate. So the intervals depend on neither
partitions nor order, all rows of one key go together, and two models see the
same replicates, which makes differences paired without a join. Rows are added
up, before any shuffle, into a histogram by (model, label, prediction, score bin) with
a weight for each replicate; histograms of parts of the data can be added. All
metrics come from it, and its size does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations
from math import exp, factorial
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.config import FOODS

# A digest gives so many weights, of so many bits each.
WEIGHTS, BITS = 8, 15
# The replicate that counts each row once.
ESTIMATE = -1
METRICS = ("accuracy", "precision", "recall", "f1", "auc")


def poisson_cuts(bits: int = BITS) -> list[int]:
    """From which of the 2**bits equally likely numbers on a Poisson number of mean one is above 0, 1, 2, ..."""
    cuts, total, k = [], 0.0, 0
    while not cuts or cuts[-1] < 1 << bits:
        total += exp(-1) / factorial(k)
        cuts.append(round(total * (1 << bits)))
        k += 1
    return [c for c in cuts if c < 1 << bits]


def _weights(halves: list[str]) -> list[Column]:
    """The weights that two numbers of 60 bits give: four numbers each, held against the cuts."""
    numbers = [F.shiftright(half, BITS * part).bitwiseAND((1 << BITS) - 1) for half in halves for part in range(WEIGHTS // 2)]
    return [reduce(add, [(number >= cut).cast("int") for cut in poisson_cuts()]) for number in numbers]


def stacked(predictions: Mapping[str, DataFrame], key: str = FOODS.id) -> DataFrame:
    """Scored test rows of several models below each other, the score being the probability of class 1."""
    rows = None
    for model, df in predictions.items():
        own = df.select(
            F.lit(model).alias("model"), F.col(key).alias("key"), F.col("label").cast("double").alias("label"),
            F.col("prediction").cast("double").alias("prediction"), vector_to_array("probability")[1].alias("score"),
        )
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        raise ValueError("no model is given")
    return rows


def histogram(scored: DataFrame, replicates: int = 200, bins: int = 1000) -> DataFrame:
    """``model chunk label prediction bin n w0 ... w7`` of rows ``model key label prediction score``.

    Replicate ``chunk * 8 + i`` has its weights in ``wi``. Scores from 0 to 1 fall into equal bins, others into the
    nearest. Rows without a label, prediction or score are left out; rows without a key share their weights.
    """
    if replicates < 1 or bins < 1:
        raise ValueError("replicates and bins are at least 1")
    chunks = -(-replicates // WEIGHTS)
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(F.col("score") * bins).cast("int")))
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("chunk").cast("string")))
    names = ["model", "chunk", "label", "prediction", "bin"]
    halves = {name: F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for name, start in (("_high", 1), ("_low", 16))}
    cells = (
        scored.where("label IS NOT NULL AND prediction IS NOT NULL AND score IS NOT NULL")
        .select("model", "key", "label", "prediction", place.alias("bin"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
        .select(*names, *[half.alias(name) for name, half in halves.items()])
        .select(*names, *[w.alias(f"w{i}") for i, w in enumerate(_weights(list(halves)))])
    )
    return cells.groupBy("model", "chunk", "label", "prediction", "bin").agg(
        F.count("*").alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(WEIGHTS)]
    )


def merged(*histograms: DataFrame) -> DataFrame:
    """One histogram of the rows of all."""
    rows = histograms[0]
    for more in histograms[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("model", "chunk", "label", "prediction", "bin").agg(*[F.sum(c).alias(c) for c in ("n", *[f"w{i}" for i in range(WEIGHTS)])])


def replicate_metrics(cells: DataFrame, replicates: int = 200) -> DataFrame:
    """``model replicate metric value`` of a histogram; replicate -1 counts each row once.

    The five metrics of ``classification_metrics``, not rounded. A replicate that holds one label only has no area.
    """
    weights = [F.struct((F.col("chunk") * WEIGHTS + i).alias("replicate"), F.col(f"w{i}").alias("w")) for i in range(WEIGHTS)]
    once = F.struct(F.when(F.col("chunk") == 0, F.lit(ESTIMATE)).alias("replicate"), F.col("n").alias("w"))
    rows = cells.select("model", "label", "prediction", "bin", F.inline(F.array(once, *weights)))
    rows = rows.where((F.col("replicate") < replicates) & (F.col("w") > 0))
    by = ["model", "replicate"]

    counts = rows.groupBy(*by, "label", "prediction").agg(F.sum("w").cast("double").alias("n"))
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("truth"), F.lit(0.0).alias("predicted"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0.0).alias("hits")),
                F.struct(F.col("prediction").alias("class"), F.lit(0.0).alias("truth"), F.col("n").alias("predicted"), F.lit(0.0).alias("hits")),
            )
        ),
    )
    classes = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("truth", "predicted", "hits")])
    p, r = (F.coalesce(F.try_divide("hits", c), F.lit(0.0)) for c in ("predicted", "truth"))
    f = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    rated = classes.withColumn("p", p).withColumn("r", r).withColumn("f", f)
    total = F.sum("truth")
    averages = rated.groupBy(*by).agg(
        (F.sum("hits") / total).alias("accuracy"),
        *[(F.sum(F.col(c) * F.col("truth")) / total).alias(name) for c, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))],
    )

    sums = rows.groupBy(*by, "bin").agg(
        F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("w"))).cast("double").alias("neg"),
    )
    upto = Window.partitionBy(*by).orderBy("bin")
    area = (
        sums.withColumn("below", F.sum("neg").over(upto) - F.col("neg"))
        .groupBy(*by)
        .agg(F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)), F.sum("pos") * F.sum("neg")).alias("auc"))
    )
    return averages.join(area, by).unpivot(by, list(METRICS), "metric", "value")


def intervals(metrics: DataFrame, models: tuple[str, ...] = (), level: float = 0.95, places: int = 4) -> DataFrame:
    """``model metric value low high``: the estimate and the interval that holds ``level`` of the replicates.

    For each two of ``models`` there are also rows ``first - second``, of the differences within each replicate.
    """
    if not 0 < level < 1:
        raise ValueError(f"level is between 0 and 1, not {level}")
    rows = metrics
    for a, b in combinations(models, 2):
        ours, theirs = (F.max(F.when(F.col("model") == m, F.col("value"))) for m in (a, b))
        both = metrics.where(F.col("model").isin(a, b)).groupBy("replicate", "metric").agg((ours - theirs).alias("value"))
        rows = rows.unionByName(both.select(F.lit(f"{a} - {b}").alias("model"), "replicate", "metric", "value"))
    drawn = F.when(F.col("replicate") != ESTIMATE, F.col("value"))
    ends = [F.round(F.percentile(drawn, end), places).alias(name) for name, end in (("low", (1 - level) / 2), ("high", (1 + level) / 2))]
    value = F.round(F.max(F.when(F.col("replicate") == ESTIMATE, F.col("value"))), places).alias("value")
    return rows.groupBy("model", "metric").agg(value, *ends)


def metric_intervals(
    scored: DataFrame, models: tuple[str, ...] = (), *, replicates: int = 200, bins: int = 1000, level: float = 0.95, places: int = 4
) -> DataFrame:
    """Intervals of the five metrics of each model, and of the differences of each two of ``models``."""
    return intervals(replicate_metrics(histogram(scored, replicates, bins), replicates), models, level, places)
