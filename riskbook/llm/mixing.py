"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Sources share a budget of words by their weights; no source is asked for more than ``most`` times what it has, and what
it cannot take is shared among the others again. Documents draw exponential keys, scaled by their quality weight, and
stand in order of their key within their source. A source gives complete epochs first (every document once per epoch),
then documents in order of their keys up to its budget; the words still missing come from the document at the border.

The border is found by sums: words per (source, bin of the key), then per key within the one bin at the border. So no
source is sorted or gathered as a whole. Keys come from a hash of id and text, so reruns agree.

* null text: no words; nothing is taken of texts without words; null sources: one source, last in order;
* null ids: allowed, the text alone decides the key;
* equal rows: one key; if the border falls on them they share the missing words evenly, rounded down;
* very long text: may lie at the border, and is then taken in part;
* empty tables: no rows; other columns: kept by ``mixed_rows``, not looked at by ``mixture``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskbook.llm.common import WORD, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BINS = 4096
HEX_DIGITS = 13


def quality_weight(text: Column) -> Column:
    """From 0.25 to 1 with the share of letters among the characters of a text."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.lit(0.25) + F.lit(0.75) * letters / F.greatest(F.length(text), F.lit(1))


def sampling_key(id_: Column, text: Column, weight: Column, seed: int) -> Column:
    """An exponential draw divided by the weight; the smaller, the earlier a document is taken."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("")), text))
    whole = F.conv(F.substring(drawn, 1, HEX_DIGITS), 16, 10).cast("long")
    return -F.log((whole + 0.5) / F.lit(float(16**HEX_DIGITS))) / weight


def _slim(df: DataFrame, text: str, id_col: str, source: str, seed: int, *more: Column) -> DataFrame:
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        *more,
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source}`").alias("source"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
        sampling_key(F.col(f"`{id_col}`"), whole, quality_weight(whole), seed).alias("key"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``target`` words of each source of ``sizes`` (``source``, ``source_size``), one row per source.

    Sources fill up in the order of their limit over their weight: a source is full if the common level so far would
    pass its limit; the level of the first that is not full holds for all that follow.
    """
    ranked = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(ranked) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    all_rows = W.partitionBy()
    weighed = sizes.select("source", "source_size", weight.alias("weight"))
    weighed = weighed.withColumns(
        {
            "limit": F.col("source_size") * most,
            "budget": F.sum("source_size").over(all_rows) * share,
            "weights": F.sum("weight").over(all_rows),
        }
    )
    earlier = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1
    )
    level = (F.col("budget") - F.coalesce(F.sum("limit").over(earlier), F.lit(0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    levelled = weighed.withColumn("level", level)
    open_level = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.col("level"))
    # Behind the first source that is not full the formula gives ever lower levels, so the highest open one is its own.
    common = levelled.withColumn("common", F.max(open_level).over(all_rows))
    full = open_level.isNull()
    target = F.when(full, F.col("limit").cast("double")).otherwise(F.col("common") * F.col("weight"))
    return common.select("source", "source_size", target.alias("target"))


def _borders(slim: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Per source: its size and target, complete ``epochs``, and where the fraction ends: ``border`` is the first key
    that is not taken whole, ``missing`` the words still taken from the ``border_rows`` with that key."""
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    asked = targets(sizes, weights, share, most)
    goal = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    asked = stored(asked.withColumn("epochs", epochs).withColumn("part", goal - epochs * F.col("source_size")), "targets")

    name = {"source": "of"}
    binned = slim.withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * BINS).cast("int"))
    in_order = W.partitionBy("source").orderBy("bin")
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("upto", F.sum("words").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    parts = asked.select("source", "part").withColumnsRenamed(name)
    at_border = (F.col("part") > F.col("upto") - F.col("words")) & (F.col("part") <= F.col("upto"))
    border_bins = sums.join(parts, F.col("source").eqNullSafe(F.col("of"))).where(at_border)
    border_bins = border_bins.select(
        "of", F.col("bin").alias("at_bin"), (F.col("part") - F.col("upto") + F.col("words")).alias("rest")
    )
    inside = binned.join(border_bins, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("at_bin")))
    by_key = inside.groupBy("of", "rest", "key").agg(F.sum("size").alias("words"), F.count("*").alias("border_rows"))
    upto = F.sum("words").over(W.partitionBy("of").orderBy("key").rowsBetween(W.unboundedPreceding, 0))
    by_key = by_key.withColumn("upto", upto)
    here = (F.col("rest") > F.col("upto") - F.col("words")) & (F.col("rest") <= F.col("upto"))
    border = by_key.where(here).select(
        "of", F.col("key").alias("border"), (F.col("rest") - F.col("upto") + F.col("words")).alias("missing"), "border_rows"
    )
    return asked.drop("part").join(border, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


def _taken() -> Column:
    """The words the mix takes of a document, repeats counted."""
    fraction = (
        F.when(F.col("key") < F.col("border"), F.col("size"))
        .when(F.col("key") == F.col("border"), F.floor(F.col("missing") / F.col("border_rows")))
        .otherwise(0)
    )
    return (F.col("epochs") * F.col("size") + fraction).cast("long")


def _joined(rows: DataFrame, borders: DataFrame) -> DataFrame:
    named = borders.withColumnRenamed("source", "of")
    return rows.join(named, F.col("source").eqNullSafe(F.col("of"))).withColumn("taken", _taken())


def mixture(
    df: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``df``: the id, ``size`` in words, ``source_size``, ``target`` of its source and ``taken``."""
    slim = stored(_slim(df, text, id_col, source, seed), "mix")
    found = _joined(slim, stored(_borders(slim, weights, share, most), "borders"))
    return found.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed_rows(
    df: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """The mix itself: the rows of ``df`` with all their columns, each as often as it is taken. Documents stay whole:
    one that is taken in part counts if at least half of it is."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    slim = stored(_slim(df, text, id_col, source, seed), "mix")
    # Stored, so that its size is known when the join is planned: rows with their texts need not move for it.
    borders = stored(_borders(slim, weights, share, most), "borders")
    found = _joined(_slim(df, text, id_col, source, seed, row), borders).where("size > 0")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    return found.select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
