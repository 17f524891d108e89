"""Equi-joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot from this share of a table's rows on.
HOT_SHARE = 1 / 256
# A hot key is cut into pieces of about this many rows.
ROWS_PER_PIECE = 500_000
SKETCH_GROUPS = 256


def hot_keys_of(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[str, dict]:
    """For each key column the values that hold at least ``share`` of the rows, with their approximate row counts.

    One scan of the key columns counts the rows and another fills frequent-items sketches of fixed size, merged in two
    steps, so nothing is shuffled by key and only about 1 / share values per column reach the driver. The sketch
    tracks enough values to miss none of these; a value just under the share may be named as well, which changes the
    balance of :func:`skew_join` but not its result. Every value named does occur in the table; ``None`` stands for
    missing keys. ``df`` should be a stored table, since both scans run right away; counting a stored table without
    filters reads file footers only.
    """
    rows = df.count()
    if not rows:
        return {k: {} for k in keys}
    most = int(1 / share) + 1
    tracked = 1 << (8 * most - 1).bit_length()
    names = [f"k{i}" for i in range(len(keys))]
    partial = (
        df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)))
        .agg(*[F.expr(f"approx_top_k_accumulate({n}, {tracked})").alias(n) for n in names])
    )
    top = f"approx_top_k_estimate(approx_top_k_combine({{}}, {tracked}), {2 * most})"
    found = partial.agg(*[F.expr(top.format(n)).alias(n) for n in names]).first()
    return {
        k: {item["item"]: item["count"] for item in found[n] if item["count"] >= share * rows}
        for k, n in zip(keys, names)
    }


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    return hot_keys_of(df, [key], share)[key]


def _pieces(key: Column, kind: T.DataType, hot: Mapping, rows_per_piece: int) -> Column:
    """Number of pieces the key is cut into; null for a key that is not hot. All keys are one literal map."""
    chosen = F.lit(None).cast("int")
    values = [value for value in hot if value is not None]
    if values:
        entries = [(F.lit(v).cast(kind), F.lit(_piece_count(hot[v], rows_per_piece))) for v in values]
        chosen = F.when(key.isNotNull(), F.element_at(F.create_map(*[x for pair in entries for x in pair]), key))
    if None in hot:
        chosen = F.when(key.isNull(), _piece_count(hot[None], rows_per_piece)).otherwise(chosen)
    return chosen


def _piece_count(rows: int, rows_per_piece: int) -> int:
    return max(2, math.ceil(rows / rows_per_piece))


def _hashable(kind: T.DataType) -> bool:
    """Maps and variants have no hash, nor has what they are nested in."""
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _spread(df: DataFrame, key: str, own: Mapping, other: Mapping, rows_per_piece: int, salt: str) -> DataFrame:
    """Rows whose key is hot on this side go to one piece each; rows whose key is hot on the other side are copied
    to every piece; all other rows form one piece. A row's piece depends on its content and its partition, not on
    the order of rows or on chance, so a recomputed task gives the same one."""
    hashable = [f"`{f.name}`" for f in df.schema.fields if _hashable(f.dataType)]
    own_pieces = _pieces(F.col(key), df.schema[key].dataType, own, rows_per_piece)
    other_pieces = _pieces(F.col(key), df.schema[key].dataType, other, rows_per_piece)
    one = F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), own_pieces).cast("int")
    if not other:
        return df.withColumn(salt, F.when(own_pieces.isNotNull(), one).otherwise(0))
    picked = (
        F.when(own_pieces.isNotNull(), F.array(one))
        .when(other_pieces.isNotNull(), F.sequence(F.lit(0), other_pieces - 1))
        .otherwise(F.array(F.lit(0)))
    )
    return df.select("*", F.explode(picked).alias(salt))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    hot_left: Mapping | None = None,
    hot_right: Mapping | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Equi-join on one key that drops ``right_key`` and cuts the given hot keys into pieces for several tasks.

    ``hot_left`` holds keys frequent on the left and their rows, ``hot_right`` those of the right; a key in both
    counts as hot on the left. The result is that of the plain join. ``how`` is inner, left, left_semi or left_anti;
    the last two take no ``hot_right``, and for left every key in ``hot_right`` has to occur on the right, as it does
    when it comes from :func:`hot_keys` of that table.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    # Missing keys match nothing; on the left they only need spreading where their rows are kept.
    keeps_missing = how in ("left", "left_anti")
    hot_left = {k: rows for k, rows in (hot_left or {}).items() if k is not None or keeps_missing}
    hot_right = {k: rows for k, rows in (hot_right or {}).items() if k is not None and k not in hot_left}
    if hot_right and how in ("left_semi", "left_anti"):
        raise ValueError(f"{how} keeps left rows as they are and cannot copy them for hot_right")
    right = right.withColumnRenamed(right_key, "_right_key")
    same_key = F.col(left_key) == F.col("_right_key")
    if not hot_left and not hot_right:
        return left.join(right, same_key, how).drop("_right_key")

    left = _spread(left, left_key, hot_left, hot_right, rows_per_piece, "_left_piece")
    copied = {k: rows for k, rows in hot_left.items() if k is not None}
    right = _spread(right, "_right_key", hot_right, copied, rows_per_piece, "_right_piece")
    joined = left.join(right, same_key & (F.col("_left_piece") == F.col("_right_piece")), how)
    if how == "left" and hot_right:
        # A copied left row meets right rows in some pieces; its other copies are no missing matches.
        was_copied = F.coalesce(F.col(left_key).isin(list(hot_right)), F.lit(False))
        joined = joined.where(~was_copied | F.col("_right_key").isNotNull())
    return joined.drop("_left_piece", "_right_key", "_right_piece")
