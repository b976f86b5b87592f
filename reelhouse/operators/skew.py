"""Joins of growing tables, and an explicit split of their hot keys.

Joins are plain Spark joins where adaptive execution can broadcast a side it has measured as small or split skewed
partitions. ``spread_join`` deals out the rows of keys that are known to be frequent, also where several joins follow each other or an
aggregation stands between, which adaptive execution leaves alone. The keys come from ``hot_keys``, counted exactly, or from
``frequent_keys``, estimated in one pass without a shuffle of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# A key with a larger share of the rows is cut into pieces of about this share. There are fewer than 1/share
# hot keys; with keys of at most KEY_BYTES bytes, their list takes less than KEY_BYTES / share bytes.
PIECE_SHARE = 1e-4
KEY_BYTES = 1024


def join_all(left: DataFrame, joins: list[tuple[DataFrame, list[str]]], how: str = "inner") -> DataFrame:
    """Join one frame after the other, each given with the columns it shares."""
    for right, on in joins:
        left = left.join(right, on, how)
    return left


def hot_keys(df: DataFrame, on: list[str], share: float = PIECE_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of the rows that have one, and ``pieces`` to cut each into.

    Keys longer than KEY_BYTES are never listed, which bounds the list in bytes; adaptive execution is left
    to split those.
    """
    size = sum((F.octet_length(F.col(c).cast("string")) for c in on), F.lit(0))
    counts = df.where(size <= KEY_BYTES).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    piece = counts.agg(F.sum("_n")).scalar() * F.lit(share)
    hot = counts.where(F.col("_n") > piece)
    return hot.select(*on, F.ceil(F.col("_n") / F.greatest(piece, F.lit(1.0))).cast("int").alias("pieces"))


def frequent_keys(df: DataFrame, keys: dict[str, list[str]], share: float = PIECE_SHARE, tracked: int = 10_000) -> DataFrame:
    """(side, key, n, total): estimated rows of the keys that hold more than ``share`` of them, for several kinds of keys in one pass.

    ``keys`` names the columns of each side. Every task keeps ``tracked`` keys at most, whatever the number of rows, and only those sketches are
    merged, so the result is small by construction. Counts are lower bounds of a frequent-items sketch. ``key`` is the JSON text of the columns; keys of
    more than KEY_BYTES bytes and rows without any of the columns are left to adaptive execution.
    """
    text = {side: F.to_json(F.struct(*cols)) for side, cols in keys.items()}
    whole = {side: F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in cols], F.lit(0)) == 0, text[side]) for side, cols in keys.items()}
    sides = df.select(*[F.when(F.octet_length(k) <= KEY_BYTES, k).alias(side) for side, k in whole.items()])
    most = min(int(1 / share), tracked)
    found = sides.agg(F.count(F.lit(1)).alias("total"), *[F.expr(f"approx_top_k({side}, {most}, {tracked})").alias(side) for side in keys])
    listed = [found.select(F.lit(side).alias("side"), F.inline(side), "total") for side in keys]
    named = reduce(DataFrame.unionAll, listed).withColumnsRenamed({"item": "key", "count": "n"})
    return named.where(F.col("key").isNotNull() & (F.col("n") > F.col("total") * share))


def pieces_of(frequencies: DataFrame, side: str, schema: str, share: float = PIECE_SHARE) -> DataFrame:
    """Hot keys of one side for ``spread_join``, in the columns of ``schema``, with the pieces their rows are dealt out to."""
    cut = F.ceil(F.col("n") / F.greatest(F.col("total") * share, F.lit(1.0))).cast("int")
    own = frequencies.where(F.col("side") == side)
    return own.select(F.from_json("key", schema).alias("key"), cut.alias("pieces")).select("key.*", "pieces")


def spread_join(left: DataFrame, right: DataFrame, on: list[str], row_id: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join in which the rows of a hot left key are dealt out by ``row_id``, a column that tells left rows apart.

    The right rows of a hot key are repeated once per piece, so every pair meets exactly once, also if
    left rows are equal in all other columns. ``hot`` comes from ``hot_keys``, best from a stored table.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot preserve the right side: {how}")
    pieces = F.broadcast(hot.select(*on, F.col("pieces").alias("_pieces")))  # bounded by share and KEY_BYTES
    count = F.coalesce(F.col("_pieces"), F.lit(1))
    dealt = left.join(pieces, on, "left").withColumn("_piece", F.pmod(F.xxhash64(row_id), count).cast("int")).drop("_pieces")
    copies = F.explode(F.sequence(F.lit(0), count - 1))
    repeated = right.join(pieces, on, "left").withColumn("_piece", copies).drop("_pieces")
    return dealt.join(repeated, [*on, "_piece"], how).drop("_piece")
