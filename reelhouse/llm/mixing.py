"""Mix sources to target weights by hash-random order, distributed prefix sums and exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelhouse.llm.common import SPACES, stored, whole_text

# Weights by the order of the sources, and the most a source may be repeated.
WEIGHTS = (1, 2, 3)
MOST = 3
# Rows sorted together in one task; a source of any size is cut into ranges of about so many.
RANGE_ROWS = 2048
KEY_SPAN = 1 << 52


def word_count(text: str = "text") -> Column:
    """Runs of anything but white space; null has none."""
    gaps = F.split(F.trim(F.regexp_replace(whole_text(text), SPACES, " ")), " ", -1)
    return F.when(F.trim(F.regexp_replace(whole_text(text), SPACES, " ")) == "", F.lit(0)).otherwise(F.size(gaps)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """(source, source_size, n_rows, target) from one row per source: ``share`` of all words dealt out by weight.

    A source takes at most ``most`` times its size; what it can't take goes to the others by weight.
    With the sources in the order of cap per unit of weight, those before some place are full and
    the rest share what is left. The level that would be left for the rest rises up to that place and
    falls after it, so its largest value is the level. Sources rank by code point, null last.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before, rest = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    cut = ranked.withColumn("level", level).withColumn("cut", F.max("level").over(whole))
    target = F.least(F.col("cap").cast("double"), F.col("cut") * F.col("weight"))
    return cut.select("source", "source_size", "n_rows", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", extra: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken, copies.

    Each source is put in the order of a hash of (seed, doc_id). Its budget is its target rounded
    down: so many whole epochs over the source, then documents in that order up to the exact
    word, so ``taken`` of one document per source may end within an epoch of it. ``copies`` counts the
    epochs in which any part of the document falls (documents without words fall in the whole epochs
    and in the rest while it lasts).

    A source is cut into key ranges of about RANGE_ROWS rows, counted from its own row count; each
    range is sorted and summed by itself and shifted by the sum of the ranges before it. A reread
    gives the same order, ties of the key being broken by doc_id and size; documents equal in all
    three are interchangeable. Null source is a source, null doc_id an id, null text has size 0.
    ``extra`` columns are carried along.
    """
    extra = extra or []
    named = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null"), F.md5(whole_text(text))))  # rows without an id spread by their text
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), named)), 1, 13), 16, 10).cast("long")
    rows = stored(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"), key.alias("key"), *extra,
    ), "mix-sizes").withColumn("named", F.col("source").isNotNull()).withColumn("name", F.coalesce("source", F.lit("")))
    totals = rows.groupBy("named", "name").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    plan = stored(targets(totals, weights, most), "mix-targets")
    plan = plan.withColumn("named", F.col("source").isNotNull()).withColumn("name", F.coalesce("source", F.lit(""))).drop("source")
    ranges = F.ceil(F.col("n_rows") / F.lit(RANGE_ROWS))
    placed = rows.join(plan, ["named", "name"]).withColumn("range", F.floor(F.col("key") / F.lit(float(KEY_SPAN)) * ranges).cast("long"))
    at = ["named", "name", "range"]
    sums = placed.groupBy(*at).agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("named", "name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*at, F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy(*at).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = summed.join(starts, at)
    epochs, budget = F.col("epochs"), F.floor("target").cast("long")
    dealt = joined.withColumn("before", F.col("start") + F.col("inside")) \
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")) \
        .withColumn("rest", budget - epochs * F.col("source_size"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return dealt.select(
        "doc_id", "size", "source", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"),
        (epochs + (F.col("before") < F.col("rest")).cast("long")).alias("copies"), *extra,
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The documents of the mix, all columns unchanged, a document repeated once per epoch it falls in.

    Documents stay whole: the one at a source's cut is written if its first word is within the budget, so
    a source exceeds its budget by less than that document.
    """
    row = "_mix_row"
    carried = docs.withColumn(row, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    dealt = mix(carried, weights, most, seed, extra=[row])
    repeated = dealt.where("copies > 0").select(row, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return repeated.select(f"{row}.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null' || md5(coalesce(text, '')))), 1, 13))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER ()
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
c AS (SELECT *, max(level) OVER () AS cut FROM l),
t AS (SELECT source, source_size, least(cap::DOUBLE, cut * weight) AS target FROM c),
p AS (SELECT d.*, source_size, target, floor(target)::BIGINT AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
   + greatest(0, least(size, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - before)))::BIGINT AS taken
FROM p
"""
