"""Exact dedup by 128-bit content hash, the bytes compared inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.common import SPACES, stored, whole_text


def content_hash(text: Column) -> Column:
    """128 bits of the text as 16 bytes."""
    return F.unhex(F.md5(text))


def normalised(text: str = "text") -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(whole_text(text), SPACES, " ")


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are grouped by (hash, text): rows share a group only if their bytes are equal. Copies are
    summed where they are read, so a text shuffles once per input partition, however many copies
    it has. Rows then find their group by the hash alone; only where two different texts share a
    hash do rows carry their text into the join.

    Null and empty texts are equal. A null doc_id never becomes keep_id unless the whole group has
    none. Rows repeating a doc_id and text count once each and are all marked kept, being one row;
    ``kept_documents`` writes one of them. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("norm")).withColumn("h", hashed(F.col("norm")))
    groups = rows.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    by_hash = stored(groups.groupBy("h").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"),
    ), "exact-groups")
    light = rows.select("doc_id", "h", F.sha2(F.col("norm"), 256).alias("text_sha256"))
    found = light.join(by_hash.where("texts = 1"), "h")
    shared = by_hash.where("texts > 1").select("h")
    result = _decisions(found)
    if not shared.isEmpty():
        apart = rows.join(shared, "h", "left_semi").join(groups, ["h", "norm"])
        result = result.unionByName(_decisions(apart.withColumn("text_sha256", F.sha2(F.col("norm"), 256))))
    return result


def _decisions(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def kept_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """The rows that stay, with all columns of ``docs``: of each group of equal texts the one of the smallest doc_id.

    Null ids come last; rows that tie are told apart by a hash of all their columns, and rows equal
    in every column leave one. Copies are reduced where they are read.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    rows = docs.select(row.alias("row"), first.alias("first"), normalised(text).alias("norm"))
    groups = rows.groupBy(hashed(F.col("norm")).alias("h"), "norm").agg(F.min_by("row", "first").alias("row"))
    return groups.select("row.*")


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""
