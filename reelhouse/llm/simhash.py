"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed.

A fingerprint has 64 bits; bit k is set if it is set in over half of the hashes of the text's shingles. Every bit position
gets one of the 2**(radius+1) - 1 vectors of radius + 1 bits that aren't zero, and every such vector v gives a table whose mask holds
the positions whose vector has an odd inner product with v. At most ``radius`` differing positions set ``radius`` linear conditions
on v, which leaves a v that isn't zero: in its table the two fingerprints share a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.common import ship, stored
from reelhouse.llm.near_dedup import components
from reelhouse.operators.skew import spread_join

BITS = 64
WORDS, SEED, RADIUS = 3, 42, 2
SHINGLES_AT_ONCE = 1 << 16
# A bucket of more fingerprints than this isn't compared pair by pair but by shared neighbours, which is exact too.
BUCKET_PAIRS = 128
# A key with a larger share of the rows than this is split in joins; there are fewer than 1 / share of them.
HOT_SHARE = 1e-3


def masks(radius: int, bits: int = BITS) -> list[int]:
    """The table masks that cover every set of ``radius`` positions: some mask holds none of them."""
    vectors = range(1, 1 << radius + 1)
    own = [1 + position % len(vectors) for position in range(bits)]
    return [sum(1 << position for position in range(bits) if (own[position] & v).bit_count() % 2) for v in vectors]


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of a UTF-8 text, A-Z lower-cased. Fewer words than a shingle's are one shingle; no words give zero."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found)) + 1
    end = np.cumsum(size)
    n = max(len(found) - words + 1, 1)
    first, last = (end - size)[:n].tolist(), (end - 1)[min(words, len(found)) - 1:].tolist()
    hashed, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        own = [hashed(joined[i:j], seed) for i, j in zip(first[at:at + SHINGLES_AT_ONCE], last[at:at + SHINGLES_AT_ONCE])]
        ones += np.unpackbits(np.array(own, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print), one row per row of ``docs``; the 64 bits are a signed long."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(own.as_py(), words, seed) for own in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(read, "doc_id long, print long")


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> BITS - 1 else mask).cast("long")


def _pairs(members: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) inside buckets of at most BUCKET_PAIRS fingerprints, each compared with those after it."""
    grouped = members.groupBy("table", "bucket").agg(F.sort_array(F.collect_list("print")).alias("prints"))
    near = F.transform("prints", lambda a, i: F.transform(
        F.filter(F.slice("prints", i + 2, F.size("prints")), lambda b: F.bit_count(a.bitwiseXOR(b)) <= radius), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    return grouped.select(F.explode(F.flatten(near)).alias("link")).select("link.a", "link.b")


def _through_neighbours(members: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join whatever is within the radius in buckets of any size, without comparing their pairs.

    Fingerprints are within an even radius if and only if some fingerprint is within half of it of both. Each names all of those,
    its bucket's fixed bits unchanged, and those that name the same one are within the radius of each other: the smallest of them stands
    for the others. A name is shared by a ball of fingerprints, whose size depends on the radius alone.
    """
    names = F.array(F.col("print"))
    free = F.filter(F.array(*[_signed(1 << k) for k in range(BITS)]), lambda bit: bit.bitwiseAND(F.col("mask")) == 0)
    for _ in range(radius // 2):
        names = F.array_distinct(F.flatten(F.transform(names, lambda p: F.concat(F.array(p), F.transform(free, lambda bit: p.bitwiseXOR(bit))))))
    named = members.select("table", "print", F.explode(names).alias("name"))
    balls = named.groupBy("table", "name").agg(F.min("print").alias("a"), F.collect_set("print").alias("all")).where(F.size("all") > 1)
    return balls.select("a", F.explode("all").alias("b")).where("a <> b").distinct()


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between different fingerprints of ``prints`` (print, unique) that connect exactly those within ``radius``.

    Buckets are counted first. Those of up to BUCKET_PAIRS fingerprints give every link in them; larger ones give links that connect
    the same fingerprints, through shared neighbours, so that no bucket is compared in full and none is skipped.
    """
    if radius % 2:
        raise ValueError("the radius is even, so that fingerprints near one neighbour are within it of each other")
    tables = F.array(*[F.struct(F.lit(i).alias("table"), _signed(m).alias("mask")) for i, m in enumerate(masks(radius))])
    rows = prints.select("print", F.explode(tables).alias("t")).select("t.*", "print", F.col("print").bitwiseAND(F.col("t.mask")).alias("bucket"))
    shared = stored(rows.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
    most = prints.count() * HOT_SHARE
    hot = shared.where(F.col("n") > F.greatest(F.lit(most), F.lit(BUCKET_PAIRS))).select("table", "bucket", F.ceil(F.col("n") / F.greatest(F.lit(most), F.lit(1.0))).cast("int").alias("pieces"))
    members = stored(spread_join(rows, shared, ["table", "bucket"], "print", hot), "simhash-members")
    return _pairs(members.where(F.col("n") <= BUCKET_PAIRS), radius).unionByName(_through_neighbours(members.where(F.col("n") > BUCKET_PAIRS), radius))


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, words: int = WORDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, print (signed long), fingerprint (16 hexadecimal digits), component_id.

    Fingerprints within ``radius`` differing bits are linked; component_id is the smallest doc_id whose fingerprint can be reached.
    Rows with equal fingerprints are one node whatever their number: they are counted where they are read, and only different
    fingerprints enter the tables. Rows meet their component by fingerprint, the rows of a frequent one dealt out.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked like any other. Rows that repeat a doc_id
    stay rows of their own: another row of the same doc_id doesn't link them. Rows without a doc_id get a component_id if some row they reach has a doc_id.
    An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    rows = stored(fingerprints(docs, words, seed, doc_id, text), "simhash-prints")
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-different")
    classes = components(links(prints.select("print"), radius))
    placed = prints.join(classes.withColumnRenamed("node", "print"), "print", "left").withColumn("class", F.coalesce("class", "print"))
    lowest = placed.groupBy("class").agg(F.min("first").alias("component_id"))
    found = stored(placed.join(lowest, "class").select("print", "component_id", "n"), "simhash-components")
    most = F.lit(max(rows.count() * HOT_SHARE, 1.0))
    hot = found.where(F.col("n") > most).select("print", F.ceil(F.col("n") / most).cast("int").alias("pieces"))
    joined = spread_join(rows, found.drop("n"), ["print"], "doc_id", hot)
    return joined.select("doc_id", "print", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
