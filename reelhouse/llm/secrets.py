"""Secret scan over a ledger of content-addressed blobs."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.llm.common import stored, whole_text


class Rule(NamedTuple):
    """A kind of secret: its pattern, and the least length of its matches or of ``group`` in them.

    A match that is too short is dropped but still uses up its characters.
    """

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0


# Patterns and lengths of the contract. The two plain kinds match whole runs of one
# class, so their least length can stand in the pattern; a shorter run can't hold a longer match.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),
)
SPANS_AT_ONCE = 256
SPANS = "array<struct<start:int,end:int>>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often its inner functions ask for it."""
    return F.transform(F.array(value), use)[0]


def spans_of(text: Column, rule: Rule) -> Column:
    """Code-point spans, end exclusive, of the rule's matches: leftmost, not overlapping.

    Splitting at the matches gives the text between them, so every start is a sum of lengths. Matches are added up in blocks of
    SPANS_AT_ONCE: an array that grows by one entry is copied each time, so one array for a text of very many matches would
    take the square of their number.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, rule.pattern, -1)
    nothing = F.array().cast(SPANS)

    def width(x: Column) -> Column:
        return F.length(x["between"]) + F.coalesce(F.length(x["match"]), F.lit(0))

    def add(acc: Column, x: Column) -> Column:
        end = acc["at"] + width(x)
        start = acc["at"] + F.length(x["between"])
        body = F.regexp_extract(x["match"], rule.pattern, rule.group) if rule.group else x["match"]
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        good = x["match"].isNotNull() & (F.length(body) >= rule.least)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

    def blocks(pairs: Column) -> Column:
        last = F.floor((F.size(pairs) - 1) / F.lit(SPANS_AT_ONCE)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(pairs, i * SPANS_AT_ONCE + 1, SPANS_AT_ONCE))

    def starts(own: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(own, begin, lambda acc, block: F.struct(
            (acc["at"] + F.aggregate(block, F.lit(0), lambda n, x: n + width(x))).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])

    def found(own: Column) -> Column:
        return _once(starts(own), lambda at: F.flatten(F.transform(own, lambda block, i: F.aggregate(
            block, F.struct(at[i].alias("at"), nothing.alias("found")), add, lambda acc: acc["found"]))))

    pairs = F.arrays_zip(between.alias("between"), matches.alias("match"))
    return F.when(F.size(matches) > 0, _once(pairs, lambda p: _once(blocks(p), found))).otherwise(nothing)


def blobs_of(paths: DataFrame, text: str = "text") -> DataFrame:
    """(blob, text), one row per different text; blob is the text's sha256. Copies meet where they are read."""
    return paths.select(whole_text(text).alias("text")).withColumn("blob", F.unhex(F.sha2("text", 256))) \
        .groupBy("blob").agg(F.first("text").alias("text"))


def scan_unseen(blobs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, kind, version, spans) of the pairs of blob and rule version that ``ledger`` lacks."""
    if ledger is None:
        pending = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "kind", "version")).alias("seen"))
        pending = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        pending = pending.where(F.size(F.array_except(F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules]), "seen")) > 0)
    found = [
        F.when(~F.array_contains("seen", f"{r.kind}@{r.version}"), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans_of(F.col("text"), r).alias("spans")))
        for r in rules
    ]
    return pending.select("blob", F.explode(F.array_compact(F.array(*found))).alias("f")).select("blob", "f.*")


def scan(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The whole ledger after scanning the texts of ``paths``: what it held, and the pairs it lacked, stored."""
    fresh = stored(scan_unseen(blobs_of(paths, text), ledger, rules), "secret-ledger")
    return fresh if ledger is None else ledger.unionByName(fresh)


def findings_by_path(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per path (doc_id) with its blob's findings under the current rule versions.

    n_<kind> counts each kind; spans lists kind:start:end by start, then in the order of the rules.
    Null text is empty text and has no finding; repeated rows each get theirs.
    """
    current = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.kind}@{r.version}"), F.lit(i))])
    rows = ledger.withColumn("rule", current[F.concat_ws("@", "kind", "version")]).where("rule IS NOT NULL AND size(spans) > 0")
    each = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rule").alias("rule"), s["end"].alias("end"), F.col("kind").alias("kind")))
    found = rows.select("blob", each.alias("each")).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("each"))).alias("found"))
    own = paths.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(whole_text(text), 256)).alias("blob"))
    joined = own.join(found, "blob", "left")
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [
        F.coalesce(F.size(kinds) - F.size(F.array_remove(kinds, r.kind)), F.lit(0)).cast("long").alias(f"n_{r.kind}")
        for r in rules
    ]
    spans = F.concat_ws(",", F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return joined.select("doc_id", *counts, F.coalesce(spans, F.lit("")).alias("spans"))


_CHECK_PART = r"""
  SELECT doc_id, '{kind}' AS kind, {n} AS rule, s.a AS a, s.b AS b FROM (
    SELECT doc_id, unnest([{{'a': coalesce(list_sum([length(x) for x in p[1:i]]), 0)::BIGINT + coalesce(list_sum([length(x) for x in m[1:i-1]]), 0)::BIGINT,
                   'b': coalesce(list_sum([length(x) for x in p[1:i]]), 0)::BIGINT + list_sum([length(x) for x in m[1:i]])::BIGINT,
                   'n': length(regexp_extract(m[i], '{pattern}', {group}))}} for i in range(1, len(m) + 1)]) AS s
    FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '{pattern}') AS p, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m FROM documents)
  ) WHERE s.n >= {least}
"""
ORACLE = "WITH f AS (" + " UNION ALL ".join(
    _CHECK_PART.format(kind=r.kind, n=i, pattern=r.pattern.replace("'", "''"), group=r.group, least=r.least) for i, r in enumerate(RULES)
) + """), g AS (
  SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rule) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN g USING (doc_id)
"""
