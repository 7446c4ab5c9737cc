"""SimHash fingerprints with DataFrame functions only (operator 6).

Terms are a text's word 5-shingles (fewer words: the whole sequence), of weight 2 for
every time they occur, and its words, of weight 1 for every time. Two 64-bit hashes of a term
vote on 128 signed bits; a bit is set where more than half of the weight sets
it. Eight 8-bit vote counters share one long, so a term costs 16 masked
additions inside generated code; counters are unpacked for every 63 terms,
before they can overflow. The fingerprint is a string of 32 hex digits.

The radius search cuts the bits into RADIUS + SPARE blocks. For every choice of
SPARE blocks a permuted table keyed by those blocks brings together the
fingerprints that agree on them; by pigeonhole every pair within the radius
meets in a table, and the exact distance is checked. Equal fingerprints are one
row of the tables, whatever the number of their documents. The report searches
all fingerprints for those of the documents whose doc_id is divisible by ASKED;
`within_radius` gives all pairs of a table of fingerprints.

Defined cases: a null text is empty; a text without words has the one term of
the empty sequence; equal texts have equal fingerprints; null ids come before
all others; different texts under one doc_id are documents of their own, in
order of a hash of the text; rows equal in doc_id and text count once in the
order and each get the same result, each other document of the rest; a null id is
not searched for and is a null near_id; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelstats.llm.tables import NULL_ID, written
from reelstats.operators.joins import salted_join

SHINGLE = 5
BITS = 128
_LANES = 0x0101010101010101
RADIUS = 8  # bits that two fingerprints of the search may differ in
SPARE = 2  # blocks that a key of the search has
ASKED = 50  # the report searches for ids divisible by it
_BLOCK = 63  # terms of weight 2 that an 8-bit counter takes without its sign bit
_SPLIT = r"[\x20\x09-\x0D]+"
_TRIM = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _terms(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """key, _pos, _term: one row for every occurrence of a term, so that frequent terms weigh more; the lowest bit of a term tells a shingle from a word."""
    words = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _TRIM, ""), _SPLIT)
    # hashes first: arrays of longs, not of strings, are sliced and exploded
    hashed = texts.select(*key, F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    rest = [lambda i, k=k: F.get("_w", i + k) for k in range(1, SHINGLE)]
    starts = F.slice("_w", 1, F.greatest(F.size("_w") - (SHINGLE - 1), F.lit(0)))
    shingles = F.when(
        F.size("_w") >= SHINGLE, F.transform(starts, lambda w, i: F.xxhash64(w, *[r(i) for r in rest]).bitwiseOR(F.lit(1)))
    ).otherwise(F.array(F.xxhash64("_w").bitwiseOR(F.lit(1))))
    single = F.transform("_w", lambda w: w.bitwiseAND(F.lit(-2)))
    return hashed.select(*key, F.posexplode(F.concat(shingles, single)).alias("_pos", "_term"))


def fingerprints(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key columns and `fp_hi`, `fp_lo` (64 bits each) of every row; key must identify a row."""
    hashed = _terms(texts, key, text).select(
        *key, F.expr(f"_pos div {_BLOCK}").alias("_block"), (F.col("_term").bitwiseAND(F.lit(1)) + 1).alias("_weight"),
        F.xxhash64("_term").alias("_h0"), F.xxhash64("_term", F.lit(29)).alias("_h1"),
    )
    lanes = F.lit(_LANES).cast("long")
    sums = [
        F.sum(F.shiftrightunsigned(f"_h{h}", i).bitwiseAND(lanes) * F.col("_weight")).alias(f"_s{h}_{i}")
        for h in (0, 1) for i in range(8)
    ]
    packed = hashed.groupBy(*key, "_block").agg(F.sum("_weight").alias("_n"), *sums)
    unpacked = [
        F.sum(F.shiftrightunsigned(f"_s{h}_{i}", 8 * k).bitwiseAND(F.lit(255))).alias(f"_c{h}_{i + 8 * k}")
        for h in (0, 1) for k in range(8) for i in range(8)
    ]
    votes = packed.groupBy(*key).agg(F.sum("_n").alias("_total"), *unpacked)

    def joined(h: int) -> Column:
        out = F.lit(0).cast("long")
        for b in range(64):
            bit = F.when(F.col(f"_c{h}_{b}") * 2 > F.col("_total"), F.lit(1)).otherwise(F.lit(0)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b))
        return out

    return votes.select(*key, joined(0).alias("fp_hi"), joined(1).alias("fp_lo"))


def as_text(hi: str, lo: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(F.col(hi)), 16, "0"), F.lpad(F.hex(F.col(lo)), 16, "0")))


def distance(a_hi, a_lo, b_hi, b_lo) -> Column:
    return F.bit_count(F.col(a_hi).bitwiseXOR(F.col(b_hi))) + F.bit_count(F.col(a_lo).bitwiseXOR(F.col(b_lo)))


def _range_of(edges: list[int]) -> Column:
    """How many of the ascending edges are not above _id, looked up in runs of about the root of their number."""
    if not edges:
        return F.lit(0).cast("long")
    run = math.isqrt(len(edges) - 1) + 1
    runs = [edges[i : i + run] for i in range(0, len(edges), run)]

    def longs(values: list[int]) -> str:
        # the smallest long has no literal of its own
        return "array(" + ",".join(f"cast('{v}' as bigint)" for v in values) + ")"

    at = f"size(filter({longs([r[0] for r in runs])}, e -> e <= _id))"
    inside = f"size(filter(element_at(array({','.join(map(longs, runs))}), {at}), e -> e <= _id))"
    return F.expr(f"cast(case when _id < cast('{edges[0]}' as bigint) then 0 else ({at} - 1) * {run} + {inside} end as long)")


def _ordered(slim: DataFrame, ids_per_bucket: int) -> DataFrame:
    """_id, _th and the next row's _n_id, _n_th, in ascending (_id, _th) order (after the last: the first).

    Ids fall into ranges of about ids_per_bucket rows each, cut at quantiles of
    the ids; a window runs inside each, and the first row of every range (a small
    table) links one range to the next.
    """
    known = F.col("_id") != NULL_ID
    buckets = max(1, -(-slim.count() // ids_per_bucket))
    edges = []
    if buckets > 1:
        ranks = [i / buckets for i in range(1, buckets)]
        edges = sorted(set(slim.where(known).agg(F.percentile_approx("_id", ranks, max(10_000, 10 * buckets))).first()[0] or []))
    slim = slim.withColumn("_b", F.when(~known, F.lit(-1).cast("long")).otherwise(_range_of(edges)))
    inside = W.partitionBy("_b").orderBy("_id", "_th")
    rows = slim.withColumn("_n", F.lead(F.struct("_id", "_th")).over(inside))
    over_buckets = W.orderBy("_b")
    first = slim.groupBy("_b").agg(F.min(F.struct("_id", "_th")).alias("_f"))
    first = first.withColumn("_after", F.coalesce(F.lead("_f").over(over_buckets), F.first("_f").over(over_buckets.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    linked = rows.join(first.select("_b", "_after"), "_b").withColumn("_n", F.coalesce("_n", "_after"))
    return linked.select("_id", "_th", F.col("_n._id").alias("_n_id"), F.col("_n._th").alias("_n_th"))


def edited_texts(docs: DataFrame, ids_per_bucket: int = 50_000) -> DataFrame:
    """_id, _th, doc_id, n_chars, _rows (equal rows), _n_id, _n_th (next document), text, edited.

    The texts are shuffled once, by row key; from there each sends the previous
    document as many leading code points as that one replaces.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.select(F.coalesce("_id", F.lit(NULL_ID)).alias("_id"), F.xxhash64("text").alias("_th"), F.length("text").cast("long").alias("n_chars"), "text")
    slim = base.groupBy("_id", "_th").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("_rows"))
    order = _ordered(slim.select("_id", "_th"), ids_per_bucket).join(slim, ["_id", "_th"])
    asked = order.select(
        F.col("_n_id").alias("_id"), F.col("_n_th").alias("_th"),
        F.struct(F.col("_id").alias("id"), F.col("_th").alias("th"), F.floor(F.col("n_chars") / 4).cast("int").alias("take")).alias("_asker"),
    )
    plan = order.join(asked, ["_id", "_th"])
    texts = base.groupBy("_id", "_th").agg(F.first("text").alias("text")).join(plan, ["_id", "_th"])
    head = texts.select(F.col("_asker.id").alias("_id"), F.col("_asker.th").alias("_th"), F.expr("substring(text, 1, _asker.take)").alias("_head"))
    kept = F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 4) as int))")
    return texts.join(head, ["_id", "_th"]).select(
        "_id", "_th", F.when(F.col("_id") != NULL_ID, F.col("_id")).alias("doc_id"), "n_chars", "_rows", "_n_id", "_n_th",
        "text", F.concat(kept, "_head").alias("edited"),
    )


def fingerprint_report(docs: DataFrame, radius: int = RADIUS, spare: int = SPARE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near, near_id.

    n_near: other documents whose fingerprint is within the radius; near_id: the
    smallest doc_id of the nearest different fingerprint within it. Both for
    doc_ids divisible by ASKED, against all documents; null for the others.
    """
    pairs = edited_texts(docs)
    both = pairs.select("_id", "_th", F.posexplode(F.array("text", "edited")).alias("_kind", "_text"))
    fp = fingerprints(both, ["_id", "_th", "_kind"], "_text")
    own, edited = (F.max(F.when(F.col("_kind") == k, F.struct("fp_hi", "fp_lo"))) for k in (0, 1))
    fp = fp.groupBy("_id", "_th").agg(own.alias("_own"), edited.alias("_ed"))
    about = pairs.select("_id", "_th", "doc_id", "n_chars", "_rows", "_n_id", "_n_th", F.sha2("edited", 256).alias("edited_sha256"))
    rows = written(about.join(fp, ["_id", "_th"]), "fingerprints")
    following = rows.select(F.col("_id").alias("_n_id"), F.col("_th").alias("_n_th"), F.col("_own").alias("_next"))
    asked = F.coalesce(F.col("doc_id") % ASKED == 0, F.lit(False))
    found = neighbours(rows.select(F.col("_id").alias("id"), "_own.fp_hi", "_own.fp_lo", F.col("_rows").alias("copies"), asked.alias("asked")), radius, spare)
    found = found.select(as_text("fp_hi", "fp_lo").alias("fingerprint"), "docs", (F.col("n") - 1).alias("n_near"), F.when(F.col("near_id") != NULL_ID, F.col("near_id")).alias("near_id"))
    rows = rows.withColumn("fingerprint", as_text("_own.fp_hi", "_own.fp_lo"))
    # many of the documents searched for may have one fingerprint
    searched = salted_join(rows.where(asked), written(found, "near"), "fingerprint", count_col="docs").drop("docs")
    rows = rows.where(~asked).unionByName(searched, allowMissingColumns=True)

    def like(other: str) -> Column:
        return 1.0 - distance("_own.fp_hi", "_own.fp_lo", f"{other}.fp_hi", f"{other}.fp_lo") / float(BITS)

    out = rows.join(following, ["_n_id", "_n_th"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", as_text("_ed.fp_hi", "_ed.fp_lo").alias("edited_fingerprint"),
        like("_ed").alias("near_edited"), like("_next").alias("near_next"), "n_near", "near_id", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")).alias("_copy"),
    )
    return out.drop("_copy")


def _bits(hi: str, lo: str, start: int, end: int) -> Column:
    """Bits start to end (from the highest of hi on) of the 128, as a number."""
    def half(column: str, a: int, b: int) -> Column:
        return F.shiftrightunsigned(F.col(column), 64 - b).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))

    if end <= 64:
        return half(hi, start, end)
    if start >= 64:
        return half(lo, start - 64, end - 64)
    return F.shiftleft(half(hi, start, 64), end - 64).bitwiseOR(half(lo, 0, end - 64))


def _edges(blocks: int) -> list[int]:
    return [round(i * BITS / blocks) for i in range(blocks + 1)]


def block_tables(prints: DataFrame, radius: int, spare: int) -> DataFrame:
    """prints (fp_hi, fp_lo and others) once for every permuted table, with `_key`: the table's number, then its blocks."""
    n = radius + spare
    edge = _edges(n)
    width = max(b - a for a, b in zip(edge, edge[1:]))
    if spare * width + math.comb(n, spare).bit_length() > 63:
        raise ValueError("the blocks of a table don't fit in a key: raise radius or lower spare")
    cut = prints.select("*", F.array(*[_bits("fp_hi", "fp_lo", a, b) for a, b in zip(edge, edge[1:])]).alias("_blocks"))
    keys = []
    for no, chosen in enumerate(combinations(range(n), spare)):
        key = F.lit(no << (spare * width)).cast("long")
        for place, i in enumerate(chosen):
            key = key.bitwiseOR(F.shiftleft(F.get("_blocks", F.lit(i)), place * width))
        keys.append(key)
    return cut.select(*prints.columns, F.explode(F.array(*keys)).alias("_key"))


def meetings(asked: DataFrame, prints: DataFrame, radius: int, spare: int) -> DataFrame:
    """Every pair of a fingerprint a of `asked` and a fingerprint b of `prints` within the radius, once: a_hi, a_lo, prints' columns as b_..., distance.

    Both sides have distinct fingerprints; asked is fp_hi, fp_lo. With
    radius + spare blocks, a pair within the radius agrees on at least `spare`
    of them and so meets in a table; the table of its first agreeing blocks
    reports it. Fingerprints of `prints` that no key of `asked` names go no further.
    """
    n = radius + spare
    edge = _edges(n)
    width = max(b - a for a, b in zip(edge, edge[1:]))
    left = written(block_tables(asked.select("fp_hi", "fp_lo"), radius, spare).select("_key", F.col("fp_hi").alias("a_hi"), F.col("fp_lo").alias("a_lo")), "asked-keys")
    right = block_tables(prints, radius, spare)
    right = right.select("_key", *[F.col(c).alias("b_" + c.removeprefix("fp_")) for c in prints.columns])
    met = right.join(left, "_key").withColumn("distance", distance("a_hi", "a_lo", "b_hi", "b_lo")).where(F.col("distance") <= radius)
    both = met.withColumn("_x_hi", F.col("a_hi").bitwiseXOR(F.col("b_hi"))).withColumn("_x_lo", F.col("a_lo").bitwiseXOR(F.col("b_lo")))
    agree = F.array(*[_bits("_x_hi", "_x_lo", a, b) == 0 for a, b in zip(edge, edge[1:])])
    first = F.slice(F.filter(F.transform(agree, lambda same, i: F.when(same, i)), lambda i: i.isNotNull()), 1, spare)
    numbers = F.create_map(*[x for no, chosen in enumerate(combinations(range(n), spare)) for x in (F.lit(",".join(map(str, chosen))), F.lit(no))])
    reported = F.shiftrightunsigned("_key", spare * width) == F.element_at(numbers, F.array_join(first.cast("array<string>"), ","))
    return both.where(reported).drop("_key", "_x_hi", "_x_lo")


def within_radius(prints: DataFrame, radius: int = RADIUS, spare: int = SPARE) -> DataFrame:
    """All pairs (a_hi, a_lo) < (b_hi, b_lo) of distinct fingerprints within the radius, and their distance; prints: fp_hi, fp_lo."""
    distinct = prints.select("fp_hi", "fp_lo").distinct()
    pairs = meetings(distinct, distinct, radius, spare).where("a_hi < b_hi or (a_hi = b_hi and a_lo < b_lo)")
    return pairs.select("a_hi", "a_lo", "b_hi", "b_lo", "distance")


def neighbours(rows: DataFrame, radius: int = RADIUS, spare: int = SPARE) -> DataFrame:
    """fp_hi, fp_lo, docs, n, near_id of every fingerprint that a row with `asked` has.

    rows: id, fp_hi, fp_lo, copies (documents the row stands for), asked. docs:
    documents with this fingerprint; n: documents with one within the radius,
    these included; near_id: the smallest id of the nearest other fingerprint
    within the radius (ties: the smallest id of all), null if there is none.
    """
    classes = rows.groupBy("fp_hi", "fp_lo").agg(F.min("id").alias("least"), F.sum("copies").alias("docs"), F.max("asked").alias("asked"))
    classes = written(classes, "fingerprint-classes")
    found = meetings(classes.where("asked"), classes.drop("asked"), radius, spare)
    other = (F.col("a_hi") != F.col("b_hi")) | (F.col("a_lo") != F.col("b_lo"))
    return found.groupBy(F.col("a_hi").alias("fp_hi"), F.col("a_lo").alias("fp_lo")).agg(
        F.max(F.when(~other, F.col("b_docs"))).alias("docs"), F.sum("b_docs").alias("n"),
        F.min(F.when(other, F.struct("distance", "b_least")))["b_least"].alias("near_id"),
    )
