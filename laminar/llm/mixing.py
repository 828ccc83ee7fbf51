"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size in words. The words of the mix (``total_share`` of
all words) go to the sources by weight; a source stops at ``max_epochs`` times its size
and what it leaves is shared again by weight until no source is above. The level of the
water has a closed form: with sources sorted by cap / weight, the level at a source is
(total - caps before it) / (weights from it on), and the greatest of these levels holds.

A source's documents are repeated floor(target / size) times whole. The fraction that is
left goes to documents in the order of a seeded hash, whole, until the words are used
up; the document at the boundary gives the last words only. So a source misses its
target by less than one word (a group of m repeated rows at the boundary: m words), and
reruns agree, however the rows are partitioned.

Scale: two reads of the documents, no shuffle of texts. Sums per source and per hash
bucket are aggregated before the shuffle; only the documents of each source's boundary
bucket are ordered. The table of boundaries has one row per source and is broadcast while
it has at most ``MAX_BROADCAST_SOURCES`` rows; beyond that Spark joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import WORD, pinned, unused

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# One row per source, under 200 bytes: 20 MB at most.
MAX_BROADCAST_SOURCES = 100_000
# 4,096 hash buckets a source: a boundary bucket holds a 4,096th of a source's documents.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words (long); null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def order_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Seeded place of a document: md5 over seed, id and the text's md5."""
    return F.md5(
        F.concat(
            F.lit(f"{seed}|"),
            F.coalesce(doc_id.cast("string"), F.lit("~")),
            F.lit("|"),
            F.md5(F.coalesce(text, F.lit("~")).cast("binary")),
        ).cast("binary")
    )


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, total_share: float = 1.0
) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    ``weights`` repeat along the sources in code point order, null last. The windows run
    over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.array(*[F.lit(float(x)) for x in weights])
    cap = F.col("source_size") * F.lit(float(max_epochs))
    return (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(w, F.col("place") % len(weights)))
        .withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(total_share)))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
            ),
        )
        .withColumn(
            "rest", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
        )
        .withColumn("level", F.max((F.col("total") - F.col("before")) / F.col("rest")).over(everything))
        .select(
            "source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target")
        )
    )


def boundaries(docs: DataFrame, seed: str, weights=WEIGHTS, max_epochs=MAX_EPOCHS) -> DataFrame:
    """Per source: source_size, target, whole repetitions, and where its fraction ends:
    documents with an order key below ``edge`` are taken once more, those at it give
    ``edge_words`` each."""
    narrow = docs.select(
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        order_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = pinned(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs
    ).withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
    )
    targets = targets.withColumn(
        "fraction", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    )
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    edge_bucket = (
        filled.join(targets, same(filled, targets))
        .where(
            (F.col("before") < F.col("fraction"))
            & (F.col("before") + F.col("words") >= F.col("fraction"))
        )
        .select(filled["source"], "bucket", (F.col("fraction") - F.col("before")).alias("left"))
    )
    inside = narrow.join(
        F.broadcast(edge_bucket) if _few(targets) else edge_bucket,
        same(narrow, edge_bucket) & (narrow["bucket"] == edge_bucket["bucket"]),
    ).select(narrow["source"], "key", "size", "left")
    inside = inside.groupBy("source", "key").agg(
        F.sum("size").alias("words"), F.count("*").alias("rows"), F.first("left").alias("left")
    )
    run = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        inside.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
        .where((F.col("before") < F.col("left")) & (F.col("before") + F.col("words") >= F.col("left")))
        .select(
            F.col("source").alias("edge_source"),
            F.col("key").alias("edge"),
            F.floor((F.col("left") - F.col("before")) / F.col("rows")).alias("edge_words"),
        )
    )
    return targets.join(edge, targets["source"].eqNullSafe(edge["edge_source"]), "left").drop(
        "edge_source", "fraction"
    )


def _few(targets: DataFrame) -> bool:
    return targets.count() <= MAX_BROADCAST_SOURCES


def mix(
    docs: DataFrame, seed: str = "mix", weights=WEIGHTS, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """``docs`` (doc_id, text, source, anything else) with, in a struct column ``mix``,
    size, source_size, target and ``taken``: the words the mix takes of the document,
    repeats counted.

    Null text: size 0, nothing taken. Null source: a source of its own, last in order.
    Repeated rows are alike in every figure. An empty table gives an empty result.
    """
    b = pinned(boundaries(docs, seed, weights, max_epochs))
    b = b.select(F.struct("*").alias("_b"))
    if _few(b):
        b = F.broadcast(b)
    place, size, key = unused(docs, "b", "size", "key")
    b = b.withColumnRenamed("_b", place)
    frame = docs.withColumn(size, word_count(docs["text"])).withColumn(
        key, order_key(docs["doc_id"], docs["text"], seed)
    )
    joined = frame.join(
        b, frame["source"].cast("string").eqNullSafe(F.col(f"{place}.source")), "left"
    )
    extra = (
        F.when(F.col(key) < F.col(f"{place}.edge"), F.col(size))
        .when(
            F.col(key) == F.col(f"{place}.edge"),
            F.least(F.col(size), F.col(f"{place}.edge_words")),
        )
        .otherwise(F.lit(0))
    )
    return joined.select(
        *[frame[c] for c in docs.columns],
        F.struct(
            F.col(size).alias("size"),
            F.col(f"{place}.source_size").alias("source_size"),
            F.col(f"{place}.target").alias("target"),
            (F.col(f"{place}.whole") * F.col(size) + extra).cast("long").alias("taken"),
        ).alias("mix"),
    )


def repeated(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, max_epochs=MAX_EPOCHS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as it is taken
    whole, and the boundary documents' last piece as their first words joined by one
    space (n_chars, where there is one, follows). Documents without words are not taken."""
    had = "mix" in docs.columns
    if had:
        raise ValueError("rename the column mix first")
    mixed = mix(docs, seed, weights, max_epochs)
    (copy,) = unused(mixed, "copy")
    size, taken = F.col("mix.size"), F.col("mix.taken")
    whole = F.floor(taken / size)
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), (taken % size).cast("int")), " ")
    out = mixed.where((size > 0) & (taken > 0)).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.ceil(taken / size)))
    )
    text = F.when(F.col(copy) > whole, part).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || md5(coalesce(text, '~'))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             source_size * 3.0::DOUBLE AS cap FROM p),
f AS (SELECT *, sum(source_size) OVER () * 1.0::DOUBLE AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS before,
             sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
      FROM w),
t AS (SELECT source, source_size, least(cap, weight * max((total - before) / rest) OVER ()) AS target FROM f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
q AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS fraction FROM r),
c AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.fraction,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, fraction - before)) AS BIGINT) AS taken
FROM c
"""
