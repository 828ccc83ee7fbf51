"""Line dedup: winnowing over line hashes, exact passages, later runs deleted.

A text is its lines (split at \\n); lines without words are carried along but not
compared. From every line a window runs to the first line at which it has ``min_words``
words. The window's least line hash is its fingerprint (winnowing with windows measured
in words): two copies of a run with at least ``min_words`` words hold at least one
whole window in common, hence the same fingerprint, so none is missed.

1. winnow: fingerprints that occur at one position of the corpus only are set aside;
2. join positions: windows of the others meet by fingerprint and hash of the window's
   lines; the earliest position (doc_id, then text hash, then line) owns the passage;
3. extend: windows that overlap or touch grow together into runs. What follows a run's last
   window (fewer than ``min_words`` words) is reached the other way: mirror windows, from a
   line back to the first line at which there are ``min_words`` words, are compared where
   they begin at a line that begins a shared window (a repeated mirror window always does).
   Both kinds together cover every line of every repeated run of ``min_words`` words or more.
   Without ``both_ways`` only forward windows are compared;
4. delete: the lines of every run that occurred earlier, in the same text or another.

Rows equal in doc_id and text are one document and get the same result. Nulls: a null
doc_id comes last in order, a null text stays null. Shorter repetitions stay.

Scale: fingerprints are narrow rows (written once to the shared folder, read three
times); earliest positions are a partially aggregated minimum, so a passage that a third
of all documents share meets as one row per task; where positions are joined to what is
shared, a fingerprint or passage with very many positions is split over tasks
(``operators/skew.py``). Mirror windows are shuffled once, by document; few are left after
that. Texts are shuffled once, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import WORD, let, pinned, unused
from laminar.operators.skew import split_hot_key_join

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(text: Column, min_words: int, both_ways: bool = False) -> Column:
    """array<struct<start, stop, anchor, content, words, mirror>>: a row per window of a text,
    with ``both_ways`` also per mirror window that is no window itself. (Whether lines are a
    window, a mirror window or both shows in the lines alone: a mirror window that is none
    never equals a window.)"""
    lines = F.filter(
        F.transform(
            _lines(text),
            lambda x, i: F.struct(
                i.alias("line"),
                F.xxhash64(x).alias("hash"),
                F.regexp_count(x, F.lit(WORD)).alias("words"),
            ),
        ),
        lambda x: x["words"] > 0,
    )

    def step(a, x):
        more = a["words"] < min_words
        keep = lambda new, old: F.when(more, new).otherwise(old)
        return F.struct(
            (a["words"] + F.when(more, x["words"]).otherwise(F.lit(0))).alias("words"),
            keep(x["line"], a["stop"]).alias("stop"),
            keep(F.least(a["anchor"], x["hash"]), a["anchor"]).alias("anchor"),
            keep(F.xxhash64(a["content"], x["hash"]), a["content"]).alias("content"),
        )

    def window(all_lines, start):
        # every line here has a word, so min_words lines are enough
        return F.aggregate(
            F.slice(all_lines, start + 1, F.lit(min_words)),
            F.struct(
                F.lit(0).alias("words"),
                F.lit(0).alias("stop"),
                F.lit(2**63 - 1).cast("long").alias("anchor"),
                F.lit(0).cast("long").alias("content"),
            ),
            step,
            lambda a: F.struct(
                F.get(all_lines, start)["line"].alias("start"),
                a["stop"].alias("stop"),
                a["anchor"].alias("anchor"),
                a["content"].alias("content"),
                a["words"].alias("words"),
                F.lit(False).alias("mirror"),
            ),
        )

    def mirror(all_lines, start):
        # with enough words before its last line it is no window itself
        own = F.get(all_lines, start)["words"]
        return let(
            window(all_lines, start),
            lambda w: F.struct(
                w["stop"].alias("start"),
                w["start"].alias("stop"),
                w["anchor"].alias("anchor"),
                w["content"].alias("content"),
                F.when(w["words"] - own >= min_words, w["words"]).otherwise(F.lit(0)).alias("words"),
                F.lit(True).alias("mirror"),
            ),
        )

    def both(ls):
        ahead = F.transform(ls, lambda _, i: window(ls, i))
        if not both_ways:
            return ahead
        back = let(F.reverse(ls), lambda rs: F.transform(rs, lambda _, i: mirror(rs, i)))
        return F.concat(ahead, back)

    return F.filter(let(lines, both), lambda w: w["words"] >= min_words)


def _shared(rows: DataFrame, by: list[str], place: Column) -> DataFrame:
    """(by, first, places): what stands at two places or more, with the earliest of them."""
    found = rows.groupBy(*by).agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("places")
    )
    return found.where(F.col("first") != F.col("last")).drop("last")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, both_ways: bool = True) -> DataFrame:
    """(id_null, id, text_hash, runs array<struct<start, stop>>): the line ranges to delete
    of each document that has any."""
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    key = ["id_null", "id", "text_hash"]
    every = pinned(
        docs.where(F.col("text").isNotNull())
        .select(*_key(F.col("doc_id"), F.col("text")), F.explode(_windows(F.col("text"), min_words, both_ways)).alias("w"))
        .select(*key, "w.start", "w.stop", "w.anchor", "w.content", "w.mirror")
    )
    windows = every.where(~F.col("mirror")).drop("mirror")
    # winnow: a fingerprint at two positions shows as two different windows' places
    place = F.struct(*key, "start")
    spread = F.xxhash64(*key, "start")
    anchors = _shared(windows, ["anchor"], place).drop("first")
    shared = split_hot_key_join(windows, anchors, "anchor", "places", spread).drop("places")
    owners = _shared(shared, ["content", "anchor"], place).withColumnRenamed("anchor", "own_anchor")
    met = split_hot_key_join(shared, owners, "content", "places", spread)
    met = met.where(F.col("anchor") == F.col("own_anchor")).select(*key, "start", "stop", "first")
    later = met.where(place != F.col("first")).select(*key, "start", "stop")
    if both_ways:
        met = pinned(met)
        later = met.where(place != F.col("first")).select(*key, "start", "stop")
        begins = met.select(*key, "start").distinct()
        mirrors = every.where("mirror").drop("anchor", "mirror").join(begins, [*key, "start"], "left_semi")
        mirrors = pinned(mirrors)
        owners = _shared(mirrors, ["content"], place)
        back = split_hot_key_join(mirrors, owners, "content", "places", spread)
        later = later.unionByName(back.where(place != F.col("first")).select(*key, "start", "stop"))
    later = later.distinct()
    by_doc = Window.partitionBy(*key).orderBy("start", "stop")
    so_far = by_doc.rowsBetween(Window.unboundedPreceding, -1)
    islands = later.withColumn(
        "new", F.coalesce((F.col("start") > F.max("stop").over(so_far) + 1).cast("int"), F.lit(1))
    ).withColumn("run", F.sum("new").over(by_doc))
    return (
        islands.groupBy(*key, "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .groupBy(*key)
        .agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    )


def _key(doc_id: Column, text: Column) -> list[Column]:
    return [
        doc_id.isNull().alias("id_null"),
        F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("text_hash"),
    ]


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, both_ways: bool = True) -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text`` (n_chars, where there is one,
    follows) and the deleted ranges in ``removed_runs`` (null: none)."""
    if "removed_runs" in docs.columns:
        raise ValueError("rename the column removed_runs first")
    runs = repeated_runs(docs, min_words, both_ways)
    names = unused(docs, "id_null", "id", "text_hash")
    keyed = docs.select(
        *docs.columns,
        *[c.alias(n) for c, n in zip(_key(docs["doc_id"], docs["text"]), names, strict=True)],
    )
    runs = runs.select(
        *[F.col(c).alias(f"{n}_r") for c, n in zip(["id_null", "id", "text_hash"], names, strict=True)],
        F.col("runs").alias("removed_runs"),
    )
    match = [keyed[n] == runs[f"{n}_r"] for n in names]
    joined = keyed.join(runs, match[0] & match[1] & match[2], "left")
    # the lines between the runs, which are apart and in order
    kept = let(
        F.struct(_lines(F.col("text")).alias("lines"), F.array_sort("removed_runs").alias("runs")),
        lambda x: F.array_join(
            F.flatten(
                F.zip_with(
                    F.concat(F.array(F.lit(-1)), F.transform(x["runs"], lambda r: r["stop"])),
                    F.concat(F.transform(x["runs"], lambda r: r["start"]), F.array(F.size(x["lines"]))),
                    lambda before, after: F.slice(x["lines"], before + 2, after - before - 1),
                )
            ),
            "\n",
        ),
    )
    text = F.when(F.col("removed_runs").isNull(), F.col("text")).otherwise(kept)
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn(
            "n_chars", F.when(F.col("removed_runs").isNull(), F.col("n_chars")).otherwise(size)
        )
    return out.select(*docs.columns, "removed_runs")


def lines_in(text: Column) -> Column:
    return F.coalesce(F.size(_lines(text)), F.lit(0)).cast("long")


def removed_lines(runs: Column) -> Column:
    total = F.aggregate(runs, F.lit(0), lambda a, r: a + r["stop"] - r["start"] + 1)
    return F.coalesce(total, F.lit(0)).cast("long")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, text, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM d),
n AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM u),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
             sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS cum
      FROM n WHERE words > 0),
e AS (SELECT a.doc_id, a.k, a.i AS start, min(b.k) AS stop_k
      FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 49
                       AND b.cum - a.cum + a.words >= 50
      GROUP BY a.doc_id, a.k, a.i),
m AS (SELECT b.doc_id, max(a.k) AS k, b.k AS stop_k
      FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.k BETWEEN b.k - 49 AND b.k
                       AND b.cum - a.cum + a.words >= 50
      GROUP BY b.doc_id, b.k),
v AS (SELECT doc_id, k, stop_k FROM e UNION SELECT doc_id, k, stop_k FROM m),
w AS (SELECT v.doc_id, min(l.i) AS start, max(l.i) AS stop, string_agg(l.line, chr(10) ORDER BY l.k) AS content
      FROM v JOIN l ON v.doc_id = l.doc_id AND l.k BETWEEN v.k AND v.stop_k
      GROUP BY v.doc_id, v.k, v.stop_k),
r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, start) AS nth FROM w),
x AS (SELECT DISTINCT u.doc_id, u.i FROM u JOIN r ON u.doc_id = r.doc_id AND r.nth > 1
                                              AND u.i BETWEEN r.start AND r.stop),
k AS (SELECT u.doc_id, count(*) AS n_lines, count(x.i) AS removed_lines,
             string_agg(u.line, chr(10) ORDER BY u.i) FILTER (WHERE x.i IS NULL) AS kept
      FROM u LEFT JOIN x ON u.doc_id = x.doc_id AND u.i = x.i GROUP BY u.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text,
       CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(k.removed_lines, 0) AS BIGINT) AS removed_lines
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
