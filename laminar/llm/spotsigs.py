"""SpotSigs document fingerprints.

A spot is a content word that directly follows a common word (the anchor). Its signature
is the anchor with the next ``CHAIN`` content words, common words between them skipped;
a text's fingerprint is its set of signatures, so menus and lists without running text
hardly count. Where ``GAP`` content words and more go by without an anchor (lists, tables),
each further content word is a spot with an empty anchor, so that such texts, too, have
signatures all along. Texts are alike as the Jaccard measure of their sets.

``near_pairs`` finds all pairs at or above a threshold: sets are partitioned by length so
that similar ones lie in the same or the next partition, meet by their rarest signatures
only (a set whose rarest signatures all miss can't reach the threshold), and a pair is
measured only if its lengths allow the threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import let, pinned

# Common words of running text in four languages; anchors of the spots.
COMMON_WORDS = (
    "a an and are as at be been but by for from had has have he in is it its of on or she that "
    "the their there they this to was were which who will with you "
    "au aux avec ce dans de des du elle en est et il la le les mais ne nous ou par pas plus pour "
    "que qui se sont sur un une vous "
    "als am auf aus bei das dem den der die ein eine einen er es für hat ich im ist man mit nicht "
    "noch oder sich sie sind und von war werden wie zu "
    "al como con del el ella esta este las lo los más no para pero por si sin su sus una uno y ya"
).split()
CHAIN = 2
GAP = 4
THRESHOLD = 0.8


def signatures(text: Column, chain: int = CHAIN, gap: int = GAP) -> Column:
    """Sorted distinct signatures (64-bit hashes) of a text; null counts as empty.

    A text without any spot has one signature, the hash of the whole text: equal texts are
    alike, others are not. The set is never empty.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    common = list(dict.fromkeys(COMMON_WORDS))

    def content(ws):
        # content words, each with the common word directly before it ('' if none)
        def one(w, i):
            before = F.get(ws, i - 1)
            anchor = F.when(before.isin(*common), before).otherwise(F.lit(""))
            return F.when(~w.isin(*common), F.struct(anchor.alias("anchor"), w.alias("word")))

        return F.filter(F.transform(ws, one), lambda x: x.isNotNull())

    def chains(cs):
        def one(c, i):
            tail = [F.get(cs, i + k)["word"] for k in range(1, chain)]
            whole = F.get(cs, i + chain - 1).isNotNull()
            near = F.slice(cs, F.greatest(i - gap, F.lit(0)) + 1, F.least(i, F.lit(gap)))
            spot = (c["anchor"] != "") | ~F.exists(near, lambda x: x["anchor"] != "")
            return F.when(whole & spot, F.xxhash64(c["anchor"], c["word"], *tail))

        return F.filter(F.transform(cs, one), lambda h: h.isNotNull())

    found = let(words, lambda ws: let(content(ws), chains))
    return let(
        F.array_sort(F.array_distinct(found)),
        lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.xxhash64(text))),
    )


def fingerprint(sigs: Column) -> Column:
    """A set of signatures as text: 16 hexadecimal digits each, in order."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), 16, "0"))), "")


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def pruned_jaccard(a: Column, b: Column, threshold: float = THRESHOLD) -> Column:
    """The Jaccard measure where the lengths allow the threshold, else null unmeasured."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return F.when(small >= large * threshold, jaccard(a, b))


def length_partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """Partition of a set length: sets alike at the threshold differ by one at most."""
    return F.floor(F.log(size) / F.lit(-math.log(threshold)) + 1e-9).cast("int")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text) -> (members, pairs).

    members: doc_id, class_id (least doc_id with the same fingerprint). pairs: class_a <
    class_b, similarity >= threshold, over classes; no pair is lost and copies are not
    expanded. Rows with a null doc_id take no part; an empty table gives two empty frames.
    """
    prints = docs.where("doc_id is not null").select("doc_id", signatures(F.col("text")).alias("sigs"))
    prints = prints.withColumn("print", F.sha2(fingerprint(F.col("sigs")), 256))
    classes = pinned(
        prints.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.first("sigs").alias("sigs"))
    )
    members = prints.select("doc_id", "print").join(classes.select("print", "class_id"), "print")

    each = classes.select(F.col("class_id").alias("id"), F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    df = each.groupBy("sig").agg(F.count("*").alias("df")).where("df > 1")
    # signatures of one set only can't meet another set: they count for the prefix length
    kept = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    ranked = (
        each.join(df, "sig")
        .groupBy("id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("shared"))
        .withColumn("prefix", kept - (F.col("n") - F.size("shared")))
        .where("prefix > 0")
        .select("id", "n", F.explode(F.slice("shared", F.lit(1), F.col("prefix").cast("int"))).alias("s"))
        .select("id", "n", F.col("s.sig").alias("sig"), length_partition(F.col("n"), threshold).alias("part"))
    )
    ranked = pinned(ranked)
    left = ranked.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig", "part")
    right = ranked.select(
        F.col("id").alias("b"), F.col("n").alias("nb"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part")
    )
    meet = left.join(right, ["sig", "part"]).where(
        (F.col("a") != F.col("b"))
        & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold)
    )
    meet = meet.select(F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b")).distinct()
    a = classes.select(F.col("class_id").alias("class_a"), F.col("sigs").alias("sa"))
    b = classes.select(F.col("class_id").alias("class_b"), F.col("sigs").alias("sb"))
    pairs = (
        meet.join(a, "class_a")
        .join(b, "class_b")
        .select("class_a", "class_b", pruned_jaccard(F.col("sa"), F.col("sb"), threshold).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )
    return members.select("doc_id", "class_id"), pairs
