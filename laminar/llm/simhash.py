"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprint: A-Z lower-cased, words are runs without space and controls 9 to 13,
shingles of ``words`` words joined by one space, hashed by XXH64 (seed 42); a bit is set
if it is in more than half of the hashes. Fingerprints link at ``max_bits`` differing
bits or fewer; a component's id is its least doc_id.

Search: the index is dealt to groups by bits that a linked pair must share: of six
blocks of the 64 bits three are free of differences, so each fingerprint goes to the 20
groups named by three whole blocks. A group of more than ``GROUP_ROWS`` different
fingerprints is dealt again by three of six blocks of its free bits; after three
levels 8 bits are free, so no group can be larger than 256. Within a group the
fingerprints are sorted by Gray rank (neighbours in that order differ in few bits); runs
of them are factored into nodes that keep the bits all members share, level upon
level. A search descends with the differences counted so far, adds the node's own shared
bits only, and drops a node with all its members as soon as the count is too high. A
group hands on a spanning forest of its links, never all pairs.

Scale: equal fingerprints are one row from the start. Counts per group are partially
aggregated; groups of one row are dropped before any list is built, lists are at most
``GROUP_ROWS`` long. Links become components by contraction (``components.py``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.common import pinned, small_batches, unused, workers_import_package
from laminar.llm.components import connected_components

WORDS = 3
MAX_BITS = 3
GROUP_ROWS = 512
FANOUT = 8
_CHUNK = 1 << 15


def simhash(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit fingerprint of a text; zero without words."""
    import xxhash

    tokens = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII space count
    if not tokens:
        return 0
    if len(tokens) < words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), 42)
    joined = b" ".join(tokens)
    starts = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1, out=starts[1:])
    begin, end = starts[: len(tokens) - words + 1].tolist(), (starts[words:] - 1).tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(begin), _CHUNK):
        h = np.array(
            [digest(joined[a:b], 42) for a, b in zip(begin[k : k + _CHUNK], end[k : k + _CHUNK])],
            dtype="<u8",
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    on = np.nonzero(2 * total > len(begin))[0]
    return sum(1 << int(i) for i in on)


def fingerprints(text: Column, words: int = WORDS) -> Column:
    """Fingerprint as a signed 64-bit number."""
    workers_import_package()

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        unsigned = np.array([simhash(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(unsigned.view(np.int64))

    return of(text)


def blocks_of(free: list[int], blocks: int = 6) -> list[list[int]]:
    """The free bits in so many blocks of nearly the same length."""
    cut = [len(free) * i // blocks for i in range(blocks + 1)]
    return [free[a:b] for a, b in zip(cut, cut[1:])]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """The mask with half of its free blocks fixed, in each way."""
    free = [i for i in range(64) if not mask >> i & 1]
    parts = blocks_of(free, 2 * max_bits)
    return [
        mask | sum(1 << i for p in chosen for i in p)
        for chosen in combinations(parts, max_bits)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code (unsigned 64 bits) in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def forest(codes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Index pairs that connect all codes within max_bits of each other (distinct codes)."""
    n = len(codes)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []

    def link(i, j):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((i, j))

    if n <= 2 * FANOUT:  # one node: compare its members
        values = codes.tolist()
        for i in range(n):
            for j in range(i + 1, n):
                if (values[i] ^ values[j]).bit_count() <= max_bits:
                    link(i, j)
        return links
    order = np.argsort(gray_rank(codes), kind="stable")
    leaf = codes[order]
    # levels from the leaves up: members' common ones and common zeros
    levels = [(leaf, leaf)]
    while len(levels[-1][0]) > FANOUT:
        ones, any_ = levels[-1]
        cut = np.arange(0, len(ones), FANOUT)
        levels.append((np.bitwise_and.reduceat(ones, cut), np.bitwise_or.reduceat(any_, cut)))
    top = len(levels[-1][0])
    query = np.repeat(np.arange(n), top)
    node = np.tile(np.arange(top), n)
    count = np.zeros(len(query), dtype=np.int64)
    above = np.zeros(len(query), dtype=np.uint64)  # bits counted in upper nodes
    for depth in range(len(levels) - 1, -1, -1):
        ones, any_ = levels[depth]
        shared = ~(ones[node] ^ any_[node])
        own = shared & ~above
        count = count + np.bitwise_count((leaf[query] ^ ones[node]) & own)
        keep = count <= max_bits
        query, node, count, above = query[keep], node[keep], count[keep], shared[keep]
        if depth:
            below = len(levels[depth - 1][0])
            query, count, above = (np.repeat(x, FANOUT) for x in (query, count, above))
            node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            inside = node < below
            # each pair once: the part of the tree before the query's own run is skipped
            inside &= (node + 1) * FANOUT ** (depth - 1) > query
            query, node, count, above = query[inside], node[inside], count[inside], above[inside]
    for i, j in zip(query.tolist(), node.tolist()):
        if i < j:
            link(int(order[i]), int(order[j]))
    return links


def _links(codes: Column, max_bits: int) -> Column:
    workers_import_package()

    @F.pandas_udf("array<struct<a: long, b: long>>")
    def of(groups: pd.Series) -> pd.Series:
        out = []
        for g in groups:
            own = np.asarray(g, dtype=np.int64)
            found = forest(own.view(np.uint64), max_bits)
            out.append([{"a": int(own[i]), "b": int(own[j])} for i, j in found])
        return pd.Series(out)

    return of(codes)


def similar(spark: SparkSession, codes: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(code: distinct signed 64-bit) -> links (a, b) that connect all codes within
    ``max_bits`` of each other; pairs that only chain together are left out."""
    if not 1 <= max_bits <= 3:
        raise ValueError("max_bits must be 1 to 3")
    group_rows = max(group_rows, 256)
    masks, parts = [0], []
    rows = codes.select("code", F.lit(0).cast("long").alias("mask"))
    for _ in range(8):
        finer = sorted({(m, f) for m in masks for f in finer_masks(m, max_bits)})
        # from Arrow: rows given as tuples would start Python workers of their own for it
        table = spark.createDataFrame(
            pa.table({"mask": pa.array([_signed(m) for m, _ in finer], pa.int64()), "finer": pa.array([_signed(f) for _, f in finer], pa.int64())})
        )
        # a constant number of masks: 20 for each mask that is dealt again
        dealt = rows.join(F.broadcast(table), "mask").select(
            "code", F.col("finer").alias("mask"), F.col("code").bitwiseAND(F.col("finer")).alias("part")
        )
        if parts:
            dealt = dealt.distinct()
        sizes = pinned(dealt.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1"))
        small = dealt.join(sizes.where(F.col("n") <= group_rows), ["mask", "part"])
        groups = small.groupBy("mask", "part").agg(F.collect_list("code").alias("codes"))
        parts.append(groups.select(F.explode(_links(F.col("codes"), max_bits)).alias("l")).select("l.a", "l.b"))
        large = sizes.where(F.col("n") > group_rows)
        masks = sorted(r["mask"] % (1 << 64) for r in large.select("mask").distinct().collect())
        if not masks:
            break
        rows = pinned(dealt.join(large, ["mask", "part"]).select("code", "mask"))
    links = parts[0]
    for p in parts[1:]:
        links = links.union(p)
    return links.distinct()


def components(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, fingerprint (16 hexadecimal digits), text_hash,
    component (a fingerprint of the group) and component_id (its least doc_id).

    Null and empty texts have fingerprint zero and link like any other. Rows with a null
    doc_id take part; a component of such rows alone has a null id. Repeated rows come out
    as often as they went in.
    """
    small_batches(docs.sparkSession)
    prints = pinned(
        docs.select(
            "doc_id",
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
            fingerprints(F.col("text"), words).alias("code"),
        )
    )
    codes = pinned(prints.groupBy("code").agg(F.min("doc_id").alias("least")))
    roots = connected_components(similar(docs.sparkSession, codes.select("code"), max_bits))
    grouped = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "least", F.coalesce("root", "code").alias("component")
    )
    grouped = pinned(grouped)
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    table = grouped.select("code", "component").join(ids, "component")
    return prints.join(table, "code").select(
        "doc_id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        "text_hash",
        "component",
        "component_id",
    )


def one_of_each(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id (null last), among equal
    ids the least text hash."""
    key = F.struct(F.col("doc_id").isNull().alias("id_null"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"))
    chosen = components(docs, words, max_bits).groupBy("component").agg(F.min(key).alias("k"))
    names = unused(docs, "id_null", "id", "hash")
    own = [docs["doc_id"].isNull(), F.coalesce(docs["doc_id"], F.lit(0)), F.xxhash64(F.coalesce(docs["text"], F.lit("")))]
    keyed = docs.select(*docs.columns, *[c.alias(n) for c, n in zip(own, names, strict=True)])
    chosen = chosen.select(*[F.col(f"k.{c}").alias(n) for c, n in zip(("id_null", "id", "hash"), names, strict=True)])
    return keyed.join(chosen, names).dropDuplicates(names).select(*docs.columns)
