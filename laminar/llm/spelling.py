"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, which turns every word into a reduced word. One edit of
a word is one edit of its reduced word, or none (a letter replaced by one of the same
symbol). So the full neighbourhood of a reduced word (each symbol deleted, each replaced by
every symbol, every symbol inserted anywhere) holds the reduced words of all near words,
and it is small: symbols, not letters, count. The neighbourhoods of the distinct reduced
words are joined with the reduced vocabulary; words of two classes that meet are compared
themselves, so that only true neighbours stay. Two classes find each other from both sides:
the join keeps the finding from the lower hash. Before the join a bitmap of fixed size
(``BITMAP_BITS``, 16 MB, whatever the vocabulary) drops what no reduced word can match.

Reduced words are told apart by a 64-bit polynomial hash modulo 2^64. Its sums over the
positions give the hash of any edit from those of the word's beginning and end, so that a
neighbourhood costs its size, not its size times the word's length, and is held as numbers
(136 bytes a letter for 8 symbols; blocks of words are held together up to ``HELD`` numbers,
a longer word is held alone).
Two reduced words with one hash only put words in one class; the comparison parts them.

Scale: one pass over the texts; counts are summed in the task before the shuffle, so a
very common word costs a row per task. What follows grows with the vocabulary: 2 x symbols
+ 1 numbers a letter for the neighbourhoods, then only classes that meet. More symbols mean
larger neighbourhoods and smaller classes; with the default of ``SYMBOLS`` a class holds
about one word as long as there are fewer words of a length than 8 to that length (2
million at seven letters, 130 million at nine).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import lower_ascii, pinned, workers_import_package

# Fixed value: a run of letters.
LETTERS = r"[A-Za-zÀ-ÿ]+"
SYMBOLS = 8  # symbols of the reduced alphabet
MIN_LENGTH = 7  # shortest word, in code points
MIN_COUNT = 2  # least occurrences of a word
DROP = 31  # a run whose checksum this divides loses a letter
RATIO = 10  # a form occurs so many times as often as its variant
HELD = 1 << 21  # numbers of neighbourhoods made at a time
BITMAP_BITS = 1 << 27  # bits of the broadcast bitmap of reduced words
BITMAP_PART = 1 << 15  # fixed value: bits of one bitmap that Spark aggregates

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_LENGTH = 0xD1B54A32D192ED03


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _symbols(letters: np.ndarray, n: int) -> np.ndarray:
    """The symbol of each code point."""
    spread = _scrambled((letters.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
    return ((spread >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _worth(n: int) -> np.ndarray:
    """What a symbol adds to a hash at position 0."""
    return _scrambled((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(_LENGTH)) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _by_length(words: list[str], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, symbols as rows) of words of one length, few enough to be held."""
    lengths = np.array([len(w) for w in words])
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        step = max(1, HELD // ((2 * n + 1) * (int(size) + 1)))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            joined = "".join([words[i] for i in part])
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            yield part, _symbols(points.reshape(len(part), size), n)


def _prefix_sums(reduced: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(what each position adds, sums of what lies before each position and at the end)."""
    added = _worth(n)[reduced] * _powers(max(1, reduced.shape[1]))[: reduced.shape[1]]
    sums = np.zeros((len(reduced), reduced.shape[1] + 1), np.uint64)
    np.cumsum(added, axis=1, out=sums[:, 1:])
    return added, sums


def _sealed(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes from sums, the length of the word counted in."""
    return _scrambled(sums + np.uint64(length * _LENGTH % (1 << 64))).view(np.int64)


def reduced_hashes(words: list[str], n: int = SYMBOLS) -> np.ndarray:
    """Hash of the reduced word of each word."""
    out = np.zeros(len(words), np.int64)
    for rows, reduced in _by_length(words, n):
        out[rows] = _sealed(_prefix_sums(reduced, n)[1][:, -1], reduced.shape[1])
    return out


def neighbourhoods(words: list[str], n: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash of a reduced word, hash of itself or a reduced word one edit from it), each once
    for one word, in blocks."""
    for _, reduced in _by_length(words, n):
        m, size = reduced.shape
        added, sums = _prefix_sums(reduced, n)
        whole, power, worth = sums[:, -1:], _powers(size + 1), _worth(n)
        new = power[:, None] * worth  # a symbol put at a position
        shorter = sums[:, :-1] + (whole - sums[:, 1:]) * np.uint64(_INVERSE)
        same = (whole - added)[:, :, None] + new[:size]
        longer = (sums + (whole - sums) * np.uint64(_BASE))[:, :, None] + new
        near = np.concatenate(
            [
                _sealed(shorter, size - 1),
                _sealed(same.reshape(m, -1), size),
                _sealed(longer.reshape(m, -1), size + 1),
            ],
            axis=1,
        )
        near.sort(axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        own = np.broadcast_to(_sealed(whole, size), near.shape)
        yield own[first], near[first]


# --------------------------------------------------------------------------- on DataFrames

def occurrences(text: Column, doc_id: Column, drop: int = DROP) -> Column:
    """array<string>: the runs of letters of a text with A-Z lower-cased. A run whose crc32 of
    ``<doc_id>:<run>`` is divisible by ``drop`` lacks the letter at the checksum modulo its
    length. Null texts have none; a null id counts as empty."""
    told = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"))

    def kept(run: Column) -> Column:
        h = F.crc32(F.concat(told, run).cast("binary"))
        at = (h % F.char_length(run)).cast("int")
        without = F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))
        return F.when(h % drop == 0, without).otherwise(run)

    return F.transform(F.regexp_extract_all(lower_ascii(text), F.lit(LETTERS), F.lit(0)), kept)


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    drop: int = DROP,
) -> DataFrame:
    """(word, n): the words of the whole texts with their occurrences over all rows (repeated
    rows count again)."""
    words = docs.select(F.explode(occurrences(docs[text], docs[doc_id], drop)).alias("word"))
    counted = words.where(F.char_length("word") >= min_length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def class_bitmap(classes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bytes of a bitmap with a bit set for each hash in ``class``, modulo ``bits`` (a power
    of two, at least one part). Aggregated in parts of 4 KB, so that the driver gets
    ``bits`` / 8 bytes at most."""
    at = F.pmod("class", F.lit(bits))
    part, bit = F.floor(at / BITMAP_PART).cast("int"), (at % BITMAP_PART).cast("long")
    parts = classes.select(part.alias("part"), bit.alias("bit")).groupBy("part")
    out = np.zeros((bits // BITMAP_PART, BITMAP_PART // 8), np.uint8)
    for row in parts.agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect():
        out[row["part"]] = np.frombuffer(row["bitmap"], np.uint8)
    return out.ravel()


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & (len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n): every two words that differ by exactly one inserted, deleted
    or replaced code point, both ways round. ``words`` has (word, n), each word once."""
    workers_import_package()

    @F.arrow_udf("bigint")
    def reduced(batch: pa.Array) -> pa.Array:
        return pa.array(reduced_hashes(batch.to_pylist(), symbols))

    words = pinned(words.select("word", "n", reduced("word").alias("class")))
    classes = pinned(words.groupBy("class").agg(F.min("word").alias("word")))
    known = words.sparkSession.sparkContext.broadcast(class_bitmap(classes))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, near in neighbourhoods(batch.column("word").to_pylist(), symbols):
                kept = own <= near
                kept[kept] = in_bitmap(known.value, near[kept])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[kept]), pa.array(near[kept])], ["class", "other"]
                )

    meets = classes.select("word").mapInArrow(around, "class long, other long")
    met = meets.join(classes.select(F.col("class").alias("other")), "other")
    near = words.select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("class").alias("other")
    )
    pairs = words.join(met, "class").join(near, "other")
    found = pairs.where(F.levenshtein("word", "near", 1) == 1)
    # a class meets itself once, with both ways round; two classes meet from one side
    ways = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.when(
            F.col("class") != F.col("other"),
            F.struct(
                F.col("near").alias("word"), F.col("near_n").alias("n"),
                F.col("word").alias("near"), F.col("n").alias("near_n"),
            ),
        ),
    )
    return found.select(F.explode(F.array_compact(ways)).alias("pair")).select("pair.*")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) without cycles: the last word that the forms lead
    to. The way known doubles each round, so rounds grow with the logarithm of the longest
    chain (a form is ``RATIO`` times as common as its variant: a chain has few links)."""
    at = pinned(links.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = pinned(at.join(onward, "root", "left"))
        at = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further is not null").isEmpty():
            return at


def variants(words: DataFrame, symbols: int = SYMBOLS, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    n_near counts near words. The form is the most frequent of them (ties: the smallest in
    code-point order) if it occurs at least ``ratio`` times as often as the word, else null;
    the root is where forms lead to in the end, the word itself if it has none. An empty
    vocabulary gives an empty result. ``ratio`` must be above 1, so that forms have no cycle.
    """
    if ratio <= 1:
        raise ValueError("the ratio must be above 1")
    words = pinned(words.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near")))
    near = near_words(words, symbols).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    common = -F.col("best.minus_n") >= ratio * F.col("n")
    found = pinned(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.near")).alias("form"),
            F.when(common, -F.col("best.minus_n")).alias("form_n"),
        )
    )
    ends = roots(found.where("form is not null"))
    joined = found.join(ends, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The variants of the vocabulary of ``docs``. Null, empty and letterless texts have no
    words, repeated rows count again, texts and words of any length are whole, other columns
    are not read, and an empty table gives an empty result."""
    return variants(vocabulary(docs, doc_id, text))
