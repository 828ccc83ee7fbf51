"""Bigram language model in a log-frequency Bloom filter.

Training counts words and word pairs (each text ends with an end token, which is also the
context of the next text's first word). A pair with count c is kept as its quantised
log frequency q, the number of whole numbers round(STEP ** k) up to c (counts to 5 are exact,
above that the middle of a level is off by an eighth at most): the filter holds the pair at levels 1 to q, and
a lookup probes level after level until one is missing. Per context the filter also holds
how often it occurs (C) and how many different words follow it (T). ``HASHES`` says how many
bits an entry has per level: an unseen pair passes the first with about 2 to that power,
inverse; a pair seen once passes the second just as rarely, because once or twice matters
most after discounting; further levels take fewer.

Probability of w after h: half of absolute discounting (max(c(hw) - D, 0) + D T(h) p(w)) /
c(h), with D from the counts of counts of all pairs, and half of the word's own p(w) =
(c + 0.5) / (N + 0.5 (V + 1)). Words outside the ``HEAD_WORDS`` most frequent ones have
their count from the filter, too; the base score uses exact counts for every word.

Scale: the filter is built in segments by a hash of the context (of the pair, for the at
most 1,000 contexts with more than a thousandth of all tokens), one group of bounded
size each; pairs are counted per task before the one shuffle. While all segments
together have at most ``MAX_FILTER_BYTES`` they are broadcast. Beyond that the same
segments answer the lookups where they lie: the same scores by another road. Texts are kept
in chunks of up to a million tokens (each different word once, two to four bytes a token); a
chunk asks each group of segments for its different pairs and words, as packed keys, and gets
a byte for each. This goes in ``ROUNDS`` parts, one after the other, so that only one part's
questions are on disk at a time. The head table has at most HEAD_WORDS rows; exact counts of
all other words are joined by hash, a few per cent of the tokens.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import fold, pinned, small_batches, unused, workers_import_package
from laminar.session import fresh_dir, shuffles_removed
from laminar.sources.layers import remove_folder

HEAD_WORDS = 1 << 18
MAX_FILTER_BYTES = 128 << 20
HASHES = (10, 8, 4)  # of the first, the second and each further level
SEGMENT_CHARS = 2_000_000  # training text per segment: about 300,000 tokens
STEP = 1.25  # ratio of neighbouring levels of counts
HOT_SHARE = 1000  # a context with more than N / HOT_SHARE tokens is spread over segments
MIXTURE = 0.5
GROUP_SEGMENTS = 16  # segments that answer together
ROUNDS = 8
_FLUSH = 1 << 20
_CACHE = 1 << 18
_CHUNK = 1 << 18
_VOCABULARY = 1 << 19  # words that a scoring task keeps

_GOLD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: increment of the mixing function
_HALF = np.uint64(32)
_COUNT, _FOLLOWERS = np.uint64(1), np.uint64(2)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (finaliser with two multiplications)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(mix64(h) + w)


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes split at ASCII white space only."""
    return (text or "").encode().lower().split()


END = word_hash(b"")


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) >= _CACHE // 2:
            self.clear()
        h = self[word] = word_hash(word)
        return h


def segment_of(h: np.ndarray, keys: np.ndarray, hot: np.ndarray, segments: int) -> np.ndarray:
    spread = np.isin(h, hot) if len(hot) else np.zeros(len(h), dtype=bool)
    return (mix64(np.where(spread, keys, h) ^ _GOLD) % np.uint64(segments)).astype(np.int64)


# the least count of each level, from 1 up, in an array that a level indexes from 1
_LEAST = np.unique(np.round(STEP ** np.arange(int(62 / np.log2(STEP)))).astype(np.int64))
MAX_LEVEL = len(_LEAST)
_MIDDLE = np.concatenate(([0.0], (_LEAST[:-1] + _LEAST[1:] - 1) / 2, [float(_LEAST[-1])]))


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised log frequency of counts >= 1."""
    return np.searchsorted(_LEAST, counts, side="right")


def value_of(level: np.ndarray) -> np.ndarray:
    """Count that a level stands for: 0 for none, else the middle of its range of counts."""
    return _MIDDLE[level]


def hashes_of(level: int) -> int:
    return HASHES[min(level, len(HASHES)) - 1]


def _spots(keys: np.ndarray, level: int):
    x = mix64(keys + np.uint64(level * int(_GOLD) % (1 << 64)))
    return x, mix64(x) | np.uint64(1)


def _spot(x: np.ndarray, bits) -> np.ndarray:
    """The upper half of x scaled to 0 .. bits - 1 (bits below 2**32)."""
    return ((x >> _HALF) * bits) >> _HALF


def build_segment(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Filter of these entries: its size in bits (8 bytes), then the bits."""
    q = levels(counts)
    order = np.argsort(-q, kind="stable")  # the keys of each level come first
    keys, q = keys[order], q[order]
    per_entry = np.cumsum([0, *map(hashes_of, range(1, MAX_LEVEL + 1))])
    wanted = int(per_entry[q].sum())
    bits = max(64, int(wanted / np.log(2)) // 8 * 8 + 8)
    on = np.zeros(bits, dtype=bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        x, step = _spots(keys[: np.searchsorted(-q, -level, side="right")], level)
        for i in range(hashes_of(level)):
            on[_spot(x + np.uint64(i) * step, np.uint64(bits))] = True
    return np.uint64(bits).tobytes() + np.packbits(on, bitorder="little").tobytes()


def packed(segments, total: int, n_bytes: int):
    """(bits, start, data) of segments (number, bytes): one array holds them all."""
    bits, start = np.ones(total, dtype=np.uint64), np.full(total, -1, dtype=np.int64)
    data, at = np.zeros(max(1, n_bytes), dtype=np.uint8), 0
    for k, part in segments:
        bits[k] = np.frombuffer(part[:8], dtype=np.uint64)[0]
        start[k] = at
        body = np.frombuffer(part, dtype=np.uint8, offset=8)
        data[at : at + len(body)] = body
        at += len(body)
    return bits, start, data


class Filter:
    """Lookups in some of the segments, as ``packed``; the others count as empty."""

    def __init__(self, bits: np.ndarray, start: np.ndarray, data: np.ndarray):
        self.bits, self.start, self.data = bits, start, data

    @classmethod
    def of(cls, segments: dict[int, bytes], total: int):
        return cls(*packed(segments.items(), total, sum(map(len, segments.values()))))

    def level(self, keys: np.ndarray, segs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        alive = np.nonzero(self.start[segs] >= 0)[0]
        # segment by segment: neighbouring probes meet in the same few hundred kB
        near = segs[alive].astype(np.uint16 if len(self.start) <= 1 << 16 else np.int64)
        alive = alive[np.argsort(near, kind="stable")]
        for level in range(1, MAX_LEVEL + 1):
            if not len(alive):
                break
            x, step = _spots(keys[alive], level)
            s = segs[alive]
            bits, start = self.bits[s], self.start[s]
            for i in range(hashes_of(level)):
                if i:
                    x += step
                spot = _spot(x, bits)
                byte = self.data[start + (spot >> np.uint64(3)).astype(np.int64)]
                ok = (byte >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if not ok.all():
                    alive, x, step, bits, start = alive[ok], x[ok], step[ok], bits[ok], start[ok]
            out[alive] = level
        return out


def _count_words(batches):
    def rows(words: Counter):
        return pd.DataFrame(
            {
                "word": np.array([word_hash(w) for w in words], dtype=np.uint64).view(np.int64),
                "n": np.array(list(words.values()), dtype=np.int64),
            }
        )

    words: Counter = Counter()
    for b in batches:
        for text in b["text"]:
            words.update(tokens(text))
            words[b""] += 1
            if len(words) >= _FLUSH:
                yield rows(words)
                words.clear()
    yield rows(words)


def _pairs_of(batches, hot: np.ndarray, segments: int):
    """Rows (segment, h, pair, n): pairs counted per task, about a million tokens at a time;
    a row holds all of a segment's pairs as packed 64-bit contexts, 64-bit pairs and 32-bit
    counts, which is half of what a row per pair would shuffle."""
    hashes, held, size = _Hashes(), [], 0

    def flush():
        h = np.concatenate([np.concatenate(([context], x[:-1])) for context, x in held])
        key = pair_key(h, np.concatenate([x for _, x in held]))
        key, first, n = np.unique(key, return_index=True, return_counts=True)
        h = h[first]
        seg = segment_of(h, key, hot, segments)
        order = np.lexsort((h, seg))  # equal contexts side by side: they compress
        h, key, n, seg = h[order], key[order], n[order].astype(np.uint32), seg[order]
        cuts = np.flatnonzero(np.diff(seg, prepend=-1, append=-1))
        at = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return pd.DataFrame(
            {
                "segment": seg[cuts[:-1]],
                "h": [h[a:b].tobytes() for a, b in at],
                "pair": [key[a:b].tobytes() for a, b in at],
                "n": [n[a:b].tobytes() for a, b in at],
            }
        )

    for b in batches:
        for text in b["text"]:
            words = list(map(hashes.__getitem__, tokens(text)))
            words.append(END)
            for k in range(0, len(words), _FLUSH):
                # a longer text is counted in parts; the word before a part is its context
                part = np.array(words[k : k + _FLUSH], dtype=np.uint64)
                held.append((np.uint64(words[k - 1] if k else END), part))
                size += len(part)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def unpacked(column: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind)


def _segment(hot: np.ndarray):
    def build(group: pd.DataFrame) -> pd.DataFrame:
        pair = unpacked(group["pair"], np.uint64)
        key, first, back = np.unique(pair, return_index=True, return_inverse=True)
        n = np.bincount(back, weights=unpacked(group["n"], np.uint32)).astype(np.int64)
        h = unpacked(group["h"], np.uint64)[first]
        context, back = np.unique(h, return_inverse=True)
        followers = np.bincount(back)
        total = np.bincount(back, weights=n).astype(np.int64)
        spread = np.isin(context, hot)
        own = context[~spread]
        keys = np.concatenate([key, pair_key(own, _COUNT), pair_key(own, _FOLLOWERS)])
        counts = np.concatenate([n, total[~spread], followers[~spread]])
        return pd.DataFrame(
            {
                "segment": [int(group["segment"].iloc[0])],
                "bits": [build_segment(keys, counts)],
                "once": [int((n == 1).sum())],
                "twice": [int((n == 2).sum())],
                # contexts spread over segments: their followers here (at most HOT_SHARE rows)
                "hot": [context[spread].view(np.int64).tolist()],
                "followers": [followers[spread].tolist()],
            }
        )

    return build


class Model:
    """What scoring needs, but for the segments: bounded tables and four numbers."""

    def __init__(self, head, counts, hot, followers, total, distinct, discount, segments):
        order = np.argsort(head)
        self.head, self.counts = head[order], counts[order]
        order = np.argsort(hot)
        self.hot, self.followers = hot[order], followers[order]
        self.total, self.distinct, self.discount = total, distinct, discount
        self.segments = segments

    @property
    def mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def exact(self, words: np.ndarray) -> np.ndarray:
        """Counts of head words, -1 for the others."""
        if not len(self.head):
            return np.full(len(words), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.head, words), len(self.head) - 1)
        return np.where(self.head[at] == words, self.counts[at], -1)

    def segment(self, h, keys):
        return segment_of(h, keys, self.hot, self.segments)

    def word_levels(self, words: np.ndarray, found: Filter):
        """Levels of the words' counts (0 for head words) and of their followers."""
        seg, rest = self.segment(words, words), self.exact(words) < 0
        count = np.zeros(len(words), dtype=np.int64)
        count[rest] = found.level(pair_key(words[rest], _COUNT), seg[rest])
        return count, found.level(pair_key(words, _FOLLOWERS), seg)

    def words(self, words: np.ndarray, count: np.ndarray, followers: np.ndarray):
        """(count, followers, whether the count is exact) of words with these levels."""
        exact = self.exact(words)
        rest = exact < 0
        followers = value_of(followers)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
            followers = np.where(self.hot[at] == words, self.followers[at], followers)
        return np.where(rest, value_of(count), exact.astype(np.float64)), followers, ~rest

    def log_probability(self, pair, count_h, followers_h, count_w):
        """log10 p(w | h); works on numpy arrays."""
        own = (count_w + 0.5) / self.mass
        d = self.discount
        seen = np.maximum(pair - d, 0) + d * followers_h * own
        ad = np.where(count_h > 0, seen / np.maximum(count_h, 1), own)
        return np.log10(MIXTURE * ad + (1 - MIXTURE) * own)


class _Vocabulary(dict):
    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []
        self[b""]  # the end token is word 0

    def __missing__(self, word):
        i = self[word] = len(self)
        self.fresh.append(word)
        return i


def _tail(index: np.ndarray, hashes: np.ndarray, exact: np.ndarray):
    """Words of a text whose exact count the head doesn't have: (hashes, occurrences)."""
    rest, n = np.unique(index[~exact[index]], return_counts=True)
    return hashes[rest].view(np.int64).tolist(), n.tolist()


def _contexts(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The word before each; word 0, the end, before the first of a text."""
    h = np.concatenate(([0], words[:-1]))
    h[starts] = 0
    return h


def _packed_chunk(words: np.ndarray, hashes: np.ndarray, sizes: np.ndarray):
    """Texts side by side as bytes: hashes of their different words (the end first), the words
    as numbers of these, byte by byte (the upper ones are mostly zero and compress), sizes."""
    own, words = np.unique(words, return_inverse=True)
    planes = words.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return hashes[own].tobytes(), planes.tobytes(), sizes.astype(np.uint32).tobytes()


class _Chunk:
    """Texts of ``_packed_chunk``: their different pairs and words in the order in which the
    segments are asked."""

    def __init__(self, m: Model, hashes: bytes, words: bytes, sizes: bytes):
        self.hashes = np.frombuffer(hashes, dtype=np.uint64)
        planes = np.frombuffer(words, dtype=np.uint8).reshape(4, -1)
        self.w = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
        sizes = np.frombuffer(sizes, dtype=np.uint32).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.h = _contexts(self.w, self.starts)
        n = len(self.hashes)
        pairs, self.back = np.unique(self.h * n + self.w, return_inverse=True)
        before = self.hashes[pairs // n]
        key = pair_key(before, self.hashes[pairs % n])
        self.pair, self.pair_order, self.pair_segment = self._ordered(key, m.segment(before, key))
        own = m.segment(self.hashes, self.hashes)
        self.word, self.word_order, self.word_segment = self._ordered(self.hashes, own)

    @staticmethod
    def _ordered(keys: np.ndarray, segments: np.ndarray):
        order = np.argsort(segments, kind="stable")
        return keys[order], order, segments[order]

    def questions(self):
        """(group, pairs, pairs of each of its segments, words, words of each)."""
        groups = np.unique(np.concatenate([self.pair_segment, self.word_segment]) // GROUP_SEGMENTS)
        for g in groups.tolist():
            edges = g * GROUP_SEGMENTS + np.arange(GROUP_SEGMENTS + 1)
            out = [g]
            for keys, segments in ((self.pair, self.pair_segment), (self.word, self.word_segment)):
                cuts = np.searchsorted(segments, edges)
                out += [keys[cuts[0] : cuts[-1]].tobytes(), np.diff(cuts).astype(np.uint32).tobytes()]
            yield tuple(out)

    def scores(self, m: Model, answers: pd.DataFrame) -> np.ndarray:
        """log10 probability of each text, from the answers of all groups."""
        answers = answers.sort_values("group")

        def told(name: str, order: np.ndarray) -> np.ndarray:
            out = np.zeros(len(order), dtype=np.int64)
            out[order] = unpacked(answers[name], np.uint8)
            return out

        pair = value_of(told("pair", self.pair_order))[self.back]
        count, followers, _ = m.words(
            self.hashes, told("count", self.word_order), told("followers", self.word_order)
        )
        log = m.log_probability(pair, count[self.h], followers[self.h], count[self.w])
        return np.add.reduceat(log, self.starts)


def _scorer(model, segments, lookups: bool):
    """Iterator UDF over texts: a row of ``_SCORED`` each; with ``lookups`` false the score is
    left to :func:`_answered_scores` and the first row of each chunk has the chunk instead."""
    chunk = _CHUNK if lookups else _FLUSH

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = model.value
        found = Filter(*segments.value) if lookups else Filter.of({}, m.segments)
        vocabulary = _Vocabulary()
        hashes, count, followers = (np.zeros(0, dtype=t) for t in (np.uint64, float, float))
        exact = np.zeros(0, dtype=bool)

        def learn():
            nonlocal hashes, count, followers, exact
            new = np.array([word_hash(w) for w in vocabulary.fresh], dtype=np.uint64)
            vocabulary.fresh = []
            c, t, e = m.words(new, *m.word_levels(new, found))
            hashes, count = np.concatenate([hashes, new]), np.concatenate([count, c])
            followers, exact = np.concatenate([followers, t]), np.concatenate([exact, e])

        def scored(texts: list[np.ndarray]) -> pd.DataFrame:
            learn()
            w = np.concatenate(texts)
            sizes = np.array([len(x) for x in texts])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            h = _contexts(w, starts)
            known_log = np.where(exact[w], np.log10(count[w] + 0.5), 0.0)
            out = pd.DataFrame(
                {
                    "n_tokens": sizes.astype(np.int64),
                    "head_known": np.add.reduceat((exact[w] & (count[w] > 0)).astype(np.int64), starts),
                    "head_log": np.add.reduceat(known_log, starts),
                }
            )
            tails = [_tail(x, hashes, exact) for x in texts]
            out["tail"], out["tail_n"] = [t[0] for t in tails], [t[1] for t in tails]
            if lookups:
                # every distinct pair is looked up once
                _, first, back = np.unique(h * len(hashes) + w, return_index=True, return_inverse=True)
                before = hashes[h[first]]
                key = pair_key(before, hashes[w[first]])
                pair = value_of(found.level(key, m.segment(before, key)))[back]
                log = m.log_probability(pair, count[h], followers[h], count[w])
                out["score"] = np.add.reduceat(log, starts)
                out["hashes"], out["words"], out["sizes"] = None, None, None
            else:
                out["score"] = np.nan
                packed_chunk = _packed_chunk(w, hashes, sizes)
                for name, value in zip(("hashes", "words", "sizes"), packed_chunk):
                    out[name] = [value] + [None] * (len(out) - 1)
            return out

        for batch in batches:
            done, texts, size = [], [], 0
            for text in batch:
                words = list(map(vocabulary.__getitem__, tokens(text)))
                words.append(0)
                texts.append(np.array(words, dtype=np.int64))
                size += len(words)
                if size >= chunk:
                    done.append(scored(texts))
                    texts, size = [], 0
                    if len(vocabulary) >= _VOCABULARY:
                        vocabulary = _Vocabulary()
                        hashes, count, followers = (np.zeros(0, dtype=t) for t in (np.uint64, float, float))
                        exact = np.zeros(0, dtype=bool)
            if texts:
                done.append(scored(texts))
            yield pd.concat(done, ignore_index=True) if done else pd.DataFrame(columns=_COLUMNS)

    return run


_SCORED = (
    "n_tokens long, head_known long, head_log double, tail array<long>, "
    "tail_n array<long>, score double, hashes binary, words binary, sizes binary"
)
_COLUMNS = [c.split()[0] for c in _SCORED.split(", ")]


def _head(counts: DataFrame, head_words: int):
    """Hashes and counts of the most frequent words, at most ``head_words`` of them, by whole
    classes of nearly equal count (a table of a few hundred classes comes to the driver)."""
    step = F.floor(F.log(1.05, F.col("n"))).cast("int")
    sizes = counts.groupBy(step.alias("k")).agg(F.count("*").alias("words")).collect()
    left, least = head_words, None
    for r in sorted(sizes, key=lambda r: -r["k"]):
        left -= r["words"]
        if left < 0:
            break
        least = r["k"]
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    rows = counts.where(step >= least).toPandas()
    return rows["word"].to_numpy(dtype=np.int64).view(np.uint64), rows["n"].to_numpy(dtype=np.int64)


def _answered_scores(chunks: DataFrame, shared, segments: DataFrame) -> DataFrame:
    """(row, score) of the texts of ``chunks`` (row: that of the first text), with the segments
    left where they are: each group of segments is sent the keys that chunks ask for, packed,
    and sends back a level (a byte) for each."""

    def ask(batches):
        m = shared.value
        for b in batches:
            for row, *packed_chunk in b.itertuples(index=False):
                asked = [(g, row, *rest) for g, *rest in _Chunk(m, *packed_chunk).questions()]
                yield pd.DataFrame(asked, columns=["group", "chunk", "pair", "pair_n", "word", "word_n"])

    def answer(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        if not len(asked):
            return pd.DataFrame(columns=["chunk", "group", "pair", "count", "followers"])
        found = Filter.of(dict(zip(held["segment"], held["bits"])), m.segments)
        numbers = np.tile(key[0] * GROUP_SEGMENTS + np.arange(GROUP_SEGMENTS), len(asked))
        segment = np.repeat(numbers, unpacked(asked["pair_n"], np.uint32))
        levels_of = {"pair": found.level(unpacked(asked["pair"], np.uint64), segment)}
        words = unpacked(asked["word"], np.uint64)
        levels_of["count"], levels_of["followers"] = m.word_levels(words, found)
        out = pd.DataFrame({"chunk": asked["chunk"], "group": key[0]})
        for name, keys in (("pair", "pair"), ("count", "word"), ("followers", "word")):
            ends = np.cumsum([len(k) // 8 for k in asked[keys]])[:-1]
            out[name] = [x.astype(np.uint8).tobytes() for x in np.split(levels_of[name], ends)]
        return out

    def scored(key, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        found = _Chunk(m, *chunk[["hashes", "words", "sizes"]].iloc[0]).scores(m, answers)
        return pd.DataFrame({"row": key[0] + np.arange(len(found)), "joined": found})

    asked = chunks.mapInPandas(
        ask, "group long, chunk long, pair binary, pair_n binary, word binary, word_n binary"
    )
    group = F.floor(F.col("segment") / GROUP_SEGMENTS).cast("long").alias("group")
    held = segments.select(group, "segment", "bits").groupBy("group")
    answers = asked.groupBy("group").cogroup(held).applyInPandas(
        answer, "chunk long, group long, pair binary, count binary, followers binary"
    )
    return chunks.groupBy("row").cogroup(answers.groupBy("chunk")).applyInPandas(
        scored, "row long, joined double"
    )


def score(
    docs: DataFrame,
    training: DataFrame,
    head_words: int = HEAD_WORDS,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """Score every text of ``docs`` under a model learnt from the texts of ``training``.

    Returns the columns of ``docs`` but ``text`` with a struct column ``lm``: n_tokens (words
    and the end), n_known, train_tokens, base_score, score (log10). Null texts count as
    empty, one end token. Repeated rows are scored alike. Without any training text no
    word is known and every base score is 0.
    """
    workers_import_package()
    with shuffles_removed(docs.sparkSession):
        return _score(docs, training, head_words, max_filter_bytes)


def _score(docs: DataFrame, training: DataFrame, head_words: int, max_filter_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    train = training.select("text")
    counts = pinned(
        train.mapInPandas(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
    )
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = sums["total"] or 0, sums["distinct"]
    head, head_n = _head(counts, head_words)
    busy = counts.where(F.col("n") * HOT_SHARE > total).select("word").collect()
    hot = np.array(sorted(r["word"] for r in busy), dtype=np.int64).view(np.uint64)

    chars = train.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n_segments = 1 + chars // SEGMENT_CHARS
    segments = pinned(
        train.mapInPandas(
            lambda bs: _pairs_of(bs, hot, n_segments), "segment long, h binary, pair binary, n binary"
        )
        .groupBy("segment")
        .applyInPandas(
            _segment(hot),
            "segment long, bits binary, once long, twice long, hot array<long>, followers array<long>",
        )
    )
    s = segments.agg(
        F.sum("once").alias("once"), F.sum("twice").alias("twice"), F.sum(F.length("bits")).alias("bytes")
    ).first()
    once, twice = s["once"] or 0, s["twice"] or 0
    discount = once / (once + 2 * twice) if once else 0.75
    spread = {
        r["h"]: r["t"]
        for r in segments.select(F.explode(F.arrays_zip("hot", "followers")).alias("x"))
        .groupBy(F.col("x.hot").alias("h"))
        .agg(F.sum("x.followers").alias("t"))
        .collect()
    }
    followers = np.array([spread.get(int(h), 0) for h in hot.view(np.int64)], dtype=np.float64)
    model = Model(head, head_n, hot, followers, total, distinct, discount, n_segments)
    shared = spark.sparkContext.broadcast(model)
    fits = (s["bytes"] or 0) <= max_filter_bytes
    held = None
    if fits:
        parts = ((r["segment"], r["bits"]) for r in segments.select("segment", "bits").toLocalIterator())
        held = spark.sparkContext.broadcast(packed(parts, n_segments, s["bytes"] or 0))

    scorer = F.pandas_udf(_scorer(shared, held, fits), _SCORED)
    own = [c for c in docs.columns if c != "text"]
    row, got, answered = unused(docs, "row", "got", "answered")
    rows = docs.select(*own, scorer(docs["text"]).alias(got)).withColumn(row, F.monotonically_increasing_id())
    if fits:
        return _with_scores(pinned(rows), own, row, got, counts, model)
    small_batches(spark)  # a batch of texts is a chunk at most, and chunks come one by one
    root = fresh_dir(spark, "lm")
    try:
        rows.write.parquet(f"{root}/rows")
        rows = spark.read.parquet(f"{root}/rows")
        chunks = rows.select(F.col(row).alias("row"), *[f"{got}.{c}" for c in ("hashes", "words", "sizes")])
        chunks = chunks.where(F.col("hashes").isNotNull())
        for k in range(ROUNDS):
            part = chunks.where(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == k)
            _answered_scores(part, shared, segments).write.parquet(f"{root}/scores/round={k}")
        joined = spark.read.schema("row long, joined double").parquet(f"{root}/scores")
        rows = rows.join(joined.select(F.col("row").alias(row), F.col("joined").alias(answered)), row)
        return pinned(_with_scores(rows, own, row, got, counts, model, F.col(answered)))
    finally:
        remove_folder(spark, root)


def _with_scores(
    rows: DataFrame, own: list[str], row: str, got: str, counts: DataFrame, model: Model, value=None
) -> DataFrame:
    """The scorer's rows as ``score`` returns them; ``value``: the score if it is not theirs."""
    tail = (
        rows.select(F.col(row).alias("row"), F.explode(F.arrays_zip(f"{got}.tail", f"{got}.tail_n")).alias("x"))
        .select("row", F.col("x.tail").alias("word"), F.col("x.tail_n").alias("k"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_log"),
        )
    )
    out = rows.join(tail.withColumnRenamed("row", row), row, "left")
    value = F.col(f"{got}.score") if value is None else value
    n = F.col(f"{got}.n_tokens")
    return out.select(
        *[rows[c] for c in own],
        F.struct(
            n.alias("n_tokens"),
            (F.col(f"{got}.head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
            F.lit(model.total).cast("long").alias("train_tokens"),
            (
                F.col(f"{got}.head_log")
                + F.coalesce("tail_log", F.lit(0.0))
                - n * F.lit(float(np.log10(model.mass)))
            ).alias("base_score"),
            value.alias("score"),
        ).alias("lm"),
    )


def outside_fold(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """Rows that may be learnt from: those outside the held-out fold of their id."""
    return docs.where(fold(F.col("doc_id")) != held_out)
