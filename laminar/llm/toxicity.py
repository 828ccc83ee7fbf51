"""Toxicity by weak supervision.

Many cheap voters look at a text: lexicon voters (a word or a word beginning that marks
toxic texts among the labelled rows, or a published insult) and pattern voters (shouting,
no hit at all). A generative label model explains their votes by one hidden class per
text: each voter has an accuracy where it votes, abstaining says nothing, and voters that
fire together more often than the class explains share one weight between them (accuracies
and correlations are estimated together by expectation maximisation; the rows' own labels
are one more voter). A linear classifier is then trained on the posterior labels and
scores every text.

The model is fitted on at most ``MAX_FIT_ROWS`` labelled rows, those first by a hash of
their id (the bound is a parameter); the lexicon is mined from the same rows by a Spark
aggregate. Scoring reads every text once, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import fold, pinned, small_batches, workers_import_package

MAX_FIT_ROWS = 20_000
MAX_LEXICON = 256
MIN_SUPPORT = 6  # toxic texts that hold an entry
Z = 2.0  # deviations of the bound on an entry's precision
MIN_PRECISION = 0.5
PREFIXES = (4, 5, 6)
# Insults that vote without any labels.
INSULTS = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting clown fool imbecile jerk "
    "idioten dummkopf arschloch abschaum wertlos imbécile crétin connard ordure abruti "
    "idiota imbécil estúpido basura asqueroso"
).split()
PATTERNS = ("shouting", "exclaiming", "insulted", "no_hit")
WORDS = re.compile(r"[^\W\d_]+")


def entries(words: set[str]) -> set[str]:
    """Possible lexicon entries of a text: its words (``word$``) and their beginnings."""
    out = {w + "$" for w in words}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


@dataclass
class Voters:
    lexicon: list[str]
    index: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.index = {e: i for i, e in enumerate(self.lexicon)}
        self.insults = frozenset(INSULTS)

    def votes(self, text: str) -> tuple[list[int], list[int]]:
        """(lexicon entries that fire, votes of the patterns: 1 toxic, -1 clean, 0 none)."""
        raw = WORDS.findall(text)
        words = {w.lower() for w in set(raw)}
        get, hits = self.index.get, set()
        for w in words:
            for n in PREFIXES:
                i = get(w[:n]) if len(w) >= n else None
                if i is not None:
                    hits.add(i)
            i = get(w + "$")
            if i is not None:
                hits.add(i)
        upper = sum(len(w) > 1 and w.isupper() for w in raw)
        insulted = not self.insults.isdisjoint(words)
        patterns = [
            int(len(raw) >= 5 and 2 * upper > len(raw)),
            int(3 * text.count("!") > len(raw) >= 5),
            int(insulted),
            -int(not hits and not insulted),
        ]
        return sorted(hits), patterns


@dataclass
class Model:
    voters: Voters
    evidence: np.ndarray  # label model's weight of each voter
    weights: np.ndarray  # classifier: voters, then the evidence's sum
    bias: float

    def score(self, text: str | None) -> float:
        hits, patterns = self.voters.votes(text or "")
        n = len(self.voters.lexicon)
        at = [*hits, *(n + i for i, v in enumerate(patterns) if v)]
        sign = np.array([1.0] * len(hits) + [float(v) for v in patterns if v])
        own = np.clip((self.evidence[at] * sign).sum(), -8, 8) if at else 0.0
        z = self.bias + self.weights[-1] * own + ((self.weights[at] * sign).sum() if at else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def label_model(
    votes: np.ndarray, times: np.ndarray | None = None, rounds: int = 25
) -> tuple[np.ndarray, np.ndarray]:
    """votes (rows x voters; 1, -1, 0) -> (posterior of class 1 per row, weight per voter).

    ``times``: how many texts each row of votes stands for (default: one). A weight is the log odds of the voter's accuracy, divided by one plus its positive
    correlations with the other voters' firing within a class.
    """
    rows, m = votes.shape
    if rows == 0:
        return np.zeros(0), np.full(m, np.log(0.8 / 0.2))
    times = np.ones(rows) if times is None else times.astype(np.float64)
    n, v, fired = times.sum(), votes.astype(np.float64), np.abs(votes).astype(np.float64)
    accuracy, shared, prior = np.full(m, 0.8), np.ones(m), 0.1
    n_fired = times @ fired
    for k in range(rounds):
        weight = np.log(accuracy / (1 - accuracy)) / shared
        p = 1 / (1 + np.exp(-np.clip(v @ weight + np.log(prior / (1 - prior)), -30, 30)))
        prior = float(np.clip(times @ p / n, 0.01, 0.99))
        right = (times * p) @ (votes == 1) + (times * (1 - p)) @ (votes == -1)
        accuracy = np.clip((right + 2.0) / (n_fired + 2.5), 0.05, 0.999)
        if k % 5 == 0:
            corr = np.zeros((m, m))
            for w in (times * p, times * (1 - p)):  # within each class, weighted by the posterior
                total = max(w.sum(), 1e-9)
                mean = (w @ fired) / total
                c = (fired * w[:, None]).T @ fired / total - np.outer(mean, mean)
                sd = np.sqrt(np.clip(np.diag(c), 1e-12, None))
                corr = np.maximum(corr, np.where(np.outer(sd, sd) > 1e-9, c / np.outer(sd, sd), 0) * (total / n > 0.005))
            np.fill_diagonal(corr, 0)
            shared = 1 + np.clip(np.where(corr > 0.2, corr, 0), 0, 1).sum(axis=1)
    return p, np.log(accuracy / (1 - accuracy)) / shared


def logistic(
    x: np.ndarray, p: np.ndarray, times: np.ndarray, ridge: float = 0.1, rounds: int = 30
) -> np.ndarray:
    """Weights (last: bias) of a logistic regression on soft labels, by Newton steps; a row
    counts ``times`` times."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (times * q * (1 - q))[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(h, x1.T @ (times * (p - q)) - penalty * w)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    return w


def _mined(sample: DataFrame, max_lexicon: int) -> list[str]:
    """Entries that mark toxic texts: lower bound of precision at least MIN_PRECISION."""

    def counted(batches):
        for b in batches:
            toxic, clean = Counter(), Counter()
            for text, is_toxic in zip(b["text"], b["toxic"]):
                (toxic if is_toxic else clean).update(entries({w.lower() for w in set(WORDS.findall(text))}))
            # an entry that no toxic text of the batch holds may still do so elsewhere
            every = list(toxic.keys() | clean.keys())
            yield pd.DataFrame(
                {"entry": every, "t": [toxic[e] for e in every], "c": [clean[e] for e in every]}
            )

    sums = (
        sample.select("text", "toxic")
        .mapInPandas(counted, "entry string, t long, c long")
        .groupBy("entry")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where(F.col("t") >= MIN_SUPPORT)
    )
    n, z2 = F.col("t") + F.col("c"), Z * Z
    rate = F.col("t") / n
    bound = (rate + z2 / (2 * n) - Z * F.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    top = (
        sums.withColumn("bound", bound)
        .where(F.col("bound") >= MIN_PRECISION)
        .orderBy(F.desc("t"), F.desc("bound"), "entry")
        .limit(max_lexicon)
    )
    return sorted(r["entry"] for r in top.collect())


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, max_lexicon: int = MAX_LEXICON) -> Model:
    """Fit on the labelled rows of ``docs`` (doc_id, text). ``labels``: doc_id, toxic.

    Rows without id or label don't count; a document labelled twice is toxic if either
    says so; of rows with one id the text first by hash counts. Without any labelled row the
    published insults and the patterns vote alone.
    """
    workers_import_package()
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    text = F.coalesce("text", F.lit(""))
    sample = pinned(
        # at most max_rows rows of two numbers
        docs.select("doc_id", text.alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"))).alias("m"))
        .select("doc_id", "toxic", F.col("m.text").alias("text"))
    )
    voters = Voters(_mined(sample, max_lexicon))

    @F.pandas_udf("hits array<int>, patterns array<int>")
    def voted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([voters.votes(t) for t in texts], columns=["hits", "patterns"])

    # texts with the same votes count as one row: most have none, so few rows come here
    same = sample.select("toxic", voted("text").alias("v")).groupBy("toxic", "v.hits", "v.patterns")
    rows = sorted(tuple(r) for r in same.count().collect())
    n, m = len(voters.lexicon), len(voters.lexicon) + len(PATTERNS)
    votes = np.zeros((len(rows), m + 1), dtype=np.int8)
    for i, (toxic, hits, patterns, _) in enumerate(rows):
        votes[i, hits] = 1
        votes[i, n:m] = patterns
        votes[i, m] = 1 if toxic else -1
    times = np.array([r[3] for r in rows], dtype=np.float64)
    posterior, weight = label_model(votes, times)
    evidence = weight[:m]
    if not rows:
        weights = np.zeros(m + 1)
        weights[-1] = 1.0
        return Model(voters, evidence, weights, float(np.log(0.1 / 0.9)))
    x = votes[:, :m].astype(np.float64)
    x = np.hstack([x, np.clip(x @ evidence, -8, 8)[:, None]])
    w = logistic(x, posterior, times)
    return Model(voters, evidence, w[:-1], float(w[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, anything else) with ``toxicity`` (0 to 1). Null counts as empty; an empty
    text has the score of a text without any hit; repeated rows are alike."""
    if "toxicity" in docs.columns:
        raise ValueError("rename the column toxicity first")
    workers_import_package()
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return docs.withColumn("toxicity", scored(docs["text"]))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may be learnt from: those outside the held-out fold."""
    return labels.where(fold(F.col("doc_id")) != 0)
