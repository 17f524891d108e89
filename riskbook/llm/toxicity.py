"""Toxicity by weak supervision: many voters, a generative model of what their votes are worth, a linear classifier.

1. Voters. A small lexicon and a few patterns are given. More voters are mined from labelled training rows: words and
   beginnings of words that are found in toxic texts clearly more often than in others. A voter says "toxic" or nothing.
2. Label model. The true label of each training text is taken as hidden. Expectation maximisation estimates for every
   voter how often it speaks on toxic and on other texts; the given label speaks as one more voter, not as the truth.
   Voters that repeat each other (a word and its beginning) are found by the correlation of their votes beyond what
   the label explains, and share their weight.
3. Classifier. A logistic regression on votes, number of voters and their share of the words learns the posterior
   labels, and gives every text its score.

Only step 1 and 2 see labels, and only those of rows that ``is_training`` lets through. Voters and classifier are
fitted on a sample of at most about ``FIT_ROWS`` labelled texts, taken by a hash of the id and, if ids repeat, of the text; the model has at most
``VOTERS`` voters, so it is broadcast whatever the input. Scoring reads every whole text.

* null and empty texts: scored as texts that no voter speaks on;
* very long texts: all words count, and the share of the words is one of the classifier's inputs;
* repeated ids: every row of the table is scored; of several labels of one id the largest holds; null labels and
  labels without a text teach nothing;
* no training rows: the given voters alone, at the weights they start with; other columns: not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import portions, stored

FIT_ROWS = 20_000
VOTERS = 600
# Beginnings of words that can become voters.
STEMS = (4, 5, 6)
# A mined voter needs so many toxic texts, and a share of toxic texts that stays above this by two standard errors.
LEAST_TOXIC, LEAST_SHARE = 5, 0.5

# Insults that start as voters (fixed values).
LEXICON = (
    "idiot", "idiots", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "worthless", "pathetic",
    "disgusting", "clown", "dumb", "imbecile", "filth", "vermin", "retard", "bastard", "bitch", "asshole", "shit",
    "fuck", "fucking", "cunt", "whore", "slut",
)
# Phrases that start as voters.
PATTERNS = (
    r"\bshut up\b",
    r"\bkill your(?:self|selves)\b",
    r"\bgo to hell\b",
    r"\b(?:i|we) hate (?:you|them|these)\b",
    r"\byou(?: are|'re) (?:an? )?(?:ugly|useless|nobody|disgrace)\b",
)
_EDGES = ".,;:!?|\"'()[]{}<>*#$%&-_"


def distinct_words(text: str | None) -> tuple[set[str], int]:
    """The words of a text in lower case, without punctuation at their ends, and how many words it has."""
    words = (text or "").lower().split()
    return {w.strip(_EDGES) for w in set(words)}, len(words)


def stems_of(word: str) -> list[str]:
    """Beginnings as voters name them, told apart from words by a star."""
    return [word[:n] + "*" for n in STEMS if len(word) > n]


@dataclass
class Model:
    """Voters by name and the classifier's weights: one per voter, then for the two counts, then the constant."""

    voters: dict[str, int]
    weights: np.ndarray
    patterns: tuple[str, ...] = PATTERNS
    compiled: list = field(default_factory=list)

    def votes(self, text: str | None) -> tuple[list[int], int]:
        """Which voters speak on a text, and its number of words."""
        if not self.compiled:
            self.compiled = [(re.compile(p), self.voters[p]) for p in self.patterns if p in self.voters]
        words, n = distinct_words(text)
        named = self.voters
        found = {named[w] for w in words if w in named}
        for length in STEMS:
            # A stem and its words are one: only words longer than the stem bear its star.
            found.update(named[s] for s in {w[:length] + "*" for w in words if len(w) > length} & named.keys())
        if self.compiled and text:
            low = text.lower()
            found.update(k for pattern, k in self.compiled if pattern.search(low))
        return sorted(found), n

    def features(self, votes: list[list[int]], sizes: np.ndarray) -> np.ndarray:
        """One row per text: votes, logarithm of their number, their share of the words in steps of the logarithm."""
        rows = np.zeros((len(votes), len(self.voters) + 2), dtype=np.float32)
        for row, found in zip(rows, votes):
            row[found] = 1
        counts = np.array([len(v) for v in votes])
        rows[:, -2] = np.log1p(counts)
        rows[:, -1] = np.log1p(100 * counts / np.maximum(sizes, 1))
        return rows

    def scores(self, texts) -> np.ndarray:
        votes, sizes = zip(*[self.votes(t) for t in texts])
        # The sum over the few votes of a text, without a row of zeros for all the others.
        counts = np.array([len(v) for v in votes])
        said = np.array([self.weights[v].sum() for v in votes])
        sizes = np.maximum(np.array(sizes), 1)
        rest = self.weights[-3] * np.log1p(counts) + self.weights[-2] * np.log1p(100 * counts / sizes) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(said + rest, -40, 40)))


def _mined(sample: DataFrame) -> list[str]:
    """The strongest words and stems of the training sample, at most ``VOTERS``."""

    def run(batches):
        seen, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words, _ = distinct_words(text.as_py())
                names = words | {s for w in words for s in stems_of(w)}
                seen.update(names)
                if label:
                    toxic.update(names)
        kinds = [pa.string(), pa.int64(), pa.int64()]
        columns = [list(seen), list(seen.values()), [toxic[w] for w in seen]]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["name", "n", "toxic"])

    counted = sample.select("text", "toxic").mapInArrow(run, "name string, n long, toxic long")
    sums = counted.groupBy("name").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    share = (F.col("toxic") + 1) / (F.col("n") + 2)
    lowest = share - 2 * F.sqrt(share * (1 - share) / (F.col("n") + 3))
    strong = sums.where((F.col("toxic") >= LEAST_TOXIC) & (lowest > LEAST_SHARE) & (F.length("name") > 2))
    return [r["name"] for r in strong.orderBy(F.desc("toxic"), "name").select("name").limit(VOTERS).collect()]


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The posterior probability of the label of each text from its votes (0 or 1) and its given label."""
    speaks = np.column_stack([votes, given]).astype(np.float32)
    n = len(speaks)
    posterior = np.where(given > 0, 0.9, np.where(votes.any(axis=1), 0.3, 0.02)).astype(np.float32)
    weight = np.ones(speaks.shape[1], dtype=np.float32)
    for step in range(rounds):
        toxic, clean = posterior.sum(), n - posterior.sum()
        on_toxic = (speaks.T @ posterior + 0.5) / (toxic + 1)
        on_clean = (speaks.T @ (1 - posterior) + 0.05) / (clean + 1)
        if step == 1:
            weight = _shared_weight(speaks, posterior, on_toxic, on_clean)
        # The given label is wrong now and then, however well it fits.
        on_toxic[-1], on_clean[-1] = min(on_toxic[-1], 0.95), max(on_clean[-1], 0.01)
        said = weight * (np.log(on_toxic / on_clean))
        silent = weight * (np.log((1 - np.minimum(on_toxic, 0.999)) / (1 - np.minimum(on_clean, 0.999))))
        prior = np.log((toxic + 1) / (clean + 1))
        total = prior + speaks @ (said - silent) + silent.sum()
        new = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        done = np.abs(new - posterior).max() < 1e-4 and step > 2
        posterior = new.astype(np.float32)
        if done:
            break
    return posterior


def _shared_weight(speaks, posterior, on_toxic, on_clean) -> np.ndarray:
    """One over the number of voters that a voter counts for, itself included: the sum of the squared correlations of
    what the label leaves unexplained."""
    rest = speaks - (posterior[:, None] * on_toxic + (1 - posterior[:, None]) * on_clean)
    rest /= np.maximum(np.sqrt((rest * rest).sum(axis=0)), 1e-6)
    correlation = rest.T @ rest
    return (1 / np.maximum(1, (correlation * correlation).sum(axis=0))).astype(np.float32)


def logistic(features: np.ndarray, wanted: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights and constant of a logistic regression on probabilities, by accelerated gradient descent."""
    x = np.column_stack([features, np.ones(len(features), dtype=np.float32)])
    weights = np.zeros(x.shape[1], dtype=np.float32)
    # A step that cannot overshoot: the curvature is at most a quarter of the largest squared length of a row.
    step = 4 / float((x * x).sum(axis=1).max() + ridge)
    ahead, momentum = weights.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -40, 40)))
        new = ahead - step * ((x.T @ (p - wanted)) / len(x) + ridge * ahead)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = new + (momentum - 1) / next_momentum * (new - weights)
        weights, momentum = new, next_momentum
    return weights


def _start(names: list[str]) -> Model:
    """The weights without training rows: any voter is enough for a score above one half, none for one near 0."""
    weights = np.zeros(len(names) + 3)
    weights[:-3], weights[-3], weights[-1] = 1.0, 3.0, -3.0
    return Model({name: k for k, name in enumerate(names)}, weights)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    is_training: Column,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """The model of a table of texts and the labels of some of them; ``is_training`` is a condition on the id."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & is_training)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("toxic"))
    share = F.lit(min(1.0, fit_rows / max(1, known.count())))
    drawn = F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1_000_000)) < share * 1_000_000
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text).alias("text"))
    # About fit_rows ids and labels.
    sample = texts.join(F.broadcast(known.where(drawn)), F.col("doc") == F.col("id")).select("text", "toxic")
    # Copies would make every word of theirs look telling.
    sample = stored(sample.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled")
    # An id that documents repeat brings all its texts.
    n = sample.count()
    if n > fit_rows:
        sample = sample.where(F.pmod(F.xxhash64(F.lit("texts"), "text"), F.lit(1_000_000)) < fit_rows / n * 1_000_000)
    given_voters = [*LEXICON, *PATTERNS]
    mined = [n for n in _mined(sample) if n not in given_voters]
    model = _start([*given_voters, *mined])

    def run(batches):
        for batch in batches:
            found = [model.votes(t.as_py()) for t in batch.column(0)]
            votes = pa.array([v for v, _ in found], pa.list_(pa.int32()))
            sizes = pa.array([n for _, n in found], pa.int64())
            arrays = [votes, sizes, batch.column(1).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["votes", "size", "toxic"])

    got = sample.mapInArrow(run, "votes array<int>, size long, toxic int").toArrow()
    if not got.num_rows:
        return model
    votes, sizes = got["votes"].to_pylist(), got["size"].to_numpy()
    features = model.features(votes, sizes)
    posterior = label_model(features[:, :-2], (got["toxic"].to_numpy() > 0).astype(np.float32))
    return Model(model.voters, logistic(features, posterior).astype(np.float64))


def scored(df: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: the id and ``score``."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        out = [np.empty(0)]
        for start, length in portions(column):
            out.append(sent.value.scores(t.as_py() for t in column.slice(start, length)))
        return pa.array(np.concatenate(out))

    return df.select(id_col, score(F.col(text)).alias("score"))
