"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every document. Votes are counted by pattern over the whole corpus
(at most 3**labellers rows), and expectation-maximisation over the counts estimates how often each labeller gives
each vote on good and on bad documents; that yields a posterior for every pattern. Posteriors of a bounded sample
train a linear scorer on hashed features, and the scorer judges all documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import map_carried, ship
from tidemark.llm.quality import Text

#: Documents the scorer is fitted on, at most about; hashed features.
TRAIN_ROWS, BUCKETS = 4000, 1 << 12
#: Features up to which a text is short.
SHORT = 200
_SHAPE = bytes(ord("0") if 48 <= c < 58 else ord("A") if 65 <= c < 91 else ord("a") if 97 <= c < 123 or c >= 128 else 32 if c in b"\t\v\f\r" else c for c in range(256))


def _vote(bad: bool, good: bool) -> int:
    return -1 if bad else 1 if good else 0


def vote_symbols(t: Text) -> int:
    n = t.n_symbols
    return _vote(10 * n > 3 * t.n_words, 100 * n < 2 * t.n_words)


def vote_repeats(t: Text) -> int:
    n = t.n_repeat_words
    return _vote(100 * n > 30 * t.n_words, n == 0 and t.n_words >= 20)


def vote_capitals(t: Text) -> int:
    return _vote(quality.shouting(t), 10 * sum(map(str.isupper, t.text)) < len(t.text))


def vote_stutter(t: Text) -> int:
    again = int((t.ids[1:] == t.ids[:-1]).sum())
    return _vote(10 * again > 3 * t.n_words, again == 0 and t.n_words >= 8)


def vote_letters(t: Text) -> int:
    letters = sum(map(str.isalpha, t.text))
    return _vote(4 * letters < 3 * t.word_chars, 10 * letters > 9 * t.word_chars)


def vote_plain(t: Text) -> int:
    """Words of letters alone, but for one mark at the end: under seven in ten is bad, over nine is good."""
    plain = sum(w.isalpha() or w[:-1].isalpha() for w in t.text.split())
    return _vote(10 * plain < 7 * t.n_words, 10 * plain > 9 * t.n_words)


def vote_sentences(t: Text) -> int:
    """Words that end a sentence: under one in forty of a long text, or over half, is bad; one in three to thirty is good."""
    ends = sum(w[-1:] in b".!?" for w in t.words)
    return _vote((t.n_words >= 60 and 40 * ends < t.n_words) or 2 * ends > max(t.n_words, 8), 3 * ends <= t.n_words <= 30 * ends)


def vote_variety(t: Text) -> int:
    kinds = len(set(t.words))
    return _vote(t.n_words >= 10 and 5 * kinds < t.n_words, 2 * kinds > t.n_words)


LABELLERS: tuple[Callable[[Text], int], ...] = (vote_symbols, vote_repeats, vote_capitals, vote_stutter, vote_letters, vote_plain, vote_sentences, vote_variety)


def votes_of(text: str | None, labellers=LABELLERS) -> str:
    """One character a labeller: + - or 0. A text without words has no votes but bad ones."""
    t = Text(text)
    return "".join("-0+"[f(t) + 1] for f in labellers) if t.n_words else "-" * len(labellers)


def count_patterns(docs: DataFrame, labellers=LABELLERS) -> pd.DataFrame:
    """(votes, n) over all rows; the patterns possible bound its size."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = batch["text"].map(lambda x: votes_of(x, labellers)).value_counts()
            yield pd.DataFrame({"votes": n.index, "n": n.to_numpy()})

    return docs.select("text").mapInPandas(count, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").toPandas()


def expectation_maximisation(patterns: pd.DataFrame, labellers: int, rounds: int = 200, smoothing: float = 1.0) -> tuple[float, np.ndarray]:
    """(prior of good, tables[class, labeller, vote]) for classes bad and good, started from the majority of the votes."""
    votes = np.array([["-0+".index(c) for c in v] for v in patterns["votes"]], dtype=int).reshape(-1, labellers)
    n = patterns["n"].to_numpy(dtype=float)
    good = 1 / (1 + np.exp(-2.0 * (votes - 1).sum(axis=1)))
    prior, tables = 0.5, np.full((2, labellers, 3), 1 / 3)
    for _ in range(rounds):
        prior = (n @ good + smoothing) / (n.sum() + 2 * smoothing)
        for c, weight in enumerate((n * (1 - good), n * good)):
            for j, v in itertools.product(range(labellers), range(3)):
                tables[c, j, v] = weight[votes[:, j] == v].sum() + smoothing
            tables[c] /= tables[c].sum(axis=1, keepdims=True)
        after = posterior(votes, prior, tables)
        if np.abs(after - good).max(initial=0) < 1e-9:
            break
        good = after
    return prior, tables


def posterior(votes: np.ndarray, prior: float, tables: np.ndarray) -> np.ndarray:
    """Chance of good for each row of vote numbers."""
    at = np.arange(votes.shape[1])
    odds = np.log(prior) - np.log1p(-prior) + (np.log(tables[1, at, votes]) - np.log(tables[0, at, votes])).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def features(text: str | None) -> np.ndarray:
    """Hashed trigrams of character shapes and of words' standing to their neighbour, as a vector of square roots.

    Its length is below one and grows with the text, so that short texts stay near the prior.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    counts = np.zeros(BUCKETS)
    shape = np.frombuffer(b" " + b" ".join(raw.translate(_SHAPE).split(b" ")) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(shape) > 2:
        code = (shape[:-2] << 16 | shape[1:-1] << 8 | shape[2:]) * np.uint32(2654435761)
        counts += np.bincount(code >> np.uint32(32 - 12), minlength=BUCKETS)
    counts[0] += sum(a == b for a, b in zip(words, words[1:], strict=False)) * 4.0
    counts[1] += len(words) - len(set(words))
    return np.sqrt(counts / (counts.sum() + SHORT))


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 8.0, decay: float = 1e-4) -> np.ndarray:
    """Weights and intercept of a logistic regression on soft labels, by full gradient steps; classes weigh the same."""
    x, y = x.astype(np.float32, copy=False), y.astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), np.float32(0)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    weight = (y / (2 * share) + (1 - y) / (2 * (1 - share))).astype(np.float32)
    for _ in range(rounds if len(y) else 0):
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        w -= np.float32(rate) * (error @ x + np.float32(decay) * w)
        b -= np.float32(rate) * error.sum()
    return np.append(w, b).astype(float)


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, labellers=LABELLERS) -> dict:
    """Labeller tables from all rows of (doc_id, text), scorer from a sample of at most ``train_rows`` rows.

    The sample takes the rows with the smallest hashes, so it is the same at every run. Null, empty and blank texts vote bad;
    repeated rows count one by one and, if they repeat the id too, are sampled together; ids may be missing; ties go by the text. An empty table gives a scorer
    that knows nothing but the prior. Further columns are ignored.
    """
    patterns = count_patterns(docs, labellers)
    prior, tables = expectation_maximisation(patterns, len(labellers))
    rows, parts = int(patterns["n"].sum()), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(votes_of(text, labellers), features(text).astype(np.float32).tobytes()) for text in batch["text"]]
            yield pd.DataFrame(out, columns=["votes", "features"])

    # about twice as many as needed by a bound on the hash, then the smallest of them
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("h"))
    bound = min((1 << 63) - 1, int(2.0 * train_rows / max(rows, 1) * (1 << 64)) - (1 << 63))
    chosen = hashed.filter(F.col("h") <= F.lit(bound)).orderBy("h", "text").limit(train_rows)
    got = chosen.select("text").repartition(parts).mapInPandas(sample, "votes string, features binary").toPandas().sort_values(["votes", "features"])
    x = np.frombuffer(b"".join(got["features"]), dtype=np.float32).reshape(len(got), BUCKETS)
    votes = np.array([["-0+".index(c) for c in v] for v in got["votes"]], dtype=int).reshape(-1, len(labellers))
    weights = fit_scorer(x, posterior(votes, prior, tables))
    weights[-1] += np.log(prior) - np.log1p(-prior)  # from equal classes to those of the corpus
    return {"prior": prior, "tables": tables, "weights": weights}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score (chance of good, by the scorer) and kept (score of a half or more) for every row.

    Null texts and texts without words score 0. Every row is judged by itself, so repeated rows get equal scores and ids
    may be missing or repeat; an empty table gives an empty result; further columns, whatever their names, are ignored.
    """
    ship(docs.sparkSession)
    weights = model["weights"]

    def judge(texts: list) -> tuple:
        s = np.array([1 / (1 + np.exp(-(features(t) @ weights[:-1] + weights[-1]))) if t and t.split() else 0.0 for t in texts], dtype=float)
        return None, (s, s >= 0.5)

    return map_carried(docs, ["doc_id"], ["text"], lambda: judge, "score double, kept boolean")


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs))
