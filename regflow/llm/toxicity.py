"""Toxicity by weak supervision.

1. Lexicons. Words and word beginnings that mark labelled toxic documents far more than
   others are collected from a bounded sample of labelled rows. All counts are of families
   of documents, so that the copies of one document count once.
2. Voters. The lexicons, split into shards, and a few text patterns each fire or stay silent
   on a document: `VOTERS` bits, so that the votes of all documents are a histogram of at most
   2**VOTERS rows, whatever the size of the corpus.
3. Label model. Expectation maximisation on the histogram of all documents estimates the prior
   and how often each voter fires on toxic and on clean documents, and the correlation of each
   pair of voters given the label; a voter's weight falls with what it shares with others.
4. Classifier. A logistic regression over counts and densities is trained on the posterior
   labels of the sample, in which the known label takes part as one more voter, and scores
   every document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed, ids_and_texts, pieces
from regflow.session import ship_by_value

ship_by_value(__name__)

#: At most so many labelled rows, those with the smallest hashes of their ids, are learned from.
SAMPLE = 20_000
#: At most so many words, and so many beginnings of each length, in a lexicon: the best
#: supported of those that pass the test of lift.
TERMS = 20_000
#: A term needs this many families of toxic documents, and to be this many times as frequent
#: among families of toxic documents as among those of others.
SUPPORT, LIFT = 3, 10.0
#: Assumed accuracy of a given label as a voter.
TRUST = 0.98
THRESHOLD = 0.3

SHARDS = 8
VOTERS = SHARDS + 8
_BEGINNINGS = (4, 5)
_WORD = re.compile(r"\w+")
_SHOUT = re.compile(r"!{2,}")
_CAPS = re.compile(r"\b[A-Z]{3,}\b")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """All of bounded size: lexicons, label model, classifier."""

    words: dict[str, int] = field(default_factory=dict)
    starts: dict[int, dict[str, int]] = field(default_factory=lambda: {n: {} for n in _BEGINNINGS})
    prior: float = 0.0
    fires: np.ndarray | None = None
    weights: np.ndarray | None = None
    correlations: np.ndarray | None = None
    coefficients: np.ndarray | None = None


def shard(term: str, shards: int) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % shards


def _terms(text: str) -> tuple[set[str], list[str]]:
    words = _WORD.findall(text.lower())
    return set(words), words


def _family(words: list[str]) -> int:
    """The smallest hash of three words in a row: copies of a document mostly share it."""
    spans = zip(words, words[1:], words[2:], strict=False)
    hashes = (zlib.crc32(" ".join(s).encode("utf-8", "surrogatepass")) for s in spans)
    return min(hashes, default=zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass")))


def measure(text: str, model: Model) -> tuple[int, list[float]]:
    """The votes of a text as bits, and its features."""
    distinct, words = _terms(text)
    found = distinct & model.words.keys()
    votes = 0
    for term in found:
        votes |= 1 << model.words[term]
    begun = []
    place = SHARDS
    for size, starts in model.starts.items():
        hit = {w[:size] for w in distinct} & starts.keys()
        for term in hit:
            votes |= 1 << (place + starts[term])
        begun.append({w for w in distinct if w[:size] in hit} if hit else set())
        place += 2
    marked = found.union(*begun)
    hits = sum(w in marked for w in words) if marked else 0
    shouts, caps = len(_SHOUT.findall(text)), len(_CAPS.findall(text))
    density = hits / max(1, len(words))
    for bit, fires in enumerate((shouts > 0, caps > 2, len(marked) > 1, density > 0.005)):
        votes |= fires << (place + bit)
    features = [
        1.0,
        math.log1p(len(found)),
        *(math.log1p(len(b)) for b in begun),
        math.log1p(len(marked)),
        float(len(marked) > 1),
        math.log1p(hits),
        min(1.0, 20 * density),
        math.log1p(shouts),
        math.log1p(caps),
        math.log1p(len(words)) / 10,
    ]
    return votes, features


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, int, int]:
    """Texts and labels of at most `sample` labelled rows, and how many are clean and toxic.
    The rows that are broadcast are bounded by `sample`."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    chosen = checkpointed(chosen)
    # Of rows that repeat an id that with the smallest digest is learned from, so reruns agree.
    rows = checkpointed(
        docs.join(F.broadcast(chosen), "id")
        .groupBy("id", "toxic")
        .agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    )
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    return rows, counts.get(0, 0), counts.get(1, 0)


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        families = [_family(_terms(text)[1]) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(families, pa.int64())], names=["toxic", "family"]
        )


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, most=1 << 20):
        toxic, kinds, terms, families = [], [], [], []
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            distinct, words = _terms(text)
            family = _family(words)
            for kind in (0, *_BEGINNINGS):
                found = {w[:kind] for w in distinct if len(w) >= kind} if kind else distinct
                terms += found
                kinds += [kind] * len(found)
                toxic += [label] * len(found)
                families += [family] * len(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(toxic, pa.int32()),
                pa.array(kinds, pa.int32()),
                pa.array(terms, pa.string()),
                pa.array(families, pa.int64()),
            ],
            names=["toxic", "kind", "term", "family"],
        )


def _learn_lexicons(sample: DataFrame, terms: int) -> Model:
    model = Model()
    labelled = sample.select("toxic", "text")
    families = labelled.mapInArrow(_families, "toxic int, family long").distinct()
    total = {r["toxic"]: r["count"] for r in families.groupBy("toxic").count().collect()}
    counted = (
        labelled.mapInArrow(_term_rows, "toxic int, kind int, term string, family long")
        .distinct()
        .groupBy("kind", "term")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .filter(F.col("toxic") >= SUPPORT)
    )
    lift = F.col("toxic") / total[1] >= LIFT * F.col("clean") / total[0]
    marks = checkpointed(counted.filter(lift))
    for kind in (0, *_BEGINNINGS):
        # Bounded: the best supported terms of each kind.
        best = marks.filter(F.col("kind") == kind).orderBy(F.desc("toxic"), "term").limit(terms)
        lexicon, shards = (model.starts[kind], 2) if kind else (model.words, SHARDS)
        lexicon.update((r["term"], shard(r["term"], shards)) for r in best.select("term").collect())
    return model


def label_model(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 30
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(prior, fires, weights, correlations) from vote patterns (rows of 0 and 1) and their
    counts. `fires[y, j]` is how often voter j fires on label y."""
    total = counts.sum()
    lexical = patterns[:, : SHARDS + 4].sum(axis=1) + 2 * patterns[:, SHARDS + 6]
    toxic = 1 / (1 + np.exp(-(2.0 * lexical - 3.0)))
    weights = np.ones(patterns.shape[1])
    correlations = np.zeros((2, patterns.shape[1], patterns.shape[1]))
    prior, fires = 0.0, np.zeros((2, patterns.shape[1]))
    for _ in range(rounds):
        prior = float(np.clip((counts * toxic).sum() / total, 1e-6, 1 - 1e-6))
        for label, share in ((0, 1 - toxic), (1, toxic)):
            mass = counts * share
            fires[label] = (mass @ patterns + 0.1) / (mass.sum() + 0.2)
            apart = (patterns - fires[label]) / np.sqrt(fires[label] * (1 - fires[label]))
            correlations[label] = (apart * mass[:, None]).T @ apart / (mass.sum() + 1e-9)
        shared = np.clip(
            prior * correlations[1] + (1 - prior) * correlations[0], 0, 1
        )
        np.fill_diagonal(shared, 0)
        weights = 1 / (1 + shared.sum(axis=1))
        toxic = posterior(patterns, prior, fires, weights)
    return prior, fires, weights, correlations


def posterior(patterns: np.ndarray, prior: float, fires: np.ndarray, weights: np.ndarray) -> np.ndarray:
    fired = np.log(fires[1] / fires[0])
    silent = np.log((1 - fires[1]) / (1 - fires[0]))
    odds = math.log(prior / (1 - prior)) + (patterns * fired + (1 - patterns) * silent) @ weights
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _bits(votes: np.ndarray) -> np.ndarray:
    return (votes[:, None] >> np.arange(VOTERS) & 1).astype(float)


def logistic_regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for soft labels `y`; the first column is the constant."""
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-3
    coefficients = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30)))
        slope = x.T @ (p - y) + penalty @ coefficients
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        coefficients -= step
        if np.abs(step).max() < 1e-6:
            break
    return coefficients


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    terms: int = TERMS,
) -> Model:
    """Learn from `labels` (doc_id, toxic), without the held-out rows, and the votes on all of
    `docs`. Labels that are null, neither 0 nor 1, or of no document are left out; of labels
    that repeat an id the largest counts. Without both kinds of labels every score is the share
    of toxic labels."""
    texts = ids_and_texts(docs, id_col, text_col)
    rows, clean, toxic = _sampled(texts, labels, sample)
    if not clean or not toxic:
        return Model(prior=toxic / max(1, toxic + clean))
    model = _learn_lexicons(rows, terms)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in pieces(batches):
            seen.update(measure(text, model)[0] for text in batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
            names=["votes", "n"],
        )

    histogram = (
        texts.select("text")
        .mapInArrow(votes, "votes long, n long")
        .groupBy("votes")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    model.prior, model.fires, model.weights, model.correlations = label_model(
        _bits(histogram["votes"].to_numpy()), histogram["n"].to_numpy().astype(float)
    )

    def measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [measure(text, model) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array([v for v, _ in found], pa.int64()),
                    pa.array([f for _, f in found], pa.list_(pa.float64())),
                ],
                names=["toxic", "votes", "features"],
            )

    learned = (
        rows.select("id", "toxic", "text")
        .mapInArrow(measures, "toxic int, votes long, features array<double>")
        .toPandas()
        .sort_values(["toxic", "votes"], kind="stable")
    )
    given = learned["toxic"].to_numpy()
    guess = posterior(_bits(learned["votes"].to_numpy()), model.prior, model.fires, model.weights)
    guess = np.clip(guess, 1e-9, 1 - 1e-9)
    odds = np.log(guess / (1 - guess)) + np.where(given == 1, 1, -1) * math.log(TRUST / (1 - TRUST))
    model.coefficients = logistic_regression(
        np.stack(learned["features"].to_numpy()), 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    )
    return model


def score_text(text: str, model: Model) -> float:
    if model.coefficients is None:
        return model.prior
    odds = float(np.dot(measure(text, model)[1], model.coefficients))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns; nothing is shuffled.

    A null text counts as an empty one; repeated rows stay or go together, and an empty table gives
    an empty result. Texts are scored a few at a time, so long ones do not add up.
    """

    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        scores = [score_text(t or "", model) for part in pieces([batch]) for t in part.column("text").to_pylist()]
        return pa.array(scores, pa.float64())

    return docs.filter(toxic(F.col(f"`{text_col}`").cast("string")) < THRESHOLD)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is an input of the score; a null text scores as an empty one. A null id is
    not held out; repeated rows each give a row; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = [score_text(text, model) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"]
            )

    scored = ids_and_texts(docs, id_col, text_col).mapInArrow(run, "id long, score double")
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
