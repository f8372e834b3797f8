"""Quality classifier (operator 1): a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good (1), bad (0) or abstain (-) on every
whole text.  The corpus is reduced to counts of vote patterns (at most 3 ** 11
rows, whatever its size); expectation-maximisation on these estimates each
labeller's votes given the true class (not voting tells nothing), and with them
a pattern's posterior.
Posterior labels train a logistic scorer on DIM hashed features; the training
sample is bounded (SAMPLE rows, first by hash of the id, DIM numbers each), the
counts and the scores cover all documents.

Defined results: null text is empty; an empty text has no features and gets the
scorer's bias; repeated rows are judged each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpointed

DIM = 4096
SAMPLE = 4000
ROUNDS, STEPS = 60, 300
KEEP = 0.5
UPPER = bytes(range(65, 91))
MARKS = b"#*$%&|<>"
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
USUAL_END = frozenset([*LETTERS, *range(48, 58), *b".,;:!?'\")"])
LABELLERS = 11
SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
RUN = re.compile(rb"(.)\1+", re.S)


def _vote(value: float, good: float, bad: float) -> str:
    """Good at or beyond `good`, bad at or beyond `bad`, between them no vote."""
    if good < bad:
        value, good, bad = -value, -good, -bad
    return "1" if value >= good else "0" if value <= bad else "-"


def votes(text: str) -> str:
    """One character for each labeller; each kind of junk is seen by several of them."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    if not n:
        return "0" * LABELLERS
    many = n >= 20
    letters = size - len(raw.translate(None, LETTERS))
    marks = size - len(raw.translate(None, MARKS))
    upper = size - len(raw.translate(None, UPPER))
    again = sum(map(operator.eq, words, words[1:]))
    odd = n - sum(map(USUAL_END.__contains__, [w[-1] for w in words]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    return "".join((
        _vote(marks / size, 0.004, 0.02),  # symbols
        _vote(odd / n, 0.05, 0.2),  # words that end in neither a letter nor a common mark
        _vote(letters / (size - n + 1), 0.93, 0.85),  # letters among what is not space
        _vote(upper / size, 0.08, 0.3),  # capitals
        _vote(sum(map(bytes.isupper, words)) / n, 0.15, 0.4),  # words in capitals
        _vote(raw.count(b"!") / n, 0.05, 0.2),  # shouting
        _vote(again / n, 0.03, 0.1),  # the same word again
        _vote(len(set(words)) / n, 0.3, 0.12) if many else "-",  # variety of words
        _vote(len(set(zip(words, words[1:]))) / n, 0.6, 0.3) if many else "-",  # variety of word pairs
        _vote(ended / len(lines), 0.5, 0.05) if many else "-",  # lines that end as sentences
        _vote(abs(len(raw) / n - 6.5), 3.0, 8.0) if many else "-",  # word length
    ))


def features(text: str, shapes: dict[bytes, int]) -> np.ndarray:
    """DIM numbers: shares of the hashed words (first half) and of their hashed shapes (second half).

    shapes: a memo of the shapes' bins, which the caller keeps.
    """
    raw = text.encode()
    words, half = raw.lower().split(), DIM // 2
    out = np.zeros(DIM, dtype=np.float32)
    if not words:
        return out
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    spelled = raw.translate(SHAPE).split()
    bins = []
    for s in spelled:
        b = shapes.get(s)
        if b is None:
            if len(shapes) > 100_000:
                shapes.clear()
            b = shapes[s] = xxhash.xxh3_64_intdigest(RUN.sub(rb"\1+", s)) % (half - 2)
        bins.append(b)
    again = int((h[1:] == h[:-1]).sum())
    out[:half] = np.bincount((h % np.uint64(half)).astype(np.int64), minlength=half)
    out[half:] = np.bincount(bins, minlength=half)
    out[DIM - 1], out[DIM - 2] = again, len(words) - len(np.unique(h))
    return out / len(words)


class LabelModel:
    """P(vote | class) of each labeller, by expectation-maximisation on pattern counts."""

    def __init__(self, counts: dict[str, int], rounds: int = ROUNDS):
        patterns = sorted(counts)
        table = np.array([["01-".index(v) for v in p] for p in patterns], dtype=np.int64).reshape(len(patterns), LABELLERS)
        weight = np.array([counts[p] for p in patterns], dtype=np.float64)
        ballots = np.array([[p.count("1"), p.count("0")] for p in patterns], dtype=np.float64).reshape(-1, 2)
        good = (ballots[:, 0] + 1) / (ballots.sum(axis=1) + 2)  # from the majority, which fixes what the classes mean
        for _ in range(rounds if len(patterns) else 0):
            share = np.stack([weight * (1 - good), weight * good])
            prior = (share.sum(axis=1) + 1) / (weight.sum() + 2)
            log = np.tile(np.log(prior)[:, None], (1, len(patterns)))
            for k in range(table.shape[1]):
                said = np.stack([np.bincount(table[:, k], weights=s, minlength=3) for s in share])[:, :2] + 1
                said /= said.sum(axis=1, keepdims=True)
                log += np.hstack([np.log(said), np.zeros((2, 1))])[:, table[:, k]]
            good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        self.posterior = dict(zip(patterns, good.tolist()))


def fit(x: np.ndarray, target: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Logistic weights (bias last) for soft targets, by accelerated gradient descent with L2."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    # the two classes weigh the same, however rare one is
    balance = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead, rate = w.copy(), 2.0
    for step in range(steps):
        error = (1 / (1 + np.exp(-x @ ahead)) - target) * balance
        new = ahead - rate * (x.T @ error + 1e-4 * ahead)
        ahead = new + step / (step + 3) * (new - w)
        w = new
    return w


def weak_quality(docs: DataFrame, id_col: str = "doc_id", keep: float = KEEP) -> DataFrame:
    """id_col, votes, posterior (label model), score (linear scorer), kept (score reaches `keep`)."""
    dtype, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce("text", F.lit("")).alias("__text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [votes(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), batch.column(2)], names=["__id", "votes", "__hash"])

    # rows are told apart by id and text, so that an id with several texts gives its sample the votes of the text that is taken
    rows = rows.withColumn("__hash", F.xxhash64("__text"))
    voted = checkpointed(rows.mapInArrow(vote, f"__id {dtype}, votes string, __hash long"))
    counts = {r[0]: r[1] for r in voted.groupBy("votes").count().collect()}
    model = LabelModel(counts)
    chosen = voted.where("__id is not null").groupBy("__id").agg(F.min(F.struct("votes", "__hash")).alias("own"))
    chosen = chosen.select("__id", "own.votes", "own.__hash").orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[bytes, int] = {}
        for batch in batches:
            x = [features(t, shapes).astype(np.float16).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["votes", "x"])

    sample = (
        rows.join(F.broadcast(chosen), ["__id", "__hash"]).select("votes", "__text", "__id").dropDuplicates(["__id"])
        .select("votes", "__text").mapInArrow(featured, "votes string, x binary").toArrow()
    )
    if sample.num_rows:
        x = np.stack([np.frombuffer(b, np.float16) for b in sample.column("x").to_pylist()]).astype(np.float32)
        weights = fit(x, np.array([model.posterior[v] for v in sample.column("votes").to_pylist()], dtype=np.float32))
    else:
        weights = np.zeros(DIM + 1, dtype=np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((weights, model.posterior))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, posterior = shared.value
        shapes: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            said = [votes(t) for t in texts]
            score = [1 / (1 + math.exp(-float(features(t, shapes) @ weights[:-1] + weights[-1]))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), pa.array(said, pa.string()), pa.array([posterior[v] for v in said], pa.float64()), pa.array(score, pa.float64())],
                names=[id_col, "votes", "posterior", "score"],
            )

    out = rows.mapInArrow(judge, f"`{id_col}` {dtype}, votes string, posterior double, score double")
    return out.withColumn("kept", F.col("score") >= keep)
