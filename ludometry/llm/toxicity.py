"""Toxic spans by a linear-chain conditional random field.

A sequence is a sentence, or 256 words of a longer one. Two states, plain and
toxic; a word speaks through itself, its first four and five letters; states
speak through their transitions. Training tokens take their labels from labelled
documents: in a toxic one, words are toxic whose form, or start, is found in
toxic documents significantly more often than in others. Forward-backward
marginals give the toxic spans; their sum and maximum give a document's score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches, slices, texts
from ludometry.llm.words import WordTable

BUCKETS = 1 << 18
TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = frozenset(".!?\n")
LONGEST = 256
SLICE = 4 << 20
# Log-likelihood ratio from which a word is taken to mark toxic documents, and
# how many times as frequent it must be there.
SIGNIFICANT, TIMES = 24.0, 12.0


def word_features(words: list[str]) -> np.ndarray:
    """Words x 3 buckets: the word, its first four and its first five letters."""
    out = np.empty((len(words), 3), dtype=np.int64)
    for k, word in enumerate(words):
        low = word.lower()
        out[k] = (
            crc32(f"w{low}".encode("utf-8", "surrogatepass")),
            crc32(f"4{low[:4]}".encode("utf-8", "surrogatepass")),
            crc32(f"5{low[:5]}".encode("utf-8", "surrogatepass")),
        )
    return out & (BUCKETS - 1)


@dataclass
class Sequences:
    """Words of some texts and the sequences they form."""

    words: list[str]
    ids: np.ndarray  # word number of every word, text after text
    owner: np.ndarray  # text of every word
    starts: np.ndarray  # first word of every sequence
    lengths: np.ndarray
    count: int  # of texts

    @classmethod
    def of(cls, values: list[str | None]) -> Sequences:
        table = WordTable(TOKENS)
        tokens = [table.ids(value or "") for value in values]
        names = table.words
        ends = np.fromiter((name in ENDS for name in names), dtype=bool, count=len(names))
        sizes = np.array([len(x) for x in tokens], dtype=np.int64)
        joined = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
        owner = np.repeat(np.arange(len(tokens)), sizes)
        end = ends[joined] if len(joined) else np.zeros(0, bool)
        sentence = np.cumsum(end) + owner  # grows at each end and each text
        word = ~end
        ids, owner, sentence = joined[word], owner[word], sentence[word]
        fresh = np.flatnonzero(np.diff(sentence, prepend=-1))
        nth = np.arange(len(ids)) - np.repeat(fresh, np.diff(fresh, append=len(ids)))
        starts = np.flatnonzero(nth % LONGEST == 0)
        return cls(names, ids, owner, starts, np.diff(starts, append=len(ids)), len(values))


@dataclass
class Model:
    """Weights of the word buckets, transitions, and how marginals make a score."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = -4.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def emissions(self, words: list[str]) -> np.ndarray:
        """What each word adds for the toxic state; the plain state gets 0."""
        return self.weights[word_features(words)].sum(axis=1) + self.bias if words else np.zeros(0)


def forward_backward(emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state and the expected transitions.

    ``emission`` is sequences x steps, NaN beyond the end of a sequence.
    """
    rows, steps = emission.shape
    live = ~np.isnan(emission)
    scores = np.stack((np.zeros_like(emission), np.where(live, emission, 0)), axis=2)
    ahead = np.zeros((rows, steps, 2))
    back = np.zeros((rows, steps, 2))
    ahead[:, 0] = scores[:, 0]
    for t in range(1, steps):
        step = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1])
        ahead[:, t] = step + scores[:, t]
    for t in range(steps - 2, -1, -1):
        after = scores[:, t + 1] + back[:, t + 1]
        step = np.logaddexp(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
        back[:, t] = np.where(live[:, t + 1, None], step, 0)
    both = ahead + back
    total = np.logaddexp(both[..., 0], both[..., 1])
    marginal = np.exp(both[..., 1] - total)
    expected = np.zeros((2, 2))
    for i in range(2):
        for j in range(2):
            joint = ahead[:, :-1, i] + moves[i, j] + scores[:, 1:, j] + back[:, 1:, j] - total[:, 1:]
            expected[i, j] = np.exp(joint)[live[:, 1:]].sum()
    return np.where(live, marginal, 0.0), expected


def _grid(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(int(lengths.max()))
    live = steps < lengths[:, None]
    return np.where(live, starts[:, None] + steps, 0), live


def marginals(model: Model, sequences: Sequences, rows: int = 4096) -> np.ndarray:
    """The probability of the toxic state for every word."""
    emission = model.emissions(sequences.words)[sequences.ids] if len(sequences.ids) else np.zeros(0)
    out = np.zeros(len(emission))
    order = np.argsort(sequences.lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = max(1, int(sequences.lengths[order[min(at + rows, len(order)) - 1]]))
        own = order[at : at + max(64, rows * 16 // longest)]
        own = own[:rows]
        at += len(own)
        place, live = _grid(sequences.starts[own], sequences.lengths[own])
        found, _ = forward_backward(np.where(live, emission[place], np.nan), model.moves)
        out[place[live]] = found[live]
    return out


def aggregates(sequences: Sequences, marginal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, the expected number of toxic words and the surest word's marginal."""
    expected = np.bincount(sequences.owner, marginal, sequences.count)
    surest = np.zeros(sequences.count)
    np.maximum.at(surest, sequences.owner, marginal)
    return expected, surest


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def scores(model: Model, sequences: Sequences, marginal: np.ndarray) -> np.ndarray:
    expected, surest = aggregates(sequences, marginal)
    a, b, c = model.calibration
    return _sigmoid(a + b * np.log1p(expected) + c * surest)


def _token_labels(sequences: Sequences, features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for words of toxic texts whose form or start marks toxic texts.

    Uses are counted by different neighbours, a word before and one after, and
    not by texts: the words of a text that was copied often do not count often.
    """
    first = np.zeros(len(sequences.ids), dtype=bool)
    first[sequences.starts] = True
    before = np.where(first, -1, np.roll(sequences.ids, 1)).astype(np.int64)
    after = np.where(np.roll(first, -1), -1, np.roll(sequences.ids, -1)).astype(np.int64)
    uses = np.stack((toxic[sequences.owner], sequences.ids, before, after), axis=1)
    order = np.lexsort(uses.T)
    uses = uses[order[np.any(np.diff(uses[order], axis=0, prepend=-2) != 0, axis=1)]]
    n1, n0 = max(int(uses[:, 0].sum()), 1), max(int((1 - uses[:, 0]).sum()), 1)
    marks = np.zeros(len(sequences.words), dtype=bool)
    for own in features.T:
        t = np.bincount(own[uses[uses[:, 0] == 1, 1]], minlength=BUCKETS)
        c = np.bincount(own[uses[uses[:, 0] == 0, 1]], minlength=BUCKETS)
        rate = (t + c) / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 2 * (np.where(t, t * np.log(t / (n1 * rate)), 0) + np.where(c, c * np.log(c / (n0 * rate)), 0))
        marks |= ((gain > SIGNIFICANT) & (t / n1 > TIMES * (c + 0.5) / n0))[own]
    return (marks[sequences.ids] & (toxic[sequences.owner] == 1)).astype(float)


def fit(values: list[str | None], toxic: list[int], weight: float = 1.0, epochs: int = 8, seed: int = 7) -> Model:
    """A model from texts and their labels; ``weight`` is that of a text labelled 0.

    Sequences with toxic words and as many others are learned by AdaGrad on the
    conditional likelihood; the score is a logistic regression on the marginals.
    """
    model = Model()
    labels = np.array(toxic, dtype=np.int64)
    if not len(labels) or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.0
        model.calibration = (6.0 * (2 * share - 1), 0.0, 0.0)
        return model
    sequences = Sequences.of(values)
    features = word_features(sequences.words) if sequences.words else np.zeros((0, 3), np.int64)
    wanted = _token_labels(sequences, features, labels)
    marked = np.add.reduceat(wanted, sequences.starts) > 0 if len(wanted) else np.zeros(0, bool)
    random = np.random.default_rng(seed)
    positive = np.flatnonzero(marked)
    others = random.permutation(np.flatnonzero(~marked))[: 2 * len(positive) + 1000]
    chosen = np.concatenate((positive, others))
    squares, bias_square, move_squares = np.full(BUCKETS, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(epochs):
        # Sequences of about one length share a batch, batches come in any order.
        mixed = chosen[np.argsort(sequences.lengths[chosen] * random.uniform(0.9, 1.1, len(chosen)))]
        groups = np.array_split(mixed, max(1, len(mixed) // 256))
        for own in (groups[k] for k in random.permutation(len(groups))):
            if not len(own):
                continue
            place, live = _grid(sequences.starts[own], sequences.lengths[own])
            buckets = features[sequences.ids[place]]
            emission = model.weights[buckets].sum(axis=2) + model.bias
            marginal, expected = forward_backward(np.where(live, emission, np.nan), model.moves)
            truth = np.where(live, wanted[place], 0)
            error = np.where(live, truth - marginal, 0)
            touched, at = np.unique(buckets[live], return_inverse=True)
            gradient = np.bincount(at.ravel(), np.repeat(error[live], 3)) / len(own)
            gradient -= 1e-5 * model.weights[touched]
            squares[touched] += gradient**2
            model.weights[touched] += 0.5 * gradient / np.sqrt(squares[touched])
            push = error.sum() / len(own)
            bias_square += push**2
            model.bias += 0.2 * push / np.sqrt(bias_square)
            pairs = np.zeros((2, 2))
            inside = live[:, 1:]
            np.add.at(pairs, (truth[:, :-1][inside].astype(int), truth[:, 1:][inside].astype(int)), 1)
            turn = (pairs - expected) / len(own)
            move_squares += turn**2
            model.moves += 0.1 * turn / np.sqrt(move_squares)
    expected, surest = aggregates(sequences, marginals(model, sequences))
    rows = np.stack((np.ones(len(labels)), np.log1p(expected), surest), axis=1)
    weights = np.where(labels == 1, 1.0, weight)
    beta = np.zeros(3)
    for _ in range(50):  # Newton's method with a small ridge
        p = _sigmoid(rows @ beta)
        slope = rows.T @ (weights * (labels - p)) - 0.1 * beta
        curve = (rows * (weights * p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(3)
        beta += np.linalg.solve(curve, slope)
    model.calibration = tuple(beta.tolist())
    return model


def train(docs: DataFrame, labels: DataFrame, bound: int = 2_000, longest: int = 50_000) -> Model:
    """A model from documents and their labels (doc_id, toxic).

    Of each class about ``bound`` labelled rows are read, chosen by a hash of
    doc_id, and none of over ``longest`` characters, so that what the driver
    holds does not grow. Rows with a null label, id or text teach nothing; of
    several labels of a document the highest counts.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    own = own.dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {row["toxic"]: row["n"] for row in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = {kind: min(1.0, bound / max(sizes.get(kind, 0), 1)) for kind in (0, 1)}
    chosen = own.filter(place < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = (
        texts(docs)
        .filter(F.length("text") <= longest)
        .join(F.broadcast(chosen), "doc_id")  # about twice the bound at most
        .select("doc_id", "text", "toxic")
        .toPandas()
        .sort_values(["doc_id", "text"])
    )
    return fit(rows["text"].tolist(), rows["toxic"].tolist(), share[1] / share[0] if sizes else 1.0)


def _per_part(docs: DataFrame, model: Model, schema: str, columns) -> DataFrame:
    arrow = batches(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                values = part["text"].to_pylist()
                made = columns(model, values, sequences := Sequences.of(values), marginals(model, sequences))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(made, arrow[1].type)], schema=arrow)

    return texts(docs).mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of (doc_id, text), each text whole.

    Null and empty texts have no toxic word and get the score of that. Repeated
    rows give repeated rows; other columns are left behind.
    """

    def column(model, values, sequences, marginal):
        return scores(model, sequences, marginal)

    return _per_part(docs, model, "doc_id long, score double", column)


def spans(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id and its toxic spans [start, end) in code points, with their surest marginal.

    Neighbouring words of a sentence at ``least`` or more are one span.
    """

    def column(model, values, sequences, marginal):
        out, at, first = [], 0, set(sequences.starts.tolist())
        for value in values:
            own: list[dict] = []
            joined = False
            for found in TOKENS.finditer(value or ""):
                if found[0] in ENDS:
                    joined = False
                    continue
                sure = float(marginal[at])
                if sure >= least and joined and at not in first:
                    own[-1] = {"start": own[-1]["start"], "end": found.end(), "score": max(own[-1]["score"], sure)}
                elif sure >= least:
                    own.append({"start": found.start(), "end": found.end(), "score": sure})
                joined = sure >= least
                at += 1
            out.append(own)
        return out

    return _per_part(docs, model, "doc_id long, spans array<struct<start:long,end:long,score:double>>", column)
