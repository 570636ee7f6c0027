"""Language identification of whole and mixed texts.

Script ranges narrow the candidates of a word, hashed character grams score it
under each candidate, and Viterbi with a switching penalty labels the words of a
text, so that spans of different languages come out as spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import batches, slices, texts
from ludometry.llm.words import WordTable, gram_buckets, letter_pattern

UNKNOWN = "und"
BUCKETS = 1 << 15
SEGMENT = 256
PLACES = 1 << 30
SLICE = 2 << 20

# First code points of blocks of scripts, and the script's number
# (0: any other). Latin 1, Greek 2, Cyrillic 3, Armenian 4, Hebrew 5, Arabic 6,
# Indic 7, Thai and Lao 8, Georgian 9, Hangul 10, Kana 11, Han 12.
SCRIPTS = [
    (0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0900, 7),
    (0x0E00, 8), (0x0F00, 0), (0x10A0, 9), (0x1100, 10), (0x1200, 0), (0x1E00, 1), (0x1F00, 2),
    (0x2000, 0), (0x3040, 11), (0x3100, 0), (0x3400, 12), (0xA000, 0), (0xAC00, 10), (0xD7B0, 0),
    (0xF900, 12), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFF21, 1), (0xFF66, 11),
    (0xFFA0, 10), (0xFFE0, 0), (0x20000, 12), (0x323B0, 0),
]
_STARTS = np.array([start for start, _ in SCRIPTS])
_NUMBERS = np.array([number for _, number in SCRIPTS])
_IMPOSSIBLE = np.float32(-1e4)


def script_of(word: str) -> int:
    return int(_NUMBERS[np.searchsorted(_STARTS, ord(word[0]), side="right") - 1])


@dataclass(frozen=True)
class Model:
    """What the words of each language look like; a few MB for a dozen languages."""

    languages: tuple[str, ...]
    gram_scores: np.ndarray  # buckets x languages, log probabilities
    candidates: np.ndarray  # scripts x languages, whether the language uses the script
    penalty: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Words x languages: log likelihood where the script allows the language."""
        buckets, owners = gram_buckets((word.lower() for word in words), len(self.gram_scores))
        scores = np.stack(
            [np.bincount(owners, self.gram_scores[buckets, k], len(words)) for k in range(len(self.languages))],
            axis=1,
        ).astype(np.float32)
        scripts = np.fromiter(map(script_of, words), dtype=np.int64, count=len(words))
        scores[~self.candidates[scripts]] = _IMPOSSIBLE
        return scores


def _counted(rows: DataFrame) -> DataFrame:
    """(lang, kind, place, n): gram buckets (kind 0) and scripts (kind 1) of the words."""
    schema_text = "lang string, kind int, place int, n double"
    schema = batches(schema_text)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                langs = np.array(part["lang"].to_pylist(), dtype=object)
                words = WordTable()
                ids = [words.ids(text or "") for text in part["text"].to_pylist()]
                names = words.words
                buckets, owners = gram_buckets((word.lower() for word in names), BUCKETS)
                scripts = np.fromiter(map(script_of, names), dtype=np.int64, count=len(names))
                for lang in sorted(set(langs)):
                    own = [ids[k] for k in np.flatnonzero(langs == lang)]
                    times = np.bincount(np.concatenate(own), minlength=len(names)).astype(float)
                    for kind, counts in (
                        (0, np.bincount(buckets, times[owners], BUCKETS)),
                        (1, np.bincount(scripts, times)),
                    ):
                        place = np.flatnonzero(counts)
                        columns = [[lang] * len(place), [kind] * len(place), place, counts[place]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                        )

    return rows.mapInArrow(run, schema_text)


def train(docs: DataFrame, bound: int = 4_000, penalty: float = 8.0, share: float = 1e-3) -> Model:
    """A model from rows of text and lang.

    Of each language about ``bound`` different texts are read, at least one, chosen
    by a hash of the text, so that the driver's share (one number per bucket and
    language) and what is learned from do not grow with the corpus, and a text
    counts once however many copies it has. Rows with a null text or lang teach nothing. A
    language may be given to a word if ``share`` of its words are in the script.
    """
    rows = docs.select(F.col("text"), F.col("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    # Texts are told apart by their hashes to be counted, and by themselves to be read.
    hashes = rows.select("lang", F.xxhash64("text").alias("hash")).distinct()
    place = F.pmod("hash", F.lit(PLACES))
    found = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).collect()
    # A text is drawn if its place is under that of its language.
    places = {row["lang"]: max(int(PLACES * min(1.0, bound / row["n"])), row["first"] + 1) for row in found}
    languages = tuple(sorted(places))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((13, 0), bool), penalty)
    limits = F.create_map(*(F.lit(x) for pair in places.items() for x in pair))
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(PLACES)) < limits[F.col("lang")]).distinct()
    counted = _counted(drawn).groupBy("lang", "kind", "place").agg(F.sum("n").alias("n"))
    grams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((13, len(languages)))
    for lang, kind, place_, n in counted.toPandas().itertuples(index=False):
        (grams if kind == 0 else scripts)[place_, languages.index(lang)] = n
    grams += 0.5
    scores = np.log(grams / grams.sum(axis=0))
    used = scripts >= share * np.maximum(scripts.sum(axis=0), 1)
    used[~used.any(axis=1)] = True  # a script of no language leaves all candidates
    return Model(languages, scores.astype(np.float32), used, penalty)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float, segment: int = SEGMENT) -> np.ndarray:
    """The best label of every word: the sum of scores less the penalty of each switch.

    ``scores`` holds the words of all texts one after another, ``lengths`` the
    words of each. Texts are cut into segments whose transfer matrices are
    computed side by side, then chained, so long texts cost no more a word than
    short ones. The result is the exact optimum; ties go to the smaller label.
    """
    total, labels = len(scores), scores.shape[1]
    if not total:
        return np.zeros(0, np.int16)
    counts = -(-lengths // segment)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (np.cumsum(lengths) - lengths)[text] + nth * segment
    sizes = np.minimum(segment, lengths[text] - nth * segment)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, text, nth = starts[order], sizes[order], text[order], nth[order]
    active = [int(np.searchsorted(-sizes, -step, side="left")) for step in range(segment)]

    def step(state: np.ndarray, t: int, live: int) -> np.ndarray:
        best = state[:live].max(axis=-1, keepdims=True) - penalty
        words = scores[starts[:live] + t]
        return np.maximum(state[:live], best) + (words[:, None, :] if state.ndim == 3 else words)

    transfer = np.full((len(starts), labels, labels), -np.inf)
    transfer[:, np.arange(labels), np.arange(labels)] = 0
    for t in range(int(sizes[0])):
        transfer[: active[t]] = step(transfer, t, active[t])

    rounds = [np.flatnonzero(nth == k) for k in range(int(nth.max()) + 1)]
    rounds = [own[np.argsort(text[own])] for own in rounds]
    entered = np.zeros((len(starts), labels))
    value = np.zeros((len(lengths), labels))
    for own in rounds:
        entered[own] = value[text[own]]
        value[text[own]] = (entered[own][:, :, None] + transfer[own]).max(axis=1)
    last = np.zeros(len(starts), dtype=np.int64)
    ending = value.argmax(axis=1)
    for own in reversed(rounds):
        last[own] = ending[text[own]]
        ending[text[own]] = (entered[own] + transfer[own, :, last[own]]).argmax(axis=1)

    came = np.empty((int(sizes[0]), len(starts), labels), dtype=np.int16)
    state = entered
    for t in range(int(sizes[0])):
        live = active[t]
        best = state[:live].argmax(axis=1)
        top = np.take_along_axis(state[:live], best[:, None], axis=1) - penalty
        came[t, :live] = np.where(state[:live] >= top, np.arange(labels), best[:, None])
        state[:live] = step(state, t, live)
    out = np.zeros(total, dtype=np.int16)
    label = last
    for t in range(int(sizes[0]) - 1, -1, -1):
        live = active[t]
        out[starts[:live] + t] = label[:live]
        label[:live] = came[t, np.arange(live), label[:live]]
    return out


def _labelled(model: Model, values: list[str | None]) -> tuple[list[np.ndarray], list[str], np.ndarray]:
    """Word numbers of each text, the words, and the label of each word of all texts."""
    words = WordTable()
    ids = [words.ids(text or "") for text in values]
    if not model.languages:
        return ids, words.words, np.zeros(sum(map(len, ids)), np.int16)
    scores = model.word_scores(words.words)
    joined = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return ids, words.words, viterbi(scores[joined], np.array([len(x) for x in ids]), model.penalty)


def _per_part(docs: DataFrame, model: Model, schema: str, columns) -> DataFrame:
    arrow = batches(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                made = columns(model, part["text"].to_pylist())
                arrays = [part["doc_id"], *(pa.array(c, f.type) for c, f in zip(made, list(arrow)[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return texts(docs).mapInArrow(run, schema)


def _predicted(model: Model, values: list[str | None]) -> tuple[list[str], list[float]]:
    ids, words, labels = _labelled(model, values)
    if not model.languages:
        return [UNKNOWN] * len(values), [0.0] * len(values)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    lengths = np.array([len(x) for x in ids])
    owner = np.repeat(np.arange(len(ids)), lengths)
    letters = np.bincount(
        owner * len(model.languages) + labels,
        sizes[np.concatenate(ids)] if len(owner) else None,
        len(ids) * len(model.languages),
    ).reshape(len(ids), -1)
    best = letters.argmax(axis=1)
    share = letters.max(axis=1) / np.maximum(letters.sum(axis=1), 1)
    names = [model.languages[k] if n else UNKNOWN for k, n in zip(best, lengths, strict=True)]
    return names, share.tolist()


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row of (doc_id, text).

    The language with most letters in the labelled spans, and its share of the
    letters. Texts that are null or without a letter are ``und`` with score 0;
    so is everything under a model of no language. Ties go to the first name.
    Repeated rows give repeated rows; other columns are left behind.
    """
    return _per_part(docs, model, "doc_id long, lang_pred string, score double", _predicted)


def confident(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents, all columns, with a language that has ``least`` of their letters.

    Null texts, texts without a letter and even mixtures of many languages go. Rows
    that share a doc_id, or have none, are judged each on its own; an empty table
    gives an empty result.
    """
    schema = docs.schema
    share = docs.sparkSession.sparkContext.broadcast(model)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                names, scores = _predicted(share.value, part["text"].to_pylist())
                keep = [name != UNKNOWN and score >= least for name, score in zip(names, scores, strict=True)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def _spans(model: Model, values: list[str | None]) -> tuple[list[list[dict]]]:
    ids, _, labels = _labelled(model, values)
    out, at = [], 0
    for text, own in zip(values, ids, strict=True):
        spans: list[dict] = []
        if model.languages:
            for found, label in zip(letter_pattern(text or "").finditer(text or ""), labels[at : at + len(own)], strict=True):
                lang = model.languages[label]
                if spans and spans[-1]["lang"] == lang:
                    spans[-1]["end"] = found.end()
                else:
                    spans.append({"start": found.start(), "end": found.end(), "lang": lang})
        at += len(own)
        out.append(spans)
    return (out,)


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the spans [start, end) of each language, in code points, in order."""
    schema = "doc_id long, spans array<struct<start:long,end:long,lang:string>>"
    return _per_part(docs, model, schema, _spans)


def held_out(key: str, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the key as text falls into the fold kept from training."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold
