"""Language identification by a mixture of languages per document.

Byte trigrams of padded words are counted per language over all training documents and
kept in hashed buckets, so that the model is a table of languages x buckets. A word has
a likelihood under each language; expectation-maximisation estimates which shares of the
languages explain the words of a document, and a penalty per language keeps the set of
languages as small as the words allow. The prediction is the language of largest share. A text
is foreign if a model that knows no language, in which all buckets are alike, explains its words
better than its mixture does, by more than that penalty; one word counts for so much at most.

The model is one table in every task. ``train`` refuses more than ``MOST_LANGUAGES`` languages
before any of it is collected, and the text that a task holds at once shrinks with their number.

Case table: a null text or one without letters is ``und`` with score 0, as is every text
if there are no training rows; rows with a null ``lang`` are predicted but not learned
from; equal shares go to the alphabetically first language; repeated rows are predicted
each; extra columns pass through; a null ``doc_id`` gives a null ``held_out`` and is learned
from; a very long text is a run of its own."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.words import byte_table, coded, column_of, flat_bytes, released, slices, split_words, spread

BUCKETS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 2.0
UNKNOWN = "und"
FOREIGN_WORD = 4.0  # a single word, such as a long key, speaks no louder against all languages
MOST_LANGUAGES = 1_000
PREDICT_BYTES = 2_000_000  # text per run, for up to 16 languages: each word holds a number per language

# words of letters: a-z and everything beyond ASCII
LETTERS = byte_table([range(0x41), range(0x5B, 0x61), range(0x7B, 0x80)])


@dataclass
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # buckets x languages


def grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of every word with a space on both sides, end to
    end, and where each word's begin (a word of n bytes has n)."""
    data, bounds = flat_bytes(words)
    lengths = np.diff(bounds)
    padded = np.full(len(data) + 2 * len(lengths), 32, np.uint32)
    starts = bounds[:-1] + 2 * np.arange(len(lengths))
    padded[spread(starts + 1, lengths)] = data
    first = spread(starts, lengths)
    mixed = (padded[first] * np.uint32(961) + padded[first + 1] * np.uint32(31) + padded[first + 2]) * np.uint32(2654435769)
    return (mixed >> np.uint32(17)).astype(np.int64) % BUCKETS, bounds


@released
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch):
            counts, values = split_words(part.column("text"), LETTERS)
            codes, distinct = coded(values)
            if not len(distinct):
                continue
            buckets, bounds = grams(distinct)
            langs, names = coded(part.column("lang"))
            of_word = np.repeat(langs, counts).astype(np.int64)
            seen = np.bincount(of_word * len(distinct) + codes, minlength=len(names) * len(distinct))
            for name, times in zip(names.to_pylist(), seen.reshape(len(names), -1), strict=True):
                found = np.bincount(buckets, np.repeat(times, np.diff(bounds)), BUCKETS)
                totals[name] = totals.get(name, 0) + found
    for name, found in totals.items():
        filled = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(filled), pa.string()), pa.array(filled, pa.int32()), pa.array(found[filled].astype(np.int64))],
            names=["lang", "bucket", "n"],
        )


def train(labelled: DataFrame) -> Model:
    """Model of the rows with text and language. It has languages x ``BUCKETS`` numbers,
    whatever the number of documents."""
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")
    languages = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if languages > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in column lang")
    counted = rows.mapInArrow(_count, "lang string, bucket int, n bigint")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    if languages:
        table[found["bucket"], found["lang"].map({k: i for i, k in enumerate(languages)})] += found["n"]
        table = np.log(table / table.sum(axis=0))
    return Model(languages, table.astype(np.float32))


def _mixture(evidence: np.ndarray, starts: np.ndarray, counts: np.ndarray, shares: np.ndarray):
    """Shares after ``ROUNDS`` of expectation-maximisation, and the log-likelihood."""
    for _ in range(ROUNDS):
        joint = evidence * np.repeat(shares, counts, axis=0)
        joint /= joint.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(joint, starts, axis=0) / counts[:, None]
    total = np.log((evidence * np.repeat(shares, counts, axis=0)).sum(axis=1, dtype=np.float64))
    return shares, np.add.reduceat(total, starts)


def mixtures(texts: pa.Array, model: Model) -> np.ndarray:
    """Shares of the languages in each text; a text without words has none."""
    return explained(texts, model)[0]


def explained(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each text, and whether it is foreign to all of them."""
    counts, values = split_words(texts, LETTERS)
    shares, foreign = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), bool)
    codes, distinct = coded(values)
    if not len(distinct) or not model.languages:
        return shares, foreign
    buckets, bounds = grams(distinct)
    of_word = np.add.reduceat(model.log_likelihood[buckets], bounds[:-1], axis=0)
    best = of_word.max(axis=1)
    evidence = np.exp(of_word - best[:, None]) + np.float32(1e-9)
    # how much better the model without language explains a word than the best language
    unknown = -np.log(BUCKETS) * np.diff(bounds) - best
    rows = np.flatnonzero(counts)
    evidence = evidence[codes]
    shares[rows] = _selected(evidence, counts[rows])
    starts = np.cumsum(counts[rows]) - counts[rows]
    mixed = np.log((evidence * np.repeat(shares[rows], counts[rows], axis=0)).sum(axis=1, dtype=np.float64))
    gain = np.add.reduceat(np.minimum(unknown[codes] - mixed, FOREIGN_WORD), starts)
    foreign[rows] = gain > _penalty(counts[rows])
    return shares, foreign


def _penalty(counts: np.ndarray) -> np.ndarray:
    return PENALTY * np.log(counts + 1.0) + PENALTY


def _selected(evidence: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares over the language set of the best penalised likelihood.

    Sets grow from the single best language in the order of the full mixture's shares.
    No set explains more than the full mixture, so a document whose best single
    language comes within one penalty of it is decided without further fits."""
    starts = np.cumsum(counts) - counts
    languages = evidence.shape[1]
    single = np.add.reduceat(np.log(evidence, dtype=np.float64), starts, axis=0)
    best = single.argmax(axis=1)
    chosen = np.zeros((len(counts), languages))
    chosen[np.arange(len(counts)), best] = 1.0
    if languages == 1:
        return chosen
    uniform = np.full((len(counts), languages), 1 / languages, np.float32)
    full, most = _mixture(evidence, starts, counts, uniform)
    penalty = _penalty(counts)
    reached = single.max(axis=1)
    open_rows = np.flatnonzero(most - reached > penalty)
    order = np.argsort(-full, axis=1, kind="stable")
    scores = reached.copy()
    for size in range(2, languages + 1):
        if not len(open_rows):
            break
        words = spread(starts[open_rows], counts[open_rows])
        inside = np.zeros((len(open_rows), languages), np.float32)
        np.put_along_axis(inside, order[open_rows, :size], 1 / size, axis=1)
        inner = np.cumsum(counts[open_rows]) - counts[open_rows]
        shares, fit = _mixture(evidence[words], inner, counts[open_rows], inside)
        fit = fit - (size - 1) * penalty[open_rows]
        better = fit > scores[open_rows]
        chosen[open_rows[better]] = shares[better]
        scores[open_rows[better]] = fit[better]
        open_rows = open_rows[most[open_rows] - size * penalty[open_rows] > scores[open_rows]]
    return chosen


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``row`` (a struct of the columns of ``documents``), ``lang_pred``, ``score`` (its
    share), ``lang_set`` and ``foreign``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    names = [*model.languages, UNKNOWN]
    most = PREDICT_BYTES * 16 // max(16, len(model.languages))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = documents.select(F.struct("*").alias("row"), letters.alias("letters"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "row.text", most):
                shares, foreign = explained(column_of(part, "row.text"), sent.value)
                shares[~part.column("letters").to_numpy(zero_copy_only=False)] = 0
                known = shares.sum(axis=1) > 0
                best = np.where(known, shares.argmax(axis=1) if shares.shape[1] else 0, len(names) - 1)
                score = shares.max(axis=1) if shares.shape[1] else np.zeros(part.num_rows)
                columns = {
                    "row": part.column("row"),
                    "lang_pred": pa.array([names[i] for i in best], pa.string()),
                    "score": pa.array(np.minimum(score, 1.0), pa.float64()),
                    "lang_set": pa.array([[names[i] for i in np.flatnonzero(s)] for s in shares], pa.list_(pa.string())),
                    "foreign": pa.array(foreign),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kept = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kept}, lang_pred string, score double, lang_set array<string>, foreign boolean")


def held_out(parts: int = 5) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts == 0


def report(documents: DataFrame) -> DataFrame:
    """Predicted language of every document, learned from four fifths of the ids."""
    model = train(documents.where(~F.coalesce(held_out(), F.lit(False))))
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).select("row.doc_id", "row.held_out", "lang_pred", "score", "lang_set")


def main_language(documents: DataFrame, least: float = 0.0) -> DataFrame:
    """Documents in languages that the labelled ones know. Those without letters go, those
    that are foreign to every language, and with ``least`` those in which no language has
    that share; texts of several known languages stay. A missing ``lang`` is filled in."""
    model = train(documents.where(~F.coalesce(held_out(), F.lit(False))))
    known = (F.col("lang_pred") != UNKNOWN) & ~F.col("foreign") & (F.col("score") >= least)
    found = predict(documents, model).where(known)
    lang = F.coalesce("row.lang", "lang_pred")
    return found.select(*(lang.alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in documents.columns))
