"""Toxicity by multiple-instance learning: documents are bags of sentences.

Only documents carry labels. A sentence has a probability by a logistic model over hashed
features of its different words (the word, and its byte 4- and 5-grams with a mark on both
sides); a document is toxic if any of its sentences is, so its probability is the noisy-or
1 - prod(1 - p) of theirs. The model is trained through the noisy-or on document labels alone,
which leaves it able to tell the offending sentences of a document apart.

Training reads a bounded sample. Of the labelled rows with at most ``TRAIN_BYTES`` of text it
takes the ``TRAIN_ROWS`` / 2 first of each label in the order of a hash, and weighs them by the
counts of all such rows. One task fits the model: steps with an L1 penalty select features, more
steps without it set the weights of the selected. The model is a table of ``BUCKETS`` numbers,
whatever the number of documents. Scoring reads every whole text, in pieces of bounded size: a
document's score is built from sums over its sentences, so a very long text is cut between
sentences (or words, where a sentence is longer than a piece) and its sums are added.

Case table: null and empty texts, and texts without letters, have score 0 and no sentence;
labels are joined by id, so null ids have none, an id labelled more than once is toxic if any
of its labels says so, and null labels count as none; equal rows are learned from once and
scored each; without training rows of both labels nothing can be learned, and every sentence
has the probability 0 (no toxic row) or 1 (only toxic rows); empty tables give no row; extra
columns of ``documents`` are kept by :func:`scored` in a struct, those of ``labels`` ignored. A
sentence ends at one of ``. ! ?``, at a line's end, or after ``MOST_WORDS`` words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens.llm.language import LETTERS
from depotlens.llm.storage import stored
from depotlens.llm.words import coded, column_of, flat_bytes, hashes, mixed, slices, spread, strings

TRAIN_ROWS = 3_000
TRAIN_BYTES = 100_000
BUCKETS = 1 << 18
MOST_WORDS = 64
LEAST_TEXTS = 5  # a feature that fewer training texts have is not learned
SELECT_STEPS = 100
REFIT_STEPS = 60
RATE = 0.1
PENALTY = 5e-4
TOXIC = 0.7
OFFENDING = 0.5
SCORE_BYTES = 3_000_000

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n\r")] = True


@dataclass
class Bags:
    """Sentences of texts: how many each text has, where each lies (in code points), and
    the codes of its different words."""

    per_text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    words: np.ndarray  # codes, sentence after sentence
    starts: np.ndarray  # of each sentence in ``words``
    distinct: pa.Array


def bags(texts: pa.Array) -> Bags:
    data, bounds = flat_bytes(texts)
    lowered = LETTERS[data]
    letter = lowered != 32
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], letter[:-1]]) if len(data) else letter
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    after = np.concatenate([letter[1:], [False]]) if len(data) else letter
    ends = np.flatnonzero(letter & (~after | edge[1:])) + 1
    codes, distinct = coded(strings(lowered[letter], np.concatenate([[0], np.cumsum(ends - starts)])))
    if not len(starts):
        none = np.empty(0, np.int64)
        return Bags(np.zeros(len(texts), np.int64), none, none, none, none, distinct)

    text = np.searchsorted(bounds, starts, side="right") - 1
    stop = np.cumsum(_ENDS[data])[starts]
    new = _changes(text, stop)
    place = np.arange(len(starts)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    new |= place % MOST_WORDS == 0
    sentence = np.cumsum(new) - 1
    opening = np.flatnonzero(new)
    closing = np.append(opening[1:], len(starts)) - 1

    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    owner = text[opening]
    first = points[starts[opening]] - points[bounds[owner]]
    last = points[ends[closing]] - points[bounds[owner]]
    pairs = np.unique(sentence * len(distinct) + codes)
    holders = pairs // len(distinct)
    return Bags(
        np.bincount(owner, minlength=len(texts)), first, last, pairs % len(distinct),
        np.flatnonzero(_changes(holders)), distinct,
    )


def _changes(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's features end to end, and where each word's begin. A
    word always has the feature of itself."""
    data, bounds = flat_bytes(words)
    lengths = np.diff(bounds)
    padded = np.full(len(data) + 2 * len(lengths), 32, np.uint64)
    begin = bounds[:-1] + 2 * np.arange(len(lengths))
    padded[spread(begin + 1, lengths)] = data
    found, owner = [hashes(words)], [np.arange(len(lengths))]
    for size in (4, 5):
        times = np.maximum(lengths + 3 - size, 0)
        at = spread(begin, times)
        gram = np.full(len(at), size, np.uint64)
        for k in range(size):
            gram = (gram << np.uint64(8)) | padded[at + k]
        found.append(mixed(gram))
        owner.append(np.repeat(np.arange(len(lengths)), times))
    of_word = np.concatenate(owner)
    order = np.argsort(of_word, kind="stable")
    buckets = (np.concatenate(found)[order] >> np.uint64(20)) % np.uint64(BUCKETS)
    counts = np.bincount(of_word, minlength=len(lengths))
    return buckets.astype(np.int64), np.cumsum(counts) - counts


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def sentence_logits(self, found: Bags) -> np.ndarray:
        if not len(found.starts):
            return np.empty(0)
        buckets, begin = features(found.distinct)
        of_word = np.add.reduceat(self.weights[buckets], begin)
        return np.add.reduceat(of_word[found.words], found.starts) + self.bias

    def score(self, found: Bags) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the texts and of their sentences."""
        logits = self.sentence_logits(found)
        return -np.expm1(-_sums(np.logaddexp(0, logits), found.per_text)), _sigmoid(logits)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return np.maximum(total[ends] - total[ends - counts], 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -x))


def fit(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Weights that maximise the weighted likelihood of the texts' labels under the
    noisy-or, by steps over all texts with a rate of its own for each weight (Adam)."""
    found = bags(texts)
    share = float(weight[toxic].sum() / weight.sum()) if len(toxic) else 0.0
    if share in (0.0, 1.0) or not len(found.starts):
        return Model(np.zeros(BUCKETS), 50.0 if share == 1 else -50.0)
    buckets, begin = features(found.distinct)
    word = np.repeat(np.arange(len(found.distinct)), np.diff(np.append(begin, len(buckets))))
    words_in = np.diff(np.append(found.starts, len(found.words)))
    text = np.repeat(np.arange(len(texts)), found.per_text)
    label, share_of = toxic[text], (weight / weight.sum())[text]

    in_texts = np.unique(np.repeat(text, words_in) * len(found.distinct) + found.words) % len(found.distinct)
    texts_of = np.bincount(buckets, np.bincount(in_texts, minlength=len(found.distinct))[word], BUCKETS)
    used = np.flatnonzero(texts_of >= LEAST_TEXTS)

    def narrowed(used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(BUCKETS, -1)
        place[used] = np.arange(len(used))
        kept = place[buckets] >= 0
        return place[buckets[kept]], word[kept]

    feature, owner = narrowed(used)
    # start: a text of the usual number of sentences has the share of toxic rows
    values = np.append(np.zeros(len(used)), np.log(share * len(texts) / max(len(text), len(texts))))
    slope, square = np.zeros(len(values)), np.zeros(len(values))
    for step in range(1, SELECT_STEPS + REFIT_STEPS + 1):
        if step == SELECT_STEPS + 1:
            chosen = np.append(values[:-1] != 0, True)
            used, values, slope, square = used[chosen[:-1]], values[chosen], slope[chosen], square[chosen]
            feature, owner = narrowed(used)
        on_word = np.bincount(owner, values[feature], len(found.distinct))
        logits = np.add.reduceat(on_word[found.words], found.starts) + values[-1]
        p, clean = _sigmoid(logits), _sums(np.logaddexp(0, logits), found.per_text)[text]
        push = np.where(label, -p * np.exp(-clean) / np.maximum(-np.expm1(-clean), 1e-9), p) * share_of
        word_push = np.bincount(found.words, np.repeat(push, words_in), len(found.distinct))
        gradient = np.append(np.bincount(feature, word_push[owner], len(used)), push.sum())
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = RATE / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        values = values - rate * slope / (1 - 0.9**step)
        if step <= SELECT_STEPS:
            weights = values[:-1]
            values[:-1] = np.sign(weights) * np.maximum(np.abs(weights) - rate[:-1] * PENALTY, 0)
    table = np.zeros(BUCKETS)
    table[used] = values[:-1]
    return Model(table, float(values[-1]))


def _number(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string"))


def train(documents: DataFrame, labels: DataFrame, folder: str) -> Model:
    """Model of the labelled ``documents``, from a bounded sample of them."""
    toxic = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = documents.where("doc_id is not null and text is not null").select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("pick")
    )
    small = texts.where(F.octet_length("text") <= TRAIN_BYTES).select("doc_id", "pick")
    rows = stored(small.join(toxic, "doc_id").dropDuplicates(["doc_id", "pick"]), folder, "labelled")
    is_toxic = F.col("toxic") > 0
    totals = rows.agg(F.count_if(is_toxic), F.count_if(~is_toxic)).first()
    halves = []
    for label, total in zip((True, False), totals, strict=True):
        first = rows.where(is_toxic == label).orderBy("pick", "doc_id").limit(TRAIN_ROWS // 2)
        weight = F.lit(float(total / max(1, min(total, TRAIN_ROWS // 2))))
        halves.append(first.select("doc_id", "pick", F.lit(label).alias("toxic"), weight.alias("weight")))
    # at most TRAIN_ROWS rows of four numbers
    picked = F.broadcast(halves[0].unionAll(halves[1]))
    sample = texts.join(picked, ["doc_id", "pick"]).dropDuplicates(["doc_id", "pick"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [pa.table(batch) for batch in batches]
        if not parts:
            return
        whole = pa.concat_tables(parts).sort_by([("pick", "ascending"), ("doc_id", "ascending")])
        arrays = (whole[name].to_numpy() for name in ("toxic", "weight"))
        model = fit(whole["text"].cast(pa.large_string()).combine_chunks(), *(np.asarray(a) for a in arrays))
        filled = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(filled, -1), pa.int32()), pa.array(np.append(model.weights[filled], model.bias))],
            names=["bucket", "weight"],
        )

    columns = sample.select("doc_id", "pick", "text", "toxic", "weight").repartition(1)
    found = columns.mapInArrow(run, "bucket int, weight double").collect()  # at most BUCKETS + 1 rows
    model = Model(np.zeros(BUCKETS), -50.0)
    for bucket, weight in found:
        if bucket < 0:
            model.bias = weight
        else:
            model.weights[bucket] = weight
    return model


def pieces(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """UTF-8 bytes of a text cut into pieces of at most ``most``: after a sentence's
    end, else at the last byte that is no letter, else between code points."""
    while len(data) > most:
        window = data[:most]
        for cuts in (_ENDS[window], LETTERS[window] == 32, (data[1 : most + 1] & 0xC0) != 0x80):
            places = np.flatnonzero(cuts)
            if len(places):
                break
        stop = int(places[-1]) + 1 if len(places) else most
        yield data[:stop]
        data = data[stop:]
    yield data


def _judged(text: np.ndarray, model: Model, most: int) -> tuple[float, list[tuple[int, int, float]]]:
    """Score of one text and its offending sentences, piece by piece."""
    clean, base, offending = 0.0, 0, []
    for piece in pieces(text, most):
        found = bags(strings(piece, np.array([0, len(piece)])))
        logits = model.sentence_logits(found)
        clean += float(np.logaddexp(0, logits).sum())
        offending += _offending(found, _sigmoid(logits), 0, len(logits), base)
        base += int(((piece & 0xC0) != 0x80).sum())
    return -float(np.expm1(-clean)), offending


def _offending(found: Bags, p: np.ndarray, start: int, stop: int, base: int = 0) -> list[tuple[int, int, float]]:
    return [(base + int(found.first[k]), base + int(found.last[k]), float(p[k])) for k in start + np.flatnonzero(p[start:stop] >= OFFENDING)]


def judged(texts: pa.Array, model: Model, most: int = SCORE_BYTES) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Scores of the texts, and the places (code points) and probabilities of their
    offending sentences."""
    if len(texts) == 1 and (pc.binary_length(texts)[0].as_py() or 0) > most:
        score, places = _judged(flat_bytes(texts)[0], model, most)
        return np.array([score]), [places]
    found = bags(texts)
    scores, p = model.score(found)
    ends = np.cumsum(found.per_text)
    places: list[list] = [[] for _ in range(len(texts))]
    for k in np.unique(np.searchsorted(ends, np.flatnonzero(p >= OFFENDING), side="right")):
        places[k] = _offending(found, p, ends[k] - found.per_text[k], ends[k])
    return scores, places


SENTENCE = "struct<start: bigint, end: bigint, score: double>"


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``row`` (a struct of the columns of ``documents``), ``score``, ``predicted`` and
    ``sentences``: those that are toxic by themselves, with start, end (code points, end
    exclusive) and probability."""
    sent = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    rows = documents.select(F.struct("*").alias("row"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "row.text", SCORE_BYTES):
                scores, places = judged(column_of(part, "row.text"), sent.value)
                listed = [[{"start": a, "end": b, "score": p} for a, b, p in found] for found in places]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(scores, pa.float64()), pa.array((scores >= TOXIC).astype(np.int32)), pa.array(listed, kind)],
                    names=["row", "score", "predicted", "sentences"],
                )

    kept = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kept}, score double, predicted int, sentences array<{SENTENCE}>")


def held_out() -> Column:
    return _number() % 3 == 1


def report(documents: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """Score and prediction of every document, learned from two thirds of the ids."""
    model = train(documents.where(~F.coalesce(held_out(), F.lit(False))), labels, folder)
    found = scored(documents.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("row.doc_id", "row.held_out", "score", "predicted", "sentences")
