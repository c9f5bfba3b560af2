"""Toxicity by multiple instances, against plain Python and held-out labels."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depotlens.llm import toxicity
from depotlens.llm.queries import QUERIES
from depotlens.llm.storage import fresh_folder

WORD = re.compile("(?:[A-Za-z]|[^\x00-\x7f])+")


def sentences(text):
    """Places and different words of the sentences of a text."""
    out, begin = [], 0
    for part in re.split(r"([.!?\n\r])", text):
        words = [(begin + m.start(), begin + m.end(), re.sub("[A-Z]", lambda c: c[0].lower(), m[0])) for m in WORD.finditer(part)]
        for k in range(0, len(words), toxicity.MOST_WORDS):
            window = words[k : k + toxicity.MOST_WORDS]
            out.append((window[0][0], window[-1][1], {w for _, _, w in window}))
        begin += len(part)
    return out


TEXTS = [
    "One two. Two THREE two!\nÉa ñó? x", "", None, "1234 ... 99", "no end " * 150, "a\r\n\nb.c.d", "word." * 40, "ß" * 30 + " ß",
]


def test_sentences_and_their_words():
    found = toxicity.bags(pa.array(TEXTS))
    names = found.distinct.to_pylist()
    stops = np.append(found.starts[1:], len(found.words))
    got = [(int(a), int(b), {names[c] for c in found.words[s:e]}) for a, b, s, e in zip(found.first, found.last, found.starts, stops, strict=True)]
    expected = [sentences(t or "") for t in TEXTS]
    assert found.per_text.tolist() == [len(e) for e in expected]
    assert got == [s for e in expected for s in e]


def model(seed=0, bias=-3.0):
    return toxicity.Model(np.random.default_rng(seed).normal(size=toxicity.BUCKETS), bias)


def test_score_is_the_noisy_or():
    m = model()
    scores, places = toxicity.judged(pa.array(TEXTS), m)
    for text, score, found in zip(TEXTS, scores, places, strict=True):
        clean, bad = 1.0, []
        for a, b, words in sentences(text or ""):
            buckets, begin = toxicity.features(pa.array(sorted(words), pa.large_string()))
            p = 1 / (1 + np.exp(-m.bias - m.weights[buckets].sum()))
            clean *= 1 - p
            if p >= toxicity.OFFENDING:
                bad.append((a, b))
        assert score == pytest.approx(1 - clean, abs=1e-9)
        assert [f[:2] for f in found] == bad


def test_features_are_the_word_and_its_grams():
    one, begin = toxicity.features(pa.array(["idiot", "a", "idiots"], pa.large_string()))
    # the word, four-grams of " idiot " and its five-grams
    assert np.diff(np.append(begin, len(one))).tolist() == [1 + 4 + 3, 1, 1 + 5 + 4]
    assert len(set(one[:8]) & set(one[9:])) == 3 + 2


def test_a_long_text_is_scored_in_pieces():
    pick = random.Random(1)
    text = "".join(pick.choice(["idiot ", "Éa ", "so. ", "word ", "!", "\n"]) for _ in range(4000))
    m = model(2, -9.0)
    whole, places = toxicity.judged(pa.array([text]), m)
    cut, cut_places = toxicity.judged(pa.array([text]), m, most=500)
    assert cut[0] == pytest.approx(whole[0], abs=1e-9)
    assert [p[:2] for p in cut_places[0]] == [p[:2] for p in places[0]]
    endless = "é" * 1001
    parts = list(toxicity.pieces(np.frombuffer(endless.encode(), np.uint8), 100))
    assert max(map(len, parts)) <= 100 and "".join(bytes(p).decode() for p in parts) == endless


def test_steps_follow_the_likelihood():
    """The fitted model beats the best constant on its own labels, and finds the sentence."""
    pick = random.Random(3)
    words = ["".join(pick.choice("abdefgh") for _ in range(5)) for _ in range(200)]
    texts, labels = [], []
    for k in range(400):
        body = [" ".join(pick.choices(words, k=8)) for _ in range(pick.randrange(1, 8))]
        if k % 5 == 0:
            body.insert(pick.randrange(len(body) + 1), " ".join([*pick.choices(words, k=4), "vermin", *pick.choices(words, k=3)]))
        texts.append(". ".join(body) + ".")
        labels.append(k % 5 == 0)
    y = np.array(labels)
    m = toxicity.fit(pa.array(texts), y, np.ones(len(y)))
    scores, places = toxicity.judged(pa.array(texts), m)
    likelihood = np.log(np.clip(np.where(y, scores, 1 - scores), 1e-12, 1)).mean()
    assert likelihood > -0.05
    assert ((scores >= toxicity.TOXIC) == y).all()
    for text, found, bad in zip(texts, places, y, strict=True):
        if bad:
            assert any("vermin" in text[a:b] for a, b, _ in found)


def test_report_on_odd_rows(spark):
    rows = [(k, "you vermin. fine" if k % 2 else "all good. fine") for k in range(60)]
    rows += [(None, "vermin"), (None, None), (61, None), (62, ""), (63, "..."), (1, "you vermin. fine"), (64, "fine. " * 30_000 + "vermin!")]
    documents = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], "doc_id bigint, text string, pick string, row string, toxic int")
    marks = [(k, k % 2, "z") for k in range(60)] + [(None, 1, "z"), (3, 0, "z"), (4, None, "z"), (999, 1, "z")]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, text string")
    found = toxicity.report(documents, labels, fresh_folder(spark, "toxicity")).collect()
    assert len(found) == len(rows)
    assert all(r.score == 0 and r.predicted == 0 and r.sentences == [] for r in found if r.doc_id in (61, 62, 63))
    assert {r.held_out for r in found if r.doc_id is None} == {None}
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id < 60)
    long = next(r for r in found if r.doc_id == 64)
    assert long.predicted == 1 and [tuple(s)[:2] for s in long.sentences] == [(180_000, 180_006)]
    assert all(0 <= r.score <= 1 for r in found)


@pytest.mark.parametrize("marks, score", [([], 0), ([(k, 0) for k in range(9)], 0), ([(k, 1) for k in range(9)], 1)])
def test_one_label_only(spark, marks, score):
    documents = spark.createDataFrame([(k, "some words.") for k in range(9)], "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    found = toxicity.report(documents, labels, fresh_folder(spark, "toxicity")).collect()
    assert [round(r.score, 6) for r in found] == [score] * 9
    nothing = toxicity.report(documents.where("false"), labels, fresh_folder(spark, "toxicity"))
    assert nothing.collect() == []


def test_held_out_accuracy(spark):
    """Held-out rows of the largest test tables: ranked well, and few clean ones marked."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op11_multiple_instance"](spark, folder).join(labels, "doc_id").where("held_out")
    rows = found.select("score", "predicted", "toxic").toPandas()
    bad, good = rows[rows.toxic == 1], rows[rows.toxic == 0]
    above = (bad.score.to_numpy()[:, None] > good.score.to_numpy()).mean() + (bad.score.to_numpy()[:, None] == good.score.to_numpy()).mean() / 2
    assert above > 0.93
    assert good.predicted.mean() < 0.01
    assert bad.predicted.mean() > 0.75


def test_labels_do_not_leak(spark):
    """Held-out labels, languages and sources change no score."""
    folder = "/root/testdata/sf0.001"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    renamed = documents.withColumns({"lang": F.lit("xx"), "source": F.lit("s")})
    results = [
        {(r.doc_id, r.score) for r in toxicity.report(d, marks, fresh_folder(spark, "toxicity")).collect()}
        for d, marks in ((documents, labels), (renamed, other))
    ]
    assert results[0] == results[1]
