"""Operators over the whole corpus, against plain Python and SQL."""

from __future__ import annotations

import io
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from compare import assert_same, connect
from depotlens.llm import archive, frames, mixing, neardup, packing, storage, tokens, topk
from depotlens.llm.components import components
from depotlens.llm.oracle import ORACLE
from depotlens.llm.queries import QUERIES, TOKENIZER
from depotlens.llm.storage import fresh_folder, stored, working_folders

SCHEMA = "doc_id bigint, text string, ids string, `key` string, row string, slice string, start string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", [n for n in ORACLE])
def test_query_matches_sql(spark, data, name):
    expected = connect(data).execute(ORACLE[name]).df()
    assert_same(QUERIES[name](spark, data), expected)


# components


def test_components_of_random_graphs(spark):
    pick = random.Random(2)
    for n, m in ((30, 20), (200, 220), (60, 59)):
        edges = [(pick.randrange(n), pick.randrange(n)) for _ in range(m)]
        if m == 59:
            edges = [(k, k + 1) for k in range(59)]  # a chain
        root = list(range(n))
        for _ in range(n):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        folder = fresh_folder(spark, "components")
        found = components(spark.createDataFrame(edges, "a bigint, b bigint"), folder, "c").collect()
        nodes = {x for e in edges for x in e}
        assert sorted((r.node, r.root) for r in found) == sorted((x, root[x]) for x in nodes)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), folder, "none").count() == 0


# near-duplicates


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i) if i is not None else low.get(find(k))
    return [(i, len(sets[k]), low[find(k)] if i is not None else None) for k, (i, _) in enumerate(rows)]


def near_rows(seed, copies=40):
    """Texts at all distances around the limit: chains of edits, copies and fragments."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randrange(4000)}"
    rows = []
    for _ in range(3):
        base = [word() for _ in range(pick.randint(30, 160))]
        at = list(base)
        for _ in range(copies):
            text = list(at if pick.random() < 0.5 else base)
            for _ in range(pick.randint(0, 3)):
                text[pick.randrange(len(text))] = word()
            at = text
            rows.append(" ".join(text))
    rows += [rows[0], rows[0].upper(), "", None, " \n", "a b", "A  B", "a b c", "one two three four five six", "x y z a b c d"]
    pick.shuffle(rows)
    return list(enumerate(rows)) + [(None, rows[0]), (3, rows[5])]


@pytest.mark.parametrize("block_classes", [2000, 9])
def test_near_duplicates_match_all_pairs(spark, block_classes):
    rows = near_rows(7)
    found = neardup.report(docs(spark, rows), block_classes).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=key) == sorted(plain_components(rows), key=key)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)


def test_pipeline_drops_near_copies_from_0_80_on(spark, data):
    import corpus_pipeline

    words = [f"w{k}" for k in range(200)]
    near = words[:100] + ["x", "y"] + words[102:181] + ["z"] + words[182:]  # 11 of 196 shingles differ
    at_82 = words[:40] + ["a"] + words[41:80] + ["b"] + words[81:120] + ["c"] + words[121:160] + ["d"] + words[161:]
    apart = [w if k % 30 else f"v{k}" for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(at_82)), (4, " ".join(apart))]
    shared = [len(shingles(rows[0][1]) & shingles(t)) / len(shingles(rows[0][1]) | shingles(t)) for _, t in rows]
    assert shared[1] > 0.85 > shared[2] > 0.8 > shared[3]
    kept = corpus_pipeline.without_near_duplicates(spark, docs(spark, rows), data)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]
    assert sorted(r.doc_id for r in neardup.one_of_each(docs(spark, rows)).collect()) == [1, 3, 4]
    assert (neardup.matches(85), neardup.matches(80)) == (40, 35)


def test_one_of_each_keeps_one_row_and_the_columns(spark):
    text = " ".join(f"w{k}" for k in range(60))
    frame = docs(spark, [(5, text), (2, text + " more"), (9, "other words"), (9, "other words"), (None, text), (7, None), (8, "")])
    kept = neardup.one_of_each(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [2, 7, 8, 9] and ids.count(None) == 1
    assert neardup.one_of_each(frame.limit(0)).count() == 0


def test_texts_that_share_passages_make_no_clusters(spark):
    """Work follows the shared postings: pairs grow with the texts, not with their square."""
    pick, found = random.Random(1), {}
    passage = lambda: " ".join(f"{pick.randrange(5000):x}" for _ in range(30))
    for n in (300, 1200):
        pool = [passage() for _ in range(n // 2)]
        texts = spark.createDataFrame([(k, " ".join(pick.sample(pool, 6))) for k in range(n)], "doc_id bigint, text string")
        folder = fresh_folder(spark, "passages")
        rows = neardup.sketches(texts, folder).withColumnRenamed("row", "rep")
        classes = stored(rows, folder, "classes")
        assert neardup._clusters(classes, folder, 85).count() == 0
        postings = spark.read.parquet(f"{folder}/prefixes")
        assert postings.where(F.col("n") > neardup.SHORT).count() == 0
        found[n] = neardup.candidate_pairs(postings).count()
    assert 0 < found[1200] < 20 * 1200 and found[1200] < 6 * found[300]


@pytest.mark.parametrize("short", [1, 2, 16])
def test_short_and_long_postings_give_the_same_groups(spark, monkeypatch, short):
    pick = random.Random(8)
    texts = []
    for size in (1, 2, 3, 9, 25):
        base = [f"w{pick.randrange(400)}" for _ in range(300)]
        for _ in range(size):
            one = list(base)
            one[pick.randrange(300)] = "changed"
            texts.append(" ".join(one))
    monkeypatch.setattr(neardup, "SHORT", short)
    found = {r.doc_id: r.component_id for r in neardup.report(docs(spark, list(enumerate(texts)))).collect()}
    assert sorted(Counter(found.values()).values()) == [1, 2, 3, 9, 25]


# top-k


@pytest.mark.parametrize(("dims", "low", "high"), [(3, -2, 3), (1, -1000, 1000), (8, -(2**23), 2**23), (5, 0, 1), (64, -160, 160)])
def test_block_search_is_exact(dims, low, high):
    pick = np.random.default_rng(dims)
    ids, values = pick.integers(0, 150, 200), pick.integers(low, high, (200, dims))
    block = topk.Block.build(ids, np.arange(200), values)
    for k in range(0, 200, 3):
        rows, scores = topk.best(block, int(ids[k]), values[k], 5)
        exact, others = values @ values[k], np.flatnonzero(ids != ids[k])
        order = others[np.lexsort((ids[others], -exact[others]))][:5]
        assert (scores == exact[order]).all() and (ids[rows] == ids[order]).all()


def test_search_over_many_blocks(spark):
    pick = np.random.default_rng(1)
    rows = [(k, [float(x) for x in pick.normal(size=6)]) for k in range(300)]
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (350, [float("nan")] * 6), (None, [1.0] * 6), (400, [0.5, 0.5]), (401, [0.25, 1.0])]
    rows += [(600, [1.0] * 6), (601, [1.0] * 6), (602, [1.0] * 6), (602, [1.0] * 6)]
    folder = fresh_folder(spark, "vectors")
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, score string")
    written = topk.index(frame, folder, "vec_id", "embedding", block_rows=40)
    found = topk.search(written, folder, k=5, every=50).collect()
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v and None not in v and not np.isnan(v).any()]
    for query, vector in good:
        if query % 50 == 0:
            others = sorted((-int(v @ vector), i) for i, v in good if i != query and len(v) == len(vector))[:5]
            mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
            assert mine == [(k + 1, i, -s) for k, (s, i) in enumerate(others)]
    assert topk.search(topk.index(frame.limit(0), fresh_folder(spark, "v0"), "vec_id", "embedding"), folder, 5, 50).count() == 0


@pytest.mark.parametrize("size", [1e6, 1e9, 1e16, 1e300])
def test_large_components_are_exact(spark, size):
    """Scores beyond 2^63 are ranked by what they are and returned as the nearest long."""
    pick = np.random.default_rng(9)
    rows = [(k, [float(x) * (size if k % 3 else 1) for x in pick.normal(size=4)]) for k in range(60)]
    rows += [(60, [1e308, 1.0, 1.0, 1.0])]  # not finite after scaling
    folder = fresh_folder(spark, "vectors")
    written = topk.index(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), folder, "vec_id", "embedding", block_rows=16)
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.search(written, folder, k=5, every=10).collect()}
    whole = {k: [math.floor(256 * x) for x in v] for k, v in rows[:60]}
    for query in range(0, 60, 10):
        best = sorted((-sum(a * b for a, b in zip(v, whole[query], strict=True)), k) for k, v in whole.items() if k != query)[:5]
        for rank, (minus, k) in enumerate(best, 1):
            assert found[query, rank] == (k, max(-(2**63), min(2**63 - 1, -minus)))
    assert (60, 1) not in found and len(found) == 30


def test_order_beyond_a_long():
    scores = [-(2**200), -(2**100) - 1, -(2**100), -(2**63), -5, 0, 2**62, 2**63 - 1, 2**63, 2**64, 2**300]
    keys = [(topk._nearest_long(s), topk._beyond(s) or b"") for s in scores]
    assert keys == sorted(keys) and len(set(keys)) == len(scores)


# tokens, frames, packing


@pytest.fixture(scope="module")
def whole():
    return tokenizers.Tokenizer.from_file(TOKENIZER)


def exact_ids(whole, text):
    return np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


ODD = list("ab sTRE'lvmd'\n\t1234.,!?-éÉßüñÑ ×÷—“²ªİıſ<|́ Σσ中") + ["don't", "we'll", "'S", "<|endoftext|>", "it's", "''s", "\x85", "\x1c"]


def test_words_encode_like_the_library(whole):
    pick = random.Random(1)
    encoder = tokens.WordTokens(TOKENIZER)
    assert encoder.by_word
    for pool in (ODD, ODD[:36]):
        texts = [None, "", "  ", "'", "'ll"] + ["".join(pick.choice(pool) for _ in range(pick.randint(0, 30))) for _ in range(4000)]
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == exact_ids(whole, text)[:-1].tolist(), text


def sample_rows():
    pick = random.Random(4)
    line = lambda n: " ".join(pick.choice(["The", "river's", "schön", "42", "x,y", "—"]) for _ in range(n))
    rows = [(k * 7 % 101, line(pick.randint(0, 300))) for k in range(101)]
    return rows + [(500, line(9000)), (501, None), (502, ""), (3, "again"), (3, "again"), (None, "no id"), (-4, "neg")]


def test_token_files_round_trip(spark, whole):
    rows = sample_rows()
    folder = fresh_folder(spark, "frames")
    manifest = stored(frames.write(docs(spark, rows), folder, TOKENIZER), folder, "manifest")
    found = sorted(frames.read(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    start = 0
    for r in found:
        assert (r.start, r.n_tokens * 4) == (start, len(r["ids"]))
        start += r.n_tokens
    exact = Counter((i, exact_ids(whole, t).tobytes()) for i, t in rows)
    assert Counter((r.doc_id, bytes(r["ids"])) for r in found) == exact
    uris = [r.file for r in manifest.collect()]
    single = [x for uri in uris for x in frames.FrameFile.open(uri).find(500)]
    assert single == [exact_ids(whole, dict(rows)[500]).tobytes()]
    none = stored(frames.write(docs(spark, []), folder, TOKENIZER), folder, "none")
    assert frames.read(none).count() == 0


def test_damaged_frame_is_noticed(tmp_path):
    sink = io.BytesIO()
    writer = frames.FrameWriter(sink)
    writer.frame(b"\x01\0\0\0" * 50)
    writer.frame(np.array([7], "<i8").tobytes() + b"\0")
    writer.close()
    data = bytearray(sink.getvalue())
    path = tmp_path / "f"
    path.write_bytes(data)
    assert frames.FrameFile.open(f"file:{path}").find(7) == [b"\x01\0\0\0" * 50]
    entry = frames.FrameFile.open(f"file:{path}").entries[0]
    data[int(entry["packed"]) - 6] ^= 0xFF
    path.write_bytes(data)
    with pytest.raises(Exception):  # noqa: B017
        frames.FrameFile.open(f"file:{path}").find(7)


def check_pieces(rows, exact):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY
    for doc, ids in exact.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and bytes(r["ids"]) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    fills = [sum(r.length for r in pieces) for pieces in by_sequence.values()]
    return sum(0 if f & (f - 1) == 0 else packing.CAPACITY - f for f in fills)


def test_packing_is_whole_and_unpadded(spark, whole):
    rows = [(k, t) for k, (_, t) in enumerate(sample_rows())]
    found = packing.packed(docs(spark, rows), TOKENIZER).collect()
    assert check_pieces(found, {i: exact_ids(whole, t) for i, t in rows}) == 0
    assert packing.packed(docs(spark, []), TOKENIZER).count() == 0
    repeated = packing.packed(docs(spark, [(1, "a b"), (1, "a b"), (None, "c")]), TOKENIZER).collect()
    assert sorted((r.doc_id is None, r.length) for r in repeated) == [(False, 3), (False, 3), (True, 2)]


@pytest.mark.parametrize("group_documents", [65536, 40])
def test_groups_of_lengths(spark, group_documents):
    pick = np.random.default_rng(3)
    sizes = np.concatenate([np.exp(pick.normal(6, 1.5, 300)).astype(int) + 1, [2048, 4096, 1, 2047, 50000]])
    frame = spark.createDataFrame([(k, int(n)) for k, n in enumerate(sizes)], "key bigint, n_tokens bigint")
    planned = packing.plan(frame, group_documents).select("key", F.explode("pieces").alias("p")).select("key", "p.*").collect()
    used = Counter()
    for r in planned:
        used[r.sequence_id] += r.length
    assert sum(used.values()) == sizes.sum()
    assert all(n == 2048 or n & (n - 1) == 0 for n in used.values())


def test_linear_program_beats_first_fit():
    histogram = np.zeros(128)
    histogram[[49, 64, 13, 27]] = [400, 300, 500, 700]
    patterns = packing.solve(histogram, 128)
    covered = sum(p.counts * p.uses for p in patterns)
    assert (covered >= histogram - 1e-6).all()
    area = (histogram * np.arange(1, 129)).sum() / 128
    rooms = []  # first fit, longest first
    for size in np.repeat(np.arange(1, 129), histogram.astype(int))[::-1]:
        at = next((k for k, room in enumerate(rooms) if room >= size), None)
        if at is None:
            rooms.append(128 - size)
        else:
            rooms[at] -= size
    assert area <= sum(p.uses for p in patterns) <= len(rooms)


# archives


def test_archive_round_trip(spark):
    shared = "<p>same ü</p>"
    rows = [(k, f"http://x/{k}", shared if k % 3 == 0 else f"<p>{k}</p>") for k in range(40)]
    rows += [(50, None, None), (51, "u", ""), (52, "u\r\nX: y", "\r\n\r\nbody\0"), (None, "u", shared), (39, "http://x/39", shared), (60, "u", "z" * 300_000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, size string")
    folder = fresh_folder(spark, "archives")
    packages = stored(archive.write(frame, folder), folder, "packages")
    found = archive.read(packages).collect()
    last = {}
    for page, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    exact = Counter()
    for page, _, html in rows:
        payload = (html or "").encode()
        top = last[html or ""]
        revisit = page is not None and page < top
        digest = archive.digest_text(__import__("hashlib").sha1(payload).digest())
        exact[(page, len(payload), digest, "revisit" if revisit else "response", top if revisit else None, None if revisit else payload)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found) == exact
    single = [x for r in packages.collect() for x in archive.Package.open(r.file).find(52)]
    assert len(single) == 1 and archive.parsed(single[0])[2] == b"\r\n\r\nbody\0"
    none = stored(archive.write(frame.limit(0), folder), folder, "none")
    assert archive.read(none).count() == 0


def test_packages_are_readable_by_others(spark, tmp_path):
    import zipfile

    path = tmp_path / "p.zip"
    with open(path, "wb") as sink:
        package = archive.StoredZip(sink)
        package.member("a/b", iter([b"one", b"two"]))
        package.member("c", iter([]))
        package.close()
    with zipfile.ZipFile(path) as other:
        assert other.testzip() is None and other.read("a/b") == b"onetwo" and other.namelist() == ["a/b", "c"]
    plain = tmp_path / "q.zip"
    with zipfile.ZipFile(plain, "w", zipfile.ZIP_STORED) as other:
        other.writestr("x", b"12345")
        other.comment = b"a comment"
    members = archive.directory(f"file:{plain}")
    start = archive.content_start(f"file:{plain}", members["x"])
    assert archive.read_range(f"file:{plain}", start, members["x"].size) == b"12345"


# scores


def test_base_scores_by_counting(spark):
    rows = [(i, t) for i, t in sample_rows()]
    found = mixing.score(docs(spark, rows)).collect()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    words = lambda t: (t or "").encode().lower().split()
    counts, texts = Counter(), 0
    for i, t in rows:
        if not held(i):
            counts.update(words(t))
            texts += 1
    total, distinct = sum(counts.values()) + texts, len(counts) + 1
    norm = total + 0.1 * (distinct + 1)

    def expected(i, t):
        seen = [counts[w] for w in words(t)] + [texts]
        return i, held(i), len(seen), sum(c > 0 for c in seen), total, round(sum(np.log10((c + 0.1) / norm) for c in seen), 6)

    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == Counter(expected(i, t) for i, t in rows)
    assert all(r.score < 0 for r in found)
    assert mixing.score(docs(spark, [])).count() == 0


def test_scores_without_training_rows(spark):
    only = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = mixing.score(docs(spark, [(only, "a b")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.base_score == pytest.approx(3 * np.log10(0.1 / 0.1)) and row.score < 0


def test_held_out_scores_beat_the_base(spark):
    """Texts of one grammar: the words alone say little, their order a lot."""
    pick = random.Random(8)
    after = {k: [pick.randrange(300) for _ in range(3)] for k in range(300)}
    rows = []
    for k in range(400):
        at, text = pick.randrange(300), []
        for _ in range(120):
            text.append(f"word{at}")
            at = pick.choice(after[at])
        rows.append((k, " ".join(text)))
    found = mixing.score(docs(spark, rows)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.7 * found[1]


def test_a_score_depends_on_its_own_text_only():
    counts = np.ones(mixing._FIRST_WORD, np.int64)
    alphabet = mixing.Alphabet(pa.array([], pa.string()), *mixing.huffman(counts))
    tables = [np.zeros(1 << bits, np.int8) for bits in mixing.SLOT_BITS]
    texts = ["the river and the house " * 30, "", "a", "the river and the house " * 30]
    score = lambda ts: mixing.log2_scores(mixing.symbol_stream(mixing.Words.of(pa.array(ts)), alphabet), tables)
    together = score(texts)
    assert together == pytest.approx([score([t])[0] for t in texts])
    assert together[0] == together[3] > -8 * 25 * 30


def test_every_context_keeps_counts_of_its_own(spark, monkeypatch):
    """Words in pairs, more of them than any fixed table has room for, and few shards or many."""
    counts = np.ones(mixing._FIRST_WORD, np.int64)
    alphabet = mixing.Alphabet(pa.array([], pa.string()), *mixing.huffman(counts))
    pick = random.Random(4)
    texts = [" ".join(f"{pick.randrange(10**9):x}" for _ in range(300)) for _ in range(200)]
    stream = mixing.symbol_stream(mixing.Words.of(pa.array(texts)), alphabet)
    keys, times = mixing.pair_counts(stream, np.ones(len(texts), bool))
    assert len(keys) > 400_000 and times.sum() == mixing.CONTEXTS * len(stream.places)
    odds = mixing.path_odds(keys, times, alphabet)
    plain: dict[tuple, list[int]] = {}
    for key, n in zip(keys.tolist(), times.tolist(), strict=True):
        at, size = alphabet.starts[key % 2**18], alphabet.lengths[key % 2**18]
        for node, bit in zip(alphabet.nodes[at : at + size].tolist(), alphabet.bits[at : at + size].tolist(), strict=True):
            plain.setdefault((key >> 18, node), [0, 0])[bit] += n
    place = 0
    for key in keys.tolist()[:20000]:
        at, size = alphabet.starts[key % 2**18], alphabet.lengths[key % 2**18]
        for node in alphabet.nodes[at : at + size].tolist():
            zero, one = plain[key >> 18, node]
            assert abs(odds[place] - np.clip(10 * np.log((one + 0.4) / (zero + 0.4)), -127, 127)) < 0.51
            place += 1

    rows = [(k, text) for k, text in enumerate(texts[:60])]
    expected = sorted(mixing.score(docs(spark, rows)).collect())
    monkeypatch.setattr(mixing, "SHARD_PAIRS", 3000)
    found = sorted(mixing.score(docs(spark, rows).repartition(5)).collect())
    assert [r.doc_id for r in found] == [r.doc_id for r in expected]
    assert [r.score for r in found] == pytest.approx([r.score for r in expected])


def test_short_texts_adapt_and_two_words_count():
    """A text of fewer than 128 words moves its weights, and the word two before is a context."""
    counts = np.ones(mixing._FIRST_WORD, np.int64)
    alphabet = mixing.Alphabet(pa.array([], pa.string()), *mixing.huffman(counts))
    stream = lambda text: mixing.symbol_stream(mixing.Words.of(pa.array([text])), alphabet)
    two, other = stream("a b c"), stream("d b c")
    differs = [(x[4:6] != y[4:6]).any() for x, y in zip(two.pairs, other.pairs, strict=True)]  # c and its end
    assert differs == [False, False, True, False, False]

    text = "r s t u v w x y z " * 6  # 109 symbols
    again = stream(text)
    tables = [np.zeros(1 << bits, np.int8) for bits in mixing.SLOT_BITS]
    assert len(again.places) < 128
    adapted = mixing.log2_scores(again, tables)[0]
    assert adapted != pytest.approx(-float(again.spelling.bit_lengths[again.places].sum()), abs=0.5)


# pipeline and registration


def test_pipeline_packs_what_its_stages_keep(spark, data, whole):
    import corpus_pipeline

    frame, sizes = spark.read.parquet(f"{data}/documents.parquet"), []
    folder = fresh_folder(spark, "stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        made = stored(stage(spark, frame, data), folder, str(k))
        assert made.columns == frame.columns
        frame = made
        sizes.append(frame.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > 0
    kept = frame.collect()
    assert not any(re.search(r"[\w.]+@[\w-]+\.\w+", r.text) for r in kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, data).collect()
    assert check_pieces(packed, {r.doc_id: exact_ids(whole, r.text) for r in kept}) == 0
    assert all(r.ids_crc32 == zlib.crc32(bytes(r["ids"])) for r in packed)


def test_working_folders_are_dropped(spark):
    with working_folders(spark):
        folder = fresh_folder(spark, "scope")
        stored(spark.range(3), folder, "t")
        with working_folders(spark):
            inner = fresh_folder(spark, "inner")
        assert not os.path.exists(inner.removeprefix("file:")) and os.path.exists(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


def test_uris_of_object_stores():
    for uri, path in (("file:/a/b", "/a/b"), ("file:///a/b", "/a/b")):
        assert storage.filesystem(uri)[1] == path
    system, path = storage.filesystem("s3a://bucket/key?region=eu-west-1")
    assert system.type_name == "s3" and path == "bucket/key"


def test_everything_is_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names and [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert set(ORACLE) <= set(contract.oracle_sql()) and set(QUERIES) <= set(names)
