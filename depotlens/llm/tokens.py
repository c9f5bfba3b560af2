"""Token ids of whole texts, each distinct word encoded once.

A tokenizer file of the known kind (lower case, words split by character class, BPE with
word ends) encodes each word on its own. Texts of ASCII and Latin letters are therefore cut
into words by byte classes, and only words not met before go through the tokenizers
library. Every other text, and every other kind of file, is encoded whole by the library."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from depotlens.llm.words import coded, flat_bytes, released, slices, spread, strings

END_ID = 1
KNOWN_WORDS = 400_000

# What a file must state for its words to be encoded one by one.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_APOSTROPHE = 39


class WordTokens:
    """Encoder of one tokenizer file, with the words met so far."""

    def __init__(self, path: str):
        with open(path) as file:
            stated = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.vocabulary = self.whole.get_vocab_size()
        splitters = (stated["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = (
            (stated["normalizer"] or {}).get("normalizers") == _NORMALIZERS
            and splitters[0].get("pattern") == {"Regex": _SPLIT}
            and stated["model"].get("end_of_word_suffix") == "</w>"
        )
        if self.by_word:
            spaced = [{"type": "WhitespaceSplit"}, splitters[1]]
            plain = {**stated, "normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": spaced}}
            self.words = Tokenizer.from_str(json.dumps(plain))
            vocabulary = self.words.get_vocab()
            self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
            self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.starts, self.lengths = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        shown = words
        other = [i for i, w in enumerate(words) if not w.isascii()]
        if other:
            shown = list(words)
            lowered = self.whole.normalizer.normalize_str(" ".join(words[i] for i in other)).split(" ")
            for i, word in zip(other, lowered, strict=True):
                shown[i] = word
        lines = [" ".join(shown[k : k + 512]) for k in range(0, len(shown), 512)]
        encoded = self.words.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int32) for e in encoded])
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("words and word ends of the tokenizer differ")
        entry = len(self.known)
        self.ids = _grown(self.ids, self.used + len(ids))
        self.starts = _grown(self.starts, entry + len(words))
        self.lengths = _grown(self.lengths, entry + len(words))
        self.ids[self.used : self.used + len(ids)] = ids
        begins = np.concatenate([[0], ends[:-1]])
        self.starts[entry : entry + len(words)] = self.used + begins
        self.lengths[entry : entry + len(words)] = ends - begins
        self.used += len(ids)
        self.known.update(zip(words, range(entry, entry + len(words)), strict=True))

    def _entries(self, distinct: list[str]) -> np.ndarray:
        if len(self.known) + len(distinct) > KNOWN_WORDS:
            self._forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if not self.by_word:
            return self._encode_whole(texts)
        data, bounds = flat_bytes(texts)
        odd = np.unique(np.searchsorted(bounds, _unusual(data), side="right") - 1)
        sizes = np.diff(bounds)
        if len(odd):
            usual = sizes.copy()
            usual[odd] = 0
            kept = spread(bounds[:-1], usual)
            data, bounds = data[kept], np.concatenate([[0], np.cumsum(usual)])
        tokens, of_text = _cut(data, bounds)
        codes, distinct = coded(tokens)
        entries = self._entries(distinct.to_pylist())[codes]
        lengths = self.lengths[entries]
        ids = self.ids[spread(self.starts[entries], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.diff(before[np.concatenate([[0], np.cumsum(of_text)])])
        if len(odd):
            more, more_counts = self._encode_whole(texts.take(pa.array(odd)))
            all_counts = counts.copy()
            all_counts[odd] = more_counts
            starts = np.cumsum(all_counts) - all_counts
            merged = np.empty(int(all_counts.sum()), np.int32)
            merged[spread(starts, counts)] = ids
            merged[spread(starts[odd], more_counts)] = more
            return merged, all_counts
        return ids, counts

    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        encoded = self.whole.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        ids = [np.array(e.ids, np.int32) for e in encoded]
        return np.concatenate([np.empty(0, np.int32), *ids]), np.array([len(i) for i in ids], np.int64)


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    grown = np.empty(max(size, 2 * len(values)), values.dtype)
    grown[: len(values)] = values
    return grown


def _unusual(data: np.ndarray) -> np.ndarray:
    """Places of characters that byte classes don't settle: beyond U+02AF, no letter,
    of special lower case, or the opening of a special token."""
    follows = np.append(data[1:], np.uint8(0))
    lead = (data >= 0xC0) & ((data < 0xC3) | (data > 0xCA))
    lead |= (data == 0xCA) & (follows > 0xAF)
    lead |= (data == 0xC3) & ((follows == 0x97) | (follows == 0xB7))
    lead |= (data == 0xC4) & (follows == 0xB0)
    lead |= (data == ord("<")) & (follows == ord("|"))
    return np.flatnonzero(lead)


def _cut(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, cut where the character class changes, at each digit and
    around English contractions; and how many each text has."""
    kind, data = _CLASS[data], _LOWER[data]
    before = np.concatenate([[_SPACE], kind[:-1]]).astype(np.uint8) if len(kind) else kind
    filled = bounds[:-1][np.diff(bounds) > 0]
    before[filled] = _SPACE
    begins = (kind != _SPACE) & ((kind != before) | (kind == _DIGIT))
    signs = np.flatnonzero((data == _APOSTROPHE) & (before != _OTHER))
    if len(signs):
        stop = bounds[np.searchsorted(bounds, signs, side="right")]
        shown = np.append(data, np.zeros(3, np.uint8))
        one, two = shown[signs + 1], shown[signs + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (signs + 1 < stop)
        long = (np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        long &= signs + 2 < stop
        for found, length in ((signs[short], 2), (signs[long], 3)):
            begins[found + 1] = False
            after = found + length
            after = after[after < stop[short if length == 2 else long]]
            begins[after] = kind[after] != _SPACE
    shown = kind != _SPACE
    place = np.concatenate([[0], np.cumsum(shown)])
    starts = np.flatnonzero(begins)
    words = strings(data[shown], np.append(place[starts], place[-1]))
    counts = np.diff(np.concatenate([[0], np.cumsum(begins)])[bounds])
    return words, counts


_LOADED: dict[str, WordTokens] = {}


def encoder(path: str) -> WordTokens:
    """The encoder of ``path``, kept for later tasks of the same worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text; and the bounds of the texts."""
    bounds = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.empty(int(bounds[-1]), np.uint32)
    out[bounds[1:] - 1] = end_id
    out[spread(bounds[:-1], counts)] = ids
    return out, bounds


def encoded(documents: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``documents`` with ``ids``, the little-endian ids of the text (a null is empty)
    and the end id, of two bytes each where the vocabulary allows, else four."""
    columns = [c for c in documents.columns if c != "text"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        width = np.dtype("<u2" if words.vocabulary <= 1 << 16 else "<u4")
        for batch in batches:
            for part in slices(batch):
                ids, bounds = with_end(*words.encode(part.column("text")), end_id)
                buffers = [None, pa.py_buffer((bounds * width.itemsize).astype(np.int32)), pa.py_buffer(ids.astype(width))]
                packed = pa.Array.from_buffers(pa.binary(), part.num_rows, buffers)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), packed, pa.array([width.itemsize] * part.num_rows, pa.int32())],
                    names=[*columns, "ids", "id_bytes"],
                )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != "text"]
    return documents.mapInArrow(run, ", ".join([*kept, "ids binary, id_bytes int"]))
