"""Whole texts to token ids with a vocabulary file of the tokenizers library."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: longest word or chunk, in bytes, that is remembered
CHUNK_BYTES = 64
#: words, and chunks that are no words, remembered in each of two generations
WORDS = 300_000
#: bytes of text that are encoded at once
AT_ONCE = 1 << 22

#: ASCII punctuation that may stand after a word (an apostrophe may belong to it)
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: fixed values: the rules of a vocabulary that separates words of letters from marks
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _MARK, _LOWER = np.zeros(256, bool), np.zeros(256, bool), np.arange(256, dtype=np.uint8)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_MARK[list(_MARKS.encode())] = True
_LOWER[65:91] += 32


class _Remembered(dict):
    """Two generations of a bounded number of entries: `turn` begins a new one when one is full."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size
        self.older: dict = {}

    def find(self, key):
        found = self.get(key)
        if found is None:
            found = self.older.get(key)
            if found is not None:
                self[key] = found
        return found

    def turn(self) -> None:
        if len(self) > self.size:
            self.older = dict(self)
            self.clear()


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings that lie in a row, by where each ends."""
    bounds = np.r_[0, ends].astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


class Encoder:
    """Ids of texts, as the library gives them.

    The vocabularies used here drop white space and match nothing across it, so the
    ids of a text are the ids of its chunks between ASCII white space in a row.  The
    distinct chunks of some MB of texts are encoded once.  Where the vocabulary's rules,
    as its file states them, separate letters from marks, a chunk that is a word and
    marks after it is put together from the two, and the library sees only words that are
    not remembered; whether a word is one of letters is asked after the library's own
    normalising.  Memory is bounded by the generations and the texts at once.
    """

    def __init__(self, path: str, words: int = WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        suffix = rules["model"].get("end_of_word_suffix")
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.splits = bool(suffix) and steps == _NORMALIZERS and bool(cuts) and cuts[0].get("pattern") == {"Regex": _PATTERN}
        # ids of words (empty: not a word of letters) and of any other chunk
        self.words, self.others = _Remembered(words), _Remembered(words)
        if self.splits:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            own = self.tokenizer.get_vocab(with_added_tokens=False)
            self.last = np.zeros(max(own.values()) + 1, bool)
            self.last[[i for token, i in own.items() if token.endswith(suffix)]] = True

    def _normal(self, word: bytes) -> str | None:
        """The word as the model sees it; None if it is not one of letters alone."""
        text = word.decode("utf-8", "replace")
        if not text.isascii():
            # some letters come apart, or together, when they are normalised
            text = self.tokenizer.normalizer.normalize_str(text)
        return text if text.isalpha() else None

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words (ASCII ones in lower case); empty for what is not a word of letters."""
        out = [self.words.find(w) for w in words]
        new = [(i, self._normal(w)) for i, (w, ids) in enumerate(zip(words, out, strict=True)) if ids is None]
        # encoded in one go: a word ends where a token with the suffix does
        normals = [n for _, n in new if n is not None]
        ids = np.array(self.model.encode(" ".join(normals), add_special_tokens=False).ids if normals else [], "<u4")
        ends, data = iter(((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()), ids.tobytes()
        at = 0
        for i, normal in new:
            found = b""
            if normal is not None:
                end = next(ends)
                found, at = data[at:end], end
            out[i] = found
            if len(words[i]) <= CHUNK_BYTES:
                self.words[words[i]] = found
        return out

    def _other_ids(self, chunk: bytes) -> bytes:
        found = self.others.find(chunk)
        if found is None:
            found = array("I", self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
            if len(chunk) <= CHUNK_BYTES:
                self.others[chunk] = found
        return found

    def _parts(self, chunks: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of parts (the first one is empty), and the two parts of each chunk."""
        at, data = np.frombuffer(chunks.buffers()[1], np.int64), np.frombuffer(chunks.buffers()[2] or b"", np.uint8)
        n = len(chunks)
        if not n or not self.splits:
            return [b"", *map(self._other_ids, chunks.to_pylist())], np.arange(1, n + 1), np.zeros(n, np.int64)
        at, data = at[chunks.offset : chunks.offset + n + 1], data[: at[chunks.offset + n]]
        data, at = data[at[0] :], at - at[0]
        sizes = np.diff(at)
        place = np.arange(1, len(data) + 1)
        ends = np.maximum(np.maximum.reduceat(np.where(_MARK[data], 0, place), at[:-1]), at[:-1])
        ascii_only = np.maximum.reduceat(data, at[:-1]) < 128
        inside = place <= np.repeat(ends, sizes)
        lowered = np.where(np.repeat(ascii_only, sizes), _LOWER[data], data)
        words = _strings(lowered[inside], np.cumsum(ends - at[:-1])).dictionary_encode()
        marks = _strings(data[~inside], np.cumsum(at[1:] - ends)).dictionary_encode()
        ids = self._word_ids(words.dictionary.to_pylist())
        tails = [self._other_ids(m) if m else b"" for m in marks.dictionary.to_pylist()]
        first = words.indices.to_numpy().astype(np.int64) + 1
        second = marks.indices.to_numpy().astype(np.int64) + 1 + len(ids)
        whole = np.flatnonzero(~np.array([bool(x) for x in ids])[first - 1])
        found = [b"", *ids, *tails, *map(self._other_ids, chunks.take(pa.array(whole)).to_pylist())]
        first[whole], second[whole] = len(ids) + len(tails) + 1 + np.arange(len(whole)), 0
        return found, first, second

    def _encode(self, data: np.ndarray, at: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        keep = ~_SPACE[data]
        first = keep.copy()
        first[1:] &= ~keep[:-1]
        begins = at[:-1][np.diff(at) > 0]
        first[begins] = keep[begins]
        text = data[keep]
        starts = np.flatnonzero(first[keep])
        coded = _strings(text, np.append(starts[1:], len(text)) if len(starts) else starts).dictionary_encode()
        found, one, two = self._parts(coded.dictionary)
        self.words.turn()
        self.others.turn()

        if end is not None:
            found.append(np.array([end], "<u4").tobytes())
        many = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(many) - many
        flat = np.frombuffer(b"".join(found), "<u4")
        # chunks before each text's end, counted among the chunks of all texts
        ends = np.searchsorted(np.flatnonzero(first), at)
        codes = coded.indices.to_numpy()
        parts = np.stack([one[codes], two[codes]], axis=1)
        if end is not None:
            parts = np.insert(parts, ends[1:], [len(found) - 1, 0], axis=0)
            ends = ends + np.arange(len(ends))
        parts = parts.ravel()
        after = np.cumsum(many[parts])
        take = np.arange(after[-1] if len(after) else 0) + np.repeat(begins[parts] - after + many[parts], many[parts])
        return flat[take], np.r_[0, after][2 * ends]

    def encode(self, texts: pa.Array, end: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, ids, places where a text's ids begin and end) for some MB of texts at a time.

        ``texts`` are UTF-8 bytes without nulls; ``end`` is appended to each text's ids.
        """
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(at, at[a] + AT_ONCE, "right")) - 1)
            yield (a, *self._encode(data[at[a] : at[b]], at[a : b + 1] - at[a], end))
            a = b

    def ids(self, text: bytes) -> bytes:
        """All ids of one text, 4 bytes each, little-endian."""
        return b"".join(ids.tobytes() for _, ids, _ in self.encode(pa.array([text], pa.large_binary())))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
