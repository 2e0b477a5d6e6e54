"""Whole texts to token ids on the executors, with a public tokenizer file.

The tokenizer file drops white space and never joins characters across it, so
the ids of a text are the ids of its white-space separated words in a row
(tested against whole-text encoding). Words repeat, so each Python worker
keeps the ids of words it has met, in a cache of bounded size; every word is
still encoded by the ``tokenizers`` library.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: words in each of the two generations of a worker's cache
CACHE_WORDS = 200_000
#: longer words are encoded without being kept
CACHE_WORD_CHARS = 64
#: characters of text encoded together
GROUP_CHARS = 3 << 20
#: largest tokenizer file that is broadcast
MAX_TOKENIZER_BYTES = 64 << 20


#: marks after a letter and before white space: a piece of their own to the pre-tokenizer
_MARKS = r"([A-Za-z])([.,;:!?]+)(\s|$)"
#: Latin letters (composed, one piece to the pre-tokenizer) and any ASCII marks after them (another piece)
_LETTERS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-/:-@\\[-`{-~]*)")


_SPACE = re.compile(r"[ \t\n\x0b\x0c\r]")


_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _packed(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACK[n](*ids) if n < 64 else np.array(ids, "<u4").tobytes()


class _WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit integers.

    Two generations bound the memory: when the young one is full it becomes
    the old one, and words found in the old one move back to the young."""

    def __init__(self, encode: Callable[[str], bytes], encode_letters: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.encode_letters = encode, encode_letters
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word.isalpha() and word.islower():
                ids = self.encode_letters(word)
            elif not (simple := _LETTERS.fullmatch(word)):
                ids = self.encode(word)
            elif simple[2]:
                ids = self[simple[1].lower()] + self[simple[2]]
            elif (low := word.lower()) != word:
                ids = self[low]
            else:
                ids = self.encode_letters(word)
        if len(word) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Texts to ids (bytes of little-endian unsigned 32-bit integers)."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._model = self._tokenizer.model
        self._marks = [t.content.lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        if any(c in m for m in self._marks for c in ".,;:!?"):
            raise ValueError("added tokens with punctuation marks are not provided for")
        self._pieces: dict[str, str] = {}
        self._words = _WordIds(self._plain, self._letters)

    def _plain(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        """A lower-case word of Latin letters: the normaliser leaves it as it is
        and the pre-tokenizer maps it letter by letter, so the library's model
        can be asked directly."""
        if not word.isascii():
            pieces = self._pieces
            for c in word:
                if c not in pieces:
                    pieces[c] = "".join(p for p, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(c))
            word = "".join([pieces[c] for c in word])
        return _packed([t.id for t in self._model.tokenize(word)])

    def _prepared(self, text: str) -> str:
        """The tokenizer lower-cases; doing so first in ASCII texts lets more
        words share an entry. Its added tokens are matched in the letter case
        given, so texts that hold one stay as they are."""
        if text.isascii():
            low = text.lower()
            return text if any(m in low for m in self._marks) else low
        return text

    def many(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text; all words are split and numbered at once."""
        parts, owner = [], []
        for k, text in enumerate(texts):
            for part in _parts(text or ""):
                parts.append(self._prepared(part))
                owner.append(k)
        count = owner[-1] + 1 if owner else 0
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pa.array(parts, pa.large_string()), _MARKS, r"\1 \2\3"))
        coded = lists.flatten().dictionary_encode()
        encoded = [self._words[w] for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        first = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(encoded), "<u4")
        word = coded.indices.to_numpy()
        length = sizes[word]
        ends = np.concatenate([[0], np.cumsum(length)])
        # word by word the run of its ids
        at = np.repeat(first[word] - ends[:-1], length)
        at += np.arange(len(at))
        ids = ids[at]
        bounds = ends[lists.offsets.to_numpy()]
        out = [b""] * count
        for k, a, b in zip(owner, bounds[:-1].tolist(), bounds[1:].tolist()):
            out[k] += ids[a:b].tobytes()
        return out

    def __call__(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def stream(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bytes]]:
        """(first column's value, ids of the second column's text) of every row,
        encoded about ``GROUP_CHARS`` characters at a time."""
        for batch in batches:
            keys, texts, size = [], [], 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                keys.append(batch.column(0)[i].as_py())
                texts.append(text)
                size += len(text or "")
                if size >= GROUP_CHARS or i + 1 == batch.num_rows:
                    yield from zip(keys, self.many(texts))
                    keys, texts, size = [], [], 0


def _parts(text: str) -> Iterator[str]:
    """A very long text in parts of about ``GROUP_CHARS``, cut at ASCII white
    space; a single word of that length stays whole."""
    while len(text) > GROUP_CHARS:
        space = _SPACE.search(text, GROUP_CHARS)
        if not space:
            break
        yield text[:space.start()]
        text = text[space.end():]
    yield text


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def encoder_of(definition: Broadcast) -> Encoder:
    """The worker's encoder (and its word cache, kept from task to task)."""
    return _encoder(definition.value)


def broadcast_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's definition, read once on the driver. Its size does not
    depend on the data and is checked."""
    size = os.path.getsize(path)
    if size > MAX_TOKENIZER_BYTES:
        raise ValueError(f"tokenizer file of {size} bytes is over {MAX_TOKENIZER_BYTES}")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())
