"""Byte-pair encoding of whole texts with a public tokenizer file and a bounded memo of pieces."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Entries of one generation of a memo. A full one becomes the old generation, which answers until the next is full: memory stays bounded whatever the corpus.
MEMO = 350_000
#: Longer pieces aren't kept.
LONGEST = 48
#: Bytes of texts whose words are told apart together; the text that reaches them still belongs to the run.
RUN = 1 << 22
# U+180E counts as white space in some releases of Unicode, so no cut relies on it
_BLANK_BEFORE_SPACE = re.compile(r" (?<=[\s\u180e] )")
_CUT = re.compile(r"(?<=[^\s\u180e])(?= )")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# the characters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the rest are counted on from 256
_SELF = {*range(33, 127), *range(161, 173), *range(174, 256)}
_REST = [b for b in range(256) if b not in _SELF]
_BYTES = [chr(b) if b in _SELF else chr(256 + _REST.index(b)) for b in range(256)]
_WRITTEN = dict(enumerate(_BYTES))
#: Marks that are a piece of their own after a word when they end it.
_MARKS = frozenset(".,;:!?)")


def safe_cuts(text: str) -> list[str]:
    """The text in parts, each cut being before a space that follows a non-blank. A byte-level BPE never has a token across such a cut."""
    if _BLANK_BEFORE_SPACE.search(text):
        return _CUT.split(text)
    head, *rest = text.split(" ")
    return [head, *(" " + w for w in rest)] if head else [" " + w for w in rest] or [""]


class _Memo(dict):
    """Ids, as bytes, by text; what is missing is computed and kept."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.compute(key)
            if len(key) > LONGEST:
                return ids
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


class _Words(_Memo):
    """Ids of a space and a word. A mark at the end of a word of letters is a piece of its own, so such words aren't kept with each mark."""

    def __init__(self, encoder: Encoder):
        super().__init__(encoder._word)
        self.pieces = encoder.pieces

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in _MARKS and word[:-1].isalpha():
            return self[word[:-1]] + self.pieces[word[-1]]
        return super().__missing__(word)


class Encoder:
    """Encodes texts to ids held as little-endian bytes of the narrowest unsigned type that fits the vocabulary.

    The tokenizer must be a byte-level BPE that splits words as GPT-2 does. Words between safe cuts come from a memo, words that aren't in it are
    split into pieces, and the tokenizer's model encodes pieces that aren't in theirs. A text that contains an added token's string is given to the
    tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _Memo(self._piece)
        self.words = _Words(self)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(_WRITTEN)
        return array(self.code, [t.id for t in self.model.tokenize(written)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a space and a word; a word of letters is one piece."""
        return self._piece(" " + word) if word.isalpha() else self.part(" " + word)

    def part(self, text: str) -> bytes:
        """Ids of a part between safe cuts that holds no added token."""
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))

    def special(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def encode(self, text: str) -> bytes:
        if self.special(text):
            return self.whole(text)
        if _BLANK_BEFORE_SPACE.search(text):
            return b"".join(self.part(p) if p[:1] != " " else self.words[p[1:]] for p in _CUT.split(text))
        head, *rest = text.split(" ")
        return self.part(head) + b"".join(map(self.words.__getitem__, rest))

    def runs(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts one after the other, each text's followed by `end_id`, and the number of each text's ids; a run of texts at a time. No text is null."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(np.concatenate([[0], ends[:-1]]) // RUN)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
            if low < high:
                yield self._run(texts.slice(low, high - low), np.array([end_id], self.dtype).tobytes())

    def _run(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Each distinct word of the run is looked up once; ids are then gathered by the words' numbers. What stands before a text's first space is no such
        word, and a text that can't be cut at every space is one with nothing after it."""
        strings = texts.to_pylist()
        odd = [self.special(t) or bool(_BLANK_BEFORE_SPACE.search(t)) for t in strings]
        heads = [self.encode(t) if o else self.part(t.partition(" ")[0]) for t, o in zip(strings, odd)]
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts) if any(odd) else texts, " ")
        words = lists.flatten().dictionary_encode()
        table = [*map(self.words.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)), *heads, end]
        counts = lists.value_lengths().to_numpy().astype(np.int64)
        after = np.cumsum(counts)
        codes = words.indices.to_numpy().copy()
        codes[after - counts] = len(words.dictionary) + np.arange(len(heads))
        codes = np.insert(codes, after, len(table) - 1)
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // self.dtype.itemsize
        first = np.cumsum(sizes) - sizes
        taken = sizes[codes]
        upto = np.cumsum(taken)
        ids = np.frombuffer(b"".join(table), self.dtype)[np.arange(upto[-1]) + np.repeat(first[codes] - upto + taken, taken)]
        return ids, np.diff(upto[np.cumsum(counts + 1) - 1], prepend=0)


_OPEN: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]
