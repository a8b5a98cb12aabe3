"""Byte-level BPE through the tokenizers library, with a memo of word-sized chunks.

A text is cut where one space stands between two non-space characters, and a chunk
after its leading letters where an ASCII punctuation mark follows.  The
pre-tokenizer of a byte-level vocabulary always starts a new piece at such a place
and no merge crosses a piece, so the ids of the chunks, joined, are the ids of the
text.  Common chunks are encoded once per worker instead of once per occurrence.
Added tokens of the vocabulary (such as `<|endoftext|>`) are found in texts as the
library finds them; a text that holds one is encoded whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")
_HEAD = r"(?s)^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>[!-/:-@\[-`{-~].*)$"
_PIECE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: How a byte-level vocabulary writes bytes: printable Latin-1 as itself, the others from U+0100 on.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_SPACE = chr(_SHOWN[32])
#: Chunks that one worker remembers; the memo is emptied when full.
MEMO_ENTRIES = 300_000
#: Characters of text encoded at once.
BLOCK_BYTES = 4 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        #: What the library takes for one token wherever it stands.
        self._added = sorted({t.content for t in self._tokenizer.get_added_tokens_decoder().values()})
        self._letters = [a for a in self._added if _PIECE(a)]
        self._reset()

    def _reset(self) -> None:
        self._memo: dict[str, int] = {}
        self._ids = np.empty(1 << 20, "<u4")
        self._starts = np.zeros(1 << 16, np.int64)
        self._used = self._known = 0

    def _add(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(chunks), self._known
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        while k + n >= len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
        self._ids[self._used : self._used + len(ids)] = ids
        np.cumsum(lengths, out=self._starts[k + 1 : k + n + 1])
        self._starts[k + 1 : k + n + 1] += self._used
        self._used += len(ids)
        self._memo.update(zip(chunks, range(k, k + n)))
        self._known = k + n

    def _gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known chunks, joined, and where each chunk's ids end."""
        starts = self._starts[index]
        lengths = self._starts[index + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self._ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)], ends

    def _index(self, chunks: list[str]) -> np.ndarray:
        memo = self._memo
        missing = list(dict.fromkeys(c for c in chunks if c not in memo))
        for at in range(0, len(missing), 8192):
            # letters alone are one piece: the model takes them as they are
            alone, mixed = [], []
            for c in missing[at : at + 8192]:
                (alone if _PIECE(c) and not (self._letters and any(a in c for a in self._letters)) else mixed).append(c)
            # of ASCII letters and a space only the space is written otherwise
            shown = [c.replace(" ", _SPACE) if c.isascii() else c.encode().decode("latin-1").translate(_SHOWN) for c in alone]
            found = [[t.id for t in self._merge(c)] for c in shown]
            found += [e.ids for e in self._tokenizer.encode_batch_fast(mixed, add_special_tokens=False)]
            self._add(alone + mixed, np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)))
        return np.fromiter(map(memo.__getitem__, chunks), np.int64, len(chunks))

    def _coded(self, words: pa.Array, space: str) -> np.ndarray:
        """The index of each word, after a space where space is one."""
        coded = words.dictionary_encode()
        return self._index([space + w for w in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]

    def _marked(self, texts: list[str]) -> np.ndarray:
        """Which texts hold an added token."""
        column, out = pa.array(texts, pa.large_string()), np.zeros(len(texts), bool)
        for token in self._added:
            out |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        return out

    def encode(self, texts: list[str], end_id: int | None = 0) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts as unsigned 32-bit integers, each text closed by end_id unless it is None; text i has ids[bounds[i]:bounds[i + 1]]."""
        if self._known > MEMO_ENTRIES or self._used > 8 * MEMO_ENTRIES:
            self._reset()
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        del lists
        words, codes = coded.dictionary, coded.indices.to_numpy()
        trimmed = pc.utf8_trim_whitespace(words)
        odd = pc.or_(pc.not_equal(trimmed, words), pc.equal(trimmed, "")).to_numpy(zero_copy_only=False)
        cut = pc.extract_regex(words, _HEAD)
        whole = pc.is_null(cut)
        heads = self._coded(pc.if_else(whole, words, pc.struct_field(cut, [0])), " ")
        rests = self._coded(pc.if_else(whole, "", pc.struct_field(cut, [1])), "")
        chunks = np.stack([heads, rests], axis=1)[codes]
        first, empty = offsets[:-1], self._index([""])[0]
        chunks[first, 0] = self._index(words.take(pa.array(codes[first])).to_pylist())
        chunks[first, 1] = empty
        counts = 2 * np.diff(offsets)
        marked = self._marked(texts)
        uncut = np.flatnonzero((np.add.reduceat(odd[codes], first) > 0) | marked) if len(texts) else []
        chunks = chunks.ravel()
        if len(uncut):
            at, pieces = 0, []
            for i in uncut:
                parts = [texts[i]] if marked[i] else _CUT.split(texts[i])
                pieces.append(chunks[at : 2 * offsets[i]])
                pieces.append(self._index([parts[0], *[" " + p for p in parts[1:]]]))
                counts[i], at = len(parts), 2 * offsets[i + 1]
            chunks = np.concatenate([*pieces, chunks[at:]])
        ids, ends = self._gather(chunks)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if end_id is not None:
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
        return ids.astype("<u4", copy=False), bounds


def id_type(path: str, end_id: int = 0) -> str:
    """The least unsigned type, 16 or 32 bits, that holds all ids of the vocabulary file at path, and end_id."""
    from tokenizers import Tokenizer

    return "<u2" if max(end_id, *Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else "<u4"


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for the vocabulary file at path."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
