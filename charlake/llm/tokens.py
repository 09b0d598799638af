"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once.

Both vocabularies cut a text before they merge anything: the byte-level one always cuts before a space
that a non-space follows, the word one at all white space. So ids of a text are the ids of its pieces
between those cuts, one after another, and a piece seen before need not be encoded again. Texts where
that rule does not plainly hold (a space before white space, control separators, the vocabulary's own marks such as
an end of text) are encoded whole, by the library's defaults. The word vocabulary lowers all letters, so words are looked
up with A-Z lowered.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np

# Pieces a worker remembers between texts (beyond it, the half met most often stays), and pieces encoded in one call.
REMEMBERED = 1_000_000
AT_ONCE = 256

_SPACE_THEN_WHITE = re.compile(r" (?:\s|$)")
_WHITE_AT_NEWLINE = re.compile(r"\n(?:\s|\Z|(?<=\s\n))")
_ODD_SEPARATORS = re.compile("[\x1c-\x1f]")


class _Codes(dict):
    """Numbers of pieces; a piece not seen before gets the next number and is listed as new."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        code = self[piece] = len(self)
        self.new.append(piece)
        return code


class Encoder:
    """ids of texts with one vocabulary file; `kind` is "bytes" or "words", as the file cuts its texts."""

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings the vocabulary has whole, whatever stands around them.
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = kind
        # What is put between pieces that are encoded together; it must come out as one id that no piece has.
        self.mark = "\n" if kind == "bytes" else "7"
        self.between = "\n" if kind == "bytes" else " 7 "
        (self.mark_id,) = self._whole([self.mark])[0]
        self.codes = _Codes()
        self.starts, self.lengths, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        """Pieces met again since the last time stay, the half met most often at most."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[: REMEMBERED // 2])
        kept = kept[self.met[kept] > 1]
        pieces = list(self.codes)
        self.codes = _Codes()
        self.codes.update((pieces[k], i) for i, k in enumerate(kept.tolist()))
        starts, self.lengths = self.starts[kept], self.lengths[kept]
        ends = np.cumsum(self.lengths)
        self.starts = ends - self.lengths
        self.ids = self.ids[np.arange(self.lengths.sum()) + np.repeat(starts - self.starts, self.lengths)]
        self.met = np.zeros(len(kept), np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces not seen before; plain ones (no white space but a leading space) are encoded many at a time."""
        plain = [i for i, p in enumerate(pieces) if p.isprintable() and self.mark not in p]
        groups = [plain[k : k + AT_ONCE] for k in range(0, len(plain), AT_ONCE)]
        starts, lengths = np.full(len(pieces), -1, np.int64), np.zeros(len(pieces), np.int64)
        found, size = [self.ids], len(self.ids)
        for group, ids in zip(groups, self._whole([self.between.join([pieces[i] for i in g]) for g in groups]), strict=True):
            values = np.asarray(ids, np.uint32)
            cuts = np.flatnonzero(values == self.mark_id)
            if len(cuts) == len(group) - 1:
                first = np.concatenate([[0], cuts + 1])
                starts[group] = size + first
                lengths[group] = np.append(cuts, len(values)) - first
                found.append(values)
                size += len(values)
        rest = np.flatnonzero(starts < 0).tolist()
        for i, ids in zip(rest, self._whole([pieces[i] for i in rest]), strict=True):
            starts[i], lengths[i] = size, len(ids)
            found.append(np.asarray(ids, np.uint32))
            size += len(ids)
        self.ids = np.concatenate(found)
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        self.met = np.concatenate([self.met, np.zeros(len(pieces), np.int64)])

    def _pieces(self, text: str) -> list[str] | None:
        if self.kind == "words":
            text = text.encode().lower().decode()  # A-Z alone
        if any(s in text for s in self.special):
            return None
        if self.kind == "words":
            return None if _ODD_SEPARATORS.search(text) else text.split()
        if _SPACE_THEN_WHITE.search(text) or "\0" in text:
            return None
        marked = text.replace(" ", "\0 ")
        if not text.startswith("\n") and not _WHITE_AT_NEWLINE.search(text):  # a newline between two words stands alone
            marked = marked.replace("\n", "\0\n\0")
        return marked.split("\0")

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text as an array of unsigned 32-bit numbers."""
        cut = [self._pieces(t) for t in texts]
        if len(self.codes) > REMEMBERED:
            self._forget()
        counts = [len(c) if c else 0 for c in cut]
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(c for c in cut if c)), np.int64, sum(counts))
        if self.codes.new:
            new, self.codes.new = self.codes.new, []
            self._learn(new)
        self.met += np.bincount(codes, minlength=len(self.met))
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.arange(total) + np.repeat(self.starts[codes] - ends + lengths, lengths)]
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        whole = iter(self._whole([t for t, c in zip(texts, cut, strict=True) if c is None]))
        return [np.asarray(next(whole), np.uint32) if c is None else flat[bounds[i] : bounds[i + 1]] for i, c in enumerate(cut)]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """This worker's encoder; it lives as long as the worker, so tasks that follow find its pieces."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
