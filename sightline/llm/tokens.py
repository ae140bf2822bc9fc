"""Token ids by the tokenizers library, each distinct piece of a text encoded once per worker."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

#: Kinds of bytes, ASCII only: what a cut may lie before, white space as ``str.isspace`` has it, dot and comma, letters.
LEAD, SPACE, STOP, LETTER = 1, 2, 4, 8
KINDS = bytes(
    LEAD * (x in " \n") + SPACE * x.isspace() + STOP * (x in ".,") + LETTER * x.isalpha() if x < "\x80" else 0
    for x in map(chr, range(256))
)


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of spans, one span after another."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Learnt(dict):
    """Numbers of pieces; the ids of number ``n`` are ``ids[ends[n] : ends[n + 1]]``."""

    def __init__(self):
        super().__init__()
        self.ids, self.ends = np.zeros(1 << 12, "<u4"), np.zeros(1 << 10, np.int64)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Pieces that are not here yet, with their ids one after another."""
        n, at = len(self), int(self.ends[len(self)])
        self.ids = self._room(self.ids, at + len(ids))
        self.ends = self._room(self.ends, n + len(sizes) + 1)
        self.ids[at : at + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(sizes)] = at + np.cumsum(sizes)
        self.update(zip(pieces, range(n, n + len(sizes)), strict=True))

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.append(array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype))

    def rows(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, -1 where it is not here."""
        return np.fromiter(map(self.get, pieces, repeat(-1)), np.int64, len(pieces))

    def spans(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each number begin, and how many it has."""
        return self.ends[rows], self.ends[rows + 1] - self.ends[rows]

    @property
    def weight(self) -> int:
        """The number of pieces, where they have 8 ids on average or fewer."""
        return max(len(self), int(self.ends[len(self)]) // 8)


class PieceTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Encoding a text piece by piece gives the same ids where the tokenizer's own rule cuts between
    the pieces anyway, and lets the library see a repeated piece once. Two rules are known:

    - ``attached`` (byte-level BPE, a space belongs to the word after it): cuts lie before a single
      space or line feed that stands between two characters that are not white space, and between an ASCII
      letter and a dot or comma. A text with white space beyond ASCII at a piece's edge is cut by the slower ``SAFE``.
    - otherwise (white space is dropped): every space and line feed is a cut.

    Texts are cut and their pieces numbered about ``GROUP`` characters at a time, and new pieces are
    learnt many at a time in one joined text. About ``most`` are kept (fewer long ones), in two
    generations: when the younger has half of them, the older is forgotten but for pieces that were met
    again. A text that may hold the name of an added token is encoded whole, as the library does by default.
    """

    SAFE = re.compile(r"(?<=\S) (?=\S)")
    WHITE = re.compile(r"\s")
    JOINED = 512
    GROUP = 1 << 21

    def __init__(self, path: str, attached: bool, most: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the first characters of added tokens; the tokenizers' normal forms do not make them from others
        self.added = sorted({token.content[:2] for token in self.tokenizer.get_added_tokens_decoder().values()})
        self.attached = attached
        self.most = most
        # With ``attached`` a piece that follows a space goes by its name alone, one that follows a
        # line feed keeps that before it, and one that follows a letter has a space before it. A
        # piece that must not stand at a cut has no ids.
        self.known, self.older = Learnt(), Learnt()
        self.gap = int(self._ids("\n" if attached else "\x00")[0])
        if attached:
            self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.spaced[[i for token, i in self.tokenizer.get_vocab().items() if token[0] == "Ġ"]] = True

    def _one(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _single(self, piece: str, before: str) -> np.ndarray:
        if before == "\n":
            return np.append(np.array([self.gap], "<u4"), self._ids(piece))
        return self._ids(before + piece)

    def _joined(self, pieces: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, with those of what is ``before`` each, and how many each
        has, from one call: pieces are told apart by what stands between them."""
        if self.attached:
            between = before or "\n"
            ids = self._ids(between + between.join(pieces))
        else:
            ids = self._ids("\x00 " + " \x00 ".join(pieces))
        apart = self.spaced[ids] if before == " " else ids == self.gap
        starts = np.flatnonzero(apart)
        if len(starts) != len(pieces) or starts[0]:  # a piece that holds what tells them apart
            return self._singles(pieces, before)
        sizes = np.diff(starts, append=len(ids))
        return (ids, sizes) if before else (ids[~apart], sizes - 1)

    def _singles(self, pieces: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._single(x, before) for x in pieces]
        return np.concatenate(ids), np.array([len(x) for x in ids])

    def _learn(self, new: set[str]) -> None:
        if not self.attached:
            if "" in new:
                self.known.add([""], np.zeros(0, "<u4"), np.zeros(1, np.int64))
            self._fill([x for x in new if x], "", 0, self._joined)
            return
        heads, bare = [x for x in new if x[0] == "\n"], [x for x in new if x[0] == " "]
        for before, lead, keys in ((" ", 0, list(new.difference(heads, bare))), ("\n", 1, heads), ("", 1, bare)):
            if self.WHITE.search("".join([x[lead:] for x in keys])):
                spread = {x for x in keys if self.WHITE.search(x, lead)}
                odd = [x for x in spread if any(c > "\x7f" and c.isspace() for c in (x[lead], x[-1]))]
                self.known.add(odd, np.zeros(0, "<u4"), np.zeros(len(odd), np.int64))
                self._fill(list(spread.difference(odd)), before, lead, self._singles)
                keys = [x for x in keys if x not in spread]
            self._fill(keys, before, lead, self._joined)

    def _fill(self, keys: list[str], before: str, lead: int, encoded: Callable) -> None:
        for at in range(0, len(keys), self.JOINED):
            some = keys[at : at + self.JOINED]
            self.known.add(some, *encoded([x[lead:] for x in some], before))

    def _slow(self, text: str) -> bytes:
        first, *rest = self.SAFE.split(text)
        return b"".join([self._one(first), *(self._one(" " + piece) for piece in rest)])

    def _cuts(self, data: bytes) -> np.ndarray:
        """By byte: does a piece begin here? The first and the last byte are line feeds."""
        kinds = np.frombuffer(data.translate(KINDS), np.uint8)
        cuts = (kinds & LEAD).astype(bool)
        if self.attached:
            left, own, right = kinds[:-2], kinds[1:-1], kinds[2:]
            cuts[1:-1] &= (left | right) & SPACE == 0
            cuts[1:-1] |= (own & STOP) * 2 & left != 0
        return cuts

    def _keys(self, pieces: list[str]) -> list[str]:
        if not self.attached:
            return [x[1:] for x in pieces]
        return [x[1:] if x[0] == " " else x if x[0] == "\n" else " " + x for x in pieces]

    def _spans(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = self.known.rows(keys)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            asked = [keys[i] for i in missing.tolist()]
            new = set(asked)
            again = [x for x in new if x in self.older]
            begins, sizes = self.older.spans(self.older.rows(again))
            self.known.add(again, self.older.ids[_spans(begins, sizes)], sizes)
            new.difference_update(again)
            if new:
                self._learn(new)
            rows[missing] = self.known.rows(asked)
        return self.known.spans(rows)

    def _by_pieces(self, texts: list[bytes]) -> list[bytes | None]:
        """Ids of texts that are not empty; none where a piece must not stand at a cut."""
        if not texts:
            return []
        data = b"\n" + b"\n".join(texts) + b"\n"
        bounds = np.cumsum([0, *(len(x) + 1 for x in texts)])
        cuts = self._cuts(data)
        cuts[bounds] = True
        begins = np.flatnonzero(cuts)
        buffers = [None, pa.py_buffer(begins.astype(np.int64, copy=False)), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins) - 1, buffers).dictionary_encode()
        spans, sizes = self._spans(self._keys(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        numbers = pieces.indices.to_numpy()
        firsts = np.searchsorted(begins, bounds)
        odd = np.zeros(len(texts), bool)
        if self.attached and not sizes.all():
            odd = np.logical_or.reduceat((sizes == 0)[numbers], firsts[:-1])
        own = sizes[numbers]
        ids = self.known.ids[_spans(spans[numbers], own)].tobytes()
        ends = 4 * np.append(0, np.cumsum(own))[firsts]
        drop = 4 * self.attached  # the line feed put before a text
        return [None if o else ids[a + drop : b] for a, b, o in zip(ends[:-1].tolist(), ends[1:].tolist(), odd.tolist(), strict=True)]

    def _groups(self, texts: list[str | None]) -> Iterator[list[str]]:
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= self.GROUP:
                yield group
                group, size = [], 0
        yield group

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, a null one as an empty one; nothing is added."""
        out = []
        for group in self._groups(texts):
            if 2 * self.known.weight > self.most:
                self.older, self.known = self.known, Learnt()
            whole = [any(start in t for start in self.added) for t in group]
            by_pieces = iter(self._by_pieces([t.encode() for t, w in zip(group, whole, strict=True) if t and not w]))
            for text, is_whole in zip(group, whole, strict=True):
                ids = (self._one(text) if is_whole else next(by_pieces)) if text else b""
                out.append(self._slow(text) if ids is None else ids)
        pa.default_memory_pool().release_unused()  # workers would keep the largest group's memory
        return out


_LOADED: dict[tuple, PieceTokenizer] = {}


def loaded(path: str, attached: bool, most: int = 1_200_000) -> PieceTokenizer:
    """The worker's tokenizer of this file, with what it has learnt in earlier tasks."""
    if (path, attached) not in _LOADED:
        _LOADED[path, attached] = PieceTokenizer(path, attached)
    _LOADED[path, attached].most = most
    return _LOADED[path, attached]


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
