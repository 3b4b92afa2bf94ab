"""Encoding of whole texts with a public tokenizer file, many texts at a time.

A byte-level BPE never merges across the pieces that its published pattern cuts. For texts of
plain Latin characters these cuts are found in numpy over the code points of many texts, each
piece is looked up by a 64-bit hash in a table that a worker keeps, and only pieces not found
there are encoded by the tokenizers library (its own model, many pieces a call). All other
texts, those that hold the string of a special token, and files of another kind, go through
the library whole.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from ._common import _P, _PINV, KEPT, _powers, code_points, slices

#: Entries of a worker's table of pieces, and the ids that it holds before it starts anew.
TABLE, POOL = 1 << 20, 6_000_000
#: Code points below this one have the same class in every version of Unicode.
PLAIN = 0x250
_LETTER, _NUMBER, _OTHER, _SPACE, _ODD = range(5)
_OPEN: dict[str, Encoder] = {}
KEPT.append(_OPEN)


def classes() -> np.ndarray:
    """The pattern's class of each plain code point; a last entry stands for all that isn't plain."""
    white = {*range(9, 14), 32, 0x85, 0xA0}
    kind = lambda c: _SPACE if c in white else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER)
    return np.array([*map(kind, range(PLAIN)), _ODD], np.int8)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself if it is printable Latin-1, else the next from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def pieces(points: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pattern's pieces in plain texts, each followed by a line feed at ``ends``, which belongs to none.

    A run of letters, of numbers or of other characters is a piece, with one space before it.
    White space before such a run gives up its last character: to the run if that is a space,
    else to a piece of its own; the rest, and white space at the end, is one piece. An
    apostrophe that begins a run and one of seven endings after it are a piece.
    """
    n = len(points)
    last = np.zeros(n, bool)
    last[ends] = True
    white = kind == _SPACE
    start = np.ones(n, bool)
    start[1:] = (kind[1:] != kind[:-1]) | last[:-1]
    lone = white & ~last  # white space whose next character is none and belongs to the same text
    lone[:-1] &= ~white[1:]
    lone[-1] = False
    start |= lone
    joins = lone & (points == 32)
    start[1:] &= ~joins[:-1]
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        at = lambda k: points[np.minimum(quote + k, n - 1)]
        a, b = at(1), at(2)
        two = (a == 115) | (a == 116) | (a == 109) | (a == 100)
        three = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)
        for which, size in ((two, 2), (three, 3)):
            q = quote[which]
            start[q + 1] = False
            start[np.minimum(q + size, n - 1)] |= True
    start[ends] = True  # closes the last piece of a text
    at = np.flatnonzero(start)
    stop = np.append(at[1:], n)
    own = ~last[at]
    return at[own], stop[own]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        words = self.tokenizer.get_vocab()
        self.wide = max(words.values(), default=0) >= 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.length = np.ones(max(words.values(), default=0) + 1, np.int64)
        for token, k in words.items():
            self.length[k] = len(token)  # a character per byte
        self.characters = byte_characters()
        said = json.loads(self.tokenizer.to_str())
        before = said.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in said.get("added_tokens", [])]
        self.cuts = said.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        self.classes = classes()
        self.values = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, PLAIN + 1, dtype=np.uint64)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(TABLE, np.uint64)
        self.spans = np.zeros((TABLE, 2), np.int64)
        self.pool = np.zeros(POOL + (1 << 16), self.kind)
        self.used = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        for i, j in slices(np.array([len(t) for t in texts], np.int64), 500_000):
            points, begin = code_points(texts[i:j])
            kind = self.classes[np.minimum(points, PLAIN)]
            odd = np.zeros(j - i, bool)
            odd[np.searchsorted(begin, np.flatnonzero(kind == _ODD), side="right") - 1] = True
            for k in range(i, j):
                if odd[k - i] or not self.cuts or any(s in texts[k] for s in self.special):
                    odd[k - i] = True
                    out[k] = self.whole(texts[k])
            if odd.all():
                continue
            kind = np.where(kind == _ODD, _OTHER, kind)
            start, stop = pieces(points, kind, begin[1:] - 1)
            good = ~odd[np.searchsorted(begin, start, side="right") - 1] if odd.any() else slice(None)
            start, stop = start[good], stop[good]
            ids, size = self.look_up(texts[i:j], begin, points, start, stop)
            cut = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, begin)]
            for k in np.flatnonzero(~odd).tolist():
                out[i + k] = ids[cut[k] : cut[k + 1]]
        return out

    def look_up(self, texts: list[str], begin: np.ndarray, points: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        with np.errstate(over="ignore"):
            sums = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(self.values[np.minimum(points, PLAIN)] * _powers(_P, len(points)), out=sums[1:])
            key = (sums[stop] - sums[start]) * _powers(_PINV, len(points) + 1)[start]
            key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
        if self.used > POOL:
            self.forget()
        slot = (key >> np.uint64(44)).astype(np.int64)
        span = self.spans[slot]
        miss = np.flatnonzero(self.keys[slot] != key)
        if len(miss):
            _, first, inverse = np.unique(key[miss], return_index=True, return_inverse=True)
            new = miss[first]
            joined = "\n".join(texts) + "\n"
            fresh = self.learn([joined[a:b] for a, b in zip(start[new].tolist(), stop[new].tolist(), strict=True)])
            span[miss] = fresh[inverse]
            self.keys[slot[new]], self.spans[slot[new]] = key[new], fresh
        size = span[:, 1]
        before = np.cumsum(size) - size
        ids = self.pool[np.repeat(span[:, 0] - before, size) + np.arange(int(size.sum()))]
        return ids, size

    def learn(self, new: list[str]) -> np.ndarray:
        """Encodes pieces into the pool; place and number of ids of each."""
        spelt = [x.encode("utf-8").decode("latin-1").translate(self.characters) for x in new]
        out = []
        for i in range(0, len(spelt), 500):
            part = spelt[i : i + 500]
            ids = np.array(self.model.encode_batch_fast([part], is_pretokenized=True, add_special_tokens=False)[0].ids, self.kind)
            ends = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum([len(x) for x in part])) + 1
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), self.kind)])
            self.pool[self.used : self.used + len(ids)] = ids
            at = np.concatenate(([0], ends))
            out.append(np.stack([self.used + at[:-1], np.diff(at)], axis=1))
            self.used += len(ids)
        return np.concatenate(out)


def encoder(path: str) -> Encoder:
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
