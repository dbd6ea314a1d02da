"""Pre-token pieces of text batches, in numpy, with a table of known pieces.

The pre-tokenizers cut a text into pieces that are encoded each on its own.
Cutting needs only the class of each character (letter, number, space, other
white space, the rest); the classes are asked from the tokenizer library itself, once per
character that occurs, so its Unicode tables apply.  The texts of a batch are cut at
once; equal pieces are found by 64-bit hashes, and only pieces not seen
before are handed to an encoder.  The table of known pieces is bounded.

The hashes are polynomials modulo 2**64 whose base and letter values are
random in every worker (keys never leave it); a piece of more than ``SHORT``
characters is hashed by BLAKE2b under a random key, because such a polynomial
cannot tell some long words apart, whatever its base.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from reelhouse.llm.words import SHORT, long_hash, mix64

LETTER, NUMBER, OTHER, SPACE, WHITE, STOP, SPECIAL, UNKNOWN = range(8)
#: Lone surrogates, which no text holds, separate texts and stand for specials.
GAP, FIRST_SPECIAL = 0xD800, 0xD801
BATCH_CHARS = 1 << 19

_up_down: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_secret: dict[int, tuple[int, np.uint64, bytes]] = {}


def _secrets() -> tuple[int, np.uint64, bytes]:
    """Base, letter offset and key of this process (a forked worker draws its own)."""
    pid = os.getpid()
    if pid not in _secret:
        _secret.clear()
        _up_down.clear()
        _secret[pid] = (int.from_bytes(os.urandom(8), "little") | 1, np.uint64(int.from_bytes(os.urandom(8), "little")), os.urandom(16))
    return _secret[pid]


def _powers(n: int):
    size = BATCH_CHARS * 3 // 2 if n <= BATCH_CHARS * 3 // 2 else 1 << n.bit_length()
    if size not in _up_down:
        _up_down.clear()
        base = _secrets()[0]
        with np.errstate(over="ignore"):
            up, down = np.full(size + 1, base, np.uint64), np.full(size + 1, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            _up_down[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _up_down[size]


class Classes:
    """Character classes as a pre-tokenizer sees them."""

    def __init__(self, pre_tokenizer):
        self.pre = pre_tokenizer
        self.table = np.full(0x110000, UNKNOWN, np.uint8)
        self.table[GAP] = STOP
        self.table[FIRST_SPECIAL:FIRST_SPECIAL + 64] = SPECIAL
        self.of(np.arange(0x250, dtype=np.uint32))

    def _class(self, ch: str) -> int:
        def cut(s):
            return [b for _, b in self.pre.pre_tokenize_str(s)]
        if ch == " ":
            return SPACE
        if cut("a" + ch) == [(0, 2)]:
            return LETTER
        if cut("!" + ch) == [(0, 2)]:
            return OTHER
        if cut("1" + ch) in ([(0, 2)], [(0, 1), (1, 2)]) and cut("." + ch + "!") == [(0, 1), (1, 2), (2, 3)]:
            # white space that ends a run is kept by some patterns: it differs
            # from a number in joining white space
            return WHITE if cut("\n" + ch) == [(0, 2)] else NUMBER
        return WHITE

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        if (found == UNKNOWN).any():
            for p in np.unique(points[found == UNKNOWN]).tolist():
                self.table[p] = self._class(chr(p))
            found = self.table[points]
        return found


def _contractions(points, cls, start, after_space_joins):
    """Apply 's 't 're 've 'm 'll 'd: an apostrophe that is a run of its own
    and begins a piece takes the next one or two letters."""
    i = np.flatnonzero((points == 0x27) & start)
    i = i[(i + 1 < len(points))]
    if not len(i):
        return
    i = i[(cls[i + 1] == LETTER) & (cls[i - 1] != OTHER)]
    one = points[i + 1]
    two = points[np.minimum(i + 2, len(points) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for at, size in ((i[short], 2), (i[long], 3)):
        start[at + 1] = False
        nxt = at + size
        start[nxt[cls[nxt] == LETTER]] = True


def cut_spaced(points: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Piece starts (flags) of `'s|...| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`."""
    run = np.where(cls == WHITE, SPACE, cls)
    start = np.ones(len(points), bool)
    start[1:] = (run[1:] != run[:-1]) | (run[1:] >= STOP)
    solid = run < SPACE
    # a solid run after white space: its last white character is a piece of
    # its own or, when it is a space, begins the solid run's piece
    b = np.flatnonzero(start[1:] & solid[1:] & (run[:-1] == SPACE)) + 1
    start[b - 1] = True
    start[b[cls[b - 1] == SPACE]] = False
    _contractions(points, cls, start, True)
    return start


def cut_words(points: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Piece starts of `'s|...|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+`; white
    space makes pieces too, which the caller leaves out."""
    run = np.where(cls == WHITE, SPACE, cls)
    start = np.ones(len(points), bool)
    start[1:] = (run[1:] != run[:-1]) | (run[1:] >= STOP) | (run[1:] == NUMBER)
    _contractions(points, cls, start, False)
    return start


class Specials:
    """Special tokens inside texts, replaced by lone surrogates."""

    def __init__(self, ids: dict[str, int]):
        self.ids = list(ids.values())
        self.names = list(ids)
        self.find = re.compile("|".join(map(re.escape, sorted(ids, key=len, reverse=True)))) if ids else None

    def hide(self, text: str, normalize=None) -> str:
        if self.find is None or not self.find.search(text):
            return normalize(text) if normalize else text
        out, at = [], 0
        for m in self.find.finditer(text):
            part = text[at:m.start()]
            out += [normalize(part) if normalize else part, chr(FIRST_SPECIAL + self.names.index(m[0]))]
            at = m.end()
        return "".join([*out, normalize(text[at:]) if normalize else text[at:]])


def char_batches(texts: list[str], limit: int = BATCH_CHARS):
    """Ranges [a, b) of about ``limit`` characters."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


class Pieces:
    """Pieces of a batch: distinct ``values`` and their ``rows`` in the table,
    the ``code`` of each piece among them, and the piece range
    ``first[i]:first[i + 1]`` of each text."""

    def __init__(self, table: list, rows: np.ndarray, code: np.ndarray, first: np.ndarray):
        self.rows, self.code, self.first = rows, code, first
        self._table = table

    @property
    def values(self) -> list:
        return [self._table[r] for r in self.rows.tolist()]


class PieceTable:
    """Known pieces: sorted ``keys`` and the ``row`` of each in ``values``.
    ``encode(list of str)`` gives a value per new piece; special tokens get
    ``special(id)``."""

    def __init__(self, pre_tokenizer, specials: dict[str, int], encode, special, spaced: bool, cut=None, limit: int = 400_000):
        self.classes = Classes(pre_tokenizer)
        self.specials = Specials(specials)
        self.encode, self.special, self.spaced, self.limit = encode, special, spaced, limit
        self.cut = cut or (cut_spaced if spaced else cut_words)
        self.reset()

    def reset(self):
        self.keys, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.values: list = []

    def _keys(self, points, begin, end):
        _, offset, key = _secrets()
        up, down = _powers(len(points))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(mix_points(points, offset) * up[:len(points)], out=sums[1:])
            out = mix64((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
        for k in np.flatnonzero(end - begin > SHORT).tolist():
            out[k] = long_hash(points[begin[k]:end[k]].tobytes(), key)
        return out

    def look_up(self, texts: list[str], fold: np.ndarray | None = None) -> Pieces:
        """Values of all pieces of ``texts`` (specials already hidden)."""
        if len(self.values) > self.limit:
            self.reset()
        gap = chr(GAP)
        raw = (gap + gap.join(texts) + gap).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(raw, np.uint32)
        if fold is not None:
            points = np.where(points < len(fold), fold[np.minimum(points, len(fold) - 1)], points)
        cls = self.classes.of(points)
        begin = np.flatnonzero(self.cut(points, cls))
        end = np.append(begin[1:], len(points))
        gaps = cls[begin] == STOP
        wanted = ~gaps if self.spaced else ~(gaps | (cls[begin] == SPACE) | (cls[begin] == WHITE))
        first = np.concatenate([[0], np.cumsum(wanted)])[np.flatnonzero(gaps)]
        begin, end = begin[wanted], end[wanted]
        if not len(begin):
            return Pieces(self.values, np.zeros(0, np.int64), np.zeros(0, np.int64), first)
        coded = pa.array(self._keys(points, begin, end)).dictionary_encode()
        code = coded.indices.to_numpy()
        unique = coded.dictionary.to_numpy()
        place = np.searchsorted(self.keys, unique)
        rows = np.full(len(unique), -1, np.int64)
        if len(self.keys):
            near = np.minimum(place, len(self.keys) - 1)
            same = self.keys[near] == unique
            rows[same] = self.row[near[same]]
        new = np.flatnonzero(rows < 0)
        if len(new):
            at = np.zeros(len(unique), np.int64)
            at[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            fresh, plain = [], []
            for b, e in zip(begin[at[new]].tolist(), end[at[new]].tolist()):
                if cls[b] == SPECIAL:
                    fresh.append(self.special(self.specials.ids[int(points[b]) - FIRST_SPECIAL]))
                else:
                    plain.append((len(fresh), points[b:e].tobytes().decode("utf-32-le")))
                    fresh.append(None)
            for (k, _), value in zip(plain, self.encode([s for _, s in plain])):
                fresh[k] = value
            rows[new] = len(self.values) + np.arange(len(new))
            self.values += fresh
            order = np.argsort(unique[new])
            new = new[order]
            self.keys, self.row = np.insert(self.keys, place[new], unique[new]), np.insert(self.row, place[new], rows[new])
        return Pieces(self.values, rows, code, first)


def mix_points(points: np.ndarray, offset: np.uint64) -> np.ndarray:
    """A 64-bit word per code point."""
    with np.errstate(over="ignore"):
        x = (points.astype(np.uint64) + offset) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def vocabulary_path(name: str) -> str:
    """A path as it is, or a public vocabulary file by name."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(path: str):
    """(tokenizer, pre-tokenizer, special ids by string) of a vocabulary file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, tokenizer.pre_tokenizer, {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
