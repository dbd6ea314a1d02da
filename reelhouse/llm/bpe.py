"""Byte-pair vocabularies as finite-state machines over input symbols.

A vocabulary file (``tokenizers`` JSON) gives tokens and an ordered merge
list.  Symbols are bytes; with an end-of-word suffix the last byte of a word
is a symbol of its own (byte + 256).  A token is a string of symbols.

The machines rest on one property of a merge list: a token sequence is an
encoding exactly when every two neighbours are *compatible*, that is when no
merge of the list would have crossed the border between them before both were
complete (:meth:`Merges.compatible`).  So for every prefix of a word exactly
one token can end its encoding, and it follows from the last tokens of the
shorter prefixes that one vocabulary token can still reach.
"""

from __future__ import annotations

import codecs
import json
from functools import lru_cache

from tokenizers.pre_tokenizers import ByteLevel

INF = 1 << 60


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """Letter that the byte-level files write for each byte -> the byte."""
    text = "".join(map(chr, range(1, 0x180)))
    out = {}
    for ch in ["\x00", *text, "ࠀ", "一", "가", "\U00010000", "\U0010ffff",
               *map(chr, range(0x180, 0x10FFFF, 0x3B9))]:
        if 0xD800 <= ord(ch) < 0xE000:
            continue
        letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(ch)[0][0]
        out.update(zip(letters, ch.encode()))
    for b in range(256):  # bytes that no UTF-8 text holds stand for themselves
        if b not in out.values() and chr(b) not in out:
            out[chr(b)] = b
    return out


class Merges:
    """Tokens as symbol strings, merges, births, and compatibility."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))["model"]
        self.suffix = spec.get("end_of_word_suffix") or ""
        self.names = {i: name for name, i in spec["vocab"].items()}
        letters = byte_letters()

        def symbols(name: str) -> str:
            last = bool(self.suffix) and name.endswith(self.suffix) and len(name) > len(self.suffix)
            if last:
                name = name[:-len(self.suffix)]
            try:
                out = [letters[ch] for ch in name]
            except KeyError:
                return ""
            if last:
                out[-1] += 256
            return "".join(map(chr, out))

        vocab = spec["vocab"]
        self.symbols = {i: s for name, i in vocab.items() if (s := symbols(name))}
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.birth: dict[int, int] = {}
        for rank, merge in enumerate(spec["merges"]):
            left, right = merge if not isinstance(merge, str) else merge.split(" ")
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.pair.setdefault((a, b), (rank, c))
            if c not in self.birth:
                self.birth[c], self.split[c] = rank, (a, b)
        self._spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._compatible: dict[tuple[int, int], bool] = {}
        # Tokens that are the encoding of their own string, by symbol string,
        # and every proper beginning of one (itself as value: one object each).
        self.token, self.reach = {}, {}
        for i, s in self.symbols.items():
            if self.whole(i):
                self.token[s] = i
                for k in range(1, len(s)):
                    self.reach.setdefault(s[:k], s[:k])
        self.longest = max(map(len, self.token), default=0)
        self.lookahead = self._lookahead()

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(element, rank at which it is consumed) from the outermost symbol
        inwards up to ``token``; side 0: left edge, 1: right edge."""
        got = self._spines.get((token, side))
        if got is None:
            chain, t, death = [], token, INF
            while True:
                chain.append((t, death))
                if t not in self.split:
                    break
                death, t = self.birth[t], self.split[t][side]
            if len(self._spines) > 20_000:
                self._spines.clear()
            got = self._spines[token, side] = chain[::-1]
        return got

    def _crossing(self, left: int, right: int) -> tuple[int, int, int] | None:
        """First merge across the border of two tokens, if there is one: both
        edges grow in rank order, and at every moment the two outer elements
        may merge before either is consumed by its own side (of two equal
        ranks, the pair further left goes first)."""
        xs, ys, i, j = self._spine(left, 1), self._spine(right, 0), 0, 0
        while True:
            (x, dx), (y, dy) = xs[i], ys[j]
            found = self.pair.get((x, y))
            if found and found[0] < dx and found[0] <= dy:
                return found[0], x, y
            if dx == dy == INF:
                return None
            if dx <= dy:
                i += 1
            if dy <= dx:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        got = self._compatible.get(key)
        if got is None:
            if len(self._compatible) > 150_000:
                self._compatible.clear()
            got = self._compatible[key] = self._crossing(left, right) is None
        return got

    def whole(self, token: int) -> bool:
        """Whether encoding the token's own string gives the token."""
        if token not in self.split:
            return True
        a, b = self.split[token]
        return self.whole(a) and self.whole(b) and self._crossing(a, b) == (self.birth[token], a, b)

    def _lookahead(self) -> int:
        """Symbols to the right of a token that can matter to it.

        Let A(y, r) be that number for "does y, once formed, merge with its
        right neighbour before rank r".  A neighbour v with a merge (y, v) of
        rank q < r must form (F(v) symbols beyond its end may matter) and
        outlast its own right neighbour until q (A(v, q) symbols), hence
        A(y, r) = max over such v of |v| + max(A(v, q), F(v)), and
        F(v) = max(F(w), A(w, birth(v))) for the right half w of v.  One pass over the
        merges in rank order computes both, because every term has a lower rank.
        """
        ahead: dict[int, int] = {}
        formed: dict[int, int] = {}
        for (y, v), (_, made) in sorted(self.pair.items(), key=lambda x: x[1][0]):
            need = len(self.symbols.get(v, "x")) + max(ahead.get(v, 0), formed.get(v, 0))
            if made not in formed:
                formed[made] = max(formed.get(v, 0), ahead.get(v, 0))
            ahead[y] = max(ahead.get(y, 0), need)
        return max([1, *ahead.values(), *formed.values()])


class Transducer:
    """Deterministic transducer over symbols, compiled as it is used.

    A state is the set of places from which a token may still be running: for
    each, the symbols read since, the token that ended there, and how many
    tokens have been counted since.  A transition is annotated with the change
    of the token count and with the token that ends the encoding of what was read.
    States are numbered when first reached and shared by all words; beyond
    ``limit`` only the current one is kept."""

    def __init__(self, merges: Merges, limit: int = 100_000):
        self.merges, self.limit = merges, limit
        self._forget()

    def _forget(self):
        start = (("", -1, 0),)
        self.number, self.states, self.edges = {start: 0}, [start], {}

    def _name(self, state) -> int:
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
        return number

    def step(self, state: int, symbol: str) -> tuple[int, int, int]:
        """(next state, change of the token count, token ending here)."""
        edge = self.edges.get(state << 9 | ord(symbol))
        if edge is not None:
            return edge
        places = self.states[state]
        if len(self.states) > self.limit:
            self._forget()
            state = self._name(places)
        m, winner, alive = self.merges, None, []
        for read, last, since in places:
            grown = read + symbol
            token = m.token.get(grown)
            if winner is None and token is not None and (last < 0 or m.compatible(last, token)):
                winner = (token, 1 - since)
            grown = m.reach.get(grown)
            if grown is not None:
                alive.append((grown, last, since))
        token, change = winner
        edge = (self._name((*((r, t, s + change) for r, t, s in alive), ("", token, 0))), change, token)
        self.edges[state << 9 | ord(symbol)] = edge
        return edge

    def places(self, state: int):
        """The state itself, which outlives its number."""
        return self.states[state]

    def run(self, places, symbols: str):
        """(state reached from ``places``, sum of the annotations on the way)."""
        state, total = self._name(places), 0
        for symbol in symbols:
            state, change, _ = self.edges.get(state << 9 | ord(symbol)) or self.step(state, symbol)
            total += change
        return self.states[state], total

    def count(self, word: str) -> int:
        """Tokens of one word given as a symbol string: the sum of the
        annotations along its path."""
        state = total = 0
        for symbol in word:
            state, change, _ = self.edges.get(state << 9 | ord(symbol)) or self.step(state, symbol)
            total += change
        return total


class StreamEncoder:
    """Symbols in, tokens out as soon as no later symbol can change them.

    Tokens that end at least ``lookahead`` symbols before the last one read
    are final; the buffer never holds more than ``2 * (lookahead + longest)``
    symbols however long the word is."""

    def __init__(self, merges: Merges, limit: int = 100_000):
        self.merges, self.keep = merges, merges.lookahead
        self.room = 2 * (merges.lookahead + merges.longest)
        self.machine = Transducer(merges, limit)
        self.size = {i: len(s) for i, s in merges.symbols.items()}
        self._clear()

    def _clear(self):
        self.ends = [-1]  # token ending the encoding of each buffered prefix
        self.state = 0

    def push(self, symbol: str) -> list[int]:
        self.state, _, token = self.machine.step(self.state, symbol)
        self.ends.append(token)
        return self._emit() if len(self.ends) > self.room else []

    def _path(self) -> list[tuple[int, int]]:
        """(end, token) of the current encoding, in order."""
        out, at = [], len(self.ends) - 1
        while at > 0:
            token = self.ends[at]
            out.append((at, token))
            at -= self.size[token]
        return out[::-1]

    def _emit(self) -> list[int]:
        done = [x for x in self._path() if x[0] <= len(self.ends) - 1 - self.keep]
        if done:
            self.ends = self.ends[done[-1][0]:]
        return [token for _, token in done]

    def finish(self) -> list[int]:
        ends, size, at, out = self.ends, self.size, len(self.ends) - 1, []
        while at > 0:
            out.append(ends[at])
            at -= size[ends[at]]
        self._clear()
        return out[::-1]

    def word(self, symbols: str) -> list[int]:
        machine = self.machine
        if len(symbols) < self.room:  # fits the buffer: nothing to emit before the end
            state, ends = self.state, self.ends
            for symbol in symbols:
                state, _, token = machine.edges.get(state << 9 | ord(symbol)) or machine.step(state, symbol)
                ends.append(token)
            return self.finish()
        out: list[int] = []
        for symbol in symbols:
            out += self.push(symbol)
        return out + self.finish()


class StreamDecoder:
    """Tokens in, text out: each token's bytes run through a byte-to-text
    machine that keeps at most an unfinished character between tokens.
    ``between`` separates tokens (for files without a decoder)."""

    def __init__(self, spellings: dict[int, bytes], between: bytes = b""):
        self.spellings, self.between = spellings, between
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def push(self, token: int) -> str:
        data = self.spellings[token]
        if self.begun:
            data = self.between + data
        self.begun = True
        return self.machine.decode(data)

    def at_rest(self) -> bool:
        """True when no unfinished character is held."""
        return not self.machine.getstate()[0]

    def finish(self) -> str:
        self.begun = False
        return self.machine.decode(b"", True)


def word_symbols(text: bytes, suffix: bool) -> str:
    """Symbol string of one word's bytes."""
    s = text.decode("latin-1")
    return s[:-1] + chr(ord(s[-1]) + 256) if suffix and s else s
