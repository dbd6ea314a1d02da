"""Token counts by finite-state transducers.

Two machines count without building tokens:

* A *cutting* transducer over character classes marks where the pre-tokenizer's
  pieces begin (a transition may mark its own character or the one before).
  The characters of a batch are dealt into chunks.  Each chunk is first run from
  all states at once: a chunk's effect is a map from state to state, an element of
  the machine's finite transition monoid, extended by one character through a
  table.  A parallel prefix scan composes the chunk maps, which gives every chunk
  its entry state, and a second run in lock step marks the beginnings.
* A *counting* transducer over bytes (:class:`reelhouse.llm.bpe.Transducer`),
  compiled from the merge list: its transitions carry the change of the token
  count.  A chunk's effect is a map from entry state to (exit state, count), composed
  by the same kind of scan.  Where a piece begins, the machine is in its start
  state whatever came before, so a piece's map is one pair, and the
  composition over the pieces of a text is a sum; equal pieces have equal maps and are run once.
  A piece of more than ``LONG`` symbols is dealt into chunks again: their maps are first
  evaluated at a likely entry state (the one reached from ``WARM`` symbols
  before), the scan composes them and asks a map for any other state it meets.

Counts per text are differences of a prefix sum over the pieces.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a special
token's string inside a text counts as one token, as in the library; repeated rows
are counted each; null doc_ids are kept; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelhouse.llm.bpe import Merges, Transducer, word_symbols
from reelhouse.llm.common import CACHES, claim, columns, tuned
from reelhouse.llm.pieces import (LETTER, NUMBER, OTHER, SPACE, WHITE, PieceTable, char_batches, vocabulary)

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
CHUNK = 64
#: Symbols of a piece from which it is counted in chunks of this size, and
#: symbols before a chunk that suggest its entry state.
LONG, WARM = 4096, 256

# States: at a border, in letters, numbers, others; in white space that ends in
# a space or in another white character; after a lone apostrophe, after an
# apostrophe and r or v, after an apostrophe and l, after a contraction.
EDGE, IN_L, IN_N, IN_O, IN_S, IN_W, QUOTE, QUOTE_RV, QUOTE_L, SHORT = range(10)
# Input classes: letters by their part in contractions, then the others.
ANY_L, STMD, RV, ELL, E_, NUM, OTH, APOS, SPC, WHT, GAP_ = range(11)
HERE, BEFORE = 1, 2


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks (HERE, BEFORE) by (state, class)."""
    to, mark = np.zeros((10, 11), np.uint8), np.zeros((10, 11), np.uint8)
    for state in range(10):
        joins = {IN_S: BEFORE, IN_W: HERE | BEFORE}.get(state)
        broken = BEFORE if state in (QUOTE_RV, QUOTE_L) else 0  # the letter after the apostrophe began a piece
        for c in range(11):
            if c <= E_:
                to[state, c], mark[state, c] = IN_L, HERE
                if state == IN_L:
                    mark[state, c] = 0
                elif joins:
                    mark[state, c] = joins
                elif state == QUOTE and c in (STMD, RV, ELL):
                    to[state, c], mark[state, c] = {STMD: SHORT, RV: QUOTE_RV, ELL: QUOTE_L}[c], 0
                elif state == QUOTE_RV and c == E_ or state == QUOTE_L and c == ELL:
                    to[state, c], mark[state, c] = SHORT, 0
                elif broken:
                    mark[state, c] = BEFORE
            elif c in (SPC, WHT):
                to[state, c] = IN_S if c == SPC else IN_W
                mark[state, c] = 0 if joins else HERE | broken
            elif c == GAP_:
                to[state, c], mark[state, c] = EDGE, HERE | broken
            else:
                own = {NUM: IN_N, OTH: IN_O, APOS: IN_O}[c]
                goes_on = state == own or c != NUM and state == QUOTE
                to[state, c] = own
                mark[state, c] = 0 if goes_on else joins or HERE | broken
                if c == APOS and not goes_on and state != IN_S:
                    to[state, c] = QUOTE
    return to, mark


def _monoid(to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All maps that words of classes make of the states, and the table that
    extends a map by one class.  Element 0 is the identity."""
    maps = [tuple(range(len(to)))]
    number, table, at = {maps[0]: 0}, [], 0
    while at < len(maps):
        row = []
        for c in range(to.shape[1]):
            image = tuple(int(to[s, c]) for s in maps[at])
            if image not in number:
                number[image] = len(maps)
                maps.append(image)
            row.append(number[image])
        table.append(row)
        at += 1
    return np.array(maps, np.uint8), np.array(table, np.uint16).ravel()


TO, MARK = _machine()
MAPS, EXTEND = _monoid(TO)
_LETTERS = np.full(128, ANY_L, np.uint8)
for _chars, _class in (("stmd", STMD), ("rv", RV), ("l", ELL), ("e", E_)):
    _LETTERS[[ord(x) for x in _chars]] = _class
_COARSE = np.full(8, GAP_, np.uint8)
_COARSE[[LETTER, NUMBER, OTHER, SPACE, WHITE]] = [ANY_L, NUM, OTH, SPC, WHT]


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), by doubling."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], 1)
        step *= 2
    return out


def cut_by_machine(points: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Flags of the characters that begin a piece."""
    n = len(points)
    fine = _COARSE[cls]
    low = np.flatnonzero((fine == ANY_L) & (points < 128))
    fine[low] = _LETTERS[points[low]]
    fine[points == 0x27] = APOS
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, GAP_, np.uint8)
    grid[:n] = fine
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    element = np.zeros(rows, np.uint16)
    for c in grid:
        element = EXTEND[element.astype(np.intp) * 11 + c]
    entry = np.zeros(rows, np.uint8)
    entry[1:] = scan(MAPS[element])[:-1, EDGE]
    state, to, mark = entry, TO.ravel(), MARK.ravel()
    marks = np.empty_like(grid)
    for k, c in enumerate(grid):
        at = state.astype(np.intp) * 11 + c
        marks[k] = mark[at]
        state = to[at]
    marks = marks.T.reshape(-1)[:n]
    start = (marks & HERE) > 0
    start[:-1] |= (marks[1:] & BEFORE) > 0
    return start


class CountMap:
    """Effect of a stretch of symbols: entry state -> (exit state, token
    count), evaluated where it is asked for."""

    def __init__(self, run):
        self.run, self.known = run, {}

    def __call__(self, entry):
        got = self.known.get(entry)
        if got is None:
            got = self.known[entry] = self.run(entry)
        return got

    def then(self, after: "CountMap") -> "CountMap":
        def run(entry):
            middle, first = self(entry)
            last, second = after(middle)
            return last, first + second
        return CountMap(run)


def scan_maps(maps: list[CountMap]) -> list[CountMap]:
    """Inclusive prefix composition, by doubling."""
    out, step = list(maps), 1
    while step < len(out):
        out[step:] = [before.then(own) for before, own in zip(out[:-step], out[step:])]
        step *= 2
    return out


def count_in_chunks(machine: Transducer, symbols: str, chunk: int = LONG, warm: int = WARM) -> int:
    """Token count of one word from the composed maps of its chunks."""
    start, made = machine.places(0), {}

    def part(at):
        own = symbols[at:at + chunk]
        if own not in made:  # equal chunks have one map
            made[own] = CountMap(lambda entry: machine.run(entry, own))
        return made[own]

    maps = []
    for at in range(0, len(symbols), chunk):
        maps.append(part(at))
        maps[-1](machine.run(start, symbols[max(0, at - warm):at])[0] if at else start)
    return scan_maps(maps)[-1](start)[1]


class TokenCounter:
    """Counts of whole texts for one byte-level vocabulary file."""

    def __init__(self, path: str):
        pre, specials = vocabulary(path)[1:]
        machine = Transducer(Merges(path))

        def counts(new):
            words = [word_symbols(s.encode(), False) for s in new]
            return [machine.count(w) if len(w) <= LONG else count_in_chunks(machine, w) for w in words]

        self.pieces = PieceTable(pre, specials, counts, lambda _: 1, spaced=True, cut=cut_by_machine, limit=600_000)

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for a, b in char_batches(texts):
            found = self.pieces.look_up([self.pieces.specials.hide(t) for t in texts[a:b]])
            sums = np.concatenate([[0], np.cumsum(np.array(found.values, np.int64)[found.code])])
            out[a:b] = np.diff(sums[found.first])
        return out


_counters: dict[str, TokenCounter] = CACHES.setdefault("tokencount", {})


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_tokens, over_limit.

    ``path``: vocabulary file on the executors, by default the public byte-level file."""
    tuned(docs.sparkSession)

    def run(batches):
        from reelhouse.llm.pieces import vocabulary_path
        claim("tokencount")
        file = vocabulary_path(path or VOCABULARY)
        if file not in _counters:
            _counters[file] = TokenCounter(file)
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            texts = text.fill_null("").to_pylist()
            n = _counters[file].count(texts)
            size = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(size), pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
