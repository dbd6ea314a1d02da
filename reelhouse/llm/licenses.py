"""License scans by template mark-up matching.

A template is mandatory wording with optional and replaceable regions (see
``license_templates``).  It compiles to a token automaton: one state per place
in the wording, silent steps around optional regions, steps on any word for
replaceable ones.  All templates run as one automaton; sets of its states are
made into deterministic states as texts need them.  A text holds a license where the
automaton accepts: every mandatory word in place, nothing else between.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z.  Word hashes of
a whole batch show where an accepted passage could start (its first two
words); from there on the automaton reads the words' bytes, so a hash never
decides.  Phrases are found the same way: first two words by hash, then all by bytes.

Per label the leftmost, longest, non-overlapping passages count.  The score is the share
of a text's words inside phrases and accepted passages.

Scale: a narrow map, no shuffle; a passage ends within the longest template
(about 200 words), so a text costs time in proportion to its length.

Defined cases: null and empty texts have no words, empty label strings, null
first and last word and score 0; repeated rows are scanned each; null doc_ids
are kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelhouse.llm.common import CACHES, claim, columns, tuned
from reelhouse.llm.license_templates import PHRASES, TEMPLATES
from reelhouse.llm.words import ALNUM_WORDS, LOWER, buffers, split_words

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MARK = re.compile(r'<(/?)(optional|one)>|<any words="(\d+)-(\d+)"/>|(\|)')
ANY, MOST_SETS = -1, 20_000


def word_list(text: str) -> list[bytes]:
    return WORD.findall(text.encode().translate(LOWER.tobytes()))


class Automaton:
    """Templates compiled together: ``steps[state]`` is a list of (word id or
    ANY, next state), ``silent[state]`` the states reached without a word."""

    def __init__(self, templates):
        self.ids: dict[bytes, int] = {}
        self.steps, self.silent, self.ends = [], [], {}
        self.labels = [label for label, _ in templates]
        firsts = []
        for number, (_, text) in enumerate(templates):
            begin = self._state()
            self.ends[self._compile(text, begin)] = number
            firsts.append(begin)
        self.sets, self.moves, self.accepts = [], [], []
        self.first = frozenset(self._closed(firsts))
        self._forget()

    def _state(self) -> int:
        self.steps.append([])
        self.silent.append([])
        return len(self.steps) - 1

    def _words(self, text: str, at: int) -> int:
        for word in word_list(text):
            nxt = self._state()
            self.steps[at].append((self.ids.setdefault(word, len(self.ids) + 1), nxt))
            at = nxt
        return at

    def _compile(self, text: str, at: int) -> int:
        """State after ``text``, which is read from state ``at`` on."""
        open_, pos = [], 0
        for m in MARK.finditer(text):
            at, pos = self._words(text[pos:m.start()], at), m.end()
            if m[3]:
                least, most, close = int(m[3]), int(m[4]), self._state()
                for k in range(most + 1):
                    if k >= least:
                        self.silent[at].append(close)
                    if k < most:
                        nxt = self._state()
                        self.steps[at].append((ANY, nxt))
                        at = nxt
                at = close
            elif m[5]:
                begin, close, _ = open_[-1]
                self.silent[at].append(close)
                at = begin
            elif not m[1]:
                open_.append((at, self._state(), m[2]))
            else:
                begin, close, kind = open_.pop()
                if kind != m[2]:
                    raise ValueError(f"{kind} region closed by {m[2]}")
                self.silent[at].append(close)
                if kind == "optional":
                    self.silent[begin].append(close)
                at = close
        if open_:
            raise ValueError(f"{open_[-1][2]} region is not closed")
        return self._words(text[pos:], at)

    def _closed(self, states) -> set[int]:
        found, todo = set(states), list(states)
        while todo:
            for nxt in self.silent[todo.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return found

    def _forget(self):
        self.number: dict[frozenset, int] = {}
        self.sets, self.moves, self.accepts = [], [], []
        self._number(self.first)

    def _number(self, states: frozenset) -> int:
        if states not in self.number:
            self.number[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.accepts.append(sorted(self.ends[s] for s in states if s in self.ends))
        return self.number[states]

    def next(self, state: int, word: int) -> int:
        """Deterministic state after ``word`` (0: in no template); -1: none."""
        found = self.moves[state].get(word)
        if found is None:
            states = self._closed({nxt for s in self.sets[state] for w, nxt in self.steps[s] if w == word or w == ANY})
            found = self.moves[state][word] = self._number(frozenset(states)) if states else -1
        return found

    def openings(self) -> tuple[set[tuple[int, int]], set[int]]:
        """First two words of accepted passages; first words that any word,
        or nothing, may follow."""
        pairs, alone = set(), set()
        for s in self.first:
            for word, nxt in self.steps[s]:
                after = self._closed([nxt])
                seconds = {w for t in after for w, _ in self.steps[t]}
                if word == ANY:
                    raise ValueError("a template must begin with a given word")
                if ANY in seconds or after & self.ends.keys():
                    alone.add(word)
                pairs |= {(word, w) for w in seconds if w != ANY}
        return pairs, alone

    def ends_from(self, words) -> dict[int, int]:
        """Template -> words read at its last acceptance, for an iterable of words."""
        out, state = {}, 0
        for n, word in enumerate(words, 1):
            state = self.next(state, self.ids.get(word, 0))
            if state < 0:
                break
            for number in self.accepts[state]:
                out[number] = n
        if len(self.sets) > MOST_SETS:  # made again as needed
            self._forget()
        return out


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hash of each word, as in a batch."""
    data = b" ".join(words)
    return split_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ALNUM_WORDS, LOWER).hashes[0]


class Scanner:
    """Phrases and templates, with the hashes of their first words."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.automaton = Automaton(templates)
        self.phrases = [(word_list(phrase), label) for phrase, label in phrases]
        ids = dict(self.automaton.ids)
        for words, _ in self.phrases:
            for w in words:
                ids.setdefault(w, len(ids) + 1)
        hashes = _hashes(list(ids))
        order = np.argsort(hashes)
        self.hashes, self.id_of = hashes[order], np.array(list(ids.values()))[order]
        self.width = len(ids) + 2
        pairs, alone = self.automaton.openings()
        self.pairs = np.array(sorted(a * self.width + b for a, b in pairs), np.int64)
        self.alone = np.array(sorted(alone), np.int64)
        self.starts = [(ids[w[0]] * self.width + ids[w[1]]) if len(w) > 1 else -ids[w[0]] for w, _ in self.phrases]

    def places(self, hashes: np.ndarray):
        """Places where a passage could start, and (place, phrase) candidates."""
        if not len(hashes):
            return np.zeros(0, np.int64), []
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ids = np.where(self.hashes[at] == hashes, self.id_of[at], 0).astype(np.int64)
        two = ids * self.width + np.append(ids[1:], 0)
        opens = np.flatnonzero(np.isin(two, self.pairs) | np.isin(ids, self.alone))
        phrases = [(int(i), k) for k, s in enumerate(self.starts) for i in np.flatnonzero(two == s if s >= 0 else ids == -s)]
        return opens, phrases

    def read(self, words: list[bytes], opens, phrases):
        """(phrase places, label spans) of one text's words, by bytes."""
        base = [(i, k) for i, k in phrases if words[i:i + len(self.phrases[k][0])] == self.phrases[k][0]]
        spans, busy = [], {}
        for i in opens:
            for number, n in self.automaton.ends_from(words[j] for j in range(i, len(words))).items():
                label = self.automaton.labels[number]
                if busy.get(label, 0) <= i:
                    spans.append((i, i + n, label))
            for begin, end, label in spans:
                busy[label] = max(busy.get(label, 0), end)
        return base, spans

    def report(self, words: list[bytes], opens, phrases):
        """Columns after doc_id and n_words."""
        base, spans = self.read(words, opens, phrases)
        inside = np.zeros(len(words) + 1, np.int64)
        for begin, end in [(i, i + len(self.phrases[k][0])) for i, k in base] + [(b, e) for b, e, _ in spans]:
            inside[begin] += 1
            inside[end] -= 1
        named = {self.phrases[k][1] for _, k in base}
        at = [i for i, _ in base]
        share = float((np.cumsum(inside)[:-1] > 0).sum()) / len(words) if words else 0.0
        return (len(base), min(at, default=None), max(at, default=None), ",".join(sorted(named)),
                ",".join(sorted(named | {label for _, _, label in spans})), share)


_scanners: dict[str, Scanner] = CACHES.setdefault("licenses", {})


def license_labels(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per document row, see ``SCHEMA``."""
    tuned(docs.sparkSession)
    templates, phrases = list(templates), list(phrases)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def run(batches):
        claim("licenses")
        own = repr((templates, phrases))
        if own not in _scanners:
            _scanners.clear()
            _scanners[own] = Scanner(templates, phrases)
        scanner = _scanners[own]
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            data, offsets = buffers(text)
            words = split_words(data, offsets, ALNUM_WORDS, LOWER)
            opens, phrases_at = scanner.places(words.hashes[0])
            n = np.diff(words.first)
            rows = [(0, None, None, "", "", 0.0)] * len(n)
            # a candidate belongs to the text that holds its first word; one
            # that would run into the next text fails on the words
            text_of = np.searchsorted(words.first, np.array([*opens.tolist(), *(i for i, _ in phrases_at)], np.int64), "right") - 1
            found: dict[int, tuple[list, list]] = {}
            for i, t in zip(opens.tolist(), text_of.tolist()):
                found.setdefault(t, ([], []))[0].append(i - int(words.first[t]))
            for (i, k), t in zip(phrases_at, text_of[len(opens):].tolist()):
                found.setdefault(t, ([], []))[1].append((i - int(words.first[t]), k))
            for t, (starts, named) in found.items():
                raw = LOWER[data[offsets[t]:offsets[t + 1]]].tobytes()
                rows[t] = scanner.report(WORD.findall(raw), starts, sorted(named))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))],
                [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
