"""Secret scans with multipart credential linking.

Base spans are strong on their own: assignments, access identifiers and long hex
runs (patterns below; matches that are too short are dropped after matching, so what they
consumed stays consumed).  Weak parts say little alone: short assigned
values, account identifiers, bare 40-character values, endpoints.  They are
reported only when complementary parts co-occur in one scope:

    weak secret        an identifier or an endpoint in scope
    weak identifier    a secret (strong or weak) in scope
    endpoint           an identifier and a secret in scope

The scope of a part is the part widened by ``reach`` code points to both
sides.  Linking is an interval join of parts and scopes on sorted positions.
Scopes never cross documents, so the join runs inside the scan of a document:
no shuffle, and no group larger than one document's parts.

Offsets are code points, end exclusive.  Digests list ``kind:start:end``, by
start, then kind in the order of ``KINDS``, comma-joined.

Defined cases: a null or empty text has no spans (empty digest string, digest of the empty
string); repeated rows are scanned each; null doc_ids are kept; other columns are ignored (and
unchanged by :func:`redact`).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelhouse.llm.common import claim, columns, sha, tuned
from reelhouse.llm.words import buffers

REACH = 300
KINDS = ("assign", "access", "hex", "identifier", "weak", "endpoint")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
IDENTIFIER = re.compile(
    r"""(?:user_?name|user_?id|login|account_?(?:id|name)|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.A | re.I)
BARE = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
#: What follows an endpoint's ``://``.
REST = re.compile(r"""[^\s"'<>]*""", re.A)
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_SCHEME = _LETTERS | frozenset("0123456789+.-")

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*range(48, 58), *range(97, 103)]] = True


def long_hex(data: np.ndarray, offsets: np.ndarray, least: int = 16) -> np.ndarray:
    """Which texts hold a run of at least ``least`` hex characters."""
    out = np.zeros(len(offsets) - 1, bool)
    if len(data) < least:
        return out
    on = np.zeros(len(data) + 2, np.int8)
    on[1:-1] = _HEX_BYTE[data]
    step = np.diff(on)
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = end - begin >= least
    # a run may span texts; look at every text it touches
    lo = np.searchsorted(offsets, begin[long], "right") - 1
    hi = np.searchsorted(offsets, end[long] - 1, "right") - 1
    for a, b in zip(lo.tolist(), hi.tolist()):
        out[a:b + 1] = True
    return out


def _near(part: tuple[int, int], starts: np.ndarray, reach_ends: np.ndarray, reach: int) -> bool:
    """Whether an interval of a sorted list touches the part's scope; the
    list's running maximum of ends makes it one binary search."""
    k = int(np.searchsorted(starts, part[1] + reach, "left"))
    return k > 0 and bool(reach_ends[k - 1] > part[0] - reach)


class _Side:
    """Sorted intervals that parts are joined against."""

    def __init__(self, spans):
        spans = sorted(spans)
        self.starts = np.array([s for s, _ in spans], np.int64)
        self.ends = np.maximum.accumulate(np.array([e for _, e in spans], np.int64)) if spans else self.starts

    def near(self, part, reach):
        return _near(part, self.starts, self.ends, reach)


def base_spans(text: str, maybe_hex: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong spans."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if maybe_hex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(out)


def endpoints(text: str) -> list[tuple[int, int]]:
    """Spans of ``scheme://...``, a scheme being a letter and letters, digits,
    ``+``, ``.`` or ``-``.  The scheme is read backwards from ``://``, over characters
    that no other scheme has, so a text is read once whatever stands in it."""
    out, last, mark = [], 0, text.find("://")
    while mark >= 0:
        at, start, end = mark, -1, 0
        while at > last and text[at - 1] in _SCHEME:
            at -= 1
            if text[at] in _LETTERS:
                start = at
        if start >= 0:
            end = REST.match(text, mark + 3).end()
            if end > mark + 3:
                out.append((start, end))
                last = end
        mark = text.find("://", max(end, mark + 3))
    return out


def linked_spans(text: str, base: list[tuple[int, int, int]], reach: int = REACH) -> list[tuple[int, int, int]]:
    """(start, kind, end) of weak parts with complementary parts in scope."""
    assigned = ":" in text or "=" in text
    ids = [m.span() for m in IDENTIFIER.finditer(text)] if assigned else []
    ends = endpoints(text) if "://" in text else []
    strong_ids = [(s, e) for s, k, e in base if k == 1]
    # a plain number is not a secret: long hex must be of key length and mixed
    strong = [(s, e) for s, k, e in base if k == 0 or k == 2 and e - s >= 32 and not text[s:e].isdigit()]
    weak = []
    if ids or ends or strong_ids:
        taken = {s for s, _ in strong}
        weak = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) < 12] if assigned else []
        weak += [m.span() for m in BARE.finditer(text) if m.start() not in taken]
    who, what, where = _Side(ids + strong_ids), _Side(strong + weak), _Side(ends)
    out = [(s, 4, e) for s, e in weak if who.near((s, e), reach) or where.near((s, e), reach)]
    out += [(s, 3, e) for s, e in ids if what.near((s, e), reach)]
    out += [(s, 5, e) for s, e in ends if who.near((s, e), reach) and what.near((s, e), reach)]
    return out


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scanned(texts: list[str], data, offsets, reach: int):
    """(base, all spans) of each text."""
    for text, hexed in zip(texts, long_hex(data, offsets).tolist()):
        base = base_spans(text, hexed)
        yield base, sorted(base + linked_spans(text, base, reach))


def secret_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document row: doc_id, counts, base_sha256, spans."""
    tuned(docs.sparkSession)

    def run(batches):
        claim("secretscan")
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            rows = [(*(sum(k == j for _, k, _ in base) for j in range(3)), sha(written(base).encode()), written(spans))
                    for base, spans in scanned(text.fill_null("").to_pylist(), *buffers(text), reach)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def masked(text: str, spans) -> str:
    """``text`` with every span (overlaps merged) replaced by its first kind."""
    out, at, merged = [], 0, []
    for s, k, e in spans:
        if merged and s < merged[-1][2]:
            merged[-1] = (merged[-1][0], merged[-1][1], max(e, merged[-1][2]))
        else:
            merged.append((s, k, e))
    for s, k, e in merged:
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """All rows and columns of ``docs`` with the spans in ``text`` masked;
    ``n_chars``, where present, follows the new text."""
    tuned(docs.sparkSession)

    def run(batches):
        claim("secretscan")
        for batch in batches:
            at = batch.schema.get_field_index("text")
            text = batch.column(at)
            new = [None if t is None else masked(t, spans)
                   for t, (_, spans) in zip(text.to_pylist(), scanned(text.fill_null("").to_pylist(), *buffers(text), reach))]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, text.type))
            size = batch.schema.get_field_index("n_chars")
            if size >= 0:
                old = batch.column(size).to_pylist()
                changed = [o if a == b else len(b) for o, a, b in zip(old, text.to_pylist(), new)]
                batch = batch.set_column(size, batch.schema.field(size), pa.array(changed, batch.column(size).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
