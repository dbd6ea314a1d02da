"""BPE encoding and decoding as bounded-lookahead streaming transducers.

Encoding: normalised text is cut into words, the words' bytes are read one by
one, and a token is emitted once it lies further back than the merge list's
sufficient lookahead (computed from the list, :meth:`Merges._lookahead`), so
memory stays constant however long a word is.  Distinct words of a worker are
encoded once and then known by key; the table of known words is bounded.

Decoding: an incremental byte-to-text machine takes token ids one by one and
keeps no more than an unfinished character.

Normalisation is the tokenizer file's own.  Below U+0300 every character is
normalised by itself, so a table read from the library serves; a text with any
later character (or one whose normal form is several characters) is given to the
library's normaliser whole.

Defined cases: a null or empty text has no tokens and decodes to the empty text; special token
strings inside texts become their ids; repeated rows are encoded each; null
doc_ids are kept; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelhouse.llm.bpe import Merges, StreamDecoder, StreamEncoder, byte_letters, word_symbols
from reelhouse.llm.common import CACHES, claim, columns, sha, tuned
from reelhouse.llm.pieces import PieceTable, char_batches, vocabulary, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
PLAIN_BELOW = 0x300


class Codec:
    """Encoder and decoder of one word-BPE vocabulary file."""

    def __init__(self, path: str, limit: int = 300_000):
        tokenizer, pre, specials = vocabulary(path)
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else None
        del tokenizer  # its model is not needed
        merges = Merges(path)
        self.encoder = StreamEncoder(merges)
        spec = json.load(open(path, encoding="utf-8"))
        names = {**merges.names, **{i: s for s, i in specials.items()}}
        if spec.get("decoder") is None:  # the library joins the written tokens by spaces
            self.between, self.spellings = b" ", {i: s.encode() for i, s in names.items()}
        else:
            letters = byte_letters()
            self.between = b""
            self.spellings = {i: s.encode() if s in specials else bytes(letters[ch] for ch in s) for i, s in names.items()}
        self.decoder = StreamDecoder(self.spellings, self.between)
        self.table = PieceTable(pre, specials, lambda new: [self._known(self.encoder.word(word_symbols(w.encode(), True)))
                                                            for w in new], lambda i: self._known([i]), spaced=False, limit=limit)
        self.fold, odd = np.arange(PLAIN_BELOW, dtype=np.uint32), []
        for p in range(PLAIN_BELOW) if self.normalize else ():
            one = self.normalize(chr(p))
            if len(one) == 1:
                self.fold[p] = ord(one)
            else:
                odd.append(chr(p))
        self.odd = re.compile("[" + re.escape("".join(odd)) + "̀-\U0010ffff]")

    def _known(self, ids: list[int]):
        """What is kept of a word: token count, ids written in decimal, its
        decoded text when the byte-to-text machine is at rest after it, and ids
        as bytes."""
        text = "".join(map(self.decoder.push, ids))
        rests = self.decoder.at_rest()
        self.decoder.finish()
        return len(ids), " ".join(map(str, ids)).encode(), text.encode() if rests else None, struct.pack(f"<{len(ids)}i", *ids)

    def prepare(self, text: str) -> str:
        """Specials hidden, normalised unless the table will do it."""
        if self.normalize and not text.isascii() and self.odd.search(text):
            return self.table.specials.hide(text, self.normalize)
        return self.table.specials.hide(text)

    def encode(self, text: str) -> list[int]:
        found = self.table.look_up([self.prepare(text)], self.fold)
        return np.frombuffer(b"".join(found.values[k][3] for k in found.code), "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        decoder = StreamDecoder(self.spellings, self.between)
        return "".join(map(decoder.push, ids)) + decoder.finish()

    def digests(self, texts: list[str]):
        """(n_tokens, ids digest, decoded digest, ids as bytes) of each text."""
        for a, b in char_batches(texts):
            found = self.table.look_up([self.prepare(t) for t in texts[a:b]], self.fold)
            n, ids, text, raw = (list(x) for x in zip(*found.values)) if found.values else ([], [], [], [])
            sums = np.concatenate([[0], np.cumsum(np.array(n, np.int64)[found.code])]) if n else np.zeros(1, np.int64)
            code, rests = found.code.tolist(), None not in text
            for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                own = code[lo:hi]
                written = b" ".join(map(ids.__getitem__, own))
                if rests:
                    decoded = self.between.join(map(text.__getitem__, own))
                else:
                    decoded = self.decode([int(i) for i in written.split()]).encode()
                yield int(sums[hi] - sums[lo]) if hi > lo else 0, sha(written), sha(decoded), b"".join(map(raw.__getitem__, own))


_codecs: dict[str, Codec] = CACHES.setdefault("wordbpe", {})


def codec(path: str) -> Codec:
    """One codec per worker and file."""
    claim("wordbpe")
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encode(docs: DataFrame, path: str | None, make, schema: str) -> DataFrame:
    """``make(doc ids, rows of Codec.digests)`` gives the arrays of a batch."""
    tuned(docs.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        own = codec(vocabulary_path(path or VOCABULARY))
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            rows = list(own.digests(text.fill_null("").to_pylist()))
            yield pa.RecordBatch.from_arrays(make(ids.cast(pa.int64()), rows), names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _digest_arrays(ids, rows):
    return [ids, *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string())))]


def _id_lists(rows):
    ends = np.cumsum([0, *(r[0] for r in rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(r[3] for r in rows), "<i4"), pa.int32()))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _encode(docs, path, _digest_arrays, SCHEMA)


def token_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of :func:`encoded` and ids array<int>."""
    return _encode(docs, path, lambda ids, rows: [*_digest_arrays(ids, rows), _id_lists(rows)], SCHEMA + ", ids array<int>")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of (doc_id, ids): doc_id, text."""
    tuned(ids.sparkSession)

    def run(batches):
        own = codec(vocabulary_path(path or VOCABULARY))
        for batch in batches:
            doc, tokens = columns(batch, "doc_id", "ids")
            yield pa.RecordBatch.from_arrays([doc, pa.array([own.decode(t or []) for t in tokens.to_pylist()], pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
