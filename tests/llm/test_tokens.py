"""Token counts, codec and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelhouse.llm import bpe, pieces, tokencount, tokenfiles, wordbpe
from reelhouse.session import scratch_path
from tests.llm.conftest import by_id

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def counter():
    return tokencount.TokenCounter(BYTE)


@pytest.fixture(scope="module")
def codec():
    return wordbpe.Codec(WORD)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


TEXT = st.lists(st.sampled_from([*"abserltvdm'1!é東 \n\t", "  ", "'s", "'re", "the", "tion", "<|endoftext|>", "É", "́", "İ", " "]), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_counts_and_codec_equal_the_library(library, counter, codec, text):
    byte, word = library
    assert counter.count([text, text + text])[0] == len(ids(byte, text))
    got = codec.encode(text)
    assert got == ids(word, text)
    assert codec.decode(got) == word.decode(got, skip_special_tokens=False)


@pytest.mark.parametrize("chunk,warm", [(1, 0), (3, 2), (16, 40), (64, 8), (5000, 256)])
def test_chunk_size_does_not_matter(library, chunk, warm):
    machine, rng = bpe.Transducer(bpe.Merges(BYTE), limit=500), random.Random(chunk)
    for n in (0, 1, 2, 70, 700):
        word = "".join(rng.choice(["a", "b", "the", "ing", "é", "tion", "xx"]) for _ in range(n))
        symbols = bpe.word_symbols(word.encode(), False)
        assert tokencount.count_in_chunks(machine, symbols, chunk, warm) == len(library[0].encode(word, add_special_tokens=False).ids) \
            == machine.count(symbols) if word else True


def test_scan_of_maps_is_their_composition():
    rng = random.Random(1)
    tables = [{s: (rng.randrange(4), rng.randrange(9)) for s in range(4)} for _ in range(23)]
    done = tokencount.scan_maps([tokencount.CountMap(t.__getitem__) for t in tables])
    for start in range(4):
        state, total = start, 0
        for k, t in enumerate(tables):
            state, n = t[state]
            total += n
            assert done[k](start) == (state, total)


def test_a_word_of_megabytes(library, counter):
    rng = random.Random(6)
    word = "".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "étude", "strengths", "q"]) for _ in range(1_100_000))
    assert len(word) > 4_500_000
    for text in (word, "z" * 5_000_000):
        assert counter.count([text])[0] == len(library[0].encode(text, add_special_tokens=False).ids)


def test_edge_documents(spark, edge_docs, no_docs, edge_rows, library):
    byte, word = library
    want = [(i, len((t or "").encode()), len(ids(byte, t)), len(ids(byte, t)) > 1024) for i, t in edge_rows]
    assert by_id(tokencount.token_counts(edge_docs)) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    want = []
    for i, t in edge_rows:
        own = ids(word, t)
        want.append((i, len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest(),
                     hashlib.sha256(word.decode(own, skip_special_tokens=False).encode()).hexdigest()))
    assert by_id(wordbpe.encoded(edge_docs)) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    back = {r.doc_id: r.text for r in wordbpe.decoded(wordbpe.token_ids(edge_docs)).collect()}
    assert back[22] == word.decode(ids(word, dict(edge_rows)[22]), skip_special_tokens=False)
    for empty in (tokencount.token_counts(no_docs), wordbpe.encoded(no_docs), tokenfiles.written_and_read(no_docs)):
        assert empty.count() == 0


def test_token_files_round_trip(spark, edge_docs, edge_rows, library):
    folder = scratch_path(spark, "token-test")
    tokenfiles.write_tokens(edge_docs, folder, block_ids=500)
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t in order:
        own = [*ids(library[0], t), 2]
        want.append((i, start, own))
        start += len(own)
    got = sorted(((r.doc_id, r.start, r.ids) for r in tokenfiles.read_tokens(spark, folder).collect()), key=lambda r: r[1])
    assert [(i, s, list(x)) for i, s, x in got] == want
    digests = sorted((tuple(r) for r in tokenfiles.token_digests(spark, folder).collect()), key=lambda r: r[1])
    assert digests == [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, s, x in want]
    assert spark.read.parquet(f"{folder}/blocks").count() > 3
    ranks = [r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    count = np.bincount(np.concatenate([x for _, _, x in want]))
    assert ranks == [int(i) for i in np.lexsort((np.arange(len(count)), -count))[:len(ranks)]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=50))
def test_pack_unpack(values):
    assert tokenfiles.unpack(*tokenfiles.pack(np.array(values, np.uint32)), len(values)).tolist() == values


def test_chunk_maps_equal_direct_cutting(counter):
    rng = random.Random(5)
    text = "".join(rng.choice("aserltv'1! \n\t") for _ in range(5000))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    cls = counter.pieces.classes.of(points)
    direct = pieces.cut_spaced(points, cls)
    assert (tokencount.cut_by_machine(points, cls)[1:] == direct[1:]).all()
    maps = tokencount.MAPS[[3, 0, 7 % len(tokencount.MAPS), 2, 5]]
    scanned = tokencount.scan(maps)
    own = np.arange(10)
    for k, m in enumerate(maps):
        own = m[own]
        assert (scanned[k] == own).all()


def test_streaming_keeps_a_bounded_buffer_and_is_stable(library):
    merges = bpe.Merges(WORD)
    stream = bpe.StreamEncoder(merges, limit=500)
    text = "".join(random.Random(7).choice("aeiourstlnh") for _ in range(4000))
    out, most = [], 0
    for symbol in bpe.word_symbols(text.encode(), True):
        out += stream.push(symbol)
        most = max(most, len(stream.ends))
    early = len(out)
    out += stream.finish()
    assert out == ids(library[1], text) and early > 0
    assert most <= 2 * (merges.lookahead + merges.longest) + 1
    assert len(stream.machine.states) <= 502


def test_stream_decoder_holds_only_an_unfinished_character():
    decoder = bpe.StreamDecoder({0: b"\xc3", 1: b"\xa9", 2: b"a"})
    assert decoder.push(0) == "" and not decoder.at_rest()
    assert decoder.push(1) == "é" and decoder.at_rest()
    assert decoder.push(0) + decoder.push(2) == "�a" and decoder.finish() == ""


def test_full_tables_of_pieces_start_over(library):
    table = pieces.PieceTable(library[0].pre_tokenizer, {}, lambda new: [len(w) for w in new], lambda i: 1, True, limit=3)
    for text in ("a b c d e", "f g", "a b c d e"):
        found = table.look_up([text])
        assert [found.values[k] for k in found.code] == [len(w) for w in ("x" * 1, *["xx"] * (len(text.split()) - 1))]
