import random
import struct

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from catchlake.llm import byte_bpe, token_counts
from llm_helpers import sha

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.read_ranks(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def random_texts(n):
    rng = random.Random(5)
    signs = "abcdeé ñ\n\t!!|<>/=中文字🙂 ▁\u0301'stre09"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(n)] + [
        "".join(rng.choice("etaoins") for _ in range(rng.randint(1, 200))) for _ in range(n)]


def test_transducer_agrees_with_the_library_and_plain_merging(codec, library, odd_texts):
    for text in random_texts(1500) + [t or "" for t in odd_texts]:
        assert codec.encode(text) == library.encode_ordinary(text)
    for text in random_texts(40):
        data = text.encode()
        assert list(codec.transducer.feed(data)) == byte_bpe.merge_by_rank(data, codec.ranks) == codec.transducer.encode(data)


def test_few_states_and_short_looks_change_nothing(codec, library):
    small = byte_bpe.Transducer(codec.ranks, states=50, look=3)
    for text in random_texts(200):
        for piece in codec.find(text):
            assert list(small.feed(piece.encode())) == library.encode_ordinary(piece)
    assert len(small.states) <= 50


def test_tokens_come_while_a_long_piece_is_read(codec):
    read = 0

    def bytes_of():
        nonlocal read
        for b in b"the" * 5000:
            read += 1
            yield b

    next(codec.transducer.feed(bytes_of()))
    assert read < 300


def test_decoding_is_incremental(codec):
    text = "é🙂中a" * 50
    ids = codec.encode(text)
    assert "".join(codec.decode_stream([i] for i in ids)) == text
    machine = byte_bpe.Utf8Machine()
    assert [machine.feed(bytes((b,))) for b in "é🙂".encode()] == ["", "é", "", "", "", "🙂"]
    assert machine.feed(b"\xf0\x9f") == "" and machine.finish() == "\ufffd" and machine.begun == b""
    for data in (b"\xff\xfea\x80", b"a\xe4\xb8", b"\xc3(\xf5b"):
        assert machine.feed(data) + machine.finish() == data.decode("utf-8", "replace")


def test_encode_and_decode(docs_of, library, odd_texts):
    docs = docs_of(odd_texts)
    rows = {r["doc_id"]: r for r in byte_bpe.encode_and_decode(docs, RANKS, P.PATTERN, ids="ids").collect()}
    for i, text in enumerate(odd_texts):
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == (len(ids), sha(packed), sha((text or "").encode()))
        assert bytes(rows[i]["ids"]) == packed
    assert byte_bpe.encode_and_decode(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_token_counts(docs_of, odd_texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts + random_texts(800) + ["  a  b ", "▁▁x", "<0x0A>", " " * 90 + "x", "ab.cd,ef"]
    docs = docs_of(texts)
    rows = {r["doc_id"]: r for r in token_counts.token_counts(docs, MODEL, 4096).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        n = len(library.encode(text or ""))
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"], rows[i]["over_limit"]) == (len((text or "").encode()), n, n > 4096)
    assert token_counts.token_counts(docs.limit(0), MODEL, 4096).count() == 0


def test_marks_that_may_be_cut_before():
    assert token_counts.opening_marks({"a": 0, "▁a": 1, "ab": 2, ".": 3, ").": 4, "b'": 5}) == {"▁", "\n", ".", ")"}
