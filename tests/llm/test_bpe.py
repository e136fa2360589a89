import hashlib
import random
from array import array

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bazaar.llm.bpe_transducer import Decoder, Encoder, Transducer, Utf8Stream, encode_texts, merge_bytes
from bazaar.llm.common import table
from bazaar.llm.queries import RANKS, TOKENIZER, op7_bpe_transducer
from bazaar.llm.vocab import load_ranks
from tests.llm.util import clashing, frame, rows

ranks = load_ranks(RANKS)
reference = tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
encoder, decoder = Encoder(ranks, P.PATTERN), Decoder(ranks)
SF = "/root/testdata/sf0.001"


def ids(text):
    return list(array("I", encoder.encode(text)))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert ids(text) == reference.encode_ordinary(text)
    assert decoder.decode(encoder.encode(text)) == text


def test_joined_pieces_of_the_vocabulary():
    rnd = random.Random(5)
    tokens = [t.decode("utf-8", "ignore") for t in ranks]
    for _ in range(1500):
        text = "".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 12)))
        assert ids(text) == reference.encode_ordinary(text), text


@pytest.mark.parametrize("text", ["", " ", "a" * 50_000, " " * 3_000 + "x", "=" * 999, "é" * 4_000, "\n \n\t  x", "日本語" * 500])
def test_long_pieces(text):
    assert ids(text) == reference.encode_ordinary(text)


def test_few_states_give_the_same_result():
    run = Transducer(ranks, max_states=3)
    for piece in (b" unbelievable", b"tokenization" * 20, "naïveté".encode()):
        assert [run.bytes_of[t] for t in run.encode(piece)] == merge_bytes(piece, ranks)


def test_emission_is_bounded():
    run, longest = Transducer(ranks), max(map(len, ranks))
    run.encode(b"abc" * 2_000 + b"the" * 2_000)
    assert all(sum(len(run.bytes_of[t]) for t in unsure) <= longest for s in run.states for _, _, unsure in s)


def test_utf8_stream_in_any_cuts():
    data = "aé日😀ß".encode() * 3
    for step in range(1, 9):
        run = Utf8Stream()
        assert "".join([run.feed(data[i:i + step]) for i in range(0, len(data), step)] + [run.close()]) == data.decode()
    run = Utf8Stream()
    assert run.feed(b"a\xe6\x97") == "a" and run.close() == "�"


def test_tokenizer_file_has_the_same_ids():
    assert {t: i for t, i in load_ranks(TOKENIZER).items() if i != 50256} == ranks
    own = Tokenizer.from_file(TOKENIZER)
    for text in ("Hello, wörld!  \n x's", "a" * 100, "日本 語"):
        assert own.encode(text, add_special_tokens=False).ids == reference.encode_ordinary(text)


def test_frame_with_nulls_repeats_and_extra_columns(spark):
    docs = clashing(frame(spark, [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "x" * 2_000_000)], "doc_id long, text string"))
    got = rows(encode_texts(docs, RANKS, P.PATTERN, decode=True))
    want = [(i, array("I", reference.encode_ordinary(t or "")).tobytes(), t or "") for i, t in
            [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "x" * 2_000_000)]]
    assert sorted(((a, bytes(b), c) for a, b, c in got), key=repr) == sorted(want, key=repr)
    assert rows(encode_texts(docs.limit(0), RANKS, P.PATTERN)) == []


def test_query_on_all_documents(spark):
    got = {r[0]: tuple(r[1:]) for r in op7_bpe_transducer(spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        want = array("I", reference.encode_ordinary(r["text"]))
        assert got.pop(r["doc_id"]) == (len(want), hashlib.sha256(want.tobytes()).hexdigest(),
                                        hashlib.sha256(r["text"].encode()).hexdigest())
    assert not got
