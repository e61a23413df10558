"""Segment-tree BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sonomere.llm import byte_bpe
from sonomere.llm.pretokens import splitter
from tests.llm.conftest import ODD

PATH = vocabularies.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=vocabularies.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def merge():
    return byte_bpe.Merger(byte_bpe.read_ranks(PATH))


@given(text=st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(library, merge, text):
    split = splitter(vocabularies.PATTERN)
    ids = [x for piece in split(text) for x in merge(piece.encode())]
    assert ids == library.encode_ordinary(text)


def test_long_pieces(library, merge):
    rng = random.Random(4)
    for n in (50, 127, 128, 129, 3000):
        text = "".join(rng.choice("aabn") for _ in range(n))
        assert merge(text.encode()) == library.encode_ordinary(text)
    assert merge(b"a" * 20_000) == library.encode_ordinary("a" * 20_000)


@pytest.fixture(scope="module")
def side_by_side():
    return byte_bpe.SideBySide(byte_bpe.read_ranks(PATH))


def ids_of(packed):
    return [np.frombuffer(x, "<u4").tolist() for x in packed]


@given(st.lists(st.one_of(st.text(alphabet="aabnthere \n漢é", max_size=140), st.text(max_size=20)), max_size=30))
@settings(max_examples=150, deadline=None)
def test_side_by_side(side_by_side, merge, texts):
    """Rows of all sizes in one call; each as if merged alone."""
    pieces = [t.encode() for t in texts]
    assert ids_of(side_by_side(pieces)) == [merge(p) if p else [] for p in pieces]


def test_side_by_side_batches(side_by_side, merge, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BATCH_LEAVES", 64)
    rng = random.Random(6)
    pieces = ["".join(rng.choices("abn tion", k=rng.randrange(1, 150))).encode() for _ in range(300)]
    assert ids_of(side_by_side(pieces)) == [merge(p) for p in pieces]


def test_small_caches_change_nothing(library):
    encoder = byte_bpe.Encoder(PATH, vocabularies.PATTERN)
    encoder.ids = byte_bpe.TwoGenerations(encoder.ids.make, entries=5, longest=6)
    rng = random.Random(7)
    for _ in range(20):
        texts = [" ".join(rng.choices(["the", "nonsensical", "abc", "漢字", "x" * 300, "q1w2e3"], k=30)) for _ in range(4)]
        assert ids_of(encoder([*texts, None, ""])) == [*map(library.encode_ordinary, texts), [], []]


def test_documents(odd, none, library):
    found = byte_bpe.round_trip(odd, PATH, vocabularies.PATTERN).collect()
    wanted = []
    for i, text, *_ in ODD:
        ids = library.encode_ordinary(text or "")
        wanted.append((
            i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    assert byte_bpe.round_trip(none, PATH, vocabularies.PATTERN).count() == 0
    kept = byte_bpe.encode(odd, PATH, vocabularies.PATTERN, keep_text=True)
    assert kept.columns == ["doc_id", "text", "ids"]


def test_decode_is_an_operator_of_its_own(odd):
    encoded = byte_bpe.encode(odd, PATH, vocabularies.PATTERN, keep_text=True)
    for r in byte_bpe.decode(encoded, PATH).collect():
        assert bytes(r.decoded).decode() == (r.text or "")
