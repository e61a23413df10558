"""Compressed token files: exact round trips, random access, the library's ids."""

import zlib

import numpy as np
import public_tokenizers as vocabularies
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sonomere.llm import token_files, token_runs
from sonomere.storage import new_path
from tests.llm.conftest import ODD, prose, table

IDS = st.lists(st.integers(0, 6), max_size=300).map(lambda x: x * 3)


@given(IDS)
@settings(max_examples=100, deadline=None)
def test_grammar_round_trip(ids):
    ids = np.array(ids, "<u4")
    body, rules, lengths = token_files.compress(ids, 100)
    assert (token_files.expand(body, rules, 100) == ids).all()
    block = token_files.Block(
        100, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), 4,
        body.astype("<u4").tobytes(),
    )
    assert (block.ids() == ids).all()
    for start in range(0, len(ids), 17):
        assert (block.ids(start, start + 23) == ids[start : start + 23]).all()


def test_grammar_shortens():
    ids = np.tile(np.arange(50, dtype="<u4"), 2000)
    body, rules, lengths = token_files.compress(ids, 100)
    assert len(body) < len(ids) / 50 and lengths.max() > 50


def check(spark, rows, **more):
    path = new_path(spark, "files")
    vocabulary = vocabularies.path("byte_bpe_50k.json")
    token_files.write_token_files(table(spark, rows), path, vocabulary, 2, **more)
    found = token_files.read_token_files(spark.read.parquet(path), token_files.crc32, "crc", "bigint")
    tokenizer, start, wanted = Tokenizer.from_file(vocabulary), 0, []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == wanted
    return spark.read.parquet(path)


def test_files_hold_the_library_ids(spark):
    files = check(spark, ODD, block_ids=500)
    assert files.count() >= 4
    rows = [(i, prose(i, 30 * i), "en") for i in range(60)]
    check(spark, rows, block_ids=1000)


def test_empty_table(spark, none):
    check(spark, [])


VOCABULARY = vocabularies.path("byte_bpe_50k.json")
ENCODER = token_files.Encoder(VOCABULARY)
LIBRARY = Tokenizer.from_file(VOCABULARY)


@given(st.lists(st.one_of(
    st.none(), st.text(max_size=40),
    st.text(alphabet="'strevmld SL1²½ⅷ\n\t\r\x85\x1f\u3000_!é漢😀", max_size=40),
), max_size=5))
@settings(max_examples=300, deadline=None)
def test_encoder_gives_the_library_ids(texts):
    wanted = [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in ENCODER(texts)] == wanted


@given(st.text(alphabet="'strevmld S1²\n\t\u3000_!é", max_size=40))
@settings(max_examples=200, deadline=None)
def test_runs_follow_the_pattern(text):
    assert token_runs.PATTERN == vocabularies.PATTERN
    point = np.frombuffer(text.encode("utf-32-le"), "<u4")
    start, _ = token_runs.runs(point, np.array([0, len(point)]))
    found = [text[a:b] for a, b in zip(start, [*start[1:], len(text)])]
    assert found == regex.findall(vocabularies.PATTERN, text)


def test_a_full_table_starts_anew():
    encoder = token_files.Encoder(VOCABULARY)
    encoder.table.entries = 50
    texts = [prose(i, 40) for i in range(30)] + ["x" * 5000, "<|endoftext|> special"]
    for at in range(0, len(texts), 2):
        wanted = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts[at : at + 2]]
        assert [x.tolist() for x in encoder(texts[at : at + 2])] == wanted


def test_grammar_to_the_end():
    """No pair is left that could be used often enough."""
    rng = np.random.default_rng(3)
    block = np.tile(rng.integers(0, 5000, 4096), 128)
    few = rng.integers(0, 3, 20_000)
    odd = [rng.integers(0, k, n) for k in (1, 2, 4, 9) for n in (7, 8, 50, 600)]
    for ids in (block, few, np.zeros(5000, np.int64), np.arange(100), *odd):
        body, rules, lengths = token_files.compress(ids, 6000)
        assert np.array_equal(token_files.expand(body, rules, 6000), ids)
        pair = body[:-1] << 32 | body[1:]
        for key, uses in zip(*np.unique(pair, return_counts=True)):
            at = np.flatnonzero(pair == key)
            apart = int(token_files._every_other(at).sum())
            assert uses < token_files.LEAST_USES or apart < token_files.LEAST_USES


def test_id_table():
    rng = np.random.default_rng(5)
    table = token_runs.IdTable(entries=600)
    # Many keys share their upper bits, so they share slots.
    key = np.unique(rng.integers(0, 40, 500).astype(np.uint64) << np.uint64(58) | rng.integers(0, 1 << 20, 500).astype(np.uint64))
    count = rng.integers(0, 5, len(key))
    ids = np.arange(count.sum(), dtype=np.uint32)
    assert (table.find(key) == -1).all()
    half = len(key) // 2
    table.add(key[:half], ids[: count[:half].sum()], count[:half])
    assert (table.find(key[half:]) == -1).all()
    table.add(key[half:], ids[count[:half].sum() :], count[half:])
    found, n = table.gather(table.find(key))
    assert np.array_equal(found, ids) and np.array_equal(n, count)
    more = np.arange(2000, dtype=np.uint64)  # more than it holds: it starts anew, with these alone
    table.add(more, np.arange(2000, dtype=np.uint32), np.ones(2000, np.int64))
    assert np.array_equal(table.gather(table.find(more))[0], np.arange(2000))
    assert (table.find(key[key >= 2000]) == -1).all()


def test_library_is_asked_once_per_pre_token():
    asked = []
    table = token_runs.IdTable()

    def library(pieces, white):
        asked.extend(pieces)
        return np.array([len(p) for p in pieces], np.uint32), np.ones(len(pieces), np.int64)

    texts = ["one two two", "", "two  one\n", "one three"]
    for _ in range(2):
        found = token_runs.encode(texts, table, library)
        assert [x.tolist() for x in found] == [[3, 4, 4], [], [3, 1, 4, 1], [3, 6]]
    assert len(asked) == len(set(asked))
    # A table that holds less than one slice needs gives the same.
    assert [x.tolist() for x in token_runs.encode(texts, token_runs.IdTable(2), library)] == [x.tolist() for x in found]


def test_expand_with_and_without_lengths():
    ids = np.tile(np.arange(40, dtype=np.uint32), 300)
    body, rules, lengths = token_files.compress(ids, 100)
    assert np.array_equal(token_files.expand(body, rules, 100, lengths), ids)
    assert np.array_equal(token_files.expand(body, rules, 100), ids)
    assert np.array_equal(token_files._rule_lengths(rules, 100), lengths)
