"""Token counts against the sentencepiece library."""

import public_tokenizers as vocabularies
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sonomere.llm import token_counts
from sonomere.llm.caches import TwoGenerations
from tests.llm.conftest import ODD, prose, table

MODEL = vocabularies.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNT = token_counts.PieceCounter(MODEL)


@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab ▁\n\t<s>0é漢", max_size=60)))
@settings(max_examples=400, deadline=None)
def test_pretokens_add_up(text):
    assert sum(map(COUNT, token_counts.segments(text))) == len(LIBRARY.encode(text))


def test_documents(odd, none, spark):
    rows = [*ODD, *((100 + i, prose(i, 50), "en") for i in range(30))]
    for docs, k in ((table(spark, rows).repartition(3), 4096), (table(spark, rows), 2)):
        found = token_counts.count_tokens(docs, MODEL, k=k).collect()
        key = lambda r: (r[0] is not None, r)
        wanted = [(i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t, *_ in rows]
        assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    assert token_counts.count_tokens(none, MODEL).count() == 0


def test_frequent_pretokens_are_found(spark):
    rows = [(i, f"often rare{i} also " * 3 + prose(i, 10), "en") for i in range(200)]
    found = token_counts.frequent_pretokens(table(spark, rows).repartition(9), k=20)
    assert {" often", " also"} <= set(found) and len(found) <= 20


def test_cache_is_bounded():
    made = []
    cache = TwoGenerations(lambda k: made.append(k) or len(k), entries=10, longest=3)
    for i in range(100):
        assert cache[str(i)] == len(str(i))
        assert cache["hot"] == 3 and cache["longer"] == 6
    assert len(cache) <= 10 and len(cache.old) <= 10
    assert made.count("hot") == 1 and made.count("longer") == 100
