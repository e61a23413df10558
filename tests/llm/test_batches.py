"""Words, hashes and shingles of Arrow columns against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sonomere.llm import batches
from tests.llm.conftest import words_of

TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="aAbZ \t\n\r\x0b\x0cé漢\x1c.", max_size=40)), max_size=8
)


@given(TEXTS)
@settings(max_examples=80, deadline=None)
def test_words_and_shingles(texts):
    column = pa.array(texts, pa.string())
    data, offsets = batches.flat(column)
    start, end, row = batches.spans(data, offsets)
    lowered = [data[a:b].tobytes().decode() for a, b in zip(start, end)]
    wanted = [(i, w) for i, t in enumerate(texts) for w in words_of(t)]
    found = [(r, "".join(c.lower() if c.isascii() else c for c in w)) for r, w in zip(row, lowered)]
    assert found == wanted
    h = batches.hashes(data, start, end)
    names = {}
    for (_, w), value in zip(wanted, h.tolist()):
        assert names.setdefault(w, value) == value
    assert len(set(names.values())) == len(names)
    for k in (1, 3, 5):
        key, of, first = batches.shingles(h, row, len(texts), k)
        expected = []
        for i, t in enumerate(texts):
            w = words_of(t)
            n = max(len(w) - k + 1, 1 if w else 0)
            expected += [(i, tuple(w[j : j + k])) for j in range(n)]
        assert [r for r, _ in expected] == of.tolist()
        values = {}
        for (_, s), value in zip(expected, key.tolist()):
            assert values.setdefault(s, value) == value
        assert len(set(values.values())) == len(values)
        assert (row[first] == of).all()


def test_sequences_and_slices():
    word = np.arange(1, 11, dtype=np.uint64)
    a = batches.sequence_hashes(np.concatenate([word, word]), np.array([0, 10, 0]), np.array([4, 14, 5]))
    assert a[0] == a[1] != a[2]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5)), pa.array(["a" * 10, None, "b" * 50, "", "c"])], ["doc_id", "text"]
    )
    parts = list(batches.slices(batch, size=12))
    assert sum(p.num_rows for p in parts) == 5
    assert pa.Table.from_batches(parts).column(0).to_pylist() == list(range(5))
    sliced = batch.slice(2)
    data, offsets = batches.flat(sliced.column(1))
    assert data.tobytes() == b"b" * 50 + b"c" and offsets.tolist() == [0, 50, 50, 51]
