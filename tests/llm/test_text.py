import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from marlstone.llm import textvec as tv

TEXTS = st.lists(st.text(st.sampled_from("ab Z9\n\té!"), max_size=30), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    data, offs = tv.buffers(pa.array(texts, pa.string()))
    starts, ends, first = tv.spans(data, offs, tv.SPACE_BYTES)
    hashes = tv.word_hashes(data, starts, ends)
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode()) for t in texts]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [w for ws in words for w in ws]
    assert np.diff(first).tolist() == [len(w) for w in words]
    same = {}
    for w, h in zip([w for ws in words for w in ws], hashes.tolist()):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    sh, at = tv.shingles(hashes, first, 3)
    for r, w in enumerate(words):
        expected = [tuple(w[i : i + 3]) for i in range(max(len(w) - 2, min(len(w), 1)))]
        assert at[r + 1] - at[r] == len(expected)
        for g, h in zip(expected, sh[at[r] : at[r + 1]].tolist()):
            assert same.setdefault(g, h) == h


def test_blocks_cover_nulls_and_long_texts():
    column = pa.array([None, "x" * 100, "", "y" * 5000, "z"]).slice(1)
    rows = [(i + k, data[offs[k] : offs[k + 1]].tobytes()) for i, n, data, offs in tv.blocks(column, 64) for k in range(n)]
    assert rows == [(0, b"x" * 100), (1, b""), (2, b"y" * 5000), (3, b"z")]
