"""The array helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm.spans import PrefixHash, BYTE_CODE, lookup, steps, text_buffer, word_hashes, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\né日", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    data, off = text_buffer(pa.array(texts, pa.string()))
    starts, ends, rows = words(data, off)
    raw = data.tobytes()
    got = [[raw[starts[k]:ends[k]].decode() for k in range(rows[i], rows[i + 1])] for i in range(len(texts))]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert got == want
    s, e, codes, first = word_hashes(data, off)
    flat = [w for x in want for w in x]
    assert len(codes) == len(flat) and first.tolist() == np.cumsum([0, *map(len, want)]).tolist()
    assert len(set(codes.tolist())) == len(set(flat))


def test_prefix_hash_windows_equal_for_equal_bytes():
    data = np.frombuffer(b"abcabcabx", np.uint8)
    h = PrefixHash(BYTE_CODE[data]).windows(3)
    assert h[0] == h[3] and h[1] == h[4] and h[0] != h[1] and len(h) == 7
    assert len(PrefixHash(BYTE_CODE[data]).windows(10)) == 0


def test_steps_cover_all_rows_once():
    off = np.array([0, 5, 5, 100, 101, 103])
    assert [x for a, b in steps(off, 10) for x in range(a, b)] == list(range(5))
    assert list(steps(np.zeros(1, np.int64))) == []


def test_lookup():
    keys = np.array([2, 5, 9], np.uint64)
    assert lookup(keys, np.array([9, 1, 5, 10], np.uint64)).tolist() == [2, -1, 1, -1]
    assert lookup(keys[:0], keys).tolist() == [-1, -1, -1]
