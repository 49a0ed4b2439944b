"""Words and names against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from textmill.llm.words import ALNUM, NOT_SPACE, slices, split_words, window_names

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB3 \t\n\x0b\x85é 中!-", max_size=40)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([1, 8, 1 << 20]))
def test_words_are_those_of_the_pattern(texts, max_bytes):
    for table, pattern, lower in ((NOT_SPACE, r"[^\x20\x09-\x0D]+", False), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        got = []
        for lo, hi, data, offs in slices(pa.array(texts, pa.string()), max_bytes):
            w = split_words(data, offs, table, lower)
            for r in range(hi - lo):
                got.append([w.word(i).decode() for i in range(w.row_first[r], w.row_first[r + 1])])
        low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t) if lower else t
        assert got == [re.findall(pattern, low(t or "")) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=5), min_size=1, max_size=30), st.integers(1, 4))
def test_equal_names_are_equal_words_and_windows(words, width):
    data = " ".join(words).encode()
    w = split_words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), NOT_SPACE)
    h = w.hashes()
    assert len(set(h.tolist())) == len(set(words))
    names = window_names(h, width).tolist()
    spans = [tuple(words[i: i + width]) for i in range(len(words) - width + 1)]
    assert len(names) == len(spans) and len(set(names)) == len(set(spans))
    assert all((names[i] == names[j]) == (spans[i] == spans[j]) for i in range(len(spans)) for j in range(i))
