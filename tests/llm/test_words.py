from __future__ import annotations

import re

import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from cardwarden.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\rabAé 日", max_size=30)), max_size=8)


@given(TEXTS, st.integers(1, 40))
def test_words_are_the_runs_between_ascii_space(texts, limit):
    found = []
    for w in W.slices(pa.array(texts, pa.string()), limit=limit):
        split = [bytes(w.bytes[a:b]) for a, b in zip(w.start, w.end, strict=True)]
        for i in range(w.last - w.first):
            found.append([x.decode() for x, d in zip(split, w.doc, strict=True) if d == i])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_hashes_tell_words_apart_and_ignore_case_on_request():
    texts = pa.array(["ab Ab ba", "ab", "AB", "é É"])
    h = [x for w in W.slices(texts) for x in w.hash]
    assert len(set(h)) == 6
    low = [x for w in W.slices(texts, lower=True) for x in w.hash]
    assert low[0] == low[1] == low[3] == low[4] and low[5] != low[6]


def test_shingles_of_short_texts_are_one():
    (w,) = W.slices(pa.array(["a b c d e f", "a b", None, "a b", "b a"]))
    doc, value = W.shingles(w)
    of = {i: set(value[doc == i].tolist()) for i in range(5)}
    assert [len(of[i]) for i in range(5)] == [2, 1, 0, 1, 1]
    assert of[1] == of[3] != of[4]
