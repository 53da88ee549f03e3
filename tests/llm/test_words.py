import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st
from plain import WORD, shingles

from creditloom.llm import words

TEXTS = st.lists(st.none() | st.text("aB \t\n\x0b\x0c\rß .", max_size=30), max_size=8)


@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    place, found = words.word_hashes(pa.array(texts, pa.string()))
    expected = [(i, w.lower()) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    assert place.tolist() == [i for i, _ in expected]
    names = dict(zip(found.tolist(), [w for _, w in expected]))
    assert [names[h] for h in found.tolist()] == [w for _, w in expected]


@given(TEXTS, st.integers(1, 3))
def test_shingle_sets(texts, k):
    place, found = words.shingle_sets(pa.array(texts, pa.string()), k)
    sets = [shingles(t, k) for t in texts]
    assert np.bincount(place, minlength=len(texts)).tolist() == [len(s) for s in sets]
    hashed = [frozenset(found[place == i].tolist()) for i in range(len(texts))]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(hashed[i] & hashed[j]) == len(sets[i] & sets[j])


def test_sliced_arrays_and_parts():
    texts = pa.array(["x y", None, "y z", "x y z"])
    whole = words.word_hashes(texts)[1].tolist()
    assert words.word_hashes(texts[2:])[1].tolist() == whole[2:]
    assert list(words.parts(texts, 4)) == [(0, 2), (2, 3), (3, 4)]
    assert list(words.parts(texts[:0])) == []
