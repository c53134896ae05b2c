import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronoframe.llm.elias_fano import DECODED, EliasFano, Trie, quantise


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=200), st.integers(0, 1 << 40))
def test_sequence_round_trip_and_search(values, probe):
    values = np.sort(np.array(values, np.uint64))
    seq = EliasFano.from_buffer(EliasFano.build(values, (1 << 40) + 1).to_bytes())
    assert (seq.get(np.arange(values.size)) == values).all()
    sought = np.append(values, [probe]).astype(np.uint64)
    found = seq.find(sought)
    assert ((found >= 0) == np.isin(sought, values)).all()
    assert (values[found[found >= 0]] == sought[found >= 0]).all()


def test_trie_finds_its_pairs_alone():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 300, (4000, 2)).astype(np.uint64), axis=0)
    p = rng.uniform(1e-6, 1, len(pairs))
    trie = Trie.from_buffers(Trie.build(pairs[:, 0], pairs[:, 1], p, 1 << 48).to_bytes())
    codes = trie.lookup(pairs[:, 0], pairs[:, 1])
    assert np.abs(np.log10(DECODED[codes]) - np.log10(p)).max() <= 0.0201
    known = {tuple(x) for x in pairs.tolist()}
    others = np.array([x for x in rng.integers(0, 320, (3000, 2)).tolist() if tuple(x) not in known], np.uint64)
    assert not trie.lookup(others[:, 0], others[:, 1]).any()
    none = Trie.build(pairs[:0, 0], pairs[:0, 1], p[:0], 1 << 48)
    assert not none.lookup(pairs[:, 0], pairs[:, 1]).any()


def test_quantise_keeps_zero():
    assert quantise(np.array([0.0, 1.0, 1e-3])).tolist()[0] == 0
    assert DECODED[quantise(np.array([1.0]))][0] == pytest.approx(1.0)
