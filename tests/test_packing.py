"""Properties of the batch helpers, without a session."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from simmart.functions.packing import pack, text_array, words_array
from simmart.operators.similarity import _Batch, _target_block

WIDTH = st.sampled_from([1, 64, 100, 128, 2048])


@st.composite
def fingerprints(draw):
    n_bits = draw(WIDTH)
    one = st.sets(st.integers(0, n_bits - 1), max_size=40).map(sorted)
    return n_bits, draw(st.lists(one, min_size=1, max_size=12))


@settings(max_examples=60, deadline=None)
@given(fingerprints())
def test_all_forms_pack_alike(case):
    n_bits, sets = case
    on = pa.array(sets, pa.list_(pa.int32()))
    words = pack(on, n_bits)
    for row, bits in zip(words, sets):
        text = "".join(f"{int(w):064b}" for w in row)
        assert [i for i, c in enumerate(text) if c == "1"] == bits
    text = text_array(on, n_bits)
    assert [len(t) for t in text.to_pylist()] == [n_bits] * len(sets)
    assert (pack(text, n_bits) == words).all()
    assert (pack(words_array(on, n_bits), n_bits) == words).all()


@settings(max_examples=60, deadline=None)
@given(fingerprints(), st.data())
def test_scores_and_windows(case, data):
    n_bits, sets = case
    ids = [f"s{i}" for i in range(len(sets))]
    on = pa.array(sets, pa.list_(pa.int32()))
    batch = _Batch(pa.RecordBatch.from_arrays([pa.array(ids), on], names=["id", "fp"]), n_bits)
    block = _target_block(pa.table({"id": ids, "fp": on}), n_bits)
    floor = data.draw(st.floats(0.01, 1.0))
    lows, highs = batch.windows(block, np.full(len(ids), floor))
    order = batch.ids.to_pylist()
    for t, name in enumerate(block["names"]):
        mine = set(sets[int(name[1:])])
        scores = batch.scores(block, t, 0, len(ids), 0.0)
        for i, source in enumerate(order):
            other = set(sets[int(source[1:])])
            expected = len(mine & other) / len(mine | other) if mine | other else 0.0
            assert scores[i] == expected
            if expected >= floor:
                assert lows[t] <= i < highs[t]


@pytest.mark.parametrize(
    "bad",
    [
        pa.array(["000", "00000"]), pa.array(["0102"]), pa.array(["01é"]),
        pa.array([[-1]], pa.list_(pa.int32())), pa.array([[4]], pa.list_(pa.int32())), pa.array([[None]], pa.list_(pa.int32())),
        pa.array([[0, 0]], pa.list_(pa.int64())), pa.array([[1]], pa.list_(pa.int64())), pa.array([[None]], pa.list_(pa.int64())),
    ],
)
def test_malformed_fingerprints_are_errors(bad):
    with pytest.raises(ValueError, match="fingerprint"):
        pack(bad, 4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("01", min_size=0, max_size=6), min_size=1, max_size=6))
def test_text_of_the_width_and_no_other(texts):
    if all(len(t) == 4 for t in texts):
        assert pack(pa.array(texts), 4)[:, 0].tolist() == [int(t, 2) << 60 for t in texts]
    else:
        with pytest.raises(ValueError):
            pack(pa.array(texts), 4)


def test_packing_holds_few_rows_spread_out():
    import tracemalloc

    rng = np.random.default_rng(3)
    rows = np.sort(rng.integers(0, 2048, (10_000, 280)), axis=1).astype(np.int32)
    lists = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, 280, dtype=np.int32), pa.array(rows.ravel()))
    tracemalloc.start()
    words = pack(lists.slice(5, 9_000), 2048)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    for i in (0, 999, 1_000, 8_999):
        bits = np.unpackbits(words[i : i + 1].astype(">u8").view(np.uint8))
        assert np.flatnonzero(bits).tolist() == sorted(set(rows[5 + i].tolist()))
    assert pack(lists.slice(0, 0), 2048).shape == (0, 32)
