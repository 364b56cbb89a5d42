"""The small parts inside the operators against plain versions."""

import random
import unicodedata
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from simmart.llm import blocks, decontaminate, language_id, line_dedup, mixing, suffix_dedup, token_count
from tests.llm import brute


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_safe_pieces_add_up(tokenizer):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "'s", "'", "don't", "1", "23", "!", "é", "\xa0", "\x1c", "<|endoftext|>", "\r\n", "日", "\x0b"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(3000)]
    for text, whole in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        pieces = token_count.safe_pieces(text)
        assert "".join(pieces) == text
        assert sum(len(e.ids) for e in tokenizer.encode_batch(pieces, add_special_tokens=False)) == len(whole.ids)


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=300, unique=True))
def test_minimal_hash_numbers_keys(keys):
    keys = np.array(sorted(keys), np.uint64)
    index = line_dedup.MinimalHash(keys)
    assert sorted(index.numbers(keys).tolist()) == list(range(len(keys)))
    assert (blocks.unpack_sorted(blocks.pack_sorted(keys), len(keys)) == keys).all()


def test_line_index_rejects_other_lines():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    index = line_dedup.LineIndex(keys[:10_000], np.ones(10_000, np.int64), np.arange(10_000))
    docs, last = index.probe(keys)
    assert (docs[:10_000] == 1).all() and (last[:10_000] == np.arange(10_000)).all()
    assert not docs[10_000:].any()


@settings(deadline=None, max_examples=200)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=30))
def test_myers_is_the_edit_distance(pattern, text):
    hit = decontaminate.myers(pattern, text, len(pattern))
    assert (hit[0] if hit else len(pattern)) == brute.substring_distance(pattern, text)
    found = decontaminate.find_item(pattern, text, len(pattern) - 1)
    if found:
        assert brute.substring_distance(pattern, text[found[1] : found[2]]) == found[0]


@given(st.dictionaries(st.integers(0, 8), st.integers(1, 30), min_size=1))
def test_pfair_stays_within_one_block(shares):
    plan, period = mixing.pfair_period(shares), sum(shares.values())
    assert [p for p, _, _ in plan] == list(range(period))
    done = dict.fromkeys(shares, 0)
    for place, source, number in plan:
        assert done[source] == number
        done[source] += 1
        assert all(abs(shares[s] * (place + 1) / period - done[s]) < 1 for s in shares)
    assert done == shares


def test_phases_place_every_block():
    shares, left = {0: 3, 1: 2, 2: 1}, {0: 100, 1: 7, 2: 0}
    plan = mixing.phases(shares, left)
    assert {s: sum(p.shares.get(s, 0) * p.periods for p in plan) for s in left} == left


def deviation(weights, blocks):
    """Largest distance of a source from the target of its exact weight, at any place."""
    plan = mixing.schedule(weights, blocks)
    order = sorted((p, s) for s, own in plan.items() for p in own)
    assert [p for p, _ in order] == list(range(sum(blocks.values()))) and all(list(p) == sorted(p) for p in plan.values())
    exact, target, done, worst = {s: Fraction(w) for s, w in weights.items()}, dict.fromkeys(blocks, Fraction()), dict.fromkeys(blocks, 0), 0
    for _, s in order:
        done[s] += 1
        room = Fraction(1)
        while room:
            active = [r for r in blocks if target[r] < blocks[r]]
            total = sum(exact[r] for r in active)
            step = min([room, *((blocks[r] - target[r]) * total / exact[r] for r in active)])
            for r in active:
                target[r] += step * exact[r] / total
            room -= step
        worst = max(worst, *(abs(target[r] - done[r]) for r in blocks))
    return worst


@pytest.mark.parametrize("weights, blocks", [({0: 2 / 3, 1: 1 / 3}, {0: 8000, 1: 4000}), ({0: 0.9999, 1: 0.0001}, {0: 19998, 1: 2})])
def test_weights_hold_over_many_periods(weights, blocks):
    assert deviation(weights, blocks) < 1


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.floats(1e-4, 1), st.integers(0, 25)), min_size=1, max_size=8))
def test_weights_hold_when_sources_end(sources):
    assert deviation({s: w for s, (w, _) in enumerate(sources)}, {s: n for s, (_, n) in enumerate(sources)}) < 1


def test_sources_of_weight_zero_come_last():
    plan = mixing.schedule({0: 0, 1: 1.0, 2: 0}, {0: 2, 1: 3, 2: 2})
    assert sorted(plan[1]) == [0, 1, 2] and sorted([*plan[0], *plan[2]]) == [3, 4, 5, 6]


def test_every_letter_makes_a_word():
    """Of the characters with first bytes C2, E2 and F0 those of category L are words, all others none."""
    chars = [chr(i) for r in (range(0x80, 0xC0), range(0x2000, 0x3000), range(0x10000, 0x40000, 7)) for i in r]
    counts = language_id.Words([c.encode() for c in chars]).counts
    assert counts.tolist() == [int(unicodedata.category(c)[0] == "L") for c in chars]


@settings(deadline=None, max_examples=50)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=5), st.integers(0, 2**31))
def test_viterbi_is_the_best_path(counts, seed):
    scores = np.random.default_rng(seed).normal(size=(sum(counts), 3)).astype(np.float32)
    labels, at = language_id.viterbi(scores, np.array(counts), 1.0), 0
    for n in counts:
        own = scores[at : at + n]

        def value(path):
            return sum(own[i, x] for i, x in enumerate(path)) - sum(a != b for a, b in zip(path, path[1:]))

        best = {(): 0.0}
        for _ in range(n):
            best = {(*p, x): 0 for p in best for x in range(3)} if n <= 5 else best
        if 0 < n <= 5:
            assert value(labels[at : at + n].tolist()) == pytest.approx(max(map(value, best)), abs=1e-4)
        at += n


@given(st.binary(min_size=1, max_size=200).map(lambda b: bytes(x % 2 for x in b)))
def test_longest_previous_factor(text):
    length, raw = 9, np.frombuffer(text, np.uint8)
    starts = np.arange(max(0, len(text) - length + 1))
    found = suffix_dedup.occurs_before(raw, starts, length)
    assert found.tolist() == [text.find(text[i : i + length]) < i for i in starts.tolist()]


@given(st.lists(st.integers(0, 20), max_size=30, unique=True))
def test_smaller_neighbours(values):
    before, after = suffix_dedup.smaller_neighbours(np.array(values, np.int64))
    for i, v in enumerate(values):
        assert before[i] == max((j for j in range(i) if values[j] < v), default=-1)
        assert after[i] == min((j for j in range(i + 1, len(values)) if values[j] < v), default=len(values))
