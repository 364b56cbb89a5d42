"""Characters of operator 7 and pieces of operator 1 against Unicode's own tables and whole texts."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from simmart.llm import language_id, token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_words(text):
    """Runs of letters and marks with a letter, one character at a time: the number of letters of each."""
    out, run = [], 0
    for c in text + " ":
        kind = unicodedata.category(c)[0]
        if kind in "LM":
            run += kind == "L"
        elif run:
            out.append(run)
            run = 0
    return out


def test_words_of_any_characters():
    pick = random.Random(7)
    planes = [(0x20, 0x7F), (0x80, 0x250), (0x250, 0xE80), (0xE80, 0x3000), (0x3000, 0xD7FF), (0xE000, 0x10000), (0x10000, 0x10FFFF)]
    texts = ["".join(chr(pick.randint(*pick.choice(planes))) for _ in range(pick.randint(0, 40))) for _ in range(400)]
    texts += ["", "hello 。。。。。。。。。", "١٢٣ 123", "नमस्ते दुनिया", "ＡＢＣ"]
    words = language_id.Words([t.encode() for t in texts])
    want = [plain_words(t) for t in texts]
    assert words.counts.tolist() == list(map(len, want))
    assert words.letters.tolist() == [n for own in want for n in own]


@pytest.mark.parametrize(
    "text, script",
    [("Hello", "Latin"), ("ＡＢＣ", "Latin"), ("Ωμέγα", "Greek"), ("Мир", "Cyrillic"), ("Հայերեն", "Armenian"), ("ܣܘܪܝܝܐ", "Syriac"),
     ("ދިވެހި", "Thaana"), ("हिन्दी", "Devanagari"), ("தமிழ்", "Tamil"), ("ไทย", "Thai"), ("ქართული", "Georgian"), ("አማርኛ", "Ethiopic"),
     ("한국어", "Hangul"), ("かな", "Kana"), ("漢字", "Han"), ("𞤀𞤁", "Adlam")],
)
def test_script_of_a_word(text, script):
    words = language_id.Words([text.encode()])
    assert list(language_id.SCRIPTS)[words.scripts()[0]] == script and len(words.counts) == 1


def test_capitals_and_small_letters_are_alike():
    for text in ("ÀÉÎ Straße", "МОСКВА", "ΑΘΗΝΑ", "ԵՐԵՒԱՆ"):
        upper, lower = (language_id.Words([t.encode()]) for t in (text, text.lower()))
        assert np.array_equal(upper.raw, lower.raw)


def test_scripts_narrow_candidates(spark):
    rows = [("hi", "नमस्ते दुनिया यह हिन्दी है"), ("ta", "வணக்கம் உலகம் இது தமிழ்"), ("th", "สวัสดีชาวโลก นี่คือภาษาไทย"), ("en", "hello world this is english")]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    model = language_id.fit(table, "doc_id", "text", "lang")
    for lang, script in (("hi", "Devanagari"), ("ta", "Tamil"), ("th", "Thai"), ("en", "Latin")):
        row = model.allowed[list(language_id.SCRIPTS).index(script)]
        assert [model.langs[i] for i in np.flatnonzero(row)] == [lang]
    asked = [("दुनिया", "hi"), ("உலகம்", "ta"), ("ภาษา", "th"), ("hello 。。。。。。。。。", "en"), ("١٢٣ 456 。", "und")]
    docs = spark.createDataFrame(asked, "text string, want string")
    assert all(r.lang_pred == r.want and r.score == (r.want != "und") for r in language_id.identify(docs, model).collect())


TEXTS = [
    "天地玄黄，宇宙洪荒。日月盈昃，辰宿列张。" * 300, "漢字かなカナ！？「」（）" * 50, "한국어문장입니다." * 60, "don't.stop!(really)'tis;we're," * 20,
    "a" * 500, "x<|endoftext|>y" * 30, "Привет,мир;как-дела?" * 30, "a.b.c/d:e=f@g" * 30, "1a2b!3c" * 40, "", "mixed 　 spaces。and" * 20,
]


def test_long_pieces_are_cut_at_signs():
    tokenizer = Tokenizer.from_file(PATH)
    for text in TEXTS:
        pieces = token_count.safe_pieces(text)
        assert "".join(pieces) == text
        found = sum(len(e.ids) for e in tokenizer.encode_batch(pieces, add_special_tokens=False))
        assert found == len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert max(map(len, token_count.safe_pieces(TEXTS[0]))) < 10


@pytest.mark.parametrize("memory", [0, 5_000, 1 << 30])
def test_lengths_at_any_memory(memory):
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as file:
        run = token_count.token_lengths(file.read(), 1000, memory)
    texts = [*TEXTS, None, *(" ".join(f"word{i % 50}" for i in range(n)) for n in range(60))]
    batches = [pa.array(texts[i : i + 7], pa.string()) for i in range(0, len(texts), 7)]
    found = [n for part in run(iter(batches)) for n in part.to_pylist()]
    assert found == [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_batches_hold_bytes():
    pieces = ["漢" * 10] * 100
    assert all(sum(map(token_count.n_bytes, b)) <= 1000 + 30 for b in token_count._byte_batches(pieces, 1000))
