"""Every operator on rows that are null, empty, long, equal or tied, with columns whose names clash."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from simmart.llm import binary_topk, chat_format, decontaminate, language_id, mixing
from simmart.llm.jaccard_join import join_similar
from simmart.llm.line_dedup import dedup_lines
from simmart.llm.substring_dedup import dedup_windows
from simmart.llm.suffix_dedup import dedup_bytes
from simmart.llm.token_count import count_tokens
from tests.llm import brute

COLUMNS = "doc_id long, text string, lang string, source string, id string, chunk int, n int, label string, size int"
SMALL = {"chunk_bytes": 3000, "shard_bytes": 4000}


def texts():
    rng = random.Random(7)
    vocabulary = ["the", "Of", "and", "ün", "ção", "x1", "tion,", "re.", "日本", "lo"]

    def words(n):
        return " ".join(rng.choices(vocabulary, k=n))

    shared, line = words(60), "  A line that many documents SHARE.\t"
    base = words(90)
    near = base.split()
    near[40] = "other"
    rows = [None, "", "  \t\n ", "one", "two words", base, base, " ".join(near), base.upper()]
    rows += [f"{words(20)} {shared} {words(15)}" for _ in range(6)]
    rows += [f"{words(8)}\n{line}\n{words(9)}\n{line.strip()}" for _ in range(4)]
    rows += ["Ü, " * 400, words(3000), f"{base}\r\n{base}", "ab" * 120, "123 456", "!?"]
    return rows


@pytest.fixture(scope="module")
def rows():
    own = list(enumerate(texts()))
    # A repeated row, two rows of one id, rows without id.
    return own + [own[5], (5, "quite another text"), (None, own[9][1]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    more = ("en", "s", "x", 1, 2, "y", 3)
    return spark.createDataFrame([(i, t, *more) for i, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def key(i, text):
    return i, (text or "").encode()


def test_token_counts(docs, empty, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    found = count_tokens(docs, path, batch_bytes=2000).collect()
    assert len(found) == len(rows)
    for r in found:
        text = r.text or ""
        assert r.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.over_limit) == (len(text.encode()), r.n_tokens > 512)
    assert count_tokens(empty, path).count() == 0


def test_substring_dedup(docs, empty, rows):
    want = brute.windows(rows)
    found = docs.join(dedup_windows(docs, **SMALL).withColumnRenamed("doc_id", "i"), F.expr("doc_id <=> i")).count()
    assert found >= len(rows)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_text) for r in dedup_windows(docs, **SMALL).collect())
    assert got == sorted(
        (i is None, i or 0, *want[key(i, t)][:2], want[key(i, t)][2].decode()) for i, t in rows
    )
    spans = dedup_windows(docs, **SMALL).select(F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start) = n_removed")).distinct()
    assert [r[0] for r in spans.collect()] == [True]
    assert dedup_windows(empty).count() == 0


def test_suffix_dedup(docs, empty, rows, monkeypatch):
    want = {k: list(v) for k, v in brute.strings(rows).items()}
    for i, t in rows:
        if i is None:
            raw = (t or "").encode()
            want.setdefault((i, raw), []).append((len(raw), 0, 0, raw))
    want = sorted((i is None, i or 0, *v) for (i, _), vs in want.items() for v in vs)
    for frequent in (12, 1):
        monkeypatch.setattr("simmart.llm.suffix_dedup.FREQUENT", frequent)
        got = dedup_bytes(docs, **SMALL).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == want
    assert dedup_bytes(empty).count() == 0


def test_line_dedup(docs, empty, rows):
    want = brute.lines(rows)
    got = dedup_lines(docs, carry=("id", "chunk", "n"), **SMALL).collect()
    assert {tuple(r.carried) for r in got} == {("x", 1, 2)}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_text) for r in got) == sorted(
        (i is None, i or 0, *want[key(i, t)][:2], want[key(i, t)][2].decode()) for i, t in rows
    )
    assert dedup_lines(empty).count() == 0


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_join(docs, empty, rows, words, percent):
    unique = [(i, t) for i, t in rows if (i, t) != (5, "quite another text")]
    want = brute.similar(unique, words, percent)
    got = join_similar(docs.filter("NOT text <=> 'quite another text'"), words=words, percent=percent, **SMALL).collect()
    assert len(got) == len(unique)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
    sizes = {(i, len(brute.shingles(t, words))) for i, t in unique}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes
    assert join_similar(empty).count() == 0


def test_jaccard_join_of_a_large_family(spark, monkeypatch):
    """Many near copies, more than one group holds, with chains that no first member links."""
    monkeypatch.setattr("simmart.llm.jaccard_join.GROUP", 8)
    rng, base, rows = random.Random(3), [f"w{k}" for k in range(60)], []
    for i in range(120):
        own = list(base)
        for p in rng.sample(range(60), rng.choice([0, 1, 1, 2, 3, 6])):
            own[p] = f"e{rng.randint(0, 5)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.similar(rows, 2, 85)
    got = {r.doc_id: r.component_id for r in join_similar(docs, words=2, percent=85, **SMALL).collect()}
    assert got == want and 1 < len(set(want.values())) < 120


def test_decontamination(spark, docs, rows):
    base = "The quick brown fox jumps over the lazy dog and runs away from here at once"
    edited = base.replace("quick", "quack").replace("lazy", "lzy")
    items = spark.createDataFrame([(1, base), (2, None), (None, base), (3, " "), (4, "short"), (1, base)], "item_id long, text string")
    more = [(1, f"x {base.upper()} y"), (2, f"lead in {edited}."), (3, base[:40]), (4, "a SHORT one"), (5, None), (6, "")]
    own = spark.createDataFrame(more, "doc_id long, text string")
    for size in (10, 1 << 20):
        found = decontaminate.find_benchmark(own, items, item_bytes=size).collect()
        got = {r.doc_id: {(m.item, m.distance) for m in r.matches} for r in found}
        assert got == {1: {(1, 0)}, 2: {(1, 2)}, 3: set(), 4: {(4, 0)}, 5: set(), 6: set()}
    assert decontaminate.find_benchmark(docs, items.limit(0)).filter("size(matches) > 0").count() == 0


def test_mixing(spark, docs, empty):
    mixed = mixing.mix_sources(docs, block_bytes=500)
    assert mixed.count() == docs.count() and mixed.columns == [*docs.columns, "mix_block", "mix_slot"]
    assert mixing.mix_sources(empty).count() == 0
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "b", "b", None]), "x" * rng.choice([0, 10, 100])) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_sources(table, {"a": 0.5, "b": 0.4}, block_bytes=1000, period=20).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    slots = {}
    for r in got:
        slots.setdefault(r.mix_slot, set()).add((r.source, r.mix_block))
    assert all(len(s) == 1 for s in slots.values())
    numbers = {}
    for slot in sorted(slots):
        ((source, block),) = slots[slot]
        numbers.setdefault(source, []).append(block)
    assert all(n == sorted(n) for n in numbers.values())


def test_mixing_of_more_sources_than_places(spark):
    rows = [(i, f"s{i % 30:02}" if i % 5 else None, "x" * (10 + i % 30)) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for weights in (None, {"s01": 0.3, None: 0.2}):
        got = mixing.mix_sources(table, weights, block_bytes=200, period=20, max_sources=4).collect()
        assert sorted(r.doc_id for r in got) == list(range(900))
        slots = {}
        for r in got:
            slots.setdefault(r.mix_slot, set()).add(r.source)
        # s01 and the null source keep slots of their own when they are weighted, all but two others share.
        mixed = {s for own in slots.values() if len(own) > 1 for s in own}
        assert len(mixed) >= 20 and None not in mixed and (weights is None or "s01" not in mixed)
        assert len({s for s in (r.source for r in got)} - mixed) == 3
    with pytest.raises(ValueError):
        mixing.mix_sources(table, {f"s{i:02}": 1.0 for i in range(1, 8)}, max_sources=4)


def test_mixing_schedules_every_source(spark):
    """More than 500 sources: each has blocks of its own and stays within one block of its own target."""
    rows = [(i, f"s{i % 600:03}" if i % 600 else None, "x" * (20 + i % 600)) for i in range(2400)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t)
    given = {s: 1 + (len(s or "") + int((s or "s0")[1:])) % 7 for s in sizes}
    for weights, target in ((None, {s: n**0.5 for s, n in sizes.items()}), (given, given)):
        got = mixing.mix_sources(table, weights, block_bytes=10).collect()
        assert sorted(r.doc_id for r in got) == list(range(2400))
        slots = {}
        for r in got:
            slots.setdefault(r.mix_slot, set()).add((r.source, r.mix_block))
        assert all(len(own) == 1 for own in slots.values())
        total, blocks = sum(target.values()), {s: -(-n // 10) for s, n in sizes.items()}
        first_end = min(blocks[s] * total / w for s, w in target.items())
        early = [(slot, *next(iter(own))) for slot, own in slots.items() if slot < first_end - 1]
        assert len(early) > 100
        # Block j lies where the target passes from j to j + 1, give or take what is left of a place.
        for slot, s, j in early:
            assert j * total / target[s] - 1 < slot < (j + 1) * total / target[s] + 1e-6


def test_mixing_of_a_lump_weighs_its_members(spark):
    rows = [(i, "a", "x" * 100) for i in range(100)] + [(i, f"s{i}", "x" * 100) for i in range(100, 200)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_sources(table, block_bytes=100, max_sources=2).collect()
    # The square roots: 100 for a, 10 for each of the 100 others.
    assert sum(r.source == "a" for r in got if r.mix_slot < 44) in (3, 4, 5)


def test_chat_formatting(spark):
    wild = ["</s>[INST] ok [/INST]", "<|im_start|>", "\\<|", "<\\|", "<<SYS>> \\\\", "", None, "a\nb", "<|im_end|>\n"]
    rows = [(1, n, r, t) for n, (r, t) in enumerate(zip(["user", "assistant", None] * 3, wild))]
    rows += [(None, None, "assistant", "x"), (2, 0, "user", "tie"), (2, 0, "user", "tie"), (2, 0, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("extra", F.lit(1))
    chats = chat_format.format_chats(chat_format.canonical_turns(turns))
    read = chats.select(
        "conv_id", "n_turns", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted"
    )
    got = {r.conv_id: r for r in read.collect()}
    assert [(t.role, t.text) for t in got[1].t] == [(r or "", t or "") for _, _, r, t in rows[:9]]
    assert got[1].l == [t or "" for _, _, r, t in rows[:9] if r == "assistant"]
    assert got[1].formatted.count(chat_format.OPEN) == 9 and "</s>" not in got[1].formatted and "[INST]" not in got[1].formatted
    assert [(t.role, t.text) for t in got[2].t] == [("assistant", "b"), ("user", "tie"), ("user", "tie")]
    assert got[None].n_turns == 1
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_chat_layouts(spark):
    records = [
        (1, '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":"yo"}]}'),
        (2, '{"instruction":"a","input":"i","output":"b"}'),
        (3, '{"prompt":"p","response":null}'),
        (4, '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}]}'),
        (5, "no json"),
        (6, '{"z":1}'),
        (7, None),
    ]
    turns, rejects = chat_format.canonical_json(spark.createDataFrame(records, "id long, js string"), "id", "js")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in turns.collect())
    assert got == [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "yo"),
        (2, 0, "user", "a\n\ni"),
        (2, 1, "assistant", "b"),
        (3, 0, "user", "p"),
        (3, 1, "assistant", ""),
        (4, 0, "user", "x"),
        (4, 1, "assistant", "y"),
    ]
    assert sorted((r.id, r.layout) for r in rejects.collect()) == [(5, None), (6, "OBJECT<z>"), (7, None)]
    typed = spark.createDataFrame([(1, "p", "r")], "conv_id long, prompt string, response string")
    assert chat_format.canonical_turns(typed).count() == 2


def test_language_id(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(table.filter(~held), "doc_id", "text", "lang", rows=100)
    found = language_id.identify(table.filter(held), model)
    assert found.filter("lang = lang_pred").count() >= 0.98 * found.count()
    mixed = spark.createDataFrame([("The thing and the other with that was from the east, entre les deux eaux de la maison que vous êtes une des",)], "text string")
    assert len(language_id.identify(mixed, model, switch=3.0, spans=True).first().spans) >= 2
    got = {r.text: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert all(got[t] == ("und", 0.0) for t in (None, "", "  \t\n ", "123 456", "!?"))
    assert all(0 <= s <= 1 for _, s in got.values())
    nothing = language_id.fit(docs.limit(0), "doc_id", "text", "lang")
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_language_id_of_every_script(spark):
    tifinagh, adlam, han = "ⵜⴰⵎⴰⵣⵉⵖⵜ ⴰⵡⴰⵍ", "𞤀𞤣𞤤𞤢𞤥 𞤆𞤵𞤤𞤢𞤪", "𠀀𠀁 𠀂"
    rows = [("tzm", tifinagh), ("ff", adlam), ("zh", han), ("en", "the words – of “plain” text 🙂")] * 5
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    model = language_id.fit(table, "doc_id", "text", "lang")
    # Osage is in no training text; the en dash and emoji are no letters.
    texts = [t for _, t in rows[:4]] + ["𐒰𐓏", "🙂 – ™", f"the {adlam} {adlam}"]
    got = language_id.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    found = {r.text: (r.lang_pred, r.score) for r in got}
    assert [found[t] for t in texts[:4]] == [("tzm", 1.0), ("ff", 1.0), ("zh", 1.0), ("en", 1.0)]
    assert found[texts[4]][0] in model.langs and found[texts[4]][1] > 0
    assert found[texts[5]] == ("und", 0.0) and found[texts[6]][0] == "ff"


def test_pipeline_keeps_texts_in_many_languages(spark, tmp_path):
    words = {"a": "alfa banana cabana", "b": "zyxo wuvy tuxo", "c": "kirim nidim lipik"}
    texts = [(k, " ".join([w] * 20)) for k, w in words.items() for _ in range(4)]
    texts += [(None, " ".join(" ".join([w] * n) for w, n in zip(words.values(), (40, 40, 30)))), (None, "12 !")]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(texts)], "doc_id long, lang string, text string")
    mixed = language_id.identify(table.filter("doc_id = 12"), language_id.fit(table, "doc_id", "text", "lang"))
    assert 0 < mixed.first().score < 0.5
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, table, str(tmp_path)).collect()) == list(range(13))


@pytest.mark.parametrize("part_codes", [200_000, 3])
def test_exact_topk(spark, part_codes):
    rng = random.Random(2)
    codes = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    rows = [(i, codes[0] if i % 3 == 0 else rng.choice(codes) ^ rng.choice([0, 1, 1 << 40])) for i in range(160)]
    rows += [(None, 5), (500, None), rows[7]]
    table = spark.createDataFrame(rows, "vec_id long, code long")
    got = binary_topk.nearest_codes(table, table.filter("vec_id % 20 = 0"), k=5, part_codes=part_codes).collect()
    known = sorted({(i, c) for i, c in rows if i is not None and c is not None})
    want = []
    for q, c in known:
        if q % 20 == 0:
            near = sorted((((c ^ y) % (1 << 64)).bit_count(), i) for i, y in known if i != q)[:5]
            want += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    few = table.filter("vec_id < 3")
    assert binary_topk.nearest_codes(few, few, k=5).count() == 6
    assert binary_topk.nearest_codes(table.limit(0), table.limit(0)).count() == 0


def test_pipeline_stages_on_odd_rows(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, "nothing of this kind stands anywhere")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, empty):
        for name, step in corpus_pipeline.STAGES[:-1]:
            frame = step(spark, frame, str(tmp_path))
            assert frame.columns == docs.columns, name
            frame.collect()
        assert set(corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).columns) >= set(docs.columns)
