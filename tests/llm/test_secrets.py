"""Secret scan against Python's matches and entropies counted window by window."""

import math
import random
import re
from collections import Counter

from simmart.llm import secret_scan as ss

KEYS = "password|passwd|secret|token|api_?key"
ANY_CASE = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in KEYS)
PLAIN = (
    (re.compile(f"({ANY_CASE})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    (re.compile("[0-9a-f]+"), 0, 32),
)


def plain(text):
    """(base, all) spans as ``(start, kind, end)``."""
    text = text or ""
    base = sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(PLAIN) for m in p.finditer(text) if len(m[g]) >= n)
    covered = set()
    for m in re.finditer("[A-Za-z0-9+/_-]{24,}", text):
        if not re.search(ss.MIXED, m[0]) or any(re.search(a, m[0]) for a in ss.ALLOWED):
            continue
        for i in range(len(m[0]) - ss.WINDOW + 1):
            window = m[0][i : i + ss.WINDOW]
            entropy = -sum(c / ss.WINDOW * math.log2(c / ss.WINDOW) for c in Counter(window).values())
            if any(set(window) <= set(c.alphabet) and entropy >= c.least for c in ss.CLASSES):
                covered |= set(range(m.start() + i, m.start() + i + ss.WINDOW))
    spans = [(s, 3, min(e for e in range(s, len(text) + 2) if e not in covered)) for s in covered if s - 1 not in covered]
    free = [x for x in spans if not any(b[0] < x[2] and x[0] < b[2] for b in base)]
    return base, sorted(base + free)


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    found = ss.scan_secrets(docs)
    plans = found._jdf.queryExecution().toString()
    assert "Python" not in plans and "Arrow" not in plans and "Exchange" not in plans
    for r in found.collect():
        got = [tuple(s) for s in r.base], [tuple(s) for s in r.spans]
        assert got == plain(texts[r.id]), texts[r.id][:300]


def random_text(rng):
    key = "".join(rng.choices(ss.CLASSES[2].alphabet, k=rng.randrange(10, 90)))
    parts = [
        "password", "Token", "API_KEY", "apikey", "secret", "passwd", ":", "=", " ", "  ", '"', "'", "AKIA", "AKIAQQQQ", "Z9" * 9, "ab" * 9,
        "deadbeef" * 3, "0f3" * 6, "ä", "😀", "\n", "a.b-c_d/e+f", "é=", "12345", key, key[:30], "folder/name-of/path_part/2024/long", "1" * 30,
        "0f8fad5b-d9cb-469f-a165-70867728950e", "EXAMPLE" + key, "=", " ",
    ]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))


def test_random_texts(spark):
    rng = random.Random(13)
    check(spark, [None, "", "a", "=", *(random_text(rng) for _ in range(300))])


def test_failing_matches_use_their_place(spark):
    check(spark, ["password: secret: abcdefghij", "token=password=abcdefgh", 'x"api_key" : "abcdefg"', "ſecret=abcdefghijk toKen=abcdefghijk"])


def test_long_text_and_many_matches(spark):
    rng = random.Random(14)
    key = "".join(rng.choices(ss.CLASSES[2].alphabet, k=9000))
    many = " ".join(f"token={rng.randrange(10**9, 10**10)} pässword" for _ in range(3000))
    check(spark, [f"é {key} end", many + " " + key[:100], "word " * 50_000 + "AKIA" + "Q7" * 9])


def test_empty_table(spark):
    assert ss.scan_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_windows_of_random_keys_are_found_and_words_are_not(spark):
    rng = random.Random(15)
    keys = ["".join(rng.choices(ss.CLASSES[2].alphabet[:62], k=40)) for _ in range(200)]
    words = ["einstaueinkeitlichlichkeitundmehr", "some_long_snake_case_identifier_name", "docs/2024/11/report-final-version-two"] * 20
    rows = ss.scan_secrets(spark.createDataFrame(list(enumerate(keys + words)), "doc_id long, text string")).collect()
    hits = [r.id for r in rows if r.spans]
    assert sum(i < 200 for i in hits) >= 198 and all(i < 200 for i in hits)
