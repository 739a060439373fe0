"""Spelling variants against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(counts, ratio=5):
    best = {}
    for w, n in counts.items():
        beside = [(-counts[o], o) for o in counts if near(w, o)]
        form = min(beside)[1] if beside and -min(beside)[0] >= ratio * n else None
        best[w] = (form, len(beside))
    out = []
    for w, n in counts.items():
        root = w
        while best[root][0] is not None:
            root = best[root][0]
        form, n_near = best[w]
        out.append((w, form, root, n, n_near, counts.get(form)))
    return sorted(out)


@pytest.fixture(scope="module")
def counts():
    rng = random.Random(4)
    base = ["".join(rng.choices("abcdeéè", k=rng.randrange(3, 8))) for _ in range(60)]
    counts: Counter = Counter()
    for k, w in enumerate(base):
        counts[w] += 4 ** rng.randrange(1, 9)
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("abzÿÀ")
            counts[rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])] += rng.randrange(1, 40)
    counts |= {"".join(rng.sample("abcdefg", 7)): 5 for _ in range(300)}  # anagrams
    counts |= {"aaaaaa": 5, "aaaaaab": 25, "aaaaaabb": 125, "aaaaaabbb": 625, "aaaaaabbbb": 3125, "x" * 20_000: 9, "x" * 20_001: 90, "a😀": 5, "b😀": 25, "": 3, "a": 4}
    return counts


@pytest.mark.parametrize("crowded", [1, 8, variants.CROWDED])
def test_group_variants(spark, counts, crowded):
    rows = list(counts.items())
    split = [("aaaaaab", 20), ("aaaaaab", 5), (None, 7), *[r for r in rows if r[0] != "aaaaaab"]]
    df = spark.createDataFrame([(*r, "x", "y") for r in split], "word string, n long, key string, full string").repartition(3)
    got = sorted(map(tuple, variants.group_variants(df, crowded=crowded).collect()))
    want = brute(counts)
    # an empty word is near none
    want = [(w, f, r, n, 0 if w == "" else m - near(w, ""), k) for w, f, r, n, m, k in want]
    assert got == want
    assert ("aaaaaa", "aaaaaab", "aaaaaabbbb", 5, 1, 25) in got and sum(r[4] for r in got) > 400


def test_a_pair_meets_once():
    powers = [c**5 for c in [*range(97, 123), *range(0xC0, 0x100)]]
    assert max(powers) < variants.POWERS
    apart = Counter(a - b for a in powers for b in powers if a != b)
    assert max(apart.values()) == 1 and not set(apart) & (set(powers) | {-p for p in powers})


def test_anagrams_share_keys(spark):
    df = spark.createDataFrame([("éab", "baé"), ("abc", "bca"), ("x", "x")], "a string, b string")
    assert all(r[0] == r[1] for r in df.select(variants.anagram_key(F.col("a")), variants.anagram_key(F.col("b"))).collect())
    assert spark.createDataFrame([("éab",)], "a string").select(variants.anagram_key(F.col("a"))).first()[0] == 233**5 + 97**5 + 98**5


def test_query_of_awkward_documents(spark, tmp_path):
    rng = random.Random(6)
    words = ["Retion", "rétions", "RETIONS", "short", "ÀÉÿ×÷öab", "naïvely"]
    texts = [" ".join(rng.choices(words, k=400)) + "1retions2retions" for _ in range(30)] + [None, "", "!!", "retions" * 3, " ".join(["retions"] * 200_000)]
    ids = [*range(len(texts) - 2), None, 3]
    spark.createDataFrame([(i, t, "r", 1) for i, t in zip(ids, texts)], "doc_id long, text string, run string, word int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    import re

    counts: Counter = Counter()
    for i, t in zip(ids, texts):
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w if h % 199 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    want = brute({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = queries.QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and sorted(map(tuple, got.collect())) == want


def test_no_words(spark):
    assert variants.group_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    assert variants.group_variants(spark.createDataFrame([("alone", 5)], "word string, n long")).collect() == [("alone", None, "alone", 5, 0, None)]
