"""Trained models against plain loops and held-out labels."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, language_id, lm_scoring, quality, url_filter
from tidemark.llm.common import is_bucket

DATA = "/root/testdata/sf0.01"


def plain_grams(text: str, alphabet: str) -> set[str]:
    """n-grams of lengths 1 to 3 as strings: letters outside the alphabet as one, runs of the rest as a space."""
    out = ""
    for c in text:
        low = c if c in alphabet else next((a for a in alphabet if len(a.upper()) == 1 and a.upper() == c), None)
        code = low or ("\x01" if c.isalpha() else " ")
        if not (code == " " and out.endswith(" ")):
            out += code
    return {out[i : i + n] for n in (1, 2, 3) for i in range(len(out) - n + 1)}


def test_kernel_by_sets():
    texts = ["der hund und die katze", "the dog and the cat", "le chien et le chat", "ein haus am see", "a house by the lake", "une maison au lac", "Ünser Größe ΣΩ 12"]
    langs = ["de", "en", "fr", "de", "en", "fr", "de"]
    m = language_id.LanguageModel(texts, langs, landmarks=7)
    sets = [plain_grams(t, m.features.alphabet) for t in texts]
    assert [len(m.features.grams(t)) for t in texts] == [len(s) for s in sets]
    want = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    got = m.kernel([m.features.grams(t) for t in texts])
    order = [int(np.argmax(row)) for row in want.T]  # landmarks come in a round over the languages
    assert sorted(np.round(got, 5).ravel()) == pytest.approx(sorted(np.round(want, 5).ravel()), abs=2e-5) and len(order) == 7
    # scores are the landmarks' kernels times the dual weights
    assert m.scores(texts) == pytest.approx(got @ m.dual + m.bias, abs=1e-4)


@pytest.mark.parametrize("gap", ["   ", "\n\t ", "- -"])
def test_grams_over_pieces(gap, monkeypatch):
    text = "abc" + gap + "def ghi" * 3
    whole = language_id.Featurizer("abcdefghi").grams(text)
    for size in (1, 2, 3, 4, 5, 7):
        monkeypatch.setattr(language_id, "PIECE", size)
        assert np.array_equal(whole, language_id.Featurizer("abcdefghi").grams(text)), size


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held_out = is_bucket(F.col("doc_id"), 3, 1)
    found = language_id.identify(docs.where(held_out), language_id.train(docs, ~held_out)).where("lang IS NOT NULL AND lang_pred != 'und'")
    n, right = found.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and right >= 0.97 * n


def test_quality_of_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    held_out = is_bucket(F.col("doc_id"), 4, 1)
    found = quality.classify(docs, labels.where(~held_out))
    n, right = found.join(labels.where(held_out), "doc_id").agg(F.count("*"), F.count_if(F.col("kept") == (F.col("quality") > 0))).first()
    assert n > 50 and right >= 0.9 * n


def test_posteriors_by_loop(spark):
    rows = [(i, f"word {'x ' * (i % 5)}{i}", f"h{i % 3}" if i % 7 else None, f"p{i % 2}") for i in range(60)] + [(60, None, "h0", "p0"), (61, "alone here", "h9", "p9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 60, 2)] + [(4, None), (99, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    y = {i: int(i % 3 > 0) for i in range(0, 60, 2)}
    overall = min(0.99, max(0.01, sum(y.values()) / len(y)))
    says = {}
    for i, t, h, p in rows:
        if t:
            soft = 1 / (1 + math.exp(-(math.log(overall / (1 - overall)) + got[i].evidence)))
            says[i] = (1.0, y[i]) if i in y else (0.25, 0.25 * soft)

    def sums(of):
        n, good = {}, {}
        for i, t, h, p in rows:
            if i in says:
                key = of(h, p)
                n[key], good[key] = n.get(key, 0) + says[i][0], good.get(key, 0) + says[i][1]
        return n, good

    def strength(of, mean):
        counts = {}
        for i, v in y.items():
            key = of(rows[i][2], rows[i][3])
            n, g = counts.get(key, (0, 0))
            counts[key] = n + 1, g + v
        over = rest = 0.0
        for key, (n, g) in counts.items():
            m = min(max(mean(key), 0.001), 0.999)
            if n > 1:
                over, rest = over + (g / n - m) ** 2 * n / (m * (1 - m)) - 1, rest + n - 1
        return min(1000.0, max(2.0, 1 / max(1e-6, over / rest) - 1))

    hn, hg = sums(lambda h, p: h)
    pn, pg = sums(lambda h, p: (h, p))
    kh = strength(lambda h, p: h, lambda key: overall)
    kp = strength(lambda h, p: (h, p), lambda key: (hg[key[0]] + kh * overall) / (hn[key[0]] + kh))
    for i, t, h, p in rows:
        w, g = says.get(i, (0.0, 0.0))
        host = min(0.999, max(0.001, (hg.get(h, 0) - g + kh * overall) / (hn.get(h, 0) - w + kh)))
        path = min(0.999, max(0.001, (pg.get((h, p), 0) - g + kp * host) / (pn.get((h, p), 0) - w + kp)))
        assert (got[i].host_rate, got[i].path_rate) == pytest.approx((host, path), rel=1e-6), i
        score = 1 / (1 + math.exp(-(math.log(path / (1 - path)) + got[i].evidence))) if t else 0.0
        assert got[i].score == pytest.approx(score, rel=1e-6, abs=1e-12) and got[i].kept == (score >= 0.5)


def test_url_scores_by_loop(spark):
    urls = [f"http://a{i % 7}.good.org/fr/page{i}" for i in range(200)] + [f"http://spam{i % 5}.net/buy-{i}?x=1" for i in range(200)] + ["ftp://other.com/é"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = pages.select("url", url_filter.rule_of(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")))["verdict"].alias("verdict"))
    model = url_filter.train(rows)
    assert model.known and model.error <= 0.01
    fold = lambda u: [0] * url_filter.ORDER + [int(url_filter._CODES[ord(c)]) for c in u]
    tables = [{}, {}]
    for u in urls[:400]:
        c = fold(u)
        for n in range(url_filter.ORDER + 1):
            for k in range(url_filter.ORDER, len(c)):
                t = tables[u.startswith("http://a")].setdefault(tuple(c[k - n : k]), {})
                t[c[k]] = t.get(c[k], 0) + 1

    def prob(table, before, x):
        below = prob(table, before[1:], x) if before else 1 / url_filter.SIZE
        t = table.get(tuple(before), {})
        total = sum(t.values())
        return (t.get(x, 0) + len(t) * below) / (total + len(t)) if total else below

    for u in (urls[3], urls[250], urls[400], "https://new.example/path"):
        c = fold(u)
        ratios = [math.log(prob(tables[1], c[k - url_filter.ORDER : k], c[k]) / prob(tables[0], c[k - url_filter.ORDER : k], c[k])) for k in range(url_filter.ORDER, len(c))]
        assert model.score(u) == pytest.approx(sum(ratios) / len(ratios), abs=1e-4)


def test_lm_scores_do_not_hang_on_the_layout(spark):
    """The same texts in one partition and in six, null and repeated ids among them."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, "some words"), (None, None), (1, "")], "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = []
    for n in (1, 6):
        df = spark.createDataFrame(rows[::-1] if n == 6 else rows, "doc_id long, text string").repartition(n)
        got = lm_scoring.score(df, common.is_bucket(F.col("doc_id"), 7, 2)).collect()
        assert len(got) == len(rows)
        found.append(sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.score) for r in got))
    for a, b in zip(*found):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) <= 1e-6 * abs(a[4])
