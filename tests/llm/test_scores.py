"""Classifiers and the language model against brute force and on held-out documents."""

import math
import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from corpus_cases import docs, empty, labels, odd, texts  # noqa: F401
from pyspark.sql import functions as F

from shelfprice.llm.language import KernelModel, _grams, identify_languages
from shelfprice.llm.lm_score import code_lengths, fit_contexts, score_documents
from shelfprice.llm.quality_model import QuadraticDiscriminant, score_quality
from shelfprice.llm.quality_rules import Condition, DecisionList, judge, learn_rules, measured

WORD = r"[^\x20\x09-\x0D]+"


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_base_score_equals_brute_force(docs, odd):
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    lower = lambda t: re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    tokens = [(i, [*re.findall(WORD, lower(t)), None]) for i, t in texts(both)]
    counts = Counter(w for i, ws in tokens if fold(i, 10) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), fold(i, 10) == 0, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for i, ws in tokens)
    got = score_documents(both, block_bytes=1 << 16, bucket_bytes=1 << 18).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want


def blended(text, counts):
    """log10 probability of a text, symbol by symbol."""
    framed, total = bytes([255, 255]) + text + bytes([254]), 0.0
    for at in range(2, len(framed)):
        excluded, p = set(), 1.0
        for order in (2, 1, 0):
            context = framed[at - order : at]
            new = {s: n for s, n in counts[order].get(context, {}).items() if s not in excluded}
            if not new:
                continue
            n, kinds = sum(new.values()), len(new)
            if framed[at] in new:
                p *= new[framed[at]] / (n + kinds)
                break
            p *= kinds / (n + kinds)
            excluded |= set(new)
        else:
            p /= 256 - len(excluded)
        total += log10(p)
    return total


def test_context_model_equals_a_plain_one():
    train, test = [b"the cat sat on the mat", b"a cat", b""], [b"the hat", b"zebra", b"", "né".encode()]
    counts, grams = [{}, {}, {}], Counter()
    for t in train:
        f = bytes([255, 255]) + t + bytes([254])
        for at in range(2, len(f)):
            grams[f[at - 2] << 16 | f[at - 1] << 8 | f[at]] += 1
            for order in range(3):
                counts[order].setdefault(f[at - order : at], Counter())[f[at]] += 1
    codes = np.array(sorted(grams))
    row, table = fit_contexts(codes, np.array([grams[c] for c in codes.tolist()]))
    data = np.frombuffer(b"".join(test), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in test]))
    assert np.allclose(code_lengths(data, offsets, row, table), [blended(t, counts) for t in test], atol=1e-4)
    assert np.allclose((10.0 ** table.astype(float)).sum(1), 1, atol=1e-4)


def deeply_blended(text, counts, depth):
    """log10 probability of a text (bytes), symbol by symbol, in contexts of up to ``depth`` bytes."""
    framed, total = bytes([255] * depth) + text + bytes([254]), 0.0
    for at in range(depth, len(framed)):
        excluded, p = set(), 1.0
        for order in range(depth, -1, -1):
            new = {s: n for s, n in counts.get(framed[at - order : at], {}).items() if s not in excluded}
            if not new:
                continue
            n, kinds = sum(new.values()), len(new)
            if framed[at] in new:
                p *= new[framed[at]] / (n + kinds)
                break
            p *= kinds / (n + kinds)
            excluded |= set(new)
        else:
            p /= 256 - len(excluded)
        total += log10(p)
    return total


@pytest.mark.parametrize("depth", [2, 3, 5, 7])
def test_deep_contexts_equal_a_plain_model(spark, docs, odd, depth):
    both = odd.select("doc_id", "text").unionByName(docs.filter("length(text) < 1500").orderBy("doc_id").limit(60).select("doc_id", "text"))
    rows, counts = [(i, (t or "").encode()) for i, t in texts(both)], {}
    for i, t in rows:
        framed = bytes([255] * depth) + t + bytes([254])
        if fold(i, 10):
            for at in range(depth, len(framed)):
                for order in range(depth + 1):
                    counts.setdefault(framed[at - order : at], Counter())[framed[at]] += 1
    want = sorted((str(i), deeply_blended(t, counts, depth)) for i, t in rows)
    got = score_documents(both, depth=depth, block_bytes=1 << 12, bucket_bytes=1 << 14).collect()
    got = sorted((str(r.doc_id), r.score) for r in got)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-5, atol=1e-3)


def test_a_repeated_text_is_likelier_than_a_new_one(spark):
    """What a document holds beyond three bytes counts: its second copy shortens it."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    passages = [" ".join(word() for _ in range(60)) for _ in range(40)]
    ids = [i for i in range(1, 400) if fold(i, 10)]
    copies, train = passages[:20], ids[:20]
    held = [i for i in range(1, 4000) if not fold(i, 10)][:40]
    rows = list(zip(train, copies, strict=True)) + list(zip(held, passages, strict=True))
    got = {r.doc_id: r.score for r in score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    copied, new = [got[i] for i in held[:20]], [got[i] for i in held[20:]]
    assert max(new) < min(copied) and np.mean(new) < 1.5 * np.mean(copied)


def test_held_out_text_is_likelier_than_noise(docs):
    noise = docs.filter("doc_id < 20").select((F.col("doc_id") + 10_000_000).alias("doc_id"), F.sha2("text", 512).alias("text"))
    got = score_documents(docs.select("doc_id", "text").unionByName(noise)).collect()
    per_token = lambda keep: np.mean([r.score / r.n_tokens for r in got if keep(r)])
    assert per_token(lambda r: r.held_out and r.doc_id < 10_000_000) > 2 * per_token(lambda r: r.doc_id >= 10_000_000)


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    marked = [(r.quality, got[r.doc_id]) for r in labels.collect() if fold(r.doc_id, 5) == 0]
    assert all(g.held_out for _, g in marked)
    good, bad = ([g.predicted for q, g in marked if q == k] for k in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_discriminant_recovers_two_normals():
    rng = np.random.default_rng(1)
    x = [rng.normal(0, 1, (4000, 2)) @ np.array([[1, 0.8], [0, 0.4]]), rng.normal(2, 0.5, (4000, 2))]
    model = QuadraticDiscriminant.fit(np.array([4000.0] * 2), np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x]), 0.0, 1e-9)
    density = lambda z, a: -0.5 * (((z - a.mean(0)) @ np.linalg.inv(np.cov(a.T, bias=True))) * (z - a.mean(0))).sum(1) - 0.5 * np.log(np.linalg.det(np.cov(a.T, bias=True)))
    z = rng.normal(1, 1, (50, 2))
    assert np.allclose(model.score(z), 1 / (1 + np.exp(density(z, x[0]) - density(z, x[1]))), atol=1e-6)


def test_odd_documents_get_a_row_each(odd, labels, empty):
    n = odd.count()
    no_labels = labels.limit(0)
    assert score_quality(odd, labels).count() == score_quality(odd, no_labels).count() == n
    assert judge(odd, no_labels).count() == n
    found = {(r.doc_id, r.lang_pred) for r in identify_languages(odd).collect()}
    assert {(900_001, "und"), (900_002, "und"), (900_003, "und"), (900_009, "und")} <= found
    assert score_documents(empty).count() == identify_languages(empty).count() == score_quality(empty, labels).count() == judge(empty, labels).count() == 0


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got if r.held_out]) > 0.99
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)


def statistics(text):
    words = re.findall(WORD, text or "")
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_statistics_equal_brute_force(docs, odd, labels):
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    extra = both.sparkSession.createDataFrame([(7_000_000 + i, t) for i, t in enumerate(["a\nb\na\n", "\n\n", "x\r\nx\r\n", "a a a a", "a b c a b c x", "x|y\n é\né\n é"])], "doc_id long, text string")
    both = both.unionByName(extra)
    want = sorted((str(i), *statistics(t)) for i, t in texts(both))
    got = judge(both, labels).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_reject_what_the_labels_reject(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = judge(docs, labels).join(labels, "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.99
    assert np.mean([r.kept for r in got if r.quality == 0]) < 0.1


@pytest.mark.parametrize("seed", [1, 2])
def test_covering_finds_planted_conjunctions(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.random((3000, 10))
    bad = ((x[:, 0] > 0.7) & (x[:, 3] < 0.4)) | (x[:, 5] > 0.9)
    found = learn_rules(x, bad)
    assert (found.rejects(x) == bad).mean() > 0.97


def test_column_and_array_forms_agree(spark, docs, labels):
    rules = DecisionList([[Condition("symbol_share", True, 0.02), Condition("mark_share", False, 0.05)], [Condition("word_length", True, 5.5)]])
    got = judge(docs, labels).select("*", rules.kept().alias("by_column")).toArrow()
    stats = {n: got[n].to_numpy() for n in got.column_names if n.startswith("n_") or n == "word_chars"}
    assert (~rules.rejects(measured(stats)) == got["by_column"].to_numpy()).all()


def test_language_scores_equal_plain_kernel_ridge():
    """With every text a landmark, the model is kernel ridge regression on the texts' sets of n-grams."""
    rng = np.random.default_rng(4)
    alphabets = ["abcdefgh  ", "efghijkl .", "éèàçab  -"]
    words = lambda a: "".join(rng.choice(list(a), rng.integers(20, 60)))
    train = [(k, words(a)) for k, a in enumerate(alphabets) for _ in range(12)]
    tests = [words(a) for a in alphabets for _ in range(5)] + ["", "zzz"]

    def grams(text):
        c = [1 + (b | 32) - 97 if chr(b).isascii() and chr(b).isalpha() else 27 + (b - 128) % 37 if b > 127 else 0 for b in text.encode()]
        return {tuple(c[i : i + n]) for n in (1, 2, 3) for i in range(len(c) - n + 1) if any(c[i : i + n])}

    def kernel(a, b):
        return len(a & b) / math.sqrt(max(len(a), 1) * max(len(b), 1))

    sets, label = [grams(t) for _, t in train], np.array([k for k, _ in train])
    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    y, ridge = np.where(label[:, None] == np.arange(3), 1.0, -1.0), 0.05
    dual = np.linalg.solve(gram + ridge * np.diag(np.bincount(label)[label].astype(float)), y)
    known = set().union(*sets)  # n-grams of no landmark do not count in a text's number either
    want = np.array([[kernel(grams(t) & known, b) for b in sets] for t in tests]) @ dual

    encode = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    model = KernelModel.fit(["a", "b", "c"], label, [np.unique(_grams(*encode(t))[1]) for _, t in train], 12, ridge)
    got = np.concatenate([model.scores(*encode(t)) for t in tests])
    assert np.abs(got - want).max() < 2e-3
