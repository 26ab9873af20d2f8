"""Personal data, decontamination, packing, the similarity join and the pipeline against brute force."""

import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from corpus_cases import docs, empty, odd, rows, SF, texts  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from shelfprice.llm.decontaminate import best_match, find_items, normalised, original_places, pieces, without_items
from shelfprice.llm.jaccard_join import _pairs_left, _shingles, _signatures, components, first_of_each, least_matches, lost_at, pruning_rule, ROWS, similar_documents
from shelfprice.llm.packing import best_fit, pack
from shelfprice.llm.pii import find_personal_data, redact, report
from shelfprice.llm.queries import tokenizer

# Personal data: the contract's own patterns (fixed values).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRICKY = [
    "a@b a@b@c.d x@y.z_q@r.s .@a.b.c. é@ü.de me@a.b%c@d.e",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.001 1.2.3 4.5.6.7 00000300.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111111111111 1 4111111111111111 6304000000000000000 41111111111111111111",
    "+1 (234) 567-8901 +12 +1234567 +12345678 +123456789012345 +1234567890123456 +1 ( ) . - 2345678 x +1.2.3.4567.89",
    "🙂é 4111 1111 1111 1111é a@b.c🙂+1 (234) 567-8901",
    "+4111 1111 1111 1111 a@1.2.3.4",
]


def expected_spans(text):
    def fine(kind, v):
        d = re.sub("[^0-9]", "", v)
        if kind == "ip":
            return all(int(x) <= 255 for x in v.split("."))
        if kind == "card":
            total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
            return 16 <= len(d) <= 19 and total % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if fine(k, m.group())]


def test_base_spans_equal_the_plain_patterns(spark, docs, odd):
    rng = np.random.default_rng(7)
    alphabet = np.array(list("0123456789 -+.()@ab_%é\n"))
    noise = ["".join(rng.choice(alphabet, 80, p=[0.05] * 10 + [0.5 / 13] * 13)) for _ in range(3000)]
    data = [(10_000_000 + i, t) for i, t in enumerate([*TRICKY, *noise])]
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(spark.createDataFrame(data, "doc_id long, text string"))
    got = defaultdict(list)
    for r in report(both).collect():
        got[r.doc_id].append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
    want = defaultdict(list)
    for i, t in texts(both):
        s = expected_spans(t)
        want[i].append((*(sum(k == x[0] for x in s) for k in PATTERNS), sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest()))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}


def test_words_that_disclose_an_entity(spark):
    data = [(i, f"note {i} filler{i} widgetmaster writes from w@acme.org about item{i} today") for i in range(6)]
    data += [(100 + i, f"plain text number {i} about other things of today and item{i}") for i in range(60)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    found = {r.doc_id: {(s.kind, s.value) for s in r.spans} for r in find_personal_data(frame).collect()}
    assert ("term", "widgetmaster") in found[0] and ("term", "about") not in found[0] and not found[101]
    clean = dict(texts(redact(frame)))
    assert "widgetmaster" not in clean[0] and "<EMAIL>" in clean[0] and "acme" not in clean[0]
    assert clean[101] == dict(data)[101]


def terms_of(frame):
    return {r.doc_id: [(s.value, s.start) for s in r.spans if s.kind == "term"] for r in find_personal_data(frame).collect()}


def test_copies_and_shared_lines_hide_no_word(spark):
    body = [f"widgetmaster w@acme.org part{i}" for i in range(4)]
    data = [(100 * i + k, t) for i, t in enumerate(body) for k in range(50)]
    data += [(1000 + i, f"signed by gatekeeper at all@corp.org number{i}") for i in range(100)]
    data += [(2000 + i, f"plain text number{i} about other things") for i in range(300)]
    data += [(3000 + k, "a copied singleton beside x@y.org") for k in range(50)]
    got = terms_of(spark.createDataFrame(data, "doc_id long, text string"))
    assert all(("widgetmaster", 0) in got[i] for i in (0, 149, 349)) and all(("gatekeeper", 10) in got[1000 + i] for i in range(100))
    assert not got[3000] and not got[2000]  # copies of one text prove nothing


def test_words_far_from_the_entity_are_found_everywhere(spark):
    gap = " and so it went on for a long while"
    data = [(i, f"Widgetmaster İx{gap * 4} note{i} w@acme.org {gap * 3} by WIDGETMASTER, not xwidgetmaster{i}") for i in range(8)]
    data += [(100 + i, f"plain{gap} item{i}") for i in range(100)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    got, text = terms_of(frame), dict(data)
    assert [(w, text[3][a : a + 12]) for w, a in got[3] if w == "widgetmaster"] == [("widgetmaster", "Widgetmaster"), ("widgetmaster", "WIDGETMASTER")]
    clean = dict(texts(redact(frame)))
    assert "widgetmaster " not in clean[3].lower() and "WIDGETMASTER" not in clean[3] and "xwidgetmaster3" in clean[3] and "while" in clean[3]


def disclosed(data, alpha=0.95, discount=2 / 3):
    """Spans of disclosing words, from the rule on all pairs of values and words of the distinct texts."""
    canonical = lambda k, v: k + ":" + (v.lower() if k == "email" else v if k == "ip" else re.sub("[^0-9]", "", v))
    texts_of = {t or "" for _, t in data}
    values = {t: {canonical(k, t[a:b]) for k, a, b in expected_spans(t)} for t in texts_of}
    words = {t: {w.lower() for w in re.findall(r"\w{3,}", t)} for t in texts_of}
    n = len(texts_of)
    told = set()
    for v in set().union(*values.values()):
        held = [t for t in texts_of if v in values[t]]
        least = (len(held) / n) ** (1 - alpha)
        for w in set().union(*(words[t] for t in held)):
            if (sum(w in words[t] for t in held) - discount) / sum(w in words[t] for t in texts_of) >= least:
                told.add((v, w))
    out = {}
    for i, t in data:
        t = t or ""
        spans = expected_spans(t)
        mine = {w for v, w in told if v in values[t]}
        out[i] = [(m.group().lower(), m.start()) for m in re.finditer(r"\w{3,}", t) if m.group().lower() in mine and not any(a <= m.end() and m.start() <= b for _, a, b in spans)]
    return out


def test_disclosing_words_equal_the_rule_on_all_pairs(spark):
    rng = np.random.default_rng(11)
    names = [f"name{i}" for i in range(12)]
    filler = [f"word{i}" for i in range(60)]
    data = []
    for i in range(400):
        parts = list(rng.choice(filler, 12))
        if i % 3 == 0:
            who = int(rng.integers(0, 8))
            parts += [f"{names[who]}@x{who}.org", names[who].title() if rng.random() < 0.9 else "Nobody", "office", f"{names[who]}."]
        if i % 11 == 0:
            parts += ["10.0.0.7", "serverroom", "+1 234 567 8901"]
        rng.shuffle(parts)
        data.append((i, " ".join(parts)))
    data += [(1000 + i, data[i][1]) for i in range(0, 60, 3)] + [(2000, None), (2001, "")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    want = disclosed(data)
    assert sum(map(len, want.values())) > 100
    assert terms_of(frame) == want


def test_work_is_linear_in_a_text(spark):
    """32,000 addresses in one text, and a line of contact with its own vocabulary in a third of all texts."""
    import time

    log = "\n".join(f"10.{i >> 8 & 255}.{i & 255}.7 ok user{i}" for i in range(32_000))
    data = [(1, log), (2, "nothing")] + [(10 + i, f"mail desk@corp.org for unique{i} special{i * 7} " + " ".join(f"only{i}x{j}" for j in range(30))) for i in range(600)]
    data += [(1000 + i, f"plain text {i}") for i in range(1200)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r for r in report(frame).collect()}
    assert got[1].n_ip == 32_000 and got[10].n_email == 1 and got[1000].spans == ""
    clean = dict(texts(redact(frame)))
    assert clean[1].startswith("<IP> ok") and clean[1].count("<IP>") == 32_000 and "10." not in clean[1]
    assert time.time() - start < 240


def test_redacted_documents(docs, odd, empty):
    for frame in (docs, odd):
        got = redact(frame)
        assert got.columns == frame.columns and got.count() == frame.count()
        assert not [t for _, t in texts(got) if expected_spans(t)]
    untouched = [x for x in texts(docs) if not expected_spans(x[1])]
    assert set(untouched) <= set(texts(redact(docs)))
    assert report(empty).count() == redact(empty).count() == 0


def edit_distance(a, b):
    """Of a to the nearest string in b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_bit_parallel_distance():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(1, n))) for n in (12, 30))
        d, start, end = best_match(a, b)
        assert d == edit_distance(a, b)
        assert d == len(a) or d >= 0 and edit_distance(b[start:end], a) <= d


def test_pieces_cover_the_item():
    assert "".join(p for _, p in pieces("abcdefghij", 2)) == "abcdefghij" and len(pieces("abcdefghij", 2)) == 3


def test_items_with_edits_are_found(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("etaoinshr"), rng.integers(2, 9)))
    items = [(i, " ".join(word() for _ in range(rng.integers(15, 25)))) for i in range(8)]
    documents, planted = [], {}
    for i in range(48):
        body = [word() for _ in range(rng.integers(0, 50))]
        if i % 3 == 0:
            item, text = items[i % 8]
            chars, edits = list(text.upper() if i % 8 else text), rng.integers(0, int(len(text) * 0.05) + 1)
            for _ in range(edits):
                at = rng.integers(0, len(chars))
                chars[at : at + rng.integers(0, 2)] = ["q"] * rng.integers(0, 2)
            body.insert(rng.integers(0, len(body) + 1), "".join(chars).replace(" ", " \n"))
            planted[i] = item
        documents.append((i, " ".join(body)))
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = find_items(docs, table, block_bytes=400).collect()
    brute = {(i, j) for i, t in documents for j, x in items if edit_distance(normalised(x), normalised(t)) <= int(len(normalised(x)) * 0.05)}
    assert {(r.doc_id, r.item_id) for r in got} == brute and set(planted.items()) <= brute
    for r in got:
        assert r.distance == edit_distance(normalised(items[r.item_id][1]), normalised(documents[r.doc_id][1]))
        assert edit_distance(normalised(items[r.item_id][1]), normalised(documents[r.doc_id][1][r.start : r.end])) == r.distance
    assert {i for i, _ in texts(without_items(docs, table))} == {i for i, _ in documents} - {i for i, _ in brute}


def test_places_in_the_text():
    text = "  Two İ  Words\n"
    n = normalised(text)
    assert len(original_places(text)) == len(n) and text[original_places(text)[n.index("words")]] == "W"


def test_odd_items(spark, odd, empty):
    table = spark.createDataFrame([(1, None), (2, ""), (None, "a text whose id is missing a text whose id"), (3, "éx" * 30)], "item_id long, text string")
    got = find_items(odd, table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(None, None)} and len(got) == 2
    assert find_items(empty, table).count() == find_items(odd, table.limit(0)).count() == 0
    assert without_items(odd, table).columns == odd.columns


def test_packed_sequences(docs, odd, empty):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer())
    special = [(910_001, "hello <|endoftext|> world<|startoftext|>x"), (910_002, "<|ENDOFTEXT|> <|endoftext|"), (910_003, "<|endoftext|>" * 5_000)]
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(docs.sparkSession.createDataFrame(special, "doc_id long, text string"))
    ids = defaultdict(list)
    for i, t in texts(both):
        ids[i].append([*encode.encode(t or "", add_special_tokens=False).ids, 2])
    got = pack(both, tokenizer(), known_words=5_000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for i, pieces_of in by_doc.items():
        want = sorted((s, len(x[s : s + 4096]), zlib.crc32(np.array(x[s : s + 4096], "<u4").tobytes()), len(x)) for x in ids[i] for s in range(0, len(x), 4096))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces_of) == want
    for held in by_sequence.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:], strict=False)) and sum(held[-1]) <= 4096
    total = sum(r.length for r in got)
    assert len(by_sequence) <= -(-total // 4096) * 1.03 + 2
    assert pack(empty, tokenizer()).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(2)
    lengths = sorted(rng.integers(1, 65, 500).tolist(), reverse=True)
    names, offsets = best_fit(lengths, 64)
    rooms, want = [], []
    for n in lengths:
        fitting = [(room, -k) for k, room in enumerate(rooms) if room >= n]
        if fitting:
            k = -min(fitting)[1]
        else:
            rooms.append(64)
            k = len(rooms) - 1
        want.append(rooms[k])
        rooms[k] -= n
    assert [64 - o for o in offsets] == want and max(names) + 1 == len(rooms)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_groups(data):
    """By row: (id, class, copies, links)."""
    sets = [shingles(t) for _, t in data]
    distinct = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    holders = defaultdict(list)
    for k, s in enumerate(distinct):
        for g in s:
            holders[g].append(k)
    root, links = list(range(len(distinct))), [0] * len(distinct)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(distinct):
        common = defaultdict(int)
        for g in s:
            for o in holders[g]:
                common[o] += o > k
        for o, n in common.items():
            if n and n >= 0.8 * (len(s) + len(distinct[o]) - n) - 1e-9:
                links[k] += 1
                links[o] += 1
                root[find(o)] = find(k)
    place = {s: k for k, s in enumerate(distinct)}
    members = defaultdict(list)
    for (i, _), s in zip(data, sets, strict=True):
        if s and i is not None:
            members[find(place[s])].append(i)
    out = []
    for (i, _), s in zip(data, sets, strict=True):
        out.append((i, min(members[find(place[s])], default=None), sets.count(s), links[place[s]]) if s else (i, i, 1, 0))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def near(spark):
    """Two groups of near copies whose members differ from each other to different degrees, exact copies and others."""
    rng = np.random.default_rng(11)
    base = [[f"w{x}" for x in rng.integers(0, 400, 120)] for _ in range(2)]
    data = []
    for i in range(160):
        words = list(base[i % 2])
        for at in rng.integers(0, len(words), rng.integers(0, 5)):
            words[at] = f"v{rng.integers(0, 30)}"
        data.append((i, " ".join(words)))
    data += [(1000 + i, " ".join(f"u{x}" for x in rng.integers(0, 5000, 60))) for i in range(60)]
    return spark.createDataFrame(data, "doc_id long, text string")


@pytest.mark.parametrize("chunk", [16, 512])
def test_groups_equal_brute_force(near, docs, odd, chunk):
    for frame in (near, docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))):
        got = similar_documents(frame, chunk=chunk, group=300).select("doc_id", "class_id", "n_copies", "n_links")
        assert rows(got) == brute_groups(texts(frame))


def test_pruning_keeps_pairs_over_the_threshold():
    least = least_matches(112, 0.8, 1e-6)
    assert least[0] == 0 and 60 < least[112] < 80
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**32, (300, 112), dtype=np.uint32)
    b = np.where(rng.random((300, 112)) < 0.8, a, a + 1)
    x, y = _pairs_left(a, b, least)
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == {(i, i) for i in range(300)}


@pytest.mark.parametrize(("common", "union", "pairs"), [(4, 5, 20_000), (9, 10, 20_000), (40, 50, 8_000), (45, 50, 8_000), (160, 200, 2_000)])
def test_bands_and_pruning_keep_similar_texts(common, union, pairs):
    import pyarrow as pa

    assert lost_at(0.8, least_matches(112, 0.8, 1e-6)) > 1e-6 >= lost_at(0.8, pruning_rule(112, 0.8, 1e-6))
    least = np.array(pruning_rule(112, 0.8, 1e-6))[16::16]
    words = [[f"t{i}w{j}" for j in range(union + 4)] for i in range(pairs)]
    short, long = (_signatures(list(_shingles(pa.array([" ".join(w[:n]) for w in words]), 5)), 112) for n in (common + 4, union + 4))
    same = short == long
    assert abs(same.mean() - common / union) < 0.01
    met = same.reshape(pairs, -1, ROWS).all(2).any(1)
    left = (np.cumsum(same, 1)[:, 15::16] >= least).all(1)
    assert (~(met & left)).sum() <= 1  # expected: 0.03 at most


def test_components_of_a_chain(spark):
    nodes = [bytes([i]) for i in range(40)]
    edges = spark.createDataFrame([*zip(nodes, nodes[1:], strict=False), (b"\xf0", b"\xf1"), (b"\xf5", b"\xf5")], "node binary, root binary")
    got = {bytes(r.node): bytes(r.label) for r in components(edges).collect()}
    assert got == {**dict.fromkeys(nodes, nodes[0]), b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


def test_one_of_each_group_stays(near, odd, empty):
    for frame in (near, odd):
        kept, data = first_of_each(frame), texts(frame)
        assert kept.columns == frame.columns
        groups = {str(c) for (i, c, _, _) in brute_groups([x for x in data if shingles(x[1])])}
        wordless = {x for x in data if not shingles(x[1])}
        assert kept.count() == len(groups) + len(wordless)
    assert first_of_each(empty).count() == similar_documents(empty).count() == 0


def test_stages_of_the_pipeline(spark, docs):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        assert {i for i, _ in texts(kept)} <= {i for i, _ in texts(before)}, name
    final = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in final.collect()} == {i for i, _ in texts(kept)}
    assert final.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).filter("n != m").count() == 0


def test_one_of_each_tells_nulls_from_texts(spark):
    data = [(5, "abc def"), (None, "5:abc def"), (5, None), (None, "5"), (None, None), (None, "n"), (5, "n"), (None, "n:tn")]
    kept = first_of_each(spark.createDataFrame(data, "doc_id long, text string"))
    assert sorted(texts(kept), key=str) == sorted(data[:-3] + [(5, "n"), data[-1]], key=str)


@pytest.mark.parametrize("n", [60, 300])
def test_groups_of_near_copies_have_few_homes(spark, n):
    """Near copies share many buckets; what is joined grows with them, not with their square."""
    from shelfprice.llm import jaccard_join

    words = [f"v{i * 31 % 997}" for i in range(240)]
    data = [(i, " ".join(w if j != i % 240 else f"x{i}" for j, w in enumerate(words))) for i in range(n)]
    data += [(10_000 + i, " ".join(f"y{i}z{j}" for j in range(50))) for i in range(40)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    seen = []
    whole = jaccard_join._folded
    try:
        jaccard_join._folded = lambda homes: seen.append(whole(homes)) or seen[-1]
        got = rows(similar_documents(frame, chunk=16).select("doc_id", "class_id", "n_links"))
    finally:
        jaccard_join._folded = whole
    assert seen[0].select("home").distinct().count() <= 3
    assert {r for r in got if r[0] < 10_000} == {(i, 0, n - 1) for i in range(n)}
    assert {r for r in got if r[0] >= 10_000} == {(10_000 + i, 10_000 + i, 0) for i in range(40)}


def test_small_layers_are_few_files(spark, tmp_path):
    """The number of files follows from the rows, not from the partitions of a shuffle."""
    from pathlib import Path

    from shelfprice.llm.pii import redact
    from shelfprice.sources import staging

    words = [f"v{i * 31 % 997}" for i in range(240)]
    data = [(i, " ".join(w if j != i else f"x{i}" for j, w in enumerate(words))) for i in range(60)]
    data += [(100 + i, " ".join(f"y{i}z{j}" for j in range(50))) for i in range(40)]
    data += [(200 + i, f"zebra{i % 4} wrote q{i} to mail{i % 4}@example.com") for i in range(40)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    since = len(staging._written)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        first_of_each(frame).write.parquet(f"{tmp_path}/first")
        redact(frame).write.parquet(f"{tmp_path}/redact")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {}
    for path in [*staging._written[since:], f"{tmp_path}/first-", f"{tmp_path}/redact-"]:
        label = Path(path).name.rsplit("-", 1)[0]
        files[label] = max(files.get(label, 0), len(list(Path(path.removesuffix("-")).glob("*.parquet"))))
    small = {"classes", "shares", "folded", "members", "tiles", "edges", "labels", "pii-entities", "pii-holders", "pii-beside", "pii-told", "first", "redact"}
    assert {label: files[label] for label in small} == dict.fromkeys(small, 1)
    assert spark.read.parquet(f"{tmp_path}/first").count() == 1 + 40 + 40
    got = dict(texts(spark.read.parquet(f"{tmp_path}/redact")))
    assert sorted(got) == [i for i, _ in data] and all(got[i] == t for i, t in data if i < 200)
    assert all("<EMAIL>" in got[i] and "example" not in got[i] for i, _ in data if i >= 200)
