"""PII spans, embedding whitening and importance resampling against brute
force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from metroframe.llm import pii, queries, resample, whitening

# ---- PII

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = [int(c) for c in match if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_brute(text):
    found = [(m.start(), pii.KINDS.index(kind), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(kind, m.group())]
    return sorted(found)


def test_detectors_equal_the_plain_patterns():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", "@", ".", "..", "-", "_", "+", "1", "12", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "4111-1111", " ", "  ", "(", ")", "é", "\n", "00",
             "+1 (988) 555-2485", "x@y.org", "378282246310005", "1.2.3.4.5.6.7.8", "+4.4.4", "%", "٣"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        assert pii.detect(text) == base_brute(text), text


DISGUISES = [
    ("mail joe [at] example [dot] com now", "email", "joe [at] example [dot] com"),
    ("joe.b at mail dot example dot com", "email", "joe.b at mail dot example dot com"),
    ("joe(at)ex.com, thanks", "email", "joe(at)ex.com"),
    ("joe @ example.com", "email", "joe @ example.com"),
    ("x ј​oe＠ехample.com y", "email", "ј​oe＠ехample.com"),
    ("call plus one nine eight eight five five five two four eight five!", "phone", "plus one nine eight eight five five five two four eight five"),
    ("+４４ 2０7 946 0958", "phone", "+４４ 2０7 946 0958"),
    ("ip 192[.]168(dot)1[.]1 x", "ip", "192[.]168(dot)1[.]1"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("four-one-one-one one one one one 1111 one one one one", "card", "four-one-one-one one one one one 1111 one one one one"),
    ("card 4111 11l1 1111 1111", "card", "4111 11l1 1111 1111"),
    ("vier eins eins eins, 1111 1111 1111", "card", "vier eins eins eins, 1111 1111 1111"),
]
PLAIN = ["look at the dot product", "one two three", "un un un un un un un un un un un un un un un un", "we met at noon dot", "a (dot) b", "x at y.com", "почта и слово", "price 3O0 l1",
         "two plus three plus four five six", "İ" * 50]


def test_disguises():
    folded = pii.PlainCharacters()
    for text, kind, span in DISGUISES:
        for before, after in (("", ""), ("é​ ", " tail"), ("a@b.org # ", "; 10.0.0.1")):
            whole = before + text + after
            base = pii.detect(whole)
            got = [(pii.KINDS[k], whole[s:e]) for s, k, e in pii.disguised(whole, base, folded)]
            assert (kind, span) in got and len(got) == 1, (whole, got)
    for text in PLAIN:
        assert pii.detect(text) == [] and pii.disguised(text, [], folded) == [], text


def test_edits_lead_back():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("abcdef") for _ in range(30))
        cuts = sorted(rng.sample(range(31), 6))
        edits = [(a, b, rng.choice(["", "X", "YZ"])) for a, b in zip(cuts[::2], cuts[1::2])]
        r = pii.Rewritten(text, edits)
        for place, c in enumerate(r.text):
            start, end = r.source(place)
            assert (text[start:end] == c) if c.islower() else (start, end) in [(a, b) for a, b, _ in edits]


@pytest.mark.parametrize("text", ["1" * 1_000_000, "a" * 1_000_000, "a." * 500_000, "+1(" * 300_000, "one " * 200_000, "a@" * 500_000, "é​" * 500_000])
def test_long_runs_take_little_time(text):
    assert pii.disguised(text, pii.detect(text), pii.PlainCharacters()) == []


def test_pii_query_and_edge_cases(spark, sf_small, tmp_path):
    def check(folder, rows):
        got = queries.op11_pii_spans(spark, folder).collect()
        assert len(got) == len(rows)
        want = Counter()
        for doc, text in rows:
            base = base_brute(text)
            text_of = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
            want[doc, *(sum(k == i for _, k, _ in base) for i in range(4)), hashlib.sha256(text_of.encode()).hexdigest()] += 1
            assert not base or text_of in [r.spans for r in got if r.doc_id == doc] or any(set(text_of.split(",")) < set(r.spans.split(",")) for r in got if r.doc_id == doc)
        assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
        return got

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    found = check(sf_small, docs)
    assert sum(r.n_email > 0 for r in found) > 0 and sum(r.n_phone > 0 for r in found) > 0
    odd = [(1, None), (2, ""), (3, "a@b.org \U0001F600 10.0.0.1"), (3, "a@b.org \U0001F600 10.0.0.1"), (None, DISGUISES[0][0]), (4, "w " * 300_000 + "x@y.org")]
    df = spark.createDataFrame([(*r, "k", 1) for r in odd], "doc_id long, text string, kind string, spans int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in check(str(tmp_path), odd)}
    assert rows[None].spans == "email:5:31" and rows[None].n_email == 0 and rows[3].spans == "email:0:7,ip:10:18" and rows[1].spans == ""
    assert pii.scan(df.limit(0)).count() == 0


# ---- whitening

def check_whitening(rows, vectors, components=32):
    """``rows`` of the operator against numpy; ``vectors`` are (id, floats)."""
    x = np.floor(64 * np.array([v for _, v in vectors], np.float64)).astype(np.int64) + 1_000_000
    n = len(x)
    moved = n * x - x.sum(0)
    c = moved / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(components, int((values > whitening.FLAT * values[0]).sum()))
    assert len(rows) == n and all(r.n == n and len(r.whitened) == k for r in rows)
    assert Counter((r.vec_id, r.deviation) for r in rows) == Counter((i, int((m * m).sum())) for (i, _), m in zip(vectors, moved))
    assert np.allclose(rows[0].explained, values[:k] / values.sum(), rtol=1e-9) and all(r.identity_error <= 1e-9 for r in rows)
    got = np.array([r.whitened for r in rows])
    assert np.abs(got.T @ got / n - np.eye(k)).max() < 1e-9
    by_id = {i: p for (i, _), p in zip(vectors, c @ basis[:, :k] / np.sqrt(values[:k]))}
    want = np.array([by_id[r.vec_id] for r in rows])
    sign = np.sign((got * want).sum(0))
    gaps = np.minimum(np.abs(np.diff(values[:k + 1], append=0)[:k]), np.abs(np.diff(values[:k], prepend=np.inf))) / values[0]
    apart = gaps > 1e-6
    assert np.abs(got - want * sign)[:, apart].max() < 1e-6 and apart.any()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 6)) * [5, 4, 3, 2, 1, 0])]  # the last dimension is constant
    extra = [(100, None), (101, [1.0, None, 0, 0, 0, 0]), (102, [float("nan")] * 6), (103, [float("inf")] * 6), (104, [1.0]), (105, [])]
    vectors += [(7, vectors[7][1]), (None, vectors[3][1])]
    df = spark.createDataFrame([(i, v and [None if e is None else float(e) for e in v], 0.0, 1) for i, v in vectors + extra],
                               "vec_id long, embedding array<double>, whitened double, n int").repartition(5)
    rows = whitening.whiten(df, block_rows=7, blocks_a_task=2).collect()
    check_whitening(rows, vectors)
    check_whitening(whitening.whiten(df, components=2).collect(), vectors, 2)
    one = whitening.whiten(df.where("vec_id = 5")).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.identity_error) for r in one] == [(5, 1, 0, [], None)]
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id >= 100 and vec_id <> 104")).count() == 0


def test_whitening_query(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in table.collect() if r.embedding and all(e is not None and math.isfinite(e) for e in r.embedding)]
    flat = queries.op12_embedding_whitening(spark, sf_small)
    assert flat.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and flat.schema["component"].dataType.simpleString() == "int"
    rows = flat.groupBy("vec_id", "n", "deviation", "identity_error").agg(F.array_sort(F.collect_list(F.struct("component", "whitened", "explained"))).alias("c"))
    rows = rows.select("vec_id", "n", "deviation", "identity_error", "c.whitened", "c.explained", "c.component").collect()
    check_whitening(rows, vectors)
    assert all(r.component == list(range(1, 33)) for r in rows)


# ---- importance resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_and_features(text, buckets=10_000, most=2):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def resample_brute(docs, target, least=20, percent=25):
    known = [words_and_features(t) for _, t in docs]
    s, t = Counter(b for _, f in known for b in f), Counter(b for x in target for b in words_and_features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))
    rows = []
    for (doc, text), (n, f) in zip(docs, known):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, text, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted({(-r[5], r[0] is None, r[0] or 0, r[1]) for r in rows if r[2] >= least})
    rank = {(a[2], a[3]): i + 1 for i, a in enumerate(able[:percent * len(able) // 100])}
    return Counter((r[0], r[3], r[4], r[5], rank.get((r[0] or 0, r[1]))) for r in rows)


def test_buckets_equal_plain_crcs(monkeypatch):
    rng = random.Random(4)
    texts = ["", "a", "Hello World é b2 -- c", "x" * 5000 + " y " + "z" * 513 + " " + "q" * 512 + " " + "r" * 1024 + " s", "one  two\nTHREE", "\0\0", "a a a a a", "K KK É"]
    texts += [" ".join(rng.choice(["foo", "bar", "Bäz", "q1", "w" * k]) for k in range(1, 60)) for _ in range(30)]
    for most in (1, 2, 3):
        find = resample.Features(10_000, most)
        for text, (n, found) in zip(texts, find.batch([t.encode() for t in texts])):
            assert (n, sorted(np.frombuffer(found, find.dtype))) == (lambda w, f: (w, sorted(f)))(*words_and_features(text, 10_000, most))
        monkeypatch.setattr(resample, "SEGMENT", 100)  # long texts go in segments
        for text in texts:
            n, parts = find.long(text.encode())
            assert (n, sorted(b for p in parts for b in p.tolist())) == (lambda w, f: (w, sorted(f)))(*words_and_features(text, 10_000, most))
        monkeypatch.undo()


def test_resampling_equals_brute_force(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("the of Und die le la x y z q w e r".split()) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (5, docs[5][1]), (5, docs[5][1]), (None, docs[7][1] + " the of" * 10), (1002, "z " * 300_000), (6, "other text " * 15)]
    target = ["the of the of", "The OF x", None, ""]
    df = spark.createDataFrame([(*d, 1, "r") for d in docs], "doc_id long, text string, score int, rank string").repartition(4)
    aims = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    got = resample.resample(df, aims).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, got)) == resample_brute(docs, target)
    assert Counter(map(tuple, resample.resample(df, aims.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect())) == resample_brute(docs, [])
    assert resample.resample(df.limit(0), aims).count() == 0


def test_resampling_query(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    got = queries.op13_importance_resampling(spark, sf_small)
    assert all(f.dataType.simpleString() == "bigint" for f in got.schema)
    assert Counter(map(tuple, got.collect())) == resample_brute(docs, target)
