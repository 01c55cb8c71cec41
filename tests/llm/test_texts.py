"""Packing, line dedup, classifier, BPE, URL filter, WARC bundles and license
scan: brute force, exact round trips, held-out accuracy and edge cases."""

import hashlib
import io
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from metroframe.llm import bpe, licenses, packing, quality, queries, simhash, substring, urlfilter, warc

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def texts_of(spark, sf, table="documents"):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/{table}.parquet").collect()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_oracle(spark, con, sf_small, name):
    got = queries.queries()[name](spark, sf_small)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    rows = [tuple(r[c] for c in rel.columns) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(rel.fetchall(), key=str)


# ---- packing

ODD = [(1, "a"), (2, ""), (2, ""), (None, None), (3, "x y z " * 4000), (4, "héllo <|endoftext|> \x00"), (5, "b" * 3000)]


def check_packing(rows, docs, capacity, encode, end_id):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    want = Counter()
    for doc, text in docs:
        ids = np.array([*encode(text or ""), end_id], "<u4")
        want[doc, len(ids)] += 1
        at = 0
        parts = sorted(set(by_doc[doc, len(ids)]))
        for start, length, crc in (p for p in parts):
            if start == at and zlib.crc32(ids[start:start + length].tobytes()) == crc:
                at += length
        assert at == len(ids)
    assert sum(r.length for r in rows) == sum(n * k for (_, n), k in want.items())
    return by_sequence


def test_packing_edge_cases(spark):
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in ODD], "doc_id long, text string, offset int, sequence_id string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec = Tokenizer.from_file(path)
    encode = lambda t: codec.encode(t, add_special_tokens=False).ids
    for capacity in (2048, 64):
        rows = packing.pack(df, path, capacity=capacity).collect()
        check_packing(rows, ODD, capacity, encode, 1)
    assert packing.pack(df.limit(0), path).count() == 0


LONG_RUNS = [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "abc1é!" * 300_000, "x" + " " * 1_200_000 + "<|endoftext|>y"]


def test_packing_of_very_long_runs(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec = Tokenizer.from_file(path)
    docs = list(enumerate(LONG_RUNS))
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), path).collect()
    check_packing(rows, docs, 2048, lambda t: codec.encode(t, add_special_tokens=False).ids, 1)
    ranks = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))  # no added tokens in a rank file
    assert all(list(ranks(t)) == codec.encode(t, add_special_tokens=False).ids for t in LONG_RUNS[:4])


def test_packing_query(spark, sf_small):
    codec = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = texts_of(spark, sf_small)
    rows = queries.op1_harmonic_packing(spark, sf_small).collect()
    sequences = check_packing(rows, docs, 2048, lambda t: codec.encode(t, add_special_tokens=False).ids, 1)
    assert sum(r.length for r in rows) / (2048 * len(sequences)) > 0.97


ADDED = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a  <|endoftext|>  b\n<|endoftext|>", "<|endoftext|", "é🙂 \x00<|endoftext|>'s"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_packing_matches_added_tokens(spark, name):
    path = public_tokenizers.path(name)
    codec = Tokenizer.from_file(path)
    ids = packing.encoder(path)
    texts = [*ADDED, *(t or "" for _, t in ODD), *(t or "" for _, t in texts_of(spark, "/root/testdata/sf0.001"))]
    assert [list(ids(t)) for t in texts] == [codec.encode(t, add_special_tokens=False).ids for t in texts]
    docs = list(enumerate(ADDED))
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), path).collect()
    check_packing(rows, docs, 2048, lambda t: codec.encode(t, add_special_tokens=False).ids, 1)


def test_packing_query_matches_added_tokens(spark, tmp_path):
    docs = list(enumerate(ADDED))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    codec = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.op1_harmonic_packing(spark, str(tmp_path)).collect()
    check_packing(rows, docs, 2048, lambda t: codec.encode(t, add_special_tokens=False).ids, 1)


def test_cut_fills_classes():
    for length in range(0, 5000):
        parts = packing.cut(length)
        assert sum(p for p, _ in parts) == length
        assert all(p * k <= 2048 and p * k >= (1 - packing.SLACK) * 2048 - k * 2 for p, k in parts)
        assert len(parts) <= length // 2048 + 5


def test_first_fit():
    lengths = np.array([5, 3, 8, 2, 2, 7])
    bins, offsets = packing.first_fit(lengths, 10)
    for b in set(bins):
        parts = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 10


# ---- passage dedup

LINES = [(2, "one two three. Four  five!\nkeep me\nOne\ttwo three.\t four FIVE!\r"), (1, "zero\none two three. x.y four five!"), (3, None), (4, ""), (None, "one two three."),
         (1, "zero\none two three. x.y four five!"), (5, "\n\n\n"), (6, "a b c d\n\n\n  a b c d\nb"), (7, "é two three four five\n\nÉ two three four five"), (8, "w " * 50000),
         (9, "b?! ... !!!\n!!!"), (10, "b?! ...  !!! tail"), (11, " b?! \x1c b?!"), (12, "zero\nkeep me one two three. zero")]


def units_brute(text):
    """(start, end, words) of each sentence, word by word."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        held = []
        for m in re.finditer(r"[^ \t\r\f\v]+", line):
            held.append((at + m.start(), at + m.end(), "".join(c.lower() if c.isascii() else c for c in m.group())))
            if m.group()[-1] in ".!?":
                out.append(held)
                held = []
        out += [held] if held else []
        at += len(line) + 1
    return [(u[0][0], u[-1][1], [w for _, _, w in u]) for u in out]


def spans_brute(rows, span_words=substring.SPAN_WORDS):
    found, units = {}, {}
    for doc, text in set(rows):
        units[doc, text] = units_brute(text)
        for n, (start, end, words) in enumerate(units[doc, text]):
            found.setdefault(" ".join(words), []).append((doc is None, doc or 0, start, text))
    first = {norm: min(places)[:3] for norm, places in found.items()}
    out = set()
    for (doc, text), own in units.items():
        run = []
        for unit in [*own, None]:
            kept = unit and first[" ".join(unit[2])]
            if unit and kept != (doc is None, doc or 0, unit[0]):
                run.append((unit, kept))
                continue
            n = sum(len(u[2]) for u, _ in run)
            if run and n >= span_words:
                none, kept_id, kept_start = run[0][1]
                out.add((doc, run[0][0][0], run[-1][0][1], len(run), n, None if none else kept_id, kept_start))
            run = []
    return out


SPAN_COLUMNS = ["doc_id", "start", "end", "n_units", "n_words", "kept_id", "kept_start"]


@pytest.mark.parametrize("span_words", [1, 3, 5, substring.SPAN_WORDS])
def test_spans_and_removal(spark, span_words):
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in LINES], "doc_id long, text string, spans string, hi int, own_id int")
    got = substring.repeats(df, span_words=span_words).select(SPAN_COLUMNS).collect()
    want = spans_brute(LINES, span_words)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    new = substring.without_repeats(df, span_words=span_words)
    assert new.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in new.collect()), key=str)
    cut = {d: [(s, e) for x, s, e, *_ in want if x == d] for d, _ in LINES}
    assert texts == sorted(((d, t if t is None else substring.remove_spans(t, cut[d])) for d, t in LINES), key=str)
    assert substring.repeats(df.limit(0)).count() == 0 and substring.without_repeats(df.limit(0)).count() == 0


def test_remove_spans():
    text = "one. two. three.\nfour\n  five.  six"
    assert substring.remove_spans(text, [(5, 9)]) == "one. three.\nfour\n  five.  six"
    assert substring.remove_spans(text, [(17, 21)]) == "one. two. three.\n  five.  six"
    assert substring.remove_spans(text, [(10, 16)]) == "one. two. \nfour\n  five.  six"
    assert substring.remove_spans(text, [(10, 29), (0, 4)]) == "two. six"
    assert substring.remove_spans(text, []) == text


def test_short_repeated_lines_alone_stay(spark):
    menu = "Home\nAbout us\nRead more\n"
    passage = "This is a sentence of eight words here. " * 2 + "And this one ends it, with nine words here."
    rows = [(1, menu + "a first text"), (2, menu + "another. " + passage), (3, "Read more\nthe third begins thus: " + passage + " and goes on.\nHome")]
    got = substring.repeats(spark.createDataFrame(rows, "doc_id long, text string"), span_words=15).collect()
    assert [(r.doc_id, r.n_words, rows[2][1][r.start:r.end]) for r in got] == [(3, 17, passage[passage.index("This", 5):])]
    assert sum(r.n_words for r in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string"), span_words=1).collect()) > 25


def test_paragraph_and_line_units(spark):
    text = "first line here\nsecond line here\n\nother part of it all"
    df = spark.createDataFrame([(1, text), (2, "x\n \n" + text)], "doc_id long, text string")
    got = substring.repeated_units(df, unit="paragraph").collect()
    assert {(r.doc_id, r.start, r.end) for r in got} == {(2, 4, 36), (2, 38, 58)}
    got = substring.repeats(df, unit="line", span_words=1).collect()
    assert [(r.doc_id, r.start, r.end, r.n_units) for r in got] == [(2, 4, 58, 3)]


# ---- quality classifier

def test_classifier_on_held_out_rows(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    scored = {r.doc_id: r for r in queries.op7_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(scored[i].score, y) for i, y in labels.items() if i in scored and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in scored.items())
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_classifier_edge_cases(spark):
    docs = spark.createDataFrame([(i, "good words here " + str(i), 9.0) for i in range(20)] + [(i, "bad $$ %% " + str(i), 9.0) for i in range(20, 40)]
                                 + [(50, None, 9.0), (51, "", 9.0), (None, "good words", 9.0), (52, "z" * 100_000, 9.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(None, 1), (3, None), (99, 0), (51, 7)], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    scored = quality.score(docs, weights)
    assert scored.columns == ["doc_id", "text", "score"] and scored.count() == docs.count()
    by_id = {r.doc_id: r.score for r in scored.collect()}
    assert all(by_id[i] > 0.5 for i in range(20)) and all(by_id[i] < 0.5 for i in range(20, 40)) and by_id[50] == by_id[51]
    for part, near in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0)):
        r = quality.score(docs.where("doc_id = 51"), quality.fit(docs, part)).first()
        assert abs(r.score - near) < 0.01
    assert quality.score(docs.limit(0), weights).count() == 0


def test_features_of_long_texts(monkeypatch):
    text = "some words, and 7 more!! words words " * 20
    want = quality.features(text.encode())
    monkeypatch.setattr(quality, "LONG", 10)
    got = quality.features(text.encode())
    assert all(np.array_equal(a, b) for a, b in zip(got, want)) and np.isclose((got[1] ** 2).sum(), 1)


def test_training_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} $$" if i % 2 else f"v{i % 5}") for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    assert np.array_equal(quality.fit(docs, labels, most_per_class=10), quality.fit(docs.orderBy(F.desc("doc_id")), labels, most_per_class=10))


def ftrl_brute(rows, epochs=quality.EPOCHS):
    """FTRL-proximal by its formulas, a coordinate at a time."""
    share = {y: sum(label == y for _, label in rows) / len(rows) for y in (0, 1)}
    z, n = Counter(), Counter()
    bias = 1 << quality.BUCKET_BITS

    def weight(i):
        l1 = 0.0 if i == bias else quality.L1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for (where, value), label in rows:
            x = [*zip(where.tolist(), value.tolist()), (bias, 1.0)]
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = 0.5 / share[label] * (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_training_equals_plain_ftrl():
    rng = random.Random(6)
    rows = [(quality.features(" ".join(rng.choice("a b c d e f g $$ !!".split()) for _ in range(rng.randrange(1, 30))).encode()), int(rng.random() < 0.4)) for _ in range(40)]
    model = quality.Ftrl()
    share = {y: sum(label == y for _, label in rows) / len(rows) for y in (0, 1)}
    for _ in range(quality.EPOCHS):
        for (where, value), label in rows:
            model.learn(where, value, label, 0.5 / share[label])
    got, want = model.weights(np.arange(len(model.z))), ftrl_brute(rows)
    assert all(got[i] == pytest.approx(w, abs=1e-9) for i, w in want.items()) and np.count_nonzero(got) <= len(want)
    # train keeps every fifth row back, learns the others, then rescales
    learned, trained = ftrl_brute([r for i, r in enumerate(rows) if i % 5]), quality.train(rows)
    ratios = {round(trained[i] / w, 6) for i, w in learned.items() if abs(w) > 1e-6 and i != 1 << quality.BUCKET_BITS}
    assert len(ratios) == 1 and ratios.pop() > 0


def test_a_repeated_id_is_one_training_row(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 7} $$" if i % 2 else f"v{i % 5}") for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    first = min(["x y z", "p q"], key=lambda t: spark.sql(f"select xxhash64('{t}')").first()[0])
    many = docs.where("doc_id <> 7").union(spark.range(3000).selectExpr("7L", "if(id % 2 = 0, 'x y z', 'p q')"))
    one = docs.where("doc_id <> 7").union(spark.createDataFrame([(7, first)], "doc_id long, text string"))
    assert np.array_equal(quality.fit(many, labels), quality.fit(one, labels))


# ---- BPE

STRANGE = ["", "a" * 5000, "ab" * 700, "   \n\n  x", "🙂🙃" * 50, "été" * 300, "<|endoftext|>", "\x00\x01", "don't we'll  I'd"]


@pytest.fixture(scope="module")
def codecs():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return (bpe.Encoder(bpe.vocabulary_tables(ranks), public_tokenizers.PATTERN),
            tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


def test_bpe_equals_the_library(codecs, monkeypatch):
    own, plain = codecs
    rng = random.Random(1)
    texts = STRANGE + ["".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(2000)), "".join(rng.choice("abcdeft") for _ in range(4000)),
                       " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(1, 60))) for _ in range(500))]
    want = [plain.encode_ordinary(t) for t in texts]
    assert [x.tolist() for x in own.encode(texts)] == want
    assert [own.decode(np.array(x, np.int64)) for x in want] == [t.encode() for t in texts]
    monkeypatch.setattr(bpe, "MATCHES_AT_ONCE", 7)  # long texts go in steps
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    assert [x.tolist() for x in own.encode(texts)] == want


def test_bpe_query(spark, sf_small, codecs):
    got = {r.doc_id: r for r in queries.op8_bpe_codec(spark, sf_small).collect()}
    for doc, text in texts_of(spark, sf_small):
        ids = codecs[1].encode_ordinary(text or "")
        r = got[doc]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_edge_cases(spark):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    df = spark.createDataFrame([(1, None, 3), (None, "x", 3), (2, "", 3), (2, "", 3)], "doc_id long, text string, ids int")
    enc = bpe.encode(df, path, pattern)
    rows = bpe.decode(enc, path, pattern).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in rows) == [("1", b""), ("2", b""), ("2", b""), ("None", b"x")]
    assert bpe.encode(df.limit(0), path, pattern).count() == 0
    nulls = bpe.decode(enc.select("doc_id", F.lit(None).cast("binary").alias("ids")), path, pattern)
    assert nulls.where("decoded is null").count() == 4


# ---- URL filter

def url_brute(urls):
    """host, path, rule, verdict and score of each URL, with dictionaries."""
    parts = []
    for u in urls:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host):]).group()
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(r), r, a) for a, r in queries.URL_RULES for h, p in [r.split("/", 1)]
                if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        parts.append((host, path, *(max(fits)[1:] if fits else (None, None))))
    counts = {"allow": {}, "block": {}}
    grams = lambda t: [(("\x02" * 3 + t + "\x03")[i:i + 4]) for i in range(len(t) + 1)]
    for host, path, _, label in set(parts):
        if label:
            c = counts[label]
            for g in grams(host + path):
                for n in range(1, 5):
                    s = g[4 - n:]
                    c[s] = c.get(s, 0) + 1
                    c["ctx", s[:-1], n] = c.get(("ctx", s[:-1], n), 0) + 1

    def p(c, g):
        out = 1 / 256
        for n in range(1, 5):
            s = g[4 - n:]
            out = (c.get(s, 0) + 2 * out) / (c.get(("ctx", s[:-1], n), 0) + 2)
        return out

    score = lambda t: np.mean([math.log(p(counts["allow"], g)) - math.log(p(counts["block"], g)) for g in grams(t)])
    sets = {k: [score(h + q) for h, q, _, label in set(parts) if label == k] for k in counts}
    if all(sets.values()):
        (ma, sa), (mb, sb) = ((np.mean(sets[k]), np.std(sets[k])) for k in ("allow", "block"))
        cut = ma + (mb - ma) * (sa / (sa + sb) if sa + sb else 0.5)
        return [(h, q, r, v or ("block" if score(h + q) < cut else "allow"), score(h + q)) for h, q, r, v in parts]
    return [(h, q, r, v or "allow", None) for h, q, r, v in parts]


URLS = ["http://A.example.net/en/1", "http://example.net/en/", "https://net/x", "https://anet/x", "http://x.org/fr/é?q#f", "http://example.com/de/",
        "http://example.com/de", "http://b.example.net", "http://b.example.net?x=/en/", None, "", "nothing", "x://", "http://xn.example.com/es/😀", "ftp://y.org/fr",
        "http://c.example.com/de/1", "http://q.org/fr/" + "z" * 3000, "http://A.example.net/en/1", "http://host\nname/path\nx", "http://u@h.net:80/a"]


@pytest.mark.parametrize("urls", [URLS, URLS[9:13], ["http://x.org/fr/1", "http://x.org/es/1"]])
def test_url_filter_equals_brute_force(spark, urls):
    df = spark.createDataFrame([(i if i != 3 else None, u, 0.5) for i, u in enumerate(urls)], "page_id long, url string, score double")
    got = sorted(urlfilter.judge(df, queries.URL_RULES).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    want = url_brute(urls)
    want = [w for i, w in enumerate(want) if i != 3] + ([want[3]] if len(urls) > 3 else [])
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [w[:4] for w in want]
    assert [r.score for r in got] == pytest.approx([w[4] for w in want]) if want[0][4] is not None else all(r.score is None for r in got)
    assert urlfilter.judge(df.limit(0), queries.URL_RULES).count() == 0


def whole_url_scores(urls):
    """Score of each whole URL, and the cut, from plain counts of all contexts."""
    labels = {u or "": w[3] for u, w in zip(urls, url_brute(urls)) if w[2]}
    padded = lambda t: "\x02" * 3 + t + "\x03"
    counts = {k: Counter(padded(t)[i - n:i + 1] for t, label in labels.items() if label == k for i in range(3, len(t) + 4) for n in range(4)) for k in ("allow", "block")}
    around = {k: Counter() for k in counts}
    for k, c in counts.items():
        for g, times in c.items():
            around[k][g[:-1], len(g)] += times

    def p(k, g):
        out = 1 / 256
        for n in range(1, 5):
            out = (counts[k][g[-n:]] + 2 * out) / (around[k][g[-n:][:-1], n] + 2)
        return out

    score = lambda t: np.mean([math.log(p("allow", g) / p("block", g)) for i in range(len(t) + 1) for g in [padded(t)[i:i + 4]]])
    (ma, sa), (mb, sb) = ((np.mean(x), np.std(x)) for x in ([score(t) for t, label in labels.items() if label == k] for k in counts))
    return [score(u or "") for u in urls], ma + (mb - ma) * (sa / (sa + sb))


def test_url_models_read_the_whole_url(spark):
    urls = [*URLS, "http://other.com/x?casino=1", "http://other.com/x?en/fr", "http://other.com/x#casino", "www.other.com/en/1", "//other.com/de/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.judge(df, queries.URL_RULES, whole_url=True).orderBy("page_id").collect()
    scores, cut = whole_url_scores(urls)
    want = [(*w[:3], w[3] if w[2] else "block" if s < cut else "allow") for w, s in zip(url_brute(urls), scores)]
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == want
    assert [r.score for r in got] == pytest.approx(scores)
    assert len({r.score for r in got[-5:]}) == 5


def test_url_query_reads_the_whole_url(spark, sf_small):
    urls = [r.url for r in spark.read.parquet(f"{sf_small}/pages.parquet").orderBy("page_id").collect()]
    got = queries.op5_url_filter(spark, sf_small).orderBy("page_id").collect()
    assert [r.score for r in got] == pytest.approx(whole_url_scores(urls)[0])


def test_url_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/pages.parquet").orderBy("page_id").collect()
    got = queries.op5_url_filter(spark, sf_small).orderBy("page_id").collect()
    want = url_brute([r.url for r in rows])
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [w[:4] for w in want]


# ---- WARC bundles

def test_warc_round_trip(spark, tmp_path):
    big, other = "é" * 600, "b" * 1000
    rows = [(1, "http://a/ü\r\nx", big), (2, "http://b", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", big), (None, None, None),
            (7, "u", other), (7, "u", other), (8, "u", "b" * 999), (9, "u", "b" * 999), (10, "u", "x" * 3_000_000), (11, "u", "a\r\n\r\nb")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    index = warc.write_bundles(df, str(tmp_path / "w"), frame_bytes=4000, bundle_bytes=3000)
    got = warc.read_records(index, str(tmp_path / "w")).collect()
    want = []
    for page, url, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == data]
        holder = max(same) if page is not None and len(data) >= 1000 else page
        kind = "response" if holder == page else "revisit"
        want.append((str(page) if page is not None else None, kind, len(data), hashlib.sha1(data).hexdigest(), str(holder) if kind == "revisit" else None,
                     data if kind == "response" else None))
    out = [(r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(out, key=str) == sorted(want, key=str)
    # the bundles are plain Zstandard streams of records too
    for bundle in (tmp_path / "w").iterdir():
        if bundle.suffix == ".zst":
            plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bundle.read_bytes()), read_across_frames=True).read()
            n, at = 0, 0
            while at < len(plain):
                fields, body = warc.parse_record(plain, at)
                at = plain.index(b"\r\n\r\n", at) + 4 + len(body) + 4
                n += 1
            assert n == index.where(F.col("bundle") == bundle.name).count()
    empty = warc.write_bundles(df.limit(0), str(tmp_path / "e"))
    assert warc.read_records(empty, str(tmp_path / "e")).count() == 0


def test_warc_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    index = warc.write_bundles(df, str(tmp_path / "w"))
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(index.withColumn("record_id", F.lit("<urn:uuid:0>")), str(tmp_path / "w")).collect()


# ---- license scan

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def least_edits(text, listed, kept):
    """Least cost of edits between a template and any span of the whole text."""
    n = len(listed)
    text = [re.sub(r"^v(?=[0-9]+$)", "", w) for w in text]
    cost = np.array([n + 1 if w in licenses.NAMES else 1 for w in text], np.int64)
    passed = np.concatenate([[0], np.cumsum(cost)])
    row = np.zeros(len(text) + 1, np.int64)
    words = np.array(text, dtype=object)
    for t in listed:
        lost = n + 1 if t in kept else 1
        new = row + lost
        if len(text):
            new[1:] = np.minimum(new[1:], row[:-1] + np.where(words == t, 0, np.maximum(cost, lost)))
        row = np.minimum.accumulate(new - passed) + passed
    return int(row.min())


def license_brute(doc, text):
    w = words_of(text)
    at, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        at += hits
        base |= {label} if hits else set()
    labels, best = set(base), 0.0
    for template, label in licenses.TEMPLATES:
        n, least = len(template.split()), least_edits(w, template.split(), {*licenses.NAMES, *label.split("-")})
        if least <= int(0.3 * n + 1e-9):
            labels.add(label)
            best = max(best, 1 - least / n)
    return (doc, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if at else best)


NOTICES = [(1, "Released under the MIT License."), (2, "x CC-BY-NC cc by nc\ncc BY nc"), (3, None), (4, ""), (None, "Apache License, Version 2.0 and Apache License, version 2"),
           (5, "This work is licensed under the GNU General Public License, version 3."), (5, "nothing"), (5, "nothing"), (6, "under the mit licens\u0435"),
           (7, "Permission is hereby gladly granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
           (8, "under the MIT \u212Aey under\u2003the mit license"), (9, "the mit license " * 3000), (10, "This work is licensed under something else"), (11, "a-b_c d9é")]


def test_license_scan_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in NOTICES], "doc_id long, text string, label string, pos int")
    got = [tuple(r) for r in licenses.scan(df).collect()]
    want = [license_brute(*n) for n in NOTICES]
    assert sorted((g[:7] for g in got), key=str) == sorted((w[:7] for w in want), key=str)
    assert sorted(g[7] for g in got) == pytest.approx(sorted(w[7] for w in want))
    assert licenses.scan(df.limit(0)).count() == 0


EDITED = [("Licensed under the Apache Software License, Version 2.0", "apache-2", 7 / 8), ("Licensed under the Apache License, v2.0", "apache-2", 7 / 8),
          ("This work is licensed under the GNU GPL, version 3", "gpl-3", 9 / 12), ("so: Released under MIT license", "mit", 4 / 5),
          ("Licensed under CC BY version NC 4.0", "cc-by-nc", 6 / 7),
          ("This work is licensed under a Creative Commons Attribution 3.0 Unported License", "cc-by", 11 / 13),
          # edits of words that tell licenses apart
          ("Licensed under the Mozilla Public License, Version 2.0", "", 0), ("Licensed under the Apache License, Version 1.1", "", 0),
          ("Released under the BSD license", "", 0), ("Licensed under CC BY-SA 4.0", "", 0), ("This work is licensed under the GNU GPL, version 2", "", 0),
          ("This work is licensed under the GNU LGPL, version 3", "", 0), ("Licensed software under much of the apache tent, version 2.0", "", 0)]


def test_license_scan_finds_edited_notices(spark):
    far = "word " * 500
    texts = [(i, pad + text + end) for i, (text, _, _) in enumerate(EDITED) for pad, end in (("", ""), (far, "."), ("", " " + far), ("mit apache gnu cc ", ""))]
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.labels, r.n_base) == (EDITED[r.doc_id][1], 0) and r.score == pytest.approx(EDITED[r.doc_id][2]), r


def test_license_edits_equal_brute_force(spark):
    rng, template = random.Random(3), licenses.TEMPLATES[3][0]
    listed, docs = template.split(), []
    for i in range(60):
        w = listed[:]
        for _ in range(rng.randrange(10)):
            at = rng.randrange(len(w))
            w[at:at + rng.randrange(2)] = rng.choice([[], ["other"], [rng.choice(listed)]])
        docs.append((i, " ".join(["x"] * rng.randrange(4) + w + ["of"] * rng.randrange(4))))

    def least(text):
        old = [0] * (len(text) + 1)
        for n, t in enumerate(listed):
            new = [n + 1]
            for j, w in enumerate(text):
                new.append(min(old[j] + (t != w), old[j + 1] + 1, new[j] + 1))
            old = new
        return min(old)

    size = len(listed)
    want = {i: least(t.split()) for i, t in docs}
    df = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), templates=[(template, "apache-2")])
    got = {r.doc_id: r.labels for r in df.collect()}
    assert got == {i: "apache-2" if e <= size * licenses.EDITED else "" for i, e in want.items()}
    assert 5 < sum(map(bool, got.values())) < 60


def test_license_labels_come_through_diagonals(spark):
    """Nothing is found where no diagonal proposes a place, however close the words are."""
    texts = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(EDITED)], "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    notices = [licenses.Notice(t, label, licenses.NAMES) for t, label in licenses.TEMPLATES]
    proposed = {(r.doc_id, notices[r.t].label) for r in licenses.proposals(texts, notices).collect()}
    assert {(i, label) for i, (_, label, _) in enumerate(EDITED) if label} <= proposed
    assert licenses.scan(texts, templates=[]).where("labels <> base_labels").count() == 0


def test_license_scan_of_a_long_text_of_notices(spark):
    """A text of 1.2 MB, all edited notices, takes time in proportion."""
    some = [t for t, label, _ in EDITED if label]
    took = {}
    for n in (20, 5_000, 20_000):
        text = " ".join(some[i % len(some)] for i in range(n))
        start = time.time()
        row, = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
        took[n] = time.time() - start
        assert row.labels == ",".join(sorted({label for _, label, _ in EDITED if label}))
    assert took[20_000] < 30 and took[20_000] < 8 * max(took[5_000], 1), took


def test_license_query(spark, sf_small):
    got = {r.doc_id: tuple(r) for r in queries.op10_license_scan(spark, sf_small).collect()}
    for doc, text in texts_of(spark, sf_small):
        want = license_brute(doc, text)
        assert got[doc][:7] == want[:7] and got[doc][7] == pytest.approx(want[7])


# ---- pipeline

def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    weights = quality.fit(docs, queries.training_labels(spark, sf_small))
    good = corpus_pipeline.accept_quality(spark, docs, sf_small)
    assert good.columns == docs.columns
    rows = {r.doc_id: r for r in good.collect()}
    scores = {r.doc_id: r.score for r in quality.score(docs, weights).collect()}
    assert set(rows) == {i for i, s in scores.items() if s >= queries.ACCEPT} and len(rows) < docs.count()

    single = corpus_pipeline.drop_near_duplicates(spark, good, sf_small)
    assert single.columns == docs.columns
    pairs = simhash.near_duplicates(good).collect()
    kept = {r.doc_id for r in single.collect()}
    assert kept == {r.doc_id for r in pairs if r.doc_id == r.component_id} and len(kept) < len(rows)

    lines = corpus_pipeline.drop_repeated_passages(spark, single, sf_small)
    assert lines.columns == docs.columns
    cut = spans_brute([(i, rows[i].text) for i in kept])
    assert cut
    for r in lines.collect():
        mine = [(s, e) for d, s, e, *_ in cut if d == r.doc_id]
        assert r.n_chars == len(r.text) and r.text == substring.remove_spans(rows[r.doc_id].text, mine)
    packed = corpus_pipeline.run(spark, sf_small).collect()
    codec = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(packed, [(r.doc_id, r.text) for r in lines.collect()], 2048, lambda t: codec.encode(t, add_special_tokens=False).ids, 1)


def test_pipeline_stages_on_odd_rows(spark, sf_small):
    rows = [(1, "some plain words", "en", "s", 16, 0.5), (None, None, None, None, None, None), (2, "", "en", "s", 0, None), (2, "", "en", "s", 0, None),
            (1, "some plain words", "en", "s", 16, 0.5), (3, "w " * 100_000, "en", "s", 200_000, 1.0), (4, " " * 1_000_000, "en", "s", 1_000_000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Score double")
    docs = docs.withColumn("__id", F.lit("x")).withColumn("__text", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("own_key", F.lit(3))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_small)
        kept = out.collect()
        if name != "packing":
            assert out.columns == docs.columns and (name == "quality" or len(kept) == {"simhash": 3, "lines": 7}[name])
        if name == "lines":
            assert sorted(map(str, (r.text for r in kept))) == sorted(str(r[1]) for r in rows)
        assert stage(spark, docs.limit(0), sf_small).count() == 0
