"""The corpus operators against brute force, the libraries and SQL, with nulls, empty and long texts, ties, repeats,
empty tables and clashing column names."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parley.llm import ann, bpe, embedding_dedup, graph, licenses, line_dedup, mixing, neighbours, phrases, pieces, quality, queries, simhash
from parley.llm.common import Workspace

DATA = Path("/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "b", " ", "  ", "\n", "é", "ß", "漢", "𓀀", "the", "in", "1", ".", "'s", "\t", "　", "౜", "<|endoftext|>", "▁", "aa", "   ", "\x85", "\x0b"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def odd_texts(n, seed=1, longest=60):
    rng = random.Random(seed)
    return [None, "", " ", "\n"] + ["".join(rng.choice(ODD) for _ in range(rng.randint(1, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def mixed_docs(spark):
    texts = odd_texts(60)
    return [(i, t) for i, t in enumerate(texts)] + [(3, "\n"), (None, "x y z"), (None, None), (70, texts[20]), (70, texts[20])]


def clash(df):
    """Extra columns by the names that operators use inside."""
    return df.selectExpr("*", "1 AS h1", "2 AS h2", "3 AS key", "4 AS fp", "5 AS id", "6 AS row_", "7 AS block", "8 AS n_tokens", "9 AS kept", "10 AS pos", "11 AS component_id")


# 1


def test_token_counts_are_the_library_s(spark, mixed_docs):
    library = Tokenizer.from_file(BPE)
    got = bpe.count_tokens(clash(documents(spark, mixed_docs)), BPE).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in mixed_docs]
    assert sorted(map(str, [tuple(r)[:3] for r in got])) == sorted(map(str, want))
    assert bpe.count_tokens(documents(spark, []), BPE).count() == 0


def test_a_piece_of_many_bytes():
    c = bpe.counter(BPE)
    assert c.count("a" * 100_000) == len(Tokenizer.from_file(BPE).encode("a" * 100_000).ids)


# 2


def test_quality_catches_poor_and_toxic_texts_held_out(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        text, kind = [rng.choice(words) for _ in range(rng.randint(20, 120))], i % 3
        if kind == 1:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(["vile", "nasty"])
        text = " | ".join(text) if kind == 0 else " ".join(text)
        rows.append((i, text))
        if i < 600:
            labels.append((i, int(kind != 0), int(kind == 1)))
    docs, rated = documents(spark, rows), spark.createDataFrame(labels + [(None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.rate(docs, quality.fit(docs, rated)).select("row.doc_id", "kept", "expected_grade").collect()}
    held = [i for i in range(600, 900)]
    assert np.mean([got[i]["kept"] == (i % 3 == 2) for i in held]) > 0.95


def test_quality_without_ratings_keeps_all(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in quality.rate(clash(docs), quality.fit(docs, none)).collect()] == [True, True]


def test_ordinal_objective_and_its_gradient():
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 6, 30)
    ends, grades, x = np.cumsum(sizes), rng.integers(0, 3, 30), rng.normal(size=10)
    features = np.concatenate([rng.choice(8, n, replace=False) for n in sizes])
    loss, g = quality.objective(x, ends, features, grades)
    low, high, total = x[8], x[8] + np.exp(x[9]), 0.0
    for k, grade in enumerate(grades):
        s = sum(x[f] for f in features[ends[k] - sizes[k] : ends[k]])
        above = [1.0, 1 / (1 + np.exp(low - s)), 1 / (1 + np.exp(high - s)), 0.0]
        total -= np.log(above[grade] - above[grade + 1])
    assert loss == pytest.approx(total / 30)
    for k in range(10):
        e = np.eye(10)[k] * 1e-6
        assert g[k] == pytest.approx((quality.objective(x + e, ends, features, grades)[0] - quality.objective(x - e, ends, features, grades)[0]) / 2e-6, abs=1e-6)


def test_quality_weights_of_either_sign_are_at_the_optimum(monkeypatch):
    monkeypatch.setattr(quality, "ENOUGH", 1e-9)
    rng = np.random.default_rng(6)
    features = np.concatenate([np.flatnonzero(rng.random(12) < 0.4) for _ in range(400)] + [np.zeros(0, int)])
    sizes = np.diff(np.flatnonzero(np.diff(features, prepend=99, append=-1) <= 0)).tolist()
    ends, n = np.cumsum(sizes), len(sizes)
    score = np.bincount(np.repeat(np.arange(n), sizes), np.array([3, -3, 2] + [0] * 9)[features], n) + rng.logistic(size=n)
    grades = (score > -1).astype(int) + (score > 1)
    start = np.append(np.zeros(12), [-1.0, 0.0])
    x = quality.fit_ordinal(ends, features, grades, start, 400)
    assert x[0] > 1 and x[1] < -1 and x[2] > 0.7
    penalty = quality.SPARSE / np.sqrt(n)
    g = quality.objective(x, ends, features, grades)[1]
    assert np.abs(g[12:]).max() < 1e-3
    assert all(abs(g[k] + np.sign(x[k]) * penalty) < 1e-3 if x[k] else abs(g[k]) <= penalty + 1e-3 for k in range(12))


def test_quality_query_is_the_model_s_score(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["fine", "text", "here", "there", "awful" if i % 2 else "nice"]) for _ in range(30))) for i in range(200)]
    docs = documents(spark, rows + [(None, None), (900, ""), (901, "awful " * 40_000), (5, rows[5][1])])
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    weights, limits, cut = quality.fit(clash(docs), labels)
    got = quality.rate(clash(docs).withColumns({"s": F.lit(1), "row": F.lit(2), "expected_grade": F.lit(3)}), (weights, limits, cut)).select("row.doc_id", "row.text", "expected_grade", "tail_probability", "kept").collect()
    assert len(got) == 204 and all(v > 0 or v < 0 for v in weights.values())
    for r in got:
        words = (r["text"] or "").split()
        held = {quality.bucket(x) for w in words for x in ["w" + w, *(f"{k}{w[:k]}" for k in (4, 5) if len(w) > k)]}
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        held |= {x for x, share in zip(quality.REPEATS, (0.05, 0.25), strict=True) if same >= 5 and same > share * len(words)}
        s = sum(weights.get(x, 0.0) for x in held)
        above = [1 / (1 + np.exp(t - s)) for t in limits]
        assert (r["expected_grade"], r["tail_probability"]) == (pytest.approx(sum(above)), pytest.approx(above[1])) and r["kept"] == (r["tail_probability"] >= cut)
    assert quality.rate(docs.limit(0), (weights, limits, cut)).count() == 0 and quality.fit(docs.limit(0), labels) is None


def test_quality_cut_is_between_good_and_other_rows():
    good = np.array([False, False, True, True])
    assert quality.best_cut(np.array([0.1, 0.2, 0.6, 0.9]), good) == pytest.approx(0.4)
    assert quality.best_cut(np.array([0.5, 0.5, 0.5, 0.5]), good) < 0.5  # rather all than a good one lost
    assert quality.best_cut(np.array([0.5]), np.array([True])) == quality.CUT


# 3


@pytest.mark.parametrize("chunk", [40, 7])
def test_pieces_are_the_library_s_and_decode_back(spark, mixed_docs, chunk):
    """With chunks of 7 the longest texts have over FAN of them, so the tree has several levels."""
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = mixed_docs + [(100 + k, t) for k, t in enumerate(odd_texts(40, 9, 300))] + [(200, "a" * 500), (201, "the in" * 90)]
    found = pieces.encode(clash(documents(spark, rows)), PIECES, chunk=chunk, giant=2 * chunk, decoded=True)
    assert found.columns == ["doc_id", "ids", "decoded"]
    found = pieces.decode(found.withColumnRenamed("decoded", "first"), PIECES).collect() if chunk == 7 else found.collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows]
    assert sorted(str((r["doc_id"], r["ids"], r["decoded"])) for r in found) == sorted(map(str, want))
    assert pieces.encode(documents(spark, []), PIECES).count() == 0


def test_max_plus_scan_of_a_unigram_model():
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(open(PIECES, "rb").read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = -abs(hash_score(p.piece))
    blob = m.SerializeToString()
    model, library = pieces.Model(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    score = lambda ids: sum(model.scores.get(model.names[i], 0.0) for i in ids)
    rng = random.Random(4)
    for _ in range(30):
        text = model.marked("".join(rng.choice(["the", "in", "er", "a", "tion", "x", " "]) for _ in range(60)))
        cuts = [*range(0, len(text), 24), len(text)]
        parts = [(text[max(0, a - model.longest) : b + model.longest], min(a, model.longest), min(a, model.longest) + b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        mats = [model.matrix(*p) for p in parts]
        total = mats[0]
        for x in mats[1:]:
            total = pieces.combine(total, x)
        assert total.shape == (1, 1) and total[0, 0] == pytest.approx(score(library.encode(text[1:].replace("▁", " "))), abs=1e-2)


def test_words_solve_as_the_library_does():
    model, library = pieces.model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(7)
    parts = [*"aeinstr.,-é漢𓀀1", "th", "tion", "er", "ing", "and", "The", "ou", "##", "...", "!!", "\u0301"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    assert all(np.frombuffer(model.solve(pieces.SPACE + w), np.int32).tolist() == library.encode(w) for w in words)


def test_a_text_over_the_bound_for_giants_is_the_library_s(spark):
    rng = random.Random(11)
    text = " ".join("".join(rng.choice(["th", "er", "in", "x", "é", "\n"]) for _ in range(rng.randint(1, 9))) for _ in range(12_000))
    assert len(text) > 2 * pieces.GIANT
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(documents(spark, [(1, text), (2, "x" * (pieces.GIANT + 1)), (3, "short")]), PIECES).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {1: library.encode(text), 2: library.encode("x" * (pieces.GIANT + 1)), 3: library.encode("short")}


def hash_score(piece: str) -> float:
    return 3 + xxhash.xxh32_intdigest(piece) % 1000 / 100


# 4


def brute_windows(rows, size=35):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k : k + size]) for _, w in split for k in range(len(w) - size + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("block", [2_000, 1 << 20])
def test_repeated_phrases(spark, mixed_docs, block):
    rng = random.Random(3)
    prose = lambda n: [rng.choice("abcdefghij") + str(rng.randint(0, 30)) for _ in range(n)]
    shared, line = prose(80), prose(20)
    rows = list(mixed_docs)
    for i in range(100, 160):
        text = prose(rng.randint(5, 90))
        if i % 2:
            a = rng.randint(0, 60)
            text += shared[a : a + rng.randint(10, 80)] + prose(5)
        rows.append((i, "  ".join(text + line * (i % 3))))
    rows += [(200, "et " * 90), (201, "\t".join(shared)), (202, "　".join(shared)), (203, rows[-1][1])]
    got = phrases.dedup_phrases(clash(documents(spark, rows)), digest_only=True, block=block).collect()
    assert sorted(str((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode())) for r in got) == brute_windows(rows)
    assert phrases.dedup_phrases(documents(spark, [])).count() == 0


def test_only_the_automaton_locates_passages(monkeypatch):
    rng = random.Random(12)
    words = [f"w{rng.randint(0, 500)}".encode() for _ in range(200)]
    text, sink = b" ".join(words), pa.BufferOutputStream()
    docs = pa.table({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array([b"x y " + text, b"other words"], pa.binary())})
    with pa.ipc.new_stream(sink, docs.schema) as w:
        w.write_table(docs)
    block = phrases.Block(pa.chunked_array([[sink.getvalue().to_pybytes()]]))
    passage = b" ".join(words[20:120])
    assert np.flatnonzero(phrases.covered_words(block, [passage])).tolist() == list(range(22, 122))
    assert not phrases.covered_words(block, [b" ".join(words[20:50])]).any()  # shorter than a window

    class Empty:
        add_word = make_automaton = lambda self, *a: None
        iter = lambda self, text: iter(())
        __len__ = lambda self: 1

    monkeypatch.setattr(phrases.ahocorasick, "Automaton", Empty)
    assert not phrases.covered_words(block, [passage]).any()


def test_rows_that_repeat_are_dealt_to_many_blocks(spark):
    rng = random.Random(13)
    text = " ".join(f"w{rng.randint(0, 900)}" for _ in range(40))
    rows = [(7, text)] * 3000 + [(8, "b " * 40)]
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in phrases.dedup_phrases(documents(spark, rows), block=4000).collect())
    assert got == Counter({(7, 40, 40): 3000, (8, 40, 40): 1})
    packed = documents(spark, rows).select(F.spark_partition_id().alias("part"), "doc_id", F.col("text").cast("binary").alias("text")).repartition(8)
    assert packed.mapInArrow(phrases.pack(50, 4000), "block int, payload binary").select("block").distinct().count() >= 4


# 5, 7: SQL


def duck(spark, df, sql):
    c = duckdb.connect()
    c.register("d", df.toPandas())
    c.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text FROM d")
    return sorted(repr(r) for r in c.execute(sql).fetchall())


def test_licenses_as_sql_and_by_name(spark, mixed_docs):
    head = "MIT License\n\nCopyright (c) 2020 A. Person\n\n"
    mit = licenses.MIT.replace("sublicense", "sub-licence").replace('"', "”").upper()
    rows = mixed_docs + [(300, head + mit + "\n"), (301, "prose\nReleased under the MIT licence!\n© 2001 B\nmore"), (302, head + mit + " extra"), (303, "Licensed under CC BY-NC 4.0."), (304, "© 2020 x\n\nAll rights reserved.")]
    docs = documents(spark, rows)
    got = licenses.scan_licenses(clash(docs), licenses.known_licenses(spark)).withColumn("notice_ids", F.array_join("notice_ids", ","))
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[300]["license_id"] == "MIT" and by_id[302]["license_id"] is None and by_id[301]["notice_ids"] == "MIT" and by_id[303]["license_id"] == "CC-BY-NC-4.0"
    assert by_id[304]["text_digest"] == hashlib.sha256(b"").hexdigest()
    want = duck(spark, docs.filter("doc_id IS NOT NULL"), licenses.SQL)
    assert sorted(repr(tuple(r)) for r in got.filter("doc_id IS NOT NULL").select("doc_id", "text_digest", "license_id", "notice_ids").collect()) == want


def test_canonical_form(spark):
    texts = ["Licence licence LICENCE sub-licence sub licence", "“ÉCOLE” ＋ été… ¿qué? ΣΟΦΙΑ", "a\u2003b\u00a0c·d", "Version 3.0 version 3.0", None, ""]
    got = licenses.canonical(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t").orderBy("i").collect()
    assert [r["whole"] for r in got] == ["license license license sublicense sublicense", "école été qué σοφια", "a b c d", "v 3 v 3", "", ""]


COMMON = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not COMMON.exists(), reason="no licence texts here")
def test_full_texts_by_digest(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = [(COMMON / f).read_text(errors="replace") for f in names]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10 + i, t.replace("\n", "\r\n\n").replace(" the license ", " THE – “licence” ")) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan_licenses(clash(documents(spark, rows)), licenses.known_licenses(spark)).collect()}
    assert got == {k: name for i, name in enumerate(names.values()) for k in (i, 10 + i)}
    assert len({d for _, d in licenses.DIGESTS}) == len(licenses.DIGESTS)


def test_licenses_of_no_rows(spark):
    assert licenses.scan_licenses(documents(spark, []), licenses.known_licenses(spark)).count() == 0


def test_lines(spark):
    rows = [(1, "Same line here\nonly one\n\nshort"), (2, " SAME LINE HERE\t\nshort\nonly two x"), (3, "Same line here"), (4, None), (5, ""), (6, "a\rSame line here\r\nSame line here"), (6, "other text\nSame line here"), (9, "twice in one doc\ntwice in one doc")]
    got = line_dedup.dedup_lines(clash(documents(spark, rows + [(None, "Same line here\nlast"), (1, "Same line here\nonly one\n\nshort")])))
    texts = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got.select("row.doc_id", "n_lines", "n_dropped", "kept").collect())
    assert texts == Counter(
        [
            (1, 4, 0, rows[0][1]), (1, 4, 0, rows[0][1]), (2, 3, 1, "short\nonly two x"), (3, 1, 1, ""), (4, 1, 0, ""), (5, 1, 0, ""), (6, 2, 1, "a\rSame line here\r"), (6, 2, 1, "other text"),
            (9, 2, 0, rows[7][1]), (None, 2, 1, "last"),
        ]
    )
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_as_sql(spark, name):
    df = queries.QUERIES[name](spark, str(DATA))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cur = c.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == sorted(repr(r) for r in cur.fetchall())


# 6, 8


def vectors(spark, m, extra=()):
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(m.astype("f4"))] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


BAD = [(5000, None, 0), (5001, [0.0] * 16, 0), (5002, [None] + [1.0] * 15, 0), (5003, [float("nan")] + [1.0] * 15, 0), (5004, [1.0], 0), (None, [1.0] * 16, 0)]


def test_nearest_against_brute_force(spark):
    m = np.random.default_rng(1).standard_normal((900, 16)).astype("f4")
    m[700:760] = m[3]
    df = vectors(spark, m, BAD).selectExpr("*", "1 AS id", "2 AS v", "3 AS q", "4 AS score")
    asked = df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("id"))
    got: dict = {}
    for r in ann.nearest(df, asked, k=24, leaf=100).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = m.astype(float)
    hits, n = 0, 0
    for q in range(0, 900, 20):
        s = x @ x[q]
        want = sorted((i for i in range(900) if i != q), key=lambda i: (-s[i], i))[:20]
        assert len(got[q]) == 20 and all(abs(s[i] - t) < 1e-9 for i, t in got[q])
        assert [i for i, _ in got[q]] == sorted((i for i, _ in got[q]), key=lambda i: (-dict(got[q])[i], i))
        hits, n = hits + len({*want} & {i for i, _ in got[q]}), n + 20
    assert hits / n >= 0.9
    assert set(got) == set(range(0, 900, 20))


@pytest.mark.parametrize("few", [300, 1 << 14])
def test_nearest_with_norms_far_apart(spark, few):
    rng = np.random.default_rng(6)
    m = rng.standard_normal((1500, 32))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[1000:] *= np.exp(rng.uniform(0, np.log(20), (500, 1)))
    m[7] *= 100
    df = vectors(spark, m)
    got: dict = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("id")), leaf=200, few=few).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x = m.astype("f4").astype(float)
    want = {q: [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20] for q in range(0, 1500, 20)}
    assert sum(len(got[q] & {*want[q]}) for q in want) >= 0.95 * 20 * len(want)


def test_outlier_norm_does_not_blind_the_graph(spark):
    m = np.random.default_rng(7).standard_normal((1200, 32))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[7] *= 100
    df = vectors(spark, m)
    got: dict = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("id")), leaf=200).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x = m.astype("f4").astype(float)
    want = {q: [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20] for q in range(0, 1200, 20)}
    assert sum(len(got[q] & {*want[q]}) for q in want) >= 0.95 * 20 * len(want)


def test_nearest_of_many_vectors_of_one_norm_and_a_hot_one(spark):
    rng = np.random.default_rng(8)
    m = rng.standard_normal((4000, 24)).astype("f4")
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[rng.permutation(4000)[:1300]] = m[11]
    df = vectors(spark, m, [(0, [float(x) for x in -m[0]], 0), (20, None, 0)])
    least = {0: min([m[0].tolist(), (-m[0]).tolist()])}
    m[0] = least[0]
    got: dict = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("id")), leaf=300).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    x = m.astype(float)
    hits = 0
    for q in range(0, 4000, 20):
        s = x @ x[q]
        s[q] = -9
        want = np.lexsort((np.arange(4000), -np.round(s, 12)))[:20].tolist()
        assert sorted(got[q]) == list(range(1, 21))
        hits += len({*want} & {*got[q].values()})
    assert hits >= 0.97 * 20 * 200


def test_repeated_ids_and_clashing_names(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 2.0], 0), (3, [1.0, 0.01], 0), (3, [1.0, 0.01], 0), (None, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS id", "2 AS v", "3 AS u", "4 AS root", "5 AS point", "6 AS n", "7 AS component_id", "8 AS times")
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.dedup_embeddings(df).collect()}
    assert got == {(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (None, 0, None, False)}  # of id 1 the vector [0, 1]
    near = ann.nearest(df, df.select(F.col("vec_id").alias("id")), top=1).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in near) == [(1, 2), (2, 1), (3, 2)]


def test_few_vectors_and_none(spark):
    df = vectors(spark, np.eye(3, 16))
    got = ann.nearest(df, df.select(F.col("vec_id").alias("id"))).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1)]
    none = df.limit(0)
    assert ann.nearest(none, none.select(F.col("vec_id").alias("id"))).count() == 0
    assert embedding_dedup.dedup_embeddings(none).count() == 0


def test_embedding_links_and_components(spark):
    rng = np.random.default_rng(2)
    m = rng.standard_normal((500, 16))
    for k in range(40):
        m[100 + k] = m[k % 7] + rng.standard_normal(16) * 0.12
    m[200:260] = m[1]
    df = vectors(spark, m, BAD)
    u = m.astype("f4").astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(500)
    while (new := np.minimum(root, np.where(near, root[None, :], 10**9).min(axis=1))).tolist() != root.tolist():
        root = new
    got = {r["vec_id"]: r for r in embedding_dedup.dedup_embeddings(df).collect()}
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), root[i], root[i] == i) for i in range(500))
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in range(5000, 5005)) and got[None]["component_id"] is None


def test_lists_are_enlarged_by_all_that_is_near(spark):
    rng = np.random.default_rng(3)
    m = np.vstack([rng.standard_normal(16) * 2 + rng.standard_normal((40, 16)) * 0.15, rng.standard_normal((60, 16))])
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<double>")
    g = neighbours.Graph(Workspace(spark, "lists"), rows, 8, above=0.88, most=48)
    g.refine(3)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert all({*np.flatnonzero(u @ u[r["id"]] >= 0.9)} - {r["id"]} <= {*r["ids"]} for r in g.nodes.collect())


def test_groups_wider_than_a_list_are_linked(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "AUDIT", 1)
    rng, n = np.random.default_rng(4), 200
    a = np.eye(32)[0]
    b = 0.915 * a + np.sqrt(1 - 0.915**2) * np.eye(32)[1]
    m = np.vstack([a + rng.standard_normal((n, 32)) * 0.008, b + rng.standard_normal((n, 32)) * 0.008, -np.eye(32)[5:6]])
    ids = [r[0] for r in spark.range(2 * n + 1).orderBy(F.xxhash64("id")).collect()]
    ids = [*ids[1:], ids[0]]  # the lone vector is the one that an audit of one would take
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, m, strict=True)], "vec_id long, embedding array<double>")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert near[:n, n:-1].any()
    got = {r["vec_id"]: r for r in embedding_dedup.dedup_embeddings(df).collect()}
    assert {got[i]["component_id"] for i in ids[:-1]} == {min(ids[:-1])} and got[ids[-1]]["component_id"] == ids[-1]
    assert all(got[i]["n_links"] == near[k].sum() - 1 for k, i in enumerate(ids))


def test_links_that_no_list_holds_are_found(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "links_of", lambda graph, points, least: points.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0))
    monkeypatch.setattr(embedding_dedup, "AUDIT", 8)
    rng = np.random.default_rng(5)
    m = rng.standard_normal((300, 16))
    m[150:] = m[:150] + rng.standard_normal((150, 16)) * 0.02
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.dedup_embeddings(vectors(spark, m)).collect()}
    assert all(got[i] == got[i + 150] <= i for i in range(150))


def test_block_column_is_block_of(spark):
    ids = np.array([0, 1, 5, 123456789012345, -7, 2**62 + 12345, -(2**63)], np.int64)
    df = spark.createDataFrame([(int(x),) for x in ids], "x long")
    assert [r[0] for r in df.select(neighbours.block_column("x", 977)).collect()] == neighbours.block_of(ids, 977).tolist()


# 9


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups(spark, mixed_docs):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    rows = list(mixed_docs)
    for i in range(300, 330):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(300)] = "changed"
        rows.append((i, " ".join(text)))
    got = simhash.simhash_groups(clash(documents(spark, rows))).collect()
    prints = {t: plain_fingerprint(t) for _, t in rows}
    assert Counter((r["doc_id"], r["fp"] % (1 << 64)) for r in got) == Counter((i, prints[t]) for i, t in rows)
    fps = sorted(set(prints.values()))
    root = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 2 and root[b] < root[a]:
                    root[a], changed = root[b], True
    least: dict = {}
    for i, t in rows:
        if i is not None:
            least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((i, least.get(root[prints[t]])) for i, t in rows)
    assert simhash.simhash_groups(documents(spark, [])).count() == 0


@pytest.mark.parametrize("radius,segments", [(0, 2), (2, 2), (4, 3)])
def test_every_near_pair_is_found(spark, radius, segments):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps):
        for _ in range(6):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 1))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.near_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), radius, segments).collect()
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) % (1 << 64)).bit_count() <= radius}
    assert sorted(map(tuple, got)) == sorted(want)


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(7, 7), (40, 1)]
    got = dict(map(tuple, graph.components(Workspace(spark, "t"), spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 41)}


# 10


def test_mixing_meets_targets(spark):
    rng = random.Random(8)
    kinds = {"a": ["al", "am", "an"], "b": ["be", "bo", "bu"], "c": ["ce", "co", "cu"]}
    rows = []
    for i in range(600):
        d = "a" if i % 3 else rng.choice("bc")
        rows.append((i, " ".join(rng.choice(kinds[d]) for _ in range(rng.randint(3, 40))), d, "s", 1))
    rows += [(700, None, None, "s", 0), (701, "", "b", "s", 0), (None, "al am", "a", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 600, 4)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    goal = [0.4, 0.35, 0.25]
    got = mixing.mix(clash(docs).drop("n_tokens"), labels, targets=dict(zip("abc", goal, strict=True))).collect()
    assert len(got) == len(rows) and min(r["rate"] for r in got) >= 0
    total = sum(r["n_tokens"] for r in got)
    for k in range(3):
        assert sum(r["rate"] * r["n_tokens"] * r["posterior"][k] for r in got) / total == pytest.approx(goal[k], abs=1e-3)
    assert np.mean([r["domain"] == dict((x[0], x[2]) for x in rows)[r["doc_id"]] for r in got if r["n_tokens"]]) > 0.97
    grown = mixing.mix(docs, labels, least=1.0, keep_total=False).collect()
    assert min(r["rate"] for r in grown) >= 1 and min(r["copies"] for r in grown) >= 1


@pytest.mark.parametrize("goal,sharp", [([0.8, 0.15, 0.05], 0.3), ([0.2, 0.5, 0.3], 3.0)])
def test_rates_are_the_optimum(spark, goal, sharp):
    rng = np.random.default_rng(3)
    n, p = rng.integers(1, 50, 60).astype(float), rng.dirichlet([sharp] * 3, 60)
    df = spark.createDataFrame([(k, int(a), [float(x) for x in b]) for k, (a, b) in enumerate(zip(n, p, strict=True))], "d int, n_tokens long, p array<double>")
    fitted, shares, _, reached = mixing.fit_rates(Workspace(spark, "rates"), df, lambda s: goal)
    got = np.array([r["rate"] for r in fitted.orderBy("d").collect()])
    r, share = np.ones(60), (n[:, None] * p).sum(0) / n.sum()
    for _ in range(20_000):
        r = np.maximum(0, r - p @ (((r * n) @ p / n.sum() - goal) / share))
    loss = lambda x: (((x * n) @ p / n.sum() - goal) ** 2 / share).sum()
    assert got.min() >= 0 and np.allclose(shares, share) and np.allclose((got * n) @ p / n.sum(), reached)
    assert loss(got) <= loss(r) + 1e-6 and np.allclose(reached, goal, rtol=2e-4)


def test_totals_that_can_not_be_met_show(spark):
    rng = np.random.default_rng(4)
    n, p = rng.integers(1, 50, 30).astype(float), rng.dirichlet([8.0] * 2, 30)
    df = spark.createDataFrame([(k, int(a), [float(x) for x in b]) for k, (a, b) in enumerate(zip(n, p, strict=True))], "d int, n_tokens long, p array<double>")
    fitted, shares, goal, reached = mixing.fit_rates(Workspace(spark, "rates"), df, lambda s: [0.99, 0.01], steps=12)
    got = np.array([r["rate"] for r in fitted.orderBy("d").collect()])
    assert np.allclose((got * n) @ p / n.sum(), reached) and goal == [0.99, 0.01] and shares[1] > reached[1] > 0.02


def test_posteriors_equal_a_plain_naive_bayes(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab cd ef gh ij Kl mn é".split()) for _ in range(rng.randint(0, 12))) for _ in range(40)] + [None, " \t"]
    rows = [(i, t, "xyz"[i % 3] if i % 7 else None, "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    words = {w for t in texts for w in (t or "").lower().split()}
    bucket = {r["w"]: r["b"] for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", mixing.bucket(F.col("w")).alias("b")).collect()}
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in mixing.mix(clash(docs).drop("n_tokens"), labels, lambda shares: shares).collect()}
    bags = {i: {w for w in (t or "").lower().split()} for i, t, *_ in rows}
    known = [(bags[i], d) for i, _, d, *_ in rows if i < 30 and d]
    counts = {d: Counter(bucket[w] for b, e in known if e == d for w in b) for d in "xyz"}
    for i, t, *_ in rows:
        s = []
        for d in "xyz":
            total = sum(counts[d].values())
            s.append(1024 * np.log(sum(e == d for _, e in known) / len(known)) + sum(np.round(1024 * np.log((counts[d][bucket[w]] + 1) / (total + mixing.BUCKETS))) for w in bags[i]))
        odds = np.exp((np.array(s) - max(s)) / 1024)
        assert got[i]["posterior"] == pytest.approx(odds / odds.sum()) and got[i]["n_tokens"] == len((t or "").split())
        assert got[i]["domain"] == "xyz"[int(np.argmax(got[i]["posterior"]))]
        assert got[i]["domain_reached"] == pytest.approx(got[i]["domain_target"]) and got[i]["rate"] == 1


def test_equal_posteriors_go_to_the_first_domain_and_unlisted_ones_keep_their_share(spark):
    docs = spark.createDataFrame([(i, "same words", "ab"[i % 2], "s", 0) for i in range(4)] + [(4, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels, {"b": 1.0}).collect()
    assert len(got) == 5 and {r["domain"] for r in got} == {"a"} and all(r["rate"] == pytest.approx(1) for r in got)
    assert mixing.weights_of({"a": 3.0, "b": 1.0}, ["a", "b", "c"])([0.2, 0.2, 0.6]) == pytest.approx([0.3, 0.1, 0.6])


def test_mixing_without_labels_or_rows(spark):
    docs, none = documents(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["rate"] for r in mixing.mix(docs, none).collect()] == [1.0, 1.0]
    assert mixing.mix(docs.limit(0), none).count() == 0


# pipeline


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    work = Workspace(spark, "pipeline-test")
    kept = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        kept.append(work.write(stage(spark, kept[-1], str(DATA)), f"s{k}"))
    assert all(d.columns == docs.columns for d in kept[:-1])
    good = [{r["doc_id"]: r["text"] for r in d.collect()} for d in kept[:-1]]
    labels = spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()
    clean = {r["doc_id"] for r in labels} & set(good[0])
    assert len(clean & set(good[1])) >= 0.97 * len(clean)
    assert set(good[2]) == set(good[1])
    prints = {i: plain_fingerprint(t) for i, t in good[2].items()}
    assert all(any((prints[i] ^ prints[j]).bit_count() <= 2 for j in prints if j < i) for i in set(good[2]) - set(good[3]))
    assert set(good[4]) == set(good[3])
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert kept[5].count() == kept[4].count()
    assert all(r["ids"] == library.encode(good[4][r["doc_id"]]) for r in kept[5].limit(50).collect())


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
@pytest.mark.parametrize("n", [60, 0])
def test_pipeline_stages_with_nulls_empties_repeats_and_clashing_names(spark, n):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(n)
    odd = [(None, "a text of no id\nwith two lines", "en", "s", None), (None, None, None, None, None), (5_000_000, "", "en", "s", 0), (5_000_001, None, None, "s", None), (5_000_002, " \n ", "en", "s", 3)]
    docs = docs.unionByName(spark.createDataFrame(odd if n else [], docs.schema)).unionAll(docs.limit(3))
    docs = clash(docs.drop("n_tokens")).selectExpr("*", "1 AS rated", "2 AS copies", "3 AS col", "4 AS kept_text", "5 AS rid", "6 AS `row`", "7 AS txt", "8 AS w", "9 AS expected_grade")
    for _, stage in cp.STAGES[:-1]:
        out = Workspace(spark, "odd").write(stage(spark, docs, str(DATA)), "out")
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes) and (out.count() > 0) == (n > 0)
        assert out.filter("doc_id IS NULL").count() in ((1, 2) if n else (0,))  # the one without a text is a near copy of others without
        docs = out
    assert cp.encoded(spark, docs, str(DATA)).count() == docs.count()


def test_near_copies_keep_one_row_of_each_group(spark):
    import corpus_pipeline as cp

    text = [" ".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=60)) for k in range(7)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (None, text[2]), (4, text[2]), (5, text[3]), (5, text[3]), (6, text[4]), (6, text[5]), (3, text[5]), (7, text[6])]
    kept = cp.near_copies(spark, documents(spark, rows), "").collect()
    want = [(None, text[0]), (None, text[1]), (4, text[2]), (5, text[3]), (6, text[4]), (3, text[5]), (7, text[6])]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in kept])) == sorted(map(str, want))
