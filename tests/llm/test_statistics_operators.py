"""Whitening, token counts and phrases against brute force, with awkward rows."""

from __future__ import annotations

import collections
import gzip
import io
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import arcwarc, common, linkgraph, phrases, tokencounts, whitening
from cardwatch.llm.wordtokens import tokenizer_path

SF = "/root/testdata/sf0.001"


# --- whitening --------------------------------------------------------------------------------
def plain_whitening(vectors, k=16):
    """(n, S, exact deviations, whitened, explained) of equally long vectors by eigh."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[float(n * c - t) / n for c, t in zip(v, s)] for v in fit])
    e, w = np.linalg.eigh(a.T @ a / n)
    e, w = e[::-1], w[:, ::-1]
    rank = int((e > 1e-14 * e[0]).sum())
    k = min(k, rank)
    rows = np.array([[float(n * c - t) / n for c, t in zip(v, s)] for v in x])
    dev = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    return n, dev, rows @ w[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def held_against(spark, vectors, tol=1e-7, **more):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>").repartition(3)
    got = whitening.whiten(df, **more).orderBy("vec_id", "component").collect()
    n, dev, z, explained = plain_whitening(vectors)
    k = z.shape[1]
    assert len(got) == len(vectors) * k
    mine = np.array([r["whitened"] for r in got]).reshape(-1, k)
    sign = np.sign((mine * z).sum(axis=0))
    assert np.abs(mine - z * sign).max() < tol
    assert {r["n"] for r in got} == {n}
    assert [int(r["deviation"] if r["deviation"] is not None else r["deviation_text"])
            for r in got[::k]] == dev
    assert np.allclose([r["explained"] for r in got[:k]], explained, rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]}
    assert got[0]["identity_error"] < 1e-9
    return got


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 20)) @ np.diag(1.3 ** np.arange(20))
    rows = [list(map(float, r)) for r in np.concatenate([v, v[:150], np.repeat(v[:1], 90, 0)])]
    held_against(spark, rows)


def test_whitening_of_badly_conditioned_rows(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 6)) @ np.diag([1e6, 1e4, 100.0, 1, 1, 0.2])
    v[:, 1] += v[:, 0]
    held_against(spark, [list(map(float, r)) for r in v], tol=1e-4)


def test_whitening_drops_directions_without_variance(spark):
    rng = np.random.default_rng(7)
    v = np.round(rng.normal(size=(200, 3)) * 10)
    flat = np.column_stack([v, v[:, 0] + v[:, 1], np.full(200, 3.0)])
    got = held_against(spark, [list(map(float, r)) for r in flat])
    assert {r["component"] for r in got} == {1, 2, 3}
    held_against(spark, [list(map(float, r)) for r in rng.normal(size=(4, 9))])  # n < length
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])],
                                 "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    good = [(i, list(map(float, r))) for i, r in enumerate(rng.normal(size=(50, 4)))]
    short = [(100 + i, list(map(float, r))) for i, r in enumerate(rng.normal(size=(30, 2)))]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [float("nan")] * 4),
           (204, [float("inf"), 0.0, 0.0, 0.0]), (None, good[0][1]), (3, good[3][1])]
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in good + short + odd],
                               "vec_id long, embedding array<double>, x int, `a.n` string")
    got = whitening.whiten(df).collect()
    count = collections.Counter(r["vec_id"] for r in got)
    assert count == {**{i: 4 for i, _ in good}, **{i: 2 for i, _ in short}, 3: 8, None: 4}
    assert {r["n"] for r in got} == {50, 30}
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.filter("vec_id >= 200")).columns == [f.name for f in whitening.OUT]


def test_whitening_of_extreme_numbers(spark):
    df = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])],
                               "vec_id long, embedding array<double>")
    got = whitening.whiten(df).filter("component = 1").orderBy("vec_id").collect()
    x = [[(1 << 62) + 10 ** 6, 64 + 10 ** 6], [-(1 << 62) + 10 ** 6, 128 + 10 ** 6],
         [10 ** 6, 320 + 10 ** 6]]
    s = [sum(c) for c in zip(*x)]
    want = [sum((3 * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    assert [int(r["deviation"] if r["deviation"] is not None else r["deviation_text"])
            for r in got] == want
    assert got[0]["deviation"] is None and got[2]["deviation"] == want[2]


def test_triangular_solve_and_factors():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(60, 7)) @ np.diag([1e5, 1, 1, 1, 1, 1, 1e-4])
    r, trace, far = whitening.r_factor(60, 7, lambda fs: (lambda q: q.T @ q)(
        whitening.orthogonal(fs)(a)))
    assert np.allclose(r.T @ r, a.T @ a, rtol=1e-9) and np.allclose(np.tril(r, -1), 0)
    assert np.allclose(whitening.solve_right(a, r) @ r, a) and trace == pytest.approx((a * a).sum())
    assert np.allclose(np.linalg.svd(r)[1], np.linalg.svd(a)[1], rtol=1e-10) and far[-1] < 1e-10


# --- token counts -------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def byte_bpe():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "<|endoftext|>", "'s", "'",
            "1", "12", "!", "日", "é", "　", "\r", "<|", "|>", "endoftext", "​", " ",
            "don't", "\0", "Word"]


def test_counts_of_odd_strings_equal_the_library(byte_bpe):
    r = random.Random(1)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 14))) for _ in range(20000)]
    texts += ["", " ", "x" * 50_000, "日" * 3000, "lorem ipsum " * 40_000, " " * 9000]
    want = [len(byte_bpe.encode(t, add_special_tokens=False)) for t in texts]
    c = tokencounts.Counter(tokenizer_path("byte_bpe_50k.json"))
    assert c.cut and tokencounts.group_counts(c, texts) == want
    small = tokencounts.Counter(tokenizer_path("byte_bpe_50k.json"), rows=50)
    assert tokencounts.group_counts(small, texts[:500]) == want[:500]


def test_token_counts_of_whole_texts(spark, byte_bpe):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (None, "a b"), (9003, "hi <|endoftext|>"),
                                 (9003, "hi <|endoftext|>")], docs.schema)
    both = docs.unionByName(odd).withColumns({"n_tokens": F.lit("x"), "a.b": F.lit(1)})
    rows = [(r["doc_id"], r["text"] or "") for r in both.collect()]
    want = collections.Counter()
    for i, t in rows:
        n = len(byte_bpe.encode(t, add_special_tokens=False))
        want[i, len(t.encode()), n, n > 1024] += 1
    got = tokencounts.token_counts(both)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert collections.Counter(map(tuple, got.collect())) == want
    assert tokencounts.token_counts(docs.limit(0)).count() == 0


def test_other_tokenizers_are_not_cut(byte_bpe):
    c = tokencounts.Counter(tokenizer_path("word_bpe_49k.json"))
    assert not c.cut
    texts = ["Hello  World", "a b\nc", ""]
    assert tokencounts.group_counts(c, texts) == [
        len(c.tok.encode(t, add_special_tokens=False)) for t in texts]


# --- phrases ----------------------------------------------------------------------------------
def plain_phrases(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, g), a in cand.items():
        cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        if any(o == lang and len(h) > len(g) and 100 * b >= 80 * a
               and any(h[i:i + len(g)] == g for i in range(len(h))) for (o, h), b in cand.items()):
            continue
        out[lang].append((score, a, " ".join(g), f[lang, g[:k]], f[lang, g[k:]]))
    got = []
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        got += [(lang, i, p, a, x, y, n[lang], s)
                for i, (s, a, p, x, y) in enumerate(found[:top], 1)]
    return sorted(got)


WORDS = ["the", "The", "of", "a", "new", "york", "city", "hall", "é", "日本", "x-1", "'s", "ＡB",
         "\x1c", "b\xa0c", "\xff"]


@pytest.fixture(scope="module")
def spoken():
    r = random.Random(3)
    rows = []
    for i in range(300):
        words = []
        for _ in range(r.randint(0, 120)):
            words += ["new", "york", "city", "hall"][:r.randint(1, 4)] if r.random() < .3 \
                else [r.choice(WORDS)]
            words.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r"]))
        lang = r.choice(["en"] * 4 + ["fr", None, "und", ""])
        rows.append((lang, " ".join(words)))
    return rows + [("en", None), ("en", ""), ("de", "one two"), ("en", "."), rows[0], rows[0]]


@pytest.mark.parametrize("block,least,top", [(500_000, 5, 2000), (60, 5, 7), (200, 1, 50)])
def test_phrases_equal_plain_counts(spark, spoken, block, least, top):
    df = spark.createDataFrame([(a, b, 1, "q") for a, b in spoken],
                               "lang string, text string, f int, `a.b` string").repartition(3)
    got = phrases.collocations(df, least=least, top=top, block_words=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(spoken, least, top)


def test_phrases_of_nothing(spark, spoken):
    df = spark.createDataFrame(spoken, "lang string, text string")
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df, least=10 ** 6).count() == 0


def test_tiles_count_every_pair():
    rng = np.random.default_rng(4)
    a = (rng.pareto(1.0, 40_000) * 20).astype(np.int64)
    b = (rng.pareto(1.0, 40_000) * 20).astype(np.int64)
    want = collections.Counter(zip(a.tolist(), b.tolist()))
    for tile, dense in ((64, 1 / 64), (16, 0.0), (1024, 2.0)):
        x, y, c, which = phrases.tile_counts(a, b, tile, dense)
        assert (x[which] == a).all() and (y[which] == b).all()
        got = list(zip(x.tolist(), y.tolist(), c.tolist()))
        assert len(got) == len(want) and {(p, q): n for p, q, n in got} == want
    assert len(phrases.tile_counts(a[:0], b[:0])[2]) == 0


def test_scores_beyond_64_bits(spark):
    big = 1 << 60
    df = spark.createDataFrame([(big, big, big + 5)], "f long, l long, r long")
    (got,) = df.select(*phrases.lowest_cut([("l", "r"), ("r", "l")])).collect()
    assert got["score"] == 2_000_000 * big // (2 * big + 5) and got["l"] == big


# --- archives that exist --------------------------------------------------------------------
def test_header_lines_with_spaces_and_fields_of_their_own():
    html = "text/html; charset=utf-8"
    for version in (1, 2):
        stream = arcwarc.arc_start("a.arc", version) + arcwarc.arc_record(
            "http://x.org/a b", b"one", version, html, "20010203040506", "1.2.3.4") \
            + arcwarc.arc_record("dns:x.org", b"two", version, "text/dns")
        (first, body), (second, _) = arcwarc.read_arc(io.BytesIO(stream))
        assert (first["URL"], first["IP-address"], first["Archive-date"], first["Content-type"],
                first["Archive-length"], body) == (
            "http://x.org/a b", "1.2.3.4", "20010203040506", html, "3", b"one")
        assert (second["URL"], second["Content-type"]) == ("dns:x.org", "text/dns")
        packed = io.BytesIO(gzip.compress(stream[:40]) + gzip.compress(stream[40:]))
        assert [b for _, b in arcwarc.read_arc(packed)] == [b"one", b"two"]
    body = b"1 0 other\nURL IP-address Archive-date Archive-length\n"
    own = b"filedesc://o 0.0.0.0 20010101 text/plain %d\n" % len(body) + body \
        + b"\nhttp://y.org/ 5.6.7.8 20020101000000 4\nbody\n"
    ((fields, got),) = arcwarc.read_arc(io.BytesIO(own))
    assert fields == {"URL": "http://y.org/", "IP-address": "5.6.7.8",
                      "Archive-date": "20020101000000", "Archive-length": "4"} and got == b"body"


def test_existing_archives_convert_an_archive_a_task(spark, tmp_path):
    want = collections.Counter()
    for k in range(12):
        data = arcwarc.arc_start(f"{k}.arc", 1 + k % 2)
        for n in range(k):
            text = f"<p>{k} {n % 3}</p>".encode()
            http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(text)
            data += arcwarc.arc_record(f"http://h{k}/", http + text, 1 + k % 2, "text/html; a=b")
            want[arcwarc.digest(text)] += 1
        (tmp_path / f"{k}.arc{'.gz' if k % 3 == 0 else ''}").write_bytes(
            gzip.compress(data) if k % 3 == 0 else data)
    paths = [(str(p),) for p in sorted(tmp_path.iterdir())]
    df = spark.createDataFrame([*paths, (None,), paths[5]], "path string")
    manifest = arcwarc.convert_files(df, common.scratch_path(spark, "converted"), file_bytes=900)
    rows = arcwarc.read(manifest)
    assert rows.rdd.getNumPartitions() == manifest.count() > 12
    got = rows.collect()
    assert collections.Counter(r["payload_digest"] for r in got) == want
    ids = set()
    for (path,) in manifest.select("path").collect():
        fs, at = common.open_fs(path)
        with fs.open_input_stream(at, compression=None) as f:
            ids |= {arcwarc.parse_warc(r)[0]["WARC-Record-ID"] for r in arcwarc.read_members(f)}
    assert len(ids) == len(got) == sum(range(12))
    assert arcwarc.convert_files(df.limit(0), common.scratch_path(spark, "none")).count() == 0


def test_hadoop_names_of_s3(monkeypatch):
    seen = []
    fake = type("F", (), {"from_uri": staticmethod(seen.append)})
    monkeypatch.setattr(common.pafs, "FileSystem", fake)
    for scheme in ("s3a", "s3n", "s3", "hdfs"):
        common.open_fs(f"{scheme}://b/x")
    assert seen == ["s3://b/x", "s3://b/x", "s3://b/x", "hdfs://b/x"]


# --- link graph -------------------------------------------------------------------------------
def test_verdicts_do_not_depend_on_unrelated_seeds(spark):
    links = "".join(f'<a href="http://n{k}.net/">' for k in range(50))
    pages = [("http://h.com/fr/1", ""), ("http://h.com/x", links + '<a href="http://bad.com/de/">'),
             ("http://bad.com/de/1", ""), ("http://bad.com/y", ""), ("http://n3.net/", ""),
             ("http://spam.net/", '<a href="http://bad.com/de/1">')]
    seen = set()
    for n in (0, 2, 300):
        more = [(f"http://u{k}.org/", "") for k in range(n)] + [
            (f"http://v{k}.com/de/", "") for k in range(n // 3)]
        df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages + more)],
                                   "page_id long, url string, html string")
        got = linkgraph.judge(df).filter(f"page_id < {len(pages)}").collect()
        seen.add(tuple(r["verdict"] for r in sorted(got)))
    assert seen == {("allow", "allow", "block", "block", "allow", "block")}


def test_pairs_of_a_block_travel_packed():
    rng = np.random.default_rng(8)
    ids = rng.integers(0, 3000, 200_000) * ((1 << 33) + 7)
    f = np.bincount(ids // ((1 << 33) + 7))[ids // ((1 << 33) + 7)]
    rows = [r for batch in phrases.pair_rows(5, ids, f, 64) for r in batch.to_pylist()]
    pairs = [r for r in rows if r["seq"] is None]
    assert len(pairs) <= 64
    want = collections.Counter((a, b) for a, b in zip(ids.tolist(), ids[1:].tolist()) if a and b)
    got, place = {}, {}
    for r in pairs:
        a, b, c = np.cumsum(phrases.unpacked(r["a"])), *map(phrases.unpacked, (r["b"], r["c"]))
        for k, (x, y, n) in enumerate(zip(a.tolist(), b.tolist(), c.tolist()), r["pos"]):
            got[x, y], place[k] = n, (x, y)
    assert got == want
    seq = phrases.unpacked(rows[-1]["seq"])
    assert collections.Counter(place[k] for k in seq.tolist() if k) == want
    assert sum(len(r[c]) for r in pairs for c in "abc") < 8 * len(want)
