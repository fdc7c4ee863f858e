"""The corpus operators against brute force, on small fixtures with awkward rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import io
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cardwatch.llm import (annforest, arcwarc, bytehash, langid, linkgraph, packing, pieces,
                           quality, simhash, suffixdedup, tokenstore, wordtokens)

SF = "/root/testdata/sf0.001"
WEIRD = ["", None, "a  b", " lead", "trail ", "é é ﬁ Ａ a\xa0b \u3000x", "<|endoftext|> hi",
         "\x1c\x1d a\x1eb\x85c", "Σας ΟΔΟΣ", "don't 's 'll we're12 3.4", "\n\n\t\r\x0b\x0c a",
         "▁x ▁", "İstanbul", "a\u0301\u0144 b", "\0 nul", "   ", "日本語 テキスト", "<s> </s>",
         "It's,THE End!!", "12. 34;;", "word " * 3000]


@pytest.fixture(scope="module")
def rows(spark):
    got = [(r["doc_id"], r["text"]) for r in
           spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return got + [(5000 + k, t) for k, t in enumerate(WEIRD)] + [(None, "no id"), (3, "again"),
                                                                 (3, "again")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- language -------------------------------------------------------------------------------
def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("n", [30, 60, 200])
def test_language_of_small_inputs(spark, n):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = langid.language_id(docs).filter("held_out").join(docs, "doc_id").filter(
        "lang IS NOT NULL").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= (0.95 if n > 60 else 0.9)
    kept = {r["doc_id"] for r in c.language_id(spark, docs, SF).collect()}
    assert kept == {r["doc_id"] for r in docs.filter(r"text RLIKE '\\p{L}'").collect()}


def test_language_network_equals_plain_convolution():
    rng = np.random.default_rng(2)
    p, _ = langid.started(list("abc"), 5)
    p = {k: v + rng.normal(0, 0.1, v.shape) for k, v in p.items()}
    x = rng.integers(0, 256, (6, langid.WINDOW)).astype(np.uint8)
    y, weight = np.array([0, 1, 2, 0, 1, 2]), np.array([1.0, 2, 0.5, 1, 1, 3])
    plain = np.zeros((6, 3))
    for n in range(6):
        pooled = [max(sum(p["E"][x[n, at + j]] @ p[f"W{w}"][j * langid.EMBED:(j + 1) * langid.EMBED,
                                                            f] for j in range(w))
                      for at in range(langid.WINDOW - w + 1)) + p[f"c{w}"][f]
                  for w in langid.WIDTHS for f in range(langid.FILTERS)]
        logit = np.maximum(pooled, 0) @ p["V"] + p["b"]
        plain[n] = np.exp(logit - logit.max()) / np.exp(logit - logit.max()).sum()
    loss, g, prob = langid.gradients(p, x, y, weight)
    assert np.allclose(prob, plain)
    assert np.allclose(langid.probabilities(langid.compiled({"labels": list("abc"), **p}), x), plain)
    assert np.isclose(loss, -(weight * np.log(plain[np.arange(6), y])).mean())
    for k, v in p.items():
        for at in zip(*(rng.choice(np.argwhere(g[k] != 0), 5).T)):
            step = 1e-6
            up, down = {**p, k: v.copy()}, {**p, k: v.copy()}
            up[k][at] += step
            down[k][at] -= step
            slope = (langid.gradients(up, x, y, weight)[0]
                     - langid.gradients(down, x, y, weight)[0]) / (2 * step)
            assert np.isclose(slope, g[k][at], rtol=1e-3, atol=1e-6), (k, at)


def test_language_without_letters_or_labels(spark):
    df = spark.createDataFrame([(1, None, None), (2, "12 !?", "en"), (3, "", "de")],
                               "doc_id long, text string, lang string")
    assert listed(langid.language_id(df).select("doc_id", "lang_pred", "score")) == [
        (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert langid.language_id(df.limit(0)).count() == 0


def test_language_stage_keeps_all_where_nothing_is_learned(spark):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert listed(c.language_id(spark, blank, SF)) == listed(blank)


def test_language_stage_with_mixed_texts(spark):
    import corpus_pipeline as c
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = [r["t"] for r in docs.filter("length(text) > 700").groupBy("lang").agg(
        F.min_by("text", "doc_id").alias("t")).orderBy("lang").collect()]
    assert len(parts) == 4
    two, four = ("".join(t[:640] for t in parts[:k]) for k in (2, 4))
    mixed = docs.limit(2).withColumns({
        "doc_id": F.when(F.col("doc_id") == docs.first()["doc_id"], 9001).otherwise(9002),
        "lang": F.lit(None).cast("string")}).withColumn(
        "text", F.when(F.col("doc_id") == 9001, two).otherwise(four))
    got = {r["doc_id"] for r in c.language_id(spark, docs.unionByName(mixed), SF)
           .select("doc_id").collect()}
    assert 9001 in got and 9002 not in got


# --- quality --------------------------------------------------------------------------------
def base_signals(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_quality_signals_and_verdict(docs, rows):
    got = quality.quality_rules(docs)
    want = sorted([(i, *base_signals(t)) for i, t in rows], key=str)
    assert listed(got.select("doc_id", *quality.SIGNALS, "base_failed")) == want
    assert got.filter("base_failed AND kept").isEmpty()
    kept = collections.Counter(r[0] for r in got.filter("kept").select("doc_id").collect())
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r[0] for r in out.select("doc_id").collect()) == kept
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_quality_em_tells_junk_from_text():
    good, junk = [1] * 7, [-1, 1, 1, 1, 1, 1, 1]
    m = quality.em([(*good, 900), (*junk, 60), (*[1, 1, 1, -1, -1, 1, 1], 40)])
    assert quality.posterior_of(good, m["good"], m["bad_vote"]) > 0.9
    assert quality.posterior_of(junk, m["good"], m["bad_vote"]) < 0.5


def test_quality_bounds_reject_every_document_labelled_bad(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = quality.signals(spark.read.parquet(f"{sf}/documents.parquet"))
    got = quality.judged(got, quality.fit(got)).select("row.doc_id", "base_failed", "kept").join(
        labels, "doc_id")
    assert got.filter("quality = 0").count() == 58
    assert got.filter("quality = 0 AND kept").isEmpty()
    assert got.filter("quality = 1 AND NOT kept AND NOT base_failed").isEmpty()


@pytest.mark.parametrize("share", [500, 1000])
def test_quality_bounds_with_an_inaccurate_rule(share, monkeypatch):
    """The price of the bounds: votes alone do not tell these from documents labelled bad."""
    good, one, junk = [1] * 7, [1, 1, 1, 1, 1, -1, 1], [-1, 1, 1, 1, -1, -1, 1]
    counts = [(*good, 9800 - share), (*one, share), (*junk, 200)]

    def posteriors():
        m = quality.em(counts)
        return [quality.posterior_of(v, m["good"], m["bad_vote"]) for v in (good, one, junk)]

    a, b, c = posteriors()
    assert a > 0.9 and b < 0.5 and c < 0.01
    monkeypatch.setattr(quality, "GOOD_BOUNDS", (0.0, 1.0))
    monkeypatch.setattr(quality, "BAD_BOUNDS", (0.0, 1.0))
    a, b, c = posteriors()
    assert a > 0.9 and b > 0.9 and c < 0.01


# --- tokens ---------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def ids(rows):
    enc = wordtokens.Encoder(wordtokens.tokenizer_path())
    plain = enc.tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    want = [np.array(e.ids + [2], "<u4").tobytes() for e in plain]
    assert [enc.id_bytes(t) for _, t in rows] == want
    small = wordtokens.Encoder(wordtokens.tokenizer_path(), rows=5)
    assert [small.id_bytes(t) for _, t in rows[:20] + rows[-20:]] == want[:20] + want[-20:]
    return list(zip([i for i, _ in rows], want))


def test_token_store_round_trip(docs, ids):
    got = tokenstore.round_trip(docs).collect()
    assert sorted([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got], key=str) == sorted(
        [(i, len(b) // 4, zlib.crc32(b)) for i, b in ids], key=str)
    got.sort(key=lambda r: r["start"])
    at, last = 0, -1
    for r in got:
        assert r["start"] == at and (r["doc_id"] is None or r["doc_id"] >= last)
        at, last = at + r["n_tokens"], last if r["doc_id"] is None else r["doc_id"]
    assert tokenstore.round_trip(docs.limit(0)).count() == 0


def test_packing_places_every_id_once_without_padding(docs, ids):
    got = packing.pack(docs).collect()
    assert sum(r["length"] for r in got) == sum(len(b) // 4 for _, b in ids)
    seqs, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for v in seqs.values():
        at = 0
        for r in sorted(v, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and at & (at - 1) == 0
    for i, b in ids:
        if i != 3:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(b) // 4
                at += r["length"]
                assert r["ids_crc32"] == zlib.crc32(b[4 * r["start"]:4 * at])
            assert at == len(b) // 4
    assert packing.pack(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 16, 211])
def test_packing_balances_step_groups_over_all_tasks(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts)
    got = packing.pack(docs).groupBy("sequence_id", "tier", "step_group").agg(
        F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] == r["tier"] for r in got)
    tokens, tier = collections.Counter(), {}
    for r in got:
        tokens[r["step_group"]] += r["n"]
        assert tier.setdefault(r["step_group"], r["tier"]) == r["tier"]
    assert max(tokens.values()) == packing.GROUP_TOKENS
    short = sum(n for n in tokens.values() if n < packing.GROUP_TOKENS)
    small = sum(r["n"] for r in got if r["tier"] < min(packing.TIERS))
    print(parts, sum(tokens.values()), short, small)
    fans = -(-parts // packing.FAN_IN)
    assert short < fans * (packing.GROUP_TOKENS + packing.TIERS[-1]) and small < fans * 4096
    assert short <= 0.05 * sum(tokens.values())


def test_pieces_equal_the_library(docs, rows):
    p = pieces.Pieces(wordtokens.tokenizer_path("piece_bpe_32k.model"))
    assert p.cut
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        x = p.model.encode(t or "")
        assert p.encode(t) == x
        want.append((i, len(x), sha(",".join(map(str, x))), sha(p.model.decode(x))))
    assert listed(pieces.round_trip(docs)) == sorted(want, key=str)


# --- vectors --------------------------------------------------------------------------------
def test_forest_recall_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(3000, 32)).tolist()
    v[7] = v[50] = v[51] = v[900] = v[100]
    data = [(k, x) for k, x in enumerate(v)] + [
        (4000, None), (4050, [0.0] * 32), (4100, [float("nan")] * 32), (4150, [None] * 32),
        (None, v[1]), (4200, [1.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = annforest.search(df, df.filter("vec_id % 50 = 0"), shard_rows=1200).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r["query_id"]].append(r)
    m = np.array(v)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hit = total = 0
    for q in range(0, 3000, 50):
        s = m @ m[q]
        s[q] = -9
        best = sorted(zip(-s.round(12), range(3000)))[:5]
        hit += len({k for _, k in best} & {r["vec_id"] for r in by[q]})
        total += 5
        assert [r["rank"] for r in by[q]] == [1, 2, 3, 4, 5]
        assert np.allclose([r["score"] for r in by[q]], [s[r["vec_id"]] for r in by[q]])
    assert hit / total >= 0.9
    assert [r["vec_id"] for r in by[50]][:4] == [7, 51, 100, 900]
    assert not {4000, 4050, 4100, 4150} & set(by) and 4200 not in by


@pytest.mark.parametrize("n", [2, 3, 5, 20, 71, 80, 150, 200])
def test_forest_scores_small_shards_whole(n):
    v = np.random.default_rng(n).normal(size=(n, 32))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    forest = annforest.Forest(np.arange(n), v)
    for q, key in enumerate(forest.keys(unit.astype(np.float32))):
        s = unit @ unit[q]
        want = sorted((-x, i) for i, x in enumerate(s) if i != q)[:5]
        assert [i for i, _ in forest.search(q, v[q], key, 5)] == [i for _, i in want]


def test_forest_with_very_large_and_very_small_vectors(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 16))
    size = np.array([1e-300, 1e-200, 1.0, 1e200, 1e300])[np.arange(300) % 5]
    df = spark.createDataFrame([(k, (x * z).tolist()) for k, (x, z) in enumerate(zip(v, size))],
                               "vec_id long, embedding array<double>")
    got = annforest.search(df, df.filter("vec_id % 50 IN (0, 1, 2, 3, 4)")).collect()
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in {r["query_id"] for r in got}:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        s = unit @ unit[q]
        s[q] = -9
        assert [i for _, i, _ in mine] == np.argsort(-s)[:5].tolist()
        assert np.allclose([x for _, _, x in mine], np.sort(s)[::-1][:5])
    assert len(got) == 30 * 5


def test_forest_finds_neighbours_of_a_rare_length(spark):
    rng = np.random.default_rng(5)
    v = [rng.normal(size=8 if k % 100 == 0 else 32).tolist() for k in range(3000)]
    df = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    got = annforest.search(df, df.filter("vec_id % 500 = 0"), shard_rows=1000).collect()
    rare = np.array(v[::100])
    rare /= np.linalg.norm(rare, axis=1, keepdims=True)
    for q in range(0, 3000, 500):
        s = rare @ rare[q // 100]
        s[q // 100] = -9
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])
                if r["query_id"] == q] == (100 * np.argsort(-s)[:5]).tolist()


# --- archives -------------------------------------------------------------------------------
def test_both_arc_versions_convert():
    for version in (1, 2):
        stream = arcwarc.arc_start("a.arc", version) + arcwarc.arc_record(
            "http://x.org/a b", b"HTTP/1.1 200 OK\r\n\r\nbody\n\nmore", version) \
            + arcwarc.arc_record("dns:x.org", b"1.2.3.4", version, "text/dns")
        one, two = map(arcwarc.parse_warc, arcwarc.convert(io.BytesIO(stream)))
        assert one[0]["WARC-Type"] == "response" and one[0]["WARC-Date"] == "2024-01-01T00:00:00Z"
        assert one[0]["WARC-Target-URI"] == "http://x.org/a b"
        assert one[0]["WARC-Payload-Digest"] == "sha1:" + arcwarc.digest(b"body\n\nmore")
        assert two[0]["WARC-Type"] == "resource" and two[1] == b"1.2.3.4"
        with pytest.raises(ValueError):
            list(arcwarc.convert(io.BytesIO(stream[:-10])))


def test_warc_round_trip(spark):
    data = [(r["page_id"], r["url"], r["html"]) for r in
            spark.read.parquet(f"{SF}/pages.parquet").collect()]
    data += [(900, None, None), (901, "x y://a b\n/z?", "<a>"), (902, "HTTP://Ex.org", "<a>"),
             (None, "q", "<a>"), (None, "q2", "zz"), (903, "", "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    first = {}
    for i, _, h in data:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in data:
        b, f = (h or "").encode(), first.get(h or "")
        again = f is not None and f != i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                     "revisit" if again else "response", f if again else None))
    assert listed(arcwarc.round_trip(df).drop("target_uri")) == sorted(want, key=str)
    assert arcwarc.round_trip(df, min_bytes=1 << 30).filter(
        "record_type = 'revisit'").isEmpty()
    # repeated ids: one response a payload, identifiers of their own
    twins = spark.createDataFrame(
        [(7, "a", "one"), (7, "b", "one"), (7, "b", "one"), (8, "c", "one"), (7, "a", "two"),
         (9, "d", "three"), (9, "d", "three"), (None, "e", "three"), (None, "f", "four"),
         (None, "f", "four")], df.schema).repartition(3)
    folder = arcwarc.scratch_path(spark, "warc")
    manifest = arcwarc.write(twins, folder)
    assert collections.Counter(
        (r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"])
        for r in arcwarc.read(manifest).collect()) == {
        (7, 3, "response", None): 2, (7, 3, "revisit", 7): 2, (8, 3, "revisit", 7): 1,
        (9, 5, "response", None): 1, (9, 5, "revisit", 9): 1, (None, 5, "revisit", 9): 1,
        (None, 4, "response", None): 2}
    ids, known = [], []
    for r in manifest.collect():
        fs, at = arcwarc.open_fs(r["path"])
        with fs.open_input_stream(at, compression=None) as f:
            for fields, _ in map(arcwarc.parse_warc, arcwarc.read_members(f)):
                ids.append(fields["WARC-Record-ID"])
                known += [fields["WARC-Refers-To"]] if "WARC-Refers-To" in fields else []
    assert len(ids) == len(set(ids)) == 10 and len(known) == 5 and set(known) <= set(ids)
    assert arcwarc.round_trip(twins, min_bytes=1 << 30).count() == 10
    assert arcwarc.round_trip(df.limit(0)).count() == 0


# --- repeats --------------------------------------------------------------------------------
def repeats(rows, length=200):
    c = collections.Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        c.update(b[s:s + length] for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        m = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if c[b[s:s + length]] > 1:
                m[s:s + length] = True
        keep = bytes(x for x, y in zip(b, m) if not y)
        out.append((i, len(b), int(m.sum()), int((np.diff(m.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(keep).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, hot", [(suffixdedup.CHUNK, 4096), (20_000, 3)])
def test_suffix_dedup(spark, rows, monkeypatch, chunk, hot):
    rnd = random.Random(1)
    base = rows[0][1]
    line = "common line of text that stands in very many documents, eighty bytes or so of it. "
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    some = rows[:60] + rows[-10:] + [
        (1000 + k, rows[k][1][:300] + noise(rnd.randrange(300)) + base[rnd.randrange(500):][
            :rnd.randrange(150, 600)]) for k in range(40)]
    some += [(2000, "a" * 1000), (2001, "a" * 199), (2002, "a" * 200), (2005, "ab" * 300),
             (7, "zz"), (7, "é" * 150), (None, base)]
    some += [(3000 + k, noise(150) + line + noise(150 + k)) for k in range(20)]
    some += [(3100 + k, some[-20 + k][1][20 + k:400]) for k in range(20)]
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    assert listed(suffixdedup.repeat_digest(df, chunk=chunk, hot_group=hot)) == repeats(some)
    kept = suffixdedup.remove_repeats(df, chunk=chunk)
    assert kept.columns == df.columns and kept.count() == len(some)


def test_blocks_of_a_long_text_choose_the_same_anchors():
    data = np.random.default_rng(2).integers(97, 100, 5000).astype(np.uint8)
    whole = bytehash.anchors(data, 200, 64)
    for block in (37, 1000, 4801):
        got = bytehash.anchors(data, 200, 64, block)
        for k in (0, 3):  # place and gram of each window
            assert (np.repeat(got[k], got[2]) == np.repeat(whole[k], whole[2])).all()
        assert (got[1] == np.cumsum(got[2]) - got[2]).all()


def test_merge_sort_equals_plain_sort():
    rnd = random.Random(5)
    data = bytes(rnd.choice(b"ab") for _ in range(3000)) + bytes(64)
    s = suffixdedup.Suffixes(data, 64)
    pos = np.array(rnd.sample(range(3000), 500))
    seg = np.sort(np.array([rnd.randrange(7) for _ in pos]))
    order = s.merge_sort(pos, seg)
    assert (seg[order] == seg).all()
    assert [data[p:p + 64] for p in pos[order]] == [x for k in range(7) for x in sorted(
        data[p:p + 64] for p in pos[seg == k])]


# --- links ----------------------------------------------------------------------------------
def test_rules_and_spread_of_trust(spark):
    a = lambda h: f'<a href="http://{h}/x">'
    data = [(1, "http://good.org/", a("friend.net")), (2, "http://friend.net/en", ""),
            (3, "http://bad.com/de/1", ""), (4, "http://fan.net/en", a("bad.com") * 3),
            (5, "http://X.Example.org/es/q", None), (6, "http://example.org/en/19?x", ""),
            (7, "http://notexample.org/en/19", ""), (8, "http://q.com/fr/", ""), (9, None, None),
            (10, "no scheme", ""), (11, "http://org", ""), (12, "http://lone.net/", ""),
            (13, "http://bad.com/en/", "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in linkgraph.judge(df).collect()}
    assert [(got[k]["rule"], got[k]["verdict"]) for k in range(1, 14)] == [
        ("org/", "allow"), (None, "allow"), ("com/de/", "block"), (None, "block"),
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"),
        ("com/fr/", "allow"), (None, "allow"), (None, "allow"), (None, "allow"),
        (None, "allow"), (None, "block")]
    assert got[5]["host"] == "x.example.org" and got[6]["path"] == "/en/19"
    assert linkgraph.judge(df.limit(0)).count() == 0


def test_page_rank_equals_plain_iteration(spark):
    edges = [("g", "a", "b", 2), ("g", "a", "c", 1), ("g", "b", "c", 1), ("g", "c", "a", 1)]
    e = spark.createDataFrame(edges, "graph string, src string, dst string, n long")
    s = spark.createDataFrame([("g", "a", 1.0)], "graph string, host string, mass double")
    r = {"a": 1.0, "b": 0.0, "c": 0.0}
    for _ in range(linkgraph.ROUNDS):
        r = {"a": .15 + .85 * r["c"], "b": .85 * r["a"] * 2 / 3,
             "c": .85 * (r["a"] / 3 + r["b"])}
    got = {x["host"]: x["rank"] for x in linkgraph.page_rank(e, s).collect()}
    assert all(abs(got[k] - r[k]) < 1e-12 for k in r)


def test_links_of_any_case_and_without_scheme(spark):
    html = ("<A HREF='HTTP://One.net/x'> <IMG SRC=//two.net/y.png> <a href=\"//three.net?q\">"
            "<a href='/four.net//x'> <a href='five.net//x'> <Script Src = \" https://six.net\">")
    pages = spark.createDataFrame([("a.org", html), ("b.org", "<a href=//c.org>"), ("d.org", "x"),
                                   ("e.org", None)], "host string, html string")
    assert listed(linkgraph.host_edges(pages)) == [
        ("a.org", "one.net", 1), ("a.org", "six.net", 1), ("a.org", "three.net", 1),
        ("a.org", "two.net", 1), ("b.org", "c.org", 1)]


def test_distrust_reaches_along_long_chains(spark):
    forms = ['<a href="http://{}/x">', '<A HREF="http://{}/x">', '<a href="//{}/x">']
    hosts = ["bad.com", *[f"h{k}.net" for k in range(1, 13)]]
    data = [(0, "http://bad.com/de/1", "")] + [
        (k, f"http://{hosts[k]}/", forms[k % 3].format(hosts[k - 1])) for k in range(1, 13)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    assert {r["verdict"] for r in linkgraph.judge(df).collect()} == {"block"}


# --- near-duplicates ------------------------------------------------------------------------
def plain_fingerprint(t):
    b = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", b)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, bits=4):
    x, par = np.array(fps, np.uint64), list(range(len(fps)))

    def find(k):
        while par[k] != k:
            k = par[k]
        return k

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= bits):
            par[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("kw", [{}, {"leaf_rows": 20, "shard_rows": 30},
                                {"margin": 1, "leaf_rows": 50}])
def test_simhash_components(docs, rows, kw):
    got = simhash.components(docs, **kw).collect()
    fps = [int(r["fingerprint"], 16) for r in got]
    assert sorted(fps) == sorted(plain_fingerprint(t) for _, t in rows)
    assert [r["component_id"] for r in got] == plain_components(fps, [r["doc_id"] for r in got])


def test_simhash_keeps_one_row_of_each_group(spark):
    text = " ".join(f"w{k}" for k in range(200))
    data = [(2, text, "x"), (1, text.upper(), "y"), (1, text.upper(), "y"), (None, text, "z"),
            (9, "other words here and there", "x"), (None, None, None), (4, "", "e")]
    df = spark.createDataFrame(data, "doc_id long, text string, fp string")
    assert listed(simhash.keep_first_of_group(df).select("doc_id", "fp")) == sorted(
        [(1, "y"), (9, "x"), (4, "e")], key=str)
    assert simhash.keep_first_of_group(df.limit(0)).count() == 0


def test_stars_join_however_long_the_chain(spark):
    order = np.random.default_rng(4).permutation(700).tolist()
    edges = [(a, b) for a, b in zip(order, order[1:])] + [(-5, -7), (-6, -5)]
    got = simhash.connect(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r["u"], r["root"]) for r in got if r["u"] >= 0} >= {(k, 0) for k in range(1, 700)}
    assert {r["root"] for r in got if r["u"] < 0} == {-7} and all(
        r["root"] in (0, -7) for r in got)


# --- pipeline -------------------------------------------------------------------------------
@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_pipeline_stages_keep_odd_columns(spark, stage):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = docs.select("*", F.lit(1).alias("a.b"), F.lit("x").alias("t"), F.lit(None).cast(
        "string").alias("row"), F.lit(2).alias("fp"))
    name, run = c.STAGES[stage]
    assert run(spark, odd, SF).columns == odd.columns
    assert run(spark, odd.limit(0), SF).count() == 0
    got = run(spark, odd, SF).collect()
    assert got and all((r["a.b"], r["t"], r["row"], r["fp"]) == (1, "x", None, 2) for r in got)


def test_pipeline_equals_stage_by_stage_brute_force(spark):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in c.STAGES[:3]:
        before = docs
        docs = c.materialize(stage(spark, docs, SF), name)
        assert docs.columns == before.columns
    near = docs.select("doc_id", "text").collect()
    ids = [r["doc_id"] for r in near]
    assert plain_components([plain_fingerprint(r["text"]) for r in near], ids) == ids
    out = c.materialize(c.suffix_array_dedup(spark, docs, SF), "suffix")
    want = {i: (n - gone, sha) for i, n, gone, _, sha in repeats(
        [(r["doc_id"], r["text"]) for r in near])}
    for r in out.collect():
        size, sha = want[r["doc_id"]]
        if size == len(r["text"].encode()):
            assert hashlib.sha256(r["text"].encode()).hexdigest() == sha
        else:  # a cut through a character drops what is left of it
            assert size - 12 < len(r["text"].encode()) < size
        assert r["n_chars"] == len(r["text"])
    last = c.pack(spark, out, SF)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == set(ids)
    assert c.run(spark, SF).count() == last.count()


# --- memory and samples ----------------------------------------------------------------------
def test_packing_leaves_no_tables_in_its_worker(monkeypatch):
    import types
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(50))) for k in range(40)]
    want = {i: wordtokens.encoder(wordtokens.tokenizer_path()).id_bytes(t) for i, t in rows}
    monkeypatch.setattr(packing, "TABLE_ENTRIES", 100)
    monkeypatch.setattr(packing, "TaskContext", types.SimpleNamespace(
        get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    path = wordtokens.tokenizer_path()
    enc, most = wordtokens.encoder(path), 0

    def batches():
        nonlocal most
        for r in rows:
            yield pa.record_batch([pa.array([r[0]]), pa.array([r[1]])], names=["i", "t"])
            most = max(most, enc.entries())
    got = [x for b in packing._packed(path, 2, packing.TIERS, 1 << 21, 1 << 15)(batches())
           for x in b.to_pylist()]
    assert most <= 100 + 200 and enc.entries() == 0
    assert b"".join(x["ids"] for x in sorted(got, key=lambda x: (x["doc_id"], x["start"]))) == \
        b"".join(want[i] for i, _ in rows)


def test_language_learns_from_every_window(spark, monkeypatch):
    # The only window that tells is one of many in its text, and any text may be the only one.
    seen = []

    def noted(p, x, y, weight):
        seen.extend(zip(x.tobytes().decode("latin-1")[k * langid.WINDOW:(k + 1) * langid.WINDOW]
                        for k in range(len(x))))
        return 0.0, {k: np.zeros_like(v) for k, v in p.items()}, None
    monkeypatch.setattr(langid, "gradients", noted)
    texts = ["".join(chr(97 + (k + j // langid.WINDOW) % 26) for j in range(langid.WINDOW * 30))
             for k in range(5)]
    train = langid._trained(langid.started(["a"], 1)[0], ["a"], np.ones(1), 1, 1)
    (out,) = train([pa.record_batch([pa.array(texts), pa.array(["a"] * 5)], names=["t", "y"])])
    assert len(seen) == 150 and out.column("n")[0].as_py() == 150
    assert sorted(w for (w,) in seen) == sorted(
        t[k:k + langid.WINDOW] for t in texts for k in range(0, len(t), langid.WINDOW))


def test_language_in_several_tasks_does_not_depend_on_files(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 30)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = (langid.fit(x) for x in (docs.orderBy("lang"), docs.repartition(7, "text")))
    assert all(np.array_equal(one[k], two[k]) for k in one)
    got = langid.identify(docs.filter(langid.held_out()), one).select("row.lang", "lang_pred")
    assert np.mean([a == b for a, b in got.collect()]) > 0.9


def test_language_score_is_calibrated_on_all_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    scores = sorted(r["score"] for r in langid.identify(
        docs.filter(langid.held_out()), model).collect())
    low = scores[(len(scores) - 1) // 100]
    got = langid.calibrated(docs, model, 1.0)
    assert 0.9 * (low - 1e-4) <= got <= 0.9 * low
