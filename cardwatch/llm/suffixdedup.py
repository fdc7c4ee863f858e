"""Removal of long repeated byte strings with a hash-compared suffix sort.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else,
in the same text or another. Strings are judged on the input texts.

1. Each text is cut at content-chosen anchors (:func:`bytehash.anchors`): equal strings
   choose the same anchor, so they can only meet among pieces with the same anchor gram.
2. Pieces that are equal as a whole repeat with every string in them. Map tasks combine
   them (checking bytes), so a passage that a third of all documents share sends one row
   from each task; one shuffle by gram finds the rest, by equal 64-bit hashes.
3. Where pieces with the same gram differ, the suffixes at their possible string starts
   are sorted: prefix polynomial hashes and binary search give the common extension of two
   suffixes in O(log length), a merge sort uses it as comparison, and neighbours whose
   common extension reaches ``length`` repeat, after a check of their bytes.
   Grams with very many different pieces (text around a common line) would put one
   group into one task: those count the 64-bit hashes of all their strings instead.
4. Spans are gathered by document and cut out.

Defined cases: null texts count as empty; texts below ``length`` bytes lose nothing;
repeated rows repeat each other's text. Rows are told apart by (id, hash of the text), so
null or repeated ids do no harm. Empty tables give empty results. Other columns are kept
by :func:`remove_repeats`, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import anchors, mixed, prefix, spans
from .common import batches_of, materialize, record_batch, trimmed

LENGTH = 200
GRAM = 64
#: Text that a map task combines at once, in bytes.
CHUNK = 48 << 20
#: Pieces of one gram in a chunk, or in a group, from which its strings are counted by hash.
HOT_LOCAL, HOT_GROUP = 1024, 4096
SALTS = 32
#: Bytes of pieces and suffixes sorted together.
SORT_BYTES, SORT_ITEMS = 4 << 20, 1 << 19

ANCHOR = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("gram", pa.int64()),
                    ("seg", pa.int64()), ("first", pa.int64()), ("n", pa.int32()),
                    ("rel", pa.int32()), ("multi", pa.int32()), ("salt", pa.int32())])
ANCHOR_DDL = ("doc_id long, th long, gram long, seg long, first long, n int, rel int, "
              "multi int, salt int")
PIECE_DDL = "doc_id long, th long, gram long, first long, n int, rel int, cov int, hot int"
SPAN_DDL = "doc_id long, th long, first long, last long"
SPAN = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("first", pa.int64()),
                  ("last", pa.int64())])


def _ids(col) -> tuple[np.ndarray, np.ndarray]:
    """An id column as numbers and its nulls."""
    return (col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
            col.is_null().to_numpy(zero_copy_only=False))


def _id_array(values, nulls):
    return pa.array(values, pa.int64(), mask=np.asarray(nulls, bool))


def merged(first: np.ndarray, last: np.ndarray):
    """Union of spans sorted by ``first``."""
    reach = np.maximum.accumulate(last)
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return first[at], reach[np.append(at[1:], len(first)) - 1]


def _combine(texts, ids, nulls, ths, length, gram):
    """Anchors of a chunk of texts: one row for each different piece, and spans for those
    that repeat within the chunk."""
    parts = []
    for k, data in enumerate(texts):
        got = anchors(np.frombuffer(data, np.uint8), length, gram)
        if got is not None:
            at, first, n, g, seg = got
            parts.append((np.full(len(n), k), first, n, at - first, g, seg))
    if not parts:
        return
    d, first, n, rel, g, seg = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((g, seg))
    d, first, n, rel, g, seg = (x[order] for x in (d, first, n, rel, g, seg))
    new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (g[1:] != g[:-1])])
    start = np.flatnonzero(new)
    run = np.repeat(start, np.diff(np.append(start, len(seg))))
    for k in np.flatnonzero(~new):  # equal hashes: compare the bytes, lest they collide
        b, e = run[k], n[k] + length - 1
        if texts[d[k]][first[k]:first[k] + e] != texts[d[b]][first[b]:first[b] + n[b] + length - 1]:
            new[k] = True  # told apart; it stays a row of its own
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(seg)))
    multi = size > 1
    # Salted grams: many different pieces in this chunk already.
    gs = g[start]
    by = np.argsort(gs, kind="stable")
    edge = np.concatenate([[True], gs[by][1:] != gs[by][:-1]])
    first_of = np.flatnonzero(edge)
    many = np.diff(np.append(first_of, len(by)))
    hot = np.zeros(len(gs), bool)
    hot[by] = np.repeat(many >= HOT_LOCAL, many)
    salt = np.where(hot, 1 + (seg[start] % np.uint64(SALTS)).astype(np.int64), 0)
    marks = gs[by][first_of[many >= HOT_LOCAL]]
    z = np.zeros(len(marks), np.int64)
    s = start
    cat = np.concatenate
    yield pa.RecordBatch.from_arrays([
        _id_array(cat([ids[d[s]], z]), cat([nulls[d[s]], z + 1])),
        pa.array(cat([ths[d[s]], z])), pa.array(cat([gs, marks]).view(np.int64)),
        pa.array(cat([seg[s].view(np.int64), z])), pa.array(cat([first[s], z])),
        pa.array(cat([n[s], z]).astype(np.int32)), pa.array(cat([rel[s], z]).astype(np.int32)),
        pa.array(cat([multi.astype(np.int32), (z + 2).astype(np.int32)])),
        pa.array(cat([salt, z]).astype(np.int32))], schema=ANCHOR)
    cov = np.flatnonzero(np.repeat(multi, size))
    cov = cov[np.lexsort((first[cov], d[cov]))]
    if len(cov):
        # Far apart in one line of numbers, so that spans of two texts never merge.
        off = d[cov].astype(np.int64) << 40
        a, b = merged(off + first[cov], off + first[cov] + n[cov] + length - 1)
        k, low = a >> 40, (1 << 40) - 1
        nothing = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([
            _id_array(ids[k], nulls[k]), pa.array(ths[k]), nothing, pa.array(b & low),
            pa.array(a & low), *[pa.nulls(len(a), pa.int32())] * 4], schema=ANCHOR)


def _anchor_rows(length, gram, chunk):
    def run(batches):
        texts, ids, nulls, ths, size = [], [], [], [], 0

        def flush():
            yield from _combine(texts, np.concatenate(ids), np.concatenate(nulls),
                                np.concatenate(ths), length, gram)

        for batch in batches:
            i, z = _ids(batch.column(0))
            got = [x.as_buffer().to_pybytes() for x in batch.column(1)]
            texts += got
            ids.append(i)
            nulls.append(z)
            ths.append(batch.column(2).to_numpy())
            size += sum(map(len, got))
            if size >= chunk:
                yield from flush()
                texts, ids, nulls, ths, size = [], [], [], [], 0
        if texts:
            yield from flush()
    return run


def _groups(batches, key_names):
    """Arrow batches sorted by key, re-cut so that no key crosses a cut: dicts of columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in key_names]
        end_key = tuple(k[-1] for k in keys)
        if last is not None and tuple(k[0] for k in keys) == last and end_key == last:
            held.append(batch)
            continue
        same = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        held.append(batch.slice(0, cut))
        if any(b.num_rows for b in held):
            yield pa.Table.from_batches(held)
        held, last = [batch.slice(cut)], end_key
    if held:
        yield pa.Table.from_batches(held)


def _meet(length, hot_group):
    """Streams anchors sorted by (gram, salt, seg): spans of pieces that are equal across
    tasks, and the pieces to sort (kind 1)."""
    def run(batches):
        for t in _groups(batches, ("gram", "salt")):
            c = {n: t.column(n).to_numpy() for n in ("th", "gram", "seg", "first", "n", "rel",
                                                     "multi", "salt")}
            ids, nulls = _ids(t.column("doc_id").combine_chunks())
            new_g = np.concatenate([[True], (c["gram"][1:] != c["gram"][:-1])
                                    | (c["salt"][1:] != c["salt"][:-1])])
            mark = c["multi"] == 2
            new_r = new_g | np.concatenate([[True], (c["seg"][1:] != c["seg"][:-1])
                                            | (mark[1:] != mark[:-1])])
            rs = np.flatnonzero(new_r)
            rlen = np.diff(np.append(rs, len(mark)))
            rmark = mark[rs]
            rcov = ((rlen > 1) | (np.maximum.reduceat(c["multi"], rs) == 1)) & ~rmark
            rg = np.cumsum(new_g)[rs] - 1
            n_g = rg[-1] + 1
            pieces = np.bincount(rg, ~rmark, minlength=n_g)
            marked = np.bincount(rg, rmark, minlength=n_g) > 0
            open_ = np.bincount(rg, ~rcov & ~rmark, minlength=n_g) > 0
            hot = marked | (c["salt"][rs[np.searchsorted(rg, np.arange(n_g))]] > 0) \
                | (pieces > hot_group)
            want = (hot | ((pieces > 1) & open_))[rg] & ~rmark
            cov_row = np.repeat(rcov, rlen) & (c["multi"] == 0)
            s, p = np.flatnonzero(cov_row), rs[want]
            k = np.concatenate([s, p])
            is_p = np.arange(len(k)) >= len(s)
            if not len(k):
                continue
            yield pa.RecordBatch.from_arrays([
                _id_array(ids[k], nulls[k]), pa.array(c["th"][k]),
                pa.array(c["gram"][k], mask=~is_p), pa.array(c["first"][k]),
                pa.array(np.where(is_p, c["n"][k], c["n"][k] + length - 1).astype(np.int32)),
                pa.array(c["rel"][k]),
                pa.array(np.concatenate([np.zeros(len(s)), rcov[want]]).astype(np.int32)),
                pa.array(np.concatenate([np.zeros(len(s)), hot[rg][want]]).astype(np.int32))],
                names=["doc_id", "th", "gram", "first", "n", "rel", "cov", "hot"])
    return run


def _cut_pieces(length):
    """The bytes of each wanted piece of a document."""
    names = ["doc_id", "th", "gram", "first", "n", "rel", "cov", "hot"]

    def run(batches):
        for batch in batches:
            out = {n: [] for n in [*names, "piece"]}
            for i, th, text, ps in zip(*(batch.column(k).to_pylist() for k in range(3)),
                                       batch.column(3).to_pylist()):
                for p in ps:
                    for n in names[2:]:
                        out[n].append(p[n])
                    out["doc_id"].append(i)
                    out["th"].append(th)
                    out["piece"].append(text[p["first"]:p["first"] + p["n"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], t) for n, t in zip(out, [
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(),
                    pa.int32(), pa.int32(), pa.binary()])], names=list(out))
    return run


class Suffixes:
    """Suffixes of a buffer, compared up to ``length`` bytes through prefix hashes."""

    def __init__(self, data: bytes, length: int):
        self.b = np.frombuffer(data, np.uint8)
        self.pre = prefix(self.b)
        self.length = length

    def equal(self, a, b, n):
        return spans(self.pre, a, a + n) == spans(self.pre, b, b + n)

    def common(self, a, b):
        """Common extension, by binary search over prefix hashes."""
        out = np.full(len(a), self.length)
        k = np.flatnonzero(~self.equal(a, b, self.length))
        if len(k):
            a, b = a[k], b[k]
            lo, hi = np.zeros(len(k), np.int64), np.full(len(k), self.length - 1)
            while (lo < hi).any():
                mid = (lo + hi + 1) >> 1
                same = self.equal(a, b, mid)
                lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
            out[k] = lo
        return out

    def before(self, a, b, or_equal):
        """Whether suffix a sorts before b (or equals it, where ``or_equal``)."""
        ext = self.common(a, b)
        whole = ext >= self.length
        at = np.minimum(ext, self.length - 1)
        return np.where(whole, or_equal, self.b[a + at] < self.b[b + at])

    def merge_sort(self, pos: np.ndarray, seg: np.ndarray) -> np.ndarray:
        """Sort the suffixes at ``pos`` inside each segment (``seg`` ascending): bottom-up
        merges of all segments together. Returns the order."""
        order = np.arange(len(pos))
        start = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        size = np.diff(np.append(start, len(pos)))
        base, many = np.repeat(start, size), np.repeat(size, size)
        width = 1
        while width < size.max(initial=0):
            act = np.flatnonzero(many > width)
            i = act - base[act]
            run = i // width
            sib = (run ^ 1) * width
            lo = np.minimum(sib, many[act])
            hi = np.minimum(sib + width, many[act])
            left, low = run % 2 == 0, lo.copy()
            me = pos[order[act]]
            todo = np.flatnonzero(low < hi)
            while len(todo):
                mid = (low[todo] + hi[todo]) >> 1
                other = pos[order[base[act[todo]] + mid]]
                # The sibling's element goes first if smaller, or if equal and on the left.
                first = self.before(other, me[todo], ~left[todo])
                low[todo] = np.where(first, mid + 1, low[todo])
                hi[todo] = np.where(first, hi[todo], mid)
                todo = todo[low[todo] < hi[todo]]
            to = base[act] + (run // 2) * 2 * width + (i - run * width) + (low - lo)
            moved = order.copy()
            moved[to] = order[act]
            order = moved
            width *= 2
        return order

    def same_bytes(self, a, b) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(self.b, self.length)
        ok = np.empty(len(a), bool)
        for at in range(0, len(a), 20_000):
            s = slice(at, at + 20_000)
            ok[s] = (view[a[s]] == view[b[s]]).all(axis=1)
        return ok


def repeated_starts(pieces: list[bytes], group: np.ndarray, rel: np.ndarray, n: np.ndarray,
                    length: int):
    """For pieces of several anchor groups: the first and last string start of each that
    repeats in another piece of its group (first > last: none).

    Equal strings have the same distance to the anchor, so suffixes are sorted by group,
    then that distance, then their bytes.
    """
    off = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])[:-1]
    sfx = Suffixes(b"".join(pieces) + bytes(length), length)
    lo, hi = np.full(len(pieces), 1 << 30), np.full(len(pieces), -1)
    who = np.repeat(np.arange(len(pieces)), n)
    k = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    seg = (group[who].astype(np.int64) << 20) | (rel[who] - k + (1 << 19))
    by = np.argsort(seg, kind="stable")
    who, k, seg = who[by], k[by], seg[by]
    twin = np.concatenate([[False], seg[1:] == seg[:-1]])
    twin |= np.append(twin[1:], False)
    who, k, seg = who[twin], k[twin], seg[twin]
    at = 0
    while at < len(who):
        # Whole segments together, about SORT_ITEMS suffixes at a time.
        end = min(len(who), at + SORT_ITEMS)
        while end < len(who) and seg[end] == seg[end - 1]:
            end += 1
        w, kk, ss = who[at:end], k[at:end], seg[at:end]
        pos = off[w] + kk
        order = sfx.merge_sort(pos, ss)
        w, kk, pos = w[order], kk[order], pos[order]
        pair = np.flatnonzero((ss[1:] == ss[:-1])
                              & sfx.equal(pos[:-1], pos[1:], length))
        ok = sfx.same_bytes(pos[pair], pos[pair + 1])
        hit = np.unique(np.concatenate([pair[ok], pair[ok] + 1]))
        for s in np.unique(ss[pair[~ok]]):  # a hash collision: this segment by its bytes
            seen: dict[bytes, int] = {}
            for j in np.flatnonzero(ss == s):
                x = sfx.b[pos[j]:pos[j] + length].tobytes()
                hit = np.append(hit, [j, seen[x]]) if x in seen else hit
                seen.setdefault(x, j)
        np.minimum.at(lo, w[hit], kk[hit])
        np.maximum.at(hi, w[hit], kk[hit])
        at = end
    return lo, hi


def _sort_groups(length):
    def flush(tables):
        t = pa.concat_tables(tables)
        gram = t.column("gram").to_numpy()
        group = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]]))
        first = t.column("first").to_numpy()
        lo, hi = repeated_starts(t.column("piece").to_pylist(), group,
                                 t.column("rel").to_numpy().astype(np.int64),
                                 t.column("n").to_numpy().astype(np.int64), length)
        k = np.flatnonzero((lo <= hi) & (t.column("cov").to_numpy() == 0))
        ids, nulls = _ids(t.column("doc_id").combine_chunks())
        return pa.RecordBatch.from_arrays([
            _id_array(ids[k], nulls[k]), pa.array(t.column("th").to_numpy()[k]),
            pa.array(first[k] + lo[k]), pa.array(first[k] + hi[k] + length)], schema=SPAN)

    def run(batches):
        held, size = [], 0
        for t in _groups(batches, ("gram",)):
            held.append(t)
            size += t.nbytes
            if size >= SORT_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)
    return run


def _string_hashes(length):
    """All strings of pieces as hashes, for grams with very many pieces."""
    def run(batches):
        for batch in batches:
            first, n = batch.column("first").to_numpy(), batch.column("n").to_numpy()
            h, k = [], []
            for j, p in enumerate(batch.column("piece").to_pylist()):
                pre, a = prefix(np.frombuffer(p, np.uint8)), np.arange(n[j])
                h.append(mixed(spans(pre, a, a + length)))
                k.append(np.full(n[j], j))
            if not h:
                continue
            k, h = np.concatenate(k), np.concatenate(h)
            at = np.concatenate([first[j] + np.arange(n[j]) for j in range(len(n))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(k)), batch.column("th").take(pa.array(k)),
                 batch.column("gram").take(pa.array(k)), pa.array(h.view(np.int64)),
                 pa.array(at.astype(np.int64)), batch.column("cov").take(pa.array(k))],
                names=["doc_id", "th", "gram", "h", "at", "cov"])
    return run


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("t")).select(
        "doc_id", F.col("t").cast("binary").alias("b"), F.xxhash64("t").alias("th"))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK,
                   hot_group: int = HOT_GROUP) -> DataFrame:
    """Byte spans to remove: (doc_id, th, first, last), not yet merged."""
    batches_of(df.sparkSession)
    docs = _keyed(df, id_col, text_col)
    rows = materialize(docs.filter(F.octet_length("b") >= length).mapInArrow(
        trimmed(_anchor_rows(length, gram, chunk)), ANCHOR_DDL), "suffix_anchors")
    own = rows.filter("gram IS NULL").select("doc_id", "th", "first", F.col("seg").alias("last"))
    met = materialize(
        rows.filter("gram IS NOT NULL").repartition("gram", "salt")
        .sortWithinPartitions("gram", "salt", "seg").mapInArrow(
            trimmed(_meet(length, hot_group)), PIECE_DDL), "suffix_pieces")
    across = met.filter("gram IS NULL").select("doc_id", "th", "first",
                                               (F.col("first") + F.col("n")).alias("last"))
    names = ["gram", "first", "n", "rel", "cov", "hot"]

    def cut(pieces: DataFrame, then, ddl: str) -> DataFrame:
        """``then``, in the same Python worker, of pieces with their bytes. The joins with the texts, here and where spans are cut
        out, are merge joins at every size: pieces and spans grow with the corpus, so no
        broadcast of them has a bound. All belong to one plan, in which the texts are
        shuffled once and that exchange is read again by each."""
        wanted = pieces.groupBy("doc_id", "th").agg(F.collect_list(F.struct(*names)).alias("ps"))
        return docs.alias("d").join(
            wanted.hint("merge").alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
            & (F.col("d.th") == F.col("w.th"))).select(
            "d.doc_id", "d.th", "d.b", "w.ps").mapInArrow(
            trimmed(lambda batches: then(_cut_pieces(length)(batches))), ddl)

    few, many = (met.filter(f"gram IS NOT NULL AND hot = {k}") for k in (0, 1))
    found = cut(few, iter, PIECE_DDL + ", piece binary").repartition("gram").sortWithinPartitions("gram").mapInArrow(
        trimmed(_sort_groups(length)), SPAN_DDL)
    out = own.unionByName(across).unionByName(found)
    if not many.isEmpty():  # no gram has very many pieces: nothing to count
        strings = cut(many, _string_hashes(length),
                      "doc_id long, th long, gram long, h long, at long, cov int")
        often = strings.groupBy("gram", "h").count().filter("count > 1").select("gram", "h")
        out = out.unionByName(strings.filter("cov = 0").join(often, ["gram", "h"]).select(
            "doc_id", "th", F.col("at").alias("first"), (F.col("at") + length).alias("last")))
    return out


def _removed(text: bytes, cuts) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, removed runs); touching spans are one run."""
    keep, at, gone, runs, reach = [], 0, 0, 0, -1
    for a, b in sorted(cuts):
        if a > reach:
            runs += 1
            keep.append(text[at:a])
            gone += b - a
        elif b > reach:
            gone += b - reach
        reach = max(reach, b)
        at = max(at, b)
    return b"".join([*keep, text[at:]]), gone, runs


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                    ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _cuts(batch):
    for ps in batch.column("cuts").to_pylist():
        yield [] if ps is None else [(p["first"], p["last"]) for p in ps]


def _digests(batches):
    for batch in batches:
        rows = []
        for i, x, cuts in zip(batch.column("doc_id").to_pylist(), batch.column("b").to_pylist(),
                              _cuts(batch)):
            kept, gone, runs = _removed(x, cuts)
            rows.append((i, len(x), gone, runs, hashlib.sha256(kept).hexdigest()))
        yield record_batch(DIGEST, *(zip(*rows) if rows else [[]] * 5))


def _with_cuts(docs: DataFrame, found: DataFrame) -> DataFrame:
    cuts = found.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("first", "last")).alias("cuts"))
    return docs.alias("d").join(cuts.hint("merge").alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
                                & (F.col("d.th") == F.col("c.th")), "left").select(
        "d.*", "c.cuts")


def repeat_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **kw) -> DataFrame:
    """Per document: bytes, bytes and runs removed, SHA-256 of what is left."""
    got = _with_cuts(_keyed(df, id_col, text_col), repeated_spans(df, id_col, text_col, **kw))
    return got.select("doc_id", "b", "cuts").mapInArrow(
        trimmed(_digests), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept_text(batches):
    for batch in batches:
        out = [_removed(x, cuts)[0].decode("utf-8", "ignore") if cuts else x.decode()
               for x, cuts in zip(batch.column("b").to_pylist(), _cuts(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())],
                                         names=["row", "kept"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **kw) -> DataFrame:
    """The rows of ``df`` as they are, but for the repeated strings in their texts; a
    character that a cut goes through is dropped. Null texts stay null."""
    docs = df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("t")).select(
        "row", "doc_id", F.xxhash64("t").alias("th"))
    got = _with_cuts(docs, repeated_spans(df, id_col, text_col, **kw)).select(
        "row", F.coalesce(F.col("row").getField(text_col), F.lit("")).cast("binary").alias("b"),
        "cuts")
    out = got.mapInArrow(trimmed(_kept_text), got.select("row").schema.add("kept", "string"))
    names = [F.when(F.col("row").getField(c).isNotNull(), F.col("kept")).alias(c)
             if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns]
    return out.select(*names)
