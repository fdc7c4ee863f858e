"""Phrases that stand together more often than their parts do, by direct-address tiling.

Texts become blocks of word numbers, one language a block. Spark adds up the blocks' word
counts; words that are frequent in their language get an id and go back to the blocks in which
they stand. A block ranks its ids by falling frequency, so that the frequent pairs meet in the
first tiles: the plane of (left rank, right rank) is cut into square tiles, and the block's pairs
are counted in each well-filled tile with one dense ``bincount`` and in all others as sorted
coordinates. Spark adds up the blocks' counts by pair. The frequent pairs get ids in their turn,
stand where their first word stands and are ranked anew; two of them side by side are a phrase
of three words, counted with the same tiles, and once more one of four. A phrase can only be
frequent if both its shorter ends are, so nothing is lost on the way.

Counts and the places of what is counted travel in one shuffle, by word or, of pairs, by the
part that a hash deals them to, a block's pairs of a part in one packed row; the frequent ones
go back in one shuffle by block. Parts grow in number with the blocks, so a part stays small.
Nothing is broadcast or collected. Each level's blocks and frequent ones are written to the
shared folder.

``score`` is the least, over the cuts of a phrase, of ``floor(2000000 * a / (l + r))`` with the
frequencies of the phrase and both sides. A phrase goes if a longer candidate holds it and has
at least 80 % of its frequency; the next longer ones suffice to tell, for frequencies only
fall as phrases grow.

Defined cases: null texts are empty; a null language is ``und``. A row's text is never cut
except between pieces. Repeated rows count as often as they stand. Empty tables, and those
without frequent phrases, give empty results. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, materialize, record_batch, trimmed

#: Words of a block, about; side of a tile; a tile with this share of its cells is dense.
BLOCK_WORDS, TILE, DENSE = 1_000_000, 1024, 1 / 64
#: Rows of an Arrow batch: texts, and (block, position, id) rows.
TEXT_ROWS, ID_ROWS = 256, 16_384
SALTS = 64

#: A byte that UTF-8 never holds stands for the end of a piece.
END = b"\xff"
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: Capital ASCII letters become small, separators END, tabs spaces.
FOLD = bytes.maketrans(SEPARATORS + b"\t" + bytes(range(65, 91)),
                       END * len(SEPARATORS) + b" " + bytes(range(97, 123)))


# --- texts to blocks ------------------------------------------------------------------------
def words_of(text: str) -> list[bytes]:
    """The words of a text in order, with END after each piece."""
    # split() parts at ASCII white space; all of it but space and tab is a separator.
    return (text.encode().translate(FOLD).replace(END, b" \xff ") + b" \xff").split()


class Numbers(dict):
    """Numbers of words from 1, in order of their first occurrence; the end of a piece is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def piece_parts(words: list[bytes], most: int):
    """``words`` in runs of about ``most``, cut after ends of pieces only."""
    at = 0
    while len(words) - at > most:
        try:
            cut = words.index(END, at + most - 1) + 1
        except ValueError:
            break
        yield words[at:cut]
        at = cut
    yield words[at:]


#: A level's rows: of each block's different words, or pairs of ids, their number in the block
#: and count; and a row with the block itself, as those numbers in order (0: none).
BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("pos", pa.int32()),
                   ("word", pa.string()), ("c", pa.int64()), ("seq", pa.binary())])
#: Of pairs, a row has those of one block and part (by hash), packed: their first number in
#: the block, then left ids, right ids and counts, in the order of their numbers.
LEVEL = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("pos", pa.int32()),
                   ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()),
                   ("seq", pa.binary())])
LEVEL_SCHEMA = "block long, part int, pos int, a binary, b binary, c binary, seq binary"
#: What a part's count gives: frequent pairs (block null), and of each block their numbers,
#: ids and frequencies, packed.
FOUND = pa.schema([("block", pa.int64()), ("id", pa.int64()), ("a", pa.int64()),
                   ("b", pa.int64()), ("f", pa.int64()), ("at", pa.binary()),
                   ("ids", pa.binary()), ("fs", pa.binary())])
FOUND_SCHEMA = ("block long, id long, a long, b long, f long, at binary, ids binary, fs binary")
#: Parts of a level at least, and blocks for each part.
PARTS, PART_BLOCKS = 64, 2
SLICE = 65_536


def packed(seq: np.ndarray) -> bytes:
    """Numbers of 64 bits, byte by byte in eight planes, compressed."""
    planes = np.ascontiguousarray(seq.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return len(seq).to_bytes(8, "little") + zstandard.ZstdCompressor(1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:]), np.uint8)
    n = int.from_bytes(data[:8], "little")
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of neighbours, the first to 0; np.cumsum gives ``x`` back."""
    return np.diff(x, prepend=0)


def level_rows(schema: pa.Schema, items: dict, seq: np.ndarray, **same):
    """Batches of a block's ``items`` by number from 1, then its row with ``seq``."""
    total = len(items["c"])
    for at in range(0, total, SLICE):
        n = min(SLICE, total - at)
        given = {"pos": np.arange(at + 1, at + n + 1, dtype=np.int32),
                 **{k: v[at:at + n] for k, v in items.items()}}
        yield pa.RecordBatch.from_arrays(
            [pa.array(given[f.name], f.type) if f.name in given else
             pa.repeat(pa.scalar(same.get(f.name), f.type), n) for f in schema], schema=schema)
    whole = {**same, "seq": packed(seq)}
    yield pa.RecordBatch.from_arrays([pa.array([whole.get(f.name)], f.type) for f in schema],
                                     schema=schema)


class Held:
    """A block of one language that is being filled."""

    def __init__(self):
        self.ids, self.parts, self.size = Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self, number: int, lang: str):
        seq = np.concatenate(self.parts)
        names = pa.array(itertools.islice(self.ids, 1, None), pa.binary()).cast(pa.string())
        return level_rows(BLOCK, {"word": names, "c": np.bincount(
            seq, minlength=len(self.ids))[1:]}, seq, block=number, lang=lang)


def _blocks(most):
    def run(batches):
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[str, Held] = defaultdict(Held)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                for part in piece_parts(words_of(text.as_py()), most):
                    held[lang].add(part)
                    if held[lang].size >= most:
                        yield from held.pop(lang).rows(next(number), lang)
                    elif sum(h.size for h in held.values()) >= 3 * most:
                        full = max(held, key=lambda k: held[k].size)
                        yield from held.pop(full).rows(next(number), full)
        for lang in sorted(held):
            yield from held[lang].rows(next(number), lang)
    return run


# --- counting pairs of ids in tiles ----------------------------------------------------------
def tile_counts(a: np.ndarray, b: np.ndarray, tile: int = TILE, dense: float = DENSE):
    """(left, right, count, which): the different pairs (a[i], b[i]), and which of them each
    pair is. Ids start at 0."""
    which = np.zeros(len(a), np.int64)
    if not len(a):
        return a, b, which, which
    side = int(max(a.max(), b.max())) // tile + 1
    where = (a // tile) * side + b // tile
    names, tiles, filled = np.unique(where, return_inverse=True, return_counts=True)
    parts, thin, total = [], np.ones(len(a), bool), 0
    for k in np.flatnonzero(filled >= dense * tile * tile):
        mine = tiles == k
        thin &= ~mine
        ta, tb = divmod(int(names[k]), side)
        cell = (a[mine] - ta * tile) * tile + (b[mine] - tb * tile)
        grid = np.bincount(cell, minlength=tile * tile)
        at = np.flatnonzero(grid)
        parts.append((at // tile + ta * tile, at % tile + tb * tile, grid[at]))
        number = np.zeros(tile * tile, np.int64)
        number[at] = np.arange(total, total + len(at))
        which[mine] = number[cell]
        total += len(at)
    if thin.any():
        rest = np.flatnonzero(thin)
        order = rest[np.lexsort((b[rest], a[rest]))]
        x, y = a[order], b[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        first = np.flatnonzero(new)
        parts.append((x[first], y[first], np.diff(np.append(first, len(x)))))
        which[order] = np.cumsum(new) - 1 + total
    return *(np.concatenate(x) for x in zip(*parts)), which


def shortened(seq: np.ndarray) -> np.ndarray:
    """Of each run of zeros one."""
    keep = seq != 0
    keep[1:] |= seq[:-1] != 0
    return seq[keep]


def part_of(a: np.ndarray, b: np.ndarray, parts: int) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
         + b.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def pair_rows(block: int, ids: np.ndarray, f: np.ndarray, parts: int):
    """Rows of the pairs of ids side by side in a block (0: not frequent); ``f`` has their
    frequencies, by whose rank the tiles are laid out."""
    both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    names, at = np.unique(ids, return_index=True)
    order = np.argsort(-f[at], kind="stable")
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    ranks = rank[np.searchsorted(names, ids)]
    a, b, c, which = tile_counts(ranks[both], ranks[both + 1])
    a, b = names[order][a], names[order][b]
    part = part_of(a, b, parts)
    dealt = np.lexsort((b, a, part))
    number = np.empty(len(a), np.int64)
    number[dealt] = np.arange(1, len(a) + 1)
    a, b, c, part = a[dealt], b[dealt], c[dealt], part[dealt]
    cut = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)] if len(part) else [0]
    rows = [(block, int(part[lo]), int(lo) + 1, packed(steps(a[lo:hi])), packed(b[lo:hi]),
             packed(c[lo:hi]), None) for lo, hi in zip(cut, cut[1:])]
    seq = np.zeros(max(0, len(ids) - 1), np.int64)
    seq[both] = number[which]
    rows.append((block, None, None, None, None, None, packed(shortened(seq))))
    yield record_batch(LEVEL, *zip(*rows))


def _counted(least: int, parts: int, replies: bool):
    """From a level's rows, sorted by part: the part's frequent pairs, then where they stand."""
    def count(part, held):
        blocks, pos, a, b, c = zip(*held)
        a = [np.cumsum(unpacked(x)) for x in a]
        sizes = np.array([len(x) for x in a])
        a = np.concatenate(a)
        b, c = (np.concatenate([unpacked(y) for y in x]) for x in (b, c))
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        first = np.flatnonzero(new)
        f = np.add.reduceat(c[order], first)
        ok = f >= least
        if not ok.any():
            return
        local = np.cumsum(ok)
        x, y, f_ok = x[first][ok], y[first][ok], f[ok]
        n = len(x)
        none = [pa.nulls(n, pa.binary())] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.array((local[ok] - 1) * parts + part + 1), pa.array(x),
             pa.array(y), pa.array(f_ok), *none], schema=FOUND)
        if not replies:
            return
        which = np.empty(len(a), np.int64)
        which[order] = np.cumsum(new) - 1
        ids = np.where(ok, (local - 1) * parts + part + 1, 0)
        rows = []
        for block, start, lo, size in zip(blocks, pos, np.cumsum(sizes) - sizes, sizes):
            mine = which[lo:lo + size]
            at = np.flatnonzero(ok[mine])
            if len(at):
                mine = mine[at]
                rows.append((block, None, None, None, None, packed(steps(at + start)),
                             packed(steps(ids[mine])), packed(f[mine])))
        if rows:
            yield record_batch(FOUND, *zip(*rows))

    def run(batches):
        last, held = None, []
        for batch in batches:
            for part, *row in zip(*(batch.column(k).to_pylist() for k in (
                    "part", "block", "pos", "a", "b", "c"))):
                if part != last and held:
                    yield from count(last, held)
                    held = []
                last = part
                held.append(row)
        if held:
            yield from count(last, held)
    return run


def _advance(parts):
    """From a block's frequent words or pairs, one a row or many packed, then the block."""
    def run(batches):
        block, held = None, []
        for batch in batches:
            at = batch.column("block").to_numpy()
            kind = batch.column("kind").to_numpy()
            cut = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1),
                   len(at)]
            for lo, hi in zip(cut, cut[1:]):
                if lo == hi:
                    continue
                if at[lo] != block:
                    block, held = at[lo], []
                if kind[lo] == 0:
                    cols = [batch.column(c).slice(lo, hi - lo)
                            for c in ("pos", "id", "f", "at", "ids", "fs")]
                    if cols[0].null_count == 0:
                        held.append([c.to_numpy().astype(np.int64) for c in cols[:3]])
                    else:
                        for x, y, z in zip(*(c.to_pylist() for c in cols[3:])):
                            held.append([np.cumsum(unpacked(x)), np.cumsum(unpacked(y)),
                                         unpacked(z)])
                elif held:
                    pos, ids, f = map(np.concatenate, zip(*held))
                    seq = unpacked(batch.column("seq")[lo].as_py())
                    size = max(int(seq.max(initial=0)), int(pos.max())) + 1
                    new, freq = np.zeros(size, np.int64), np.zeros(size, np.int64)
                    new[pos], freq[pos] = ids, f
                    seq = shortened(np.where(new[seq] > 0, seq, 0))
                    yield from pair_rows(int(block), new[seq], freq[seq], parts)
    return run


def frequent(level: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """The level's words or pairs with frequency ``f`` of ``least`` and more, in each block,
    with an id of their own. A key has one row a block, so one shuffle counts them, names them
    and keeps where they stand."""
    dealt = (level.filter("seq IS NULL").select("block", "pos", "c", *keys).repartition(*keys)
             .withColumn("_at", F.monotonically_increasing_id()))
    key = Window.partitionBy(*keys)
    return materialize(dealt.select("block", "pos", *keys, F.sum("c").over(key).alias("f"),
                                    (F.min("_at").over(key) + 1).alias("id"))
                       .filter(F.col("f") >= least), name)


def table_of(found: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each frequent word or pair."""
    return found.groupBy("id", *keys, "f").agg(F.lit(1).alias("_")).drop("_")


def frequent_pairs(level: DataFrame, least: int, parts: int, name: str,
                   replies: bool = True) -> DataFrame:
    """The level's pairs with frequency ``least`` and more, counted part by part."""
    return materialize(level.filter("seq IS NULL").drop("seq").repartition(parts, "part")
                       .sortWithinPartitions("part", "block", "pos").mapInArrow(
        trimmed(_counted(least, parts, replies)), FOUND_SCHEMA), name)


def pairs_of(found: DataFrame) -> DataFrame:
    return found.filter("block IS NULL").select("id", "a", "b", "f")


def advance(level: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """The blocks one level up."""
    none, number = F.lit(None).cast("binary"), F.lit(None).cast("long")
    if "ids" in found.columns:
        rows = found.filter("block IS NOT NULL").select(
            "block", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("pos"),
            number.alias("id"), number.alias("f"), "at", "ids", "fs", none.alias("seq"))
    else:
        rows = found.select("block", F.lit(0).alias("kind"), "pos", "id", "f", none.alias("at"),
                            none.alias("ids"), none.alias("fs"), none.alias("seq"))
    blocks = level.filter("seq IS NOT NULL").select(
        "block", F.lit(1).alias("kind"), F.lit(0).alias("pos"), number.alias("id"),
        number.alias("f"), none.alias("at"), none.alias("ids"), none.alias("fs"), "seq")
    return materialize(rows.unionByName(blocks).repartition("block")
                       .sortWithinPartitions("block", "kind").mapInArrow(
        trimmed(_advance(parts)), LEVEL_SCHEMA), "phrase_level")


# --- phrases --------------------------------------------------------------------------------
def wide(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def cut_score(left: str, right: str) -> Column:
    return F.expr(f"CAST(CAST(2000000 AS DECIMAL(10,0)) * CAST(f AS DECIMAL(19,0)) DIV "
                  f"(CAST({left} AS DECIMAL(19,0)) + CAST({right} AS DECIMAL(19,0))) AS BIGINT)")


def lowest_cut(cuts) -> list[Column]:
    """score, l and r of the cut with the lowest score, the first of equal ones."""
    best = F.array_min(F.array(*[F.struct(cut_score(x, y).alias("score"), F.lit(k).alias("k"),
                                          F.col(x).alias("l"), F.col(y).alias("r"))
                                 for k, (x, y) in enumerate(cuts, 1)]))
    return [best[c].alias(c) for c in ("score", "l", "r")]


def not_covered(shorter: DataFrame, longer: DataFrame) -> DataFrame:
    """``shorter`` without those that a longer phrase holds nearly as often."""
    most = (longer.select("a", "f").unionAll(longer.select("b", "f"))
            .groupBy(F.col("a").alias("id")).agg(F.max("f").alias("_f")))
    covered = F.coalesce(wide("_f") * 100 >= wide("f") * 80, F.lit(False))
    return shorter.join(most, "id", "left").filter(~covered).drop("_f")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *,
                 least: int = 30, top: int = 2000, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    batches_of(df.sparkSession, TEXT_ROWS)
    texts = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    level = materialize(texts.mapInArrow(
        trimmed(_blocks(block_words)),
        "block long, lang string, pos int, word string, c long, seq binary"), "phrase_blocks")
    batches_of(df.sparkSession, ID_ROWS)
    totals = level.groupBy("lang").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))

    def of(table, side, **names):
        """Columns of the frequent ones that stand as ``side`` of a pair."""
        return table.select(F.col("id").alias(side), *[F.col(c).alias(n)
                                                       for n, c in names.items()])

    there = frequent(level, ["lang", "word"], least, "frequent_words")
    one = materialize(table_of(there, ["lang", "word"]), "words")
    parts = max(PARTS, level.filter("seq IS NOT NULL").count() // PART_BLOCKS)
    level = advance(level, there, parts)

    there = frequent_pairs(level, least, parts, "frequent_pairs")
    two = materialize(pairs_of(there)
                      .join(of(one, "a", lang="lang", w1="word", f1="f"), "a")
                      .join(of(one, "b", last="word", f2="f"), "b")
                      .withColumn("phrase", F.concat_ws(" ", "w1", "last")), "pairs")
    level = advance(level, there, parts)

    there = frequent_pairs(level, least, parts, "frequent_triples")
    three = materialize(
        pairs_of(there)
        .join(of(two, "a", lang="lang", start="phrase", f1="f1", head="f"), "a")
        .join(of(two, "b", last="last", f2="f2", tail="f"), "b")
        .withColumn("phrase", F.concat_ws(" ", "start", "last")), "triples")
    level = advance(level, there, parts)

    four = materialize(
        pairs_of(frequent_pairs(level, least, parts, "frequent_quadruples", False))
        .join(of(three, "a", lang="lang", start="phrase", f1="f1", head="head", t="f"), "a")
        .join(of(three, "b", last="last", f2="f2", tail="tail", u="f"), "b")
        .withColumn("phrase", F.concat_ws(" ", "start", "last")), "quadruples")

    found = [
        (not_covered(two, three), [("f1", "f2")]),
        (not_covered(three, four), [("f1", "tail"), ("head", "f2")]),
        (four, [("f1", "u"), ("head", "tail"), ("t", "f2")])]
    scored = None
    for phrases, cuts in found:
        part = phrases.select("lang", "phrase", F.col("f").alias("a"), *lowest_cut(cuts))
        scored = part if scored is None else scored.unionByName(part)

    # The best of each language are among the best of its salted parts.
    order = (F.desc("score"), F.desc("a"), "phrase")
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = (scored.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(whole).cast("long"))
            .filter(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
