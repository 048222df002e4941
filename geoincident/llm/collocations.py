"""Phrase collocations from FM-indexes over word ids (op 13).

Whole texts are cut into shards; a shard holds its words as symbols, one
separator between pieces. Words that are frequent over all shards get an id,
the others become separators, and every shard is indexed once: the BWT of its
symbols and of their reverse, both sorted to the depth of the longest phrase.
Level by level, each shard extends the intervals of the phrases that are still
frequent over all shards by one word to the right (reverse BWT) and to the left
(BWT); a longer phrase is met where both extensions give the same interval, so
its first and its last words are known to be frequent too. Its counts are summed
across shards: a shard deals its phrases to buckets by the hash of first and last
words and sends each bucket one packed block, and only phrases that reach
``least`` go back to the shards, packed too, as intervals of the next level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import lean, per_group, prepare, scratch, shuffle_width, staged
from geoincident.llm.piece_encoding import _distinct
from geoincident.llm.words import U64, mix

#: bytes of text in a shard; a longer text is a shard of its own
SHARD_BYTES = 8 << 20
#: rows of a BWT that are looked at together
EXTEND_ROWS = 1 << 18
#: words of all texts for each bucket that phrases are dealt to, at most; a phrase stands for one word place of a shard at least
BUCKET_WORDS = 1 << 21
_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK
#: bits of a symbol's or an interval's place in its shard, of a shard's place in its task
_PLACE_BITS, _NTH_BITS = 31, 12
#: numbers of columns that travel packed: of symbols, of ids, places and counts
_SYMBOL, _NUMBER = "<i4", "<i8"


def tokenize(texts: list[bytes | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one piece of bytes, A-Z lower-cased; begin and end of every word, and whether a piece begins with it."""
    blob = (b"\n".join(t or b"" for t in texts) + b"\n" * 9).lower()
    kind = _KIND[np.frombuffer(blob, dtype=np.uint8)]
    inside = kind == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    begin, end = edges[0::2], edges[1::2]
    breaks = np.cumsum(kind == _BREAK, dtype=np.int32 if len(kind) < 1 << 31 else np.int64)[begin]
    return blob, begin, end, np.concatenate([[True], breaks[1:] != breaks[:-1]])[:len(begin)]


def _pack(rising: list[np.ndarray], others: list[np.ndarray], kind: str = _NUMBER) -> bytes:
    """Columns of whole numbers, the first ones as differences, byte by byte of the numbers, compressed."""
    raw = np.stack([np.asarray(c, dtype=kind) for c in [*(np.diff(c, prepend=0) for c in rising), *others]])
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(raw.size, raw.itemsize).T)
    return raw.shape[1].to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(block: bytes | pa.Buffer, rising: int, columns: int, kind: str = _NUMBER) -> np.ndarray:
    n, width = int.from_bytes(block[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(block[8:], n * width * columns, "zstd", asbytes=True), dtype=np.uint8).reshape(width, -1)
    raw = np.ascontiguousarray(planes.T).view(kind).reshape(columns, n)
    np.cumsum(raw[:rising], axis=1, out=raw[:rising])
    return raw


def _shard(texts: dict[str, list[bytes | None]], shard: int) -> pa.RecordBatch:
    """A row: shard, its words by language with their counts, and the packed sequence of their numbers (from 1; 0 separates)."""
    langs, words, counts, parts, base = [], [], [], [np.zeros(1, dtype=np.int32)], 0
    for lang, own in texts.items():
        blob, begin, end, first = tokenize(own)
        if not len(begin):
            continue
        at, which = _distinct(blob, begin, end)
        size = np.bincount(which, minlength=len(at))
        order = np.argsort(-size, kind="stable")  # frequent words get small numbers, which pack well
        place = np.empty(len(at), dtype=np.int32)
        place[order] = np.arange(len(at), dtype=np.int32)
        at, which = at[order], place[which]
        words += [blob[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
        langs += [lang] * len(at)
        counts.append(size[order])
        size = 1 + first
        seq = np.zeros(int(size.sum()) + 1, dtype=np.int32)
        seq[np.cumsum(size) - 1] = which + base + 1
        parts.append(seq)
        base += len(at)
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([langs], pa.list_(pa.string())),
         pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
         pa.array([np.concatenate(counts) if counts else []], pa.list_(pa.int64())),
         pa.array([_pack([], [np.concatenate(parts)], _SYMBOL)], pa.binary())],
        names=["shard", "langs", "words", "counts", "seq"])


def word_shards(docs: DataFrame, text_col: str, lang_col: str, shard_bytes: int) -> DataFrame:
    """Shards of whole documents, in the order of the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, size = TaskContext.get().partitionId(), 0, {}, 0

        def number() -> int:
            if nth >> _NTH_BITS or part >> (63 - _PLACE_BITS - _NTH_BITS):
                raise ValueError("too many shards for a task, or tasks: use a larger shard_bytes")
            return (part << _NTH_BITS) | nth

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if not text:
                    continue
                held.setdefault(lang, []).append(text)
                size += len(text) + 1
                if size >= shard_bytes:
                    yield _shard(held, number())
                    held, size, nth = {}, 0, nth + 1
        if held:
            yield _shard(held, number())

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "shard long, langs array<string>, words array<string>, counts array<long>, seq binary")


def _order(seq: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Suffixes of ``seq`` in the order of their first ``depth`` symbols."""
    wide = np.concatenate([seq, np.zeros(depth, dtype=seq.dtype)]).astype(np.int64)
    keys, each = [], max(1, 63 // bits)
    for start in range(0, depth, each):
        key = np.zeros(len(seq), dtype=np.int64)
        for k in range(start, min(start + each, depth)):
            key = (key << bits) | wide[k:k + len(seq)]
        keys.append(key)
    return np.lexsort(keys[::-1])


class BidirectionalIndex:
    """BWT of a sequence of symbols (0 separates) and of its reverse, each right for phrases up to the depth they are sorted to."""

    def __init__(self, bwt: np.ndarray, reverse: np.ndarray):
        self.bwt = (bwt, reverse)
        self.counts = np.bincount(bwt, minlength=1)
        self.starts = np.cumsum(self.counts) - self.counts
        self._steps: list[np.ndarray | None] = [None, None]

    @classmethod
    def build(cls, seq: np.ndarray, depth: int) -> BidirectionalIndex:
        bits = max(1, int(seq.max(initial=0)).bit_length())
        return cls(*(s[_order(s, depth, bits) - 1] for s in (seq, seq[::-1])))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals (forward, reverse, size) of the symbols from 1 on."""
        return self.starts[1:], self.starts[1:], self.counts[1:]

    def _step(self, side: int) -> np.ndarray:
        """Row of the suffix that is one symbol longer, for every row."""
        if self._steps[side] is None:
            order = np.argsort(self.bwt[side], kind="stable")
            step = np.empty(len(order), dtype=np.int32 if len(order) < 1 << 31 else np.int64)
            step[order] = np.arange(len(order), dtype=step.dtype)
            self._steps[side] = step
        return self._steps[side]

    def extend(self, side: int, near: np.ndarray, far: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """All extensions of intervals by one symbol: to the left with side 0, to the right with side 1.

        ``near``: starts in the BWT of that side, ``far``: in the other one. Gives for
        each extension the interval it comes from, its starts near and far, its size and
        the symbol, in runs of about ``EXTEND_ROWS`` rows to bound memory.
        """
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // EXTEND_ROWS)) + 1
        for a, b in pairwise([0, *cuts.tolist(), len(size)]):
            if size[a:b].any():
                yield self._extend(side, near[a:b], far[a:b], size[a:b], a)

    def _extend(self, side: int, near: np.ndarray, far: np.ndarray, size: np.ndarray, base: int) -> tuple[np.ndarray, ...]:
        total = np.cumsum(size)
        of = np.repeat(np.arange(len(size)), size)
        rows = np.arange(total[-1]) + np.repeat(near - (total - size), size)
        symbol = self.bwt[side][rows]
        key = of * len(self.counts) + symbol
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        at = order[first]
        come, symbol = of[at], symbol[at]
        # smaller symbols of the interval come first on the far side
        before = first - (total - size)[come]
        real = symbol > 0
        return come[real] + base, self._step(side)[rows[at[real]]].astype(np.int64), (far[come] + before)[real], count[real], \
            symbol[real]


def _all(runs: Iterator[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    none = np.zeros(0, dtype=np.int64)
    return [np.concatenate(x) for x in zip((none,) * 5, *runs, strict=True)]


def _extensions(index: BidirectionalIndex, lo: np.ndarray, rlo: np.ndarray, size: np.ndarray, ids: np.ndarray
                ) -> tuple[np.ndarray, ...]:
    """One word longer phrases whose first and last words are both among the given ones: forward and reverse starts, size,
    ids of the first and of the last words."""
    prefix, right_rlo, right_lo, count, _ = _all(index.extend(1, rlo, lo, size))
    suffix, left_lo, *_ = _all(index.extend(0, lo, rlo, size))
    _, a, b = np.intersect1d(right_lo, left_lo, assume_unique=True, return_indices=True)
    return right_lo[a], right_rlo[a], count[a], ids[prefix[a]], ids[suffix[b]]


_DEALT = "bucket long, shard long, block binary"


def _dealt(shard: int, found: list[np.ndarray] | tuple[np.ndarray, ...], buckets: int) -> pa.RecordBatch:
    """Phrases of a shard (forward and reverse starts, size, ids of first and last words): a row for each bucket."""
    lo, rlo, size, prefix, suffix = (np.asarray(x, dtype=np.int64) for x in found)
    bucket = (mix(mix(prefix.astype(U64)) + suffix.astype(U64)) % U64(buckets)).astype(np.int64)
    by = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by])) + 1
    parts = [by[a:b] for a, b in pairwise([0, *cuts.tolist(), len(by)])] if len(by) else []
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[p[0]]) for p in parts], pa.int64()), pa.array([shard] * len(parts), pa.int64()),
         pa.array([_pack([lo[p], prefix[p]], [rlo[p], suffix[p], size[p]]) for p in parts], pa.binary())],
        names=["bucket", "shard", "block"])


def _index_shard(shards: pa.Table, frequent: pa.Table, depth: int) -> pa.Table:
    """Index of a shard over its frequent words, symbols by falling count."""
    schema = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("bwt", pa.binary()), ("reverse", pa.binary())])
    if not shards.num_rows or not frequent.num_rows:
        return schema.empty_table()
    seq = _array(shards, "seq", 0, _SYMBOL)
    word, ids, size = (frequent.column(c).to_numpy() for c in ("place", "id", "size"))
    order = np.lexsort((ids, -size))
    symbol = np.zeros(max(int(seq.max(initial=0)), int(word.max())) + 1, dtype=np.int32)
    symbol[word[order]] = np.arange(1, len(order) + 1)
    seq = symbol[seq]
    # one separator between pieces is enough, and none stands for a lone word
    word_here = np.concatenate([[False], seq > 0, [False]])
    alone = word_here[1:-1] & ~word_here[:-2] & ~word_here[2:]
    seq = np.where(alone, 0, seq)
    seq = seq[(seq > 0) | np.concatenate([[True], seq[:-1] > 0])]
    seq = np.concatenate([seq, np.zeros(1, dtype=np.int32)])
    index = BidirectionalIndex.build(seq, depth)
    return pa.Table.from_arrays(
        [pa.array([shards.column("shard")[0].as_py()], pa.int64()), pa.array([_pack([], [ids[order]])], pa.binary()),
         *(pa.array([_pack([], [b], _SYMBOL)], pa.binary()) for b in index.bwt)], schema=schema)


def _array(table: pa.Table, column: str, row: int, kind: str) -> np.ndarray:
    return _unpack(table.column(column)[row].as_buffer(), 0, 1, kind)[0]


def _load(table: pa.Table, row: int) -> BidirectionalIndex:
    return BidirectionalIndex(_array(table, "bwt", row, _SYMBOL), _array(table, "reverse", row, _SYMBOL))


def _pairs(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Two-word phrases of every shard; all its words are frequent, so extensions to the right are enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(table.num_rows):
                index, ids = _load(table, i), _array(table, "ids", i, _NUMBER)
                lo, rlo, size = index.words()
                first, at, far, count, last = _all(index.extend(1, rlo, lo, size))
                yield _dealt(table.column("shard")[i].as_py(), (far, at, count, ids[first], ids[last - 1]), buckets)

    return run


def _trimmed(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``work`` on one shard at a time, after which freed memory goes back."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        [made] = lean(lambda _: iter([work(left, right)]))(iter(()))
        return made

    return run


def _longer(buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One word longer phrases of a shard from those that are still frequent."""

    def run(index: pa.Table, alive: pa.Table) -> pa.Table:
        if not index.num_rows or not alive.num_rows:
            return pa.Table.from_batches([_dealt(0, (np.zeros(0),) * 5, buckets)])
        blocks = [_unpack(b, 1, 4) for b in alive.column("block").to_pylist()]
        found = _extensions(_load(index, 0), *np.concatenate(blocks, axis=1))
        return pa.Table.from_batches([_dealt(index.column("shard")[0].as_py(), found, buckets)])

    return run


#: stands in place of a shard where a block holds phrases of all shards
_EVERY = -1


def _frequent(dealt: DataFrame, buckets: int, least: int) -> DataFrame:
    """Phrases whose sizes reach ``least`` over all shards: for each bucket a block of their ids, first and last words'
    ids and sums (under ``_EVERY``), and for each shard its blocks of forward and reverse starts, sizes and ids."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, shards = table.column("bucket")[0].as_py(), table.column("shard").to_pylist()
        parts = [_unpack(b, 2, 5) for b in table.column("block").to_pylist()]
        ends = np.cumsum([p.shape[1] for p in parts]).tolist()
        lo, prefix, rlo, suffix, size = np.concatenate(parts, axis=1)
        del parts
        order = np.lexsort((suffix, prefix))
        a, b = prefix[order], suffix[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        f = np.add.reduceat(size[order], first)
        live = f >= least
        if not live.any():
            return
        names = np.where(live, (np.cumsum(live) - 1) * buckets + bucket, -1)
        own = np.empty(len(order), dtype=np.int64)
        own[order] = np.repeat(names, np.diff(np.append(first, len(order))))
        at = first[live]
        to, blocks = [_EVERY], [_pack([], [names[live], a[at], b[at], f[live]])]
        for shard, (start, end) in zip(shards, pairwise([0, *ends]), strict=True):
            here = start + np.flatnonzero(own[start:end] >= 0)
            if len(here):
                to.append(shard)
                blocks.append(_pack([lo[here]], [rlo[here], size[here], own[here]]))
        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(blocks, pa.binary())], names=["shard", "block"])

    return per_group(dealt, ["bucket"], ["shard"], work, "shard long, block binary")


def _level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _unpack(block, 0, 4)], names=["id", "prefix", "suffix", "f"])


def _summed(rows: DataFrame, keys: list[str], place: str, least: int) -> DataFrame:
    """Rows of the keys whose sizes reach ``least`` over all shards, with that sum (f) and an id of the key.

    A shard has one row of a key at most, so that no key holds more rows than there are shards.
    """
    same = Window.partitionBy(*keys)
    number = F.shiftleft(F.col("shard"), _PLACE_BITS).bitwiseOR(F.col(place))
    return (rows.withColumns({"f": F.sum("size").over(same), "id": F.min(number).over(same)})
            .where(F.col("f") >= least))


def _score(n_words: int) -> Column:
    """The lowest cut: struct of score, first words, l and r."""
    cuts = []
    for k in range(1, n_words):
        first, rest = F.col("pre")[k - 1], F.col("suf")[n_words - k - 1]
        wide = [c.cast("decimal(19,0)") for c in (F.col("f"), F.col("n"), first, rest)]
        top = (F.lit(1000).cast("decimal(4,0)") * wide[0]).cast("decimal(19,0)") * wide[1]
        cuts.append(F.struct(_whole(top, wide[2] * wide[3]).alias("score"), F.lit(k).alias("k"),
                             first.alias("l"), rest.alias("r")))
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def _whole(top: Column, bottom: Column) -> Column:
    """Whole part of the quotient of two decimals, in exact arithmetic: the remainder is taken off first."""
    return ((top - top % bottom) / bottom).cast("decimal(38,0)").cast("long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, least: int = 100,
                 top: int = 2000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A text's A-Z are lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are
    ``[^\\x20\\x09]+`` in them. Candidates are phrases of 2 to ``max_words`` words
    met ``least`` times or more within pieces of the language (a; null: ``und``);
    n counts all words, l and r the first and the last words at the cut of the
    lowest score floor(1000 a n / (l r)). A candidate inside a longer one of the
    same count is dropped. The first ``top`` by score, a (falling) and phrase are
    kept. Null and empty texts have no words, repeated rows count again, other
    columns are ignored, and an empty table gives no row.
    """
    spark = docs.sparkSession
    prepare(spark)
    if least < 1 or max_words < 2:
        raise ValueError("needs least >= 1 and max_words >= 2")
    with scratch(spark) as keep:
        found, totals = _levels(docs, text_col, lang_col, max_words, least, shard_bytes)
        return keep(_ranked(found, totals, top), "collocations")


def _levels(docs: DataFrame, text_col: str, lang_col: str, max_words: int, least: int, shard_bytes: int
            ) -> tuple[list[DataFrame], DataFrame]:
    """Per number of words the frequent phrases (id, f and first and last words' ids), and all words of each language."""
    with scratch(docs.sparkSession) as keep:
        shards = staged(word_shards(docs, text_col, lang_col, shard_bytes), "shards")
        words = shards.select("shard", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("at", "w")).select(
            "shard", (F.col("at") + 1).cast("long").alias("place"), F.col("w.langs").alias("lang"),
            F.col("w.words").alias("word"), F.col("w.counts").alias("size"))
        totals = keep(words.groupBy("lang").agg(F.sum("size").alias("n")), "totals")
        frequent = staged(_summed(words, ["lang", "word"], "place", least), "frequent")
        levels = [keep(frequent.groupBy("id").agg(F.first("lang").alias("lang"), F.first("word").alias("word"),
                                                  F.first("f").alias("f")), "words")]
        index = keep(shards.select("shard", "seq").groupBy("shard").cogroup(
            frequent.select("shard", "place", "id", "size").groupBy("shard")).applyInArrow(
                _trimmed(lambda a, b: _index_shard(a, b, max_words)), "shard long, ids binary, bwt binary, reverse binary"), "index")
    n = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(2 * shuffle_width(docs.sparkSession), n // BUCKET_WORDS + 1)
    alive = None
    for length in range(2, max_words + 1):
        if alive is None:
            longer = index.mapInArrow(lean(_pairs(buckets)), _DEALT)
        else:
            alive = alive.where(F.col("shard") != _EVERY)
            longer = index.groupBy("shard").cogroup(alive.groupBy("shard")).applyInArrow(_trimmed(_longer(buckets)), _DEALT)
        alive = staged(_frequent(longer, buckets, least), f"phrases{length}")
        levels.append(alive.where(F.col("shard") == _EVERY).select("block").mapInArrow(
            lean(_level), "id long, prefix long, suffix long, f long"))
    return levels, totals


def _ranked(levels: list[DataFrame], totals: DataFrame, top: int) -> DataFrame:
    none = F.array().cast("array<long>")
    known = levels[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                             none.alias("pre"), none.alias("suf"))
    out = None
    for length, level in enumerate(levels[1:], 2):
        begin = known.select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("head"),
                             F.array_append("pre", F.col("f")).alias("pre"))
        rest = known.select(F.col("id").alias("suffix"), "last", F.array_append("suf", F.col("f")).alias("suf"))
        known = staged(level.join(begin, "prefix").join(rest, "suffix").select(
            "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", "pre", "suf"), f"texts{length}")
        mine = known
        if length < len(levels):
            longer = levels[length].select(F.explode(F.array("prefix", "suffix")).alias("id"), "f")
            mine = mine.join(longer.groupBy("id").agg(F.max("f").alias("most")), "id", "left").where(
                F.col("most").isNull() | (F.col("most") < F.col("f")))
        mine = mine.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", _score(length).alias("cut"))
        out = mine if out is None else out.unionByName(mine)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (out.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                       F.col("cut.score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = {"op13_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
seqs AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM seqs GROUP BY lang),
grams AS (
  SELECT lang, len AS words, array_to_string(w[i:i + len - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM seqs), (SELECT unnest([1, 2, 3, 4, 5]) AS len)
  WHERE i + len - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, words, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE words >= 2),
inside AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + len - 1], ' ') AS phrase, c.f
  FROM (SELECT *, unnest(range(1, words + 1)) AS i FROM cand) c, (SELECT unnest([2, 3, 4]) AS len)
  WHERE len < words AND i + len - 1 <= words),
cuts AS (
  SELECT c.lang, c.phrase, c.words, c.f AS a, k, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand) c
  JOIN grams l ON l.lang = c.lang AND l.words = k AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.words = c.words - k AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f >= 100 * b.a))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""}
