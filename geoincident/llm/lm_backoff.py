"""Language-model scoring by a weighted backoff automaton (op 7).

Every pair and triple of words that occurs ``least`` times in the training
documents is a state and an arc, so the model grows with the corpus; nothing of
it is broadcast or collected.

Automaton: a state is a known context of one or two words. An arc for word x
carries log10 (c(hx) - 1/2) / c(h); a failure arc leads to the shorter context
and carries the weight that makes the probabilities of a state add up to 1; the
last state has the smoothed unigrams of the base score.

Documents are dealt by a hash of id and text into chunks of about CHUNK_BYTES.
1. Each chunk counts its different words and pairs and sends them, by ranges of
   their hashes, to buckets. A bucket adds up the exact counts and answers every
   chunk, in the order of the chunk's own sorted keys. Then the same is done for
   triples, only those whose two pairs are states: no other can occur as often.
2. Each chunk gets its counts back. Of every key one chunk, the first that has
   it, gives the arc's probability to the arc's state; buckets of states add
   these up and answer with the failure weights.
3. Each chunk traverses its texts with its part of the automaton.

Keys travel as blocks of bytes, a block per chunk and bucket, so frequent words
cost one key per chunk, and no step has a row per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.llm.common import per_group, prepare, scratch, staged
from geoincident.llm.words import U64, blocks, hash_words, mix

#: hash of the end of a text, counted as a token
END = U64(0x5E9D1E0F0A57B1C3)
#: bytes of text in a chunk, and of all texts for one bucket of each order
CHUNK_BYTES, BUCKET_BYTES = 6 << 20, 12 << 20
_DISCOUNT = 0.5
_EVEN = U64(0xFFFFFFFFFFFFFFFE)
#: rows of an Arrow batch; a block of keys can be as large as a chunk
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_ROWS = "256"
_BLOCKS = "grp long, chunk long, size long, data binary, total long, kinds long"


def _tokens(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per block of texts: token hashes with ends, the first token of each text, index of the first text."""
    for lo, hi in blocks(texts):
        words, first = hash_words(texts[lo:hi])
        n = hi - lo
        at = first + np.arange(n + 1)
        out = np.empty(len(words) + n, dtype=U64)
        ends = at[1:] - 1
        body = np.ones(len(out), dtype=bool)
        body[ends] = False
        out[body], out[ends] = words, END
        yield out, at, lo


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(3) + b * U64(0x9E3779B97F4A7C15) + U64(1))


def _grams(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pair and the triple that end at each token; 0 where the text has none."""
    two, three = np.zeros(len(tokens), dtype=U64), np.zeros(len(tokens), dtype=U64)
    two[1:] = _pair(tokens[:-1], tokens[1:])
    two[first[:-1]] = 0
    three[2:] = _pair(two[1:-1], tokens[2:])
    three[first[:-1]] = 0
    second = first[:-1] + 1
    three[second[second < len(tokens)]] = 0
    return two, three


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Stable order of the keys: one sort of their leading bits, with their places in the bits below, in place of an argsort."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    least = keys.min()
    lead = (keys - least) << U64(64 - int(keys.max() - least).bit_length() if keys.max() > least else 0)
    below = U64((1 << len(keys).bit_length()) - 1)
    lead &= ~below
    lead |= np.arange(len(keys), dtype=U64)
    lead.sort()
    lead &= below
    order = lead.astype(np.int64)
    got = keys[order]
    if (got[1:] < got[:-1]).any():  # some differ in the lower bits only
        return np.argsort(keys, kind="stable")
    return order


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Whether a sorted key is the first of its kind."""
    return np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]


def _planes(column: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(column).view(np.uint8).reshape(-1, column.itemsize).T).tobytes()


def _plain(data: bytes, size: int, kind: str, at: int = 0) -> tuple[np.ndarray, int]:
    end = at + size * np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8, end - at, at).reshape(np.dtype(kind).itemsize, size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(size), end


def _wire(column: np.ndarray) -> bytes:
    """Byte planes; of floats, most of which are 0, a bit each and then the others."""
    if column.dtype.kind != "f":
        return _planes(column)
    some = column != 0
    return np.packbits(some).tobytes() + _planes(column[some])


def _unwire(data: bytes, size: int, kind: str, at: int = 0) -> tuple[np.ndarray, int]:
    if np.dtype(kind).kind != "f":
        return _plain(data, size, kind, at)
    width = -(-size // 8)
    some = np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size).astype(bool)
    out = np.zeros(size, dtype=kind)
    if some.any():
        out[some], at = _plain(data, int(some.sum()), kind, at + width)
        return out, at
    return out, at + width


def _pack(*columns: np.ndarray) -> bytes:
    """Columns one after the other; the first one's differences, as it ascends."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    return b"".join(_wire(c) for c in (first, *columns[1:]))


def _unpack(data: bytes, size: int, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        column, at = _unwire(data, size, kind, at)
        out.append(column)
    return [np.cumsum(out[0], dtype=out[0].dtype), *out[1:]]


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    """(grp, chunk, size, data, total, kinds)"""
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(columns)],
        names=["grp", "chunk", "size", "data", "total", "kinds"])


class _Chunk:
    """Tokens of a chunk's texts and the sorted keys of each order; keys are even hashes."""

    def __init__(self, table: pa.Table):
        texts = table.filter(pc.less(table.column("grp"), 0))
        self.ids = texts.column("id")
        learn = np.array(texts.column("learn").to_pylist(), dtype=bool)
        parts = [(t, f) for t, f, _ in _tokens(texts.column("text").cast(pa.binary()).to_pylist())]
        self.tokens = np.concatenate([t for t, _ in parts])
        base = np.cumsum([0, *(len(t) for t, _ in parts)])
        self.first = np.concatenate([*(f[:-1] + b for (_, f), b in zip(parts, base[:-1], strict=True)), base[-1:]])
        two, three = _grams(self.tokens, self.first)
        self.inside2, self.inside3 = two != 0, three != 0
        self.learned = np.repeat(learn, np.diff(self.first)).astype(U64)
        self.grams = [x & _EVEN for x in (self.tokens, two, three)]
        self.mine: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []

    def count(self, order: int, ok: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of an order at the tokens ``ok`` and how often each is learned here."""
        code = np.sort(self.grams[order - 1][ok] | self.learned[ok])
        key = code & _EVEN
        if not len(key):
            return key, np.zeros(0, np.uint32)
        at = np.flatnonzero(_firsts(key))
        return key[at], np.add.reduceat(code & U64(1), at).astype(np.uint32)

    def _known(self, table: pa.Table, buckets: int, order: int, ok: np.ndarray, least: float) -> np.ndarray:
        """Index of the key that ends at each token ``ok`` and has ``least`` occurrences; else -1."""
        at = np.flatnonzero(ok)
        keys = self.grams[order - 1][at]
        by = _ordered(keys)
        keys = keys[by]
        new = _firsts(keys)
        counts = _answers(table, buckets, order, "<u8")
        keep = (counts >> U64(1)) >= least
        self.keys.append(keys[new][keep])
        self.n.append((counts[keep] >> U64(1)).astype(np.float64))
        self.mine.append((counts[keep] & U64(1)).astype(bool))
        out = np.full(len(self.tokens), -1, dtype=np.int64)
        out[at[by]] = np.where(keep, np.cumsum(keep) - 1, -1)[np.cumsum(new) - 1]
        return out

    def locate(self, table: pa.Table, buckets: int, least: float) -> None:
        """The known words and pairs, and the tokens that a known triple may end at."""
        self.word = self._known(table, buckets, 1, np.ones(len(self.tokens), dtype=bool), 1)
        self.pair = self._known(table, buckets, 2, self.inside2, least)
        self.may = self.inside3 & (self.pair >= 0)
        self.may[1:] &= self.pair[:-1] >= 0

    def locate_all(self, table: pa.Table, buckets: int, least: float) -> None:
        self.locate(table, buckets, least)
        self.triple = self._known(table, buckets, 3, self.may, least)

    def arcs(self, level: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of the words and the pairs: keys, probability of the arcs given by this chunk, and that of the shorter context."""
        n1, n2, n3 = self.n
        for state, arc, (keys, n), (mine, longer) in (
                (self.word, self.pair, (self.keys[0], n1), (self.mine[1], n2)),
                (self.pair, self.triple, (self.keys[1], n2), (self.mine[2], n3))):
            at = np.full(len(longer), -1, dtype=np.int64)
            some = np.flatnonzero(arc >= 0)
            at[arc[some]] = some
            own = np.flatnonzero(mine & (at >= 0))
            at = at[own]
            left, low = state[at - 1], state[at]
            lower = (n1[low] + 0.5) / 10 ** level if arc is self.pair else (n2[low] - _DISCOUNT) / n1[self.word[at - 1]]
            yield (keys, np.bincount(left, weights=(longer[own] - _DISCOUNT) / n[left], minlength=len(n)),
                   np.bincount(left, weights=lower, minlength=len(n)))

    def scores(self, fail1: np.ndarray, fail2: np.ndarray, level: float) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, score. The state before a token is the longest known context."""
        n1, n2, n3 = self.n
        word, pair, triple = self.word, self.pair, self.triple
        base = np.full(len(word), np.log10(0.5) - level)
        base[word >= 0] = np.log10(n1[word[word >= 0]] + 0.5) - level
        inner = np.flatnonzero(self.inside2)  # tokens with a word before them
        by3 = triple >= 0
        by2 = ~by3 & (pair >= 0)
        weight = np.where(by3 | by2, 0.0, base)
        at = np.flatnonzero(by3)
        weight[at] += np.log10((n3[triple[at]] - _DISCOUNT) / n2[pair[at - 1]])
        at = np.flatnonzero(by2)
        weight[at] += np.log10((n2[pair[at]] - _DISCOUNT) / n1[word[at - 1]])
        # from a state without the arc: its failure arc
        at = inner[~by3[inner] & (pair[inner - 1] >= 0)]
        weight[at] += fail2[pair[at - 1]]
        at = inner[~by3[inner] & ~by2[inner] & (word[inner - 1] >= 0)]
        weight[at] += fail1[word[at - 1]]
        start = self.first[:-1]
        return (np.diff(self.first), np.add.reduceat(word >= 0, start, dtype=np.int64),
                np.add.reduceat(base, start), np.add.reduceat(weight, start))


def _deal(order: int, keys: np.ndarray, *columns: np.ndarray, buckets: int, only: range | None = None
          ) -> Iterator[tuple[int, int, bytes]]:
    """(group, number of keys, bytes) of every bucket (of ``only``) that has some of the sorted keys."""
    width = (1 << 64) // buckets + 1
    cut = np.searchsorted(keys, np.array([b * width for b in range(buckets)], dtype=U64))
    cut = [*cut.tolist(), len(keys)]
    for b in only or range(buckets):
        x, y = cut[b], cut[b + 1]
        if y > x:
            yield order * buckets + b, y - x, _pack(keys[x:y], *(c[x:y] for c in columns))


def _answers(table: pa.Table, buckets: int, order: int, kind: str) -> np.ndarray:
    """The buckets' answers of an order, in the order of the chunk's keys."""
    rows = table.select(["grp", "size", "data"])
    rows = rows.filter(pc.equal(pc.floor(pc.divide(rows.column("grp"), buckets)), order)).sort_by("grp")
    got = [np.zeros(0, dtype=kind)]
    for size, data in zip(rows.column("size").to_pylist(), rows.column("data").to_pylist(), strict=True):
        got.append(_unwire(data, size, kind)[0])
    return np.concatenate(got)


def _add_up(table: pa.Table, kinds: tuple[str, ...], answer) -> Iterator[pa.RecordBatch]:
    """Sums each key's columns over the chunks of a bucket and answers every chunk; one more row, of chunk -1,
    with the sum of the first column and the number of keys where it is not 0."""
    group, chunks = table.column("grp")[0].as_py(), table.column("chunk").to_pylist()
    sent = [_unpack(d, n, "<u8", *kinds) for d, n in
            zip(table.column("data").to_pylist(), table.column("size").to_pylist(), strict=True)]
    keys = np.concatenate([x[0] for x in sent])
    order = _ordered(keys)
    new = _firsts(keys[order])
    at = np.flatnonzero(new)
    sums = [np.add.reduceat(np.concatenate([x[i + 1] for x in sent])[order], at, dtype="f8" if k == "<f8" else "i8")
            for i, k in enumerate(kinds)]
    value = answer(*sums)[np.cumsum(new) - 1]
    out = np.empty(len(keys), dtype=value.dtype)
    out[order] = value
    if out.dtype == U64:  # the first chunk that has the key is told so
        out[order[at]] |= U64(1)
    ends = np.cumsum([0, *(len(x[0]) for x in sent)])
    for i, chunk in enumerate(chunks):
        part = out[ends[i]:ends[i + 1]]
        yield _block_rows([(group, chunk, len(part), _wire(part), None, None)])
    yield _block_rows([(group, -1, 0, None, int(sums[0].sum()), int(np.count_nonzero(sums[0])))])


def score_texts(docs: DataFrame, train: F.Column, id_col: str = "doc_id", text_col: str = "text",
                share: float = 0.0, least: int = 2) -> DataFrame:
    """Base and model log10 probability of every text, learned from the rows where ``train`` holds.

    Pairs and triples of ``least`` occurrences (1 and more) are states.
    ``share`` asks for that share of the training tokens as well, 0 for none.

    Returns one row per input row: id, n_tokens, n_known, train_tokens,
    base_score, score. Null text is empty: its one token is the end. Repeated
    rows and ids, null ones too, keep rows of their own; rows equal in id and
    text fall into one chunk. Extra columns are ignored. Without training rows
    every word is unknown; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, _BATCH_ROWS)
    try:
        with scratch(spark) as keep:
            return _score(docs, train, id_col, text_col, share, max(1, least), keep)
    finally:
        spark.conf.set(_BATCH, before)


def _score(docs: DataFrame, train: F.Column, id_col: str, text_col: str, share: float, least: int, keep) -> DataFrame:
    size = docs.agg(F.coalesce(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 1), F.lit(0))).first()[0]
    chunks, buckets = max(8, -(-size // CHUNK_BYTES)), max(8, -(-size // BUCKET_BYTES))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.pmod(F.xxhash64(id_col, text_col), F.lit(chunks)).alias("chunk"), F.lit(-1).cast("long").alias("grp"),
        F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("learn"), F.col(text_col).alias("text"),
        F.lit(None).cast("long").alias("size"), F.lit(None).cast("binary").alias("data"))

    def beside(*answers: DataFrame, lo: int = 0, hi: int = chunks) -> DataFrame:
        own = F.col("chunk").between(lo, hi - 1)
        out = texts.where(own)
        for x in answers:
            out = out.unionByName(x.where(own).select("chunk", "grp", "size", "data"), allowMissingColumns=True)
        return out

    def count(table: pa.Table) -> Iterator[pa.RecordBatch]:
        own, chunk = _Chunk(table), table.column("chunk")[0].as_py()
        for k, ok in ((1, slice(None)), (2, own.inside2)):
            for group, n, data in _deal(k, *own.count(k, ok), buckets=buckets):
                yield _block_rows([(group, chunk, n, data, None, None)])

    def count_triples(table: pa.Table) -> Iterator[pa.RecordBatch]:
        own, chunk = _Chunk(table), table.column("chunk")[0].as_py()
        own.locate(table, buckets, wanted)
        for group, n, data in _deal(3, *own.count(3, own.may), buckets=buckets):
            yield _block_rows([(group, chunk, n, data, None, None)])

    def total_counts(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _add_up(table, ("<u4",), lambda n: n.astype(U64) << U64(1))

    # blocks of keys are only shuffled, the answers are written
    counts = staged(per_group(per_group(texts, ["chunk"], [], count, _BLOCKS), ["grp"], [], total_counts, _BLOCKS), "counts")
    total, kinds = (counts.where(F.col("chunk") == -1).where(F.col("grp") < 2 * buckets)
                    .agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first())
    level = float(np.log10(total + 0.5 * (kinds + 1)))
    wanted = max(least, share * total)
    triples = staged(per_group(per_group(beside(counts), ["chunk"], [], count_triples, _BLOCKS),
                               ["grp"], [], total_counts, _BLOCKS), "triples")

    def arcs(only: range):
        def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
            own, chunk = _Chunk(table), table.column("chunk")[0].as_py()
            own.locate_all(table, buckets, wanted)
            for k, (keys, spent, below) in enumerate(own.arcs(level), 4):
                for group, n, data in _deal(k, keys, spent, below, buckets=buckets, only=only):
                    yield _block_rows([(group, chunk, n, data, None, None)])

        return run

    def failures(table: pa.Table) -> Iterator[pa.RecordBatch]:
        # what is left to the shorter context, over what the state's own arcs leave there; 0 without arcs
        yield from _add_up(table, ("<f8", "<f8"), lambda spent, below: np.log10(
            np.maximum(1 - spent, 1e-300) / np.maximum(1 - below, 1e-300)))

    def score(table: pa.Table) -> Iterator[pa.RecordBatch]:
        own = _Chunk(table)
        own.locate_all(table, buckets, wanted)
        out = own.scores(*(_answers(table, buckets, k, "<f8") for k in (4, 5)), level)
        yield from pa.Table.from_arrays([own.ids, *map(pa.array, out)],
                                        names=["id", "n_tokens", "n_known", "base_score", "score"]).to_batches()

    # one half of the buckets after the other, so that only one's sums lie on disk
    failed = [staged(per_group(per_group(beside(counts, triples), ["chunk"], [], arcs(only), _BLOCKS),
                               ["grp"], [], failures, _BLOCKS), "failures")
              for only in (range(buckets // 2), range(buckets // 2, buckets))]
    # likewise one half of the chunks' texts and answers
    parts = [keep(per_group(beside(counts, triples, *failed, lo=lo, hi=hi), ["chunk"], [], score,
                            f"id {kind}, n_tokens long, n_known long, base_score double, score double"), "scored")
             for lo, hi in ((0, chunks // 2), (chunks // 2, chunks))]
    scored = parts[0].unionByName(parts[1])
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op7_lm_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns on the folds (crc32 of the id modulo 5) other than 1 and scores all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    out = score_texts(docs, fold != 1)
    return out.withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))


#: the base score; the automaton's score has no SQL form, so the query has none
