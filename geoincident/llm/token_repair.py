"""Token ids in a Re-Pair compressed binary format (op 5).

Documents are dealt out in ascending id order; each task encodes its texts and
writes shards of whole documents. In a shard, rounds of Re-Pair replace frequent
id pairs by nonterminals; the shard stores the rules with their expansion
lengths and, for each document, its number of ids, so that any range of ids can
be decoded without the rest.

Shard, little endian: ``RPTK``, then u32 documents, rules, symbols, terminals;
the rules as u32 (left, right, length); the documents' numbers of ids as i64;
the symbols' lower 16 bits as u16, then their upper 8 bits as u8. Symbols below ``terminals`` are ids, the others rules.
A file is a Parquet table: part and nth (the shards' order), the documents' own
ids, n_ids and the shard.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import kept, lean, prepare, shuffle_width, staged
from geoincident.llm.words import blocks, hash_spans, word_spans

_MAGIC = b"RPTK"
_SLOT_BITS = 18
_SLOTS = 1 << _SLOT_BITS


#: letters that the tokenizer's normaliser maps one to one and its pattern keeps in one piece
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def _split_stops(low: bytes, begin: np.ndarray, end: np.ndarray, first: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans with one full stop or comma at the end of a word, after a letter a-z, as a span of its own.

    That is a piece of its own to the tokenizer's pattern too.
    """
    raw = np.frombuffer(low, dtype=np.uint8)
    last, before = raw[end - 1], raw[end - 2]
    stop = ((last == 0x2E) | (last == 0x2C)) & (end - begin > 1) & (before >= 0x61) & (before <= 0x7A)
    size = 1 + stop
    at = np.cumsum(size) - size
    begin, end = np.repeat(begin, size), np.repeat(end, size)
    two = at[stop]
    end[two] -= 1
    begin[two + 1] = end[two + 1] - 1
    return begin, end, np.concatenate([at, [len(begin)]])[first]


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others for the next free code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class WordIds(dict):
    """Ids of words (A-Z lower-cased) as u32 bytes, encoded when first met.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words. Words of plain letters are one piece of its pattern
    and go to the library's model at once. Emptied at ``most`` words to bound memory.
    """

    def __init__(self, tokenizer, most: int = 500_000):
        super().__init__()
        self.tokenizer, self.model, self.most = tokenizer, tokenizer.model, most
        self.letters = _byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode().lower()
        if _LETTERS.fullmatch(text):
            mapped = text if text.isascii() else "".join([self.letters[b] for b in text.encode()])
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        else:
            ids = self._whole(word.decode())
        if len(self) >= self.most:
            self.clear()
        self[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Ids of every text. In a block of texts each different word (by 64-bit hash) is looked up once."""
        for lo, hi in blocks(texts):
            # a text that may hold the name of a special token, which the tokenizer finds in raw text, goes whole
            odd = {i: self._whole(t.decode()) for i, t in enumerate(texts[lo:hi]) if t and b"<|" in t}
            low, begin, end, first = word_spans([b"" if i in odd else t for i, t in enumerate(texts[lo:hi])])
            begin, end, first = _split_stops(low, begin, end, first)
            _, at, which = np.unique(hash_spans(low, begin, end), return_index=True, return_inverse=True)
            known = [self[low[a:b]] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            flat = np.frombuffer(b"".join(known), dtype="<u4")
            size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
            start = (np.cumsum(size) - size)[which]
            size = size[which]
            stop = np.concatenate([[0], np.cumsum(size)])
            ids = flat[np.arange(stop[-1]) + np.repeat(start - stop[:-1], size)]
            cut = stop[first].tolist()
            for i, (a, b) in enumerate(pairwise(cut)):
                yield np.frombuffer(odd[i], dtype="<u4") if i in odd else ids[a:b]


_WORD_IDS: dict[str, WordIds] = kept("word_ids")


def word_ids(path: str) -> WordIds:
    """One per Python worker and tokenizer file."""
    if path not in _WORD_IDS:
        from tokenizers import Tokenizer

        _WORD_IDS[path] = WordIds(Tokenizer.from_file(path))
    return _WORD_IDS[path]


def compress(ids: np.ndarray, terminals: int, rounds: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rounds of replacing the pairs met ``least`` times, more frequent ones first.

    Pairs are counted in a table by hash; of pairs that share a slot one has its
    turn, the others theirs in a later round. Where chosen pairs overlap, the
    more frequent one wins, and in a run of one id every second place.
    """
    seq, rules = ids.astype(np.int64), [np.zeros((0, 2), dtype=np.int64)]
    symbols = terminals
    for turn in range(rounds):
        if len(seq) < 2:
            break
        pair = (seq[:-1] << 32) | seq[1:]
        slot = ((pair ^ (pair >> 29)) * (0x9E3779B97F4A7C15 - (1 << 64) + 2 * turn)) >> (64 - _SLOT_BITS) & (_SLOTS - 1)
        count = np.bincount(slot, minlength=_SLOTS)
        owner = np.zeros(_SLOTS, dtype=np.int64)
        owner[slot] = pair
        often = np.flatnonzero((count[slot] >= least) & (owner[slot] == pair))
        place = slot[often]
        count = np.bincount(place, minlength=_SLOTS)
        score = np.where(count >= least, ((count << _SLOT_BITS) + np.arange(_SLOTS)) << 1, -2)
        rank = np.full(len(seq) + 1, -2, dtype=np.int64)
        rank[1 + often] = score[place] + (often & 1)
        here = rank[1:-1]
        win = np.flatnonzero((here > 0) & (here > rank[:-2]) & (here > rank[2:]))
        if not len(win):
            break
        chosen = np.zeros(_SLOTS, dtype=bool)
        chosen[slot[win]] = True
        used = np.flatnonzero(chosen)
        name = np.zeros(_SLOTS, dtype=np.int64)
        name[used] = symbols + np.arange(len(used))
        rules.append(np.stack([owner[used] >> 32, owner[used] & 0xFFFFFFFF], axis=1))
        seq[win] = name[slot[win]]
        keep = np.ones(len(seq), dtype=bool)
        keep[win + 1] = False
        seq = seq[keep]
        symbols += len(used)
    return seq, np.concatenate(rules)


def _expand(seq: np.ndarray, terminals: int, rules: np.ndarray) -> np.ndarray:
    """The ids that the symbols stand for."""
    while True:
        is_rule = seq >= terminals
        if not is_rule.any():
            return seq
        size = 1 + is_rule
        at = (np.cumsum(size) - size)[is_rule]
        rule = seq[is_rule] - terminals
        seq = np.repeat(seq, size)
        seq[at], seq[at + 1] = rules[rule, 0], rules[rule, 1]


def write_shard(counts: list[int], ids: np.ndarray, rounds: int, least: int) -> bytes:
    """A shard of documents with these numbers of ids."""
    terminals = int(ids.max(initial=0)) + 1
    seq, rules = compress(ids, terminals, rounds, least)
    length = np.ones(terminals + len(rules), dtype=np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        length[terminals + r] = length[a] + length[b]
    table = np.concatenate([rules, length[terminals:, None]], axis=1).astype("<u4")
    if len(length) > 1 << 24:
        raise ValueError("a shard can name 16,777,216 symbols")
    head = np.array([len(counts), len(rules), len(seq), terminals], dtype="<u4")
    return b"".join([_MAGIC, head.tobytes(), table.tobytes(), np.array(counts, dtype="<i8").tobytes(),
                     (seq & 0xFFFF).astype("<u2").tobytes(), (seq >> 16).astype(np.uint8).tobytes()])


class Shard:
    """A written shard; ``ids(start, stop)`` decodes a range of its ids."""

    def __init__(self, raw: bytes):
        if raw[:4] != _MAGIC:
            raise ValueError("not a token shard")
        documents, rules, symbols, self.terminals = np.frombuffer(raw, "<u4", 4, 4).tolist()
        self.rules = np.frombuffer(raw, "<u4", 3 * rules, 20).reshape(rules, 3).astype(np.int64)
        at = 20 + 12 * rules
        self.counts = np.frombuffer(raw, "<i8", documents, at)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        at += 8 * documents
        if len(raw) != at + 3 * symbols:
            raise ValueError("token shard is cut short")
        self.symbols = (np.frombuffer(raw, "<u2", symbols, at).astype(np.int64)
                        | (np.frombuffer(raw, np.uint8, symbols, at + 2 * symbols).astype(np.int64) << 16))
        size = np.ones(symbols, dtype=np.int64)
        is_rule = self.symbols >= self.terminals
        size[is_rule] = self.rules[self.symbols[is_rule] - self.terminals, 2]
        self.ends = np.cumsum(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, dtype="<u4")
        a, b = np.searchsorted(self.ends, [start, stop - 1], side="right")
        begin = int(self.ends[a - 1]) if a else 0
        return _expand(self.symbols[a:b + 1], self.terminals, self.rules)[start - begin:stop - begin].astype("<u4")

    def all_ids(self) -> np.ndarray:
        """Every id: the rules are expanded once, each symbol is a copy of its range."""
        first = np.arange(self.terminals + len(self.rules), dtype=np.int64)
        flat = np.concatenate([first[:self.terminals],
                               _expand(first[self.terminals:], self.terminals, self.rules)]).astype("<u4")
        size = np.ones(len(first), dtype=np.int64)
        size[self.terminals:] = self.rules[:, 2]
        first = np.cumsum(size) - size
        size = size[self.symbols]
        return flat[np.arange(int(size.sum())) + np.repeat(first[self.symbols] - (self.ends - size), size)]

    def document(self, nth: int) -> np.ndarray:
        return self.ids(int(self.starts[nth]), int(self.starts[nth + 1]))


def token_shards(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                 shard_ids: int = 1 << 19, rounds: int = 6, least: int = 16) -> DataFrame:
    """The file's rows: part, nth, doc_ids, n_ids, shard, in ascending id order (null ids first).

    Null text is empty; every document ends with ``end_id``. Rows of equal id
    keep rows of their own, ordered by text. Extra columns are ignored; an
    empty table gives no shard. A shard holds ``shard_ids`` ids or one document.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(shuffle_width(spark), "id").sortWithinPartitions("id", "text")
    arrow_ids = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        end = np.array([end_id], dtype="<u4")
        part, nth = TaskContext.get().partitionId(), 0
        names, counts, held, size = [], [], [], 0

        def shard() -> pa.RecordBatch:
            raw = write_shard(counts, np.concatenate(held), rounds, least)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([names], pa.list_(arrow_ids)),
                 pa.array([size], pa.int64()), pa.array([raw], pa.binary())],
                names=["part", "nth", "doc_ids", "n_ids", "shard"])

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for name, ids in zip(batch.column(0).to_pylist(), known.encode(texts), strict=True):
                names.append(name)
                counts.append(len(ids) + 1)
                held += (ids, end)
                size += len(ids) + 1
                if size >= shard_ids:
                    yield shard()
                    names, counts, held, size, nth = [], [], [], 0, nth + 1
        if names:
            yield shard()

    return rows.mapInArrow(lean(write, "word_ids"), f"part int, nth int, doc_ids array<{kind.simpleString()}>, n_ids long, shard binary")


def read_documents(shards: DataFrame, crc_only: bool = False) -> DataFrame:
    """part, nth, doc_id, at (ids before it in the shard), n_tokens and ids (u32 bytes) of every document;
    ``crc_only``: ids_crc32 in place of ids."""
    last = "ids_crc32 long" if crc_only else "ids binary"
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(3)[i].as_py())
                ids = shard.all_ids()
                n = len(shard.counts)
                each = [ids[a:b].tobytes() for a, b in pairwise(shard.starts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, pa.int32()),
                     pa.array([batch.column(1)[i].as_py()] * n, pa.int32()),
                     batch.column(2)[i].values, pa.array(shard.starts[:-1]), pa.array(shard.counts),
                     pa.array([zlib.crc32(x) for x in each], pa.int64()) if crc_only else pa.array(each, pa.binary())],
                    names=["part", "nth", "doc_id", "at", "n_tokens", last.split()[0]])

    return shards.select("part", "nth", "doc_ids", "shard").mapInArrow(
        lean(read), f"part int, nth int, doc_id {kind}, at long, n_tokens long, {last}")


def with_starts(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Adds start from the totals of earlier parts and of earlier shards of the part."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("part").orderBy("nth")
    first = (shards.select("part", "nth", "n_ids")
             .withColumn("before", F.sum("n_ids").over(inside) - F.col("n_ids"))
             .join(parts, "part").select("part", "nth", (F.col("base") + F.col("before")).alias("first")))
    return docs.join(first, ["part", "nth"]).withColumn("start", F.col("first") + F.col("at"))


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents' ids, reads the file back: doc_id, start, n_tokens, ids_crc32."""
    shards = staged(token_shards(docs, tokenizer), "tokens")
    return with_starts(read_documents(shards, crc_only=True), shards).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_token_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the public word BPE."""
    import public_tokenizers

    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
