"""SentencePiece BPE encoding and decoding by vectorised merge rounds (op 11).

A text becomes a blank followed by itself; blanks are the mark U+2581. No piece
has a mark after another character, so texts are cut before each run of blanks
and every different stretch of a block is encoded once. All stretches lie in
flat arrays of symbols: a round finds the best-ranked pair of every stretch by a
segmented minimum, merges its occurrences from left to right at once and
compacts the arrays, until no stretch has a pair left. Where a merge could make
an even better pair, only the leftmost occurrence of that round is merged, so
the result is that of the library's queue (score, then leftmost). Rounds over a
stretch of very many symbols without a cut would take quadratic time; such a one
goes through that queue itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoincident.llm.common import lean, prepare
from geoincident.llm.words import blocks, hash_spans

MARK = "▁"
_NORMAL, _CONTROL, _UNKNOWN, _BYTE = 1, 3, 2, 6
_NONE = np.iinfo(np.int32).max
#: how the library writes an unknown id
_UNKNOWN_TEXT = " ⁇ ".encode()
#: symbols from which a stretch is merged through a queue
LONG_STRETCH = 4096


class Pieces:
    """A BPE model with byte fallback, identity normaliser and dummy prefix.

    Symbols are piece ids; a character that is no piece has the number of pieces
    plus its code point. ``keys`` are the pairs of symbols that merge, sorted,
    ``merged`` their piece and ``rank`` its place by score.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != model.trainer_spec.BPE or rules.precompiled_charsmap
                or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces
                or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix
                or not kinds <= {_NORMAL, _CONTROL, _UNKNOWN, _BYTE}):
            raise ValueError("needs a BPE model with byte fallback, the identity normaliser and a dummy prefix")
        self.n = len(model.pieces)
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        if any(MARK in piece.lstrip(MARK) for piece in normal):
            raise ValueError("a piece has a blank after another character")
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], dtype=np.int32)
        self.is_control = np.array([p.type == _CONTROL for p in model.pieces])
        byte_of = {i: bytes([b]) for b, i in byte_ids.items()}
        self.text = [byte_of.get(i) or (p.piece.replace(MARK, " ").encode() if p.type == _NORMAL else
                                        _UNKNOWN_TEXT if p.type == _UNKNOWN else b"")
                     for i, p in enumerate(model.pieces)]
        self.marked = {i for piece, i in normal.items() if piece[0] == MARK}

        self.chars = np.arange(self.n, self.n + 0x110000, dtype=np.int32)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        self.chars[0x20] = self.chars[ord(MARK)]
        scores = sorted({p.score for p in model.pieces if p.type == _NORMAL}, reverse=True)
        place = {score: i for i, score in enumerate(scores)}

        def symbol(part: str) -> int | None:
            return int(self.chars[ord(part)]) if len(part) == 1 else normal.get(part)

        rows = []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    rows.append(((left << 32) | right, i, place[model.pieces[i].score]))
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(len(rows), 3)
        self.keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.merged = np.append(table[:, 1], 0).astype(np.int32)
        self.rank = np.append(table[:, 2], _NONE).astype(np.int32)
        # merged pieces that are part of a pair of the same rank or a better one
        self.early = np.zeros(self.n, dtype=bool)
        own = np.full(self.n, -1, dtype=np.int64)
        own[table[:, 1]] = table[:, 2]
        for side in (table[:, 0] >> 32, table[:, 0] & 0xFFFFFFFF):
            known = side < self.n
            part, better = side[known], table[known, 2]
            self.early[part[better <= own[part]]] = True

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``_NONE`` if it does not merge) and the piece it makes."""
        key = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, key)
        known = self.keys[at] == key
        return np.where(known, self.rank[at], _NONE), np.where(known, self.merged[at], 0)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of stretches of ``sizes`` symbols each, and the stretch of every one."""
        symbols = symbols.copy()
        stretch = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), _NONE, dtype=np.int32)
        into = np.zeros(len(symbols), dtype=np.int32)
        inner = np.flatnonzero(stretch[1:] == stretch[:-1])
        rank[inner], into[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]]))
            count = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            over = best == _NONE
            if over.any():  # compaction: finished stretches leave the arrays
                gone = np.repeat(over, count)
                done.append((stretch[gone], symbols[gone]))
                left = ~gone
                symbols, stretch, rank, into = symbols[left], stretch[left], rank[left], into[left]
                best, count = best[~over], count[~over]
                if not len(symbols):
                    break
            nth = np.repeat(np.arange(len(count)), count)
            here = np.flatnonzero(rank == best[nth])
            # of neighbouring occurrences every second one, from the left
            run = np.concatenate([[True], np.diff(here) != 1])
            first = np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))
            here = here[(np.arange(len(here)) - first) % 2 == 0]
            alone = np.zeros(len(count), dtype=bool)
            alone[nth[here[self.early[into[here]]]]] = True
            if alone.any():
                leftmost = np.concatenate([[True], nth[here[1:]] != nth[here[:-1]]])
                here = here[leftmost | ~alone[nth[here]]]
            symbols[here] = into[here]
            keep = np.ones(len(symbols), dtype=bool)
            keep[here + 1] = False
            at = (np.cumsum(keep) - 1)[here]
            symbols, stretch, rank, into = symbols[keep], stretch[keep], rank[keep], into[keep]
            touched = np.zeros(len(symbols) + 1, dtype=bool)
            touched[at] = touched[at - 1] = True  # the place before the first is the spare last one
            again = np.flatnonzero(touched[:-1])
            rank[again], into[again] = _NONE, 0
            again = again[again + 1 < len(symbols)]
            again = again[stretch[again] == stretch[again + 1]]
            rank[again], into[again] = self.pairs(symbols[again], symbols[again + 1])
        if not done:
            return symbols, stretch
        stretch, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(stretch, kind="stable")
        return symbols[order], stretch[order]

    def queue(self, symbols: list[int]) -> np.ndarray:
        """Final symbols of one stretch by a queue of its pairs (rank, place)."""
        if not hasattr(self, "_made"):
            self._made = dict(zip(self.keys[:-1].tolist(),
                                  zip(self.rank[:-1].tolist(), self.merged[:-1].tolist(), strict=True), strict=True))
        n, made = len(symbols), self._made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = []

        def offer(a: int, b: int) -> None:
            pair = made.get((symbols[a] << 32) | symbols[b])
            if pair:
                heapq.heappush(waiting, (pair[0], a, symbols[a], symbols[b], pair[1]))

        for a in range(n - 1):
            offer(a, a + 1)
        while waiting:
            _, a, left, right, into = heapq.heappop(waiting)
            b = after[a]
            if symbols[a] != left or b >= n or symbols[b] != right:
                continue
            symbols[a], symbols[b] = into, -1
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        return np.array([x for x in symbols if x >= 0], dtype=np.int32)

    def stretches(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of stretches and the number of ids of each."""
        texts = [x.decode() for x in raw]
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        symbols = self.chars[points]
        long = np.flatnonzero(sizes >= LONG_STRETCH)
        if len(long):
            stop = np.cumsum(sizes)
            merged = [self.queue(symbols[b - n:b].tolist()) for b, n in zip(stop[long], sizes[long], strict=True)]
            inside = np.repeat(np.isin(np.arange(len(sizes)), long), sizes)
            short, of = self.merge(symbols[~inside], np.where(sizes < LONG_STRETCH, sizes, 0))
            symbols = np.concatenate([short, *merged])
            stretch = np.concatenate([of, np.repeat(long, [len(m) for m in merged])])
            order = np.argsort(stretch, kind="stable")
            symbols, stretch = symbols[order], stretch[order]
        else:
            symbols, stretch = self.merge(symbols, sizes)
        unknown = symbols >= self.n
        if unknown.any():  # byte fallback
            point = symbols - self.n
            width = np.where(unknown, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), 1)
            spread = np.repeat(symbols, width)
            raw_bytes = "".join(map(chr, point[unknown].tolist())).encode()
            spread[np.repeat(unknown, width)] = self.byte_ids[np.frombuffer(raw_bytes, dtype=np.uint8)]
            symbols, stretch = spread, np.repeat(stretch, width)
        return symbols, np.bincount(stretch, minlength=len(texts))

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Ids of every text; a block of texts has each different stretch encoded once."""
        for lo, hi in blocks(texts):
            own = [(t or b"").replace(MARK.encode(), b" ") for t in texts[lo:hi]]
            blob = b"".join([b" " + t if t else b"" for t in own])
            starts = np.cumsum([0] + [len(t) + 1 if t else 0 for t in own])
            blank = np.frombuffer(blob, dtype=np.uint8) == 0x20
            first = np.zeros(len(blob), dtype=bool)
            first[1:] = blank[1:] & ~blank[:-1]
            first[starts[:-1][np.diff(starts) > 0]] = True
            begin = np.flatnonzero(first)
            end = np.append(begin[1:], len(blob))[:len(begin)]
            at, which = _distinct(blob + b"\0" * 9, begin, end)
            flat, size = self.stretches([blob[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)])
            start = (np.cumsum(size) - size)[which]
            size = size[which]
            stop = np.concatenate([[0], np.cumsum(size)])
            ids = flat[np.arange(stop[-1]) + np.repeat(start - stop[:-1], size)]
            for a, b in pairwise(stop[np.searchsorted(begin, starts)].tolist()):
                yield ids[a:b]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, as the library writes it: one blank at the front is the dummy prefix's,
        bytes that are no UTF-8 become U+FFFD each, control ids nothing."""
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.n):
            raise ValueError("id outside the model")
        control = self.is_control[ids]
        if control.any():  # no character goes across one
            parts = np.split(ids[~control], np.unique(np.cumsum(~control)[control]))
        else:
            parts = [ids]
        parts = [p for p in parts if len(p)]
        out = [self._plain(p) for p in parts]
        if out and parts[0][0] in self.marked:
            out[0] = out[0][1:]
        return "".join(out)

    def _plain(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.text.__getitem__, ids.tolist()))
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _one_by_one(raw)


def _one_by_one(raw: bytes) -> str:
    """Every byte that begins no whole character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        width = 1 + (raw[at] >= 0xC0) + (raw[at] >= 0xE0) + (raw[at] >= 0xF0)
        try:
            out.append(raw[at:at + width].decode())
            at += width
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def _distinct(blob: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of every different span, and the number of its span for each; equal bytes, not hashes alone."""
    _, at, which = np.unique(hash_spans(blob, begin, end), return_index=True, return_inverse=True)
    eight = np.ndarray((len(blob) - 7,), dtype="<u8", buffer=blob, strides=(1,))
    same = (end - begin) == (end - begin)[at][which]
    left, k = np.flatnonzero(same), 0
    while len(left):
        size = (end - begin)[left] - k
        mask = np.where(size >= 8, np.uint64(0xFFFFFFFFFFFFFFFF),
                        (np.uint64(1) << (8 * np.minimum(size, 7)).astype(np.uint64)) - np.uint64(1))
        other = begin[at][which[left]]
        same[left[(eight[begin[left] + k] ^ eight[other + k]) & mask != 0]] = False
        left = left[size > 8]
        k += 8
    odd = np.flatnonzero(~same)  # another span of equal hash: a place of its own
    which = which.copy()
    which[odd] = len(at) + np.arange(len(odd))
    return np.concatenate([at, odd]), which


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One per Python worker and model file."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _with(df: DataFrame, name: str, kind: T.DataType, arrow: pa.DataType, source: str, work) -> DataFrame:
    """``df`` with a column computed batch by batch; a column of that name is replaced, all others stay."""
    own = [c for c in df.columns if c != name]
    schema = df.select(*[F.col(f"`{c}`") for c in own]).schema.add(name, kind)
    place = df.columns.index(source)
    rest = [i for i, c in enumerate(df.columns) if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(work(batch.column(place)), arrow) if batch.num_rows else pa.array([], arrow)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in rest] + [made],
                                             names=[batch.schema.names[i] for i in rest] + [name])

    return df.mapInArrow(lean(run), schema)


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text (array of int), without begin or end ids.

    Null and empty texts have no ids. Every row stays, repeated ones too; other
    columns are kept, one named ``ids_col`` is replaced. An empty table stays empty.
    Works row by row inside the scan, without a shuffle.
    """
    prepare(docs.sparkSession)

    def work(texts: pa.Array) -> list[np.ndarray]:
        return list(pieces(model).encode(texts.cast(pa.binary()).to_pylist()))

    return _with(docs, ids_col, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), text_col, work)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of every array of ids; null arrays are empty. Ids outside the model raise."""
    prepare(rows.sparkSession)

    def work(ids: pa.Array) -> list[str]:
        known, values, at = pieces(model), ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        return [known.decode(values[a:b]) for a, b in pairwise(at.tolist())]

    return _with(rows, text_col, T.StringType(), pa.string(), ids_col, work)


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents with the public SentencePiece model, decoded again from its ids."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decode(encode(docs, model).drop("text"), model)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
