"""Language identification by prediction by partial matching (op 3).

Every language has a tree of byte contexts of up to ``order`` bytes with the
counts of the next byte over all its labelled rows, frozen once learned: tasks
count the bytes of their rows, Spark adds the counts up, and contexts that are
rare in the language are left out, so the model does not grow with the corpus.
A byte costs ``-log2 c/(n+d)`` bits where its context has seen it
(c of n times, d different bytes) and ``-log2 d/(n+d)`` bits for each escape to
the next shorter context (method C), down to 8 bits for a byte never seen. A
text goes to the language with the shortest exact code length.

Frozen, all trees together are one automaton, built where texts are scored; the
driver only holds the counts. A state is the longest known
context, and the code lengths of every byte in every language are a table.
Texts are cut into pieces that overlap by ``order`` bytes, which fixes the
state, and all pieces advance together, so whole texts are scored by table
look-ups. A-Z are lower-cased first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import lean, prepare
from geoincident.llm.words import blocks

_PIECE = 512


@dataclass
class Model:
    """languages; symbol of each byte (unseen bytes share one, the last symbol ends a text and costs
    nothing); next state and bits per language for every state and symbol."""

    order: int
    languages: list[str]
    symbol: np.ndarray
    step: np.ndarray
    bits: np.ndarray


class Trees:
    """Counts of the context trees of all languages: lang, k, context, byte, n."""

    def __init__(self, order: int, counts: pa.Table):
        self.order, self.counts = order, counts

    def __getstate__(self) -> dict:
        return {"order": self.order, "counts": self.counts}

    @cached_property
    def languages(self) -> list[str]:
        return sorted(self.counts.column("lang").unique().to_pylist())

    @cached_property
    def model(self) -> Model:
        return build_model(self.counts.to_pandas(), self.order)


def _summed(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different codes, sorted, and the sum of their counts (one each if not given)."""
    if counts is None:
        return np.unique(codes, return_counts=True)
    by = np.argsort(codes, kind="stable")
    codes, counts = codes[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[:len(codes)])
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


#: bytes of text whose codes are held at a time
_COUNT_BYTES = 1 << 20


def _top_counts(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Different runs of ``order`` bytes and the next one, as one number, with their counts."""
    pad = b"\n" * order
    raw = np.frombuffer(b"".join(pad + t.lower() for t in texts), dtype=np.uint8)
    inside = np.ones(len(raw), dtype=bool)
    at = 0
    for t in texts:
        inside[at:at + order] = False
        at += order + len(t)
    found = []
    for a in range(order, len(raw), _COUNT_BYTES):
        b = min(a + _COUNT_BYTES, len(raw))
        code = raw[a:b].astype(np.int64)
        for j in range(1, order + 1):
            code |= raw[a - j:b - j].astype(np.int64) << (8 * j)
        found.append(_summed(code[inside[a:b]]))
    if len(found) == 1:
        return found[0]
    none = np.zeros(0, dtype=np.int64)
    return _summed(*(np.concatenate([none, *x]) for x in zip(*found, strict=True))) if found else (none, none)


def _all_orders(codes: np.ndarray, counts: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per order from the highest to 0: codes of (context, next byte) and their counts."""
    for k in range(order, -1, -1):
        codes, counts = _summed(codes & ((1 << (8 * (k + 1))) - 1), counts)
        yield k, codes, counts


def _context_counts(texts: list[str], order: int, least: int) -> pd.DataFrame:
    """Counts of (context, next byte) for contexts of 0 to ``order`` bytes seen ``least`` times."""
    out = []
    for k, codes, counts in _all_orders(*_top_counts([t.encode() for t in texts], order), order):
        _, group = np.unique(codes >> 8, return_inverse=True)
        keep = np.bincount(group, weights=counts)[group] >= (least if k > 1 else 1)
        out.append(pd.DataFrame({"k": k, "context": codes[keep] >> 8, "byte": codes[keep] & 255, "n": counts[keep]}))
    return pd.concat(out, ignore_index=True)


def build_model(counts: pd.DataFrame, order: int) -> Model:
    """The automaton over the context trees of all languages; counts: lang, k, context, byte, n."""
    languages = sorted(counts["lang"].unique())
    symbol = np.zeros(256, dtype=np.uint16)
    used = np.union1d(counts["byte"].to_numpy(dtype=np.int64), [10])  # a text is preceded by line ends
    symbol[:] = len(used)
    symbol[used] = np.arange(len(used))
    width = len(used) + 1
    nodes = counts[["k", "context"]].drop_duplicates().sort_values(["k", "context"])
    ids = {(0, 0): 0}
    for k, c in zip(nodes["k"], nodes["context"], strict=True):
        ids.setdefault((k, c), len(ids))
    bits = np.zeros((len(ids), width + 1, len(languages)), dtype=np.float32)
    step = np.zeros((len(ids), width + 1), dtype=np.int32)
    counts = counts.assign(
        node=[ids[x] for x in zip(counts["k"], counts["context"], strict=True)],
        sym=symbol[counts["byte"].to_numpy()], li=np.searchsorted(languages, counts["lang"].to_numpy()))
    shorter = np.zeros(len(ids), dtype=np.int64)
    grown = {}
    for (k, c), i in ids.items():
        if k:
            low = (k - 1, c & ((1 << (8 * (k - 1))) - 1))
            while low not in ids:  # a suffix may have been too rare in the union
                low = (low[0] - 1, low[1] & ((1 << (8 * (low[0] - 1))) - 1))
            shorter[i] = ids[low]
            if (k - 1, c >> 8) in ids:
                grown.setdefault(ids[(k - 1, c >> 8)], []).append((symbol[c & 255], i))
    by_node = counts.groupby(["node", "li"])["n"].agg(["sum", "count"]).reset_index()
    total = np.zeros((len(ids), len(languages)))
    kinds = np.zeros((len(ids), len(languages)))
    total[by_node["node"], by_node["li"]] = by_node["sum"]
    kinds[by_node["node"], by_node["li"]] = by_node["count"]
    known = total > 0
    escape = np.where(known, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
    spans = counts.sort_values("node", kind="stable")
    first = np.searchsorted(spans["node"].to_numpy(), np.arange(len(ids) + 1))
    sym, li, n = (spans[c].to_numpy() for c in ("sym", "li", "n"))
    for i in range(len(ids)):
        low = 8.0 if i == 0 else bits[shorter[i]]
        bits[i] = low + escape[i]
        a, b = first[i], first[i + 1]
        bits[i, sym[a:b], li[a:b]] = -np.log2(n[a:b] / (total[i, li[a:b]] + kinds[i, li[a:b]]))
        step[i] = 0 if i == 0 else step[shorter[i]]
        for s, to in grown.get(i, ()):
            step[i, s] = to
    bits[:, width], step[:, width] = 0, 0
    return Model(order, list(languages), symbol, step, bits)


def code_lengths(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """Bits of every whole text in every language."""
    k, width = model.order, model.step.shape[1]
    step, bits = model.step.ravel(), model.bits.reshape(-1, len(model.languages))
    out = np.zeros((len(texts), len(model.languages)))
    for lo, hi in blocks(texts):
        raw = [(t or b"").lower() for t in texts[lo:hi]]
        blob = np.frombuffer(b"".join(b"\n" * k + t for t in raw), dtype=np.uint8)
        syms = model.symbol[blob]
        size = np.array([len(t) for t in raw])
        begin = np.concatenate([[0], np.cumsum(size + k)])[:-1]
        pieces = -(-size // _PIECE)
        doc = np.repeat(np.arange(len(raw)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, end = begin[doc] + nth * _PIECE, begin[doc] + k + size[doc]
        for a in range(0, len(doc), 16_384):
            s, e = start[a:a + 16_384], end[a:a + 16_384]
            state = np.zeros(len(s), dtype=np.int64)
            cost = np.zeros((len(s), len(model.languages)))
            for j in range(k + min(_PIECE, int((e - s).max()) - k)):
                at = s + j
                sym = np.where(at < e, syms[np.minimum(at, len(syms) - 1)], width - 1)
                cell = state * width + sym
                if j >= k:
                    cost += bits[cell]
                state = step[cell]
            np.add.at(out, lo + doc[a:a + 16_384], cost)
    return out


#: different codes of a language that a task holds before it sends their counts on
_HELD = 1 << 21


def _count_rows(order: int):
    """Of batches of lang and text: lang, k, code and n, summed over the task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def send(lang: str) -> Iterator[pa.RecordBatch]:
            for k, codes, counts in _all_orders(*held.pop(lang), order):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(codes), dtype=np.int32))),
                     pa.array(np.full(len(codes), k, dtype=np.int32)), pa.array(codes), pa.array(counts)],
                    names=["lang", "k", "code", "n"])

        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                for lo, hi in blocks(own):
                    new = _top_counts(own[lo:hi], order)
                    if lang in held:
                        new = _summed(*(np.concatenate(x) for x in zip(held[lang], new, strict=True)))
                    held[lang] = new
                    if len(new[0]) >= _HELD:
                        yield from send(lang)
        for lang in list(held):
            yield from send(lang)

    return run


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", order: int = 4, least: int = 8,
          share: float = 1 / 60_000) -> Trees:
    """Context trees of all rows; those with null language or text are left out.

    A context of two or more bytes is kept if it is followed by ``least`` bytes
    and by ``share`` of its language's bytes, which bounds the model; counts of
    kept contexts are exact.
    """
    prepare(docs.sparkSession)
    rows = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .where("lang is not null and text is not null"))
    sizes = rows.groupBy("lang").agg((F.sum(F.octet_length("text")) * F.lit(share)).alias("floor"))
    same = Window.partitionBy("lang", "k", "context")
    counts = (rows.mapInArrow(lean(_count_rows(order)), "lang string, k int, code long, n long")
              .select("lang", "k", F.shiftright("code", 8).alias("context"), F.col("code").bitwiseAND(255).alias("byte"), "n")
              .groupBy("lang", "k", "context", "byte").agg(F.sum("n").alias("n"))
              .withColumn("seen", F.sum("n").over(same)).where((F.col("k") < 2) | (F.col("seen") >= least))
              .join(F.broadcast(sizes), "lang").where((F.col("k") < 2) | (F.col("seen") >= F.col("floor")))
              .select("lang", F.col("k").cast("long").alias("k"), "context", "byte", "n"))
    return Trees(order, counts.toArrow())


def identify(docs: DataFrame, model: Trees | Broadcast, keep: list[str], text_col: str = "text",
             names: tuple[str, str, str] = ("lang_pred", "score", "bits_per_byte")) -> DataFrame:
    """``keep`` columns, lang_pred, score and bits_per_byte (under ``names``) of every row.

    score is the share of the best language if all are equally likely before
    the text is seen. Null texts and texts without a letter: ``und``, 0, null.
    Ties go to the first language by name; without any learned language all
    rows are ``und``. ``keep`` must not hold any of ``names``. A model that
    serves several calls can be given as one broadcast.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = model if isinstance(model, Broadcast) else spark.sparkContext.broadcast(model)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    columns = [*keep] if text_col in keep else [*keep, text_col]
    at = columns.index(text_col)

    def letters(t: bytes | None) -> bool:
        return bool(t) and (bool(t.translate(None, delete=_NO_LETTER)) and
                            (any(65 <= c <= 90 or 97 <= c <= 122 for c in t[:64])
                             or any(c.isalpha() for c in t.decode())))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value.model
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            best_names, scores, rates = [], [], []
            if m.languages:
                lengths = code_lengths(m, texts)
                best = lengths.argmin(axis=1)
                low = lengths.min(axis=1)
                share = 1 / np.exp2(np.minimum(low[:, None] - lengths, 0)).sum(axis=1)
            for i, t in enumerate(texts):
                ok = bool(m.languages) and letters(t)
                best_names.append(m.languages[best[i]] if ok else "und")
                scores.append(float(share[i]) if ok else 0.0)
                rates.append(float(low[i] / len(t)) if ok else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(best_names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rates, pa.float64())], names=[*keep, *names])

    added = [f"`{n}` {k}" for n, k in zip(names, ("string", "double", "double"), strict=True)]
    return docs.select(*columns).mapInArrow(lean(predict), ", ".join([*kinds, *added]))


#: bytes added to a text's length before its code length is held against it: short texts vary more
SLACK_BYTES = 32


def _rate(rate: F.Column, text: F.Column) -> F.Column:
    size = F.octet_length(text)
    return rate * size / (size + SLACK_BYTES)


#: steps of the rates to a bit per byte; equal ones are counted together, so few rows tell a language's share
_RATE_STEPS = 10_000


def usual_rates(docs: DataFrame, model: Trees | Broadcast, lang_col: str = "lang", text_col: str = "text",
                share: float = 0.99) -> dict[str, float]:
    """Bits per byte that ``share`` of a language's texts stay under, for each learned language.

    From all labelled rows that the model has told right; ``docs`` should be
    rows that it has not learned from. Rows with null language or text are left
    out; a language without rows has no entry. Rates are rounded to
    1 / 10,000 bit.
    """
    rows = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .where("lang is not null and text is not null"))
    told = identify(rows, model, ["lang", "text"]).where("lang_pred = lang")
    step = F.round(_rate(F.col("bits_per_byte"), F.col("text")) * _RATE_STEPS).cast("long")
    counted = told.groupBy("lang", step.alias("step")).count()
    found = counted.groupBy("lang").agg(F.percentile("step", F.lit(share), F.col("count")).alias("r"))
    return {r["lang"]: r["r"] / _RATE_STEPS for r in found.collect()}


def fits(lang_pred: F.Column, bits_per_byte: F.Column, text: F.Column, usual: dict[str, float],
         times: float = 2.0) -> F.Column:
    """Whether a text's code length is at most ``times`` what its language's texts usually need.

    The best of the learned languages is a poor one for noise and for a
    language never learned. True where ``usual`` has no figure; false for
    ``und`` and null texts.
    """
    limit = F.lit(None).cast("double")
    if usual:
        limit = F.try_element_at(F.create_map(*(F.lit(x) for pair in sorted(usual.items()) for x in pair)), lang_pred)
    known = (lang_pred != "und") & text.isNotNull()
    return F.coalesce(known & (limit.isNull() | (_rate(bits_per_byte, text) <= times * limit)), F.lit(False))


#: bytes that are no part of any letter
_NO_LETTER = bytes(c for c in range(128) if not chr(c).isalpha())


def fold(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def op3_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns on the folds other than 0 and predicts all documents; a null id is in no fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(fold() != 0))
    rows = docs.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model, ["doc_id", "held_out"])
