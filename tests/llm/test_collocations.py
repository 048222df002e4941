"""Operator 13 against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import lower_ascii
from pyspark.sql import functions as F

from geoincident.llm import collocations


def plain(docs, max_words, least, top):
    """docs: (text, lang) pairs."""
    counts, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + size])] += 1
    out = set()
    for lang, f in counts.items():
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = Counter()
        for p, c in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], c)
        rows = []
        for p, a in cand.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, k = min(((1000 * a * n[lang]) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


@pytest.mark.parametrize(("max_words", "least", "top", "shard_bytes"), [(5, 4, 2000, 3000), (3, 1, 25, 200), (2, 2, 7, 1 << 20)])
def test_against_plain_counting(spark, max_words, least, top, shard_bytes):
    rnd = random.Random(least)
    words = ["a", "b", "c", "Á", "dd", "É", "日", "x-y", "\xa0", "NaN"] + [f"w{i}" for i in range(20)]
    weights = [9, 8, 7, 5, 4, 3, 3, 2, 2, 2] + [1] * 20
    docs = []
    for _ in range(300):
        text = "".join(rnd.choices(words, weights)[0] + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!"])
                       for _ in range(rnd.randrange(60)))
        docs.append((text, rnd.choice(["en", "en", "en", "de", None, "und"])))
    docs += [(None, "en"), ("", "fr"), (" . ", "fr"), ("A b A b A b A b", "it")] + docs[:9]  # repeated rows
    df = spark.createDataFrame([(t, g, 1, 2) for t, g in docs], "text string, lang string, shard int, id int").repartition(3)
    got = rows_of(collocations.collocations(df, max_words=max_words, least=least, top=top, shard_bytes=shard_bytes))
    assert len(got) == len(set(got)) > 0
    assert set(got) == plain(docs, max_words, least, top)


def test_intervals_count_every_phrase(monkeypatch):
    monkeypatch.setattr(collocations, "EXTEND_ROWS", 16)
    rnd = random.Random(3)
    seq = [0]
    for _ in range(60):
        seq += [rnd.randrange(1, 5) for _ in range(rnd.randrange(1, 9))] + [0]
    index = collocations.BidirectionalIndex.build(np.array(seq, dtype=np.int32), 5)
    for side in (0, 1):
        lo, rlo, size = index.words()
        near, far, phrases = (lo, rlo, [(c,) for c in range(1, 5)]) if side == 0 else (rlo, lo, [(c,) for c in range(1, 5)])
        for length in range(2, 6):
            come, step, other, size, symbols = collocations._all(index.extend(side, near, far, size))
            phrases = [(c, *phrases[i]) if side == 0 else (*phrases[i], c)
                       for i, c in zip(come.tolist(), symbols.tolist(), strict=True)]
            expected = Counter(w for i in range(len(seq)) if 0 not in (w := tuple(seq[i:i + length])) and len(w) == length)
            assert dict(zip(phrases, size.tolist(), strict=True)) == expected
            near, far = step, other
    none = collocations.BidirectionalIndex.build(np.zeros(1, dtype=np.int32), 5)
    assert list(none.extend(1, *none.words())) == []


def test_phrases_travel_in_blocks(spark):
    rnd = np.random.default_rng(5)
    shards, n, buckets = 6, 400, 3
    plain, batches = Counter(), []
    for shard in range(shards):
        key = rnd.choice(5000, n, replace=False)
        prefix, suffix = (1 << 40) + key // 70, (1 << 41) - key % 70
        lo, rlo, size = np.sort(rnd.integers(0, 1 << 45, n)), rnd.integers(0, 1 << 45, n), rnd.integers(1, 60, n)
        batches.append(collocations._dealt(shard, (lo, rlo, size, prefix, suffix), buckets))
        for row in zip(prefix.tolist(), suffix.tolist(), size.tolist(), strict=True):
            plain[row[:2]] += row[2]
    assert all(b.num_rows <= buckets for b in batches)  # a row for each phrase before
    rows = [r for b in batches for r in b.to_pylist()]
    sent = {(r["shard"], *x) for r in rows for x in collocations._unpack(r["block"], 2, 5).T.tolist()}
    dealt = spark.createDataFrame([tuple(r.values()) for r in rows], collocations._DEALT).repartition(4)
    found = collocations._frequent(dealt, buckets, 70).collect()
    names, back = {}, set()
    for r in found:
        if r["shard"] == collocations._EVERY:
            for name, a, b, f in collocations._unpack(bytes(r["block"]), 0, 4).T.tolist():
                assert name not in names and f == plain[a, b] >= 70
                names[name] = (a, b)
    assert set(names.values()) == {k for k, f in plain.items() if f >= 70} != set()
    for r in found:
        if r["shard"] != collocations._EVERY:
            for lo, rlo, size, name in collocations._unpack(bytes(r["block"]), 1, 4).T.tolist():
                back.add((r["shard"], lo, names[name][0], rlo, names[name][1], size))
    assert back == {x for x in sent if plain[x[2], x[4]] >= 70}


def test_sequences_travel_packed():
    rnd = np.random.default_rng(6)
    words = rnd.zipf(1.3, 40000) % 3000
    texts = {lang: [" ".join(f"w{w}" + "," * (i % 9 == 0) for i, w in enumerate(part)).encode()]
             for lang, part in (("en", words[:30000]), ("de", words[30000:]))}
    batch = collocations._shard(texts, 7)
    table = pa.Table.from_batches([batch])
    row = batch.to_pylist()[0]
    seq = collocations._array(table, "seq", 0, collocations._SYMBOL)
    pieces = [p.split() for lang in texts for p in texts[lang][0].decode().split(",") if p]
    assert [row["words"][i - 1] for i in seq[seq > 0]] == [w for p in pieces for w in p]
    assert np.bincount(seq)[1:].tolist() == row["counts"]
    assert len(row["seq"]) < 2 * len(seq)  # 4 bytes a symbol before
    lang = np.array(row["langs"])
    assert all((np.diff(np.array(row["counts"])[lang == g]) <= 0).all() for g in texts)  # small numbers for frequent words
    some = np.arange(1, len(lang) + 1, 2)
    ids = rnd.permutation(len(some)) + (5 << 31)
    frequent = pa.table({"place": some, "id": ids, "size": np.array(row["counts"])[some - 1]})
    index = collocations._index_shard(table, frequent, 3)
    loaded = collocations._load(index, 0)
    named = collocations._array(index, "ids", 0, collocations._NUMBER)
    sizes = dict(zip(ids.tolist(), row["counts"][::2], strict=True))
    assert sorted(named.tolist()) == sorted(ids.tolist()) and len(index["bwt"][0].as_py()) < 2 * len(loaded.bwt[0])
    assert all(c <= sizes[i] for i, c in zip(named.tolist(), loaded.counts[1:].tolist(), strict=True))


def test_scores_are_exact_beyond_64_bits(spark):
    numbers = [(99_999_999_999, 9_876_543_210_123, 99_999_999_999, 100_000_000_003), (10**12 + 1, 10**13 + 7, 10**12 + 1, 10**12 + 3),
               (100, 10**13, 100, 100), (7, 3, 10**9, 10**9), (123_456_789, 987_654_321_000, 123_456_790, 3_000_000_000)]
    df = spark.createDataFrame([(f, n, [left], [right]) for f, n, left, right in numbers],
                               "f long, n long, pre array<long>, suf array<long>")
    got = [r["cut"]["score"] for r in df.select(collocations._score(2).alias("cut")).collect()]
    assert got == [1000 * f * n // (left * right) for f, n, left, right in numbers]


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, "en"), ("", None), ("one two", "en")], "text string, lang string")
    assert collocations.collocations(df).count() == 0
    empty = collocations.collocations(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    long = spark.createDataFrame([("ping pong " * 30000 + "x" * 100000, "en")], "text string, lang string")
    got = rows_of(collocations.collocations(long, shard_bytes=1000))
    assert got == sorted(plain([("ping pong " * 30000 + "x" * 100000, "en")], 5, 100, 2000), key=lambda r: r[1])
    with pytest.raises(ValueError, match="least"):
        collocations.collocations(df, least=0)
    assert collocations.collocations(long.withColumn("lang", F.lit(7)), max_words=2).select("lang").distinct().first()[0] == "7"
