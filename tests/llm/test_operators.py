"""Every dealt operator against SQL, brute force, an exact round trip or held-out accuracy, and its edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from brute import WORDS, lower_ascii
from pyspark.sql import functions as F

from geoincident.llm import (benchmark_index, chat_trees, embedding_dedup, language_ppm, line_alignment, lm_backoff,
                             registry, secret_ownership, source_mixing, token_repair)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*rel.columns).collect())) == Counter(rel.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.queries())
    assert len(numbers) == len(set(numbers)) == len(registry._MODULES)


# ---- 1

def test_embeddings_edge_cases(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    near = [(base + rng.standard_normal(16) * 0.02).tolist() for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(near)] + [
        (100, None), (101, [0.0] * 16), (102, [float("nan")] + [1.0] * 15), (103, near[0]), (104, [None] * 16),
        (105, [1.0, 0.0]), (106, []), (None, near[0]), (103, near[0]), (107, (-base).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cls", F.lit("x"))
    for part in (1000, 7):  # small parts: every two parts of a bucket meet
        got = embedding_dedup.near_duplicate_embeddings(df, part_rows=part).collect()
        assert len(got) == len(rows)
        many = [r for r in got if r["component_id"] == 0]
        assert len(many) == 33 and {r["n_links"] for r in many} == {32}
        assert all(r["n_links"] == 0 for r in got if r["vec_id"] in (100, 101, 102, 104, 105, 106, 107))
    assert embedding_dedup.near_duplicate_embeddings(df.limit(0)).count() == 0


# ---- 3

def test_language_held_out_accuracy_and_und(spark):
    sf = "/root/testdata/sf0.01"
    got = language_ppm.op3_language_ppm(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got) > 150
    rows = spark.createDataFrame([(1, None, "en"), (2, "123 !?", "en"), (3, "the thing and the other " * 9, "en"),
                                  (4, "der die das und nicht " * 9, "de"), (5, "", None), (None, "the and " * 30, "en")],
                                 "doc_id long, text string, lang string")
    model = language_ppm.train(rows)
    pred = {r["doc_id"]: r for r in language_ppm.identify(rows, model, ["doc_id"]).collect()}
    assert [pred[i]["lang_pred"] for i in (1, 2, 3, 4, 5, None)] == ["und", "und", "en", "de", "und", "en"]
    none = language_ppm.train(rows.limit(0))
    assert {r["lang_pred"] for r in language_ppm.identify(rows, none, ["doc_id"]).collect()} == {"und"}


def test_noise_and_languages_never_learned_do_not_fit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_ppm.train(docs.where(language_ppm.fold() != 0))
    usual = language_ppm.usual_rates(docs.where(language_ppm.fold() == 0), model)
    assert sorted(usual) == model.languages
    rng = random.Random(3)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)) for _ in range(50)]
    other = ["Это обычный текст на русском языке о погоде и о людях, которые живут в городе.", "今日は天気がいいので散歩に行きます。"]
    odd = spark.createDataFrame([(t,) for t in [*noise, *other, None, "", "12 34"]], "text string")

    def fitting(df, figures):
        known = language_ppm.identify(df, model, ["text"])
        return known.where(language_ppm.fits(F.col("lang_pred"), F.col("bits_per_byte"), F.col("text"), figures)).count()

    assert fitting(odd, usual) == 0
    assert fitting(odd, {}) == len(noise) + len(other)
    labelled = docs.where("lang is not null and text rlike '[a-z]'")
    assert fitting(labelled, usual) >= 0.995 * labelled.count()
    assert language_ppm.usual_rates(docs.limit(0), model) == {}


def test_trees_and_usual_rates_come_from_all_rows(spark):
    rng = random.Random(5)
    words = ["the", "thing", "other", "and", "over", "house", "river"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 30))) + f" {i}" for i in range(900)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(5)
    model = language_ppm.train(df)
    counts = model.counts.to_pandas()
    assert counts[counts["k"] == 0]["n"].sum() == sum(len(t) for t in texts)
    plain = language_ppm._context_counts(texts, 4, 8)
    columns = ["k", "context", "byte", "n"]
    assert sorted(map(tuple, counts[columns].to_numpy().tolist())) == sorted(map(tuple, plain[columns].to_numpy().tolist()))
    few = language_ppm.train(df, share=0.01).counts.to_pandas()
    sizes = few.groupby(["k", "context"])["n"].sum().reset_index()
    assert sizes[sizes["k"] > 1]["n"].min() >= 0.01 * sum(len(t) for t in texts)
    # one text in fifty is of letters that the model has seldom met
    odd = [t.upper() if i % 50 else "".join(rng.choice("jkqxz ") for _ in range(200)) + " the" for i, t in enumerate(texts)]
    held = spark.createDataFrame([(t, "en") for t in odd], "text string, lang string")
    rates = [r["bits_per_byte"] * len(r["text"]) / (len(r["text"]) + language_ppm.SLACK_BYTES)
             for r in language_ppm.identify(held, model, ["text"]).collect()]
    for share in (0.5, 0.97, 0.99):
        got = language_ppm.usual_rates(held, model, share=share)
        assert got == {"en": pytest.approx(float(np.percentile(rates, 100 * share)), abs=1e-4)}


def test_code_length_against_plain_ppm():
    """Exact code length by walking the context trees, method C, byte by byte."""
    texts = ["abracadabra abra", "cadabra bra"]
    counts = language_ppm._context_counts(texts, 3, 1).assign(lang="x")
    model = language_ppm.build_model(counts, 3)
    tree = {}
    for k, c, b, n in zip(counts["k"], counts["context"], counts["byte"], counts["n"], strict=True):
        tree.setdefault(int(c).to_bytes(k, "big"), {})[b] = n

    def bits(context, byte):
        seen = tree.get(context)
        low = lambda: bits(context[1:], byte) if context else 8.0
        if seen is None:
            return low()
        total, kinds = sum(seen.values()), len(seen)
        return -math.log2(seen[byte] / (total + kinds)) if byte in seen else -math.log2(kinds / (total + kinds)) + low()

    for text in ("abra", "Dab zebra\xe9 ", "b" * 1500):
        raw = b"\n\n\n" + text.encode().lower()
        plain = sum(bits(raw[i - 3:i], raw[i]) for i in range(3, len(raw)))
        assert language_ppm.code_lengths(model, [text.encode()])[0, 0] == pytest.approx(plain, rel=1e-5)


# ---- 4

def test_mixing_edge_cases(spark):
    rows = spark.createDataFrame(
        [(1, "a b c", "en", "s1", 9), (1, "a b c", "en", "s1", 9), (2, None, None, None, 1), (3, "", "en", "s1", 2),
         (None, "x y", None, "s2", 3), (4, "q " * 50, "de", "s2", 4)],
        "doc_id long, text string, lang string, source string, mix int")
    got = source_mixing.mix_sources(rows, F.lit("all"), {}, 0.5, 2)
    out = [r["mix"] for r in got.collect()]
    assert len(out) == 6 and all(0 <= m["part_tokens"] <= m["n_tokens"] for m in out)
    assert sum(m["epochs"] * m["n_tokens"] + m["part_tokens"] for m in out) == 0.5 * 58
    assert source_mixing.mix_sources(rows.limit(0), F.lit("all"), {}, 0.5).count() == 0
    shut = source_mixing.mix_sources(rows, F.lit("all"), {("all", "de"): 0}, 1.0).collect()
    assert all(r["mix"]["epochs"] == 0 and r["mix"]["part_tokens"] == 0 for r in shut if r["lang"] == "de")


def _taken(rows, budget, epochs=1):
    got = source_mixing.mix_sources(rows, F.lit("all"), {}, budget, epochs).collect()
    out = [r["mix"] for r in got]
    assert len(got) == rows.count() and all(0 <= m["part_tokens"] <= m["n_tokens"] for m in out)
    return sum(m["epochs"] * m["n_tokens"] + m["part_tokens"] for m in out), got


def test_mixing_meets_the_budget_with_null_and_repeated_ids(spark):
    shape = "doc_id long, text string, lang string, source string, nth int, leaf string, __domain string"
    word = lambda i: " ".join(f"w{i}x{k}" for k in range(11))
    tail = ("en", "s", 5, "own", "theirs")
    cases = {"null ids": [(None, word(i), *tail) for i in range(300)],
             "one id": [(4, word(i), *tail) for i in range(300)],
             "equal rows": [(4, word(0), *tail)] * 300,
             "equal rows among others": [(i % 50, word(i % 60), *tail) for i in range(300)] + [(None, word(1), *tail)] * 100}
    for name, rows in cases.items():
        df = spark.createDataFrame(rows, shape).repartition(7)
        for budget, epochs in ((0.5, 1), (0.123, 1), (0.999, 1), (1.7, 3)):
            total, got = _taken(df, budget, epochs)
            assert total == math.floor(budget * 11 * len(rows)), (name, budget)
            assert sum(0 < r["mix"]["part_tokens"] < r["mix"]["n_tokens"] for r in got) <= 1
            assert {(r["nth"], r["leaf"], r["__domain"]) for r in got} == {(5, "own", "theirs")}


# ---- 5

def test_tokens_against_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    odd = {-5: None, -4: "", -3: "A<|endoftext|>b <|ENDOFTEXT|>", -2: "Don't... stop., É́ İi ﬁ naïve's x.y, 3.14",
           -1: "ÀÉÎ ß ÿ Ÿ  a b \x1c c é. ," + "z" * 300}
    rows = spark.createDataFrame([*odd.items(), *docs.items()], "doc_id long, text string").withColumn("nth", F.lit(1))
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_repair.digest(rows, path).collect()}
    at = 0
    for i, t in sorted({**odd, **docs}.items()):
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert got[i] == (at, len(ids), zlib.crc32(ids.tobytes())), i
        at += len(ids)
    assert token_repair.digest(rows.limit(0), path).count() == 0
    twice = token_repair.digest(rows.where("doc_id < 0").union(rows.where("doc_id < 0")), path)
    assert twice.count() == 10


def test_repair_round_trip():
    rng = np.random.default_rng(0)
    for n, k in ((1, 3), (2, 1), (7, 1), (1000, 2), (30_000, 40)):
        ids = (rng.integers(0, k, n) ** 2).astype("<u4")
        shard = token_repair.Shard(token_repair.write_shard([n // 2, n - n // 2], ids, 6, 4))
        assert (shard.all_ids() == ids).all() and (shard.document(1) == ids[n // 2:]).all()
        for a, b in np.sort(rng.integers(0, n + 1, (40, 2))).tolist():
            assert (shard.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        token_repair.Shard(token_repair.write_shard([3], np.array([1, 2, 3], "<u4"), 2, 2)[:-1])


# ---- 6

KINDS = (("assign", re.compile(secret_ownership.KINDS[0][1][4:], re.I | re.A), 2, 12),
         ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))


def _base(text):
    spans, counts = [], []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        found = [m for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
        counts.append(len(found))
        spans += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in found]
    return (*counts, hashlib.sha256(",".join(s for *_, s in sorted(spans)).encode()).hexdigest())


def test_secrets_against_brute_force(spark, docs):
    odd = {-1: None, -2: "", -3: 'secret=api_key="longvaluelongvalue1" AKIAAKIA AKIA' + "Z" * 14 + "AKIA" + "Q" * 20,
           -4: "\U0001f600 Token : 'abcdef0123456789' pASSwd=short API_KEY=0123456789abcdef0123" * 40,
           -5: "AKIAabc " + "f" * 15 + " " + "f" * 16, -6: "x" * 200_000 + "token=" + "ab1" * 9}
    rows = spark.createDataFrame([(*x, f"o{x[0]}/r") for x in [*odd.items(), *docs.items(), (-4, odd[-4])]],
                                 "doc_id long, text string, source string").withColumn("hash", F.lit("h"))
    got = secret_ownership.scan_secrets(rows).collect()
    assert len(got) == len(odd) + len(docs) + 1
    texts = {**odd, **docs}
    for r in got:
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == _base(texts[r["doc_id"]]), r["doc_id"]
        base = ",".join(s for s in r["spans"].split(",") if not s.startswith("live"))
        assert hashlib.sha256(base.encode()).hexdigest() == r["base_sha256"]
    assert secret_ownership.scan_secrets(rows.limit(0)).count() == 0


def test_copied_examples_and_live_values(spark):
    own, shared = "token=Zx81kQ0pLm27", "token=example0key9abcd"
    rows = spark.createDataFrame([(i, f"{shared} here", f"o{i}/r") for i in range(4)]
                                 + [(9, own, "me/a"), (10, own, "me/b"), (11, own, None)],
                                 "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["n_live"], r["n_copied"]) for r in secret_ownership.scan_secrets(rows).collect()}
    assert got == {0: (0, 1), 1: (0, 1), 2: (0, 1), 3: (0, 1), 9: (1, 0), 10: (1, 0), 11: (1, 0)}


# ---- 7

@pytest.mark.parametrize("least", [1, 2, 3])
def test_scores_against_brute_force(spark, docs, least):
    rows = spark.createDataFrame([*docs.items(), (-1, None), (-2, "zzz zzz the"), (-3, "w" * 5000)], "doc_id long, text string")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    toks = {i: [*WORDS.findall(lower_ascii(t or "")), "\n"] for i, t in rows.collect()}
    learn = [i for i in toks if zlib.crc32(str(i).encode()) % 5 != 1]
    uni, pairs, triples = Counter(), Counter(), Counter()
    for i in learn:
        uni.update(toks[i])
        pairs.update(zip(toks[i], toks[i][1:]))
        triples.update(zip(toks[i], toks[i][1:], toks[i][2:]))
    n, v = sum(uni.values()), len(uni)
    pairs = {k: c for k, c in pairs.items() if c >= least}
    triples = {k: c for k, c in triples.items() if c >= least}
    p1 = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    after, after2 = {}, {}
    for a, b in pairs:
        after.setdefault(a, []).append(b)
    for a, b, c in triples:
        after2.setdefault((a, b), []).append(c)

    def p2(a, w):
        if (a, w) in pairs:
            return (pairs[a, w] - 0.5) / uni[a]
        if a not in after:
            return p1(w)
        return p1(w) * (1 - sum((pairs[a, x] - 0.5) / uni[a] for x in after[a])) / (1 - sum(map(p1, after[a])))

    def p3(a, b, w):
        if (a, b, w) in triples:
            return (triples[a, b, w] - 0.5) / pairs[a, b]
        if (a, b) not in after2:
            return p2(b, w)
        own = after2[a, b]
        return p2(b, w) * (1 - sum((triples[a, b, x] - 0.5) / pairs[a, b] for x in own)) / (1 - sum(p2(b, x) for x in own))

    got = {r["doc_id"]: r for r in lm_backoff.score_texts(rows, train, least=least).collect()}
    for i, words in toks.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in uni for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10(p1(w)) for w in words), rel=1e-9)
        model = sum(math.log10(p1(w) if k == 0 else p2(words[0], w) if k == 1 else p3(words[k - 2], words[k - 1], w))
                    for k, w in enumerate(words))
        assert r["score"] == pytest.approx(model, rel=1e-8), i
    assert lm_backoff.score_texts(rows.limit(0), train).count() == 0
    assert lm_backoff.score_texts(rows.limit(3), F.lit(False)).where("n_known = 0").count() == 3


def test_keys_are_ordered_by_one_sort_of_their_leading_bits(monkeypatch):
    rng = np.random.default_rng(7)
    argsort, slow = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda keys, **kw: slow.append(len(keys)) or argsort(keys, **kw))
    far = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)[rng.integers(0, 4000, 9000)]
    narrow = np.uint64(0xFFF0000000000000) + (rng.integers(0, 1 << 40, 5000, dtype=np.uint64) & lm_backoff._EVEN)
    top = np.array([0, (1 << 64) - 1, 0, (1 << 64) - 1, 5], dtype=np.uint64)
    for keys in (far, narrow, top[:0], top[:1], np.full(9, 3, dtype=np.uint64)):
        assert np.array_equal(lm_backoff._ordered(keys), argsort(keys, kind="stable"))
    assert not slow
    close = np.concatenate([top, rng.integers(0, 50, 300).astype(np.uint64)])  # equal in their leading bits
    assert np.array_equal(lm_backoff._ordered(close), argsort(close, kind="stable")) and slow


def test_known_keys_are_found_at_every_token():
    texts = ["the cat the cat sat", "", None, "the cat ran"] * 3 + ["one"]
    table = pa.table({"grp": pa.array([-1] * len(texts), pa.int64()), "id": list(range(len(texts))), "learn": [True] * len(texts),
                      "text": texts})
    own = lm_backoff._Chunk(table)
    keys, n = own.count(2, own.inside2)
    rows = [lm_backoff._block_rows([(g, 0, size, lm_backoff._wire(n[a:a + size].astype(np.uint64) << np.uint64(1)), None, None)])
            for a, (g, size, _) in zip(np.cumsum([0, *(s for _, s, _ in lm_backoff._deal(2, keys, n, buckets=4))]),
                                       lm_backoff._deal(2, keys, n, buckets=4))]
    at = own._known(pa.Table.from_batches(rows[::-1]), 4, 2, own.inside2, 6)
    assert np.array_equal(own.keys[0], keys[n >= 6]) and own.n[0].tolist() == n[n >= 6].tolist()
    often = np.isin(own.grams[1], keys[n >= 6]) & own.inside2
    assert np.array_equal(at >= 0, often) and np.array_equal(own.keys[0][at[often]], own.grams[1][often])


def test_sums_that_are_mostly_0_travel_as_bits():
    rng = np.random.default_rng(8)
    for size, share in ((0, 0), (1, 0), (1, 1), (1003, 0), (1003, 0.1), (1003, 1)):
        keys = np.sort(rng.integers(0, 1 << 62, size).astype(np.uint64))
        spent, below = (np.where(rng.random(size) < share, rng.random(size), 0.0) for _ in range(2))
        sent = lm_backoff._pack(keys, spent, below)
        got = lm_backoff._unpack(sent, size, "<u8", "<f8", "<f8")
        assert all(np.array_equal(a, b) for a, b in zip(got, (keys, spent, below), strict=True))
        assert len(sent) <= 8 * (size + np.count_nonzero(spent) + np.count_nonzero(below)) + size // 4 + 2


def test_pairs_seen_twice_are_states_whatever_the_corpus(spark):
    """1.2 million other tokens must not take the arcs away from a pair that was seen twice."""
    filler = " ".join(["f"] * 1000)
    rows = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit(filler).alias("text")).unionByName(
        spark.createDataFrame([(5000, "p q r"), (5001, "p q r"), (5002, "p q r"), (5003, "r q p")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in lm_backoff.score_texts(rows, F.col("doc_id") < 5002).where("doc_id >= 5000").collect()}
    n = 1200 * 1001 + 8
    level = math.log10(n + 0.5 * 6)
    start = math.log10(2.5) - level
    seen = 3 * math.log10(1.5 / 2)
    assert got[5002]["score"] == pytest.approx(start + seen, rel=1e-9) and got[5002]["train_tokens"] == n
    assert got[5003]["score"] < got[5002]["score"] and got[5003]["n_known"] == 4


# ---- 8

def test_escape_is_reversible():
    rng = random.Random(4)
    parts = [*chat_trees.CONTROLS, "\\", "\\\\", "[", "<", "s>", "/", "INST]", "x", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        safe = chat_trees.escape(text)
        assert chat_trees.unescape(safe) == text and not any(c in safe for c in chat_trees.CONTROLS)
        turns = [("user", text), ("assistant", text[::-1]), (text, "")]
        shaped, spans = chat_trees.format_turns(turns)
        assert chat_trees.read_turns(shaped) == turns
        assert [chat_trees.unescape(shaped[a:b]) for a, b in spans] == [r[1] for r in turns if r[0] == "assistant"]


def test_branches_of_a_tree(spark):
    rows = spark.createDataFrame(
        [("t", 1, None, "user", "q", 1.0, 0), ("t", 2, 1, "assistant", "short", 1.0, 0), ("t", 3, 1, "assistant", "long", 2.0, 0),
         ("t", 4, 2, "user", "more", 5.0, 0), (None, 7, 99, None, None, None, 0), ("c", 1, 2, "a", "x", 1.0, 0),
         ("c", 2, 1, "b", "y", 1.0, 0)],
        "tree string, node int, parent int, role string, text string, score double, rank int")
    got = {(r["tree"], r["rank"]): ([t for _, t in chat_trees.read_turns(r["formatted"])], r["score"])
           for r in chat_trees.format_reply_trees(rows, branches=2).collect()}
    assert got == {("t", 1): (["q", "short", "more"], 7.0), ("t", 2): (["q", "long"], 3.0), (None, 1): ([""], 0.0)}
    assert chat_trees.format_reply_trees(rows.limit(0)).count() == 0


def test_null_tree_and_repeated_messages(spark):
    rows = [(None, 1, None, "user", "a", 1.0), ("null", 1, None, "user", "b", 1.0), ("", 1, None, "user", "c", 1.0)]
    rows += [("t", i, i - 1 or None, "user", f"m{i}", 1.0) for i in range(1, 6)] * 2 + [("t", 5, 4, "user", "zz", 9.0)]
    df = spark.createDataFrame(rows, "tree string, node int, parent int, role string, text string, score double")
    got = {r["tree"]: (r["n_turns"], [t for _, t in chat_trees.read_turns(r["formatted"])])
           for r in chat_trees.format_reply_trees(df).collect()}
    assert got == {None: (1, ["a"]), "null": (1, ["b"]), "": (1, ["c"]), "t": (5, [f"m{i}" for i in range(1, 6)])}


def test_only_control_strings_are_marked():
    for text in ("[s>", "<INST]", "</INST]", "[/s>", "< s>", "[inst]"):
        assert chat_trees.escape(text) == text


# ---- 9

def test_patience_blocks_are_common_and_in_order():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(9))] for _ in range(2))
        i = k = 0
        for x, y, n in line_alignment.patience_blocks(a, b):
            assert x >= i and y >= k and n > 0 and a[x:x + n] == b[y:y + n]
            i, k = x + n, y + n
        if a == b:
            assert line_alignment.patience_blocks(a, b) == ([(0, 0, len(a))] if a else [])


def test_lines_are_deleted_from_later_documents(spark):
    passage = "a passage of quite some words that two documents share\nand its second line"
    rows = spark.createDataFrame(
        [(1, f"first\n{passage}\nend one"), (2, f"{passage}\nnew text here"), (3, "short line\nother"), (4, "short line\nthird"),
         (5, f"first\n{passage}\nend one"), (5, f"first\n{passage}\nend one"), (6, None), (7, ""), (None, "alone")],
        "doc_id long, text string").withColumn("row", F.lit(1))
    got = {(r["doc_id"], r["text"], r["n_removed"]) for r in line_alignment.dedup_lines(rows).collect()}
    assert got == {(1, f"first\n{passage}\nend one", 0), (2, "new text here", 2), (3, "short line\nother", 0),
                   (4, "short line\nthird", 0), (5, "", 4), (6, None, 0), (7, "", 0), (None, "alone", 0)}
    assert line_alignment.dedup_lines(rows.limit(0)).count() == 0


def _common(a, b, x, y):
    n = 0
    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
        n += 1
    return n


def test_patience_finds_the_heaviest_run_of_repeated_lines():
    rng = random.Random(2)
    for _ in range(1500):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        words = [(1, 4, 2)[x] for x in a]
        runs = [(sum(words[x:x + n]), x, y, n) for x in range(len(a)) for y in range(len(b)) if (n := _common(a, b, x, y))]
        heavy, x, y, n = line_alignment._heaviest_run(a, b, words)
        assert heavy == max((r[0] for r in runs), default=0) and a[x:x + n] == b[y:y + n] and sum(words[x:x + n]) == heavy
        if runs:
            assert line_alignment.patience_blocks(a, b)
    p = [1, 2, 3]
    assert line_alignment.patience_blocks([8, *p, 9], [*p, 7, *p]) == [(1, 0, 3)]
    assert line_alignment.patience_blocks([*p, 7, *p], [8, *p, 9]) == [(0, 1, 3)]


def test_blocks_whose_lines_have_other_first_owners(spark):
    rows = spark.createDataFrame(
        [(1, "four words of one\nalone a"), (2, "five words of the other\nalone b"), (3, "three more words\nalone c"),
         (4, "x y\nfour words of one\nfive words of the other\n\nthree more words\nz"),
         (5, "new\nfour words of one\nfive words of the other\n\nthree more words\nend")], "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_alignment.dedup_lines(rows).collect()}
    assert got == {1: [], 2: [], 3: [], 4: [], 5: [1, 2, 3, 4]}


def test_passages_that_one_document_repeats(spark):
    passage = "a passage of quite some words\nthat the first document holds twice\nand a third line"
    rows = spark.createDataFrame(
        [(6, f"{passage}\nbetween\n{passage}"), (7, f"before\n{passage}\nafter"),
         (8, "own start\n" + "q w e r t\na s d f g\n" * 2 + "own end"), (9, "q w e r t\na s d f g\nother")],
        "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_alignment.dedup_lines(rows).collect()}
    assert got == {6: [], 7: [1, 2, 3], 8: [], 9: [0, 1]}


def test_passages_in_another_order(spark):
    a, b, c = ("\n".join(f"passage {x} line {i} with some words" for i in range(6)) for x in "abc")
    rows = spark.createDataFrame([(1, f"{b}\n{a}\n{c}"), (2, f"own\n{c}\n{a}\nmiddle\n{b}")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_alignment.dedup_lines(rows).collect()}
    assert got == {1: f"{b}\n{a}\n{c}", 2: "own\nmiddle"}


def test_nothing_heavy_is_left_in_common():
    """Brute force over every pair of places: no run of ``least`` words stays, and what goes stood in the other."""
    rng = random.Random(4)
    for _ in range(1500):
        kinds = rng.choice((3, 8, 20))
        a, b = ([rng.randrange(kinds) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        words, least = [x % 4 for x in a], rng.choice((1, 3, 6))
        gone = line_alignment.common_blocks(a, b, words, least)
        assert all(a[i] in b for i in gone)
        left = [-5 if i in set(gone) else x for i, x in enumerate(a)]
        for x in range(len(a)):
            for y in range(len(b)):
                assert sum(words[x:x + _common(left, b, x, y)]) < least
        runs = [sum(words[x:x + _common(a, b, x, y)]) for x in range(len(a)) for y in range(len(b))]
        assert bool(gone) == (max(runs) >= least)


# ---- 10

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_contamination_against_brute_force(spark, docs):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    items |= {900: "Short item É", 901: None, 902: "!!", 903: "of the and of the and of the and of the and of the"}
    extra = {-1: None, -2: "x short-ITEM É y", -3: "short item é", -4: " ".join(items[0].split()[:10]),
             -5: "of the and " * 9, -6: items[1] + " " + items[1], -7: "..."}
    rows = spark.createDataFrame([*extra.items(), *docs.items(), (-6, extra[-6])], "doc_id long, text string").withColumn("n", F.lit(1))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("unit", F.lit("u"))
    windows = {}
    for i, t in items.items():
        w = LETTERS.findall(lower_ascii(t or ""))
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s:s + 10]), set()).add(str(i))
    texts = {**extra, **docs}
    for block in (2_000_000, 400):
        got = benchmark_index.contamination(rows, bench, block_words=block).collect()
        assert len(got) == len(texts) + 1
        for r in got:
            w = LETTERS.findall(lower_ascii(texts[r["doc_id"]] or ""))
            hit, found = set(), set()
            for k in {len(x) for x in windows}:
                for s in range(len(w) - k + 1):
                    if own := windows.get(tuple(w[s:s + k])):
                        hit.update(range(s, s + k))
                        found |= own
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(found)), r["doc_id"]
            assert r["n_near"] >= r["n_items"] and r["contaminated"] == bool(hit)
    assert benchmark_index.contamination(rows, bench.limit(0)).where("contaminated").count() == 0
    assert benchmark_index.contamination(rows.limit(0), bench).count() == 0


def test_workers_give_up_what_other_operators_kept():
    from geoincident.llm import common

    mine, other = common.kept("test_mine"), common.kept("test_other")
    mine[1], other[1] = "a", "b"
    assert list(common.lean(lambda batches: batches, "test_mine")(iter([3]))) == [3]
    assert mine == {1: "a"} and other == {}
    assert list(common.lean(lambda batches: batches)(iter([]))) == [] and mine == {}
    assert token_repair._WORD_IDS is common.kept("word_ids")


def test_byte_contexts_are_counted_in_pieces(monkeypatch):
    from collections import Counter

    texts = [b"", b"Abcab", b"x" * 50, b"abc abd abe" * 9]
    plain = Counter((b"\n" * 4 + t.lower())[i:i + 5] for t in texts for i in range(len(t)))
    monkeypatch.setattr(language_ppm, "_COUNT_BYTES", 7)
    codes, counts = language_ppm._top_counts(texts, 4)
    assert {int(c).to_bytes(5, "big"): n for c, n in zip(codes, counts.tolist(), strict=True)} == plain
    assert [len(x) for x in language_ppm._top_counts([], 4)] == [0, 0]
