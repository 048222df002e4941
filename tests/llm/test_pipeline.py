"""The pipeline's stages, each on its own input, against plain Python on sf0.001."""

import hashlib
import random
import re
import zlib

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _near_kept(rows):
    """Smallest id of every group of 5-word shingle sets linked at 0.8; wordless documents stay."""
    sets, root = {}, {r.doc_id: r.doc_id for r in rows}
    for r in rows:
        w = re.findall("[^\x20\x09-\x0d]+", _lower(r.text))
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def _clean(rows, items):
    """Documents without a window of ten words (or a whole shorter item) of the benchmark."""
    def split(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", _lower(text))

    windows = set()
    for item in items:
        w = split(item.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    sizes = {len(w) for w in windows}
    out = set()
    for r in rows:
        w = split(r.text)
        if not any(tuple(w[i:i + k]) in windows for k in sizes for i in range(len(w) - k + 1)):
            out.add(r.doc_id)
    return out


def _check_mix(rows, kept):
    """Each leaf keeps the first of its documents in the seeded order; all leaves together take the budget."""
    leaves, total, last = {}, 0, []
    for r in rows:
        n = len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))
        number = re.search("([0-9]{1,9})$", r.source or "")
        leaf = (int(number[1]) % 3 if number else "-", r.lang, r.source)
        total += n
        if n:
            leaves.setdefault(leaf, []).append((hashlib.md5(f"7:0:{r.doc_id}".encode()).hexdigest(), r.doc_id, n))
    taken = 0
    for docs in leaves.values():
        docs.sort()
        here = [i in kept for _, i, _ in docs]
        assert here == sorted(here, reverse=True)
        some = [n for _, i, n in docs if i in kept]
        taken += sum(some)
        last += some[-1:] if len(some) < len(docs) else []
    assert kept <= {i for docs in leaves.values() for _, i, _ in docs}
    assert int(0.9 * total) <= taken < int(0.9 * total) + sum(last) + 1


def test_noise_and_other_languages_go_and_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(5)
    odd = [(-i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))) for i in range(1, 21)]
    odd += [(-30, "Это обычный текст на русском языке о погоде и о людях, которые живут в городе."), (-31, None), (-32, ""),
            (-33, "12 34 !?")]
    odd = spark.createDataFrame([tuple({"doc_id": i, "text": t}.get(c) for c in docs.columns) for i, t in odd], docs.schema)
    own = {"__lang": "a", "__share": "b", "__bits": "c", "mix": "d", "__row": "e"}
    both = docs.unionByName(odd).withColumns({k: F.lit(v) for k, v in own.items()})
    got = corpus_pipeline.language(spark, both, SF)
    assert got.columns == both.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()} and len(rows) >= 0.99 * docs.count()
    for stage in (corpus_pipeline.near_copies, corpus_pipeline.decontaminate, corpus_pipeline.mix):
        out = stage(spark, spark.createDataFrame(rows[:40], both.schema), SF)
        assert out.columns == both.columns
        assert {tuple(r[k] for k in own) for r in out.collect()} == {tuple(own.values())}


def test_stages_of_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_stages_against_plain_python(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages, schema = dict(corpus_pipeline.STAGES), docs.schema

    def step(name, rows):
        out = stages[name](spark, spark.createDataFrame(rows, schema), SF)
        assert out.columns == docs.columns
        return out.collect()

    first = docs.collect()
    known = step("language", first)
    assert all(any(c.isalpha() for c in r.text or "") for r in known)
    assert set(known) <= set(first) and len(known) > 0.5 * len(first)

    single = step("near_copies", known)
    assert sorted(r.doc_id for r in single) == sorted(_near_kept(known))

    clean = step("decontaminate", single)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    assert sorted(r.doc_id for r in clean) == sorted(_clean(single, items))
    assert len(clean) < len(single)

    mixed = step("mix", clean)
    assert mixed and set(mixed) <= set(clean) and len(set(mixed)) == len(mixed)
    _check_mix(clean, {r.doc_id for r in mixed})

    got = {r.doc_id: r for r in stages["tokens"](spark, spark.createDataFrame(mixed, schema), SF).collect()}
    encoder, start = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json"))), 0
    assert len(got) == len(mixed)
    for r in sorted(mixed, key=lambda r: r.doc_id):
        ids = [*encoder.encode(r.text, add_special_tokens=False).ids, 1]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        out = got[r.doc_id]
        assert (out.start, out.n_tokens, out.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_near_copies_of_null_and_repeated_ids(spark):
    """A group is told by its links, not by an id that others may share."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    texts = {c: " ".join(f"{c}{k}" for k in range(30)) for c in "abcdefg"}
    rows = [(None, texts["a"]), (None, texts["b"]), (None, texts["c"]), (7, texts["d"]), (7, texts["e"]),
            (8, texts["f"] + " more"), (None, texts["f"]), (9, texts["f"]), (None, texts["g"]), (None, texts["g"]),
            (None, None), (None, ""), (3, " ")]
    full = [tuple({"doc_id": i, "text": t}.get(c) for c in schema.names) for i, t in rows]
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(full, schema), SF).collect()
    want = [r for r in rows if r not in ((None, texts["f"]), (9, texts["f"]), (None, texts["g"]))] + [(None, texts["g"])]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(want, key=str)
