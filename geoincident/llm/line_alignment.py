"""Line dedup by pairwise alignment (op 9).

1. Every line's hash is counted over the documents, and so is that of every
   shortest run of consecutive lines that reaches ``least_words`` words. A line
   or run that several documents share names one partner for all of them: the
   first document that has it. So a line of thousands of documents gives as many
   pairs, not their square, none is too frequent to be used, and every block
   that can be deleted has, from each of its lines on, a partner with the whole run.
2. Each (later document, partner) pair is aligned by patience diff: lines that
   are unique in both are the anchors, the rarest lines of the pair; the longest
   increasing run of them is kept, equal lines next to an anchor join it, and
   the gaps are aligned again. A gap without such lines is split at the common
   run of consecutive lines with the most words.
3. Aligned common blocks of at least ``least_words`` words are deleted from the
   later document, and what is left of it is aligned again until the partner has
   no run of so many words of it: passages may stand in any order.

Documents are ordered by id, then by a hash of id and text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoincident.llm.common import prepare, staged

#: marks in place of a line's hash: deleted, and not in the other document
_GONE, _ELSE = -2, -1


def _heaviest_run(a: list[int], b: list[int], words: list[int]) -> tuple[int, int, int, int]:
    """Words, start in a, start in b and length of the common run of most words (the first one), by the
    suffix automaton of b; ``words`` are those of a's lines."""
    step: list[dict[int, int]] = [{}]
    link, size, end = [-1], [0], [-1]
    last = 0
    for at, x in enumerate(b):
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        end.append(at)
        p, last = last, new
        while p >= 0 and x not in step[p]:
            step[p][x] = new
            p = link[p]
        if p < 0:
            continue
        q = step[p][x]
        if size[q] > size[p] + 1:
            twin = len(step)
            step.append(dict(step[q]))
            link.append(link[q])
            size.append(size[p] + 1)
            end.append(end[q])
            link[q] = twin
            while p >= 0 and step[p].get(x) == q:
                step[p][x] = twin
                p = link[p]
            q = twin
        link[new] = q
    total = [0, *accumulate(words)]
    best = (0, 0, 0, 0)
    state = length = 0
    for at, x in enumerate(a, 1):
        while state and x not in step[state]:
            state = link[state]
            length = size[state]
        if x in step[state]:
            state, length = step[state][x], length + 1
            if total[at] - total[at - length] > best[0]:
                best = (total[at] - total[at - length], at - length, end[state] + 1 - length, length)
    return best


def patience_blocks(a: list[int], b: list[int], words: list[int] | None = None, least: int = 1
                    ) -> list[tuple[int, int, int]]:
    """Aligned common blocks (start in a, start in b, length), in order.

    ``words`` of a's lines (one each if not given): in a gap without a line
    unique in both, only blocks of ``least`` words and more are sought.
    """
    words = [1] * len(a) if words is None else words
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            pairs.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            pairs.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {x: y for y, x in enumerate(b[k:m], k) if in_b[x] == 1}
        unique = [(x, place[v]) for x, v in enumerate(a[i:j], i) if in_a[v] == 1 and v in place]
        if not unique:
            if sum(words[x] for x, v in enumerate(a[i:j], i) if v in in_b) >= least:
                heavy, x, y, size = _heaviest_run(a[i:j], b[k:m], words[i:j])
                if heavy >= max(least, 1):
                    pairs += ((i + x + n, k + y + n) for n in range(size))
                    todo += ((i, i + x, k, k + y), (i + x + size, j, k + y + size, m))
            continue
        # longest increasing run by piles
        tops, last, back = [], [], [-1] * len(unique)
        for n, (_, y) in enumerate(unique):
            pile = bisect_left(tops, y)
            if pile == len(tops):
                tops.append(y)
                last.append(n)
            else:
                tops[pile], last[pile] = y, n
            back[n] = last[pile - 1] if pile else -1
        run, n = [], last[-1]
        while n >= 0:
            run.append(unique[n])
            n = back[n]
        run.reverse()
        # each gap starts at an anchor, so the anchor and its equal neighbours are its head
        starts = [(i, k), *run]
        for (x, y), (u, v) in zip(starts, [*run, (j, m)], strict=True):
            todo.append((x, u, y, v))
    pairs.sort()
    out: list[tuple[int, int, int]] = []
    for x, y in pairs:
        if out and out[-1][0] + out[-1][2] == x and out[-1][1] + out[-1][2] == y:
            out[-1] = (out[-1][0], out[-1][1], out[-1][2] + 1)
        else:
            out.append((x, y, 1))
    return out


def common_blocks(a: list[int], b: list[int], words: list[int], least: int) -> list[int]:
    """Lines of ``a`` in blocks of ``least`` words and more that ``b`` has too, wherever they stand in it.

    The pair is aligned; what is left of ``a`` is aligned again with the whole
    of ``b``, which finds passages in another order, and at last the heaviest
    common runs are taken until none reaches ``least``.
    """
    gone: set[int] = set()
    rest, theirs = list(a), set(b)

    def take(blocks: list[tuple[int, int, int]]) -> bool:
        found = False
        for start, _, size in blocks:
            if sum(words[start:start + size]) >= least:
                found = True
                gone.update(range(start, start + size))
                rest[start:start + size] = [_GONE] * size
        return found

    aligning = take(patience_blocks(a, b, words, least))
    while _heaviest_stretch(rest, theirs, words) >= least:
        some = set(rest)
        other = [x if x in some else _ELSE for x in b]
        if aligning:
            aligning = take(patience_blocks(rest, other, words, least))
            continue
        _, x, y, size = _heaviest_run(rest, other, words)
        if not take([(x, y, size)]):
            break
    return sorted(gone)


def _heaviest_stretch(a: list[int], theirs: set[int], words: list[int]) -> int:
    """Words of the heaviest run of lines of ``a`` that the other document has anywhere; no common run has more."""
    best = now = 0
    for x, n in zip(a, words, strict=True):
        now = now + n if x in theirs else 0
        best = max(best, now)
    return best


def _line_table(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hash and number of words of every line, white space at its ends does not count, and the hash of the
    shortest run of two and more lines from each line on that has ``least`` words."""

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words, runs = [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                lines = [x.strip() for x in (text or b"").split(b"\n")]
                own = np.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) if x else 0 for x in lines], dtype=np.int64)
                size = np.array([len(x.split()) for x in lines], dtype=np.int64)
                total = np.cumsum(size)
                stop = np.searchsorted(total, total - size + least) + 1
                some = np.flatnonzero((own != 0) & (size < least) & (stop <= len(lines)))
                hashes.append(own)
                words.append(size)
                runs.append([xxhash.xxh3_64_intdigest(own[i:k].tobytes()) - (1 << 63)
                             for i, k in zip(some.tolist(), stop[some].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hashes, pa.list_(pa.int64())),
                 pa.array([x.astype(np.int32) for x in words], pa.list_(pa.int32())),
                 pa.array(runs, pa.list_(pa.int64()))], names=["id", "row", "lines", "words", "runs"])

    return table


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 10) -> DataFrame:
    """Id, text without the deleted lines, n_lines, n_removed, removed (line numbers from 0) of every row.

    Null text stays null and has no lines. Rows equal in id and text are one
    document and get the same result; other rows of an id are ordered among
    themselves. Null ids come first. Extra columns are ignored; an empty table
    gives an empty result. A document all of whose lines are deleted has the empty text.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    table = staged(rows.where("text is not null").mapInArrow(
        _line_table(least_words), f"id {kind}, row long, lines array<long>, words array<int>, runs array<long>"), "lines")
    order = F.struct("id", "row").alias("doc")
    met = table.select(order, F.explode(F.array_distinct(F.concat("lines", "runs"))).alias("line")).where("line <> 0")
    first = (met.groupBy("line").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
             .where("first.row <> last.row").select("line", "first"))
    pairs = staged(met.join(first, "line").where("doc.row <> first.row").select(
        F.col("doc.row").alias("row"), F.col("first.row").alias("partner")).distinct(), "pairs")
    one = table.dropDuplicates(["row"])
    both = (pairs.join(one.select("row", "lines", "words"), "row")
            .join(one.select(F.col("row").alias("partner"), F.col("lines").alias("theirs")), "partner")
            .select("row", "lines", "words", "theirs"))

    def align(batches):
        for batch in batches:
            own, cut = [], []
            for i, row in enumerate(batch.column(0).to_pylist()):
                a, words = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                shared = set(a)
                b = [x if x in shared else _ELSE for x in batch.column(3)[i].as_py()]
                gone = common_blocks(a, b, words, least_words)
                if gone:
                    own.append(row)
                    cut.append(gone)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(cut, pa.list_(pa.int32()))],
                                             names=["row", "gone"])

    gone = staged(both.mapInArrow(align, "row long, gone array<int>").groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone")), "gone")
    out = rows.join(gone.hint("merge"), "row", "left")  # the same plan at every size
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")
    return out.select(
        F.col("id").alias(id_col), F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("removed"))


def op9_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; blocks of ten words and more."""
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
