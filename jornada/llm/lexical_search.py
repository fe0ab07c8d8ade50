"""Ranked lexical search: an Aho-Corasick scan of the documents, without an index.

1. The terms of a block of items become one automaton over their bytes, each term
   guarded by a separator on both sides, so only whole terms of a text match. The
   automaton is sent to the tasks; a block is at most BLOCK_BYTES of item text. Items
   beyond it are further blocks, each with a scan of its own.
2. A scan reads every text once and keeps its number of terms and the counts of the
   item terms in it. From that table come the document frequencies, N and L.
3. The automaton's outputs map to items: each term's postings (item, repeats) spread a
   document's contributions over items. Every task keeps its best rows of each item; the
   rest are ranked by Spark, over hashed shares of the documents first.

Contributions are exact integers: a score is under 10**6 * 45,000 * (an item's terms),
below 2**53 for any item in a block, so sums in doubles are exact.

Defined cases: a null or empty text, or one without terms, counts in no number and is
never returned; an item without terms or without a matching document has no rows; the
items of a repeated id are ranked each on their own. Equal scores are in order of
doc_id (null last); rows that share an id and a score have ranks in any order. Extra
columns are ignored; empty tables give no rows. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import text_slices

TOP = 20
#: Text bytes of the items whose automaton and postings are sent to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Cells of one scoring step (documents x items), and contributions spread at once.
CELLS = 4 << 20

# Bytes that are no part of a term; only A-Z are folded.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _FOLD[_a:_b + 1] = 0x20
_IS_TERM = _FOLD != 0x20


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return [t for t in (text or "").encode().translate(_FOLD.tobytes()).split(b" ") if t]


class ItemBlock:
    """Terms of some items: their automaton and their postings."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        number: dict[bytes, int] = {}
        postings: list[tuple[int, int, int]] = []
        for at, (_, text) in enumerate(items):
            for term, n in Counter(terms(text)).items():
                postings.append((number.setdefault(term, len(number)), at, n))
        self.terms = list(number)
        postings.sort()
        self.items = np.array([p[1] for p in postings], np.int64)
        self.repeats = np.array([p[2] for p in postings], np.float64)
        self.starts = np.searchsorted([p[0] for p in postings], np.arange(len(number) + 1))

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", i)
        found.make_automaton()
        return found


def count_terms(docs: DataFrame, block: ItemBlock) -> DataFrame:
    """doc_id, n (terms of the text) and the item terms in it with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = block.automaton() if block.terms else None
        for batch in batches:
            for lo, hi, offsets, data in text_slices(batch.column(1)):
                mask = _IS_TERM[data]
                starts = mask.copy()
                starts[1:] &= ~mask[:-1]
                first = offsets[:-1][offsets[:-1] < len(data)]
                starts[first] = mask[first]  # a row's first byte starts a term of its own
                before = np.concatenate(([0], np.cumsum(starts)))
                n = before[offsets[1:]] - before[offsets[:-1]]
                folded = _FOLD[data].tobytes().decode("latin-1")
                found = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    counts = (Counter(map(itemgetter(1), automaton.iter(f" {folded[a:b]} ")))
                              if automaton is not None and b > a else {})
                    found.append(counts)
                keep = pa.array(n > 0)
                flat = [np.fromiter((x for c in found for x in side(c)), np.int32) for side in (dict.keys, dict.values)]
                ends = pa.array(np.concatenate(([0], np.cumsum([len(c) for c in found]))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(f)) for f in flat]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), *lists],
                    ["doc_id", "n", "term", "tf"]).filter(keep)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n bigint, term array<int>, tf array<int>")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class _Best:
    """The best rows of each item so far, of a task."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * items
        self.least = np.ones(items)

    def add(self, item: int, ids: np.ndarray, none: np.ndarray, scores: np.ndarray) -> None:
        ids, none, scores = (np.concatenate(x) for x in zip(self.rows[item], (ids, none, scores)))
        order = np.lexsort((ids, none, -scores))[:self.top]
        self.rows[item] = ids[order], none[order], scores[order]
        if len(order) == self.top:
            self.least[item] = scores[order[-1]]


def best_documents(counts: DataFrame, block: ItemBlock, documents: int, length: int,
                   df: dict[int, int], top: int = TOP) -> DataFrame:
    """Each task's best rows of each item: item (number in the block), doc_id, score."""
    weights = np.array([weight(documents, df.get(i, 0)) for i in range(len(block.terms))], np.int64)
    spread = np.diff(block.starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(block.ids), top)
        rows = max(1, CELLS // max(1, len(block.ids)))
        for batch in batches:
            term, tf = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            ends = np.concatenate(([0], np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))))
            ids = batch.column(0)
            none = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            m = 100 - 25 + (25 * n * documents) // length
            doc = np.repeat(np.arange(len(n)), np.diff(ends))
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            at = 0
            while at < len(n):
                # As many documents as keep cells and contributions in bounds, one at least.
                end = min(len(n), at + rows)
                work = np.cumsum(spread[term[ends[at]:ends[end]]])
                if len(work) and work[-1] > CELLS:
                    fits = np.searchsorted(work, CELLS, side="right") + ends[at]
                    end = max(at + 1, int(np.searchsorted(ends, fits, side="right")) - 1)
                part = slice(ends[at], ends[end])
                times = spread[term[part]]
                start = np.repeat(block.starts[term[part]] - np.concatenate(([0], np.cumsum(times)[:-1])), times)
                post = start + np.arange(len(start))
                cell = np.repeat(doc[part] - at, times) * len(block.ids) + block.items[post]
                total = np.bincount(cell, np.repeat(value[part], times) * block.repeats[post],
                                    (end - at) * len(block.ids)).reshape(end - at, len(block.ids))
                for item in np.flatnonzero((total >= best.least).any(axis=0)):
                    hit = np.flatnonzero(total[:, item] >= best.least[item])
                    best.add(int(item), ids[at + hit], none[at + hit], total[hit, item].astype(np.int64))
                at = end
        for item, (doc_ids, missing, scores) in enumerate(best.rows):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), item, np.int32)), pa.array(doc_ids, mask=missing), pa.array(scores)],
                    ["item", "doc_id", "score"])
    return counts.mapInArrow(run, "item int, doc_id bigint, score bigint")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The best rows of each item, by share of the documents first, then of all."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    some = (rows.withColumn("share", share)
            .withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*order)))
            .where(F.col("rank") <= top).drop("share", "rank"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= top))


def item_blocks(items: DataFrame) -> Iterator[ItemBlock]:
    """Blocks of items of bounded size; the driver holds one at a time."""
    rows, size = [], 0
    for r in items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator():
        rows.append((r.item_id, r.text))
        size += len((r.text or "").encode())
        if size >= BLOCK_BYTES:
            yield ItemBlock(rows)
            rows, size = [], 0
    yield ItemBlock(rows)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of every item."""
    spark = docs.sparkSession
    out = scratch_dir(spark, "search-ranked")
    schema = "item_id bigint, rank int, doc_id bigint, score bigint"
    for block in item_blocks(items):
        path = scratch_dir(spark, "search-counts")
        count_terms(docs, block).write.parquet(path)
        counts = spark.read.parquet(path)
        total = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        # One row for each term of the block.
        df = dict(counts.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator())
        names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id bigint")
        best = best_documents(counts, block, total.documents or 0, total.length or 1, df, top)
        (ranked(best, top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
         .write.mode("append").parquet(out))
    return spark.read.schema(schema).parquet(out)
