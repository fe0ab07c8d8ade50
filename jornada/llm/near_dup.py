"""Near-duplicate groups by SetSketch registers.

1. Every text becomes its set of shingle hashes; from it a sketch: register j keeps
   the smallest of the set's j-th hash values, read as an exponential variate, on an
   exponential scale (``floor(1 - log_b x)``, truncated). Registers of a union are
   the register-wise maxima, and equal registers grow likelier with similarity.
2. Documents with equal sets (by a 128-bit digest) form one class; only one row of a
   class goes on, under a number of the class's own that is written with it.
3. Bands of ``ROWS`` registers are the candidate keys: sets that share a key, directly
   or through others, form a candidate group. Groups too large for one block are split
   by ``DRAWS`` further keys of ``DEEP`` drawn registers each.
4. Inside a block, a pair passes if its jointly estimated similarity (maximum
   likelihood over greater, smaller and equal registers, given the exact set sizes) is
   not clearly below the threshold, and becomes a link if the full sets confirm
   ``100 * intersection >= 80 * union``. Only a spanning forest of the links leaves a
   block; groups of several blocks are finished as :mod:`.blocks` tells.
5. Components are found by min-label propagation with pointer jumping.

With 32 bands of 5 rows a pair at similarity exactly 0.8 shares no band with
probability 3e-6, less above it; in a group larger than a block it shares none of the
further keys with a probability of about 1e-5.

Defined cases: a null text or one without words has an empty set, n_shingles 0 and
is its own component; texts with equal sets share a class, whatever their ids; the
texts of a repeated id are compared each on their own. A component is named by its
smallest id, so it has a null name where all its rows have a null id, and the different
texts of one id may name two components alike. ``kept`` marks the row of a component
with the smallest id (of one id's texts, the smallest digest of the text) and its exact
repeats for ``deduplicate``; ``near_duplicates`` returns doc_id = component_id under that
name (false without an id). Extra columns are ignored; empty tables give no rows. Texts are read whole,
whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import common_counts, verified_links
from .common import WORD, mix64, text_slices, unused, word_hashes, written
from .graph import TASK_LINKS, connected, forest

LEAST, OF = 80, 100
SHINGLE = 2
BANDS, ROWS = 32, 5
M = BANDS * ROWS
#: Sketch base, rate and register limit: x from 1 down to b**-4000 (1e-34) in steps of 2 %.
BASE, RATE, LIMIT = 1.02, 20.0, 4000
#: Pairs whose estimate is below this are not verified; nearly five standard deviations under 0.8.
MIN_ESTIMATE = 0.65
#: Keys of drawn registers that split a group too large for one block.
DRAWS, DEEP = 128, 8

_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(1, 1 << 63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, M, dtype=np.uint64)
_BANDED = np.arange(M).reshape(BANDS, ROWS)
_DRAWN = np.stack([_rng.choice(M, DEEP, replace=False) for _ in range(DRAWS)])


def shingle_sets(offsets: np.ndarray, data: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each row of a slice; a short text is one shingle."""
    words, first = word_hashes(offsets, data)
    mixed = words.copy()
    for i in range(1, size):  # position-dependent, so word order matters
        mixed[:len(words) - i] = mix64(mixed[:len(words) - i] * np.uint64(0x9E3779B97F4A7C15)
                                       + words[i:])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        if n >= size:
            yield np.unique(mixed[a:b - size + 1])
        elif n:
            h = np.array([n], dtype=np.uint64)
            for w in words[a:b]:
                h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + w)
            yield h
        else:
            yield np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes (empty set: all 0)."""
    if not len(hashes):
        return np.zeros(M, np.uint16)
    least = np.full(M, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 256):
        part = hashes[at:at + 256, None] * _FACTOR
        part += _SHIFT
        np.minimum(least, part.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 1.0) / 2.0 ** 64
    spaced = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(spaced) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


_GRID = np.linspace(0.0, 1.0, 101)


def _likelihood(more, less, same, u, v, j):
    """Log-likelihood of similarity j, given how many registers are greater, smaller and
    equal, and the shares of the two sets in the sum of their sizes."""
    def p(x):  # probability that one register exceeds the other
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    return (more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny))
            + same * np.log(np.maximum(1 - up - down, tiny)))


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely similarity of each pair (register matrices and set sizes)."""
    total = np.maximum(na + nb, 1).astype(float)
    u, v = (na / total)[:, None], (nb / total)[:, None]
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    j = np.minimum(_GRID, np.minimum(u / np.maximum(v, 1e-12), v / np.maximum(u, 1e-12)))
    score = _likelihood(more, less, a.shape[1] - more - less, u, v, j)
    return j[np.arange(len(j)), score.argmax(axis=1)]


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which pairs of two register matrices have an estimate of MIN_ESTIMATE or more.

    The likelihood is concave in the similarity, so two of its values tell on which side
    of the limit its maximum is.
    """
    out = np.zeros((len(a), len(b)), bool)
    step = max(1, (1 << 22) // (len(b) * M))
    for i in range(0, len(a), step):
        more, less = ((f(a[i:i + step, None], b)).sum(axis=2, dtype=np.int16) for f in (np.greater, np.less))
        small, large = (f(na[i:i + step, None], nb) for f in (np.minimum, np.maximum))
        row, col = np.nonzero((OF * small >= LEAST * large) & (M - more - less >= M * MIN_ESTIMATE / 2))
        more, less = more[row, col], less[row, col]
        u = na[i + row] / (na[i + row] + nb[col])
        at, below = (_likelihood(more, less, M - more - less, u, 1 - u, j) for j in (MIN_ESTIMATE, MIN_ESTIMATE - 0.01))
        out[i + row, col] = at > below
    return out


def _row_key() -> Column:
    """Digest of a row's id and text: rows that share it are exact repeats."""
    named = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("none"))
    return F.unhex(F.sha2(F.concat(named, F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"), 256))


def sketch(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row key, n_shingles, digest of the set and its registers (null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, offsets, data in text_slices(batch.column(2)):
                sizes, digests, regs = [], [], []
                for s in shingle_sets(offsets, data, shingle):
                    sizes.append(len(s))
                    digests.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    regs.append(registers(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
                    ["doc_id", "row_key", "n_shingles", "digest", "regs"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _row_key().alias("row_key"), "text").mapInArrow(
        run, "doc_id bigint, row_key binary, n_shingles bigint, digest binary, regs binary")


#: 64-bit words of a packed set that hold its registers.
HEAD = M * 2 // 8


def packed_sets(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, set): registers and whole set of each (id, text, regs) row, as one binary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = batch.column(2)
            for lo, hi, offsets, data in text_slices(batch.column(1)):
                sets = [regs[lo + i].as_py() + s.tobytes()
                        for i, s in enumerate(shingle_sets(offsets, data, shingle))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], ["id", "set"])
    return texts.select("id", "text", "regs").mapInArrow(run, "id bigint, set binary")


def linked(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which pairs of two lists of packed sets are likely by their registers and reach the
    threshold by their full sets."""
    regs, sizes = [], []
    for packed in (left, right):
        regs.append(np.stack([s[:HEAD] for s in packed]).view(np.uint16))
        sizes.append(np.array([len(s) - HEAD for s in packed]))
    out = likely(regs[0], regs[1], sizes[0], sizes[1])
    if left is right:
        np.fill_diagonal(out, False)
    row, col = (np.flatnonzero(out.any(axis=axis)) for axis in (1, 0))
    if len(row):
        near = [left[i][HEAD:] for i in row]
        both = common_counts(near, near if left is right else [right[i][HEAD:] for i in col]).astype(np.int64)
        union = sizes[0][row][:, None] + sizes[1][col] - both
        out[np.ix_(row, col)] &= OF * both >= LEAST * union
    return out


def _keys_of(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, id) per row of ``chosen``: the key hashes the row's number and its registers."""
    keys, size = chosen.shape
    powers = (np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, size + 1, dtype=np.uint64))
    numbers = mix64(np.arange(1, keys + 1, dtype=np.uint64))
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            regs = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(-1, M)
            mixed = mix64(regs.astype(np.uint64) + np.uint64(1))
            key = mix64((mixed[:, chosen] * powers).sum(axis=2, dtype=np.uint64) + numbers)
            ids = np.repeat(np.asarray(part.column(0)), keys)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(ids)],
                                             ["key", "id"])


def _stars(reps: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(a, b): each id (of id, regs) with the smallest one of a key, as many pairs as connect
    whatever shares keys."""
    keys = written(reps.select("id", "regs").mapInArrow(lambda batches: _keys_of(batches, chosen),
                                                        "key bigint, id bigint").distinct(), "near-keys")
    lead = (keys.groupBy("key").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("key", "a"))
    stars = keys.join(lead, "key").where("a <> id").select("a", F.col("id").alias("b"))
    # As many tasks as keep their part of the keys in bounds: a set is in every task's forest.
    return written(forest(stars.coalesce(keys.count() // TASK_LINKS + 1)), "near-stars")


def candidate_stars(reps: DataFrame, chosen: np.ndarray = _BANDED) -> DataFrame:
    """(a, b) pairs that connect whatever ids (of id, regs) share keys.

    An eighth of the keys comes first. What they connect stands under one id in the
    others, so a large group of near copies has few rows there.
    """
    first = _stars(reps, chosen[:len(chosen) // 8])
    named = reps.select("id", "regs").join(connected(first), "id", "left").select(
        F.coalesce("comp", "id").alias("id"), "regs")
    return first.unionByName(_stars(named, chosen[len(chosen) // 8:]))


def _keyed_duplicates(docs: DataFrame, shingle: int) -> DataFrame:
    """near_duplicates with the row key."""
    base = written(sketch(docs, shingle), "near-sketch")
    # The first row of a class: the smallest id, then the smallest key.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    classes = (base.where("digest is not null").groupBy("digest")
               .agg(first.alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs")))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "near-reps")
    reps = classes.select("id", "n_shingles", "regs", F.col("first.row_key").alias("row_key"))
    stars = candidate_stars(reps)
    wanted = written(reps.join(stars.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id"), "near-wanted")
    # Exact repeats of a row have one key: one of them is read.
    texts = written(docs.select(_row_key().alias("row_key"), "text").join(wanted.drop("n_shingles"), "row_key")
                    .dropDuplicates(["id"]).select("id", "text", "regs"), "near-texts")
    links = verified_links(
        wanted.select("id", "n_shingles"), stars, linked,
        lambda ids: packed_sets(texts.join(ids, "id"), shingle),
        lambda sets: candidate_stars(sets.select("id", F.substring("set", 1, 2 * M).alias("regs")), _DRAWN))
    classes = (classes.select("digest", "id", "first").join(connected(links), "id", "left")
               .withColumn("comp", F.coalesce("comp", "id")))
    top = classes.groupBy("comp").agg(F.min("first").alias("top"))
    classes = classes.join(top, "comp").select(
        "digest", F.col("first.doc_id").alias("class_id"), F.col("top.doc_id").alias("component_id"),
        F.col("top.row_key").alias("top"))
    own = F.col("digest").isNull()
    return base.drop("regs").join(classes, "digest", "left").select(
        "doc_id", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (own | (F.col("row_key") == F.col("top"))).alias("kept"),
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "row_key")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id) and class_id, one row
    per document."""
    same = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return _keyed_duplicates(docs, shingle).drop("row_key").withColumn("kept", same)


def deduplicate(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, its text that of the smallest id. Of rows without
    words, only the repeats of a known id are dropped."""
    key = unused(docs, "row_key")
    keep = _keyed_duplicates(docs, shingle).where("kept").select(F.col("row_key").alias(key)).distinct()
    blank = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = docs.where(~blank).withColumn(key, _row_key()).dropDuplicates([key])
    return rows.join(keep, key, "left_semi").drop(key).unionByName(docs.where(blank))
