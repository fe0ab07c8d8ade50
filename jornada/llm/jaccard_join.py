"""N-gram Jaccard join: groups of documents whose shingle sets are 80 % alike.

Two sets link when ``100 * intersection >= 80 * union``. The search is exact:

1. Every set keeps its ``head``: its smallest ``d + k`` hashes, where ``d`` is the
   number of its shingles that a partner may lack. Of two linked sets, the heads share
   at least ``k`` hashes, ``k`` of the set whose head ends first.
2. The document frequency of each head token is counted over the distinct sets. A set
   with too few shared head tokens has no partner and goes no further.
3. Heads are ordered by frequency, rarest first, and cut to a prefix, whose tokens are
   index keys.
4. Sets that share a key, directly or through others, form a candidate group. A group
   too large for one block is searched again with whole sets for heads, whose prefixes
   are shorter against their length. In these, rare tokens are keys of their own, while
   frequent tokens fall into classes by a hash, and pairs of tokens of one class are
   keys. A class yields no key from its first token, so the prefix is extended by one
   token for each class it meets: two linked sets then share a single rare token or a
   token pair. The number of classes follows the set's size, in steps of 5/4, so a
   set has keys in its own step and the next.
5. Groups are then packed into blocks of bounded size; full sets meet
   inside a block and all pairs are verified there by one matrix product; only a
   spanning forest of the links leaves it. In groups of several blocks the member with
   most links is then compared with all blocks, and what is still outside the group's
   largest component with every member of the other blocks. No pair is emitted that is
   not a link of the forest.

Defined cases: a null text or one without words has an empty set, n_shingles 0, and is
its own component; texts with equal sets are one class, whatever their ids, and share
their component. A component is named by its smallest id (null only if all its rows have
none); a row without an id and without words has a null component. Repeated rows come
back as often as they occur. Extra columns are ignored; an empty table gives no rows.
Texts are read whole. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import common_counts, verified_links
from .common import mix64, text_slices, written
from .graph import TASK_LINKS, connected, forest
from .near_dup import shingle_sets

#: A link needs LEAST / OF of the union in common.
LEAST, OF = 80, 100
SHINGLE = 5
#: Tokens in more distinct sets than this are frequent: indexed in pairs, not alone.
RARE = 64


def needed(n: int) -> int:
    """Shingles that a set of n has in common with any partner, at least."""
    return -(-LEAST * n // OF)


def surplus(n: int) -> int:
    """k: head tokens that a set of n is sure to share, if its head ends first."""
    return (n - needed(n)) // 4 + 1


def head_length(n: int) -> int:
    return min(n, n - needed(n) + surplus(n)) if n else 0


def head_overlap(n: int) -> int:
    """Head tokens that a set of n shares with any partner, at least."""
    return surplus(needed(n))


def _size_steps(limit: int = 1 << 40) -> list[int]:
    """Smallest size of each step: a partner is at most one step away."""
    steps = [1]
    while steps[-1] < limit:
        steps.append(steps[-1] * OF // LEAST + 1)
    return steps


_STEPS = _size_steps()


def size_step(n: int) -> int:
    return int(np.searchsorted(_STEPS, n, side="right")) - 1


def token_classes(step: int) -> int:
    """Classes of frequent tokens in a step, a quarter of what its smallest set is sure to share."""
    return needed(_STEPS[max(step - 1, 0)]) // 4


def keys(tokens: np.ndarray, frequency: np.ndarray, n: int, whole: bool = False) -> np.ndarray:
    """Index keys of a set of n shingles, given the head tokens that other sets share
    (``whole``: the head is the whole set, and frequent tokens are paired)."""
    head, overlap = (n, needed(n)) if whole else (head_length(n), head_overlap(n))
    # Tokens of the rarest-first prefix that must give a key or be lacking in a partner.
    budget = head - overlap + 1 - (head - len(tokens))
    if budget <= 0:
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, frequency))
    tokens, rare = tokens[order], (frequency <= RARE)[order]
    if not whole or rare[:budget].all():
        return np.sort(tokens[:budget])
    out = []
    step = size_step(n)
    for s in (step, step + 1):
        classes = token_classes(s)
        if not classes:  # too small a set: frequent tokens are keys of their own, too
            out.append(tokens[:budget])
            continue
        group = np.where(rare, -1, (mix64(tokens) % np.uint64(classes)).astype(np.int64))
        gain = np.ones(len(tokens), np.int64)
        _, first = np.unique(group, return_index=True)
        gain[first[group[first] >= 0]] = 0
        cut = int(np.searchsorted(np.cumsum(gain), budget)) + 1
        out.append(tokens[:cut][rare[:cut]])
        often, group = tokens[:cut][~rare[:cut]], group[:cut][~rare[:cut]]
        order = np.lexsort((often, group))
        often, group = often[order], group[order]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else []
        for a, b in zip(starts, [*starts[1:], len(group)]):
            i, j = np.triu_indices(b - a, 1)
            out.append(mix64(mix64(often[a + i] + np.uint64(s + 1)) * np.uint64(0x9E3779B97F4A7C15) + often[a + j]))
    return np.unique(np.concatenate(out))


def row_key() -> Column:
    """Digest of a row's id and text: rows that share it are exact repeats."""
    named = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("none"))
    return F.unhex(F.md5(F.concat(named, F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary")))


def heads(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row key, n_shingles, the set's id (null: empty) and its packed head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, offsets, data in text_slices(batch.column(2)):
                sizes, ids, packed = [], [], []
                for s in shingle_sets(offsets, data, shingle):
                    sizes.append(len(s))
                    ids.append(int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                               if len(s) else None)
                    packed.append(s[:head_length(len(s))].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(packed, pa.binary())],
                    ["doc_id", "row_key", "n_shingles", "id", "head"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("row_key"), "text").mapInArrow(
        run, "doc_id bigint, row_key binary, n_shingles bigint, id bigint, head binary")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, id) of every head token."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            packed = part.column(1).to_pylist()
            flat = np.frombuffer(b"".join(packed), np.int64)
            ids = np.repeat(np.asarray(part.column(0)), [len(p) // 8 for p in packed])
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], ["token", "id"])


def _keyed(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """(key, id, lacking): index keys of each set, and its share of tokens nobody shares."""
    for batch in batches:
        for id_, n, shared in zip(*(batch.column(i) for i in range(3))):
            token, often = (np.asarray(x) for x in shared.values.flatten())
            n = n.as_py()
            found = keys(token.view(np.uint64), often, n, whole)
            head = n if whole else head_length(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(np.full(len(found), id_.as_py(), np.int64)),
                 pa.array(np.full(len(found), (head - len(token)) / head))], ["key", "id", "lacking"])


def _packed_sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, offsets, data in text_slices(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo),
                 pa.array([s.tobytes() for s in shingle_sets(offsets, data, shingle)], pa.binary())], ["id", "set"])


def linked(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which pairs of two lists of sets reach the threshold."""
    both = common_counts(left, right).astype(np.int64)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right]) - both
    return OF * both >= LEAST * union


def candidate_stars(sets: DataFrame, whole: bool = False) -> DataFrame:
    """(a, b): indexed sets b with the leader a of a key's sets, as many as connect whatever
    shares keys; a set leads where it has the fewest tokens that nobody shares.

    ``sets`` holds id, n_shingles and head of each distinct set (``whole``: all of it).
    """
    tokens = sets.select("id", "head").mapInArrow(_tokens, "token bigint, id bigint")
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    per_set = (tokens.join(shared, "token").groupBy("id")
               .agg(F.collect_list(F.struct("token", "often")).alias("shared")))
    found = written(per_set.join(sets.select("id", "n_shingles"), "id").select("id", "n_shingles", "shared")
                    .mapInArrow(lambda batches: _keyed(batches, whole), "key bigint, id bigint, lacking double"),
                    "join-keys")
    lead = (found.groupBy("key").agg(F.min(F.struct("lacking", "id")).alias("lead"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("key", F.col("lead.id").alias("a")))
    stars = found.join(lead, "key").where("a <> id").select("a", F.col("id").alias("b"))
    # As many tasks as keep their part of the keys in bounds: a set is in every task's forest.
    return written(forest(stars.coalesce(found.count() // TASK_LINKS + 1)), "join-stars")


def jaccard_groups(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (the smallest id with an equal set),
    one row per row of ``docs``."""
    base = written(heads(docs, shingle).withColumn("row", F.monotonically_increasing_id()), "join-heads")
    known = base.where("id is not null")
    classes = written(known.groupBy("id").agg(F.min("doc_id").alias("class_id"), F.min("row").alias("row")),
                      "join-classes")
    sets = known.join(classes.select("row"), "row")  # one row of each distinct set
    stars = candidate_stars(sets)
    ids = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = written(sets.select("id", "row_key", "n_shingles").join(ids, "id"), "join-wanted")
    # Exact repeats of a row have one key: one of them is read.
    texts = (docs.select(row_key().alias("row_key"), "text").join(wanted.select("id", "row_key"), "row_key")
             .dropDuplicates(["id"]).select("id", "text"))
    links = verified_links(
        wanted.select("id", "n_shingles"), stars, linked,
        lambda ids: texts.join(ids, "id").select("id", "text").mapInArrow(
            lambda batches: _packed_sets(batches, shingle), "id bigint, set binary"),
        lambda sets: candidate_stars(sets.withColumnRenamed("set", "head"), whole=True))
    labels = connected(links)
    classes = classes.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    top = classes.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    classes = written(classes.join(top, "comp").select("id", "class_id", "component_id"), "join-classes")
    found = known.join(classes, "id").select("doc_id", "n_shingles", "component_id", "class_id")
    alone = F.col("doc_id")
    return found.unionByName(base.where("id is null").select(
        "doc_id", "n_shingles", alone.alias("component_id"), alone.alias("class_id")))
