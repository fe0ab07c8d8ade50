"""Links of candidate groups, found in blocks of bounded size.

Members of a group meet inside a block, and only a spanning forest of their links leaves
it. In groups of several blocks the member with most links is then compared with all
blocks, and what is still outside the group's largest component with every member of the
other blocks. No row is made for a pair that is not a link of a forest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import connected

#: A block of a candidate group holds about so many shingles and sets.
BLOCK_SHINGLES, BLOCK_SETS = 400_000, 2048
#: Columns of one matrix product.
COLUMNS = 4096
#: Which pairs of two lists of packed sets are links.
Linked = Callable[[list[np.ndarray], list[np.ndarray]], np.ndarray]


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of two lists of sorted sets."""
    out = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sides.append((token, np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    if left is right:
        both, times = np.unique(sides[0][0], return_counts=True)
        both = both[times > 1]
        out[np.arange(len(left)), np.arange(len(left))] = [len(s) for s in left]
    else:
        both = np.intersect1d(*(np.unique(token) for token, _ in sides), assume_unique=True)
    if not len(both):
        return out
    placed = []
    for token, row in sides:
        col = np.searchsorted(both, token)
        col[col == len(both)] = 0
        hit = both[col] == token
        order = np.argsort(col[hit], kind="stable")
        placed.append((col[hit][order], row[hit][order]))
    total = np.zeros_like(out)
    for at in range(0, len(both), COLUMNS):
        dense = []
        for (col, row), sets in zip(placed, (left, right)):
            a, b = np.searchsorted(col, (at, at + COLUMNS))
            x = np.zeros((len(sets), min(COLUMNS, len(both) - at)), np.float32)
            x[row[a:b], col[a:b] - at] = 1
            dense.append(x)
        total += dense[0] @ dense[1].T
    return np.maximum(out, total)


def spanning_forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """(parent, child) links that connect whatever the adjacency matrix connects."""
    out, seen = [], np.zeros(len(adjacent), bool)
    degree = adjacent.sum(axis=1)
    for root in np.argsort(-degree, kind="stable"):
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            reach = adjacent[front] & ~seen
            new = np.flatnonzero(reach.any(axis=0))
            out += zip(front[reach[:, new].argmax(axis=0)].tolist(), new.tolist())
            seen[new] = True
            front = new
    return out


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


_LINK = "a bigint, b bigint, links bigint"


def _links(a, b, links) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, links)], ["a", "b", "links"])


def _within(batches: Iterator[pa.RecordBatch], linked: Linked) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links inside each row's block; ``links`` counts those of a."""
    for batch in batches:
        for members in batch.column(0):
            ids, sets = members.values.flatten()[:2]
            ids, sets = np.asarray(ids), _sets(sets)
            adjacent = linked(sets, sets)
            np.fill_diagonal(adjacent, False)
            degree = adjacent.sum(axis=1)
            found = spanning_forest(adjacent)
            a, b = ([p for p, _ in found], [c for _, c in found])
            yield _links(ids[a] if a else [], ids[b] if b else [], degree[a] if a else [])


def _between(batches: Iterator[pa.RecordBatch], linked: Linked) -> Iterator[pa.RecordBatch]:
    """Links between each row's two lists of (id, comp, set), a forest over their components."""
    for batch in batches:
        for own, others in zip(batch.column(0), batch.column(1)):
            (ia, ca, sa), (ib, cb, sb) = ([np.asarray(x) if i < 2 else _sets(x) for i, x in
                                           enumerate(side.values.flatten()[:3])] for side in (own, others))
            row, col = np.nonzero(linked(sa, sb) & (ca[:, None] != cb))
            if not len(row):
                continue
            pairs = np.sort(np.stack((ca[row], cb[col])), axis=0)
            pairs, at = np.unique(pairs, axis=1, return_index=True)
            above: dict[int, int] = {}

            def top(c):
                while c in above:
                    c = above[c]
                return c

            a, b = [], []
            for p, q, i in zip(*pairs.tolist(), at.tolist()):
                p, q = top(p), top(q)
                if p != q:
                    above[q] = p
                    a.append(int(ia[row[i]]))
                    b.append(int(ib[col[i]]))
            yield _links(a, b, [0] * len(a))


def verified_links(sizes: DataFrame, stars: DataFrame, linked: Linked, full: Callable[[DataFrame], DataFrame],
                   again: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b) links that connect the members of each candidate group as all its links would.

    ``sizes`` holds (id, n_shingles) of what may be in a group and ``stars`` the pairs
    that make the groups; ``full`` gives (id, set) of the ids it is given; ``again`` gives
    finer stars of the sets (id, set, n_shingles) of groups too large for one block.
    """
    def packed(members: DataFrame) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("own")
        return (members.groupBy("grp", "blocks", own)
                .agg(F.collect_list(F.struct("id", "set")).alias("members")))

    def within(blocks: DataFrame) -> DataFrame:
        return written(blocks.where(F.size("members") > 1).select("members")
                       .mapInArrow(lambda batches: _within(batches, linked), _LINK), "block-links")

    groups = _with_blocks(connected(stars), sizes)
    small, large = groups.where("blocks = 1"), groups.where("blocks > 1")
    links = within(packed(full(small.select("id")).join(small, "id")))
    if large.isEmpty():
        return links.select("a", "b")
    sets = written(full(large.select("id")).join(sizes, "id"), "block-sets")
    blocks = written(packed(sets.join(_with_blocks(connected(again(sets)), sizes), "id")), "blocks")
    found = within(blocks)
    links = links.select("a", "b").unionByName(found.select("a", "b"))
    several = blocks.where("blocks > 1")
    return links if several.isEmpty() else links.unionByName(_across_blocks(several, found, linked))


def _with_blocks(labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """id, grp and the number of blocks of the group."""
    groups = labels.withColumnRenamed("comp", "grp")
    blocks = groups.join(sizes, "id").groupBy("grp").agg(
        F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).alias("blocks"))
    return written(groups.join(blocks, "grp"), "block-groups")


def _across_blocks(large: DataFrame, links: DataFrame, linked: Linked) -> DataFrame:
    """Links between the blocks of each group."""
    members = large.select("grp", "own", F.inline("members"))
    comps = _with_components(members.select("grp", "own", "id"), links)
    # The member with most links is compared with all blocks.
    to_all = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("own")
    blocks = large.groupBy("grp").agg(F.first("blocks").alias("blocks"))
    most = links.groupBy(F.col("a").alias("id")).agg(F.max("links").alias("links"))
    centre = (comps.join(most, "id").groupBy("grp")
              .agg(F.max_by(F.struct("id", "comp"), F.struct("links", "id")).alias("c")).select("grp", "c.id", "c.comp"))
    centre = (members.select("id", "set").join(centre, "id").join(blocks, "grp")
              .select("grp", F.array(F.struct("id", "comp", "set")).alias("others"), to_all))
    found = written(_repacked(members, comps).join(centre, ["grp", "own"]).select("members", "others")
                    .mapInArrow(lambda batches: _between(batches, linked), _LINK), "block-links")
    links = links.unionByName(found)
    comps = _with_components(comps.select("grp", "own", "id"), links)
    # What is outside a group's largest component meets every member of the other blocks.
    sizes = comps.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("grp").agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"),
                                       F.count(F.lit(1)).alias("n_comps")).where("n_comps > 1")
    comps = written(comps.join(largest, "grp").withColumn("outside", F.col("comp") != F.col("largest")), "block-outside")
    outside = (_repacked(members, comps.where("outside")).join(blocks, "grp")
               .select("grp", F.col("own").alias("from"), F.col("members").alias("others"), "blocks")
               .select("grp", "from", "others", to_all).where(F.col("own") != F.col("from")))
    rest = (_repacked(members, comps).join(outside, ["grp", "own"]).select("others", "members")
            .mapInArrow(lambda batches: _between(batches, linked), _LINK))
    return found.select("a", "b").unionByName(written(rest, "block-links").select("a", "b"))


def _with_components(ids: DataFrame, links: DataFrame) -> DataFrame:
    labels = connected(links)
    return written(ids.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "block-comps")


def _repacked(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The blocks again, of the members in ``comps`` and with their components."""
    return (members.select("id", "set").join(comps.select("grp", "own", "id", "comp"), "id").groupBy("grp", "own")
            .agg(F.collect_list(F.struct("id", "comp", "set")).alias("members")))
