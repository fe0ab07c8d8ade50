"""Conversation repair, lexical search and the Jaccard join against brute-force versions."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from jornada.llm import conversation_repair as repair
from jornada.llm import blocks, graph, near_dup
from jornada.llm import jaccard_join as join
from jornada.llm import lexical_search as search
from jornada.llm import queries
from jornada.llm.common import table

SF = "/root/testdata/sf0.001"


# ---- conversation structure repair ----------------------------------------------

def plain_damage(rows):
    """Damaged rows of each original conversation, in order (turn, role, digest of the text)."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        kept += [(turn, role, text)] * (2 if hit == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen
                   else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Least (cost, audit) by uniform-cost search over (rows used, role letters so far)."""
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        if at == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(lines)
        # The least (cost, audit) of a state is final: audits of a state grow by equal letters.
        done.add((at, last))
        wanted = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        steps = [("I", 5, at, wanted[0], lines + (wanted + ":",))]
        if at < len(rows):
            _, role, text = rows[at]
            steps.append(("D", 2, at + 1, last, lines))
            if faults[at] in ("", "truncated"):
                more = 5 if faults[at] else 0
                if role[:1] and role[:1] in allowed[last]:
                    steps.append(("K", more, at + 1, role[:1], lines + (f"{role}:{text}",)))
                steps.append(("R", 1 + more, at + 1, wanted[0], lines + (f"{wanted}:{text}",)))
        for letter, paid, *state in steps:
            heapq.heappush(heap, (cost + paid, audit + letter, *state))
    raise AssertionError("no repair")


def plain_result(rows):
    out = {}
    for conv, kept in plain_damage(rows).items():
        turns = {r[0] for r in kept if r[0] is not None}
        faults = plain_faults(kept)
        letters = [r[1][:1] for r in kept]
        illegal = sum(p + q not in ("su", "ua", "au") for p, q in zip(letters, letters[1:]))
        cost, audit, text = plain_repair(kept, faults) if kept else (0, "", "")
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def repaired(rows):
    frame = repair.repair_conversations(rows, repair.damage(rows))
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def test_repair_equals_search_on_the_table(spark):
    rows = table(spark, SF, "conversations")
    assert {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, SF).collect()} == plain_result(
        [(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])


def test_repair_of_odd_rows(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "User", "ulf"]),
             rng.choice(["Yes.", "no", " ", "", None, "a ! ", "Why?\n", "Yes. "]))
            for c in [*range(150), None] for t in rng.sample([None, *range(-3, 12)], rng.randint(1, 8))]
    rows += [(1000, t, "user", "again.") for t in range(300)] + [(1001, None, "user", "x.")] * 40
    frame = spark.createDataFrame([(*r, "extra") for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, kind string")
    assert repaired(frame) == plain_result(rows)


def test_repair_of_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.repair_conversations(empty, repair.damage(empty)).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(dropped, 0, "user", "hi.")], empty.schema)
    assert repaired(rows) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_long_runs_by_powers():
    """A million equal rows: the powers give the cost and the audit that steps give."""
    for symbol in range(16):
        costs = repair.END
        for _ in range(300):
            costs = repair.advance(symbol, 1, costs)
        assert repair.advance(symbol, 300, repair.END) == costs
    cost, audit = repair.repair([(4 * 1 + repair.DUPLICATE, 1_000_000)])
    assert (cost, audit) == (2_000_000, "D" * 1_000_000)
    rng = random.Random(2)
    for _ in range(300):
        symbols = [rng.choice([0, 1, 4, 5, 6, 8, 9, 11, 12, 13]) for _ in range(rng.randint(1, 9))]
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        faults = ["", "truncated", "blank", "duplicate"]
        rows = [(i, ["system", "user", "assistant", "tool"][s // 4], "t") for i, s in enumerate(symbols)]
        assert repair.repair(runs) == plain_repair(rows, [faults[s % 4] for s in symbols])[:2]


# ---- ranked lexical search -------------------------------------------------------

def plain_search(docs, items, top=20):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or ""))
    words = [(i, split(t)) for i, t in docs]
    words = [(i, len(w), Counter(w)) for i, w in words if w]
    number, length = len(words), sum(n for _, n, _ in words)
    df = Counter(t for _, _, w in words for t in w)
    out = []
    for item, text in items:
        scores = []
        for doc, n, w in words:
            m = 75 + 25 * n * number // length
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * w[t] // (1000 * w[t] + 12 * m)) for t in split(text) if t in w)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


DOCS = [(1, "The cat, the Dog!"), (2, "cat-dog cat"), (3, None), (4, ""), (5, "... !"), (None, "dog Été été"),
        (7, "CAT"), (7, "CAT"), (8, "concatenate dogs"), (9, "x" * 50_000 + " cat"), (10, "cafés cat dog")]
ITEMS = [(1, "cat cat DOG"), (2, "été café"), (3, None), (4, "?!"), (None, "the"), (1, "dogs")]


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_search_equals_plain(spark, monkeypatch, cells):
    monkeypatch.setattr(search, "CELLS", cells)
    docs = spark.createDataFrame([(*d, 1.5) for d in DOCS], "doc_id bigint, text string, score double")
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id bigint, text string, rank string")
    found = search.search(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(DOCS, ITEMS)
    assert sorted(map(tuple, search.search(docs, items, 2).collect()), key=str) == plain_search(DOCS, ITEMS, 2)


def test_search_in_several_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 20)
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert sorted(map(tuple, search.search(docs, items).collect()), key=str) == plain_search(DOCS, ITEMS)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert search.search(docs, items).collect() == []
    assert search.search(docs, spark.createDataFrame(ITEMS, items.schema)).collect() == []
    assert search.search(spark.createDataFrame(DOCS, docs.schema), items).collect() == []


# ---- N-gram Jaccard join ---------------------------------------------------------

def shingles(text, size=join.SHINGLE):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_groups(rows, size=join.SHINGLE):
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if sets[i] and sets[j] and 100 * both >= 80 * all_ and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, rows):
        least[g] = min((x for x in (least.get(g), doc) if x is not None), default=None)
    return sorted(((doc, len(s), least[g]) for (doc, _), s, g in zip(rows, sets, group)), key=str)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def groups_of(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, id int")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.jaccard_groups(frame, **kw).collect()), key=str)


def test_join_equals_all_pairs(spark):
    rng = random.Random(3)
    line = "one line that very many of these documents have in common with each other"
    texts = [f"{line} " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(1, 80))) for _ in range(60)]
    for n in (9, 40, 130):
        base = [f"b{rng.randrange(10 ** 6)}" for _ in range(n)]
        texts += near_copies(rng, base, 40, max(1, n // 30)) + [" ".join(base[:-k]) for k in range(1, n // 5)]
    texts += ["a b c d e f g h", "A B  c d e f g\nh", "a b", "b a", "a b", "x", None, "", " \n", "q " * 30_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, "another text of the same id"), (None, texts[70]), (None, None)]
    assert groups_of(spark, rows) == plain_groups(rows)


def test_join_in_many_blocks(spark, monkeypatch):
    """A group of copies of copies, spread over blocks that only some links connect."""
    monkeypatch.setattr(blocks, "BLOCK_SETS", 8)
    rng = random.Random(4)
    texts, words = [], [f"c{i}" for i in range(60)]
    for i in range(90):
        words = list(words)
        words[rng.randrange(60)] = f"n{i}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts + near_copies(rng, words, 60, 2)))
    assert groups_of(spark, rows) == plain_groups(rows)


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """Copies of copies for SetSketch: blocks of 8, and rows in proportion to the documents."""
    monkeypatch.setattr(blocks, "BLOCK_SETS", 8)
    made = []
    for module in (near_dup, blocks, graph):
        def counted(df, label, real=module.written):
            out = real(df, label)
            made.append((label, out.count()))
            return out
        monkeypatch.setattr(module, "written", counted)
    rng = random.Random(4)
    texts, words = [], [f"c{i}" for i in range(60)]
    for i in range(90):
        words = list(words)
        words[rng.randrange(60)] = f"n{i}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts + near_copies(rng, words, 110, 8)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_groups(rows, 2)
    most = {"near-keys": max(near_dup.BANDS, near_dup.DRAWS)}
    assert {"block-outside", "near-keys"} <= {label for label, _ in made}
    assert all(n <= most.get(label, 4) * len(rows) for label, n in made), made


def test_likely_pairs_are_those_of_the_estimate():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[k:], rng.integers(0, 1 << 63, k).astype(np.uint64))))
            for k in range(0, 200, 8)] + [base[:340], base[:300]]
    regs = np.stack([near_dup.registers(s) for s in sets])
    n = np.array([len(s) for s in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets)), indexing="ij"))
    fits = 100 * np.minimum(n[a], n[b]) >= 80 * np.maximum(n[a], n[b])
    least = near_dup.MIN_ESTIMATE
    want = fits & (near_dup.estimate(regs[a], regs[b], n[a], n[b]) >= least - 1e-9)
    assert (near_dup.likely(regs, regs, n, n).ravel() == want).all() and 0 < want.sum() < fits.sum()


def test_join_of_other_shingles_and_no_rows(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f g"), (3, "f e d c b a")]
    assert groups_of(spark, rows, shingle=2) == plain_groups(rows, 2)
    assert groups_of(spark, []) == []


def test_linked_sets_share_a_key():
    """Prefixes of singles and pairs: every pair of linked sets shares a key, whatever the
    frequencies of their tokens; frequent tokens give pairs, rare ones single keys."""
    rng = np.random.default_rng(1)
    for n in [*range(4, 60), 100, 333, 1000]:
        for rare in (0.0, 0.5, 1.0):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            gone = rng.integers(0, max(1, len(x) // 10) + 1)
            y = np.unique(np.concatenate((rng.permutation(x)[gone:],
                                          rng.integers(0, 1 << 63, gone).astype(np.uint64))))
            if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
                continue
            for whole in (False, True):
                heads = [s[:len(s) if whole else join.head_length(len(s))] for s in (x, y)]
                often = {int(t): (2 if rng.random() < rare else int(rng.integers(2, 5000)))
                         for t in np.intersect1d(*heads)}
                found = []
                for s, head in zip((x, y), heads):
                    shared = np.array([t for t in head if int(t) in often], np.uint64)
                    found.append(join.keys(shared, np.array([often[int(t)] for t in shared], np.int64), len(s), whole))
                assert len(np.intersect1d(*found)), (n, rare, whole)


def test_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, 25).astype(np.uint64)) for _ in range(60)]
    exact = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert (blocks.common_counts(sets, sets) == exact).all()
    assert (blocks.common_counts(sets[:7], sets[5:]) == exact[:7, 5:]).all()
    adjacent = exact >= 19
    forest = blocks.spanning_forest(adjacent)
    assert all(adjacent[a, b] for a, b in forest) and len(forest) < len(sets)
    reach = [np.eye(len(sets), dtype=bool), np.eye(len(sets), dtype=bool)]
    reach[0] |= adjacent
    for a, b in forest:
        reach[1][a, b] = reach[1][b, a] = True
    for r in reach:
        for _ in range(7):
            r |= (r.astype(int) @ r.astype(int)) > 0
    assert (reach[0] == reach[1]).all()


@pytest.mark.parametrize("task_links", [7, 500_000])
def test_components_of_chains_rings_and_stars(spark, monkeypatch, task_links):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(300)]
    ring = [(1000 + i, 1000 + (i + 1) % 50) for i in range(50)]
    star = [(2000, 2000 + i) for i in range(1, 60)]
    rest = [(rng.randint(3000, 3200), rng.randint(3000, 3200)) for _ in range(90)]
    links = [rng.choice([(a, b), (b, a)]) for a, b in chain + ring + star + rest + star[:9]]
    rng.shuffle(links)
    above = {}

    def top(x):
        return x if above.get(x, x) == x else top(above[x])

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        above.setdefault(p, p)
        above[q] = p
    monkeypatch.setattr(graph, "TASK_LINKS", task_links)
    df = spark.createDataFrame(links, "a bigint, b bigint").repartition(6)
    got = {r.id: r.comp for r in graph.connected(df).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}
    assert graph.connected(df.limit(0)).count() == 0
