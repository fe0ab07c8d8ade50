"""Benchmark decontamination by pigeonhole edit matching.

An item of length L gets an error budget ``k = floor(rate * L)`` and is cut into
``k + 1`` pieces. An occurrence with at most k edits leaves at least one piece
untouched, so every occurrence lies around an exact piece hit. Piece hits come from
one Aho-Corasick pass over each text; around each hit the item is verified with
Myers' bit-parallel distance (one Python integer per column).

Texts and items are compared in a normal form: A-Z and Latin-1 capitals folded,
ASCII signs and white space as one space, UTF-8 bytes otherwise as they are.
Distances count bytes of that form.

The benchmark is the stated query set: it is searched against all documents in
blocks of bounded size (BLOCK_BYTES), each shipped to the tasks whole.

Items shorter than MIN_ITEM bytes are searched in the same way with a space on either
side, that is as whole words; items of a single word match only a text that equals
them, for words alone are no evidence.

Defined cases: null or empty texts match nothing, null or empty items are skipped;
repeated rows and ids are reported row by row; extra columns are ignored; an empty
table on either side gives no matches (and drops no document). ``clean`` judges every
row by its own text, whatever its id, and returns its columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, unused, written

RATE = 0.06
MIN_ITEM = 24
#: Bytes of benchmark text in one pass over the documents.
BLOCK_BYTES = 8 << 20

_FOUND = "item_id bigint, distance int, budget int, start bigint, end bigint"

_FOLD = np.full(256, 0x20, dtype=np.uint8)
for _lo, _hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _FOLD[_lo:_hi] = np.arange(_lo, _hi)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def _normal(offsets: np.ndarray, data: np.ndarray):
    """Normal form of a slice of texts: (offsets, latin-1 string of all bytes)."""
    n = len(data)
    out = _FOLD[data]
    capital = np.zeros(n, dtype=bool)
    # Capitals of Latin-1 are C3 80..9E (97 is the multiplication sign).
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[capital] += 0x20
    space = out == 0x20
    keep = np.ones(n, dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    begins = offsets[:-1][np.diff(offsets) > 0]
    keep[begins] = ~space[begins]  # no space at a text's start
    # A space that a start dropped may be followed by more of its run: those are
    # dropped already, being second in a run.
    place = np.concatenate(([0], np.cumsum(keep)))
    return place[offsets], out[keep].tobytes().decode("latin-1")


def normalise(text: str | None) -> str:
    """Normal form of one text, as a string of its bytes."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    if not len(raw):
        return ""
    _, out = _normal(np.array([0, len(raw)]), raw)
    return out.rstrip(" ")


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, text) of the budget + 1 pieces, of even length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """Best (distance, end) of the pattern against any part of the text, or None.

    Myers' bit-vector algorithm with the search boundary condition (a match may
    begin anywhere); ties go to the leftmost end.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        if mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Matcher:
    """A block of items, ready to be searched for in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, min_item: int = MIN_ITEM):
        import ahocorasick
        self.items, self.whole = [], {}
        # Pieces of long items, and of short ones with a space on either side.
        found: tuple[dict, dict] = {}, {}
        for item_id, text in items:
            form = normalise(text)
            if not form:
                continue
            if len(form) < min_item and " " not in form:
                self.whole.setdefault(form, []).append(item_id)
                continue
            budget, short = int(rate * len(form)), len(form) < min_item
            form = f" {form} " if short else form
            for offset, piece in pieces(form, budget):
                found[short].setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, form, budget))
        self.automata = []
        for part in found:
            automaton = ahocorasick.Automaton()
            for piece, uses in part.items():
                automaton.add_word(piece, (len(piece), uses))
            if part:
                automaton.make_automaton()
            self.automata.append(automaton if part else None)

    def search(self, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """(item_id, distance, budget, start, end) of the best match of each item.

        ``start`` is where the best match begins at the latest found by aligning
        backwards from its end.
        """
        if self.whole:
            for item_id in self.whole.get(text.rstrip(" "), ()):
                yield item_id, 0, 0, 0, len(text.rstrip(" "))
        long, short = self.automata
        if long is not None:
            yield from self._search(long, text)
        if short is not None:
            for item_id, distance, budget, start, end in self._search(short, f" {text} "):
                yield item_id, distance, budget, start, min(max(end - 2, start), len(text))

    def _search(self, automaton, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        spans: dict[int, list[tuple[int, int]]] = {}
        for last, (size, uses) in automaton.iter(text):
            for item, offset in uses:
                _, form, budget = self.items[item]
                begin = last - size + 1 - offset
                spans.setdefault(item, []).append((begin - budget, begin + len(form) + budget))
        for item, windows in spans.items():
            item_id, form, budget = self.items[item]
            best, done = None, -1
            for a, b in sorted(windows):
                a, b = max(a, 0), min(b, len(text))
                if b <= done:
                    continue
                done = b
                at = text.find(form, a, b)
                hit = (0, at + len(form)) if at >= 0 else None
                if hit is None:
                    near = myers(form, text[a:b], budget)
                    hit = near and (near[0], a + near[1])
                if hit and (best is None or hit < best):
                    best = hit
                if best and not best[0]:
                    break
            if best:
                distance, end = best
                low = max(0, end - len(form) - budget)
                back = myers(form[::-1], text[low:end][::-1], distance)
                yield item_id, distance, budget, end - back[1], end


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes``; the driver holds one at a time."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        rows = [tuple(r) for r in part.collect()]
        if rows:
            yield rows


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_item: int = MIN_ITEM,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item that it holds within the item's budget.

    doc_id, item_id, distance, budget, and the place in the text's normal form.
    """
    return _matched(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), pa.int64(), "doc_id bigint",
                    benchmark, rate, min_item, block_bytes)


def _matched(narrow: DataFrame, id_type: pa.DataType, id_field: str, benchmark: DataFrame, rate: float = RATE,
             min_item: int = MIN_ITEM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Matches of (id, text) rows, whatever the id is."""
    schema = f"{id_field}, {_FOUND}"

    def search(items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, rate, min_item)
            names = [f.split(" ")[0] for f in schema.split(", ")]
            kinds = [id_type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            for batch in batches:
                ids = batch.column(0)
                rows = []
                for lo, hi, offsets, data in text_slices(batch.column(1)):
                    if not len(data):
                        continue
                    places, form = _normal(offsets, data)
                    for i in range(lo, hi):
                        text = form[places[i - lo]:places[i - lo + 1]]
                        rows += [(ids[i].as_py(), *m) for m in matcher.search(text)]
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], names)
        return narrow.mapInArrow(run, schema)

    out = None
    for items in _blocks(benchmark, block_bytes):
        part = search(items)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else narrow.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that hold no benchmark item, all columns kept."""
    name = unused(docs, "dirty")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    texts = docs.select(digest.alias("key"), "text")
    dirty = written(_matched(texts, pa.binary(), "key binary", benchmark, **options).select("key").distinct(), "leaks")
    return docs.join(dirty.withColumnRenamed("key", name), digest == F.col(name), "left_anti")
