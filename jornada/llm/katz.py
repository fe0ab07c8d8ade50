"""Katz back-off language model over word pairs, learnt and evaluated on Spark.

``P(w | h) = d(c) * c(h, w) / c(h)`` for a pair seen in training, otherwise
``alpha(h) * P(w)``: counts up to K are discounted by Good-Turing, and ``alpha(h)`` is
exactly the mass that the discounts of h free, over the unigram mass of the words not
seen after h, so the probabilities after every h add up to 1. Unigrams are discounted
the same way; what they free is the probability of any unknown word.

The work goes by blocks of documents and buckets of keys, all of them tables in the
shared folder or shuffles between them:

1. Documents are packed into blocks of about BLOCK_BYTES of text.
2. Each block lists its distinct words and pairs (64-bit hashes, sorted, as packed
   differences) with their training counts, cut into buckets of the hash range; it has
   rows for the buckets that it has keys of, and no others.
3. Each bucket adds the counts up over the blocks and answers every block in the order
   it asked: the corpus count of each key, and whether this block speaks for it. A word
   or pair that makes up a third of all tokens is one entry per block; hash ranges
   even out the buckets, whose number follows the amount of text.
4. Each block scores its documents with the answers. For the pairs it speaks for it
   gives their share of c(h), of the kept mass and of the unigram mass after h; a sum
   over h makes the table of contexts. Terms in ``alpha(h)`` are handed on per
   document (its block and place there) and h, joined with that table (AQE splits what
   is skewed) and added.

Defined cases: a null or empty text is the end token alone; repeated rows and rows
without an id count and score each on their own; without training rows every token has probability 1 (score
0); empty tables give no rows; extra columns are ignored. A text longer than a block
is a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, text_slices, word_hashes, written

#: Counts above K are not discounted.
K = 5
END = np.uint64(0x9D5C0FB1A7E3D241)
START = np.uint64(0x5A17B20C4F9E8863)
#: Bytes of text in a block, and about so many bytes of text to a bucket of keys.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20

_DOCS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.large_string())])
_BLOCKS = "block bigint, size bigint, training bigint, docs binary"
_ASKED = "bucket int, block bigint, pairs binary, pair_n binary, words binary, word_n binary"
_ANSWERS = "block bigint, bucket int, pairs binary, words binary, stats array<bigint>"
_SCORED = ("kind int, block bigint, place int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
           "base_score double, score double, prev bigint, total bigint, kept double, p double")
_SCORED_PA = pa.schema([
    ("kind", pa.int32()), ("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ("prev", pa.int64()), ("total", pa.int64()), ("kept", pa.float64()), ("p", pa.float64())])
#: Kinds of rows that a scored block gives: a document's sums, a context's sums, and a
#: document's tokens whose factor is the context's alpha or its scale.
DOCUMENT, CONTEXT, ALPHA, SCALE = range(4)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as differences of as many bytes as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys)
    width = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    body = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + body.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    body = np.frombuffer(data, np.uint8, offset=9)
    n = len(body) // width if width else 0
    steps = np.zeros((n + 1, 8), np.uint8)
    steps[1:, :width] = body.reshape(n, width)
    steps = steps.view("<u8").reshape(-1).astype(np.uint64)
    steps[0] = int.from_bytes(data[1:9], "little")
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts in the narrowest of 1, 2, 4 or 8 bytes each, deflated."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + zlib.compress(values.astype(f"<u{width}").tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


def _packed_docs(parts: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for part in parts:
            out.write_batch(part)
    return sink.getvalue().to_pybytes()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, held_out, text) as packed blocks."""
    task = TaskContext.get().partitionId() << 32
    number, held, size, training = 0, [], 0, 0

    def close():
        nonlocal number, size, training
        row = {"block": [task + number], "size": [size], "training": [training],
               "docs": [_packed_docs(held)]}
        number, size, training = number + 1, 0, 0
        held.clear()
        return pa.RecordBatch.from_pydict(row, pa.schema(
            [("block", pa.int64()), ("size", pa.int64()), ("training", pa.int64()), ("docs", pa.binary())]))

    for batch in batches:
        batch = pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip(batch.columns, _DOCS)], schema=_DOCS)
        for lo, hi, offsets, data in text_slices(batch.column(2)):
            part = batch.slice(lo, hi - lo)
            held.append(part)
            size += len(data)
            training += sum(not h for h in part.column(1).to_pylist())
            if size >= BLOCK_BYTES:
                yield close()
    if held:
        yield close()


class _Sequences:
    """The tokens of a block in a row: word, word before, document number."""

    def __init__(self, docs: bytes):
        table = pa.ipc.open_stream(docs).read_all()
        self.ids = table.column(0).combine_chunks()
        self.held = np.asarray(table.column(1).combine_chunks())
        word, prev, owner, at = [], [], [], 0
        for chunk in table.column(2).chunks:
            for lo, hi, offsets, data in text_slices(chunk):
                words, first = word_hashes(offsets, data)
                stops = first[1:] + np.arange(1, hi - lo + 1)  # each text's end token
                w = np.full(len(words) + hi - lo, END, np.uint64)
                inner = np.ones(len(w), bool)
                inner[stops - 1] = False
                w[inner] = words
                p = np.empty(len(w), np.uint64)
                p[1:] = w[:-1]
                p[np.concatenate(([0], stops[:-1]))] = START
                word.append(w), prev.append(p)
                owner.append(np.repeat(np.arange(at + lo, at + hi), np.diff(first) + 1))
            at += len(chunk)
        self.word, self.prev, self.owner = (np.concatenate(x) for x in (word, prev, owner))

    def pair(self) -> np.ndarray:
        return mix64(self.prev * np.uint64(0x9E3779B97F4A7C15) + mix64(self.word))


def _buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The one of ``buckets`` equal hash ranges that each key falls in (under 2**32 of them)."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _asked(buckets: int):
    """Task function: the keys of each block with training counts, cut into the buckets
    they fall in. A block gives rows for these alone, so the rows grow with the distinct
    keys of the blocks, however many buckets there are."""
    def counted(keys, training):
        order = np.argsort(keys, kind="stable")
        keys, training = keys[order], training[order]
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, counts = keys[at], np.add.reduceat(training, at)
        return keys, counts, _buckets_of(keys, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs in zip(batch.column(0).to_pylist(), batch.column(1)):
                seq = _Sequences(docs.as_buffer())
                training = (~seq.held)[seq.owner].astype(np.int64)
                pairs = counted(seq.pair(), training)
                words = counted(seq.word, training)
                del seq, training
                cells = np.union1d(pairs[2], words[2])
                columns = [pa.array(cells, pa.int32()), pa.array(np.full(len(cells), block), pa.int64())]
                for keys, counts, bucket in (pairs, words):
                    cuts = list(zip(np.searchsorted(bucket, cells), np.searchsorted(bucket, cells, side="right")))
                    columns += [pa.array([pack_keys(keys[a:b]) for a, b in cuts], pa.binary()),
                                pa.array([pack_counts(counts[a:b]) for a, b in cuts], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    columns, ["bucket", "block", "pairs", "pair_n", "words", "word_n"])
    return run


def _answered(asked: pa.Table) -> pa.Table:
    """One bucket: corpus counts of its keys, for every block in the order it asked.

    An answer is twice the count, plus 1 for the block that speaks for the key. A row
    without a block holds the bucket's totals: tokens, types and the numbers of words
    and of pairs that occur 1 to K + 1 times.
    """
    asked = asked.sort_by("block")
    answers, stats = [], []
    for name, n in (("pairs", "pair_n"), ("words", "word_n")):
        keys = [unpack_keys(k.as_py()) for k in asked.column(name)]
        counts = np.concatenate([unpack_counts(c.as_py()) for c in asked.column(n)])
        cut = np.cumsum([0] + [len(k) for k in keys])
        distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
        answer = 2 * total[inverse]
        answer[first] += 1
        answers.append([pack_counts(answer[a:b]) for a, b in zip(cut[:-1], cut[1:])])
        often = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1:K + 2].tolist()
        stats = ([int(total.sum()), int((total > 0).sum())] if name == "words" else []) + stats + often
    # tokens, types, pairs' histogram, words' histogram
    bucket = asked.column("bucket")[0].as_py()
    rows = asked.num_rows
    return pa.table([
        pa.array(asked.column("block").to_pylist() + [None], pa.int64()),
        pa.array([bucket] * (rows + 1), pa.int32()), pa.array(answers[0] + [None], pa.binary()),
        pa.array(answers[1] + [None], pa.binary()),
        pa.array([None] * rows + [stats], pa.list_(pa.int64()))],
        names=["block", "bucket", "pairs", "words", "stats"])


def discounts(histogram: dict[int, int]) -> list[float]:
    """d(1) .. d(K) from the numbers of events seen once, twice, ... (Good-Turing).

    Where the histogram doesn't allow it (gaps, values outside (0, 1]), absolute
    discounting by n1 / (n1 + 2 n2) takes its place, which leaves mass free too.
    """
    n = [0.0] + [float(histogram.get(r, 0)) for r in range(1, K + 2)]
    out = []
    if all(n[1:]):
        tail = (K + 1) * n[K + 1] / n[1]
        if tail < 1:
            out = [((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) for r in range(1, K + 1)]
    if not out or not all(0 < d < 1 for d in out):
        less = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        less = min(max(less, 0.1), 0.9)
        out = [(r - less) / r for r in range(1, K + 1)]
    return out


def _discounted(counts: np.ndarray, d: list[float]) -> np.ndarray:
    factor = np.concatenate(([0.0], d, [1.0]))
    return counts * factor[np.minimum(counts, K + 1)]


class KatzModel:
    """What every block needs to know: totals and discounts (a few numbers)."""

    def __init__(self, stats: list[int], training_docs: int):
        self.tokens, self.types = stats[:2]
        pairs, words = stats[2:K + 3], stats[K + 3:]
        self.d_pairs = discounts(dict(enumerate(pairs, 1)))
        self.d_words = discounts(dict(enumerate(words, 1)))
        self.starts = training_docs
        n = max(self.tokens, 1)
        freed = sum(r * words[r - 1] * (1 - d) for r, d in enumerate(self.d_words, 1))
        self.scale = 1.0 / n
        if self.tokens and freed <= 1e-12 * n:  # nothing freed: keep one event's worth for the unknown
            freed, self.scale = n / (n + 1), 1.0 / (n + 1)
        self.p_unknown = freed / n if self.tokens else 1.0

    def p_word(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.d_words) * self.scale, self.p_unknown)


def _rows(n: int, kind: int, **columns) -> pa.RecordBatch:
    given = {"kind": np.full(n, kind, np.int32), **columns}
    return pa.RecordBatch.from_arrays(
        [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in _SCORED_PA],
        schema=_SCORED_PA)


def _scored_block(model: KatzModel, block: int, docs: bytes, answers: list[dict]) -> Iterator[pa.RecordBatch]:
    """Rows of one block, by kind."""
    seq = _Sequences(docs)
    _, at, pair = np.unique(seq.pair(), return_index=True, return_inverse=True)
    words, word = np.unique(seq.word, return_inverse=True)
    answers = sorted(answers, key=lambda a: a["bucket"])
    c, c_word = (np.concatenate([unpack_counts(a[k]) for a in answers]) for k in ("pairs", "words"))
    speaks, c, c_word = (c & 1) > 0, c >> 1, c_word >> 1
    kept, p_word = _discounted(c, model.d_pairs), model.p_word(c_word)
    context = np.concatenate(([0], word[:-1]))  # the word before, or one past the words
    context[seq.prev == START] = len(words)
    c_context = np.append(c_word, model.starts)

    n_docs, owner = len(seq.ids), seq.owner
    per_doc = lambda weights=None: np.bincount(owner, weights, n_docs)
    seen = c[pair] > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        token = np.where(seen, np.log10(kept[pair] / c_context[context]), np.log10(p_word)[word])
    base = np.log10((c_word + 0.1) / (model.tokens + 0.1 * (model.types + 1)))[word]
    yield _rows(n_docs, DOCUMENT, block=np.full(n_docs, block), place=np.arange(n_docs, dtype=np.int32),
                doc_id=seq.ids, held_out=seq.held, n_tokens=per_doc(),
                n_known=per_doc((c_word > 0)[word]).astype(np.int64),
                base_score=per_doc(base), score=per_doc(token))

    after, least = context[at], len(words) + 1
    mine = speaks & (c > 0)
    sums = [np.bincount(after[mine], x[mine], least) for x in (c, kept, p_word[word[at]])]
    some = np.flatnonzero(sums[0])
    names = np.append(words, START).view(np.int64)
    yield _rows(len(some), CONTEXT, prev=names[some], total=sums[0][some].astype(np.int64),
                kept=sums[1][some], p=sums[2][some])

    # Only a context without a discounted successor can have a scale below 1.
    full = np.bincount(after, (c > 0) & (c <= K), least) == 0
    for kind, which in ((ALPHA, ~seen & (c_context > 0)[context]), (SCALE, seen & full[context])):
        key, n = np.unique(owner[which] * least + context[which], return_counts=True)
        yield _rows(len(key), kind, block=np.full(len(key), block), place=(key // least).astype(np.int32),
                    prev=names[key % least], n_tokens=n)


def _scored(model: KatzModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs, answers in zip(*(batch.column(i) for i in range(3))):
                yield from _scored_block(model, block.as_py(), docs.as_buffer(), answers.as_py())
    return run


def score(docs: DataFrame) -> DataFrame:
    """Score all documents with a model of those that are not held out.

    ``docs``: doc_id, text, held_out. Gives doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score: one row per row of ``docs``, whatever its id.
    """
    blocks = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text")
                     .mapInArrow(_blocks, _BLOCKS), "katz-blocks")
    sums = blocks.agg(F.sum("size"), F.sum("training")).first()
    buckets = 1 + (sums[0] or 0) // BUCKET_BYTES
    answers = written(blocks.select("block", "docs").mapInArrow(_asked(buckets), _ASKED)
                      .groupBy("bucket").applyInArrow(_answered, _ANSWERS), "katz-answers")
    stats = answers.where("block is null").agg(
        *[F.sum(F.col("stats")[i]) for i in range(2 + 2 * (K + 1))]).first()
    model = KatzModel([int(x or 0) for x in stats], int(sums[1] or 0))

    given = (answers.where("block is not null").groupBy("block")
             .agg(F.collect_list(F.struct("bucket", "pairs", "words")).alias("answers")))
    rows = written(blocks.select("block", "docs").join(given, "block").select("block", "docs", "answers")
                   .mapInArrow(_scored(model), _SCORED), "katz-scored")

    context = (rows.where(F.col("kind") == CONTEXT).groupBy("prev")
               .agg(F.sum("total").alias("total"), F.sum("kept").alias("kept"), F.sum("p").alias("p")))
    # A context whose successors all are too frequent to be discounted gives up one
    # event's worth instead.
    total = F.col("total")
    scale = F.when(F.col("kept") > total - 1e-9, total / (total + 1)).otherwise(F.lit(1.0))
    context = context.select("prev", scale.alias("scale"), "total", "kept", "p").select(
        "prev", "scale", ((1 - F.col("kept") * F.col("scale") / F.col("total"))
                          / F.greatest(1 - F.col("p"), F.lit(1e-12))).alias("alpha"))
    factor = F.when(F.col("kind") == ALPHA, F.col("alpha")).otherwise(F.col("scale"))
    rest = (rows.where(F.col("kind").isin(ALPHA, SCALE)).select("kind", "block", "place", "prev", "n_tokens")
            .join(context, "prev")
            .select("block", "place", F.lit(None).cast("long").alias("doc_id"),
                    F.lit(None).cast("boolean").alias("held_out"), F.lit(0).cast("long").alias("n_tokens"),
                    F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base_score"),
                    (F.col("n_tokens") * F.log10(factor)).alias("score")))
    sums = ["n_tokens", "n_known", "base_score", "score"]
    return (rows.where(F.col("kind") == DOCUMENT).select("block", "place", "doc_id", "held_out", *sums)
            .unionByName(rest).groupBy("block", "place")
            .agg(*[F.max(c).alias(c) for c in ("doc_id", "held_out")], *[F.sum(c).alias(c) for c in sums])
            .select("doc_id", "held_out", "n_tokens", "n_known",
                    F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"))
