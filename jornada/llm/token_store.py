"""Token-id output: documents as Simple-8b blocks in ascending doc_id order.

``write_tokens`` encodes each text with a public tokenizer, appends an end id,
range-partitions the encoded documents by id and writes blocks: every row of the
Parquet files is one block of consecutive documents with its place (shard, block,
first id inside the shard), the documents' ids and counts (their offsets inside the
block), and the packed words. ``read_documents`` decodes blocks
vectorised and places them globally from the shard totals in the files.

Defined cases: a null or empty text is the end id alone; a null doc_id sorts first;
rows that repeat an id keep one entry each; an empty table gives an empty store;
a very long text is one block of its own. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import text_slices

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: A block closes once it holds this many ids.
BLOCK_IDS = 1 << 16
#: Entries of a worker's cache, and the longest piece it keeps; it is emptied when full
#: (results don't depend on it).
CACHE_ENTRIES = 800_000
CACHE_LENGTH = 64
#: Bytes of text whose distinct pieces are found at once.
SLICE_BYTES = 4 << 20

_BLOCKS = ("shard int, block int, first bigint, n_ids bigint, doc_ids array<bigint>, "
           "counts array<bigint>, words binary")
_DOCS = "shard int, position bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def default_vocabulary() -> str:
    """Path of the public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


# Letters and marks that the vocabulary's pre-tokenizer keeps apart whatever stands
# around them: a run of Latin letters (with the space before it), a run of other
# signs, a single line break. A piece with anything else goes whole to the tokenizer.
_UNIT = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[^\\w\\s']+|\n)")
_UNSURE = re.compile("[^\\WA-Za-zÀ-ÖØ-öø-ÿ]|[^\\S\n]|'|\n\n|\n\\Z")
_INNER = re.compile(r"(?<=\S) (?=\S)")
# A space beside white space, or white space at a text's end (what Python calls white space).
_WHITE = r"[\x09-\x0D\x1C-\x1F\x20\x{85}\p{Z}]"
_ODD = f"{_WHITE} | {_WHITE}|{_WHITE}\\z"
# A byte-level vocabulary spells these bytes as themselves, and the others,
# in ascending order, as the characters from 256 on.
_AS_THEMSELVES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGNS = np.zeros(256, "<u4")
_BYTE_SIGNS[_AS_THEMSELVES] = _AS_THEMSELVES
_BYTE_SIGNS[_BYTE_SIGNS == 0] = 256 + np.arange(256 - len(_AS_THEMSELVES))


def _taken(ids: np.ndarray, sizes: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The entries at ``slots`` in a row; ``ids`` holds entries of ``sizes`` one behind the other."""
    size = sizes[slots]
    ends = np.cumsum(size)
    at = np.repeat((np.cumsum(sizes) - sizes)[slots] - (ends - size), size)
    at += np.arange(len(at))
    return ids[at]


class PieceEncoder:
    """Encodes texts by way of their distinct pieces, with a cache of units.

    A space between two non-space characters always begins a pre-token of a
    byte-level vocabulary, so the ids of a text are those of its pieces in a row.
    Pieces recur: Arrow numbers the distinct ones of a call, each of them is cut into
    units once, and a unit is encoded once per worker. A text that holds the spelling
    of an added token is encoded whole, as the library does it.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(vocabulary)
        if self._tok.normalizer is not None or type(self._tok.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError(f"{vocabulary}: a byte-level vocabulary without normaliser is needed")
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("H" if self._tok.get_vocab_size() <= 1 << 16 else "I")
        self._clear()

    def _clear(self) -> None:
        """Empty the cache: strings by slot, their ids in a row, and whether a space begins them."""
        self._slots: dict[str, int] = {}
        self._ids = np.zeros(0, self.dtype)
        self._sizes = np.zeros(0, np.int64)
        self._begins = np.zeros(0, bool)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text from the library."""
        return [found.ids for found in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_model(self, units: list[str]) -> list[list[int]]:
        """Ids of words and ASCII signs, single pre-tokens, from the vocabulary's model alone."""
        data = np.frombuffer("\n".join(units).encode(), np.uint8)
        signs = _BYTE_SIGNS[data].tobytes().decode("utf-32-le").split(chr(_BYTE_SIGNS[10]))
        tokenize = self._tok.model.tokenize  # one fetch: each access makes a new wrapper
        return [[t.id for t in tokenize(text)] for text in signs]

    def _flat(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and the size of each entry."""
        return (np.fromiter(chain.from_iterable(found), self.dtype),
                np.fromiter(map(len, found), np.int64, len(found)))

    def _keep(self, texts: list[str], found: list[list[int]]) -> None:
        """Enter texts into the cache."""
        ids, sizes = self._flat(found)
        self._slots.update(zip(texts, range(len(self._slots), len(self._slots) + len(texts))))
        self._ids = np.concatenate((self._ids, ids))
        self._sizes = np.concatenate((self._sizes, sizes))
        self._begins = np.concatenate((self._begins, np.fromiter((t[0] == " " for t in texts), bool, len(texts))))

    def _learn(self, units: list[str], whole: list[str]) -> None:
        """Encode the units and whole pieces that the cache lacks."""
        new = list(set(units).difference(self._slots))
        plain = [u for u in new if u != "\n" and (u.isascii() or u[1:].isalpha())]
        rest = list({*new, *whole}.difference(self._slots, plain))
        if plain:
            self._keep(plain, self._by_model(plain))
        if rest:
            self._keep(rest, self._whole(rest))

    def _pieces(self, pieces: list[str], heads: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, places): pieces, with the space before them, stand at ``places``, heads behind them."""
        units, whole, once = [], [], []
        for at, piece in enumerate(pieces):
            (once if len(piece) > CACHE_LENGTH else whole if _UNSURE.search(piece) else units).append(at)
        places = np.empty(len(pieces), np.int64)
        places[units + whole + once] = np.arange(len(pieces))
        units = _UNIT.findall("".join([" " + pieces[at] for at in units]))
        whole = [" " + pieces[at] for at in whole]
        self._learn(units, whole)
        slots = np.fromiter(map(self._slots.__getitem__, chain(units, whole)), np.int64, len(units) + len(whole))
        ids = [_taken(self._ids, self._sizes, slots)]
        sizes = [np.add.reduceat(self._sizes[slots], np.flatnonzero(self._begins[slots]))] if len(slots) else []
        # Long pieces and the starts of texts seldom recur: they stay out of the cache.
        found, more = self._flat(self._whole([" " + pieces[at] for at in once] + heads))
        return np.concatenate((*ids, found)), np.concatenate((*sizes, more)), places

    def _rows(self, flat: pa.Array, counts: np.ndarray) -> list[np.ndarray]:
        """Ids of texts given by their pieces: the first as it is, the others with a space before them."""
        if not len(counts):
            return []
        heads = np.cumsum(counts) - counts
        first = np.zeros(len(flat), bool)
        first[heads] = True
        rest = flat.filter(pa.array(~first)).dictionary_encode()
        pieces = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids, sizes, places = self._pieces(
            pieces, flat.take(pa.array(heads)).to_numpy(zero_copy_only=False).tolist())
        slots = np.empty(len(flat), np.int64)
        slots[heads] = len(pieces) + np.arange(len(heads))
        slots[~first] = places[rest.indices.to_numpy()]
        ends = np.cumsum(np.add.reduceat(sizes[slots], heads)).tolist()
        ids = _taken(ids, sizes, slots)
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def __call__(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """Ids of each text (null: none)."""
        collecting = gc.isenabled()
        gc.disable()  # the short-lived lists hold no cycles; scanning them takes a sixth of the time
        try:
            return self._encode(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        finally:
            if collecting:
                gc.enable()

    def _encode(self, column: pa.Array) -> list[np.ndarray]:
        if len(self._slots) > CACHE_ENTRIES:
            self._clear()
        column = column.fill_null("")
        # Where white space meets white space or a text's end, a split at a space isn't
        # sure: such texts are split with care.
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
        held = np.zeros(len(column), bool)
        for added in self._added:
            held |= pc.match_substring(column, added).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(column.filter(pa.array(~(odd | held))), " ")
        plain = iter(self._rows(split.flatten(), split.value_lengths().to_numpy().astype(np.int64)))
        parts = [_INNER.split(t) for t in column.filter(pa.array(odd & ~held)).to_pylist()]
        careful = iter(self._rows(pa.array(list(chain.from_iterable(parts)), column.type),
                                  np.array(list(map(len, parts)), np.int64)))
        whole = iter([np.array(self._tok.encode(t, add_special_tokens=False).ids, self.dtype)
                      for t in column.filter(pa.array(held)).to_pylist()])
        return [next(whole if h else careful if o else plain) for h, o in zip(held, odd)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(vocabulary: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    if vocabulary not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[vocabulary] = PieceEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def _encoded_blocks(vocabulary: str | None, end_id: int):
    """Task function: a sorted partition of (doc_id, text) as packed blocks."""
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
                        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int64())), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(vocabulary or default_vocabulary())
        end = np.array([end_id], dtype=encode.dtype)
        block = first = total = 0
        docs, counts, data = [], [], []

        def close():
            nonlocal block, first, total
            words = simple8b.encode(np.concatenate(data))
            out = pa.RecordBatch.from_pylist([dict(
                shard=shard, block=block, first=first, n_ids=total, doc_ids=list(docs),
                counts=list(counts), words=words.astype("<u8").tobytes())], schema)
            block, first, total = block + 1, first + total, 0
            docs.clear(), counts.clear(), data.clear()
            return out

        for batch in batches:
            for row, until, _, _ in text_slices(batch.column(1), SLICE_BYTES):
                texts = batch.column(1).slice(row, until - row)
                for doc, ids in zip(batch.column(0).slice(row, until - row).to_pylist(), encode(texts)):
                    docs.append(doc)
                    counts.append(len(ids) + 1)
                    data += (ids, end)
                    total += counts[-1]
                    if total >= BLOCK_IDS:
                        yield close()
        if docs:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None,
                 end_id: int = END_ID) -> None:
    """Write the token store of ``docs`` at ``path`` (one job, committed by Spark).

    Texts are range-partitioned before they are encoded: the bounds come from a pass
    that encodes nothing, and every text is encoded once.
    """
    (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
     # Rows without an id, or of one id, are dealt by their texts.
     .select("doc_id", "text", F.xxhash64("text").alias("hash"))
     .repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash")
     .select("doc_id", "text")
     .mapInArrow(_encoded_blocks(vocabulary, end_id), _BLOCKS)
     .write.option("compression", "uncompressed").parquet(path))


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a token store, as written."""
    return spark.read.schema(_BLOCKS).parquet(path)


def decode_block(words: bytes) -> np.ndarray:
    """All ids of a block in a row."""
    return simple8b.decode(np.frombuffer(words, dtype="<u8"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("shard", pa.int32()), ("position", pa.int64()), ("doc_id", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(batch.schema.get_field_index(name))[row]
            ids = decode_block(get("words").as_buffer()).astype("<u4")
            counts = np.array(get("counts").as_py(), dtype=np.int64)
            starts = np.concatenate(([0], np.cumsum(counts)))
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(counts), get("shard").as_py(), np.int32)),
                 pa.array(starts[:-1] + get("first").as_py()),
                 get("doc_ids").values, pa.array(counts), pa.array(crc, pa.int64())], schema=schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: the totals of the shards
    before (one row per shard) plus the place inside the shard.
    """
    blocks = open_store(spark, path)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
              .select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base")))
    rows = blocks.select("shard", "first", "doc_ids", "counts", "words").mapInArrow(_documents, _DOCS)
    return rows.join(shards, "shard").select(
        "doc_id", (F.col("base") + F.col("position")).cast("long").alias("start"),
        "n_tokens", "ids_crc32")
