"""Language identification: family first, then one-versus-one linear SVMs within it.

Features are frequencies of hashed byte trigrams over the letters of a text (capitals
folded, everything else a blank), so signs and markup don't move a prediction.
Linear SVMs (squared hinge) separate each pair of families, then each pair of
languages inside a family; the most votes win, ties by summed margins.

Training takes a bounded sample: about PER_LANGUAGE labelled documents of each
language, chosen by a hash of the id. Models are a few vectors of DIMENSIONS
numbers, shipped to the tasks; every text is predicted whole.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
null labels are not trained on; a single learned language is always predicted;
with no labelled row everything is ``und``; repeated rows and ties behave the same
in every run; empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

DIMENSIONS = 2048
PER_LANGUAGE = 1000

# Families of ISO 639-1 codes; a code not listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}

_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), lang)


def features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Unit-length trigram frequencies, one row per text of a slice."""
    rows = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((rows, DIMENSIONS), np.float32)
    b = _LETTER[data]
    capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    b[1:][capital] += 0x20
    blank = b == 0x20
    key = (b[:-2].astype(np.uint32) << 16) | (b[1:-1].astype(np.uint32) << 8) | b[2:]
    key = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    good = (blank[:-2].view(np.uint8) + blank[1:-1] + blank[2:]) < 2
    owner = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    good &= owner[:-2] == owner[2:]
    flat = np.bincount(owner[:-2][good] * DIMENSIONS + key[good], minlength=rows * DIMENSIONS)
    out = np.sqrt(flat.reshape(rows, DIMENSIONS).astype(np.float32))
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(length, 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 200) -> np.ndarray:
    """Linear SVM (L2-regularised squared hinge, last weight the bias), y in -1, 1.

    Accelerated gradient descent with a fixed step from the largest curvature.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    y = y.astype(x.dtype)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * c
    rate = 1.0 / (1e-2 + 2 * (weight * (x * x).sum(axis=1)).sum())
    w = z = np.zeros(x.shape[1], x.dtype)
    t = 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ z))
        step = z - rate * (1e-2 * z - 2 * x.T @ (weight * slack * y))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = step + (t - 1) / t_next * (step - w)
        w, t = step, t_next
    return w


def _pairs(x: np.ndarray, names: np.ndarray) -> dict[tuple[str, str], np.ndarray]:
    out = {}
    for a, b in combinations(sorted(set(names)), 2):
        rows = (names == a) | (names == b)
        out[a, b] = train_svm(x[rows], np.where(names[rows] == a, 1.0, -1.0))
    return out


class Model:
    """Pairwise SVMs over families and, per family, over its languages."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        fams = np.array([family(v) for v in langs], dtype=object)
        self.families = sorted(set(fams))
        self.members = {f: sorted(set(langs[fams == f])) for f in self.families}
        self.between = _pairs(x, fams)
        self.within = {f: _pairs(x[fams == f], langs[fams == f]) for f in self.families}

    @staticmethod
    def _vote(x: np.ndarray, names: list[str], svms: dict) -> tuple[np.ndarray, np.ndarray]:
        """(index of the winning name, confidence 0 to 1) per row."""
        if len(names) == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        votes = np.zeros((len(x), len(names)))
        sure = np.zeros((len(x), len(names)))
        for (a, b), w in svms.items():
            margin = x @ w[:-1] + w[-1]
            p = 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))
            i, j = names.index(a), names.index(b)
            votes[:, i] += margin >= 0
            votes[:, j] += margin < 0
            sure[:, i] += p
            sure[:, j] += 1 - p
        best = (votes + sure / (len(names) + 1)).argmax(axis=1)
        return best, sure[np.arange(len(x)), best] / (len(names) - 1)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        fam, score = self._vote(x, self.families, self.between)
        langs = np.empty(len(x), dtype=object)
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(fam == i)
            if len(rows):
                best, inner = self._vote(x[rows], self.members[f], self.within[f])
                langs[rows] = np.array(self.members[f], dtype=object)[best]
                score[rows] *= inner
        return langs.tolist(), score


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, offsets, data in text_slices(batch.column(1), 1 << 19):
            x = features(offsets, data).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())],
                ["lang", "x"])


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on (doc_id, text, lang) rows; null languages are left out."""
    rows = labelled.where("lang is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    # A hash of row and row number decides: languages with more rows are thinned evenly, and
    # so are rows that repeat. The sample's size is per_language on average for each of them.
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(per_language / n)).otherwise(share)
    number = F.monotonically_increasing_id()
    drawn = F.pmod(F.xxhash64(F.lit(9), "doc_id", "text", number), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = rows.where(drawn < share).select("lang", "text")
    got = sample.mapInArrow(_vectors, "lang string, x binary").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    langs = np.array(got["lang"].to_pylist(), dtype=object)
    order = np.lexsort((x[:, 0], x.sum(axis=1), langs))
    return Model(x[order], langs[order])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ascii_letter = np.zeros(256, bool)
        ascii_letter[0x41:0x5B] = ascii_letter[0x61:0x7B] = True
        for batch in batches:
            for lo, hi, offsets, data in text_slices(batch.column(1), 1 << 19):
                n = hi - lo
                seen = np.concatenate(([0], np.cumsum(ascii_letter[data])))
                letter = np.diff(seen[offsets]) > 0
                for i in np.flatnonzero(~letter):  # only texts without an ASCII letter
                    text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
                    letter[i] = any(c.isalpha() for c in text)
                langs, score = ["und"] * n, np.zeros(n)
                if model is not None and letter.any():
                    rows = np.flatnonzero(letter)
                    names, p = model.predict(features(offsets, data)[rows])
                    for i, name in zip(rows, names):
                        langs[i] = name
                    score[rows] = p
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(langs, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")
