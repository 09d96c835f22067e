"""Language identification with bit-sliced Bloom filters over character n-grams.

Learning: for every labelled training document the distinct n-grams of its lower-cased letters (words parted and framed
by one blank) are counted by language. A language contains an n-gram when at least `share` of its documents have it and
no language has it more than `lead` times as often. Such n-grams go into one Bloom filter per language; the filters have
the same hashes and lie side by side, slot by slot, as bitmasks over languages. Their size is fixed by `slots`, so what
the driver gathers and broadcasts is bounded whatever the corpus.

Predicting: the masks of an n-gram's slots, combined by AND, name all languages that contain it. The hits of a language,
over the distinct n-grams of the text, are corrected by its filter's rate of false positives; the largest corrected rate
decides (ties: the smaller name). The score is that rate's part of all languages' rates. A text with letters but without
hits gets the language with most training documents and score 0; null texts and texts without letters get `und`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from casebook.llm.common import lean, mix, settle, slices

_OTHER = re.compile(r"[\W\d_]+")
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)


def grams(text: str | None, n: int) -> np.ndarray | None:
    """Distinct hashes of the n-grams of a text's letters; None without any letter."""
    if not text:
        return None
    letters = _OTHER.sub(" ", text.lower())
    if not any(map(str.isalpha, letters)):
        return None
    codes = np.frombuffer(f" {letters.strip()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    width = min(n, len(codes))
    total = np.zeros(len(codes) - width + 1, dtype=np.uint64)
    for j in range(width):
        total = total * _STEP[1] + codes[j : len(codes) - width + 1 + j] * _STEP[0]
    return np.unique(mix(total))


def slots_of(hashes: np.ndarray, probes: int, slots: int) -> np.ndarray:
    """The slots of each hash, one row a probe."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    return np.stack([((low + np.uint64(i) * (high | np.uint64(1))) % np.uint64(slots)).astype(np.int64) for i in range(probes)])


def _counts(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                by: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    own = grams(text, n)
                    if own is not None:
                        by.setdefault(lang, []).append(own)
                for lang, arrays in by.items():
                    gram, rows = np.unique(np.concatenate(arrays), return_counts=True)
                    names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(gram), np.int32)), [lang]).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array(gram.view(np.int64)), pa.array(rows)], names=["lang", "gram", "rows"]
                    )

    return run


class LanguageFilters:
    """The learned filters: `masks` holds, for every slot, a bitmask over `languages` (in words of 64)."""

    def __init__(self, languages: list[str], usual: int, masks: np.ndarray, n: int, probes: int):
        self.languages, self.usual, self.masks, self.n, self.probes = languages, usual, masks, n, probes
        fill = [self._hits(masks, i).mean() if len(masks) else 0.0 for i in range(len(languages))]
        self.false_rate = np.array(fill) ** probes

    @staticmethod
    def _hits(masks: np.ndarray, language: int) -> np.ndarray:
        return (masks[:, language // 64] >> np.uint64(language % 64)) & np.uint64(1)

    def predict(self, text: str | None) -> tuple[str, float]:
        own = grams(text, self.n)
        if own is None or not self.languages:
            return "und", 0.0
        at = slots_of(own, self.probes, len(self.masks))
        found = self.masks[at[0]]
        for row in at[1:]:
            found = found & self.masks[row]
        rates = np.array([self._hits(found, i).mean() for i in range(len(self.languages))])
        rates = np.clip((rates - self.false_rate) / np.maximum(1e-9, 1 - self.false_rate), 0, 1)
        if not rates.sum():
            return self.languages[self.usual], 0.0
        best = int(np.argmax(rates))
        return self.languages[best], float(rates[best] / rates.sum())


def learn_filters(
    documents: DataFrame, train: Column, n: int = 4, share: float = 0.002, lead: float = 10.0, slots: int = 1 << 20, probes: int = 4
) -> LanguageFilters:
    """Filters learned from text and lang of the rows where `train` holds and lang is not null."""
    rows = documents.where(train & F.col("lang").isNotNull()).select("lang", "text")
    by = rows.where("text is not null").groupBy("lang").count().orderBy("lang").collect()
    languages, totals = [r[0] for r in by], [r[1] for r in by]
    if not languages:
        return LanguageFilters([], 0, np.zeros((slots, 1), dtype=np.uint64), n, probes)
    counted = rows.mapInArrow(lean(_counts(n)), "lang string, gram long, rows long").groupBy("lang", "gram").agg(F.sum("rows").alias("rows"))
    known = documents.sparkSession.createDataFrame(list(zip(languages, range(len(languages)), totals)), "lang string, number int, total long")
    rated = counted.join(known, "lang").select("gram", "number", (F.col("rows") / F.col("total")).alias("rate"))
    frequent = settle(rated.where(F.col("rate") >= share), "language-grams")
    top = frequent.groupBy("gram").agg(F.max("rate").alias("top"))
    inside = frequent.join(top, "gram").where(F.col("rate") * lead >= F.col("top")).select("gram", "number")
    words = (len(languages) + 63) // 64
    setters = inside.mapInArrow(_slot_rows(probes, slots), "word int, slot long, bit long")
    bits = setters.groupBy("word", "slot").agg(F.bit_or("bit").alias("mask")).toArrow()
    masks = np.zeros((slots, words), dtype=np.uint64)
    masks[bits["slot"].to_numpy(), bits["word"].to_numpy()] = bits["mask"].to_numpy().view(np.uint64)
    return LanguageFilters(languages, int(np.argmax(totals)), masks, n, probes)


def _slot_rows(probes: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(0).to_numpy().view(np.uint64)
            number = np.tile(batch.column(1).to_numpy(), probes)
            at = slots_of(gram, probes, slots).ravel()
            bit = np.uint64(1) << (number % 64).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((number // 64).astype(np.int32)), pa.array(at), pa.array(bit.view(np.int64))], names=["word", "slot", "bit"]
            )

    return run


#: Bytes of text after which a batch of predictions is handed on.
HANDED_ON = 4 << 20


def _predict(shared, new: tuple[str, str], keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in batches:
            texts, width = batch.column(batch.num_columns - 1), batch.num_columns - (not keep_text)
            found: list[tuple[str, float]] = []
            at, size = 0, 0
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                found.append(filters.predict(text))
                size += len(text or "")
                if size >= HANDED_ON or i + 1 == batch.num_rows:
                    kept = [batch.column(j).slice(at, i + 1 - at) for j in range(width)]
                    told = [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
                    yield pa.RecordBatch.from_arrays([*kept, *told], names=[*batch.schema.names[:width], *new])
                    at, size, found = i + 1, 0, []

    return run


def predict_languages(
    rows: DataFrame, filters: LanguageFilters, names: tuple[str, str] = ("lang_pred", "score"), keep_text: bool = False
) -> DataFrame:
    """`rows`, whose last column is the text, with the predicted language and its score in its place, or behind it."""
    shared = rows.sparkSession.sparkContext.broadcast(filters)
    kept = rows.schema if keep_text else rows.schema[:-1]
    schema = StructType([*kept.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return rows.mapInArrow(lean(_predict(shared, names, keep_text)), schema)
