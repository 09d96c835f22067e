"""Toxicity by noisy-channel deobfuscation: restore disguised words, then score the restored text.

1. A character trigram model is counted over the letters of all documents. Pairs and single letters are summed from all
   trigrams on Spark; trigrams seen fewer than `least_rows` times are then left to the pairs. The driver gathers 16 bytes
   for each distinct one, which grows with the letters in use, more slowly than the text.
2. A token that may be disguised becomes a lattice: look-alike digits and signs may stand for letters, runs of one
   character for one or two of it, letters kept apart by signs for one word, and letters kept apart by blanks for words
   whose bounds the decoding chooses. Every reading but the plain one
   costs the channel something; Viterbi decoding under the trigram model picks the reading. Tokens of plain letters have a
   lattice with one path and are taken as they are.
3. Features are words and word beginnings of the restored text (its plain reading included). Labelled documents give each
   feature a weight, the log odds of toxic against other documents less a margin for chance. The feature with the largest
   weight is taken, the documents that have it are set aside, and the rest is counted again, until no weight reaches
   `least` with more evidence (log likelihood ratio) than the best of all features has by chance; so words that merely
   accompany a marker get no weight. The largest weight of a text and the sum over its
   words go through a logistic calibration, fitted on labelled documents that gave no weights.

The model of labels is fitted on at most `sample` labelled documents (smallest hash of their id); scoring is a single
pass without a shuffle. Null and empty texts get the score of a text without features. Without labels of both kinds every
score is the share of toxic labels (0 without any). Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import settle
from casebook.llm.compression_quality import fit_logistic

# Letters that a digit or sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
_WORD = re.compile(r"[^\W\d_]+")
_OTHER = re.compile(r"[\W\d_]+")
_APART = re.compile(r"[^\w@$!|+(]+|_+")
_RUN = re.compile(r"(.)\1")
_RUNS = re.compile(r"(.)\1*", re.DOTALL)
_SPELLED = re.compile(rf"(?:[^\W\d_]|[{re.escape(''.join(LOOKALIKES))}])+")
_EDGE = " \t\r\n\v\f.,;:?\"'`´*&%#~<>[]{})/\\=^…«»„“”-_"
_SUBSTITUTE, _REPEAT = 1.5, 0.5  # what a look-alike and a shortened run cost, in nats


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter trigrams (three code points packed into a long), by batch of texts."""
    for batch in batches:
        held: list[np.ndarray] = []
        size = 0
        for at, text in enumerate(batch.column(0)):
            letters = _OTHER.sub(" ", (text.as_py() or "").lower()).strip()
            if letters:
                codes = np.frombuffer(f"  {letters} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
                held.append((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])
                size += len(codes)
            if held and (size > 4_000_000 or at + 1 == batch.num_rows):
                gram, rows = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(rows)], names=["gram", "rows"])
                held, size = [], 0


_LETTER, _PAIR = (1 << 21) - 1, (1 << 42) - 1
#: Tables of the letter model: the trigram, its first two letters, its last two, the middle one and the last one.
_KINDS = ["gram", "shiftright(gram, 21)", f"gram & {_PAIR}", f"shiftright(gram, 21) & {_LETTER}", f"gram & {_LETTER}"]


def _code(letters: str) -> int:
    code = 0
    for c in letters:
        code = code << 21 | ord(c)
    return code


class LetterModel:
    """Smoothed log probabilities of a letter after two others; every table holds sorted codes and their counts."""

    def __init__(self, trigrams: dict[str, int], smooth: float = 5.0):
        gram = np.array([_code(g) for g in trigrams], dtype=np.int64)
        rows = np.array(list(trigrams.values()), dtype=np.int64)
        self.smooth = smooth
        self._hold([(codes, rows) for codes in (gram, gram >> 21, gram & _PAIR, gram >> 21 & _LETTER, gram & _LETTER)])

    @classmethod
    def of_tables(cls, tables: list[tuple[np.ndarray, np.ndarray]], smooth: float = 5.0) -> LetterModel:
        """A model of (codes, counts) in the order of `_KINDS`."""
        model = cls({}, smooth)
        model._hold(tables)
        return model

    def _hold(self, tables: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.tables = []
        for codes, rows in tables:
            once, at = np.unique(codes, return_inverse=True)
            total = np.zeros(len(once), dtype=np.int64)
            np.add.at(total, at, rows)
            self.tables.append((once, total))
        self.total = int(self.tables[4][1].sum())
        self.known: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def _rows(self, kind: int, letters: str) -> int:
        codes, rows = self.tables[kind]
        at = int(np.searchsorted(codes, code := _code(letters)))
        return int(rows[at]) if at < len(codes) and codes[at] == code else 0

    def log(self, gram: str) -> float:
        found = self.known.get(gram)
        if found is None:
            if len(self.known) > 500_000:
                self.known.clear()
            k = self.smooth
            p1 = (self._rows(4, gram[2]) + 1) / (self.total + len(self.tables[4][0]) + 1)
            p2 = (self._rows(2, gram[1:]) + k * p1) / (self._rows(3, gram[1]) + k)
            p3 = (self._rows(0, gram) + k * p2) / (self._rows(1, gram[:2]) + k)
            found = self.known[gram] = math.log(p3)
        return found


@lru_cache(maxsize=1 << 16)
def _options(letter: str, run: int) -> tuple[tuple[str, float], ...]:
    """Readings and costs of a run of one character; a run of three stands for any longer one."""
    plain = letter.isalpha()
    cost = 0.0 if plain else _SUBSTITUTE
    out = []
    for x in letter if plain else LOOKALIKES.get(letter, ""):
        out.append((x, cost + (_REPEAT if run > 1 else 0)))
        if run > 1:
            out.append((x * 2, cost + (_REPEAT if run > 2 else 0)))
    return tuple(out)


def lattice(token: str) -> list[tuple[tuple[str, float], ...]]:
    """For each run of one character in a token its readings and their costs; empty without a reading in letters."""
    out = [_options(found.group(1), min(3, found.end() - found.start())) for found in _RUNS.finditer(token)]
    return out if all(out) else []


def decode(token: str, model: LetterModel, apart: bool = False) -> str | None:
    """The likeliest word behind a token, or words if its characters stood apart; None if it has no reading in letters."""
    steps = lattice(token)
    if not steps:
        return None
    if apart:
        parted = []
        for options in steps:
            parted.append((*options, *((" ".join(x), cost) for x, cost in options if len(x) == 2)))
        steps = [x for options in parted for x in (options, (("", 0.0), (" ", 0.0)))][:-1]
    known, log = model.known, model.log
    best: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    for options in [*steps, [(" ", 0.0)]]:
        following: dict[str, tuple[float, tuple | None]] = {}
        for state, (score, path) in best.items():
            for letters, cost in options:
                total, last = score - cost, state
                for c in letters:
                    gram = last + c
                    step = known.get(gram)
                    total += log(gram) if step is None else step
                    last = gram[1:]
                if last not in following or total > following[last][0]:
                    following[last] = (total, (path, letters))
        best = following
    path, parts = max(best.values(), key=lambda x: x[0])[1], []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts)).strip()


def readings(token: str, model: LetterModel) -> tuple[str, ...]:
    """Words of a lower-cased token, plain and restored."""
    core = token.strip(_EDGE)
    if core.isalpha() and not _RUN.search(core):
        return (core,)
    plain = tuple(_WORD.findall(core))
    found = set(plain)
    pieces = [x for x in _APART.split(core.strip("!|+(")) if x]
    if len(pieces) > 2 and all(len(x) == 1 for x in pieces):
        pieces = ["".join(pieces)]
    for piece in pieces:
        for form in {piece, piece.strip("!|+("), piece.strip("!|+($@€£¡")}:
            if not any(map(str.isalpha, form)) or (form.isalpha() and not _RUN.search(form)):
                if form.isalpha():
                    found.add(form)
                continue
            word = decode(form, model)
            if word:
                found.add(word)
    return tuple(found)


_NOTHING: tuple[bool, tuple[str, ...]] = (False, ())


def restored_words(
    text: str | None, model: LetterModel, memo: dict[str, tuple[bool, tuple[str, ...]]], keep: Callable[[str], float] | None = None
) -> set[str]:
    """Distinct words of a text, restored ones included, or those of them that `keep` accepts.

    `memo` remembers for a token whether it is a single character and its words; it belongs to one model and `keep`.
    """
    tokens = (text or "").lower().split()
    if len(memo) > 500_000:
        memo.clear()
    out: set[str] = set()
    alone: set[str] = set()
    for token in set(tokens):
        known = memo.get(token)
        if known is None:
            words = readings(token, model)
            if keep:
                words = tuple(filter(keep, words))
            single = len(token.strip(_EDGE)) < 2
            known = memo[token] = (single, words) if single or words else _NOTHING
        if known is _NOTHING:
            continue
        out.update(known[1])
        if known[0]:
            alone.add(token)
    if alone and sum(token in alone for token in tokens) > 2:
        run: list[str] = []
        for token in [*tokens, "  "]:  # blanks are no token: they end the last run
            if token in alone:
                run.append(token.strip(_EDGE))
            elif run:
                if len(run) > 2:
                    joined = "".join(run)
                    words = [*readings(joined, model)]
                    for part in _SPELLED.findall(joined):
                        if any(map(str.isalpha, part)):
                            words += (decode(part, model, True) or "").split()
                    out.update(filter(keep, words) if keep else words)
                run = []
    return out


def features(word: str) -> list[str]:
    """The word itself and its beginnings (marked by a hyphen)."""
    return [word, *(f"{word[:k]}-" for k in range(3, min(9, len(word) + 1)))]


class ToxicityModel:
    def __init__(self, letters: LetterModel, weights: dict[str, float], calibration: np.ndarray):
        self.letters, self.weights, self.calibration = letters, weights, calibration
        self.memo: dict[str, tuple[bool, tuple[str, ...]]] = {}
        #: The first three letters of all beginnings that have a weight: other words need no look at their beginnings.
        self.stems = {f[:3] for f in weights if f.endswith("-")}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def weight(self, word: str) -> float:
        """The largest weight of the word and its beginnings, 0 without any."""
        if word[:3] in self.stems:
            return max(self.weights.get(f, 0.0) for f in features(word))
        return self.weights.get(word, 0.0)

    def traits(self, words) -> list[float]:
        found = [w for w in map(self.weight, words) if w]
        most = max(found, default=0.0)
        return [most, most * most, math.log1p(math.fsum(found))]

    def of_words(self, words) -> float:
        z = self.calibration[0] + float(np.dot(self.calibration[1:], self.traits(words)))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))

    def score(self, text: str | None) -> float:
        return self.of_words(restored_words(text, self.letters, self.memo, self.weight))


def learn_letters(documents: DataFrame, least_rows: int = 2) -> LetterModel:
    """The trigram model of all texts; see the module for `least_rows`."""
    counted = documents.select("text").mapInArrow(_trigrams, "gram long, rows long")
    summed = settle(counted.groupBy("gram").agg(F.sum("rows").alias("rows")), "toxicity-trigrams")
    codes = F.array(*(F.struct(F.lit(i).alias("kind"), F.expr(kind).alias("code")) for i, kind in enumerate(_KINDS)))
    tables = summed.select(F.explode(codes).alias("of"), "rows").groupBy("of.kind", "of.code").agg(F.sum("rows").alias("rows"))
    gathered = tables.where((F.col("kind") > 0) | (F.col("rows") >= least_rows)).toArrow()
    kind, code, rows = (gathered[c].to_numpy() for c in ("kind", "code", "rows"))
    return LetterModel.of_tables([(code[kind == i], rows[kind == i]) for i in range(len(_KINDS))])


def _words(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, memo = shared.value, {}
        for batch in batches:
            words = [sorted(restored_words(text.as_py(), letters, memo)) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(words, pa.list_(pa.string()))], names=["toxic", "fits", "words"]
            )

    return run


def learn_toxicity(
    documents: DataFrame, labels: DataFrame, train: Column, half: Column, sample: int = 20_000, margin: float = 1.5, least: float = 1.5
) -> ToxicityModel:
    """A model of `labels.toxic` from labelled rows where `train` (on doc_id) holds; rows where `half` holds calibrate."""
    spark = documents.sparkSession
    letters = learn_letters(documents)
    known = labels.where(train & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.select("doc_id", "toxic", half.alias("fits")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = F.broadcast(known)  # at most `sample` ids
    rows = documents.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic", "fits")
    shared = spark.sparkContext.broadcast(letters)
    bags = settle(rows.mapInArrow(_words(shared), "toxic int, fits boolean, words array<string>"), "toxicity-words")
    sizes = {(r.toxic, r.fits): r.n for r in bags.groupBy("toxic", "fits").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get((1, False), 0), sizes.get((0, False), 0)
    n = sum(sizes.values())
    share = sum(v for (t, _), v in sizes.items() if t) / n if n else 0.0
    flat = np.array([math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0, 0, 0])
    if not toxic or not other:
        return ToxicityModel(letters, {}, flat)
    begins = lambda w: F.transform(F.sequence(F.lit(3), F.least(F.lit(8), F.length(w))), lambda k: F.concat(F.substr(w, F.lit(1), k), F.lit("-")))
    marks = lambda w: F.concat(F.array(w), F.when(F.length(w) > 2, begins(w)).otherwise(F.array().cast("array<string>")))
    once = F.array_distinct(F.flatten(F.transform("words", marks)))  # a document states each feature once, without a shuffle
    each = bags.where(~F.col("fits")).select("toxic", F.monotonically_increasing_id().alias("row"), F.explode(once).alias("feature"))
    counts = each.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("o") + 0.5) / (other + 1))
    weight = odds - margin * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    counts = settle(counts, "toxicity-features")
    chance = math.log(max(2, counts.count()))  # what the best of so many features reaches by chance
    able = counts.where(F.col("t") * math.log((toxic + other) / toxic) >= chance).where(weight >= least).select("feature")
    able = settle(able, "toxicity-able")  # written, so that its size decides how it is joined
    found = each.join(able, "feature").select("row", "toxic", "feature").toArrow()
    model = ToxicityModel(letters, pick_features(found, toxic, other, margin, least, chance), flat)
    fitted = bags.where("fits") if sizes.get((1, True)) and sizes.get((0, True)) else bags
    traits = fitted.select("toxic", "words").mapInArrow(_traits(spark.sparkContext.broadcast(model)), "toxic int, a double, b double, c double").toArrow()
    x = np.column_stack([traits[c].to_numpy() for c in "abc"])
    model.calibration = fit_logistic(x, traits["toxic"].to_numpy().astype(float))
    return model


def pick_features(found: pa.Table, toxic: int, other: int, margin: float, least: float, chance: float) -> dict[str, float]:
    """Features and weights in a greedy choice over (row, toxic, feature) of the sampled documents.

    A feature that could be taken occurs in many toxic documents of the sample, so their number is bounded with it.
    """
    if not found.num_rows:
        return {}
    names, feature = np.unique(found["feature"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    row = np.unique(found["row"].to_numpy(), return_inverse=True)[1]
    bad = found["toxic"].to_numpy() == 1
    left = np.ones(len(row), dtype=bool)
    out: dict[str, float] = {}
    while True:
        t = np.bincount(feature[left & bad], minlength=len(names))
        o = np.bincount(feature[left & ~bad], minlength=len(names))
        odds = np.log((t + 0.5) / (toxic + 1)) - np.log((o + 0.5) / (other + 1))
        part, share = t / np.maximum(1, t + o), toxic / (toxic + other)
        evidence = t * np.log(np.maximum(part, 1e-9) / share) + o * np.log(np.maximum(1 - part, 1e-9) / (1 - share))
        weight = np.where(evidence >= chance, odds - margin * np.sqrt(1 / (t + 0.5) + 1 / (o + 0.5)), -np.inf)
        best = int(np.argmax(weight))
        if weight[best] < least:
            return out
        out[str(names[best])] = float(weight[best])
        gone = np.zeros(int(row.max()) + 1, dtype=bool)
        gone[row[left & (feature == best)]] = True
        left &= ~gone[row]


def _traits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.traits(words) for words in batch.column(1).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*found)] or [pa.array([], pa.float64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["toxic", "a", "b", "c"])

    return run


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(text.as_py()) for text in batch.column(batch.num_columns - 1)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=batch.schema.names[:-1] + ["score"])

    return run


def score_toxicity(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """`rows`, whose last column is the text, with the score in its place."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(shared), rows.schema[:-1].add("score", "double"))
