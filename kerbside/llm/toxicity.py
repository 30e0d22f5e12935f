"""Toxicity scores from a weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts to Latin ones, digits and
signs inside words to the letters they stand for. The lexicon holds words and word beginnings
with weights learned from labelled documents. Matches inside exception phrases do not count. The
sum of weights, as it is and over the length of the text, gives a score through a logistic curve.

Bounds: at most MAX_LABELLED labelled documents are learned from (the least by a hash of their
id), a lexicon is chosen from the MAX_CANDIDATES features most frequent in toxic documents and has
at most MAX_ENTRIES entries. Everything else covers all rows.

Defined cases: a missing or empty text has no match and gets the curve's value there; without
labelled documents of both kinds nothing is learned and every score is 0; labels of unknown ids
and missing labels are ignored; an id labelled twice is toxic if one label says so; rows without
an id are scored and count as held out; columns other than `doc_id` and `text` are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import slices, stored, texts

MAX_LABELLED = 200_000
MAX_ENTRIES = 2_000
FOLDS = 5
PREFIXES = (4, 5, 6, 7, 8)
# Beginnings and words of toxic documents that are looked for in the other ones.
MAX_CANDIDATES = 100_000
# Counted features that a worker holds before it sends them on.
HELD = 300_000

# FIXED VALUES: letters that look like Latin ones, by the letter they stand for.
LOOKALIKES = {
    "a": "аαɑ", "b": "ьβ", "c": "сϲ", "d": "ԁ", "e": "еεҽ", "g": "ɡ", "h": "һ", "i": "іιı",
    "j": "ј", "k": "кκ", "l": "ӏ", "m": "м", "n": "пη", "o": "оοσ", "p": "рρ", "q": "ԛ",
    "s": "ѕ", "t": "тτ", "u": "υ", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
# FIXED VALUES: digits and signs used as letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a",
              "$": "s", "!": "i", "|": "l"}
# FIXED VALUES: phrases in which a lexicon word means no harm.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "pond scum", "clown fish",
              "class clown", "circus clown", "stupid mistake of mine")

_FOLDED = str.maketrans(
    {x: latin for latin, same in LOOKALIKES.items() for x in same}
    | {chr(0xFF41 + i): chr(ord("a") + i) for i in range(26)}  # full-width letters
    | {chr(0xFF10 + i): str(i) for i in range(10)}
)
_ALIKE = re.compile(f"[{''.join(map(chr, _FOLDED))}]")
_RUN = re.compile(r"[0134578@$!|]+")
_WORD = re.compile(r"[^\W\d_]+")
_ANY = str.maketrans(STANDS_FOR)
_DIGITS = str.maketrans({k: v for k, v in STANDS_FOR.items() if k.isdigit()})


def _as_letters(found: re.Match) -> str:
    """Digits beside a letter, and signs before one, as the letters they stand for."""
    text, start, end = found.string, found.start(), found.end()
    if end < len(text) and text[end].isalpha():
        return found.group().translate(_ANY)
    if start and text[start - 1].isalpha():
        return found.group().translate(_DIGITS)
    return found.group()


def fold(text: str) -> str:
    """Folded words, each between single spaces."""
    low = text.lower()
    if _ALIKE.search(low):
        low = low.translate(_FOLDED)
    return f" {' '.join(_WORD.findall(_RUN.sub(_as_letters, low)))} "


def features(folded: str) -> set[str]:
    """Whole words (` word `) and word beginnings (` begin`) of a folded text."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in PREFIXES if n <= len(word))
    return out


@dataclass(frozen=True)
class Model:
    """The lexicon's weights, exception phrases, and the curve's three coefficients."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float] | None


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0)) == 0


class Matcher:
    """The automaton over lexicon and exceptions, in one pass over a folded text."""

    def __init__(self, model: Model):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in model.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in model.exceptions:
            words = fold(phrase).rstrip()
            self.automaton.add_word(words, (len(words), None))
        self.filled = len(self.automaton) > 0
        if self.filled:
            self.automaton.make_automaton()

    def measure(self, text: str) -> tuple[float, int]:
        """(sum of weights, words). A match inside an exception phrase counts nothing."""
        folded = fold(text)
        found, excused = [], []
        for end, (length, weight) in self.automaton.iter(folded) if self.filled else ():
            if weight is None:
                excused.append((end - length + 1, end))
            else:
                found.append((end - length + 1, weight))
        if excused:
            found = [(at, w) for at, w in found
                     if not any(first <= at < last for first, last in excused)]
        return sum(w for _, w in found), folded.count(" ") - 1 if len(folded) > 2 else 0


def _points(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the curve sees: a constant, the weight, and the weight over the length."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), weight / np.maximum(words, 1)], axis=1)


def _fit_curve(weight: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a ridge of 1."""
    x, beta = _points(weight, words), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (toxic - p) - beta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.eye(3)
        step = np.linalg.solve(curvature, slope)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def scores(model: Model, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    if model.curve is None:
        return np.zeros(len(weight))
    return 1 / (1 + np.exp(-np.clip(_points(weight, words) @ np.array(model.curve), -30, 30)))


def _counts(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(feature, docs): in how many texts each feature, or each wanted one, occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                ["feature", "docs"])
            count.clear()
            return out

        for batch in slices(batches):
            for text in texts(batch):
                found = features(fold(text))
                count.update(found if wanted is None else found & wanted)
            if len(count) > HELD:
                yield emit()
        if count:
            yield emit()

    return (
        rows.select("text").mapInArrow(run, "feature string, docs long")
        .groupBy("feature").agg(F.sum("docs").alias("docs"))
    )


def _gain(toxic: int, other: int, n_toxic: int, n_other: int) -> float:
    """Log-likelihood ratio of a feature's share among toxic and other documents."""
    total = 0.0
    both = (toxic + other) / (n_toxic + n_other)
    for k, n in ((toxic, n_toxic), (other, n_other)):
        for seen, expected in ((k, n * both), (n - k, n * (1 - both))):
            total += seen * math.log(seen / expected) if seen else 0.0
    return 2 * total


def choose_lexicon(
    rows: list[tuple[str, int, int]], n_toxic: int, n_other: int
) -> dict[str, float]:
    """Entries and weights from (feature, toxic documents, other documents).

    Features must tell the kinds apart beyond what chance does among so many. From the strongest
    on, each is lengthened as far as it stays nearly as frequent, and covers what begins with it.
    """
    limit = 2 * math.log(100 * max(len(rows), 1))
    strong = {f: (t, o) for f, t, o in rows
              if t * n_other > 3 * o * n_toxic and _gain(t, o, n_toxic, n_other) > limit}
    order = sorted(strong, key=lambda f: (-_gain(*strong[f], n_toxic, n_other), len(f), f))
    longer: dict[str, list[str]] = {}
    for f in strong:
        for n in range(1 + PREFIXES[0], len(f)):
            longer.setdefault(f[:n], []).append(f)
    entries: dict[str, float] = {}
    for f in order:
        if len(entries) == MAX_ENTRIES:
            break
        if any(f[:n] in entries for n in range(1 + PREFIXES[0], len(f) + 1)):
            continue
        same = [g for g in longer.get(f, ())
                if strong[g][0] >= 0.95 * strong[f][0] and strong[g][1] <= strong[f][1]]
        best = max([f, *same], key=lambda g: (len(g), g))
        toxic, other = strong[best]
        entries[best] = math.log((toxic + 0.5) / n_toxic) - math.log((other + 0.5) / n_other)
    return entries


def fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Lexicon and curve from labelled documents that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sample = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED), "labelled")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most MAX_LABELLED rows of two numbers: a proven bound for the broadcast.
    train = source.join(F.broadcast(sample), "doc_id")
    sizes = dict(train.groupBy("toxic").count().collect())
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Model({}, exceptions, None)
    toxic = _counts(train.where("toxic = 1"), None).where("docs > 2").orderBy(
        F.col("docs").desc(), "feature").limit(MAX_CANDIDATES)
    in_toxic = dict(toxic.collect())
    in_other = dict(_counts(train.where("toxic = 0"), frozenset(in_toxic)).collect())
    rows = [(f, n, in_other.get(f, 0)) for f, n in in_toxic.items()]
    lexicon = Model(choose_lexicon(rows, n_toxic, n_other), exceptions, None)
    seen = np.array(_measured(train, lexicon, ["toxic"]).select("weight", "words", "toxic")
                    .collect(), dtype=float).reshape(-1, 3)
    return Model(lexicon.weights, exceptions, _fit_curve(seen[:, 0], seen[:, 1], seen[:, 2]))


def _measured(rows: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """The carried columns with (weight, words, score) of each row's whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            found = np.array([matcher.measure(t) for t in texts(batch)], dtype=float)
            score = scores(model, found[:, 0], found[:, 1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(found[:, 0]),
                 pa.array(found[:, 1].astype(np.int64)), pa.array(score)],
                [*carried, "weight", "words", "score"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), "weight double", "words long",
                        "score double"])
    return rows.select(*carried, "text").mapInArrow(run, schema)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, weight, words) of every row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _measured(source, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "weight", "words",
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` whose score stays below 0.5, as they are."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return _measured(rows, model, ["row"]).where("score < 0.5").select("row.*")
