"""Language identification of mixed texts: Viterbi over per-word scores.

A word's scores are log probabilities of its character trigrams under each language, learned from
labelled texts. The scripts of a text's letters narrow its candidates; Viterbi with a penalty for
switching then labels each word, and so the spans of a text that mixes languages.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from shoptrail.llm.common import add_columns, free_name, id_remainder, slices, texts_of

UNKNOWN = "und"
#: Learning takes at most this many documents of each language, by digests, and reads them whole.
TEXTS_PER_LANGUAGE = 1_000
#: Parts of the range of digests whose sizes are counted to find where a language's sample ends.
DIGEST_PARTS = 1 << 16
#: Languages that a model may have, those with most documents; others are not learned (a column of dirty values has millions).
MOST_LANGUAGES = 256
#: Cost in nats of labelling a word differently from the one before it.
SWITCH_PENALTY = 4.0
#: Trigrams are hashed into this many cells.
CELLS = 1 << 15
#: Words whose scores a worker remembers at a time.
MAX_WORDS = 300_000
#: Words that are labelled side by side.
BATCH_WORDS = 1_000_000

#: Letters, with the marks that stand on them; numerals such as Roman or circled ones are none.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: First and last code point of blocks by script; other letters are "Other".
SCRIPTS = (
    ("Latin", 0x0041, 0x024F), ("Greek", 0x0370, 0x03FF), ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x06FF),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0xAC00, 0xD7AF), ("Kana", 0x3040, 0x30FF),
    ("Han", 0x4E00, 0x9FFF), ("Latin", 0x1E00, 0x1EFF),
)


def script_of(letter: str) -> str:
    code = ord(letter)
    return next((name for name, low, high in SCRIPTS if low <= code <= high), "Other")


def _cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the words' trigrams, with a mark on both sides of a word, and where each word's begin. One
    trigram is centred on each letter; cells are the same in every process."""
    lower = [word.lower() for word in words]
    codes = np.frombuffer(("\2" + "\3\2".join(lower) + "\3").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.int64)
    cells = (codes[:-2] * 1_000_003 + codes[1:-1] * 8_191 + codes[2:] * 131) % CELLS
    begins = np.cumsum([0, *map(len, lower)])[:-1]
    return cells[codes[1:-1] > 3], begins


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # CELLS x languages, log probabilities
    scripts: dict[str, list[int]]  # languages seen in each script


def learn(
    labelled: DataFrame, text: str = "text", lang: str = "lang", id_column: str | None = None, per_language: int = TEXTS_PER_LANGUAGE
) -> Model:
    """Fit the trigram model on rows with non-null language and text.

    Takes a bounded sample per language (``per_language`` rows), by digests of ids or else of texts. Counts of ``DIGEST_PARTS`` parts of the ids'
    digests say first up to which part a language has enough, so few texts beyond the sample are moved. The
    ``MOST_LANGUAGES`` languages with most documents are learned.
    Trigrams are counted in tasks and only sums per (language, cell) reach the driver, at most ``CELLS``
    per language.
    """
    digest = F.xxhash64(F.col(id_column or text))
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), digest.alias("digest"),
        F.pmod(digest, F.lit(DIGEST_PARTS)).alias("part"),
    )
    sizes = usable.groupBy("lang", "part").agg(F.count("*").alias("n"))
    common = sizes.groupBy("lang").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "lang").limit(MOST_LANGUAGES).select("lang")
    sizes = sizes.join(F.broadcast(common), "lang")  # 256 rows at most
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    ends = sizes.withColumn("before", before).where(F.col("before") < per_language).groupBy("lang").agg(F.max("part").alias("last"))
    # One row per language, ``MOST_LANGUAGES`` at most.
    few = usable.join(F.broadcast(ends), "lang").where("part <= last")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("part", "digest", "text"))
    sample = few.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        seen: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for language, texts in batch.groupby("lang")["text"]:
                found = Counter(word for value in texts for word in _LETTERS.findall(value))
                if not found:
                    continue
                cells, begins = _cells(list(found))
                times = np.repeat(np.fromiter(found.values(), np.int64), np.diff(np.append(begins, len(cells))))
                sums[language] = sums.get(language, 0) + np.bincount(cells, weights=times, minlength=CELLS)
                for word, n in found.items():
                    seen[language, script_of(word[0])] += n
        rows = [(language, "", int(i), int(n[i])) for language, n in sums.items() for i in np.flatnonzero(n)]
        rows += [(language, script, -1, n) for (language, script), n in seen.items()]
        yield pd.DataFrame(rows, columns=["lang", "script", "cell", "n"])

    counted = sample.mapInPandas(count, "lang string, script string, cell int, n bigint")
    counted = counted.groupBy("lang", "script", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    place = {language: i for i, language in enumerate(languages)}
    counts = np.full((CELLS, len(languages)), 0.5)
    grams = counted[counted["cell"] >= 0]
    counts[grams["cell"], grams["lang"].map(place)] += grams["n"]
    scripts: dict[str, list[int]] = {}
    words = counted[counted["cell"] < 0]
    total = words.groupby("lang")["n"].sum()
    for language, script, n in words[["lang", "script", "n"]].itertuples(index=False):
        if n >= 0.01 * total[language]:
            scripts.setdefault(script, []).append(place[language])
    scores = np.log(counts / counts.sum(axis=0)) if languages else np.zeros((CELLS, 0))
    return Model(languages, scores.astype(np.float32), {k: sorted(v) for k, v in scripts.items()})


class _Scores(dict):
    """Number of each word in a growing table of scores."""

    def __init__(self, model: Model):
        self.model, self.table = model, np.zeros((0, len(model.languages)), np.float32)
        self.allowed: dict[str, np.ndarray] = {}

    def _candidates(self, letter: str) -> np.ndarray:
        """Which languages a word that begins so may have: those of its script, or all if it has none."""
        found = self.allowed.get(letter)
        if found is None:
            found = np.zeros(len(self.model.languages), bool)
            found[self.model.scripts.get(script_of(letter), slice(None))] = True
            self.allowed[letter] = found
        return found

    def of(self, texts: list[list[str]]) -> np.ndarray:
        """Scores of all words of the texts in order; words that are not known yet are scored together."""
        if len(self) > MAX_WORDS:
            self.clear()
            self.table = self.table[:0]
        new = list({word for words in texts for word in words} - self.keys())
        if new:
            cells, begins = _cells(new)
            sizes = np.diff(np.append(begins, len(cells)))
            weight = np.minimum(np.fromiter(map(len, new), np.int64, len(new)), 8) / sizes
            found = np.add.reduceat(self.model.scores[cells], begins, axis=0) * weight[:, None].astype(np.float32)
            allowed = np.stack([self._candidates(word[0]) for word in new])
            found = np.where(allowed, found, found.min(axis=1, keepdims=True) - 50)
            self.update(zip(new, range(len(self), len(self) + len(new))))
            self.table = np.concatenate([self.table, found])
        return self.table[[n for words in texts for n in map(self.__getitem__, words)]]


def viterbi(scores: np.ndarray, begins: np.ndarray, ends: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each row of ``scores``; texts take the rows from ``begins`` to ``ends``.

    All texts advance by one word at a time, longest first, so a step is one operation on the texts
    that still have words. Ties go to staying, then to the first language.
    """
    order = np.argsort(begins - ends, kind="stable")
    begin, size = begins[order], (ends - begins)[order]
    longest = int(size[0]) if len(size) else 0
    came = np.zeros(len(scores), np.uint16)  # label switched from, best before
    switched = np.zeros(scores.shape, bool)
    labels = np.zeros(len(scores), np.uint16)
    best = scores[begin[size > 0]].copy() if longest else scores[:0]
    active = np.searchsorted(-size, -np.arange(longest + 1), side="left")  # texts longer than a step
    finals = np.zeros(len(size), np.int64)
    for step in range(1, longest):
        n = active[step]
        if n < len(best):
            finals[n : len(best)] = best[n:].argmax(axis=1)
            best = best[:n]
        rows = begin[:n] + step
        top = best.argmax(axis=1)
        high = best[np.arange(n), top][:, None] - penalty
        leave = high > best
        came[rows] = top
        switched[rows] = leave
        best = np.where(leave, high, best) + scores[rows]
    finals[: len(best)] = best.argmax(axis=1) if len(best) else 0
    now = finals.copy()
    for step in range(longest - 1, -1, -1):
        n = active[step] if step else int((size > 0).sum())
        rows = begin[:n] + step
        label = now[:n]
        labels[rows] = label
        now[:n] = np.where(switched[rows, label], came[rows], label)
    return labels


def _label(model: Model, work: _Scores, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words and labels of each text, in order, worked on in groups of texts."""
    group, size = [], 0

    def flush() -> Iterator[tuple[list[str], np.ndarray]]:
        ends = np.cumsum([len(w) for w in group])
        labels = viterbi(work.of(group), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
        for words, end in zip(group, ends):
            yield words, labels[end - len(words) : end]

    for value in texts:
        words = _LETTERS.findall(value or "")
        if group and size + len(words) > BATCH_WORDS:
            yield from flush()
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield from flush()


def predict(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) for each row: the language with most letters, and its share of them.

    ``und`` with score 0 for null texts, texts without a letter, and all texts if nothing was learned.
    Ties go to the first language in order. Each row is judged alone, in whole; no shuffle. The model is
    broadcast: ``CELLS`` numbers per language.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        held = sent.value
        work = _Scores(held)

        def labelled(column: pa.Array) -> tuple[list[str], list[float]]:
            names, scores = [], []
            texts = texts_of(column)
            for words, labels in _label(held, work, texts) if held.languages else (([], None) for _ in texts):
                if not words:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                letters = np.bincount(labels, weights=np.fromiter(map(len, words), np.float64, len(words)), minlength=len(held.languages))
                at = int(letters.argmax())
                names.append(held.languages[at])
                scores.append(float(letters[at] / letters.sum()))
            return names, scores

        return labelled

    narrow = docs.select(F.col(id_column), F.col(text).alias(free_name(docs, "text_")))
    adds = {"lang_pred": ("string", pa.string()), "score": ("double", pa.float64())}
    return add_columns(narrow, [narrow.columns[1]], adds, make, rows=1_024, drops=(narrow.columns[1],))


def spans(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, start, end, lang) of each span of one language, as code point offsets of its first letter
    and behind its last. Texts without letters have no spans."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        work = _Scores(held)
        for part in slices(batches, 1_024) if held.languages else ():
            texts, rows, found = texts_of(part.column(1)), [], []
            for i, (value, (words, labels)) in enumerate(zip(texts, _label(held, work, texts))):
                last = None
                for match, label in zip(_LETTERS.finditer(value or ""), labels):
                    if last is not None and last[2] == held.languages[label]:
                        last[1] = match.end()
                    else:
                        last = [match.start(), match.end(), held.languages[label]]
                        rows.append(i)
                        found.append(last)
            columns = list(zip(*found)) if found else [(), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[id_column, "start", "end", "lang"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column), F.col(text).alias(free_name(docs, "text_")))
    return narrow.mapInArrow(run, f"`{id_column}` {kind}, start bigint, end bigint, lang string")


def identify(docs: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """Learn from documents outside the held-out fold and predict all:
    (doc_id, held_out, lang_pred, score)."""
    fold = id_remainder("doc_id", parts) == held_out
    model = learn(docs.where(~fold), id_column="doc_id")
    predicted = predict(docs, model)
    return predicted.select("doc_id", (id_remainder("doc_id", parts) == held_out).alias("held_out"), "lang_pred", "score")
