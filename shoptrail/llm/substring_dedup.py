"""Substring deduplication by hashing of normalised lines and their sentences.

Texts are cut into units: lines, and sentences within them. A digest is that of the words in lower case.
The earliest occurrence of each digest stays (smallest doc_id, null last, then place in the text), later
ones are repeats. A line that repeats a whole line goes, whatever its length. Of sentences a run of adjacent
repeats goes if it has enough words; so a shared passage goes wherever it stands in a line, and a lone phrase
inside another line stays.

A sentence under the floor is hashed together with those after it in its line until they reach it (at the end
of a line with those before it), so passages of short sentences are found too. Very long sentences are cut into
pieces at places that depend on the nearest words only, so a passage from inside one is found by its pieces.

What stays: a passage that begins or ends inside a sentence goes from the first to the last cut it shares with
its earlier copy. In a sentence of MAX_UNIT_WORDS and more that leaves about ten words at an end, in a shorter
one the broken sentence, and all of the passage if under MIN_RUN_WORDS are left. Where a passage ends inside a
line, up to four words of short sentences behind its last longer one stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from shoptrail.llm.common import add_columns, cut_lineage, free_name, texts_of

#: A run of repeated sentences goes if it has this many words; lines that repeat as a whole need none.
MIN_RUN_WORDS = 25
#: Shorter units are hashed together with their neighbours.
MIN_UNIT_WORDS = 5
#: Sentences of so many words are cut into pieces, so that a passage from inside one is found.
MAX_UNIT_WORDS = 2 * MIN_RUN_WORDS
#: A piece ends behind the word whose hash is the least among so many words before and behind it.
REACH = 4
#: A digest with so many occurrences is looked up without a shuffle; there are no more such digests than that.
HOT, MOST_HOT = 100_000, 10_000
#: Stands for an id that is null or no number, which comes after all others.
LAST = (1 << 63) - 1
#: Seeds of the digests: lines meet lines only, sentences meet sentences and lines of one sentence.
SENTENCE, LINE = 0, 1

#: Scripts without blanks: two Han or kana, four South-East Asian characters count as a word.
_HAN, _THAI = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff", "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_CLOSED = re.compile(f"[{_HAN}{_THAI}]")
_IN_HAN, _IN_THAI = re.compile(f"[{_HAN}]"), re.compile(f"[{_THAI}]")
_UNIT = re.compile(r"[^\n]*?(?:[.!?\u0964\u0965\u061f\u06d4]+(?=[ \t\n]|\Z)[ \t]*|\n|\Z)", re.S)
#: Where such scripts occur, their end marks need no blank, and South-East Asian phrases end at blanks.
_CLOSED_UNIT = re.compile(
    rf"[^\n]*?(?:[.!?\u0964\u0965\u061f\u06d4]+(?=[ \t\n]|\Z)[ \t]*|[\u3002\uff01\uff1f\uff61\u104b\u17d4]+[\u300d\u300f\u201d\u2019\uff09)]*[ \t\u3000]*|(?<=[{_THAI}])[ \t]+|\n|\Z)",
    re.S,
)
_BLANK = re.compile(r"[\x20\x09-\x0D]+")
_WORD = re.compile(rf"[{_HAN}{_THAI}]|[^\x20\x09-\x0D{_HAN}{_THAI}]+")

#: (start, end, words, normalised words) of a unit; (first unit, last unit, seed) of what is hashed.
Unit = tuple[int, int, int, str]
Span = tuple[int, int, int]


def _unit(value: str, start: int, end: int, closed: bool) -> Unit:
    part = value[start:end]
    words = [w for w in _BLANK.split(part) if w]
    n = len(words)
    if closed:
        n += len(_IN_HAN.findall(part)) // 2 + len(_IN_THAI.findall(part)) // 4
    return start, end, n, " ".join(words).lower()


def _pieces(value: str, start: int, end: int) -> list[int]:
    """Ends of the pieces of a long sentence. No cut looks at more than its own neighbourhood, so copies of a
    passage are cut alike whatever stands around them."""
    words = list(_WORD.finditer(value, start, end))
    low = [w.group().lower() for w in words]
    hashes = [xxhash.xxh32_intdigest(f"{a} {b}") for a, b in zip(low, low[1:])]
    found = []
    for i, word in enumerate(low):
        reach = REACH * (2 if _IN_HAN.match(word) else 4 if _IN_THAI.match(word) else 1)
        if i < reach or i + reach >= len(hashes):
            continue
        around = hashes[i - reach : i + reach + 1]
        if hashes[i] == min(around) and around.count(hashes[i]) == 1:
            at = words[i + 1].start()
            if not unicodedata.category(value[at]).startswith("M"):
                found.append(at)
    return [*found, end]


def units(text: str | None) -> list[Unit]:
    """Units of a text, without gaps.

    A unit ends behind the end mark of a sentence and the blanks after it, or behind a line break.
    """
    found, at, value = [], 0, text or ""
    closed = not value.isascii() and _CLOSED.search(value) is not None
    for match in (_CLOSED_UNIT if closed else _UNIT).finditer(value):
        if match.end() == at:
            continue
        unit = _unit(value, at, match.end(), closed)
        if unit[2] < MAX_UNIT_WORDS:
            found.append(unit)
        else:
            for end in _pieces(value, at, match.end()):
                found.append(_unit(value, at, end, closed))
                at = end
        at = match.end()
    return found


def _within(parts: list[Unit], begin: int, end: int) -> list[Span]:
    """Sentences of one line (units ``begin`` to ``end``) that are hashed, short ones with their neighbours."""
    line = [k for k in range(begin, end + 1) if parts[k][2]]
    found, taken = [], set()
    for i, first in enumerate(line):
        for way in (1, -1):
            n, j = 0, i
            while 0 <= j < len(line) and n < MIN_UNIT_WORDS:
                n += parts[line[j]][2]
                j += way
            span = (first, line[j - 1]) if way > 0 else (line[j + 1], first)
            if n >= MIN_UNIT_WORDS:
                if span not in taken:
                    taken.add(span)
                    found.append((*span, SENTENCE))
                break
    return found


def spans(parts: list[Unit], text: str | None) -> list[Span]:
    """What is hashed: each line that has words, with its line break, and the sentences in it."""
    found, begin = [], 0
    for i, (_, end, _, _) in enumerate(parts):
        if text[end - 1] == "\n" or i + 1 == len(parts):
            if any(parts[k][2] for k in range(begin, i + 1)):
                found.append((begin, i, LINE))
                found += _within(parts, begin, i)
            begin = i + 1
    # In the order of the text, so that of equal spans in one text the earliest stays.
    return sorted(found)


def digest(parts: list[Unit], span: Span) -> bytes:
    first, last, seed = span
    return xxhash.xxh3_128_digest(" ".join(parts[k][3] for k in range(first, last + 1) if parts[k][2]), seed)


def cuts(parts: list[Unit], hashed: list[Span], repeats: Iterable[int], min_words: int = MIN_RUN_WORDS) -> list[tuple[int, int]]:
    """Offsets (start, end) of what goes: repeated lines, and runs of repeated units that have at least
    ``min_words`` words. Blank units between two that go, go too."""
    again, gone = [False] * len(parts), [False] * len(parts)
    for place in repeats:
        first, last, seed = hashed[place]
        for i in range(first, last + 1):
            again[i] = True
            gone[i] |= seed == LINE
    begin, last, words = None, 0, 0

    def close() -> None:
        if begin is not None and words >= min_words:
            gone[begin : last + 1] = [True] * (last + 1 - begin)

    for i, (_, _, n, _) in enumerate(parts):
        if again[i]:
            if begin is None:
                begin, words = i, 0
            words, last = words + n, i
        elif n:
            close()
            begin = None
    close()
    found, blank = [], False
    for (start, end, n, _), goes in zip(parts, gone):
        if goes and found and (blank or found[-1][1] == start):
            found[-1] = (found[-1][0], end)
        elif goes:
            found.append((start, end))
        blank = bool(found) and (goes or (blank and n == 0))
    return found


def _digests() -> Callable:
    """Digests of a text's spans in order, 16 bytes each, and its number of units."""

    def run(column: pa.Array) -> tuple[list, list]:
        found, counts = [], []
        for value in texts_of(column):
            parts = units(value)
            found.append(b"".join(digest(parts, span) for span in spans(parts, value)))
            counts.append(len(parts))
        return found, counts

    return run


def _rewrite(min_words: int) -> Callable[[], Callable]:
    """Texts without their repeats; only texts that have some are cut again."""

    def run(values: pa.Array, places: pa.Array) -> tuple[list, list, list]:
        texts, counts, removed = texts_of(values), [], []
        for i, repeats in enumerate(places.to_pylist()):
            cut: list[tuple[int, int]] = []
            if repeats:
                value = texts[i]
                parts = units(value)
                cut = cuts(parts, spans(parts, value), repeats, min_words)
                at, left = 0, []
                for start, end in cut:
                    left.append(value[at:start])
                    at = end
                if cut:
                    texts[i] = "".join([*left, value[at:]])
            counts.append(sum(end - start for start, end in cut))
            removed.append([{"start": start, "end": end} for start, end in cut])
        return texts, counts, removed

    return lambda: run


def _repeats(hashed: DataFrame, key: list[str]) -> DataFrame:
    """(key, places): the spans of each document that an earlier place has.

    ``hashed`` is (key, digests, n_units). Digests that occur ``HOT`` times and more, at most ``MOST_HOT`` of
    them, are looked up where they are; so a line of a third of all documents is moved to no single task.
    """
    last = (F.length("digests") / 16).cast("int") - 1
    spot = F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.substring("digests", i * 16 + 1, F.lit(16))))
    rows = hashed.where(F.length("digests") > 0).select(*key, spot.alias("place", "d"))
    number = [F.coalesce(F.expr("try_cast(id AS bigint)"), F.lit(LAST))] if "none" in key else []
    order = F.struct(*[x for name in key for x in ([*number, F.col(name)] if name == "id" else [F.col(name)])], "place")
    first = cut_lineage(rows.groupBy("d").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1"))
    total = first.agg(F.sum("n")).first()[0] or 0
    most = max(HOT, total // MOST_HOT)
    hot, cold = first.where(F.col("n") >= most).select("d", "first"), first.where(F.col("n") < most).select("d", "first")
    met = rows.join(cold, "d")
    if hot.limit(1).count():
        met = met.unionByName(rows.join(F.broadcast(hot), "d"))
    return met.where(order != F.col("first")).groupBy(*key).agg(F.collect_set("place").alias("places"))


def deduplicate(docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_words: int = MIN_RUN_WORDS) -> DataFrame:
    """Rows of ``docs`` with repeated passages taken out of ``text``, and with ``n_units``,
    ``n_removed`` (characters) and ``removed`` (array of start and end in the original text, in
    code points).

    All rows stay, emptied ones too; a null text stays null. Repeated rows (same id, same text) are one
    document: each is rewritten alike. Ids order as numbers where they are numbers, else as text, null last. Columns
    of ``docs`` with the added names are replaced; other columns, whatever their names, stay what they are.

    Texts are cut and hashed once; the digests are kept by a checkpoint. They are counted with map-side combination, so a
    line of every document is one row per task. Only digests that occur twice or more go on. Texts are shuffled once, to
    meet their repeats.
    """
    kept = docs.drop("n_units", "n_removed", "removed")
    digest_of = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    if isinstance(kept.schema[id_column].dataType, IntegralType):
        key = {"id": F.coalesce(F.col(id_column).cast("bigint"), F.lit(LAST)), "hash": digest_of}
    else:
        key = {"none": F.col(id_column).isNull(), "id": F.coalesce(F.col(id_column).cast("string"), F.lit("")), "hash": digest_of}
    names = {name: free_name(kept, name) for name in ("none", "id", "hash", "places")}
    narrow = kept.select(*[expr.alias(name) for name, expr in key.items()], F.col(text).alias("text"))
    adds = {"digests": ("binary", pa.binary()), "n_units": ("bigint", pa.int64())}
    hashed = cut_lineage(add_columns(narrow, ["text"], adds, _digests, drops=("text",)))
    of_each = hashed.groupBy(*key).agg(F.first("n_units").alias("n_units")).join(_repeats(hashed, list(key)), list(key), "left")
    of_each = of_each.withColumnsRenamed(names)
    joined = kept.select("*", *[expr.alias(names[name]) for name, expr in key.items()]).join(of_each, [names[name] for name in key])
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    made = {
        text: ("string", pa.string()), "n_removed": ("bigint", pa.int64()),
        "removed": ("array<struct<start: bigint, end: bigint>>", spans_type),
    }
    rewritten = add_columns(joined, [text, names["places"]], made, _rewrite(min_words), drops=tuple(names.values()))
    return rewritten.select(*kept.columns, "n_units", "n_removed", "removed")
