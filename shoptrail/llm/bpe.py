"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

The merges are compiled into a finite-state transducer over bytes. Two facts make that possible:

* a sequence of tokens is the BPE encoding of its bytes exactly if each two neighbours are the
  encoding of their joint bytes (no merge crosses the seam before both are complete);
* so each prefix of the input has one last token: the longest vocabulary entry that ends there and
  goes with the last token of what stands before it.

A state is the last token that was given out and the bytes after it. A byte leads to a state that is
worked out the first time it is needed and looked up from then on. A token is given out as soon as
every place where a token reaching beyond the input read so far could start has it on its path. That
takes at most as many bytes of lookahead as the longest vocabulary entry has. Where the table is full and
a piece leaves the part of the transducer that is known, its rest is worked out by the same two facts without keeping states.

The new pieces of a group of texts take their moves side by side, a byte of each at a time, as arrays. A move that many of
them miss is worked out; those that leave the known part have their rests worked out side by side, too.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from shoptrail.llm.common import add_columns, free_name, texts_of

#: Tables only save time, so they are bounded: moves, answers about neighbours, states whose inner side is at hand, and words
#: of each of two generations. A full table of moves stays as long as it serves most pieces: it is forgotten when, over as many
#: missing moves as it may hold, more pieces left it than were encoded by it alone.
MAX_MOVES = 250_000
MAX_FITS = 200_000
MAX_PATHS = 20_000
MAX_WORDS = 250_000
#: Characters of a word that is kept.
MAX_KEPT = 64
#: A move is one number: the next state, and behind it which tokens are given out.
_GIVEN_BITS = 24
_GIVEN = (1 << _GIVEN_BITS) - 1
#: Marks that end a word often and are a piece of their own behind letters.
MARKS = (",", ".")
#: Runs of letters alone are one piece.
LATIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
INNER_SPACE = re.compile(r"\s (?:\s|\Z)").search
#: Bytes of a piece that is worked on side by side with others: places in it are bits of a number.
MAX_BESIDE = 60
#: Characters of the texts that are worked on together.
GROUP_CHARS = 1 << 22
#: Texts that a task holds at a time where nothing but ids is made of them: what many of them share is looked up once.
GROUP_ROWS = 1_024
#: Pieces of a group that have to miss a move for it to be worked out.
LEARN_FROM = 8
#: Ids that the decoder takes at a time.
DECODE_STEP = 65_536


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Rank file: a line holds a token in base64 and its rank."""
    rows = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in rows}


class MergeTransducer:
    """Encodes one piece of pre-split text, byte by byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        opens = {token[:n] for token in ranks for n in range(1, len(token))}
        # What a run of bytes is: twice its rank, plus one if a longer token begins so; -1 if it is no token itself.
        self.kinds = {token: rank << 1 | (token in opens) for token, rank in ranks.items()}
        self.kinds.update((part, -1) for part in opens if part not in ranks)
        self.spines: tuple[dict, dict] = ({}, {})
        self.fits: dict[int, bool] = {}
        self._forget()
        self._plant()

    def _plant(self) -> None:
        """The vocabulary as a tree in arrays: the node that a byte leads to from a node (0: none, 1: the root; a row for
        each node that goes on, its last column for the end of a piece), the token at each node, and of each token its
        length and the longest other token it begins with (-1: none)."""
        inner = sorted((part for part, kind in self.kinds.items() if kind & 1), key=len)
        leaves = (part for part, kind in self.kinds.items() if not kind & 1)
        node = {b"": 1} | {part: i for i, part in enumerate([*inner, *leaves], 2)}
        self.inner = len(inner) + 2
        self.tree = np.zeros((self.inner, 257), np.int32)
        self.token_at = np.full(len(node) + 1, -1, np.int64)
        self.length, self.shorter = np.zeros(max(self.token) + 1, np.int64), np.full(max(self.token) + 1, -1, np.int64)
        within = {b"": -1}
        for part in sorted(node, key=len)[1:]:
            before, rank = within[part[:-1]], self.ranks.get(part, -1)
            self.tree[node[part[:-1]], part[-1]] = node[part]
            within[part] = before if rank < 0 else rank
            if rank >= 0:
                self.token_at[node[part]], self.length[rank], self.shorter[rank] = rank, len(part), before
        # Answers about neighbours, in the order of their names.
        self.seams, self.seams_fit = np.asarray([(1 << 62)]), np.asarray([False])

    def _forget(self) -> None:
        # A state is named by the token given out last and the bytes after it; the rest follows from these.
        self.known: dict[tuple[int, bytes], int] = {}
        self.names: list[tuple[int, bytes]] = []
        self.paths: dict[int, tuple[list[int], list[int], list[int]]] = {}
        self.moves: dict[int, int] = {}
        self.given: list[bytes] = [b""]
        self.number: dict[bytes, int] = {b"": 0}
        self.rest: dict[int, bytes] = {}
        self.missed = self.walked = 0
        self.start = self._state(b"", [-1], [1], [0])
        self.from_moves, self.to_moves = np.asarray([1 << 62]), np.asarray([0])

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge completes a token; None for a single byte."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            at = pairs.index(min(pairs))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _spine(self, side: int, rank: int) -> list[tuple[bytes, int]]:
        """What stands at a token's right (0) or left (1) end while it is put together, last form
        first, each with the rank at which it is taken up into the next form."""
        ends = self.token[rank]
        found = [(ends, 1 << 60)]
        while halves := self._halves(ends):
            found.append((halves[1 - side], self.ranks[ends]))
            ends = halves[1 - side]
        self.spines[side][rank] = found
        return found

    def _fit(self, left: int, right: int) -> bool:
        """No merge crosses the seam between the two tokens."""
        if left < 0:
            return True
        name = left << 20 | right
        found = self.fits.get(name)
        if found is None:
            if len(self.fits) >= MAX_FITS:
                self.fits.clear()
            found = self.fits[name] = self._seam(left, right)
        return found

    def _seam(self, left: int, right: int) -> bool:
        """Of merges with the same rank, the one further left comes first."""
        rank, ends = self.ranks.get, self.spines[0].get(left) or self._spine(0, left)
        for b, until_b in self.spines[1].get(right) or self._spine(1, right):
            for a, until_a in ends:
                merged = rank(a + b)
                if merged is not None and merged < until_a and merged <= until_b:
                    return False
        return True

    def _state(self, pending: bytes, last: list[int], marks: list[int], live: list[int]) -> int:
        """``last[i]`` is the last token of what was read up to byte ``i`` of ``pending``, the first
        of them the token given out last; ``marks[i]`` has a bit for each token end on the way there;
        at the ``live`` places a token that reaches beyond ``pending`` may start."""
        # Where no token can start right behind the one given out, that one is of no account.
        name = (-1 if live[0] else last[0], pending)
        state = self.known.get(name)
        if state is None:
            state = self.known[name] = len(self.names)
            self.names.append((last[0], pending))
            if len(self.paths) >= MAX_PATHS:
                self.paths.clear()
            self.paths[state] = last, marks, live
        return state

    def _path(self, state: int) -> tuple[list[int], list[int], list[int]]:
        """The inner side of a state, worked out from its name where it is not at hand."""
        path = self.paths.get(state)
        if path is None:
            left, pending = self.names[state]
            path = [left], [1], [0]
            for end in range(1, len(pending) + 1):
                path = self._read(pending[:end], *path)
            if len(self.paths) >= MAX_PATHS:
                self.paths.clear()
            self.paths[state] = path
        return path

    def _read(self, pending: bytes, last: list[int], marks: list[int], live: list[int]) -> tuple[list[int], list[int], list[int]]:
        """The inner side with the last byte of ``pending`` read."""
        end, kinds, still, rank, mark = len(pending), self.kinds, [], -1, 0
        for begin in live:
            kind = kinds.get(pending[begin:])
            if kind is None:
                continue
            if rank < 0 and kind >= 0 and self._fit(last[begin], kind >> 1):
                rank, mark = kind >> 1, marks[begin] | 1 << end
            if kind & 1:
                still.append(begin)
        if rank >= 0:  # else no path from the token given out last comes by here
            still.append(end)
        return [*last, rank], [*marks, mark], still

    def _tokens(self, last: list[int], end: int) -> bytes:
        path = []
        while end > 0:
            path.append(last[end])
            end -= len(self.token[last[end]])
        return struct.pack(f"<{len(path)}I", *reversed(path))

    def _move(self, state: int, byte: int) -> int:
        pending = self.names[state][1] + bytes((byte,))
        last, marks, live = self._read(pending, *self._path(state))
        mark = marks[-1]
        for place in live:  # what all paths that can still be taken run through
            mark &= marks[place]
        cut = mark.bit_length() - 1
        given = b""
        if cut > 0:
            given = self._tokens(last, cut)
            pending, last = pending[cut:], last[cut:]
            marks, live = [m >> cut for m in marks[cut:]], [p - cut for p in live]
        number = self.number.get(given)
        if number is None:
            number = self.number[given] = len(self.given)
            self.given.append(given)
        found = self.moves[state << 8 | byte] = self._state(pending, last, marks, live) << _GIVEN_BITS | number
        return found

    def _finish(self, before: int, data: bytes) -> bytes:
        """Tokens of the bytes behind the token ``before``, without new states.

        Longest tokens are tried first, each only where it goes with the one before it. As a prefix has one last
        token, a place that led nowhere is not tried again.
        """
        kinds, fit = self.kinds.get, self._fit
        size, at, left = len(data), 0, before
        path: list[int] = []
        waiting: list[list[tuple[int, int]]] = []  # at each token of the path: (end, rank) of shorter ones
        dead: set[int] = set()
        ends: list[tuple[int, int]] | None = None
        while at < size:
            if ends is None:
                ends, end = [], at
                while end < size:
                    end += 1
                    kind = kinds(data[at:end])
                    if kind is None:
                        break
                    if kind >= 0:
                        ends.append((end, kind >> 1))
                        if not kind & 1:
                            break
            while ends:
                end, rank = ends.pop()
                if end not in dead and fit(left, rank):
                    path.append(rank)
                    waiting.append(ends)
                    at, left, ends = end, rank, None
                    break
            else:
                dead.add(at)
                ends = waiting.pop()
                at -= len(self.token[path.pop()])
                left = path[-1] if path else before
        return struct.pack(f"<{len(path)}I", *path)

    def encode(self, piece: bytes) -> bytes:
        """Ids of a piece as little-endian unsigned 32-bit integers."""
        state, move_of, given, out = self.start, self.moves.get, self.given, b""
        self.walked += 1
        for at, byte in enumerate(piece):
            move = move_of(state << 8 | byte)
            if move is None:
                if len(self.moves) >= MAX_MOVES:
                    self.missed += 1
                    before, pending = self.names[state]
                    out += self._finish(before, pending + piece[at:])
                    if self.missed >= MAX_MOVES:
                        if 2 * self.missed > self.walked:
                            self._forget()
                        self.missed = self.walked = 0
                    return out
                move = self._move(state, byte)
            if move & _GIVEN:
                out += given[move & _GIVEN]
            state = move >> _GIVEN_BITS
        left = self.rest.get(state)
        if left is None:
            left = self.rest[state] = self._tokens(self._path(state)[0], len(self.names[state][1]))
        return out + left

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """``encode`` of each piece, short ones side by side."""
        out = [b""] * len(pieces)
        short = [i for i, piece in enumerate(pieces) if len(piece) <= MAX_BESIDE]
        for i, piece in enumerate(pieces):
            if len(piece) > MAX_BESIDE:
                out[i] = self.encode(piece)
        if not short:
            return out
        if len(self.moves) >= len(self.from_moves):
            self.from_moves = np.fromiter(self.moves.keys(), np.int64, len(self.moves))
            order = np.argsort(self.from_moves)
            self.to_moves = np.append(np.fromiter(self.moves.values(), np.int64, len(self.moves))[order], 0)
            self.from_moves = np.append(self.from_moves[order], 1 << 62)
        data = b"".join(pieces[i] for i in short)
        sizes = np.fromiter((len(pieces[i]) for i in short), np.int64, len(short))
        begins, states, at = np.cumsum(sizes) - sizes, np.full(len(short), self.start), np.zeros(len(short), np.int64)
        text, active, missing = np.frombuffer(data, np.uint8), np.arange(len(short)), []
        self.walked += len(short)
        while len(active):
            names = states[active] << 8 | text[begins[active] + at[active]]
            places = np.searchsorted(self.from_moves, names)
            known = self.from_moves[places] == names
            missing.append(names[~known])
            active, moves = active[known], self.to_moves[places[known]]
            states[active] = moves >> _GIVEN_BITS
            at[active] += 1
            gives = np.flatnonzero(moves & _GIVEN)
            for i, number in zip(active[gives].tolist(), (moves[gives] & _GIVEN).tolist()):
                out[short[i]] += self.given[number]
            active = active[at[active] < sizes[active]]
        rests: list[tuple[int, int, bytes]] = []  # place, token before, bytes behind it
        for i, state, done in zip(short, states.tolist(), at.tolist()):
            piece = pieces[i]
            left = self.rest.get(state) if done == len(piece) else None
            if left is None:
                before, pending = self.names[state]
                rests.append((i, before, pending + piece[done:]))
            else:
                out[i] += left
        found = self._finish_all([x[1] for x in rests], [x[2] for x in rests])
        for (i, _, _), ids in zip(rests, found):
            out[i] += ids
        self._learn(np.concatenate(missing))
        return out

    def _learn(self, missing: np.ndarray) -> None:
        """Moves that many pieces missed are worked out, as long as the table has room."""
        room = MAX_MOVES - len(self.moves)
        if room > 0:
            names, times = np.unique(missing, return_counts=True)
            for name in names[times >= LEARN_FROM][:room].tolist():
                self._move(name >> 8, name & 255)
            return
        self.missed += len(missing)
        if self.missed >= MAX_MOVES:
            if 2 * self.missed > self.walked:
                self._forget()
            self.missed = self.walked = 0

    def _fit_all(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """``_fit`` of each pair."""
        names = np.where(lefts < 0, -1, lefts << 20 | rights)
        places = np.searchsorted(self.seams, names)
        known = (self.seams[places] == names) | (names < 0)
        if not known.all():
            if len(self.seams) >= MAX_FITS:
                self.seams, self.seams_fit = self.seams[-1:], self.seams_fit[-1:]
                known = names < 0
            new = np.unique(names[~known])
            fit = np.fromiter((self._seam(x >> 20, x & 0xFFFFF) for x in new.tolist()), bool, len(new))
            places = np.searchsorted(self.seams, new)
            self.seams, self.seams_fit = np.insert(self.seams, places, new), np.insert(self.seams_fit, places, fit)
            places = np.searchsorted(self.seams, names)
        return self.seams_fit[places] | (names < 0)

    def _finish_all(self, befores: list[int], pieces: list[bytes]) -> list[bytes]:
        """``_finish`` of each piece behind the token before it, a token of each at a time."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        width = int(sizes.max(initial=0))
        text = np.full((n, width + 1), 256, np.int64)
        text[np.arange(width + 1) < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        before = np.asarray(befores, np.int64)
        left, rank = before.copy(), np.full(n, -2)  # -2: to be looked for
        at, depth, dead, path = (np.zeros(shape, np.int64) for shape in (n, n, n, (n, width + 1)))
        active = np.flatnonzero(sizes)
        while len(active):
            some = active[rank[active] == -2]
            rank[some] = -1
            node, place = np.ones(len(some), np.int64), at[some]
            while len(some):
                node = self.tree[node, text[some, place]]
                token = self.token_at[node]
                rank[some[token >= 0]] = token[token >= 0]
                goes = (node > 0) & (node < self.inner)
                some, node, place = some[goes], node[goes], place[goes] + 1
            none = rank[active] < 0
            back, on = active[none], active[~none]
            if len(back):  # nothing goes with the token before: a shorter one in its place
                dead[back] |= 1 << at[back]
                depth[back] -= 1
                last = path[back, depth[back]]
                at[back] -= self.length[last]
                left[back] = np.where(depth[back] > 0, path[back, depth[back] - 1], before[back])
                rank[back] = self.shorter[last]
            token = rank[on]
            ends = at[on] + self.length[token]
            fit = self._fit_all(left[on], token) & (dead[on] >> ends & 1 == 0)
            took, token, ends, other = on[fit], token[fit], ends[fit], on[~fit]
            rank[other] = self.shorter[rank[other]]
            path[took, depth[took]] = token
            depth[took] += 1
            at[took], left[took], rank[took] = ends, token, -2
            active = active[at[active] < sizes[active]]
        ids = path[np.arange(width + 1) < depth[:, None]].astype("<u4").tobytes()
        stops = (4 * np.cumsum(depth)).tolist()
        return [ids[begin:end] for begin, end in zip([0, *stops], stops)]


class _Kept(dict):
    """Ids by text, in two generations: what the older one knows comes back when it is met again, so frequent texts stay."""

    def __init__(self):
        self.older: dict[str, bytes] = {}

    def keep(self, text: str, ids: bytes) -> None:
        if len(text) <= MAX_KEPT:
            if len(self) >= MAX_WORDS:
                self.older = dict(self)
                self.clear()
            self[text] = ids


class Codec:
    """Encoder and decoder of whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = MergeTransducer(ranks)
        self.split = regex.compile(pattern).findall
        self.token = self.transducer.token
        self.pieces, self.spaced = _Kept(), _Kept()
        self.mark = {mark: self.encode_piece(mark) for mark in MARKS}

    def encode_piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.transducer.ranks.get(data)
        return self.transducer.encode(data) if whole is None else struct.pack("<I", whole)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text; texts are worked on in groups."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        """What the texts are made of is looked up once for all of them, and what is new is encoded together.

        The pattern always cuts where white space follows something else, and a single space goes
        with what follows it. So the runs between spaces, each with the space before it, can be
        encoded apart, unless a space stands inside or at the end of longer white space.
        """
        cuts: list[tuple[list[str], list[str]]] = []  # pieces, runs behind them
        for text in texts:
            first, *others = [text] if INNER_SPACE(text) else text.split(" ")
            cuts.append((self.split(first), others))
        pieces = set().union(*(cut for cut, _ in cuts))
        every = set().union(*(others for _, others in cuts))
        runs = dict(zip(every, map(self.spaced.get, every)))
        words: set[str] = set()
        marked: list[str] = []
        mixed: list[tuple[str, list[str]]] = []
        for run in [run for run, ids in runs.items() if ids is None]:
            if run[-1:] in MARKS and LATIN(run, 0, len(run) - 1):
                words.add(run[:-1])
                marked.append(run)
                continue
            ids = self.spaced.older.get(run)
            if ids is not None:
                runs[run] = ids
                self.spaced.keep(run, ids)
            elif LATIN(run):
                words.add(run)
            else:
                cut = self.split(" " + run)
                mixed.append((run, cut))
                if cut[0][:1] == " " and LATIN(cut[0], 1):
                    words.add(cut[0][1:])
                    pieces.update(cut[1:])
                else:
                    pieces.update(cut)
        words_ids, pieces_ids = self._known(self.spaced, " ", words), self._known(self.pieces, "", pieces)
        for run in words:
            runs[run] = words_ids[run]
        for run in marked:
            runs[run] = words_ids[run[:-1]] + self.mark[run[-1]]
        for run, cut in mixed:
            if cut[0][:1] == " " and LATIN(cut[0], 1):
                ids = words_ids[cut[0][1:]] + b"".join(map(pieces_ids.__getitem__, cut[1:]))
            else:
                ids = b"".join(map(pieces_ids.__getitem__, cut))
            runs[run] = ids
            if "\n" not in run:  # the number of those has no bound worth its memory, as that of words with a mark
                self.spaced.keep(run, ids)
        for cut, others in cuts:
            yield b"".join(map(pieces_ids.__getitem__, cut)) + b"".join(map(runs.__getitem__, others))

    def _known(self, table: _Kept, space: str, texts: set[str]) -> dict[str, bytes]:
        """Ids of each of the texts, each with ``space`` before it, from a table or, where they are new, by themselves."""
        found = dict(zip(texts, map(table.get, texts)))
        new = []
        for text in [text for text, ids in found.items() if ids is None]:
            ids = table.older.get(text)
            if ids is None:
                new.append(text)
            else:
                found[text] = ids
                table.keep(text, ids)
        data = [(space + text).encode("utf-8", "surrogatepass") for text in new]
        whole = list(map(self.transducer.ranks.get, data))
        made = iter(self.transducer.encode_all([x for x, rank in zip(data, whole) if rank is None]))
        for text, rank in zip(new, whole):
            found[text] = ids = next(made) if rank is None else struct.pack("<I", rank)
            table.keep(text, ids)
        return found

    def decode(self, ids: bytes) -> Iterator[str]:
        """Text in steps. The UTF-8 automaton carries the state of a character that a step's end
        cuts; bytes that no text can hold come out as lone surrogates."""
        automaton = codecs.getincrementaldecoder("utf-8")("surrogateescape")
        token = self.token.__getitem__
        for begin in range(0, len(ids), 4 * DECODE_STEP):
            step = array("I", ids[begin : begin + 4 * DECODE_STEP])
            yield automaton.decode(b"".join(map(token, step)))
        yield automaton.decode(b"", True)


def codec_maker(df: DataFrame, rank_file: str, pattern: str) -> Callable[[], Codec]:
    """The vocabulary is read once, on the driver, and sent out: a fixed file of about a megabyte.
    A worker process compiles it once and keeps it for its later tasks."""
    with open(rank_file, "rb") as source:
        data = source.read()
    sent = df.sparkSession.sparkContext.broadcast((data, pattern))
    name = hashlib.sha256(data + pattern.encode()).hexdigest()

    def make() -> Codec:
        kept = globals().setdefault("_COMPILED", {})
        if name not in kept:
            held, split_by = sent.value
            kept.clear()
            gc.set_threshold(200_000, 50, 1_000)  # the tables hold no cycles
            kept[name] = Codec(parse_ranks(held), split_by)
        return kept[name]

    return make


def encode_column(df: DataFrame, rank_file: str, pattern: str, text: str = "text", into: str = "token_ids") -> DataFrame:
    """Add ``into``: the ids of each text as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. A column of that name is replaced. Each row is worked on alone,
    so repeated rows and rows without an id come out like any other; no shuffle.
    """
    make = codec_maker(df, rank_file, pattern)

    def work() -> Callable:
        codec = make()
        return lambda values: [list(codec.encode_all(texts_of(values)))]

    return add_columns(df, [text], {into: ("binary", pa.binary())}, work)


def encode_checked(
    df: DataFrame, rank_file: str, pattern: str, text: str = "text", into: str = "token_ids", back: str = "comes_back"
) -> DataFrame:
    """``encode_column``, and ``back``: whether the ids, decoded again, give the text's bytes. The text itself goes."""
    make = codec_maker(df, rank_file, pattern)

    def work() -> Callable:
        codec = make()

        def one(value: str | None, ids: bytes) -> tuple[bytes, bool]:
            at = 0
            for step in codec.decode(ids):
                if not (value or "").startswith(step, at):
                    return ids, False
                at += len(step)
            return ids, at == len(value or "")

        def every(values: pa.Array) -> list:
            texts = texts_of(values)
            return list(zip(*map(one, texts, codec.encode_all(texts))))

        return every

    return add_columns(df, [text], {into: ("binary", pa.binary()), back: ("boolean", pa.bool_())}, work, drops=(text,))


def round_trip(df: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each text, decode the ids again, and give digests of both:
    (id, n_tokens, ids_sha256, decoded_sha256). A null text counts as empty."""
    make = codec_maker(df, rank_file, pattern)

    def work() -> Callable:
        codec = make()

        def one(ids: bytes) -> tuple[int, str, str]:
            decoded = hashlib.sha256()
            for step in codec.decode(ids):
                decoded.update(step.encode("utf-8", "surrogateescape"))
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded.hexdigest()

        return lambda values: list(zip(*map(one, codec.encode_all(texts_of(values)))))

    narrow = df.select(F.col(id_column), F.col(text).alias(free_name(df, "text_")))
    adds = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
    return add_columns(narrow, [narrow.columns[1]], adds, work, GROUP_ROWS, drops=(narrow.columns[1],))


def decode_column(df: DataFrame, rank_file: str, pattern: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """Add ``into``: the text that the ids stand for (null ids: empty); bytes that are no UTF-8 are
    shown as U+FFFD."""
    make = codec_maker(df, rank_file, pattern)

    def shown(steps: Iterable[str]) -> str:
        return "".join(steps).encode("utf-8", "surrogateescape").decode("utf-8", "replace")

    def work() -> Callable:
        codec = make()
        return lambda values: [[shown(codec.decode(x or b"")) for x in values.to_pylist()]]

    return add_columns(df, [ids], {into: ("string", pa.string())}, work)
