"""Whole-text encoding with a ``tokenizers`` file, one library call per distinct word instead of per text.

A blank between two characters that are not white space is where a new pre-token begins, for every
pattern that lets a blank belong to the word after it or to no word at all.  So a text is cut at
its blanks, each piece is encoded by the library when a worker meets it first, and its ids are kept
in a bounded cache.  Texts with any other kind of blank are encoded whole by the library.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters that normalisation treats one by one.  A run of either kind is a pre-token of its own,
#: and so is one line break between runs.  Special tokens and shortened words need the marks left out.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r"!#$%&()*+,\-./:;=?@"
RUNS = re.compile(rf"[{LETTERS}]+|[{MARKS}]+|\n")
WORD = re.compile(rf"([{LETTERS}]+)([{MARKS}]*)")
PLAIN = re.compile(rf"(?:[{LETTERS}]+|[{MARKS}]+)(?:\n?(?:[{LETTERS}]+|[{MARKS}]+))*")
#: The same as ``WORD`` for Arrow, whose patterns need the ends of the piece said.
SPLIT_WORD = rf"\A(?P<word>[{LETTERS}]+)(?P<marks>[{MARKS}]*)\z"
#: Two of them with a line break between.
SPLIT_LINES = rf"\A(?P<word>[{LETTERS}]+)(?P<marks>[{MARKS}]*)(?P<line>\n)(?P<next>[{LETTERS}]+)(?P<more>[{MARKS}]*)\z"
PROBES = ("a", "Is.", "THEAHEBLE!!", "achlichß", "réeuxê,###", "Ñdota.\nEn", "x-y", "(über)", "xqzjk:\n-éÉ", "þorn%%%")
IDS = np.dtype("<u4")


class _Pieces(dict):
    """Piece -> value.  Keeps the pieces used since the last two times it was full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.half, self.before = make, max(1, limit // 2), {}

    def __missing__(self, piece: str):
        found = self.before.get(piece)
        if found is None:
            found = self.make(piece)
        if len(self) >= self.half:
            self.before = dict(self)
            self.clear()
        self[piece] = found
        return found


class _Runs:
    """Ids of runs, looked up by Arrow many at a time.  At ``limit`` runs the half that was asked for last is kept."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int, fixed: dict[str, list[int]]):
        self.make, self.limit, self.fixed, self.calls = make, limit, len(fixed), 0
        self.names = pa.array(list(fixed), pa.string())
        self.sizes = np.array([len(ids) for ids in fixed.values()], np.int32)
        self.ids = np.array([i for ids in fixed.values() for i in ids], IDS)
        self.used = np.zeros(len(fixed), np.int32)

    def places(self, runs: pa.Array) -> np.ndarray:
        """The entries of these distinct runs; those of an earlier call may have moved."""
        if len(self.names) > self.limit:
            by_use = self.fixed + np.argsort(-self.used[self.fixed:], kind="stable")[:self.limit // 2]
            kept = np.concatenate([np.arange(self.fixed), np.sort(by_use)])
            self.ids, _ = gathered(kept, self.sizes, self.ids)
            self.names, self.sizes, self.used = self.names.take(pa.array(kept)), self.sizes[kept], self.used[kept]
        found = pc.index_in(runs, value_set=self.names)
        missing = pc.is_null(found)
        new = runs.filter(missing)
        at = found.fill_null(0).to_numpy().copy()
        at[missing.to_numpy(zero_copy_only=False)] = len(self.names) + np.arange(len(new), dtype=np.int32)
        ids, sizes = self.make(_strings(new))
        self.names = pa.concat_arrays([self.names, new])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        self.calls += 1
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
        self.used[at] = self.calls
        return at


class _NotApart(Exception):
    """The piece cannot be encoded apart from its neighbours."""


def _strings(texts: pa.Array) -> list[str]:
    """The same as ``to_pylist``, without a scalar object of Arrow's for each text."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def gathered(slots: np.ndarray, sizes: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries, one entry's after the other's, and the place where each entry's end.

    An entry's ids follow those of the entry before it in ``pool``.
    """
    # 32 bits are enough: there are no more ids than bytes, and Arrow's texts have fewer than that
    begin = np.cumsum(sizes, dtype=np.int32) - sizes
    taken = sizes.take(slots)
    ends = np.cumsum(taken, dtype=np.int32)
    shift = begin.take(slots)
    shift -= ends
    shift += taken
    at = np.repeat(shift, taken)
    at += np.arange(len(at), dtype=np.int32)
    return pool.take(at), ends


class Encoder:
    """Ids, or numbers of ids, of whole texts as the library gives them without added tokens.

    ``limit`` bounds the cached pieces of a worker.  ``known`` holds numbers of ids of frequent
    pieces, used by :meth:`count` only.
    """

    def __init__(self, path: str, limit: int = 300_000, known: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.signs = {ord(c): self._by_library(c) for c in map(chr, range(256)) if re.fullmatch(f"[{LETTERS}{MARKS}]", c)}
        self.blank, self.line = self._by_library(" "), self._whole("\n")
        self.runs = _Pieces(self._run, limit // 4)
        self.direct = all(self._plain(gap, word) == self._whole(gap + word) for word in PROBES for gap in ("", " "))
        as_bytes = lambda gap: lambda piece: array("I", self._ids(gap, piece)).tobytes()
        as_count = lambda gap: lambda piece: len(self._ids(gap, piece))
        self.first, self.rest = _Pieces(as_bytes(""), limit // 8), _Pieces(as_bytes(" "), limit)
        self.first_count, self.rest_count = _Pieces(as_count(""), limit // 8), _Pieces(as_count(" "), limit)
        self.known = known or {}
        # of encode_all: runs, and pieces that are not words and their marks
        self.met = _Runs(self._all_runs, limit * 3 // 8, {"": [], "\n": self.line})
        self.others = _Pieces(as_bytes(" "), limit // 8)

    def _by_library(self, text: str) -> str:
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return "".join(part for part, _ in self.library.pre_tokenizer.pre_tokenize_str(normal))

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _run(self, run: str) -> list[int]:
        """One pre-token, a blank before it or not, straight to the library's model."""
        return [t.id for t in self.model.tokenize(run.replace(" ", self.blank).translate(self.signs))]

    def _all_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many runs, one after the other, and each run's number of ids."""
        ids, sizes = array("I"), []
        for run in runs:
            own = self._run(run)
            ids.extend(own)
            sizes.append(len(own))
        return np.array(ids, IDS), np.array(sizes, np.int32)

    def _plain(self, gap: str, piece: str) -> list[int]:
        ids: list[int] = []
        for run in RUNS.findall(piece):
            ids += self.line if run == "\n" else self.runs[gap + run]
            gap = ""
        return ids

    def _ids(self, gap: str, piece: str) -> list[int]:
        if self.direct and (plain := WORD.fullmatch(piece)):
            word, marks = plain.groups()
            ids = self.runs[gap + word]
            return ids + self.runs[marks] if marks else ids
        if self.direct and PLAIN.fullmatch(piece):
            return self._plain(gap, piece)
        if not piece or piece[0].isspace() or not piece[0].isprintable():
            raise _NotApart
        return self._whole(gap + piece)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pieces = text.split(" ")
        try:
            return self.first[pieces[0]] + b"".join(map(self.rest.__getitem__, pieces[1:]))
        except _NotApart:
            return np.array(self._whole(text), IDS).tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many texts, one after the other, and the place where each text's end.

        Arrow cuts the texts and finds their distinct pieces, so that a piece is looked up once however often
        it occurs; a letter run and the marks after it are looked up apart.  This holds many times the
        size of the texts: give it a few megabytes at a time.
        """
        pieces = pc.split_pattern(pc.fill_null(texts, ""), " ")
        starts = pieces.offsets.to_numpy()
        coded = pieces.values.dictionary_encode()
        codes, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

        # the runs of pieces that are a word and its marks, or two of them and the line break between
        found = pc.extract_regex(distinct, SPLIT_WORD) if self.direct else pa.nulls(len(distinct))
        words = pc.is_valid(found).to_numpy(zero_copy_only=False)
        others = np.flatnonzero(~words)
        rest = distinct.take(pa.array(others))
        broken = pc.extract_regex(rest, SPLIT_LINES) if self.direct else pa.nulls(len(rest))
        lines = pc.is_valid(broken).to_numpy(zero_copy_only=False)
        columns = []
        for of, names in ((found, ("word", "marks")), (broken, ("word", "marks", "line", "next", "more"))):
            of = of.drop_null()
            columns += [
                pc.binary_join_element_wise("", pc.struct_field(of, n), " ") if n == "word" else pc.struct_field(of, n) for n in names
            ] if len(of) else [pa.array([], pa.string())] * len(names)
        runs = pa.concat_arrays(columns).dictionary_encode()
        places = np.split(self.met.places(runs.dictionary).take(runs.indices.to_numpy()), np.cumsum([len(c) for c in columns])[:-1])
        sizes, pool = self.met.sizes, self.met.ids

        # two entries for each distinct piece, entry 0 is empty; further entries follow those of the runs
        parts = np.zeros((len(distinct), 2), np.int32)
        parts[words] = np.stack(places[:2], axis=1)
        joined, ends = gathered(np.stack(places[2:], axis=1).reshape(-1), sizes, pool)
        parts[others[lines], 0] = len(sizes) + np.arange(lines.sum())
        sizes = np.concatenate([sizes, np.diff(ends[4::5], prepend=0).astype(np.int32)])
        # an entry of None sends its text to the library
        entries = [self._or_none(self.others, piece) for piece in _strings(rest.filter(pa.array(~lines)))]
        parts[others[~lines], 0] = len(sizes) + np.arange(len(entries))

        slots = parts.take(codes, axis=0)
        firsts = _strings(distinct.take(pa.array(codes[starts[:-1]])))
        slots[starts[:-1], 0] = len(sizes) + len(entries) + np.arange(len(firsts))
        slots[starts[:-1], 1] = 0
        entries += [self._or_none(self.first, piece) for piece in firsts]

        apart = np.concatenate([np.ones(len(sizes), bool), np.array([entry is not None for entry in entries], bool)])
        if not apart.all():
            for text in np.unique(np.searchsorted(starts, np.flatnonzero(~apart[slots[:, 0]]), "right") - 1).tolist():
                slots[starts[text]:starts[text + 1]] = 0
                slots[starts[text], 0] = len(sizes) + len(entries)
                entries.append(self.encode(texts[text].as_py() or ""))
        entries = [entry or b"" for entry in entries]

        pool = np.concatenate([pool, joined, np.frombuffer(b"".join(entries), IDS)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, entries), np.int32, len(entries)) // 4])
        ids, ends = gathered(slots.reshape(-1), sizes, pool)
        return ids, np.concatenate([[0], ends])[2 * starts[1:]]

    @staticmethod
    def _or_none(cache: _Pieces, piece: str) -> bytes | None:
        try:
            return cache[piece]
        except _NotApart:
            return None

    def count(self, text: str) -> int:
        if not text:
            return 0
        pieces, known, misses = text.split(" "), self.known, self.rest_count
        try:
            total = self.first_count[pieces[0]]
            found = list(map(known.get, pieces[1:]))
            if None in found:
                found = [misses[p] if n is None else n for p, n in zip(pieces[1:], found)]
            return total + sum(found)
        except _NotApart:
            return len(self._whole(text))


_ENCODERS: dict[tuple, Encoder] = {}


def release() -> None:
    """Give this worker's caches back; operators without a tokenizer call it, as workers are used again."""
    _ENCODERS.clear()


def encoder(path: str, limit: int = 800_000) -> Encoder:
    """This worker's encoder; its cache lives until an operator without a tokenizer uses the worker."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = Encoder(path, limit)
    return _ENCODERS[path, limit]
