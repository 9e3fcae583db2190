"""Per-worker tables of text units (words, mostly).

The same words come again and again, so what is computed from a word alone
(its token ids, its share of a score) is computed once per Python worker and
looked up after that. A table holds ``limit`` units at most and starts over
when full, which bounds memory and never changes a result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np

UNIT_LIMIT = 700_000
#: Characters handled together: bounds the arrays of one step.
SLICE_CHARS = 2_000_000

_CACHE: dict = {}


def cached(key, make: Callable):
    """An object kept by the worker process from task to task: one at a
    time, so that steps that share a worker do not add up."""
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = make()
    return _CACHE[key]


def slices(texts: list[str | None], chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """``(first, texts)`` runs of about ``chars`` characters, null as empty."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= chars:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1024, dtype), 0

    def add(self, values) -> None:
        values = np.asarray(values, self.data.dtype)
        if self.n + len(values) > len(self.data):
            data = np.zeros(max(2 * len(self.data), self.n + len(values)), self.data.dtype)
            data[: self.n] = self.data[: self.n]
            self.data = data
        self.data[self.n: self.n + len(values)] = values
        self.n += len(values)


class _Index(dict):
    """Numbers units in the order they are first met."""

    def __init__(self):
        self.new = []

    def __missing__(self, unit):
        self[unit] = at = len(self)
        self.new.append(unit)
        return at


class UnitTable:
    """Rows of the units seen; ``compute`` adds rows for a list of new ones."""

    def __init__(self, limit: int = UNIT_LIMIT):
        self.limit, self.index = limit, _Index()
        self.reset()

    def reset(self) -> None:
        raise NotImplementedError

    def compute(self, units: list) -> None:
        raise NotImplementedError

    def rows(self, units: list) -> np.ndarray:
        if len(self.index) > self.limit:
            self.index = _Index()
            self.reset()
        rows = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
        if self.index.new:
            new, self.index.new = self.index.new, []
            self.compute(new)
        return rows


# A blank before a non-blank always starts a new piece of the byte-level
# pattern, and so does a line break between two non-blanks, which is a piece
# by itself. Pieces are merged separately, so the ids of a text are the ids of
# its units in order. The blanks of Python's \s include all of the pattern's.
_BLANK = re.compile(r" (?=\S)")
_BREAK = ("\n",)


def byte_level_units(text: str) -> list:
    """Units of a text: a string stands for itself after a blank, a tuple of
    one string for itself alone."""
    words = text.split()
    if " ".join(words) != text.replace("\n", " "):  # other white space, or not one between two words
        first, *rest = _BLANK.split(text)
        return [(first,), *rest]
    if "\n" not in text:
        return [(words[0],), *words[1:]] if words else [("",)]
    units = []
    for line in text.split("\n"):
        words = line.split(" ")
        words[0] = (words[0],)
        units += words
        units.append(_BREAK)
    units.pop()
    return units


_SEPARATORS = re.compile("[\x1c-\x1f]")  # blanks to str.split, not to the tokenizer
_PLAIN_BLANKS = re.compile("[ \t\n\x0b\x0c\r]+")


def word_level_units(text: str) -> list:
    """Units for the tokenizer whose pieces never hold white space."""
    return _PLAIN_BLANKS.split(text) if _SEPARATORS.search(text) else text.split()


class TokenTable(UnitTable):
    """Token ids of units, by a tokenizer of the tokenizers library.

    A unit of letters is one piece to the tokenizer, so many are encoded as
    one text and told apart by the piece numbers of the tokens. A comma or
    full stop after Latin letters is a piece by itself.
    """

    RUN = 400  # units encoded as one text

    def __init__(self, tokenizer_json: bytes, blank: str, limit: int = UNIT_LIMIT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.blank = Tokenizer.from_str(tokenizer_json.decode()), blank
        self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in ",."}
        super().__init__(limit)

    def reset(self) -> None:
        self.ids, self.start, self.length = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    def encode_run(self, words: list[str], alone: bool) -> list[list[int]]:
        """Ids of words of letters, each after a blank or alone."""
        if alone or not self.blank:
            # a line break between letters is a piece, or nothing, by itself
            found = self.tokenizer.encode("\n".join(words), add_special_tokens=False)
            every = 2 if self.blank else 1
        else:
            found = self.tokenizer.encode(self.blank + self.blank.join(words), add_special_tokens=False)
            every = 1
        pieces = np.array(found.word_ids, np.int64)
        if not len(pieces) or pieces[-1] != every * (len(words) - 1):
            return self.encode_each([(w,) if alone else w for w in words])
        cuts = np.searchsorted(pieces, np.arange(0, every * len(words), every))
        ends = np.searchsorted(pieces, np.arange(0, every * len(words), every), "right")
        ids = found.ids
        return [ids[a:b] for a, b in zip(cuts.tolist(), ends.tolist())]

    def encode_each(self, units: list) -> list[list[int]]:
        texts = [u[0] if isinstance(u, tuple) else self.blank + u for u in units]
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def compute(self, units: list) -> None:
        found: list = [None] * len(units)
        plain: dict = {False: {}, True: {}}  # by kind: word of letters -> the units it is in
        others = []
        for i, u in enumerate(units):
            alone = isinstance(u, tuple)
            w = u[0] if alone else u
            mark = self.marks.get(w[-1:])
            if mark is not None and w[-2:-1] < "\u0250" and w[-2:-1].lower().isalpha():
                w = w[:-1]
            else:
                mark = ()
            if w.isalpha():
                plain[alone].setdefault(w, []).append((i, mark))
            else:
                others.append(i)
        for alone, words in plain.items():
            order = list(words)
            for at in range(0, len(order), self.RUN):
                run = order[at: at + self.RUN]
                for w, ids in zip(run, self.encode_run(run, alone)):
                    for i, mark in words[w]:
                        found[i] = [*ids, *mark]
        if others:
            for i, ids in zip(others, self.encode_each([units[i] for i in others])):
                found[i] = ids
        length = np.fromiter(map(len, found), np.int64, len(found))
        self.start.add(self.ids.n + np.cumsum(length) - length)
        self.length.add(length)
        self.ids.add([i for x in found for i in x])


class Encoder:
    """Ids of whole texts with an end id, by way of the units' ids."""

    def __init__(self, tokenizer_json: bytes, level: str, end_id: int, limit: int = UNIT_LIMIT):
        self.split = byte_level_units if level == "byte" else word_level_units
        self.table = TokenTable(tokenizer_json, " " if level == "byte" else "", limit)
        self.end = np.uint32(end_id)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array and the number of ids of each text."""
        units, counts = [], []
        for t in texts:
            u = self.split(t)
            units += u
            counts.append(len(u))
        rows = self.table.rows(units)
        lengths, starts = self.table.length.data[rows], self.table.start.data[rows]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        last = ends[np.cumsum(counts)]  # ids up to each text's end, without end ids
        at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)
        ids = np.insert(self.table.ids.data[at], last, self.end)
        return ids, np.diff(last, prepend=0) + 1


def encoder(tokenizer_json: bytes, level: str, end_id: int, limit: int = UNIT_LIMIT) -> Encoder:
    return cached((hash(tokenizer_json), level, end_id, limit), lambda: Encoder(tokenizer_json, level, end_id, limit))
