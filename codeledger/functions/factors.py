"""Text that every match of a pattern must hold, and the grams by which such text is looked up.

A pattern's factors are ASCII texts of which each match holds at least one, in any case.  They come from the
pattern's parse tree; what the tree does not tell for sure gives no factor.  A factor is looked up by one gram of
it, three letters or digits that follow each other, so that the texts worth a regex are found by equality.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from re import _constants as op
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 3
#: Alternatives that one pattern is followed into before its text is given up.
MOST_FACTORS = 16
#: Characters of a class that count as alternatives.
MOST_MEMBERS = 4
_RUN = re.compile("[a-z0-9]+")


def fold(text: Column) -> Column:
    """``text`` so that letters which match each other without case are equal, as far as ASCII is concerned."""
    # the characters beyond ASCII that match an ASCII letter but have another lower case
    return F.lower(F.translate(text, "İıſ", "iis"))


def grams(text: Column) -> Column:
    """The distinct grams of folded text, as an array; overlapping ones too."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=([a-z0-9]{{{GRAM}}}))"), F.lit(1)))


def grams_of_words(text: Column) -> Column:
    """``grams`` for long text: its distinct words are cut out first, so each is looked at once."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(f"[a-z0-9]{{{GRAM},}}"), F.lit(0)))
    return grams(F.array_join(words, " "))


def required_factors(pattern: str) -> frozenset[str] | None:
    """Folded texts of which every match of ``pattern`` holds one; None if there are none that can be looked up."""
    found = _Text().read(_parser.parse(pattern)).best()
    return found if found and all(_longest_run(f) >= GRAM for f in found) else None


def gram_counts(patterns: Iterable[frozenset[str] | None]) -> Counter:
    """In how many factors each gram occurs: the rarest gram of a factor finds the fewest others."""
    return Counter(g for factors in patterns for f in factors or () for g in set(_grams(f)))


def rarest_gram(factor: str, counts: Counter) -> str:
    return min(_grams(factor), key=lambda g: (counts[g], g))


def _grams(factor: str) -> list[str]:
    return [run[i : i + GRAM] for run in _RUN.findall(factor) for i in range(len(run) - GRAM + 1)]


def _longest_run(factor: str) -> int:
    return max(map(len, _RUN.findall(factor)), default=0)


def _better(a: frozenset[str] | None, b: frozenset[str] | None) -> frozenset[str] | None:
    """The set whose shortest run is longer, of equals the smaller set."""
    if not a or not b:
        return a or b

    def key(factors: frozenset[str]) -> tuple:
        return min(map(_longest_run, factors)), -len(factors)

    return max(a, b, key=key)


class _Text:
    """What is known of the text that part of a pattern matches.

    ``whole``: all texts it can be, or None; ``required``: texts one of which it holds, or None.  Parts in a row
    are joined while all of them are known; where one is not, the text so far is a candidate and a new run begins.
    """

    def __init__(self) -> None:
        self.whole: frozenset[str] | None = frozenset([""])
        self.run: frozenset[str] = frozenset([""])
        self.required: frozenset[str] | None = None

    def best(self) -> frozenset[str] | None:
        return _better(self.required, self._told(self.run))

    @staticmethod
    def _told(texts: frozenset[str] | None) -> frozenset[str] | None:
        return texts if texts and "" not in texts else None

    def _broken(self, *candidates: frozenset[str] | None) -> None:
        """Text that is not known follows."""
        for texts in (self._told(self.run), *candidates):
            self.required = _better(self.required, texts)
        self.run, self.whole = frozenset([""]), None

    def _follow(self, texts: frozenset[str]) -> None:
        """One of ``texts`` follows."""
        joined = frozenset(a + b for a in self.run for b in texts) if len(self.run) * len(texts) <= MOST_FACTORS else None
        if joined is None:
            self._broken(self._told(texts))
            self.run = texts if len(texts) <= MOST_FACTORS else frozenset([""])
            return
        self.run = joined
        self.whole = joined if self.whole is not None else None

    def read(self, items) -> _Text:
        for kind, value in items:
            if kind is op.LITERAL:
                self._letters([value])
            elif kind is op.IN:
                self._letters(self._members(value))
            elif kind is op.SUBPATTERN:
                self._part([value[-1]])
            elif kind is op.ATOMIC_GROUP:
                self._part([value])
            elif kind is op.BRANCH:
                self._part(value[1])
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
                self._repeated(*value)
            elif kind not in (op.AT, op.ASSERT, op.ASSERT_NOT):  # these match no text of their own
                self._broken()
        return self

    @staticmethod
    def _members(items) -> list[int] | None:
        codes: list[int] = []
        for kind, value in items:
            if kind is op.LITERAL:
                codes.append(value)
            elif kind is op.RANGE and value[1] - value[0] < MOST_MEMBERS:
                codes += range(value[0], value[1] + 1)
            else:
                return None
        return codes if len(codes) <= MOST_MEMBERS else None

    def _letters(self, codes: list[int] | None) -> None:
        # other letters may have several folded forms
        if codes is None or any(c >= 128 for c in codes):
            self._broken()
        else:
            self._follow(frozenset(chr(c).lower() for c in codes))

    def _part(self, branches) -> None:
        parts = [_Text().read(branch) for branch in branches]
        wholes = [p.whole for p in parts]
        if all(w is not None for w in wholes) and sum(map(len, wholes)) <= MOST_FACTORS:
            self._follow(frozenset().union(*wholes))
            return
        needed = [p.best() for p in parts]
        told = frozenset().union(*needed) if all(needed) else None
        self._broken(told if told and len(told) <= MOST_FACTORS else None)

    def _repeated(self, least: int, most, item) -> None:
        part = _Text().read(item)
        if least == 0:
            if most == 1 and part.whole is not None and len(part.whole) < MOST_FACTORS:
                self._follow(part.whole | {""})
            else:
                self._broken()
        elif part.whole is None:
            self._broken(part.best())
        else:
            for _ in range(min(least, 8)):
                self._follow(part.whole)
            if least != most or least > 8:
                self._broken()
