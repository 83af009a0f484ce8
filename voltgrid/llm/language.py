"""Language of a text by cross-parsing.

For each language a suffix automaton holds all substrings of the words of a bounded,
labelled sample.  A text is parsed into phrases, each the longest match from where it
stands; the language that needs the fewest phrases, normalised by the size of its
sample, wins.  Phrases end at word ends, so a word's phrases depend on the word alone
and each distinct word is parsed once per process, however often it occurs.

Defined cases: a text that is null or has no letters is ``und`` with score 0; without
any labelled rows every text is; of equal languages the smaller name wins; words of any
length are parsed whole; rows that lack an id or a label are classified but not
learned from; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship

#: bounds of the sample: documents per language, characters of each, letters of distinct words per language
SAMPLE_DOCS = 200
SAMPLE_CHARS = 6_000
SAMPLE_LETTERS = 60_000
UNKNOWN = "und"
#: words remembered in a process; longer words are parsed each time
REMEMBERED = 400_000
REMEMBERED_LETTERS = 48

_WORD = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """All substrings of the words that were added; ``next[state]`` maps a letter to a state."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, following: dict[str, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: str) -> int:
        """The state that ends exactly one letter after ``p`` (a copy of the one that is there, if that is longer)."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, word: str) -> None:
        last = 0
        for c in word:
            if c in self.next[last]:
                last = self._split(last, c)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c)
            last = new

    def phrases(self, word: str) -> int:
        """Number of longest matches, one after the other, that make up the word; a letter without match is one."""
        count, state, following = 0, 0, self.next
        for c in word:
            ahead = following[state].get(c)
            if ahead is None:
                count += 1
                ahead = following[0].get(c)
                if ahead is None:
                    state = 0
                    continue
            elif state == 0:
                count += 1
            state = ahead
        return count


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def marked(word: str) -> str:
    """The word with its ends, which tell beginnings and endings of words apart."""
    return f" {word} "


class Parser(dict):
    """Word -> row of a table with its phrases per language and its letters."""

    def __init__(self, samples: dict[str, list[str]]):
        super().__init__()
        self.names = sorted(samples)
        self.automata, self.cost = [], []
        for name in self.names:
            automaton = SuffixAutomaton()
            for word in samples[name]:
                automaton.add(marked(word))
            self.automata.append(automaton.phrases)
            self.cost.append(log2(2 + sum(map(len, samples[name]))))
        self.rows = np.zeros((1024, len(self.names) + 1))

    def parse(self, word: str) -> list[int]:
        if not any(map(str.isalpha, word)):
            return [0] * (len(self.names) + 1)
        return [*(phrases(marked(word)) for phrases in self.automata), len(word)]

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.parse(word)
        self[word] = at
        return at

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, letters per phrase).  The score is the lead over the next language, from 0 to 1."""
        words = words_of(text) if text else []
        if not words or not self.names:
            return UNKNOWN, 0.0, 0.0
        if len(self) > REMEMBERED:
            self.clear()
        long = [w for w in words if len(w) > REMEMBERED_LETTERS]
        if long:
            words = [w for w in words if len(w) <= REMEMBERED_LETTERS]
        at = list(map(self.__getitem__, words))
        total = self.rows[at].sum(0) + sum((np.array(self.parse(w)) for w in long), np.zeros(len(self.names) + 1))
        if total[-1] == 0:
            return UNKNOWN, 0.0, 0.0
        bits = total[:-1] * self.cost
        order = np.argsort(bits, kind="stable")
        best = int(order[0])
        lead = 1.0 - bits[best] / bits[order[1]] if len(order) > 1 else 1.0
        return self.names[best], float(lead), float(total[-1] / total[best])


_parsers: dict[int, Parser] = {}


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[str]]:
    """Distinct words per language from a bounded sample of labelled rows.

    The sample is the `SAMPLE_DOCS` rows of each language with the smallest hash of
    their id, of rows with equal ids those with the smallest texts.  Ids alone are
    ranked first, then the rows that carry a chosen id; either way tasks send that
    many rows of each language at most, and no more reach the driver.
    """
    narrow = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    narrow = narrow.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.substring(text_col, 1, SAMPLE_CHARS).alias("text"), F.xxhash64(id_col).alias("place")
    )
    first = lambda rows, *order: rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", *order))
    ).where(F.col("rank") <= SAMPLE_DOCS)
    ids = [r[0] for r in first(narrow.select("id", "lang", "place")).select("id").distinct().collect()]
    if not ids:
        return {}
    texts = first(narrow.where(F.col("id").isin(ids)), "text").select("lang", "text", "place").collect()
    samples: dict[str, dict[str, None]] = {}
    letters: dict[str, int] = {}
    for row in sorted(texts, key=lambda r: (r["lang"], r["place"], r["text"])):
        own = samples.setdefault(row["lang"], {})
        for word in words_of(row["text"]):
            if word not in own and letters.get(row["lang"], 0) < SAMPLE_LETTERS:
                own[word] = None
                letters[row["lang"]] = letters.get(row["lang"], 0) + len(word)
    return {lang: list(own) for lang, own in samples.items() if own}


def identify(docs: DataFrame, text: Column, samples: dict[str, list[str]]) -> Column:
    """Column of struct<lang, score, match>: the language, its lead and the letters per phrase.

    ``samples`` (bounded, see `fit`) goes to the tasks; each process builds its automata once.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(samples)

    @F.pandas_udf("lang string, score double, match double")
    def of(texts: pd.Series) -> pd.DataFrame:
        parser = parser_of(sent.value)
        return pd.DataFrame([parser.classify(t) for t in texts], columns=["lang", "score", "match"])

    return of(text)


def parser_of(samples: dict[str, list[str]]) -> Parser:
    """The parser of this process for the sample (one is kept)."""
    key = hash(tuple((k, *v) for k, v in sorted(samples.items())))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]
