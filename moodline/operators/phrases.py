"""Finding the entries of a word table, phrases included, within a text.

Entries are words or phrases, told apart from what they overlap with as a reader would: from left to
right, and of those that start at one place the longest. Two ways give the same matches:

* ``Matcher``: an Aho-Corasick automaton over the numbers of the table's words, for tables small enough to
  travel to the tasks. One pass over a text's words, whatever the number and length of phrases; texts
  stay on their rows.
* ``grams`` and ``without_overlaps``: a row for each length of entry behind the words that entries begin
  with, to be joined with a table of any size, and what is found put together again by row.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.columns import as_column
from moodline.functions.text import bare_word

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def entry(token: Column | str) -> Column:
    """An entry with single blanks between its words."""
    return F.trim(F.regexp_replace(as_column(token), " +", " "))


def entry_lengths(table: DataFrame, token: str = "token") -> list[int]:
    """Which numbers of words the entries have. An entry given twice is an error."""
    shown = table.select(entry(token).alias("entry")).filter("entry <> ''")
    rows = (
        shown.groupBy(F.size(F.split("entry", " ")).alias("size"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("entry").alias("distinct"))
        .collect()
    )
    if any(r["n"] != r["distinct"] for r in rows):
        raise ValueError("an entry of the word table is given twice")
    return sorted(r["size"] for r in rows)


class Matcher:
    """Aho-Corasick automaton of a table's entries, as plain lists and dictionaries."""

    def __init__(self, entries: Iterable[tuple[str, float]]):
        self.numbers: dict[str, int] = {}  # of the words that occur in entries
        self.ways: list[dict[int, int]] = [{}]  # state -> word number -> state
        self.ends: list[tuple[int, float] | None] = [None]  # state -> words and valence of the entry it ends
        for text, valence in entries:
            state = 0
            words = text.split(" ")
            for word in words:
                number = self.numbers.setdefault(word, len(self.numbers))
                after = self.ways[state].get(number)
                if after is None:
                    after = self.ways[state][number] = len(self.ways)
                    self.ways.append({})
                    self.ends.append(None)
                state = after
            if self.ends[state] is not None:
                raise ValueError(f"entry given twice: {text!r}")
            self.ends[state] = (len(words), valence)
        self.single = not any(self.ways[s] for s in self.ways[0].values())
        # fall: the state of the longest proper suffix that begins an entry; found: the nearest state
        # that ends an entry, among the state itself and those it falls to
        self.fall = [0] * len(self.ways)
        self.found = [s if end else 0 for s, end in enumerate(self.ends)]
        queue = deque(self.ways[0].values())
        while queue:
            state = queue.popleft()
            for number, after in self.ways[state].items():
                queue.append(after)
                back = self.fall[state]
                while back and number not in self.ways[back]:
                    back = self.fall[back]
                self.fall[after] = self.ways[back].get(number, 0)
            if not self.ends[state]:
                self.found[state] = self.found[self.fall[state]]

    def matches(self, words: Sequence[str]) -> list[tuple[int, int, float]]:
        """(place, number of words, valence) of the entries in a text, none overlapping another."""
        known = self.numbers
        if self.single:
            first, ends = self.ways[0], self.ends
            return [(i, 1, ends[first[known[w]]][1]) for i, w in enumerate(words) if w in known]
        ways, fall, found, ends = self.ways, self.fall, self.found, self.ends
        longest: dict[int, tuple[int, float]] = {}  # by the place where an entry starts
        state = 0
        for i, word in enumerate(words):
            number = known.get(word)
            if number is None:
                state = 0
                continue
            while state and number not in ways[state]:
                state = fall[state]
            state = ways[state].get(number, 0)
            end = found[state]
            while end:
                size, valence = ends[end]
                start = i - size + 1
                if start not in longest or longest[start][0] < size:
                    longest[start] = (size, valence)
                end = found[fall[end]]
        out, free = [], 0
        for start in sorted(longest):
            if start >= free:
                size, valence = longest[start]
                out.append((start, size, valence))
                free = start + size
        return out

    def __getstate__(self) -> dict:
        return self.__dict__


def first_words(table: DataFrame) -> DataFrame:
    """token, longest: the words that entries begin with, and of how many words the longest of those has."""
    words = F.split("token", " ")
    return table.select(F.get(words, F.lit(0)).alias("token"), F.size(words).alias("size")).groupBy("token").agg(
        F.max("size").alias("longest")
    )


def grams(words: DataFrame, lengths: Sequence[int], following: Sequence[str]) -> DataFrame:
    """A row for each length of entry that fits behind a word: ``size`` and ``token``, the words joined.

    ``words`` has ``token``, a word, in the columns ``following`` the words after it as they are written,
    null past the end, and ``longest``, the most words that an entry that begins with it has.
    """
    after = [bare_word(c) for c in following]
    column = {n: F.concat(F.col("token"), *[x for c in after[: n - 1] for x in (F.lit(" "), c)]) for n in lengths}
    pairs = F.array(
        *[F.struct(F.lit(n).alias("size"), F.when(F.col("longest") >= n, c).alias("gram")) for n, c in column.items()]
    )
    kept = [c for c in words.columns if c not in ("token", "longest", *following)]
    # a null word is a text without words: it stays, as one row
    some = F.filter(pairs, lambda p: p["gram"].isNotNull() | F.col("token").isNull())
    each = F.when(F.col("token").isNull(), F.slice(some, 1, 1)).otherwise(some)
    return words.select(*kept, F.explode(each).alias("_gram")).select(
        *kept, F.col("_gram.size").alias("size"), F.col("_gram.gram").alias("token")
    )


def without_overlaps(found: Column) -> Column:
    """Total and number of the entries of a text that stay: an array of (place, size, value) structs to a struct."""
    ordered = F.array_sort(F.transform(found, lambda m: F.struct(m["place"], (-m["size"]).alias("shorter"), m["value"])))
    start = F.struct(F.lit(0).alias("free"), F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("matched"))

    def take(seen: Column, m: Column) -> Column:
        taken = F.struct(
            (m["place"] - m["shorter"]).cast("int").alias("free"),
            (seen["total"] + m["value"]).alias("total"),
            (seen["matched"] + 1).alias("matched"),
        )
        return F.when(m["place"] >= seen["free"], taken).otherwise(seen)

    return F.aggregate(ordered, start, take)
