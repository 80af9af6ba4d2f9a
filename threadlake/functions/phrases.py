"""Sequences of words as single words, within the row.

The phrases form a trie over words. At a word that begins some phrase the trie is walked
along the words that follow, a state at a time, and the longest phrase on the way counts;
nearly all words begin none and cost one look-up. The trie is a constant of the plan, so
texts are neither exploded nor shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlake.functions.lookup import let, literal_lookup


class PhraseTrie:
    """States of a trie over words; a step is named by state and word.

    A step leads to ``2 * state``, plus one where a phrase ends.
    """

    def __init__(self, phrases: Iterable[str]):
        self.phrases = sorted({tuple(p.lower().split()) for p in phrases if len(p.split()) > 1})
        self.longest = max(map(len, self.phrases), default=0)
        self.steps: dict[str, int] = {}
        states: dict[tuple[str, ...], int] = {(): 0}
        for phrase in self.phrases:
            for size in range(1, len(phrase) + 1):
                states.setdefault(phrase[:size], len(states))
        ends = set(self.phrases)
        for path, state in states.items():
            if path:
                self.steps[f"{states[path[:-1]]} {path[-1]}"] = 2 * state + (path in ends)


def merge_phrases(words: Column, phrases: Iterable[str]) -> Column:
    """``words`` with each phrase as one word, its parts joined by blanks.

    The leftmost phrase counts, of those that begin with the same word the longest, and
    phrases do not overlap. Case plays no part and stays as it is. Without phrases of two
    words or more the words come back as they are.
    """
    trie = PhraseTrie(phrases)
    if not trie.phrases:
        return words
    step = literal_lookup(trie.steps, "int")

    def after(step_taken: Column) -> Column:
        return F.concat(F.floor(step_taken / 2).cast("string"), F.lit(" "))

    def length_at(low: Column, place: Column, first: Column) -> Column:
        """Words of the longest phrase at ``place``, or 0; ``first`` is the step of its word."""

        def walk(state: Column, word: Column) -> Column:
            return let(
                F.when(state["at"].isNotNull(), step(F.concat(after(state["at"]), word))),
                lambda at: F.struct(
                    at.alias("at"),
                    (state["seen"] + 1).alias("seen"),
                    F.when(at % 2 == 1, state["seen"] + 1).otherwise(state["best"]).alias("best"),
                ),
            )

        start = F.struct(first.alias("at"), F.lit(1).alias("seen"), F.lit(0).alias("best"))
        # Words are fetched one by one: a slice would copy the whole text first.
        following = F.transform(F.sequence(F.lit(1), F.lit(trie.longest - 1)), lambda n: F.get(low, place + n))
        return F.aggregate(following, start, walk, lambda state: state["best"])

    def found(low: Column) -> Column:
        """Where phrases begin and how many words they have."""
        sizes = F.transform(
            low,
            lambda word, place: let(
                step(F.concat(F.lit("0 "), word)),
                lambda first: F.struct(
                    place.alias("place"),
                    F.when(first.isNull(), 0).otherwise(length_at(low, place, first)).alias("size"),
                ),
            ),
        )
        return F.filter(sizes, lambda one: one["size"] > 0)

    def apart(candidates: Column) -> Column:
        """Those that do not begin inside the one taken before."""
        kind = "array<struct<place:int,size:int>>"

        def take(state: Column, one: Column) -> Column:
            return F.when(one["place"] < state["end"], state).otherwise(
                F.struct(
                    (one["place"] + one["size"]).alias("end"),
                    F.concat(state["taken"], F.array(one)).alias("taken"),
                )
            )

        start = F.struct(F.lit(0).alias("end"), F.array().cast(kind).alias("taken"))
        return F.aggregate(candidates, start, take, lambda state: state["taken"])

    def cut(shown: Column, taken: Column) -> Column:
        """The words before each phrase, then the phrase; at last the words behind all."""

        def end(number: Column) -> Column:
            one = F.get(taken, number)
            return F.when(number < 0, 0).otherwise(one["place"] + one["size"])

        def between(begin: Column, until: Column) -> Column:
            return F.when(
                until > begin, F.transform(F.sequence(begin, until - 1), lambda place: F.get(shown, place))
            ).otherwise(F.array().cast("array<string>"))

        def part(one: Column, number: Column) -> Column:
            before = let(end(number - 1), lambda begin: between(begin, one["place"]))
            phrase = F.array_join(between(one["place"], one["place"] + one["size"]), " ")
            return F.concat(before, F.array(phrase))

        behind = let(end(F.size(taken) - 1), lambda begin: between(begin, F.size(shown)))
        return F.concat(F.flatten(F.transform(taken, part)), behind)

    return let(words, lambda shown: let(
        let(F.transform(shown, F.lower), lambda low: let(found(low), apart)),
        lambda taken: F.when(F.size(taken) == 0, shown).otherwise(cut(shown, taken)),
    ))
