"""Lexicon sentiment as a column expression.

The lexicon and the rule words are inputs. The score follows the published
rule-based method (Hutto and Gilbert, 2014): a valence per known word, changed
by degree words, negations, capitals, "but" and closing punctuation, summed and
squeezed into -1..1. The default lexicon is a short list of our own, so scores
are not those of any published lexicon; give a full one for real work.

A key of several words is a phrase, in the lexicon (an idiom) as among the degree
words: where it stands in a text it counts as one word, and the longest one wins.
Emoji are read as the words of their names.

A text stays in its row: its words are an array, the few that the lexicon knows
look at their neighbours by position, and nothing is exploded, shuffled or sent
to a Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.functions.emoji import emoji_names, spell_emoji
from threadlake.functions.labels import sentiment_label
from threadlake.functions.lookup import MAX_TABLE_WORDS, let, literal_lookup
from threadlake.functions.phrases import merge_phrases
from threadlake.functions.text import clean_html, squeeze_spaces, word_tokens
from threadlake.functions.word_tables import KNOWN, ROW, WordTable, fits, word_lookup

# Fixed values of the published method.
DEGREE_STEP = 0.293
CAPITALS_STEP = 0.733
NEGATION_FACTOR = -0.74
NEVER_SO_FACTOR = 1.25
DISTANCE_FACTORS = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATIONS_MOST = 0.292, 4
QUESTION_STEP, QUESTIONS_FEW, QUESTIONS_MANY = 0.18, 3, 0.96
SPREAD = 15.0

# Degree words and negations of the method.
STRONGER = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply "
    "enormous enormously entirely especially exceptional exceptionally extreme extremely "
    "fabulously fully greatly highly hugely incredible incredibly intensely major majorly "
    "more most particularly purely quite really remarkably so substantially thoroughly "
    "total totally tremendous tremendously unbelievably unusually utter utterly very"
).split()
WEAKER = (
    "almost barely hardly kinda less little marginal marginally occasional occasionally "
    "partly scarce scarcely slight slightly somewhat sorta"
).split()
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt "
    "mightnt mustnt neednt neither never none nope nor not nothing nowhere oughtnt shant "
    "shouldnt uhuh wasnt werent without wont wouldnt rarely seldom despite"
).split()

# Idioms and degree phrases of the method.
IDIOMS: dict[str, float] = {
    "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
WEAKER_PHRASES = ("just enough", "kind of", "sort of")

# Our own short list of everyday words, valence -4 to 4.
DEFAULT_LEXICON: dict[str, float] = {
    "amazing": 3.0, "awesome": 3.0, "beautiful": 2.5, "best": 3.0, "better": 1.5,
    "brilliant": 3.0, "clean": 1.5, "clever": 2.0, "delight": 2.5, "easy": 1.5,
    "elegant": 2.0, "enjoy": 2.0, "excellent": 3.0, "fantastic": 3.0, "fast": 1.0,
    "fun": 2.0, "good": 2.0, "great": 3.0, "happy": 2.5, "helpful": 2.0,
    "impressive": 2.5, "interesting": 1.5, "like": 1.5, "love": 3.0, "nice": 2.0,
    "perfect": 3.0, "recommend": 1.5, "thanks": 2.0, "useful": 2.0, "win": 2.5,
    "wonderful": 3.0, "worth": 1.0,
    "angry": -2.5, "annoying": -2.0, "awful": -3.0, "bad": -2.5, "boring": -1.5,
    "broken": -2.0, "bug": -1.0, "confusing": -1.5, "crash": -2.0, "disagree": -1.5,
    "disappointing": -2.5, "disgusting": -3.0, "fail": -2.5, "failure": -2.5,
    "garbage": -3.0, "hate": -3.0, "horrible": -3.0, "no": -1.0, "painful": -2.0,
    "poor": -2.0, "problem": -1.5, "sad": -2.0, "scam": -3.0, "slow": -1.0,
    "stupid": -2.5, "terrible": -3.0, "ugly": -2.0, "useless": -2.0, "worse": -2.0,
    "worst": -3.0, "wrong": -2.0,
    # Words of the names of common emoji.
    "smiling": 2.0, "grinning": 2.0, "joy": 2.5, "heart": 2.0, "kiss": 1.5, "thumbs up": 2.0,
    "crying": -2.0, "pouting": -2.0, "weary": -1.5, "fearful": -2.0, "thumbs down": -2.0,
    **IDIOMS,
}


def _default_degrees() -> dict[str, float]:
    weaker = dict.fromkeys((*WEAKER, *WEAKER_PHRASES), -DEGREE_STEP)
    return {**dict.fromkeys(STRONGER, DEGREE_STEP), **weaker}


@dataclass(frozen=True)
class SentimentRules:
    """The words that change the valence of their neighbours."""

    degrees: Mapping[str, float] = field(default_factory=_default_degrees)
    negations: Iterable[str] = tuple(NEGATIONS)
    contrast: str = "but"
    emoji: Mapping[str, str] = field(default_factory=emoji_names)


PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def sentiment_words(clean: Column) -> Column:
    """Words of a text with single blanks; punctuation at the ends goes if over two letters stay.

    Trimming is the dearest step per word, so the end letters are looked at first.
    """
    marks = F.lit(PUNCTUATION)

    def stripped(word: Column) -> Column:
        return let(
            F.btrim(word, marks),
            lambda inner: F.when(F.length(inner) > 2, inner).otherwise(word),
        )

    def bare(word: Column) -> Column:
        marked = F.contains(marks, F.substring(word, -1, 1)) | F.contains(
            marks, F.substring(word, 1, 1)
        )
        return F.when(marked, stripped(word)).otherwise(word)

    return F.transform(F.split(clean, " "), bare)


def _in_capitals(word: Column, low: Column) -> Column:
    """``low`` is the word in lower case; comparing with it first spares most words the rest."""
    return (word != low) & (word == F.upper(word))


def valence_sum(
    words: Column, lexicon: Mapping[str, float], rules: SentimentRules
) -> Column:
    """The summed valence of an array of words; phrases of the rules count as one word."""
    return _valence_sum(merge_phrases(words, [*lexicon, *rules.degrees]), literal_lookup(lexicon), rules)


def _valence_sum(words: Column, valence_of: Callable[[Column], Column], rules: SentimentRules) -> Column:
    degree_of = literal_lookup(rules.degrees)
    negations = sorted(rules.negations)

    def total(shown: Column, low: Column, valences: Column, mixed: Column, turn: Column) -> Column:
        """``low`` are the words in lower case, ``turn`` the place of the contrast word."""

        def word(at: Column) -> Column:
            return F.when(at < 0, "").otherwise(F.coalesce(F.get(low, at), F.lit("")))

        def known(at: Column) -> Column:
            """No word at all counts as known: it changes nothing."""
            return (at < 0) | F.get(valences, at).isNotNull()

        def loud(at: Column) -> Column:
            return mixed & _in_capitals(F.get(shown, at), F.get(low, at))

        def negates(name: Column) -> Column:
            return name.isin(negations) | name.contains("n't")

        def moved(value: Column, at: Column, distance: int) -> Column:
            """``value`` moved by the degree of the word ``at``."""
            sign = F.when(value < 0, -1.0).otherwise(1.0)
            towards = F.when(value > 0, CAPITALS_STEP).otherwise(-CAPITALS_STEP)

            def by(degree: Column) -> Column:
                step = degree * sign + F.when(loud(at), towards).otherwise(0.0)
                return F.when(degree.isNull() | (degree == 0.0), value).otherwise(
                    value + step * DISTANCE_FACTORS[distance]
                )

            return let(degree_of(word(at)), by)

        def negated(value: Column, at: Column, nearer: list[Column]) -> Column:
            """``value`` turned by a negation ``at``, given the words between."""
            turned = F.when(negates(word(at)), value * NEGATION_FACTOR).otherwise(value)
            if not nearer:
                return turned
            so, doubt = F.lit(False), F.lit(False)
            for other in nearer:
                so = so | word(other).isin("so", "this")
                doubt = doubt | (word(other) == "doubt")
            return (
                F.when((word(at) == "never") & so, value * NEVER_SO_FACTOR)
                .when((word(at) == "without") & doubt, value)
                .otherwise(turned)
            )

        def after(value: Column, place: Column, distance: int) -> Column:
            """``value`` after the word ``distance + 1`` places back had its effect."""
            at = place - (distance + 1)
            nearer = [place - (step + 1) for step in range(distance)]
            effect = let(moved(value, at, distance), lambda v: negated(v, at, nearer))
            return F.when(known(at), value).otherwise(effect)

        def in_context(value: Column, place: Column) -> Column:
            before = place - 1
            least = (
                (word(before) == "least")
                & ~known(before)
                & ~word(place - 2).isin("at", "very")
            )
            return let(
                let(after(value, place, 0), lambda one: let(
                    after(one, place, 1), lambda two: after(two, place, 2)
                )),
                lambda v: F.when(least, v * NEGATION_FACTOR).otherwise(v),
            )

        def own_value(valence: Column, place: Column) -> Column:
            one, two, three = word(place - 1), word(place - 2), word(place - 3)
            refused = (one == "no") | (two == "no") | ((three == "no") & one.isin("or", "nor"))
            determiner = (word(place) == "no") & F.get(valences, place + 1).isNotNull()
            plain = F.when(refused, valence * NEGATION_FACTOR).when(determiner, 0.0)
            step = F.when(valence > 0, CAPITALS_STEP).otherwise(-CAPITALS_STEP)
            return plain.otherwise(valence) + F.when(loud(place), step).otherwise(0.0)

        def contribution(valence: Column, place: Column) -> Column:
            name = word(place)
            degree = degree_of(name)
            silent = (degree.isNotNull() & (degree != 0.0)) | (
                (name == "kind") & (word(place + 1) == "of")
            )
            weight = (
                F.when(turn == 0, 1.0)
                .when(place < turn - 1, BEFORE_BUT)
                .when(place > turn - 1, AFTER_BUT)
                .otherwise(1.0)
            )
            value = let(own_value(valence, place), lambda v: in_context(v, place))
            return F.when(silent, 0.0).otherwise(value * weight)

        values = F.transform(
            valences,
            lambda valence, place: F.when(valence.isNull(), 0.0).otherwise(
                contribution(valence, place)
            ),
        )
        return F.aggregate(values, F.lit(0.0), lambda done, value: done + value)

    # Capitals mean something only where not every word has them.
    def mixed_case(shown: Column, low: Column) -> Column:
        capitals = F.zip_with(shown, low, _in_capitals)
        return let(capitals, lambda c: F.array_contains(c, True) & F.array_contains(c, False))

    return let(words, lambda shown: let(
        F.transform(shown, F.lower), lambda low: let(
            F.transform(low, valence_of), lambda valences: let(
                mixed_case(shown, low), lambda mixed: let(
                    F.array_position(low, rules.contrast),
                    lambda turn: total(shown, low, valences, mixed, turn),
                )
            )
        )
    ))


def _spelled(clean: Column, emoji: Mapping[str, str]) -> Column:
    """``clean`` with its emoji as words; only a text that changes is squeezed once more."""
    return let(clean, lambda text: let(
        spell_emoji(text, emoji),
        lambda spelled: F.when(spelled == text, text).otherwise(squeeze_spaces(spelled)),
    ))


def _emphasis(clean: Column) -> Column:
    def count(mark: str) -> Column:
        return F.length(clean) - F.length(F.replace(clean, F.lit(mark), F.lit("")))

    exclamations = F.least(count("!"), F.lit(EXCLAMATIONS_MOST)) * EXCLAMATION_STEP
    questions = (
        F.when(count("?") <= 1, 0.0)
        .when(count("?") <= QUESTIONS_FEW, count("?") * QUESTION_STEP)
        .otherwise(QUESTIONS_MANY)
    )
    return exclamations + questions


def _phrases(lexicon: WordTable) -> list[str]:
    """The entries of several words. They steer how texts are cut, so they are configuration
    whatever the size of the table: at most as many as a constant word table."""
    if not isinstance(lexicon, DataFrame):
        return [term for term in lexicon if " " in term]
    term = F.col(lexicon.columns[0])
    found = lexicon.select(term.alias("term")).where(F.contains(term, F.lit(" "))).limit(MAX_TABLE_WORDS + 1).collect()
    if len(found) > MAX_TABLE_WORDS:
        raise ValueError(f"more than {MAX_TABLE_WORDS} phrases in the lexicon")
    return [row.term for row in found]


def add_sentiment(
    df: DataFrame,
    column: str = "text",
    lexicon: WordTable | None = None,
    rules: SentimentRules | None = None,
) -> DataFrame:
    """Adds ``sentiment_score`` (four decimals) and ``sentiment_label``.

    The text is cleaned of HTML and its emoji are spelled out first; a blank one scores 0
    and is neutral. The lexicon may be a frame of term and valence and have any size
    (``word_tables``); then the rows are staged if more of its words occur than a constant
    holds.
    """
    lexicon = DEFAULT_LEXICON if lexicon is None else lexicon
    rules = rules or SentimentRules()

    def score(total: Column) -> Column:
        emphasis = _emphasis(F.col("_clean"))
        return let(
            F.when(total > 0, total + emphasis).when(total < 0, total - emphasis).otherwise(0.0),
            lambda sum_: F.round(sum_ / F.sqrt(sum_ * sum_ + F.lit(SPREAD)), 4),
        )

    def words() -> Column:
        return merge_phrases(sentiment_words(F.col("_clean")), [*phrases, *rules.degrees])

    phrases = _phrases(lexicon)
    cleaned = df.withColumn("_clean", _spelled(clean_html(F.col(column)), rules.emoji))
    if fits(lexicon):
        rows, total = cleaned, valence_sum(sentiment_words(F.col("_clean")), lexicon, rules)
    else:
        found = word_lookup(cleaned, F.transform(words(), F.lower), lexicon)
        rows, total = found.rows, _valence_sum(words(), found.value_of, rules)
    scored = rows.withColumn("sentiment_score", let(total, score)).withColumn(
        "sentiment_label", sentiment_label(F.col("sentiment_score"))
    )
    return scored.drop("_clean", ROW, KNOWN)


def lexicon_sum(text: Column, lexicon: Mapping[str, float]) -> Column:
    """The plain sum of the valences of a text's words, without any rules."""
    valence_of = literal_lookup(lexicon)
    return F.aggregate(
        word_tokens(text),
        F.lit(0.0),
        lambda total, word: total + F.coalesce(valence_of(word), F.lit(0.0)),
    )


def add_lexicon_sum(
    df: DataFrame, column: str, lexicon: WordTable, output: str = "valence"
) -> DataFrame:
    """``lexicon_sum`` as a column, for a lexicon of any size."""
    found = word_lookup(df, word_tokens(F.col(column)), lexicon)
    total = F.aggregate(
        word_tokens(F.col(column)),
        F.lit(0.0),
        lambda done, word: done + F.coalesce(found.value_of(word), F.lit(0.0)),
    )
    return found.without_helpers(found.rows.withColumn(output, total))


def label_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("rows"))
