"""Writing-style measures of single texts: projections, no shuffle.

Words, their repetitions, the characters' entropy and phrases are counted by one small Arrow function, which
takes a sixth of the processor time of arrays of words in the JVM; the measures are native.
"""

import math
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chars, text as tx
from .constants import AI_TELLS, EXTRA_FEATURES, NUMERIC_FEATURES, STOPWORDS

_STOPWORDS = frozenset(STOPWORDS)
# Decimal places of the features the corpus builder stores.
_STORED_PLACES = {
    "avg_word_len": 2, "vocab_div_ratio": 2, "complex_word_ratio": 2,
    "stopword_ratio": 2, "upper_letter_ratio": 2, "doc_pos": 2,
    "char_entropy": 3, "rep_bigram": 3,
}


# The same characters as ``chars.WORD``.
_WORDS = re.compile(r"\w+")
_COUNTS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("words", "letters", "long", "kinds", "stops", "pairs")]
                       + [T.StructField("entropy", T.DoubleType()), T.StructField("tells", T.IntegerType())])
_ARROW = pa.struct([*[(f.name, pa.int32()) for f in _COUNTS[:6]], ("entropy", pa.float64()), ("tells", pa.int32())])
# Texts up to this length are searched for phrases together.
_SHORT = 4096


def _counts(text: str) -> tuple:
    """Words, their characters, those of seven and more, different ones, stopwords, different pairs,
    and the Shannon entropy of the characters in bits, 0 for an empty text."""
    kinds = set(text)
    if len(kinds) <= 128:
        # A scan for each character is faster than a look at each place.
        sizes, blanked = map(text.count, kinds), text
        for c in kinds:
            if not (c.isalnum() or c == "_"):
                blanked = blanked.replace(c, " ")
    else:
        sizes, blanked = Counter(text).values(), " ".join(_WORDS.findall(text))
    entropy = math.log2(len(text)) - sum(n * math.log2(n) for n in sorted(sizes)) / len(text) if text else 0.0
    words, low = blanked.split(), blanked.lower().split()
    return (len(words), len(blanked) - blanked.count(" "), sum(map((7).__le__, map(len, words))), len(set(low)),
            sum(map(_STOPWORDS.__contains__, low)), len(set(zip(low, low[1:]))), entropy)


def _phrases_found(lowered: list[str], lexicon: tuple) -> list[int]:
    """How many of the phrases each text holds: short texts are searched as one, behind separators."""
    found = [0 if len(t) <= _SHORT else sum(map(t.__contains__, lexicon)) for t in lowered]
    short = [k for k, t in enumerate(lowered) if len(t) <= _SHORT]
    starts = list(accumulate((len(lowered[k]) + 1 for k in short), initial=0))
    joined = "\0".join(lowered[k] for k in short)
    for phrase in lexicon:
        at = joined.find(phrase)
        while at >= 0:
            place = bisect_right(starts, at) - 1
            found[short[place]] += 1
            at = joined.find(phrase, starts[place + 1])
    return found


@lru_cache
def _counted_with(lexicon: tuple):
    apart = all(phrase and "\0" not in phrase for phrase in lexicon)

    def counted(texts: list) -> list[tuple]:
        lowered = [t.lower() if t and lexicon else "" for t in texts]
        tells = _phrases_found(lowered, lexicon) if apart else [sum(map(t.__contains__, lexicon)) for t in lowered]
        return [(None,) * len(_ARROW) if t is None else (*_counts(t), n) for t, n in zip(texts, tells)]

    @F.arrow_udf(_COUNTS)
    def batch(texts: pa.Array) -> pa.Array:
        rows = [row for part in tx.held_parts(texts) for row in counted(part.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], fields=list(_ARROW))

    # Computed once and not again in filters, as the cleaned text is.
    return batch.asNondeterministic()


def word_bigrams(tokens: Column) -> Column:
    """Adjacent pairs joined by a space; empty below two words."""
    n = F.size(tokens)
    pairs = F.zip_with(
        F.slice(tokens, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def tell_count(lowered: Column, lexicon=AI_TELLS) -> Column:
    """Distinct lexicon entries occurring as substrings."""
    return sum((F.contains(lowered, F.lit(entry)).cast("int") for entry in lexicon), F.lit(0))


def _rounder(places: int):
    return lambda value: tx.python_round(value, places)


def stylometry(
    df: DataFrame, *, text_col: str = "text", position: Column | None = None,
    total: Column | None = None, rounded: bool = False,
    features=NUMERIC_FEATURES, lexicon=AI_TELLS,
) -> DataFrame:
    """Append style features of ``text_col``; each is narrow, so no row moves.

    Words are counted once and the counts shared. Columns not asked for are pruned
    together with the work they need.
    """
    position = F.lit(0) if position is None else position
    total = F.lit(1) if total is None else total
    text = F.col(text_col)
    keep = [c for c in df.columns if c not in features]
    staged = df.select(*keep, position.alias("_pos"), total.alias("_total")).withColumns({
        "_counts": _counted_with(tuple(lexicon) if "ai_tell_count" in features else ())(text), "_chars": F.length(text)})
    n = F.col("_counts.words")
    per_word = F.greatest(n, F.lit(1))
    per_char = F.greatest("_chars", F.lit(1))
    formulas = {
        "char_count": F.col("_chars"),
        "word_count": n,
        "avg_word_len": F.col("_counts.letters") / per_word,
        "vocab_div_ratio": F.when(n > 0, F.col("_counts.kinds")).otherwise(0) / per_word,
        "complex_word_ratio": F.col("_counts.long") / per_word,
        "stopword_ratio": F.col("_counts.stops") / per_word,
        "upper_letter_ratio": tx.count_class(text, r"\p{IsUppercase}") / per_char,
        "semicolon_dash_count": F.col("_chars") - F.length(F.translate(text, ";-", "")),
        "char_entropy": F.coalesce(F.col("_counts.entropy"), F.lit(0.0)),
        "rep_bigram": F.when(n < 3, F.lit(0.0)).otherwise(
            1.0 - F.try_divide(F.col("_counts.pairs"), n - 1)
        ),
        "ai_tell_count": F.col("_counts.tells"),
        "doc_pos": F.col("_pos") / F.greatest(F.col("_total") - 1, F.lit(1)),
        "numeric_digit_ratio": tx.count_class(text, chars.digit_class()) / per_char,
        "is_first_sent": (F.col("_pos") == 0).cast("int"),
        "is_last_sent": (F.col("_pos") == F.col("_total") - 1).cast("int"),
    }
    staged = staged.where(n > 0) if rounded else staged
    if not rounded:
        return staged.select(*keep, *[formulas[name].alias(name) for name in features])
    # One short loop for all values of as many places: written out for each, the generated
    # method would be longer than what the JVM compiles.
    places = {p: [name for name in features if _STORED_PLACES.get(name) == p] for p in (2, 3)}
    values = staged.select(*keep, *[formulas[name].alias(name) for name in features if name not in _STORED_PLACES], *[
        tx.computed_once(F.transform(
            F.array(*[formulas[name].cast("double") for name in names]), _rounder(p))).alias(f"_rounded{p}")
        for p, names in places.items() if names])
    return values.select(*keep, *[
        F.col(f"_rounded{_STORED_PLACES[name]}")[places[_STORED_PLACES[name]].index(name)].alias(name)
        if name in _STORED_PLACES else F.col(name) for name in features])


ALL_FEATURES = (*NUMERIC_FEATURES, *EXTRA_FEATURES)
