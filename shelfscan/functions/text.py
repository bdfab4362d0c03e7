"""Text helpers: ordered rules, title case and dollar text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which the warehouse's INITCAP starts a new word,
# besides white space.
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

# Product family rules, first match wins, on the lower-cased category name.
FAMILY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("whisk", "bourbon", "scotch", "rye"), "WHISKIES"),
    (("brandi",), "BRANDIES"),
    (("vodka",), "VODKAS"),
    (("wine",), "WINES"),
    (("gin",), "GINS"),
    (("liqueur", "triple sec", "cordial"), "LIQUEURS"),
    (("tequila",), "TEQUILAS"),
    (("schnapps",), "SCHNAPPS"),
    (("rum",), "RUMS"),
    (("mezcal",), "MEZCALS"),
    (("beer",), "BEERS"),
    (("champagne", "sparkling"), "CHAMPAGNE & SPARKLING"),
    (("sake",), "SAKE"),
    (("absinthe",), "ABSINTHE"),
    (("bitters",), "BITTERS"),
    (("vermouth",), "VERMOUTH"),
    (("cocktail",), "COCKTAIL MIXERS"),
    (("neutral grain spirits",), "NEUTRAL SPIRITS"),
    (("distilled spirits specialty", "temporary & specialty", "special order items"),
     "SPECIALTY SPIRITS"),
]
OTHER_FAMILY = "OTHER"


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when the text holds at least one of the words."""
    return reduce(or_, [text.contains(word) for word in words])


def first_match(text: Column, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """Label of the first rule with a word in the text; NULL text gets the default."""
    (words, label), *others = rules
    choice = F.when(contains_any(text, words), F.lit(label))
    for words, label in others:
        choice = choice.when(contains_any(text, words), F.lit(label))
    return choice.otherwise(F.lit(default))


def product_family(category_name: Column) -> Column:
    return first_match(F.lower(category_name), FAMILY_RULES, OTHER_FAMILY)


def title_case(text: Column, breaks: str = WORD_BREAKS) -> Column:
    """INITCAP that also starts a word after the given characters.

    Spark's ``initcap`` breaks at blanks only, so a mark and a blank are put behind
    every other break and taken out again afterwards.
    """
    if not breaks:
        return F.initcap(text)
    mark = "\u0001 "
    pattern = "([\\t\\n\\r" + re.escape(breaks).replace('"', '\\"') + "])"
    spaced = F.regexp_replace(text, pattern, "$1" + mark)
    return F.replace(F.initcap(spaced), F.lit(mark), F.lit(""))


def dollars(amount: Column) -> Column:
    """Whole dollars with thousands marks, such as ``$1,234,567`` or ``-$12``."""
    rounded = F.round(amount.cast("decimal(30,4)"), 0).cast("decimal(26,0)")
    sign = F.when(rounded < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$"), F.format_number(F.abs(rounded), 0))
