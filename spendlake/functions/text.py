"""Text columns: tokens, HTML cells, money, dates and percentages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.fixed import COLOR_DOWN, COLOR_SAME, COLOR_UP, CURRENCY_SUFFIX

# HTML replacements in the order they are applied.
_HTML = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


def tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case runs of letters and digits, in order and with repeats, without stop words."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    dropped = F.array(*[F.lit(word) for word in ("", *stop_words)])
    return F.filter(words, lambda word: ~F.array_contains(dropped, word))


# Entries of a user dictionary; they are part of the plan.
MAX_PHRASES = 1000


def joined_phrases(listed: Column, phrases: Mapping[str, str]) -> Column:
    """The tokens with every phrase of the dictionary replaced: from the left on, the longest that begins at each place.

    ``phrases`` maps tokens joined by spaces to what takes their place, one token or several. What a phrase covers
    begins no other.
    """
    if len(phrases) > MAX_PHRASES:
        raise ValueError(f"at most {MAX_PHRASES} phrases, not {len(phrases)}")
    if not phrases:
        return listed
    known = F.create_map(*[F.lit(text) for entry in sorted(phrases.items()) for text in entry])
    sizes = sorted({len(phrase.split(" ")) for phrase in phrases}, reverse=True)

    def found(at: Column) -> Column:
        """(size, text) of the longest phrase at a place, of the token itself where there is none."""
        one = F.struct(F.lit(1).alias("size"), F.get(listed, at - 1).alias("text"))
        for size in reversed(sizes):
            text = F.try_element_at(known, F.array_join(F.slice(listed, at, size), " "))
            fits = text.isNotNull() & (at + size - 1 <= F.size(listed))
            one = F.when(fits, F.struct(F.lit(size).alias("size"), text.alias("text"))).otherwise(one)
        return one

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("made"))

    def step(state: Column, place: Column) -> Column:
        made = F.concat(state["made"], F.split(place["text"], " "))
        taken = F.struct((place["at"] + place["size"]).alias("next"), made.alias("made"))
        return F.when(place["at"] < state["next"], state).otherwise(taken)

    places = F.transform(
        F.sequence(F.lit(1), F.size(listed)),
        lambda at: F.struct(at.alias("at"), found(at)["size"].alias("size"), found(at)["text"].alias("text")),
    )
    joined = F.aggregate(places, start, step, lambda state: state["made"])
    return F.when(F.size(listed) > 0, joined).otherwise(listed)


def separated_tokens(text: Column) -> Column:
    """Parts between commas or bars, as they stand."""
    return F.filter(F.split(text, r"[,]|[|]"), lambda part: part != "")


def escape_html(text: Column) -> Column:
    for plain, escaped in _HTML:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def cell_text(text: Column) -> Column:
    """Escaped text, or a dash where there is none."""
    return F.when(F.coalesce(text, F.lit("")) == "", "-").otherwise(escape_html(text))


def money_text(amount: Column) -> Column:
    return F.format_number(amount, 0)


def won_text(amount: Column) -> Column:
    return F.concat(money_text(amount), F.lit(CURRENCY_SUFFIX))


def date_text(day: Column) -> Column:
    return F.concat(
        F.year(day).cast("string"),
        F.lit("년 "),
        F.month(day).cast("string"),
        F.lit("월 "),
        F.day(day).cast("string"),
        F.lit("일"),
    )


def round_tenth(value: Column) -> Column:
    """Half away from zero, to one decimal."""
    return F.round(value * 10) / 10


def percent_text(value: Column) -> Column:
    return F.format_string("%.1f%%", value)


def change_percent(current: Column, previous: Column) -> Column:
    """Change against the previous total in percent; NULL when there was none."""
    share = F.try_divide((current - previous).cast("double"), previous.cast("double"))
    return F.round(share * 1000) / 10


def change_text(current: Column, previous: Column) -> Column:
    diff = current - previous
    change = change_percent(current, previous)
    # A change too small to show keeps its sign, as floating-point zero does.
    tiny_fall = (change == 0) & (F.signum(diff) != F.signum(previous))
    percent = F.when(tiny_fall, "-0.0%").otherwise(percent_text(change))
    rise = F.concat(F.lit("▲ +"), percent, F.lit(" (+"), won_text(diff), F.lit(")"))
    fall = F.concat(F.lit("▼ "), percent, F.lit(" (-"), won_text(-diff), F.lit(")"))
    return (
        F.when(previous == 0, "-").when(diff > 0, rise).when(diff < 0, fall).otherwise("━ 0.0% (0 원)")
    )


def change_color(current: Column, previous: Column) -> Column:
    return (
        F.when((previous == 0) | (current == previous), COLOR_SAME)
        .when(current > previous, COLOR_UP)
        .otherwise(COLOR_DOWN)
    )


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """The template with each ``{{NAME}}`` replaced, in the order the values are given."""
    filled = F.lit(template)
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{{" + name + "}}"), value.cast("string"))
    return filled
