"""Text cleanup: per-site removal patterns and generic line filters."""

import sys
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.fixed_values import BOILERPLATE_PHRASES
from pageloom.functions.text import contains_any, let, strip
from pageloom.functions.urls import rule_host

# Case-insensitive, dot matches line ends, Unicode classes.
PATTERN_FLAGS = "(?isU)"
#: Patterns in which no literal is looked for: choices, special groups, optional groups, numbers, quotes, odd classes.
_OPAQUE = r"[|]|\(\?|\)[?*{]|\\[QEpPkKxuc0-9NX]|\[\^?\]|&&"


@cache
def _odd_letters() -> tuple[str, str]:
    """Letters that a pattern takes for others of a different upper case, and these others."""
    simple = lambda c, how: x if len(x := how(c)) == 1 else c
    odd, plain = [], []
    for char in map(chr, range(0x80, sys.maxunicode + 1)):
        kept = simple(char, str.upper)
        small = simple(kept, str.lower) if char != "\u0130" else "i"
        if small != char and simple(small, str.upper) != kept:
            odd.append(char)
            plain.append(small)
    return "".join(odd), "".join(plain)


def probe(text: Column) -> Column:
    """The text in capitals, so that what a pattern takes for equal is equal.

    A class of single letters is tested letter by letter; the range before it passes over nearly all characters.
    """
    odd, plain = _odd_letters()
    any_odd = rf"[\x{{{ord(min(odd)):x}}}-\x{{{ord(max(odd)):x}}}&&[{odd}]]"
    return F.upper(F.when(text.rlike(any_odd), F.translate(text, odd, plain)).otherwise(text))


def required_literal(pattern: Column) -> Column:
    """In capitals, the longest stretch of plain characters that every match of a pattern must hold; empty if unknown.

    Escapes, classes and characters that may be left out part the stretches.
    """
    gap = "\x01"
    parted = F.regexp_replace(F.regexp_replace(pattern, r"(?s)\\.", gap), r"(?s)\[[^\]]*\]", gap)
    sure = F.regexp_replace(parted, r"(?s).(?:[?*]|\{[^}]*\})", gap)
    stretches = F.split(sure, r"[\x01.^$()+?*{}\[\]]+")
    longest = F.aggregate(stretches, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    return F.when(pattern.rlike(_OPAQUE), F.lit("")).otherwise(probe(longest))


def with_literals(rules: DataFrame) -> DataFrame:
    """Patterns as ``array<struct<pattern, literal>>``; the literal is found once for each rule."""
    checked = F.transform("patterns", lambda p: F.struct(p.alias("pattern"), required_literal(p).alias("literal")))
    return rules.withColumn("patterns", checked)


def may_match(probed: Column, rule: Column) -> Column:
    return (rule["literal"] == "") | F.contains(probed, rule["literal"])


def remove_patterns(text: Column, patterns: Column) -> Column:
    """Apply the removal patterns one after another.

    A pattern whose literal is not in the text is not tried, unless one before it has changed the text: that may bring
    together what was apart.
    """

    def step(state: Column, rule: Column) -> Column:
        tried = F.regexp_replace(state["body"], F.concat(F.lit(PATTERN_FLAGS), rule["pattern"]), F.lit(""))
        body = F.when(state["changed"] | may_match(state["probed"], rule), tried).otherwise(state["body"])
        return let(
            body,
            lambda b: F.struct(
                b.alias("body"), (state["changed"] | (b != state["body"])).alias("changed"), state["probed"].alias("probed")
            ),
        )

    start = F.struct(text.alias("body"), F.lit(False).alias("changed"), probe(text).alias("probed"))
    return F.aggregate(patterns, start, step, lambda state: state["body"])


def with_patterns(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``_patterns``, those of the page's host; null for other hosts."""
    keyed = with_literals(rules).select(F.col("domain").alias("rule_domain"), F.col("patterns").alias("_patterns"))
    return pages.join(keyed, rule_host(F.col("url")) == F.col("rule_domain"), "left").drop("rule_domain")


def apply_patterns(pages: DataFrame) -> DataFrame:
    """Clean ``article_body`` by the row's ``_patterns``, which end here."""
    cleaned = F.when(
        F.col("_patterns").isNotNull(), remove_patterns(F.col("article_body"), F.col("_patterns"))
    ).otherwise(F.col("article_body"))
    return pages.withColumn("article_body", cleaned).drop("_patterns")


def apply_site_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Clean ``article_body`` by the rules of the page's host; other hosts stay as they are."""
    return apply_patterns(with_patterns(pages, rules))


def clean_lines(text: Column) -> Column:
    """Drop lines holding a boilerplate phrase, then strip the text."""
    kept = F.array_join(
        F.filter(F.split(text, "\n"), lambda line: ~contains_any(line, BOILERPLATE_PHRASES)), "\n"
    )
    return strip(F.when(contains_any(text, BOILERPLATE_PHRASES), kept).otherwise(text))


def drop_boilerplate_lines(pages: DataFrame) -> DataFrame:
    return pages.withColumn("article_body", clean_lines(F.col("article_body")))
