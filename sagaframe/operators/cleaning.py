"""Noise removal from texts. Rules are data; every rule is a Column expression, so a cleaned text costs no shuffle and no Python."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sagaframe.functions.text import clean_text


@dataclass(frozen=True)
class NoiseRules:
    """A line is noise if it holds all words of a combination or matches a pattern; fragments go wherever they stand."""

    combinations: tuple[tuple[str, ...], ...] = ()
    line_patterns: tuple[str, ...] = ()
    fragments: tuple[str, ...] = ()
    promo_words: tuple[str, ...] = ()
    end_markers: tuple[str, ...] = ()
    meta_titles: tuple[str, ...] = ()


def is_noise_line(line: Column, rules: NoiseRules) -> Column:
    found = F.lit(False)
    for words in rules.combinations:
        every = F.lit(True)
        for w in words:
            every = every & F.contains(line, F.lit(w))
        found = found | every
    for pattern in rules.line_patterns:
        found = found | line.rlike(pattern)
    return found


def has_noise(text: Column, rules: NoiseRules) -> Column:
    lines = F.exists(F.split(text, "\n"), lambda line: is_noise_line(line, rules))
    return lines | (text.rlike("|".join(f"(?:{p})" for p in rules.fragments)) if rules.fragments else F.lit(False))


def strip_noise(text: Column, rules: NoiseRules) -> Column:
    """Struct of the cleaned text, lines removed and fragments removed."""
    text = F.coalesce(text, F.lit(""))
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda line: ~is_noise_line(line, rules))
    joined = F.array_join(kept, "\n")
    fragments = F.lit(0)
    for p in rules.fragments:
        fragments = fragments + F.regexp_count(joined, F.lit(p))
    for p in rules.fragments:
        joined = F.regexp_replace(joined, p, "")
    joined = clean_text(F.regexp_replace(joined, r"\n{3,}", "\n\n"))
    return F.struct(joined.alias("text"), (F.size(lines) - F.size(kept)).cast("long").alias("lines_removed"), fragments.cast("long").alias("fragments_removed"))


def cut_after_marker(text: Column, markers: tuple[str, ...]) -> Column:
    """The text up to the first end marker."""
    for m in markers:
        at = F.instr(text, m)
        text = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    return text


def is_promo_block(block: Column, words: tuple[str, ...]) -> Column:
    """Two promo words, or promo words on all lines but one (two lines at least)."""
    hit = lambda line: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(line, w))
    hits = F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(block, w)))
    lines = F.filter(F.split(block, "\n"), lambda x: clean_text(x) != "")
    return (hits >= 2) | (F.size(F.filter(lines, hit)) >= F.greatest(F.lit(2), F.size(lines) - 1))


def strip_trailing_promo(text: Column, words: tuple[str, ...]) -> Column:
    """Drop paragraphs from the end while the last one is promotion."""
    if not words:
        return text
    blocks = F.filter(F.split(text, r"\n{2,}"), lambda b: clean_text(b) != "")
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(True).alias("end"))

    def step(acc: Column, b: Column) -> Column:
        drop = acc["end"] & is_promo_block(b, words)
        return F.struct(F.when(drop, acc["kept"]).otherwise(F.concat(F.array(b), acc["kept"])).alias("kept"), drop.alias("end"))

    return F.array_join(F.aggregate(F.reverse(blocks), start, step)["kept"], "\n\n")


def sanitize(text: Column, rules: NoiseRules) -> Column:
    """Marker cut, noise lines and fragments, trailing promotion, in this order."""
    return clean_text(strip_trailing_promo(strip_noise(cut_after_marker(F.coalesce(text, F.lit("")), rules.end_markers), rules)["text"], rules.promo_words))


def is_meta_chapter(title: Column, body: Column, rules: NoiseRules) -> Column:
    """A chapter whose title is none of the story's and whose body is promotion."""
    named = title.rlike("|".join(rules.meta_titles)) if rules.meta_titles else F.lit(False)
    return named & (is_promo_block(body, rules.promo_words) if rules.promo_words else F.lit(False))


def normalized_with_audit(text: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Struct of the rewritten text and an array of (rule, n) for the rules that applied; rules are (name, pattern, replacement)."""
    audit = []
    for name, pattern, replacement in rules:
        audit.append(F.struct(F.lit(name).alias("rule"), F.regexp_count(text, F.lit(pattern)).cast("long").alias("n")))
        text = F.regexp_replace(text, pattern, replacement)
    return F.struct(text.alias("text"), F.filter(F.array(*audit), lambda a: a["n"] > 0).alias("applied"))


def clean_nested(df: DataFrame, rules: NoiseRules) -> DataFrame:
    """Strip noise from every string at any depth of every column."""
    def walk(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return F.when(c.isNotNull(), strip_noise(c, rules)["text"])
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: walk(x, kind.elementType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[walk(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
        if isinstance(kind, T.MapType):
            return F.transform_values(c, lambda _, v: walk(v, kind.valueType))
        return c

    return df.select(*[walk(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def backfill_report(before: DataFrame, after: DataFrame, key: str, text: str, dataset: str) -> DataFrame:
    """dataset, rows, changed, characters removed."""
    b, a = before.select(key, F.col(text).alias("b")), after.select(key, F.col(text).alias("a"))
    return b.join(a, key).agg(
        F.lit(dataset).alias("dataset"), F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("changed"),
        F.coalesce(F.sum(F.char_length("b") - F.char_length("a")), F.lit(0)).alias("chars_removed"),
    )
