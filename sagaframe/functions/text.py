"""Text scalars as Column functions: cleaning, keys, ids, grams, numbers. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters and digits of any script; what is not one of them never counts in a key.
NOT_WORD = r"[^\p{L}\p{N}]+"
_EDGES = r"(?U)^\s+|\s+$"


def clean_text(c: Column) -> Column:
    """Null to empty, white space of any kind off both ends."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), _EDGES, "")


def normalize_name(c: Column) -> Column:
    """Key of a name: its letters and digits in lower case."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), NOT_WORD, ""))


def text_key(c: Column) -> Column:
    """Key of a text: without white space, in lower case."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", ""))


def stable_id(prefix: str | Column, text: Column) -> Column:
    """prefix, underscore, first ten hex digits of the text's SHA-1."""
    first = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(first, F.lit("_"), F.substring(F.sha1(text), 1, 10))


def slugify(c: Column, filler: str = "item") -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(clean_text(c)), NOT_WORD, "-"), "^-+|-+$", "")
    return F.when(slug == "", F.lit(filler)).otherwise(slug)


def casefold(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def first_nonempty(*cs: Column) -> Column:
    return F.coalesce(*[F.nullif(clean_text(c), F.lit("")) for c in cs], F.lit(""))


def ordered_unique(values: Column, limit: int | None = None) -> Column:
    """Cleaned, non-empty values at their first occurrence, at most `limit`."""
    found = F.array_distinct(F.filter(F.transform(values, clean_text), lambda x: x != ""))
    return found if limit is None else F.slice(found, 1, limit)


def joined_parts(*cs: Column) -> Column:
    """Non-empty parts joined by " | "."""
    return F.concat_ws(" | ", *[F.nullif(clean_text(c), F.lit("")) for c in cs])


def truncated(c: Column, limit: int) -> Column:
    return F.when(F.char_length(c) <= limit, c).otherwise(F.concat(F.rtrim(F.substring(c, 1, limit - 3)), F.lit("...")))


def snippet(c: Column, needle: Column | str, radius: int = 36) -> Column:
    """Text around the first occurrence; empty without one."""
    key = F.lit(needle) if isinstance(needle, str) else needle
    at = F.instr(c, key)
    start = F.greatest(at - radius, F.lit(1))
    return F.when(at > 0, F.substring(c, start, at - start + F.char_length(key) + radius)).otherwise("")


def anchors(c: Column, size: int) -> Column:
    """Head and tail of a text."""
    return F.struct(F.substring(c, 1, size).alias("head"), F.when(F.char_length(c) > size, F.right(c, F.lit(size))).otherwise("").alias("tail"))


def token_estimate(c: Column, floor: int = 64, per_token: float = 1.6) -> Column:
    return F.greatest(F.lit(floor), F.ceil(F.char_length(c) / F.lit(per_token))).cast("long")


def prompt_tokens(c: Column) -> Column:
    return F.greatest((F.char_length(c) * F.lit(0.8)).cast("long"), F.lit(1).cast("long"))


def clip_ratio(a: Column, b: Column | float) -> Column:
    """a / b within 0 and 1 at four places; 0 where b isn't positive."""
    b = F.lit(float(b)) if isinstance(b, (int, float)) else b.cast("double")
    return F.when(b <= 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), F.least(a / b, F.lit(1.0))), 4))


def round4(c: Column) -> Column:
    """Four places. Weighted sums of such numbers often end in a half; it goes up on whichever side of it floating point lands."""
    return F.round(c + 1e-9, 4)


def char_grams(c: Column) -> Column:
    """Distinct pairs of neighbouring characters; a single character stands for itself. The text is split once, not searched for each place."""
    signs = F.filter(F.split(c, ""), lambda x: x != "")
    pairs = F.zip_with(F.slice(signs, 1, F.greatest(F.size(signs) - 1, F.lit(0))), F.slice(signs, 2, F.greatest(F.size(signs) - 1, F.lit(0))), lambda a, b: F.concat(a, b))
    return F.when(F.char_length(c) <= 1, signs).otherwise(F.array_distinct(pairs))


def natural_key(c: Column) -> list[Column]:
    """Sort keys of chapter ids: numbers by value, then texts, then empty ones."""
    digits = c.rlike(r"^\d+$")
    return [F.when(digits, 0).when(F.coalesce(c, F.lit("")) != "", 1).otherwise(2), F.when(digits, c.cast("decimal(38,0)")), F.coalesce(c, F.lit(""))]


def fingerprint(*cs: Column) -> Column:
    """SHA-256 of the canonical JSON of the columns."""
    return F.sha2(F.to_json(F.struct(*cs), {"ignoreNullFields": "false"}), 256)


def keyword_hits(c: Column, words: Sequence[str]) -> Column:
    """How many of the words a text holds."""
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))) if words else F.lit(0)


def numeral_value(c: Column, digits: dict[str, int], units: dict[str, int], sections: dict[str, int]) -> Column:
    """Value of a numeral written with digits, units (ten, hundred, ...) and section units (ten thousand, ...); null if any sign is none of them.

    The tables are data: any script's numerals of this kind can be read.
    """
    def table(d: dict[str, int]) -> Column:
        return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v).cast("long"))]) if d else F.create_map().cast("map<string,bigint>")

    ds, us, ss, zero = table(digits), table(units), table(sections), F.lit(0).cast("long")

    def step(acc: Column, x: Column) -> Column:
        section = acc["section"] + F.when(acc["number"] == 0, F.when(acc["section"] == 0, 1).otherwise(0)).otherwise(acc["number"]) * us[x]
        return (
            F.when(ds[x].isNotNull(), F.struct(acc["total"].alias("total"), acc["section"].alias("section"), ds[x].alias("number"), acc["ok"].alias("ok")))
            .when(us[x].isNotNull(), F.struct(acc["total"].alias("total"), section.alias("section"), zero.alias("number"), acc["ok"].alias("ok")))
            .when(ss[x].isNotNull(), F.struct((acc["total"] + (acc["section"] + acc["number"]) * ss[x]).alias("total"), zero.alias("section"), zero.alias("number"), acc["ok"].alias("ok")))
            .otherwise(F.struct(acc["total"].alias("total"), acc["section"].alias("section"), acc["number"].alias("number"), F.lit(False).alias("ok")))
        )

    start = F.struct(zero.alias("total"), zero.alias("section"), zero.alias("number"), F.lit(True).alias("ok"))
    done = F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), start, step)
    return F.when(done["ok"] & (F.char_length(c) > 0), done["total"] + done["section"] + done["number"])
