"""Text functions as Columns. Lengths count code points; white space is Unicode white space as listed in SPACE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
WS = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once: a name inside a lambda, where an expression would be evaluated for each element."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Without white space at both ends; null becomes empty."""
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(SPACE))


def words(c: Column | str) -> Column:
    return F.filter(F.split(col(c), WS + "+"), lambda x: x != "")


def n_words(c: Column | str) -> Column:
    return F.size(words(c))


def lines(c: Column | str) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), "\n"), strip), lambda x: x != "")


def sentences(c: Column | str) -> Column:
    return F.split(col(c), r"(?<=[.!?])" + WS + "+")


def first_sentence(c: Column | str) -> Column:
    return strip(F.try_element_at(sentences(c), F.lit(1)))


def paragraphs(c: Column | str, separator: str = "\n\n+") -> Column:
    """Stripped paragraphs that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), separator), strip), lambda x: x != "")


def collapse(c: Column | str) -> Column:
    return F.regexp_replace(strip(F.lower(col(c))), WS + "+", " ")


def fingerprint(c: Column | str, size: int = 400) -> Column:
    """Key of near-equal texts: their first `size` collapsed lower-case characters."""
    return F.md5(F.substring(collapse(c), 1, size))


def tokens(c: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(pattern), F.lit(0))


def has_any(c: Column, parts: Sequence[str]) -> Column:
    """Whether any of the parts is in the text."""
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def token_estimate(c: Column | str) -> Column:
    """About 1.3 tokens a word, rounded down, 1 at least; 0 for an empty text."""
    c = F.coalesce(col(c), F.lit(""))
    return F.when(c == "", 0).otherwise(F.greatest(F.lit(1), F.floor(n_words(c) * 1.3).cast("int"))).cast("int")


def bullets(items: Column) -> Column:
    """Each item on a line of its own after a dash; nothing for no items."""
    made = F.transform(F.filter(items, lambda x: x.isNotNull() & (x != "")), lambda x: F.concat(F.lit("\n- "), strip(x)))
    return F.when(F.size(F.coalesce(items, F.array().cast("array<string>"))) == 0, "").otherwise(F.array_join(made, ""))


def render(template: Column, variables: Column) -> Column:
    """template with each ⟦name⟧ replaced by the map's value."""
    return F.aggregate(F.map_entries(variables), template, lambda acc, kv: F.replace(acc, F.concat(F.lit("⟦"), kv["key"], F.lit("⟧")), F.coalesce(kv["value"], F.lit(""))))


def nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def first_nonempty(*cs: Column) -> Column:
    """The first that is neither null nor empty, or empty."""
    return F.coalesce(*(F.when(c != "", c) for c in cs), F.lit(""))
