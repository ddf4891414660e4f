"""Name and label functions as Catalyst expressions; no Python runs per row."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

SUFFIX = r"( (JR|SR|II|III|IV))+$"


@lru_cache(maxsize=1)
def _marks() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters that decompose into one ASCII letter with marks, as a translate table; those that give several letters, as pairs."""
    one_from, one_to, many = [], [], []
    for cp in [*range(0x80, 0x2000), *range(0xFB00, 0xFB07), *range(0xFF21, 0xFF5B)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        base = "".join(c if c.isascii() and c.isalpha() else " " for c in base)
        if not base.strip():
            continue  # nothing but blanks is left of it, as of any other mark
        if len(base) == 1:
            one_from.append(chr(cp))
            one_to.append(base)
        else:
            many.append((chr(cp), base))
    return "".join(one_from), "".join(one_to), many


def normalize_name(c: Column) -> Column:
    """Upper-case ASCII letters and single blanks: marks are dropped, everything else becomes a blank."""
    frm, to, many = _marks()
    for x, y in many:
        c = F.replace(c, F.lit(x), F.lit(y))
    bare = F.regexp_replace(F.translate(c, frm, to), r"\p{M}+", "")
    return F.trim(F.regexp_replace(F.upper(bare), "[^A-Z]+", " "))


def match_key(c: Column) -> Column:
    """The normalised name without trailing generation suffixes; a name that is only a suffix stays."""
    return F.regexp_replace(normalize_name(c), SUFFIX, "")


def reorder_name(c: Column) -> Column:
    """``LAST, First`` -> ``First LAST``, split at the first comma; names without a comma pass."""
    last, first = F.trim(F.get(F.split(c, ",", 2), F.lit(0))), F.trim(F.get(F.split(c, ",", 2), F.lit(1)))
    return F.when(F.contains(c, F.lit(",")), F.concat_ws(" ", first, last)).otherwise(c)


def abbreviate_name(c: Column) -> Column:
    """``First Rest`` -> ``F. Rest``; one token stays."""
    t = F.trim(c)
    rest = F.trim(F.get(F.split(t, " ", 2), F.lit(1)))
    return F.when(F.coalesce(rest, F.lit("")) != "", F.concat(F.left(t, F.lit(1)), F.lit(". "), rest)).otherwise(t)


def title_case(c: Column) -> Column:
    """A capital after every non-letter, small letters elsewhere."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1_000_000)))), "")


def full_name(c: Column) -> Column:
    """A box-score spelling as a full name."""
    return title_case(reorder_name(c))


def pad3(c: Column) -> Column:
    """At least three digits; longer numbers keep all of theirs."""
    return F.format_string("%03d", c)


def rounds_label(rounds: Column) -> Column:
    """``5`` for one round, ``5-9`` for the first and last of several."""
    first, last = F.get(rounds, F.lit(0)).cast("string"), F.get(rounds, F.size(rounds) - 1).cast("string")
    return F.when(F.size(rounds) > 1, F.concat(first, F.lit("-"), last)).otherwise(first)


def name_tokens(c: Column) -> Column:
    """The distinct words of a normalised name."""
    return F.array_distinct(F.filter(F.split(normalize_name(c), " "), lambda x: x != ""))


def surname_tokens(stats_name: Column) -> Column:
    """The words of a listed name (``J. Begarin``) behind its first blank."""
    return name_tokens(F.get(F.split(stats_name, " ", 2), F.lit(1)))


def minutes_number(c: Column) -> Column:
    """``MM:SS`` as minutes; ``DNP`` and blanks are 0, null stays null."""
    m = F.trim(c)
    at = F.split(m, ":")
    clock = F.get(at, F.lit(0)).try_cast("int") + F.get(at, F.lit(1)).try_cast("int") / F.lit(60.0)
    return F.when(m.isin("", "DNP"), F.lit(0.0)).otherwise(clock)
