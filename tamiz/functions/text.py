"""Text keys: spaces, hyphens, accents, case, splits. All native Column expressions."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white space, spelled so that Java and RE2 read it alike.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
# A private-use character that marks a longer decomposition during translation.
MANY = "\uE000"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Apply `use` to a value that is computed only once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def strip_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def tighten_hyphens(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}*-{SPACE}*", "-")


def trim_columns(df, *names: str):
    """Trim plain spaces on the named columns, all in one projection."""
    return df.withColumns({name: F.trim(F.col(name)) for name in names})


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions without combining marks, by rule from Unicode.

    Returns the two `translate` strings and the characters that decompose into several.
    In `translate` those (and Hangul syllables) become MANY; characters beyond the end
    of the second string are deleted.
    """
    single, dropped, several = {}, [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if HANGUL_FIRST <= code <= HANGUL_LAST or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if plain == char:
            continue
        if not plain:
            dropped.append(char)
        elif len(plain) == 1:
            single[char] = plain
        else:
            several[char] = plain
    many = [*several, *map(chr, range(HANGUL_FIRST, HANGUL_LAST + 1))]
    source = "".join([*single, *many, *dropped])
    return source, "".join(single.values()) + MANY * len(many), several


def _syllable(char: Column) -> Column:
    """Hangul syllables decompose by arithmetic on the code point."""
    index = F.ascii(char) - F.lit(HANGUL_FIRST)

    def letter(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")

    lead = letter(F.lit(0x1100) + F.floor(index / 588))
    vowel = letter(F.lit(0x1161) + F.floor((index % 588) / 28))
    tail = F.when(index % 28 == 0, "").otherwise(letter(F.lit(0x11A7) + index % 28))
    return F.concat(lead, vowel, tail)


def strip_accents(text: Column) -> Column:
    """Compatibility decomposition (NFKD) without combining marks.

    ASCII text passes through and other text takes one `translate`. Only if that met a
    character with a longer decomposition is the text spelled out character by character.
    """
    source, target, several = _decompositions()
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")

    def expand(char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code.between(HANGUL_FIRST, HANGUL_LAST), _syllable(char)).otherwise(
            F.coalesce(F.try_element_at(table, char), F.translate(char, source, target))
        )

    def plain(value: Column) -> Column:
        spelled = F.array_join(F.transform(F.split(value, ""), expand), "")
        translated = bind(
            F.translate(value, source, target),
            lambda t: F.when(t.contains(MANY), spelled).otherwise(t),
        )
        return F.when(~value.rlike(r"[^\x00-\x7F]"), value).otherwise(translated)

    return bind(text, plain)


def country_key(name: Column) -> Column:
    """Upper-case key without accents or stray spaces; NULL becomes ''."""
    return F.coalesce(F.upper(strip_accents(collapse_space(strip_space(name)))), F.lit(""))


def district_key(name: Column) -> Column:
    """Like `country_key`, with spaced hyphens closed up first."""
    return F.coalesce(
        F.upper(strip_accents(collapse_space(tighten_hyphens(strip_space(name))))), F.lit("")
    )


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, also after hyphens and apostrophes."""
    runs = F.split(text, r"(?<=[^\p{L}])")
    return F.array_join(F.transform(runs, F.initcap), "")


def capitalise(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def split_first(text: Column, separator: str) -> Column:
    """struct<found, left, right> around the first separator, both sides trimmed.

    Without a separator both sides are ''.
    """
    pattern = rf"(?s)^(.*?){re.escape(separator)}(.*)$"
    return F.struct(
        text.contains(separator).alias("found"),
        F.trim(F.regexp_extract(text, pattern, 1)).alias("left"),
        F.trim(F.regexp_extract(text, pattern, 2)).alias("right"),
    )


def label(template: str, *parts: Column) -> Column:
    """Popup or label text from a printf template."""
    return F.format_string(template, *parts)
