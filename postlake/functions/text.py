"""Splitting, escaping and normalising text."""

from __future__ import annotations

import json
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a text is split or stripped.
_SPACES = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def _plain_spaces(text: Column) -> Column:
    return F.translate(text, _SPACES, " " * len(_SPACES))


def words(text: Column) -> Column:
    """Split on runs of white space; blank text gives an empty array."""
    return F.array_remove(F.split(_plain_spaces(text), " "), "")


def joined_words(text: Column, separator: str) -> Column:
    """The words of ``text`` in one string; NULL if there are none."""
    blanks = F.regexp_replace(F.trim(_plain_spaces(text)), " +", separator)
    return F.nullif(blanks, F.lit(""))


def split_tags(text: Column) -> Column:
    """Split on every single space, so repeated spaces give empty tokens."""
    return F.split(text, " ")


def tokenize_query(text: Column) -> Column:
    return words(text)


def normalize_query(text: Column) -> Column:
    return F.replace(strip(text), F.lit(" "), F.lit("_"))


def sanitize_folder(text: Column) -> Column:
    """Replace every character that is unsafe in a folder name by an underscore."""
    unsafe = '<>:"/|?* ,'
    return F.translate(text, unsafe, "_" * len(unsafe))


def _replace_each(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def html_escape(text: Column) -> Column:
    return _replace_each(
        text,
        (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")),
    )


# A reference: numeric, or a name of up to 32 characters, with or without a semicolon.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LAST = 0x10FFFF


def _windows_code(code: int) -> str:
    """What a reference to a C1 control stands for: the Windows-1252 character, where there is one."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _numbered(digits: Column, base: int) -> Column:
    """The character of a numeric reference; nothing for one that stands for no character."""
    short = F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0"))
    code = F.when(F.length(short) > 8, F.lit(_LAST + 1).cast("bigint")).otherwise(F.conv(short, base, 10).cast("bigint"))
    windows = F.array(*(F.lit(_windows_code(one)) for one in range(0x80, 0xA0)))
    low = code.bitwiseAND(F.lit(0xFFFF))
    nothing = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF) | low.isin(0xFFFE, 0xFFFF)
    )
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > _LAST), F.lit("\ufffd"))
        .when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int")))
        .when(nothing, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


_LONGEST_NAME = max(map(len, entities.html5))


def _by_beginning() -> dict[str, dict[str, str]]:
    """The named references by their first two letters, so that a name is held against few of them."""
    tables: dict[str, dict[str, str]] = {}
    for name, meant in entities.html5.items():
        tables.setdefault(name[:2], {})[name] = meant
    return tables


def _named(name: Column) -> Column:
    """The text of a named reference, without its ``&``: the longest known name it starts with, and
    the rest as it is."""
    tables = F.from_json(F.lit(json.dumps(_by_beginning())), "map<string,map<string,string>>")
    lengths = F.sequence(F.least(F.length(name), F.lit(_LONGEST_NAME)), F.lit(2), F.lit(-1))

    def longest(table: Column) -> Column:
        tries = F.transform(lengths, lambda n: F.concat(F.try_element_at(table, F.left(name, n)), F.substr(name, n + 1)))
        return F.when(table.isNotNull(), F.get(F.filter(tries, lambda text: text.isNotNull()), F.lit(0)))

    # One look at the tables per name: the one found is bound by the outer transform.
    one = F.array(F.try_element_at(tables, F.left(name, F.lit(2))))
    found = F.when(F.length(name) >= 2, F.get(F.transform(one, longest), F.lit(0)))
    return F.coalesce(found, F.concat(F.lit("&"), name))


def _reference(found: Column) -> Column:
    body = F.rtrim(F.substr(found, F.lit(3)), F.lit(";"))
    return (
        F.when(F.lower(F.left(found, F.lit(3))) == "&#x", _numbered(F.substr(body, F.lit(2)), 16))
        .when(F.left(found, F.lit(2)) == "&#", _numbered(body, 10))
        .otherwise(_named(F.substr(found, F.lit(2))))
    )


def html_unescape(text: Column) -> Column:
    """All HTML entities to text. Only texts with an ampersand are taken apart."""
    between = F.split(text, _REFERENCE)
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    whole = F.zip_with(
        between, found, lambda plain, one: F.concat(plain, F.when(one.isNotNull(), _reference(one)).otherwise(""))
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(whole, "")).otherwise(text)


def quote_names(text: Column) -> Column:
    """Percent-encode everything but ``A-Za-z0-9_.-~``."""
    return _replace_each(F.url_encode(text), (("+", "%20"), ("*", "%2A"), ("%7E", "~")))


def strip_backslash(token: Column) -> Column:
    return F.regexp_replace(token, r"^\\", "")


def entity_apostrophe(token: Column) -> Column:
    return F.replace(token, F.lit("'"), F.lit("&#039;"))


def tag_case_keys(token: Column) -> Column:
    """The spellings a dictionary may hold a token under: entity, lower, upper and as it is."""
    bare = strip_backslash(token)
    return F.array(entity_apostrophe(bare), F.lower(bare), F.upper(bare), bare)


def contains_any(text: Column, needles) -> Column:
    """True if any needle is a substring of the whole text; no needles match nothing."""
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle)
    return found


def has_any_token(text: Column, tokens) -> Column:
    """True if any of ``tokens`` equals a whole space-separated token of ``text``."""
    wanted = F.array(*[F.lit(t) for t in tokens]).cast("array<string>")
    return F.arrays_overlap(split_tags(text), wanted)
