"""Text cleaning as column expressions.

Java's ``(?U)\\s`` plus the four separators ``\\x1c-\\x1f`` is the whitespace set of a Python ``str``
pattern, so the patterns below keep and drop the same characters as Python's ``re`` does.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns and the composed-query markers.
SPACE = r"\s\x1c-\x1f"
URLS = rf"(?U)http[^{SPACE}]+|www\.[^{SPACE}]+"
SPECIALS = rf"(?U)[^a-zA-Z0-9{SPACE}]+"
TITLE_MARK = "[TITLE] "
BODY_MARK = " [BODY] "

COMMENTS = r"(?s)<!--.*?-->"
UNSHOWN_TAGS = ("script", "style", "template")
TAGS = r"</?[a-zA-Z!?][^>]*>"


def _shown(code: int) -> str:
    """What a numeric reference shows: the old single-byte code page where it has a character there."""
    if 0x80 <= code < 0xA0:
        return bytes([code]).decode("cp1252", "ignore") or chr(code)
    return "\ufffd" if code == 0 else chr(code)


#: Named references with and without the semicolon, as the standard table has them; those without one also count
#: where more letters follow.
NAMED = json.dumps(html5)
OPEN = json.dumps({name: shown for name, shown in html5.items() if not name.endswith(";")})
LONGEST_OPEN = max(len(name) for name in html5 if not name.endswith(";"))
#: Numbers that show other characters than their own, and numbers that show nothing.
ODD_NUMBERS = json.dumps({str(code): _shown(code) for code in (0, 0x0D, *range(0x80, 0xA0))})
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _constant(table: str) -> Column:
    """A literal map of strings; folded once, when the query is planned."""
    return F.from_json(F.lit(table), "map<string,string>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it uses several times, evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it uses several times, evaluated once. Bodies must not nest: an argument of a
    Python function with lambdas inside lambdas cannot be planned."""
    return F.get(F.transform(F.array(value), body), 0)


def _number(reference: Column) -> Column:
    """The character of ``#...`` or ``#x...``."""
    hexadecimal = F.substring(reference, 2, 1).isin("x", "X")
    digits = F.regexp_replace(reference, "^#[xX]?0*|;$", "")
    long = F.length(digits) > 8
    known = F.when(long | (digits == ""), F.lit("0")).otherwise(digits)
    code = F.when(hexadecimal, F.conv(known, 16, 10)).otherwise(known).cast("long")
    low = code % 0x10000
    nothing = code.between(1, 8) | code.between(0x0E, 0x1F) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF) | (code == 0x0B) | (low >= 0xFFFE)
    plain = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")  # a byte-order mark leads
    return (
        F.when(long | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
        .when((code == 0) | (code == 0x0D) | code.between(0x80, 0x9F), F.element_at(_constant(ODD_NUMBERS), code.cast("string")))
        .when(nothing, F.lit(""))
        .otherwise(plain)
    )


def _name(reference: Column) -> Column:
    """The characters of a name, else of its longest beginning that is one, else the reference as it stands."""
    found = [F.try_element_at(_constant(NAMED), reference)]
    for length in range(LONGEST_OPEN, 1, -1):
        begun = F.try_element_at(_constant(OPEN), F.substring(reference, 1, length))
        found.append(F.when(F.length(reference) > length, F.concat(begun, F.substr(reference, F.lit(length + 1)))))
    return F.coalesce(*found, F.concat(F.lit("&"), reference))


def _decode_entities(text: Column) -> Column:
    """Character references decoded, as expressions; the parts after each ampersand are looked at alone."""

    def decoded(part: Column, at: Column) -> Column:
        reference = F.regexp_extract(part, REFERENCE, 1)
        shown = F.when(reference == "", F.lit("&")).when(reference.startswith("#"), _number(reference)).otherwise(_name(reference))
        return F.when(at == 0, part).otherwise(F.concat(shown, F.substr(part, F.length(reference) + 1)))

    return F.array_join(F.transform(F.split(text, "&"), decoded), "")


def _without_tags(text: Column) -> Column:
    text = F.regexp_replace(text, COMMENTS, "")
    for tag in UNSHOWN_TAGS:
        text = F.regexp_replace(text, rf"(?is)<{tag}\b.*?</{tag}\s*>", "")
    return F.regexp_replace(text, TAGS, "")


def _as_text(text: Column, is_markup: Column) -> Column:
    return F.when(is_markup, _decode_entities(_without_tags(text))).otherwise(text)


def html_to_text(text: Column) -> Column:
    """Visible text of an HTML fragment: tags become nothing, entities are decoded last."""
    return _as_text(text, text.contains("<") | text.contains("&"))


def strip_urls(text: Column) -> Column:
    # The plain substring test keeps the pattern away from the many texts without a URL.
    has_url = text.contains("http") | text.contains("www.")
    return F.when(has_url, F.regexp_replace(text, URLS, "")).otherwise(text)


def strip_special(text: Column) -> Column:
    return F.regexp_replace(text, SPECIALS, "")


def clean_text(text: Column) -> Column:
    """HTML (only where both brackets occur), URLs, special characters, case; NULL becomes ''."""
    plain = _as_text(text, text.contains("<") & text.contains(">"))
    return F.coalesce(F.lower(strip_special(_let(plain, strip_urls))), F.lit(""))


def strip_space(text: Column) -> Column:
    """Trim every kind of whitespace; Spark's ``trim`` alone removes only U+0020."""
    return F.regexp_replace(text, rf"(?U)^[{SPACE}]+|[{SPACE}]+$", "")


def compose_query(title: Column, body: Column, markers: bool = True) -> Column:
    """Title and body text in one query; ``markers=False`` leaves the two literal marks out."""
    shown = html_to_text(F.coalesce(body, F.lit("")))
    if markers:
        return strip_space(F.concat(F.lit(TITLE_MARK), title, F.lit(BODY_MARK), shown))
    return strip_space(F.concat(title, F.lit(" "), shown))


def words(text: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    return F.filter(F.split(text, rf"(?U)[{SPACE}]+"), lambda word: word != "")


def filled(first: Column, second: Column) -> Column:
    """``first`` unless it is NULL or empty, else ``second``."""
    return F.coalesce(F.nullif(first, F.lit("")), second)
