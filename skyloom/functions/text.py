"""Text: flight numbers, airport labels, hours and the folding used to compare news."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column, functions as F

from skyloom.constants import FOLD_FROM, FOLD_TO

FLIGHT_NUMBER_PATTERN = r"^[A-Z0-9]{1,3}\s?[0-9]{1,4}$"
HOUR_PATTERN = r"(\d{2}:\d{2}(?::\d{2})?)"
BLANKS = r"[\s\p{Z}\x1c-\x1f\x85]+"

# The standard table of named character references, from Python's own library.
NAMED = json.dumps(html5)
# Numbers that stand for another character by the HTML standard: those of Windows-1252, and two more.
RENUMBERED = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)} | {0: "\ufffd", 0x0D: "\r"}
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <#;]{1,32};?)"


def stripped(c: Column) -> Column:
    """Without blanks of any kind at the ends: tabs, line ends and no-break spaces too."""
    return F.regexp_replace(c, rf"^{BLANKS}|{BLANKS}\z", "")


def flight_code(c: Column) -> Column:
    """Flight number without blanks, in capitals; empty text when missing."""
    return F.coalesce(F.upper(stripped(F.replace(c, F.lit(" "), F.lit("")))), F.lit(""))


def upper_key(c: Column) -> Column:
    return F.upper(stripped(c))


def status_key(c: Column) -> Column:
    return F.lower(stripped(F.coalesce(c, F.lit(""))))


def airport_code(c: Column) -> Column:
    """``CDG - Paris Charles de Gaulle`` -> ``CDG``."""
    return F.trim(F.split_part(F.trim(c), F.lit(" - "), F.lit(1)))


def day_text(c: Column) -> Column:
    return F.substring(c, 1, 10)


def hour_text(c: Column) -> Column:
    """First ``HH:MM`` or ``HH:MM:SS`` in a text; empty when there is none."""
    return F.coalesce(F.regexp_extract(c, HOUR_PATTERN, 1), F.lit(""))


def hour_number(c: Column) -> Column:
    """Hour of the first ``HH:MM`` in a text; 0 when there is none."""
    return F.coalesce(F.regexp_extract(c, r"(\d{2}):(\d{2})", 1).try_cast("int"), F.lit(0))


def day_and_hour(c: Column, bare_day_hour: str = "00:00") -> Column:
    """Split a date-time text into ``struct<day, hour>``.

    Readable values give ``YYYY-MM-DD`` and ``HH:MM``; others give their first two words.
    ``bare_day_hour`` is the hour of a text that holds a day only.
    """
    value = F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("T"), F.lit(" ")))
    readable = value.try_cast("timestamp_ntz").isNotNull() & value.rlike(
        r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}|$)"
    )
    bare = F.length(value) == 10
    words = F.split(value, r"\s+")
    return F.struct(
        F.when(readable, F.substring(value, 1, 10))
        .otherwise(F.coalesce(F.get(words, F.lit(0)), F.lit("")))
        .alias("day"),
        F.when(readable & bare, F.lit(bare_day_hour))
        .when(readable, F.substring(value, 12, 5))
        .otherwise(F.coalesce(F.get(words, F.lit(1)), F.lit("")))
        .alias("hour"),
    )


def valid_flight_number(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c)).rlike(FLIGHT_NUMBER_PATTERN), F.lit(False))


def valid_request(number: Column, origin: Column, destination: Column) -> Column:
    """A request names a well-formed flight number and two different airports."""
    return valid_flight_number(number) & ~origin.eqNullSafe(destination)


def unescape(c: Column) -> Column:
    """Decode HTML character references once, named and numeric, as the HTML standard says.

    Names are those of the standard table, with or without a semicolon where it allows that; what follows such a name
    stays. Unknown names stay. Numbers beyond Unicode and surrogates give U+FFFD, those of non-characters nothing.
    """
    parts = F.split(c, "&", -1)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(rest, _decoded), ""))


def _decoded(part: Column) -> Column:
    """Text that followed an ampersand, with the reference it begins with decoded."""
    ref = F.regexp_extract(part, REFERENCE, 1)
    after = F.substr(part, F.length(ref) + 1)
    digits = F.regexp_extract(ref, "^#([0-9]+)", 1)
    hex_digits = F.regexp_extract(ref, "^#[xX]([0-9a-fA-F]+)", 1)
    return (
        F.when(ref == "", F.concat(F.lit("&"), part))
        .when(digits != "", F.concat(_character(digits, 10), after))
        .when(hex_digits != "", F.concat(_character(hex_digits, 16), after))
        .otherwise(F.concat(_named(ref), after))
    )


def _named(ref: Column) -> Column:
    """The longest beginning of a name that the table holds, decoded, with what is left of the name."""
    names = F.from_json(F.lit(NAMED), "map<string,string>")
    lengths = F.when(F.length(ref) > 2, F.sequence(F.length(ref) - 1, F.lit(2), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    shorter = F.get(F.filter(lengths, lambda n: F.map_contains_key(names, F.substr(ref, F.lit(1), n))), F.lit(0))
    prefix = F.try_element_at(names, F.substr(ref, F.lit(1), shorter))
    return F.coalesce(F.try_element_at(names, ref), F.concat(prefix, F.substr(ref, shorter + 1)), F.concat(F.lit("&"), ref))


def _character(digits: Column, base: int) -> Column:
    # More digits than any character needs: beyond Unicode.
    significant = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(significant) <= 8, F.conv(F.concat(F.lit("0"), significant), base, 10).cast("long")).otherwise(0x110000)
    table = F.create_map(*[F.lit(x) for pair in RENUMBERED.items() for x in pair])
    beyond = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    none = code.between(1, 8) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(beyond, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.when(beyond, "\ufffd").when(none, "").otherwise(plain))


def plain_text(c: Column, entities: bool = True) -> Column:
    """Text as compared: decoded, lower case, accents folded, blanks collapsed."""
    text = F.coalesce(c, F.lit(""))
    if entities:
        # Most texts hold no reference at all; they skip the decoding.
        text = F.when(F.contains(text, F.lit("&")), unescape(text)).otherwise(text)
    text = F.translate(F.lower(text), FOLD_FROM, FOLD_TO)
    text = F.replace(text, F.lit("œ"), F.lit("oe"))
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def fold_word(word: str) -> str:
    """Driver-side twin of ``plain_text`` for the fixed word lists."""
    return " ".join(word.lower().translate(str.maketrans(FOLD_FROM, FOLD_TO)).replace("œ", "oe").split())


def contains_any(text: Column, words: Iterable[str], whole_words: bool = False) -> Column:
    """Whether a folded text holds one of the words (as substrings, or as whole words)."""
    folded = sorted({fold_word(w) for w in words})
    # A word that contains another listed word adds nothing to a substring test.
    kept = [w for w in folded if not any(o != w and o in w for o in folded)]
    if whole_words:
        alternatives = "|".join(re.escape(w) for w in folded)
        return text.rlike(rf"\b({alternatives})\b")
    test = F.lit(False)
    for w in kept:
        test = test | F.contains(text, F.lit(w))
    return test


def joined(values: Column, separator: str = ";") -> Column:
    """Array -> text; empty text for a missing array."""
    return F.coalesce(F.array_join(values, separator), F.lit(""))


def sorted_distinct(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))
