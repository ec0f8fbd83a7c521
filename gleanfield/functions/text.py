"""Text, contact and price functions."""

import html
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from gleanfield.functions.binding import let
from gleanfield.operators.markup import decoded

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Patterns of the contact blocks found in descriptions.
CONTACT_BLOCK = r"(?d)Contact Info\:.*?\|.*?\|.*?(?=(?:\s*Contact Info)|\s*\|)"
CONTACT_LABEL = r"(?d)(?:eMail|Phone|Fax):\s*.*?(?=,|\n|$)"
CONTACT_NAMES = r"(?d)(?<=Info:\s).*?(?=\n|$|eMail|Phone|Fax)"
PRICE = r"\d[0-9 ,.]*"


def strip(text: Column) -> Column:
    """N7 for one column."""
    return F.btrim(text, F.lit(BLANKS))


def newlines_to_blank(text: Column) -> Column:
    """Every newline or carriage return becomes one blank."""
    return F.translate(text, "\n\r", "  ")


def blank_newlines(text: Column) -> Column:
    """N8 for one column: strip, then C5. Runs of blanks are kept."""
    return newlines_to_blank(strip(text))


def squeeze(text: Column) -> Column:
    """XPath normalize-space: trim, runs of blanks to one blank."""
    return F.btrim(F.regexp_replace(text, "[ \t\r\n]+", " "))


def capitalize(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, 2, 2**31 - 1)))


def word_characters(text: Column) -> Column:
    """Lower-case, keep letters, numbers and `_` only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", "")


def event_id(name: Column, city: Column, start: Column) -> Column:
    """N5; NULL when a part is NULL."""
    return F.concat(
        word_characters(name), F.lit("__"), word_characters(city), F.lit("__"), start.cast("string")
    )


@lru_cache(maxsize=1)
def _ascii_bases():
    """Non-ASCII characters whose canonical decomposition starts with an ASCII one."""
    pairs = []
    for code in range(0x80, sys.maxunicode + 1):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base < "\x80":
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(text: Column) -> Column:
    """accented letters to their ASCII base, every other non-ASCII character dropped."""
    accented, bases = _ascii_bases()
    return F.regexp_replace(F.translate(text, accented, bases), r"[^\x00-\x7F]+", "")


@arrow_udf(StringType())
def _unescape(text: pa.Array) -> pa.Array:
    unescape = html.unescape
    return pa.array([None if t is None else unescape(t) for t in text.to_pylist()], pa.string())


@arrow_udf(StringType())
def _unescape_whole(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else decoded(t) for t in text.to_pylist()], pa.string())


def html_unescape(text: Column, whole: bool = False) -> Column:
    """Only values holding `&` travel to Python.

    With `whole` a named reference must end in `;`, as in the texts of page fields; else `&amp` counts too.
    """
    read = _unescape_whole if whole else _unescape
    return F.coalesce(read(F.when(text.contains("&"), text)), text)


def br_parts(markup: Column) -> Column:
    """Markup split on `<br>`."""
    return F.split(markup, r"(?i)<br\s*/?>")


def after_last_tag(markup: Column) -> Column:
    """Text after the last `>`."""
    return F.substring_index(markup, ">", -1)


def after_label(text: Column) -> Column:
    """Text after the first `:` (all of it without one), stripped."""
    return strip(F.regexp_replace(text, "(?s)^[^:]*:", ""))


def price_text(text: Column) -> Column:
    """C4: first run of digits, blanks, commas and dots."""
    return F.nullif(strip(F.regexp_extract(text, PRICE, 0)), F.lit(""))


def compose_description(*parts: Column) -> Column:
    """Parts joined by newlines; a missing part leaves its place empty."""
    return F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts])


def _spaced(values: Column) -> Column:
    return strip(F.array_join(values, " "))


def _pick(lists: Column, i: int) -> Column:
    return F.transform(lists, lambda p: F.get(p, F.lit(i)))


def contact_blocks(desc: Column) -> Column:
    """`STRUCT<description, names, emails, phones, ok>`.

    `ok` is false without a block, or where a block has not exactly three parts.
    """
    found = F.transform(
        F.regexp_extract_all(desc, F.lit(CONTACT_BLOCK), F.lit(0)),
        lambda b: F.struct(
            b.alias("block"),
            F.transform(
                F.split(F.split_part(b, F.lit("Contact Info: "), F.lit(2)), r"\|"), strip
            ).alias("parts"),
        ),
    )

    def struct(blocks):
        parts = blocks["parts"]
        return F.struct(
            F.coalesce(
                F.split_part(desc, F.get(blocks, F.lit(0))["block"], F.lit(1)), desc
            ).alias("description"),
            _spaced(_pick(parts, 0)).alias("names"),
            _spaced(_pick(parts, 1)).alias("emails"),
            _spaced(_pick(parts, 2)).alias("phones"),
            ((F.size(blocks) > 0) & F.forall(parts, lambda p: F.size(p) == 3)).alias("ok"),
        )

    return let(found, lambda blocks: F.when(blocks.isNotNull(), struct(blocks)))


def labelled_contacts(desc: Column) -> Column:
    """`STRUCT<emails, phones, faxes, ok>` from `eMail:/Phone:/Fax:` labels.

    Values are lower-cased and lose all white space; `ok` is false where a value
    holds a second `:`.
    """
    found = F.transform(
        F.regexp_extract_all(desc, F.lit(CONTACT_LABEL), F.lit(0)),
        lambda m: F.split(F.regexp_replace(F.lower(m), r"(?U)\s+", ""), ":"),
    )

    def struct(pairs):
        of = lambda key: F.array_join(
            _pick(F.filter(pairs, lambda p: F.get(p, F.lit(0)) == key), 1), " "
        )
        return F.struct(
            of("email").alias("emails"),
            of("phone").alias("phones"),
            of("fax").alias("faxes"),
            F.forall(pairs, lambda p: F.size(p) == 2).alias("ok"),
        )

    return let(found, lambda pairs: F.when(pairs.isNotNull(), struct(pairs)))


def info_names(desc: Column) -> Column:
    """`STRUCT<description, organizer, names, ok>` from `Info: Organizer, Name, Name`."""
    found = F.transform(
        F.regexp_extract_all(desc, F.lit(CONTACT_NAMES), F.lit(0)),
        lambda i: F.struct(i.alias("info"), F.transform(F.split(i, ","), strip).alias("parts")),
    )

    def struct(infos):
        first = F.get(infos, F.lit(0))["info"]
        rest = F.transform(infos["parts"], lambda p: F.slice(p, 2, F.size(p)))
        return F.struct(
            F.coalesce(F.split_part(desc, F.nullif(first, F.lit("")), F.lit(1)), desc).alias(
                "description"
            ),
            F.array_join(_pick(infos["parts"], 0), " ").alias("organizer"),
            F.array_join(F.flatten(rest), " ").alias("names"),
            F.coalesce(first != "", F.lit(True)).alias("ok"),
        )

    return let(found, lambda infos: F.when(infos.isNotNull(), struct(infos)))
