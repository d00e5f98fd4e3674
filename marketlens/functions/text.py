"""Text to typed values. Every function is ``Column -> Column`` and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts and patterns below decide results.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITY_PATTERN = r"^(?i)[+-]?inf(inity)?$"
VOLUME_PATTERN = r"(\d+\.?\d*)([KkMm]?)"
BYLINE_PREFIX = "Visit the "
BYLINE_SUFFIX = " Store"
STAR_KEYS = ("1", "2", "3", "4", "5")

_EDGE_BLANKS = r"^\s+|\s+$"
_PY_LITERAL = r"([\[{{,:]\s*){word}(?=\s*[,\]}}])"
# A quoted text with its escapes, what lies between quoted texts, or a quote mark that is never closed.
_PIECES = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+|['"]"""
_SECRET_PARAM = r"(?i)\b((?:api[_-]?)?key|token|access_token|secret|password)=[^&\s\"']+"


def strip(col: Column) -> Column:
    """Cut white space of every kind from both ends (``trim`` cuts blanks only)."""
    return F.regexp_replace(col, _EDGE_BLANKS, "")


def to_number(col: Column) -> Column:
    """Text to double; text that is not a number gives null.

    The pattern keeps out spellings the JVM parser takes but a data cleaner would not (``1.5d``).
    """
    text = strip(col.cast("string"))
    plain = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    infinite = F.when(
        text.rlike(INFINITY_PATTERN),
        F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
    )
    return F.coalesce(plain, infinite)


def clean_money(col: Column) -> Column:
    """``$1,299.00`` to 1299.0."""
    return to_number(F.regexp_replace(col.cast("string"), r"[$,]", ""))


def to_ts(col: Column) -> Column:
    """Text to a zone-free timestamp; text that is not a timestamp gives null."""
    return col.try_cast("timestamp_ntz")


def parse_volume(col: Column, null_as: int | None = 0) -> Column:
    """Estimated volume text such as ``7K+ bought in past month`` to a whole number.

    The first number counts, with a K or M directly behind it; the rest is cut off, not rounded.
    Text without a number gives 0. ``null_as`` is the value for a missing text.
    """
    text = col.cast("string")
    number = F.regexp_extract(text, VOLUME_PATTERN, 1).try_cast("double")
    suffix = F.upper(F.regexp_extract(text, VOLUME_PATTERN, 2))
    scale = F.when(suffix == "K", 1e3).when(suffix == "M", 1e6).otherwise(1.0)
    parsed = F.coalesce((number * scale).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(col.isNull(), F.lit(null_as).cast("bigint")).otherwise(parsed)


def literal_to_json(col: Column) -> Column:
    """Rewrite a Python-style literal so that the JSON reader takes it.

    Quoted texts are cut out first and put back unchanged; only what lies between them is rewritten:
    bare words in value position, and numbers as keys. Single quotes are left to the reader.
    """

    def rewrite(piece: Column) -> Column:
        text = piece
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            text = F.regexp_replace(text, _PY_LITERAL.format(word=word), f"$1{json_word}")
        text = F.regexp_replace(text, r"([{,]\s*)(\d+)(\s*:)", r'$1"$2"$3')
        return F.when(piece.startswith("'") | piece.startswith('"'), piece).otherwise(text)

    return F.array_join(F.transform(F.regexp_extract_all(col, F.lit(_PIECES), F.lit(0)), rewrite), "")


_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def number_map(col: Column) -> Column:
    """Text of a mapping to ``map<string,double>``; null when it is not a mapping of numbers."""
    return F.from_json(literal_to_json(col), "map<string,double>", _JSON_OPTIONS)


def map_total(counts: Column) -> Column:
    """Sum of a map's values, null when one of them is null or the sum is zero."""
    total = F.aggregate(F.map_values(counts), F.lit(0.0), lambda acc, v: acc + v)
    return F.nullif(total, F.lit(0.0))


def share(counts: Column, total: Column, key: str) -> Column:
    """One key's share of the total; 0 when either is missing."""
    return F.coalesce(F.try_element_at(counts, F.lit(key)) / total, F.lit(0.0))


def dict_text_field(col: Column, name: str) -> Column:
    """One field of a mapping written as text; anything else gives null."""
    fields = F.from_json(literal_to_json(col), "map<string,string>", _JSON_OPTIONS)
    return F.try_element_at(fields, F.lit(name))


def has_text(col: Column) -> Column:
    """True when the value holds anything but white space."""
    return strip(F.coalesce(col.cast("string"), F.lit(""))) != ""


def title_case(col: Column) -> Column:
    """Upper-case each letter that does not follow a letter; lower-case the others."""
    chars = F.split(F.lower(col), "")
    starts_word = lambda i: (i == 0) | ~F.get(chars, i - 1).rlike(r"\p{L}")
    cased = F.transform(chars, lambda c, i: F.when(starts_word(i), F.upper(c)).otherwise(c))
    return F.array_join(cased, "")


def brand_short(col: Column, title: bool = False) -> Column:
    """Brand name from a store byline; ``title`` ignores case and title-cases the result."""
    prefix, suffix = BYLINE_PREFIX, BYLINE_SUFFIX
    text = col
    if title:
        prefix, suffix, text = prefix.lower(), suffix.lower(), F.lower(col)
    text = F.replace(text, F.lit(prefix), F.lit(""))
    text = F.replace(text, F.lit(suffix), F.lit(""))
    return title_case(strip(text)) if title else strip(text)


def flag(col: Column, data_type: str) -> Column:
    """Presence flag by the column's type: null is false; any non-empty text and any non-zero
    number is true."""
    if data_type == "boolean":
        truth = col
    elif data_type in ("string", "varchar", "char"):
        truth = F.length(col) > 0
    else:
        truth = (col != 0) & ~F.isnan(col.cast("double"))
    return F.coalesce(truth, F.lit(False))


def redact(col: Column) -> Column:
    """Mask the values of key, token and password parameters inside a logged text."""
    return F.regexp_replace(col, _SECRET_PARAM, "$1=***")


def http_status(col: Column) -> Column:
    """Leading three-digit status of an error text, null when there is none."""
    return F.regexp_extract(col, r"^\s*(\d{3})\b", 1).try_cast("int")
