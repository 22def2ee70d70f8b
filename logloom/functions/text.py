"""Column expressions over log text. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.formats import LogFormat, Mask

WILDCARD = "<*>"

# The characters a text strip removes (Unicode white space and the
# information separators), as a trim set and as regex classes.
STRIP_SET = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
_EXOTIC = r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRIP_CLASS = rf"[{_EXOTIC} ]"
# White space other than one plain blank.
_UNEVEN = rf"(?:[{_EXOTIC}]|  ){STRIP_CLASS}*"

# Joins the captured header groups so that one regex run yields all of them.
_SEP = "\x01"


def strip(text: Column) -> Column:
    """Strip white space at both ends; the slow trim runs only where an end is white space."""
    ends = F.lit(STRIP_SET)
    padded = F.contains(ends, F.left(text, F.lit(1))) | F.contains(ends, F.right(text, F.lit(1)))
    return F.when(padded, F.btrim(text, ends)).otherwise(text)


def clean_line(line: Column) -> Column:
    """Drop undecodable bytes, then strip white space at both ends."""
    repaired = F.replace(F.make_valid_utf8(line), F.lit(chr(0xFFFD)), F.lit(""))
    return strip(F.when(F.is_valid_utf8(line), line).otherwise(repaired))


def is_blank(line: Column) -> Column:
    """Whether ``clean_line`` leaves nothing, found without cleaning the line."""
    sure = line.rlike(rf"[^{_EXOTIC} \x{{fffd}}]")
    return ~(sure | (line.rlike(f"[^{_EXOTIC} ]") & F.is_valid_utf8(line)))


def header_groups(line: Column, fmt: LogFormat) -> Column:
    """``[marker, group 1, ..., group k]`` of a matching line, a shorter array otherwise.

    ``regexp_extract`` runs the regex again for every group. Rewriting the line once to its
    groups and splitting that costs one run; a line that itself holds the separator takes the
    extract form, so the result is the same for every text.
    """
    pattern = "(?s)" + fmt.header
    groups = range(1, len(fmt.fields) + 1)
    once = F.split(F.regexp_replace(line, pattern, _SEP + _SEP.join(f"${g}" for g in groups)), _SEP)
    extracted = F.when(
        line.rlike(pattern), F.array(F.lit(""), *[F.regexp_extract(line, pattern, g) for g in groups])
    ).otherwise(F.array(line))
    return F.when(F.contains(line, F.lit(_SEP)), extracted).otherwise(once)


def first_entity(content: Column, fmt: LogFormat) -> Column:
    """The first entity id named in the content, NULL when there is none."""
    return F.nullif(F.regexp_extract(content, fmt.entity, 1), F.lit(""))


def all_entities(content: Column, fmt: LogFormat) -> Column:
    """Every distinct entity id named in the content."""
    return F.array_distinct(F.regexp_extract_all(content, F.lit(fmt.entity), F.lit(1)))


def mask(content: Column, masks: Iterable[Mask]) -> Column:
    """Apply the masks one after the other."""
    for rule in masks:
        content = F.regexp_replace(content, rule.pattern, rule.token)
    return content


def even(text: Column) -> Column:
    """Text with its tokens joined by one blank."""
    # Most lines hold plain blanks only, which two quick scans tell.
    suspect = F.contains(text, F.lit("  ")) | text.rlike("[^ -~]")
    return F.trim(F.when(suspect, F.regexp_replace(text, _UNEVEN, " ")).otherwise(text))


def signature(content: Column, masks: Iterable[Mask]) -> Column:
    """Masked content with tokens joined by one blank.

    Without masks every token that bears a digit becomes a wildcard, otherwise nearly every
    line would be a signature of its own.
    """
    masks = tuple(masks)
    text = even(mask(content, masks))
    if not masks:
        text = F.regexp_replace(text, r"(^| )[^ \d]*\d[^ ]*", "$1" + WILDCARD)
    return text


def tokens(sig: Column) -> Column:
    """Tokens of a signature; the empty signature has none."""
    return F.when(sig == "", F.array().cast("array<string>")).otherwise(F.split(sig, " "))


def head_token(token: Column) -> Column:
    """Token as used in a leaf key: wildcard when it bears a digit."""
    return F.when(token.rlike(r"\d"), F.lit(WILDCARD)).otherwise(token)


def equal_tokens(left: Column, right: Column) -> Column:
    """Number of positions where two equally long token lists agree on a non-wildcard."""
    return F.size(F.filter(F.zip_with(left, right, lambda a, b: (a == b) & (a != WILDCARD)), lambda hit: hit))


def similar(left: Column, right: Column, sim_th: float) -> Column:
    """Whether the share of equal tokens reaches ``sim_th``."""
    return equal_tokens(left, right) / F.greatest(F.size(left), F.lit(1)) >= F.lit(sim_th)


def event_name(number: Column) -> Column:
    return F.concat(F.lit("E"), number.cast("string"))


def event_number(event_id: Column) -> Column:
    """Numeric suffix of an event id, the sort key of event columns."""
    return F.substring(event_id, 2, 18).cast("bigint")


def preview(template: Column, width: int = 70) -> Column:
    """Template cut to ``width`` characters, with dots when cut."""
    return F.when(
        F.length(template) > width, F.concat(F.substring(template, 1, width), F.lit("..."))
    ).otherwise(template)


def is_positive(label: Column, positive: str) -> Column:
    """0/1 target; an unlabelled row counts as 0."""
    return F.coalesce(label == F.lit(positive), F.lit(False)).cast("int")
