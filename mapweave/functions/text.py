"""Column expressions for ids, references, titles and numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapweave import schemas

#: Line ends as text sources use them, the rarer ones included.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def node_id(framework: Column, version: Column, ref: Column) -> Column:
    return F.concat_ws(":", framework, version, ref)


def trim(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$", "")


def squeeze(text: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return trim(F.regexp_replace(text, "(?U)[\\s\\x1c-\\x1f]+", " "))


def filled(text: Column) -> Column:
    return F.coalesce(F.length(trim(text)) > 0, F.lit(False))


def lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def repaired_ref(ref: Column) -> Column:
    """A full id given for a reference becomes what stands after its last colon."""
    return F.when(ref.rlike("^[^:]+:[^:]+:.+$"), F.substring_index(ref, ":", -1)).otherwise(ref)


def shortened(text: Column, limit: int = schemas.TEXT_LIMIT) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(schemas.TEXT_MARK))).otherwise(text)


def title_of(text: Column, limit: int = schemas.TITLE_LIMIT) -> Column:
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 3), F.lit("...")))


def slug(title: Column) -> Column:
    return F.upper(F.regexp_replace(F.regexp_replace(title, "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))


def rolled_up(ref: Column) -> Column:
    return F.regexp_replace(ref, "\\.[^.]*$", "")


def without_parentheses(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, "\\([^)]*\\)", ""))


def _styled(pattern: str, group: int) -> Callable[[Column], Column]:
    def style(ref: Column) -> Column:
        plain = without_parentheses(ref)
        return F.when(plain.rlike(pattern), F.regexp_extract(plain, pattern, group)).otherwise(plain)

    return style


#: How external references are written, by name. The patterns.
REF_STYLES: dict[str, Callable[[Column], Column]] = {
    "iso": _styled("^[A-Za-z]?\\.?\\d+(?:\\.\\d+)*", 0),
    "caf": _styled("^[A-Za-z]+\\d+(?:\\.[A-Za-z0-9]+)*", 0),
    "article": _styled("(?i)^(Article\\s+\\d+)", 1),
    "section": _styled("(?i)^(Section\\s+\\d+(?:\\.\\d+)*)", 1),
}


def ref_style(name: str) -> Callable[[Column], Column]:
    if name not in REF_STYLES:
        raise ValueError(f"unknown reference style {name!r}; known: {', '.join(REF_STYLES)}")
    return REF_STYLES[name]


def rejoined_capital(text: Column) -> Column:
    """A capital split off its word comes back; A and I are words of their own. Fixed value: the pattern."""
    return F.regexp_replace(squeeze(text), "\\b([B-HJ-Z]) (?=[a-z]{2})", "$1")


def label(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9_]", "_")


def type_label(node_type: Column) -> Column:
    plain = label(node_type)
    return F.concat(F.upper(F.substring(plain, 1, 1)), F.lower(F.substring(plain, 2, 1 << 30)))


def digits(text: Column) -> Column:
    plain = trim(text)
    return F.when(plain.rlike("^[0-9]+$"), plain.try_cast("int"))


def batch_name(number: Column, prefix: str = "batch") -> Column:
    return F.format_string(f"{prefix}_%03d", number)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(100.0 * part, whole), 1)


def unit(vector: Column) -> Column:
    """The vector over its length; a zero vector as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    over = F.when(norm == 0, 1.0).otherwise(norm)
    return F.transform(vector, lambda x: x / over)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def key_values(pairs: list[str], flag: str) -> dict[str, str]:
    """KEY=VALUE options; the first = parts them."""
    out = {}
    for pair in pairs:
        key, found, value = pair.partition("=")
        if not found:
            raise ValueError(f"{flag} takes KEY=VALUE, not {pair!r}")
        out[key.strip()] = value.strip()
    return out
