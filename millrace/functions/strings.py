"""Text functions as Column builders, with the null rules stated for each."""

from __future__ import annotations

import html.entities
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_UUID = "00000000-0000-0000-0000-000000000000"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def to_upper(c: Column) -> Column:
    return F.upper(c)


def to_lower(c: Column) -> Column:
    return F.lower(c)


def trim(c: Column) -> Column:
    """Without the control characters and spaces at both ends."""
    return F.regexp_replace(c, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def substring(c: Column, start: int, end: int | None = None) -> Column:
    """Characters [start, end) from 0; outside the text, and for null, the empty text."""
    size = F.length(c)
    stop = F.lit(end) if end is not None else size
    fits = (F.lit(start) >= 0) & (F.lit(start) <= stop) & (stop <= size)
    return F.when(sure_true(fits), F.substring(c, F.lit(start + 1), stop - start)).otherwise("")


def sure_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def path_substring(c: Column, start: int, end: int) -> Column:
    """As ``substring``, but -1 means the end of the text and an end past it is clipped; null stays null."""
    size = F.length(c)
    place = lambda i: size + 1 + i if i < 0 else F.lit(i)
    a, b = place(start), place(end)
    return F.when(c.isNull(), None).when((b <= a) | (a < 0) | (a > size), "").otherwise(F.substring(c, a + 1, F.least(b, size) - a))


def _last(c: Column, part: str) -> Column:
    """1-based place of the last occurrence, 0 if there is none."""
    found = F.instr(F.reverse(c), part[::-1])
    return F.when(found > 0, F.length(c) - found - len(part) + 2).otherwise(0)


def substring_before(c: Column, part: str) -> Column:
    """Up to the first occurrence; all of the text without one or for an empty part; null gives ''."""
    at = F.instr(c, part) if part else F.lit(0)
    return F.coalesce(F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c), F.lit(""))


def substring_after(c: Column, part: str) -> Column:
    at = F.instr(c, part) if part else F.lit(0)
    return F.coalesce(F.when(at > 0, F.substring(c, at + len(part), F.length(c))).otherwise(c), F.lit(""))


def substring_before_last(c: Column, part: str) -> Column:
    at = _last(c, part) if part else F.lit(0)
    return F.coalesce(F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c), F.lit(""))


def substring_after_last(c: Column, part: str) -> Column:
    at = _last(c, part) if part else F.lit(0)
    return F.coalesce(F.when(at > 0, F.substring(c, at + len(part), F.length(c))).otherwise(c), F.lit(""))


def index_of(c: Column, part: str) -> Column:
    """From 0; -1 if absent or null."""
    return (F.coalesce(F.instr(c, part), F.lit(0)) - 1).cast("long")


def last_index_of(c: Column, part: str) -> Column:
    return (F.coalesce(_last(c, part), F.lit(0)) - 1).cast("long")


def length(c: Column) -> Column:
    """Null is 0."""
    return F.coalesce(F.length(c), F.lit(0)).cast("long")


def prepend(c: Column, before: str) -> Column:
    return F.concat(F.lit(before), _text(c))


def append(c: Column, after: str) -> Column:
    return F.concat(_text(c), F.lit(after))


def concat(*values: Column) -> Column:
    """The text of every value; null is left out."""
    return F.concat(*map(_text, values))


def replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def replace_first(c: Column, pattern: str, new: str) -> Column:
    """The first match only; ``$n`` in ``new`` names groups of ``pattern``."""
    shifted = re.sub(r"\$(\d)", lambda m: f"${int(m[1]) + 2}", re.sub(r"\$0", "$2", new)) if "$" in new else new
    # group 1 is what stands before the match, group 2 the match
    return F.regexp_replace(c, rf"(?s)\A(.*?)({pattern})", "$1" + shifted)


def replace_all(c: Column, pattern: str, new: str) -> Column:
    return F.regexp_replace(c, pattern, new)


def replace_null(c: Column, other: Column) -> Column:
    return F.coalesce(c, other)


def replace_empty(c: Column, other: Column) -> Column:
    """``other`` for null and for white space only."""
    return F.when(F.coalesce(F.regexp_replace(c.cast("string"), r"\s+", "") == "", F.lit(True)), other).otherwise(c)


def coalesce(*values: Column) -> Column:
    return F.coalesce(*values)


def pad_left(c: Column, size: int, pad: str = "_") -> Column:
    """Never shortens; a size of 0 or less changes nothing."""
    return F.lpad(c, F.greatest(F.lit(size), F.length(c)), F.lit(pad or "_")) if size > 0 else c


def pad_right(c: Column, size: int, pad: str = "_") -> Column:
    return F.rpad(c, F.greatest(F.lit(size), F.length(c)), F.lit(pad or "_")) if size > 0 else c


def repeat(c: Column, n: int, most: int | None = None, seed: int = 0) -> Column:
    """``n`` times, or a number from ``n`` to ``most`` by a seeded draw; null gives ''."""
    if n <= 0 or (most is not None and most < n):
        raise ValueError("repeats must be positive, and the least no more than the most")
    times = F.lit(n) if most is None else (F.floor(F.rand(seed) * (most - n + 1)) + n).cast("int")
    return F.repeat(_text(c), times)


def delimited_field(c: Column, index: int, delimiter: str = ",", quote: str = '"', escape: str = "\\", strip: bool = False) -> Column:
    """Field ``index``, from 1, of one delimited line; '' where there is none.

    Quoted fields may hold delimiters; ``strip`` takes the quotes off.
    """
    d, q, e = (re.escape(x) for x in (delimiter, quote, escape))
    field = rf"(?:{q}(?:{e}.|[^{q}{e}])*{q}|[^{d}{q}]|{e}.)*"
    value = F.regexp_extract(c, rf"(?s)\A(?:{field}{d}){{{index - 1}}}({field})(?:{d}|\z)", 1)
    return F.coalesce(F.regexp_replace(value, rf"\A\s*{q}|{q}\s*\z", "") if strip else value, F.lit(""))


def to_radix(c: Column, radix: int, width: int = 0) -> Column:
    """Digits in base 2 to 36 in lower case, a minus sign for negative numbers, zeros before up to ``width``."""
    n = c.cast("long")
    digits = F.lower(F.conv(F.abs(n).cast("string"), 10, radix))
    signed = F.when(n < 0, F.concat(F.lit("-"), digits)).otherwise(digits)
    return F.lpad(signed, F.greatest(F.lit(width), F.length(signed)), F.lit("0"))


def from_radix(c: Column, radix: int) -> Column:
    body = F.regexp_replace(c, r"^-", "")
    value = F.conv(body, radix, 10).cast("long")
    return F.when(c.startswith("-"), -value).otherwise(value)


def url_encode(c: Column) -> Column:
    return F.url_encode(c)


def url_decode(c: Column) -> Column:
    return F.try_url_decode(c)


def base64_encode(c: Column) -> Column:
    return F.base64(c.cast("binary"))


def base64_decode(c: Column) -> Column:
    return F.unbase64(c).cast("string")


def _chain(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


# The escapes of each format.
_XML = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")]
_JSON = [("\\", "\\\\"), ('"', '\\"'), ("/", "\\/"), ("\b", "\\b"), ("\n", "\\n"), ("\t", "\\t"), ("\f", "\\f"), ("\r", "\\r")]
_HTML3_LAST = 255


def _html_entities(last: int) -> dict[str, str]:
    """Entities of all characters up to ``last``, from Python's table."""
    return {chr(code): f"&{name};" for code, name in html.entities.codepoint2name.items() if code <= last}


def escape_xml(c: Column) -> Column:
    return _chain(_text(c), _XML)


def unescape_xml(c: Column) -> Column:
    return _chain(_text(c), [(new, old) for old, new in _XML[::-1]])


def escape_json_text(c: Column) -> Column:
    return _chain(_text(c), _JSON)


def unescape_json_text(c: Column) -> Column:
    """Unescapes left to right, by reading the text as one JSON string."""
    quoted = F.concat(F.lit('{"v":"'), F.regexp_replace(_text(c), r'(?<!\\)((?:\\\\)*)"', r'$1\\"'), F.lit('"}'))
    return F.coalesce(F.get_json_object(quoted, "$.v"), _text(c))


def escape_csv(c: Column) -> Column:
    t = _text(c)
    return F.when(t.rlike(r'[,"\r\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)


def unescape_csv(c: Column) -> Column:
    t = _text(c)
    inner = F.substring(t, F.lit(2), F.length(t) - 2)
    return F.when(t.rlike(r'(?s)\A".*[,"\r\n].*"\z'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(t)


def _mapped(parts: Column, table: dict[str, str]) -> Column:
    """The parts joined, those in the table replaced."""
    lookup = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.array_join(F.transform(parts, lambda x: F.coalesce(F.try_element_at(lookup, x), x)), "")


def _escape_html(c: Column, last: int) -> Column:
    return _mapped(F.split(_text(c), ""), _html_entities(last))


def _unescape_html(c: Column, last: int) -> Column:
    return _mapped(F.split(_text(c), "(?=&)|(?<=;)"), {new: old for old, new in _html_entities(last).items()})


def escape_html3(c: Column) -> Column:
    return _escape_html(c, _HTML3_LAST)


def unescape_html3(c: Column) -> Column:
    return _unescape_html(c, _HTML3_LAST)


def escape_html4(c: Column) -> Column:
    return _escape_html(c, 0x10FFFF)


def unescape_html4(c: Column) -> Column:
    return _unescape_html(c, 0x10FFFF)


def escape_json(c: Column) -> Column:
    """Any value as JSON text."""
    wrapped = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def unescape_json(c: Column, schema: str) -> Column:
    """JSON text as a typed value; text that is not of that type gives null."""
    return F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), f"v {schema}")["v"]


_HASHES = {"MD5": F.md5, "SHA-1": F.sha1, "SHA-224": lambda c: F.sha2(c, 224), "SHA-256": lambda c: F.sha2(c, 256), "SHA-384": lambda c: F.sha2(c, 384), "SHA-512": lambda c: F.sha2(c, 512)}


def hash_text(c: Column, algorithm: str) -> Column:
    """The digest in lower-case hex."""
    if algorithm not in _HASHES:
        raise ValueError(f"no such algorithm: {algorithm}")
    return _HASHES[algorithm](c.cast("binary"))


def _named_uuid(c: Column, namespace: str | None, digest, version: str) -> Column:
    space = F.unhex(F.lit((namespace or ZERO_UUID).replace("-", "")))
    h = digest(F.concat(space, c.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("long").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit(version), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def uuid3(c: Column, namespace: str | None = None) -> Column:
    """Name-based by MD5; without a namespace that of all zeros."""
    return _named_uuid(_text(c), namespace, F.md5, "3")


def uuid5(c: Column, namespace: str | None = None) -> Column:
    return _named_uuid(_text(c), namespace, F.sha1, "5")


def uuid() -> Column:
    return F.uuid()


def bytes_to_text(c: Column, charset: str = "UTF-8") -> Column:
    return F.decode(c, charset)


def text_to_bytes(c: Column, charset: str = "UTF-8") -> Column:
    return F.encode(c, charset)


def field_name(path: str) -> Column:
    """The name of the field that a path ends in."""
    return F.lit(re.split(r"[/.]", path)[-1])


def convert_charset(c: Column, source: str, target: str) -> Column:
    return F.encode(F.decode(c, source), target)
