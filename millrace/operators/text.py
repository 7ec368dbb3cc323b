"""Text and content operators: replace, extract, parse, split, encode, hash, compare."""

from __future__ import annotations

import base64
import bz2
import datetime
import io
import lzma
import re
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Sequence
from functools import reduce
from html.parser import HTMLParser
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.predicates import sure
from millrace.scratch import written

# --- replace and extract ---------------------------------------------------


def replace_text(c: Column, pattern: str, replacement: str, line_by_line: bool = False, literal: bool = False) -> Column:
    """Every match replaced, over the whole text or in each line by itself; ``$n`` names groups."""
    pattern = re.escape(pattern) if literal else pattern
    if line_by_line:
        return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, pattern, replacement)), "\n")
    return F.regexp_replace(c, pattern, replacement)


def replace_computed(c: Column, pattern: str, make: Callable[[Sequence[Column]], Column], groups: int) -> Column:
    """The first match replaced by a column computed from its groups (0 is the match)."""
    head = F.regexp_extract(c, rf"(?s)\A(.*?)(?:{pattern})", 1)
    tail = F.regexp_extract(c, rf"(?s)\A.*?(?:{pattern})(.*)\z", groups + 1)
    parts = [F.regexp_extract(c, pattern, i) for i in range(groups + 1)]
    return F.when(c.rlike(pattern), F.concat(head, make(parts), tail)).otherwise(c)


def replace_with_mapping(df: DataFrame, text: str, key: Sequence[str], mapping: DataFrame) -> DataFrame:
    """Words replaced by a table (word, replacement); all else in the text stays.

    Words are exploded and joined, so the mapping may be of any size; of several
    replacements of a word the least counts.  Rows are numbered and written
    first, so ``key`` may be null or repeated, and be any columns.
    """
    rows = written(df.withColumn("__row", F.monotonically_increasing_id()), "mapping-rows")
    parts = F.regexp_extract_all(text, F.lit(r"(?U)(\w+|\W+)"), 1)
    words = rows.select("__row", F.posexplode(parts).alias("__i", "word"))
    unique = mapping.filter("word IS NOT NULL").groupBy("word").agg(F.min("replacement").alias("replacement"))
    mapped = words.join(unique, "word", "left").groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("__i", F.coalesce("replacement", "word").alias("w")))).alias("__p"))
    joined = mapped.select("__row", F.array_join(F.col("__p.w"), "").alias("__t"))
    return rows.join(joined, "__row", "left").withColumn(text, F.coalesce("__t", text)).select(*df.columns)


def extract_text(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """For each name and pattern the columns name.0, name.1 ... of the first match; null without one."""
    out = {}
    for name, pattern in patterns.items():
        hit = F.col(text).rlike(pattern)
        for i in range(re.compile(pattern).groups + 1):
            out[f"{name}.{i}"] = F.when(hit, F.regexp_extract(text, pattern, i))
    return df.withColumns(out)


# The usual named patterns of log lines.
GROK = {
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "INT": r"[+-]?\d+",
    "POSINT": r"\b[1-9]\d*\b",
    "NUMBER": r"[+-]?(?:\d+(?:\.\d+)?|\.\d+)",
    "USERNAME": r"[a-zA-Z0-9._-]+",
    "IPV4": r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)",
    "HOSTNAME": r"\b[0-9A-Za-z][0-9A-Za-z-]{0,62}(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62})*\.?",
    "IPORHOST": r"(?:%{IPV4}|%{HOSTNAME})",
    "URIPATH": r"(?:/[A-Za-z0-9$.+!*'(){},~:;=@#%&_-]*)+",
    "QUOTEDSTRING": r'"(?:[^"\\]|\\.)*"',
    "YEAR": r"(?:\d\d){1,2}",
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTHDAY": r"(?:0[1-9]|[12]\d|3[01]|[1-9])",
    "TIME": r"(?:2[0-3]|[01]?\d):[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?",
    "TIMESTAMP_ISO8601": r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{TIME}(?:Z|[+-]\d\d:?\d\d)?",
    "LOGLEVEL": r"(?:TRACE|DEBUG|INFO|NOTICE|WARN(?:ING)?|ERROR|CRIT(?:ICAL)?|FATAL|SEVERE|EMERG)",
    "UUID": r"[A-Fa-f0-9]{8}-(?:[A-Fa-f0-9]{4}-){3}[A-Fa-f0-9]{12}",
}


def _without_groups(pattern: str) -> str:
    """The pattern with groups that do not capture; what is quoted or in a character class stays."""
    out, depth, i = [], 0, 0
    while i < len(pattern):
        step = 1
        if pattern.startswith("\\Q", i):
            end = pattern.find("\\E", i)
            step = (end + 2 if end >= 0 else len(pattern)) - i
        elif pattern[i] == "\\":
            step = 2
        elif pattern[i] == "[":
            # a bracket right at the start of a class is text
            step = len(re.match(r"\[\^?\]?", pattern[i:])[0])
            depth += 1
        elif pattern[i] == "]" and depth:
            depth -= 1
        elif pattern[i] == "(" and not depth and pattern[i + 1 : i + 2] != "?":
            out.append("(?:")
            i += 1
            continue
        out.append(pattern[i : i + step])
        i += step
    return "".join(out)


def expand_grok(expression: str, library: dict[str, str] | None = None) -> tuple[str, list[str]]:
    """One regular expression with a group for each ``%{PATTERN:name}``, and the names in order."""
    library = GROK | (library or {})
    names: list[str] = []

    def plain(pattern: str) -> str:
        return re.sub(r"%\{(\w+)\}", lambda m: f"(?:{plain(library[m[1]])})", _without_groups(pattern))

    def named(m: re.Match) -> str:
        if m[1] not in library:
            raise ValueError(f"no such pattern: {m[1]}")
        if m[2]:
            names.append(m[2])
            return f"({plain(library[m[1]])})"
        return f"(?:{plain(library[m[1]])})"

    return re.sub(r"%\{(\w+)(?::(\w+))?\}", named, _without_groups(expression)), names


def extract_grok(df: DataFrame, text: str, expression: str, library: dict[str, str] | None = None, keep_empty: bool = False, no_match: str = "raw", order: Sequence[str] = (), stream: str | None = None) -> DataFrame:
    """Named captures as columns.  Lines that do not match are kept raw, skipped, or appended.

    ``append`` joins a line to the text of the last match before it, in order
    within its ``stream``; then ``stack_trace`` holds what was appended.
    """
    pattern, names = expand_grok(expression, library)
    hit = F.col(text).rlike(pattern)
    value = lambda i: F.regexp_extract(text, pattern, i)
    df = df.withColumn("matched", hit)
    out = df.withColumns({n: F.when(hit, value(i) if keep_empty else F.nullif(value(i), F.lit(""))) for i, n in enumerate(names, 1)})
    if no_match == "raw":
        return out
    if no_match == "skip":
        return out.filter("matched")
    if no_match != "append" or stream is None:
        raise ValueError("no_match is raw, skip or append; append needs the stream's column")
    w = Window.partitionBy(stream).orderBy(*order)
    grouped = out.withColumn("__g", F.sum(F.col("matched").cast("int")).over(w))
    firsts = grouped.filter("matched")
    rest = grouped.filter(~F.col("matched") & (F.col("__g") > 0)).groupBy(stream, "__g").agg(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t")))).alias("__l"))
    rest = rest.select(stream, "__g", F.array_join(F.col("__l.__t"), "\n").alias("stack_trace"))
    return firsts.join(rest, [stream, "__g"], "left").drop("__g")


# --- logs and messages -----------------------------------------------------

_3164 = r"(?s)\A<(\d{1,3})>([A-Z][a-z]{2}\s+\d{1,2} \d{2}:\d{2}:\d{2}) (\S+) (.*)\z"
_5424 = r"(?s)\A<(\d{1,3})>(\d{1,2}) (\S+) (\S+) (\S+) (\S+) (\S+) (-|(?:\[(?:[^\]\\]|\\.)*\])+)(?: (.*))?\z"
_DATED = r"(?s)\A<(\d{1,3})>(?:(\d{1,2}) )?(\d{4}-\d\d-\d\dT\S+) (\S+) (.*)\z"


def last_of_each(pairs: Column) -> Column:
    """A map of (key, value) records; of equal keys the last counts.  Null keys are left out."""
    numbered = F.array_sort(F.transform(F.filter(pairs, lambda p: p["key"].isNotNull()), lambda p, i: F.struct(p["key"].alias("key"), i.alias("i"), p["value"].alias("value"))))

    def kept(s: Column) -> Column:
        last = F.filter(s, lambda x, i: (i + 1 == F.size(s)) | (F.get(s, i + 1)["key"] != x["key"]))
        return F.transform(last, lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))

    # sorted once, as the only element of an array
    return F.map_from_entries(F.transform(F.array(numbered), kept)[0])


def parse_syslog(df: DataFrame, line: str) -> DataFrame:
    """priority, severity, facility, version, timestamp, hostname, body, valid, of both header forms."""
    c = F.col(line)
    old, new = c.rlike(_3164), c.rlike(_DATED)
    pick = lambda i, j: F.when(old, F.regexp_extract(line, _3164, i) if i else None).when(new, F.nullif(F.regexp_extract(line, _DATED, j), F.lit("")))
    priority = pick(1, 1).try_cast("int")
    return df.withColumns({
        "priority": priority, "severity": priority.bitwiseAND(F.lit(7)), "facility": F.shiftright(priority, 3), "version": pick(0, 2), "timestamp": pick(2, 3),
        "hostname": pick(3, 4), "body": pick(4, 5), "valid": sure(old | new),
    })


def parse_syslog_5424(df: DataFrame, line: str, nil: str = "null") -> DataFrame:
    """All header fields and structured data as a map ``id.name`` to value; of a repeated name the last value counts.

    ``nil`` says what a dash becomes: ``dash``, ``null``, or ``omit`` (null, too, in a column).
    """
    hit = F.col(line).rlike(_5424)
    raw = lambda i: F.when(hit, F.regexp_extract(line, _5424, i))
    field = lambda i: raw(i) if nil == "dash" else F.nullif(raw(i), F.lit("-"))
    priority = raw(1).try_cast("int")
    elements = F.regexp_extract_all(raw(8), F.lit(r"\[((?:[^\]\\]|\\.)*)\]"), 1)
    entries = F.flatten(F.transform(elements, lambda e: F.zip_with(
        F.transform(F.regexp_extract_all(e, F.lit(r'(\S+)="((?:[^"\\]|\\.)*)"'), 1), lambda n: F.concat(F.split_part(e, F.lit(" "), F.lit(1)), F.lit("."), n)),
        F.regexp_extract_all(e, F.lit(r'(\S+)="((?:[^"\\]|\\.)*)"'), 2), lambda k, v: F.struct(k.alias("key"), v.alias("value")))))
    return df.withColumns({
        "priority": priority, "severity": priority.bitwiseAND(F.lit(7)), "facility": F.shiftright(priority, 3), "version": raw(2), "timestamp": field(3), "hostname": field(4),
        "appname": field(5), "procid": field(6), "messageid": field(7), "structured_data": last_of_each(entries), "body": raw(9), "valid": sure(hit),
    })


def parse_cef(df: DataFrame, line: str) -> DataFrame:
    """Header fields, which ``|`` parts (``\\|`` is text), and the ``extension`` map of key=value pairs; of a repeated key the last counts."""
    from millrace.operators.schema import CEF_HEADER

    part = r"((?:[^|\\]|\\.)*)"
    pattern = r"(?s)CEF:" + r"\|".join([part] * 7) + r"(?:\|(.*))?\z"
    hit = F.col(line).rlike(pattern)
    clean = lambda c: F.regexp_replace(c, r"\\([|\\=])", "$1")
    head = {n: F.when(hit, clean(F.regexp_extract(line, pattern, i))) for i, n in enumerate(CEF_HEADER, 1)}
    tail = F.when(hit, F.regexp_extract(line, pattern, 8))
    pair = F.lit(r"(\w+)=((?:[^=\\]|\\.)*)(?=\s+\w+=|\s*\z)")
    keys, values = F.regexp_extract_all(tail, pair, 1), F.transform(F.regexp_extract_all(tail, pair, 2), lambda v: clean(F.rtrim(v)))
    return df.withColumns(head | {"extension": last_of_each(F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))), "valid": sure(hit)})


# Fields of a flow record of version 5, and their sizes in bytes.
NETFLOW_V5 = {"srcaddr": 4, "dstaddr": 4, "nexthop": 4, "input": 2, "output": 2, "dPkts": 4, "dOctets": 4, "first": 4, "last": 4, "srcport": 2, "dstport": 2, "pad1": 1, "tcp_flags": 1, "prot": 1, "tos": 1, "src_as": 2, "dst_as": 2, "src_mask": 1, "dst_mask": 1, "pad2": 2}
NETFLOW_HEADER, NETFLOW_RECORD = 24, 48


def _unsigned(content: Column, at: Column, size: int) -> Column:
    return F.conv(F.hex(F.substring(content, at, F.lit(size))), 16, 10).cast("long")


def parse_netflow_v5(df: DataFrame, datagram: str) -> DataFrame:
    """A row for each flow record of the datagrams of version 5; addresses dotted, other fields as numbers."""
    c = F.col(datagram)
    size = F.least(_unsigned(c, F.lit(3), 2), F.floor((F.octet_length(c) - NETFLOW_HEADER) / NETFLOW_RECORD))
    rows = df.filter(_unsigned(c, F.lit(1), 2) == 5).withColumn("record_index", F.explode(F.when(size > 0, F.sequence(F.lit(0).cast("long"), size - 1)).otherwise(F.array().cast("array<bigint>"))))
    out, offset = {}, NETFLOW_HEADER + 1
    for name, width in NETFLOW_V5.items():
        at = (F.col("record_index") * NETFLOW_RECORD + offset).cast("int")
        if name in ("srcaddr", "dstaddr", "nexthop"):
            out[name] = F.concat_ws(".", *(_unsigned(c, at + i, 1).cast("string") for i in range(4)))
        else:
            out[name] = _unsigned(c, at, width)
        offset += width
    return rows.withColumns(out)


def parse_windows_event_xml(df: DataFrame, xml: str) -> DataFrame:
    """Provider, event id, level, computer and the data of an event's XML; a broken text gives nulls."""
    at = lambda p: F.nullif(F.xpath_string(F.col(xml), F.lit(p)), F.lit(""))
    return df.withColumns({
        "provider": at("/Event/System/Provider/@Name"), "event_id": at("/Event/System/EventID").try_cast("int"), "level": at("/Event/System/Level").try_cast("int"),
        "computer": at("/Event/System/Computer"), "data": F.xpath(F.col(xml), F.lit("/Event/EventData/Data/text()")),
    })


# --- html ------------------------------------------------------------------

# Elements that have no end tag.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Elements(HTMLParser):
    """Places of elements that match tag, #id or .class, alone or joined as tag.class."""

    def __init__(self, selector: str):
        super().__init__(convert_charrefs=False)
        m = re.fullmatch(r"([\w-]*)(?:#([\w-]+))?(?:\.([\w-]+))?", selector)
        if not m or not selector:
            raise ValueError(f"selector not understood: {selector}")
        self.tag, self.id, self.cls = (x or None for x in m.groups())
        self.open: list[tuple[str, int | None]] = []
        self.found: list[dict] = []

    def at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def scan(self, html: str) -> list[dict]:
        self.html = html
        self.lines = [0] + [m.end() for m in re.finditer("\n", html)]
        self.feed(html)
        self.close()
        for _, i in self.open:
            if i is not None:
                self.found[i] |= {"inner_end": len(html), "end": len(html)}
        return self.found

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        hit = (self.tag in (None, tag)) and (self.id in (None, values.get("id"))) and (self.cls is None or self.cls in (values.get("class") or "").split())
        start, after = self.at(), self.at() + len(self.get_starttag_text())
        index = None
        if hit:
            index = len(self.found)
            self.found.append({"start": start, "inner": after, "inner_end": after, "end": after, "attrs": values})
        if tag not in _VOID:
            self.open.append((tag, index))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        if tag in (t for t, _ in self.open):
            end = self.html.find(">", self.at()) + 1
            while True:
                name, i = self.open.pop()
                if i is not None:
                    self.found[i] |= {"inner_end": self.at(), "end": end if name == tag else self.at()}
                if name == tag:
                    break


def html_elements(html: str | None, selector: str, output: str = "html") -> list[str]:
    """Of each element: its ``html``, its inner ``text``, or an attribute ``@name``."""
    out = []
    for e in _Elements(selector).scan(html or ""):
        if output == "html":
            out.append(html[e["start"] : e["end"]])
        elif output == "text":
            out.append(re.sub(r"<[^>]*>", "", html[e["inner"] : e["inner_end"]]))
        elif output.startswith("@"):
            out.append(e["attrs"].get(output[1:]) or "")
    return out


def edit_html(html: str | None, selector: str, how: str, value: str) -> str | None:
    """``modify`` the inner text, ``prepend`` or ``append`` inside, or ``put`` after each outermost match."""
    if html is None:
        return None
    out, upto = [], 0
    for e in sorted(_Elements(selector).scan(html), key=lambda e: e["start"]):
        if e["start"] < upto:
            continue
        place = {"modify": (e["inner"], e["inner_end"]), "prepend": (e["inner"],) * 2, "append": (e["inner_end"],) * 2, "put": (e["end"],) * 2}[how]
        out += [html[upto : place[0]], value]
        upto = place[1]
    return "".join(out) + html[upto:]


def get_html_element(df: DataFrame, html: str, selector: str, output: str = "html") -> DataFrame:
    """Adds ``elements``, in Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: html_elements(t, selector, output))

    return df.withColumn("elements", run(F.col(html)))


def modify_html_element(df: DataFrame, html: str, selector: str, how: str, value: str) -> DataFrame:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: edit_html(t, selector, how, value))

    return df.withColumn(html, run(F.col(html)))


# --- split, segment, count -------------------------------------------------


def split_text(df: DataFrame, text: str, lines: int, header: int = 0) -> DataFrame:
    """A row for each ``lines`` lines, with the first ``header`` lines before each split."""
    every = F.split(text, "\n")
    head = F.slice(every, 1, header) if header else F.array().cast("array<string>")
    body = F.slice(every, F.lit(header + 1), F.greatest(F.size(every) - header, F.lit(0)))
    starts = F.when(F.size(body) > 0, F.sequence(F.lit(0), F.size(body) - 1, F.lit(lines))).otherwise(F.array().cast("array<int>"))
    return df.withColumn("__s", F.explode(starts)).withColumns({"fragment_index": F.floor(F.col("__s") / lines).cast("long"), "split": F.array_join(F.concat(head, F.slice(body, F.col("__s") + 1, F.lit(lines))), "\n")}).drop("__s")


def split_content(df: DataFrame, text: str, delimiter: str) -> DataFrame:
    """A row for each part between delimiters; empty parts are left out."""
    return df.select("*", F.posexplode(F.filter(F.split(text, re.escape(delimiter)), lambda x: x != "")).alias("fragment_index", "split"))


def segment_content(df: DataFrame, content: str, size: int) -> DataFrame:
    """Segments of ``size`` bytes with fragment_index from 1 and fragment_count; empty content is one segment."""
    b = F.col(content).cast("binary")
    count = F.greatest(F.ceil(F.octet_length(b) / size), F.lit(1))
    return df.withColumn("fragment_count", count).withColumn("fragment_index", F.explode(F.sequence(F.lit(1).cast("long"), F.col("fragment_count")))).withColumn("segment", F.substring(b, ((F.col("fragment_index") - 1) * size + 1).cast("int"), F.lit(size)))


def modify_bytes(content: Column, start: int = 0, end: int = 0, all_: bool = False) -> Column:
    """Without the first ``start`` and last ``end`` bytes; empty if nothing is left or all go."""
    b = content.cast("binary")
    left = F.octet_length(b) - start - end
    return F.when(b.isNull(), None).when((left > 0) & F.lit(not all_), F.substring(b, F.lit(start + 1), left)).otherwise(F.lit(b""))


def count_text(df: DataFrame, text: str) -> DataFrame:
    """Lines, lines that are not blank, words and characters of each text."""
    lines = F.split(text, "\n")
    return df.withColumns({
        "line_count": F.size(lines).cast("long"), "non_empty_line_count": F.size(F.filter(lines, lambda x: F.trim(x) != "")).cast("long"),
        "word_count": F.regexp_count(text, F.lit(r"\S+")).cast("long"), "character_count": F.length(text).cast("long"),
    })


# --- dictionaries ----------------------------------------------------------


def scan_attributes(df: DataFrame, dictionary: DataFrame, term: str, columns: Sequence[str], how: str = "any") -> DataFrame:
    """Adds ``matched``: any, or all, of the columns are in the dictionary; all of none is true."""
    terms = dictionary.filter(F.trim(term) != "").select(F.col(term).alias("__t")).distinct()
    for i, c in enumerate(columns):
        df = df.join(terms.withColumnRenamed("__t", f"__t{i}"), F.col(c) == F.col(f"__t{i}"), "left")
    hits = [F.col(f"__t{i}").isNotNull() for i in range(len(columns))]
    matched = reduce(lambda a, b: a & b, hits, F.lit(True)) if how == "all" else reduce(lambda a, b: a | b, hits, F.lit(False))
    return df.withColumn("matched", matched).drop(*(f"__t{i}" for i in range(len(columns))))


def scan_content(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Adds ``matched`` and the first term found; blank terms are ignored.

    The terms are one alternation, so every text is read once.
    """
    known = sorted({t for t in terms if t.strip()}, key=len, reverse=True)
    if not known:
        return df.withColumns({"matched": F.lit(False), "term": F.lit(None).cast("string")})
    pattern = "|".join(re.escape(t) for t in known)
    return df.withColumns({"matched": sure(F.col(text).rlike(pattern)), "term": F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))})


# --- encode, compress, hash ------------------------------------------------


#: What broken input raises in the packing modules.
_BROKEN = (ValueError, EOFError, OSError, NotImplementedError, RuntimeError, zlib.error, lzma.LZMAError, tarfile.TarError, zipfile.BadZipFile)


def _try_bytes(function: Callable[[bytes], bytes]):
    def one(value: bytes | None) -> bytes | None:
        try:
            return None if value is None else function(bytes(value))
        except _BROKEN:
            return None

    return one


def _per_row(c: Column, function: Callable[[bytes], bytes]) -> Column:
    one = _try_bytes(function)

    @F.arrow_udf("binary")
    def run(values: pa.Array) -> pa.Array:
        # a value that a batch repeats is taken once
        values = values.dictionary_encode()
        done = pa.array([one(v) for v in values.dictionary.to_pylist()], values.dictionary.type)
        return done.take(values.indices)

    return run(c.cast("binary"))


def encode_content(c: Column, encoding: str) -> Column:
    """base64, hex or base32 text of bytes."""
    if encoding == "base32":
        return _base32(c.cast("binary"))
    return F.base64(c.cast("binary")) if encoding == "base64" else F.lower(F.hex(c.cast("binary")))


def _base32(c: Column) -> Column:
    """20 bits (5 hex digits, 4 base-32 digits) at a time; bits beyond the bytes are 0, digits beyond them are ``=``."""
    groups = F.ceil(F.octet_length(c) / 5).cast("int")
    hexed = F.rpad(F.hex(c), groups * 10, "0")
    digits = F.transform(F.sequence(F.lit(0), groups * 2 - 1), lambda i: F.lpad(F.conv(F.substring(hexed, i * 5 + 1, F.lit(5)), 16, 32), 4, "0"))
    whole = F.translate(F.array_join(digits, ""), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    used = F.ceil(F.octet_length(c) * 8 / 5).cast("int")
    return F.when(groups > 0, F.rpad(F.left(whole, used), groups * 8, "=")).when(groups == 0, "")


def decode_content(c: Column, encoding: str) -> Column:
    """The bytes of an encoded text; null where it is not one."""
    if encoding == "base32":
        return _per_row(c, base64.b32decode)
    return F.try_to_binary(c, F.lit(encoding))


def _deflated(value: bytes, level: int, window: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, window)
    return z.compress(value) + z.flush()


#: Values up to this size get a dictionary of LZMA of their own size, above it that of the level.
_SHORT = 1 << 14


def _bzipped(value: bytes, level: int) -> bytes:
    """A level is a block of so many 100 kB; the least is taken that holds the value (runs may grow by a quarter), which gives the same block."""
    return bz2.compress(value, min(max(level, 1), 1 + len(value) * 5 // 4 // 99_900))


def _lzma(value: bytes, level: int, form: int, kind: int) -> bytes:
    """A dictionary beyond the value finds nothing more, but its tables are cleared for each value."""
    if len(value) > _SHORT:
        return lzma.compress(value, form, preset=level)
    size = max(1 << (len(value) - 1).bit_length(), 1 << 12) if value else 1 << 12
    return lzma.compress(value, form, filters=[{"id": kind, "preset": level, "dict_size": size}])


# Ways to pack one value and to unpack it.
_CODECS: dict[str, tuple[Callable[[bytes, int], bytes], Callable[[bytes], bytes]]] = {
    "gzip": (lambda v, level: _deflated(v, level, 31), lambda v: zlib.decompress(v, 31)),
    "deflate": (lambda v, level: _deflated(v, level, 15), zlib.decompress),
    "bzip2": (_bzipped, bz2.decompress),
    "xz": (lambda v, level: _lzma(v, level, lzma.FORMAT_XZ, lzma.FILTER_LZMA2), lzma.decompress),
    "lzma": (lambda v, level: _lzma(v, level, lzma.FORMAT_ALONE, lzma.FILTER_LZMA1), lambda v: lzma.decompress(v, lzma.FORMAT_ALONE)),
}


def _codec(kind: str) -> tuple[Callable[[bytes, int], bytes], Callable[[bytes], bytes]]:
    if kind not in _CODECS:
        raise ValueError(f"no such compression: {kind}")
    return _CODECS[kind]


def compress_content(c: Column, level: int = 6, kind: str = "gzip") -> Column:
    """Each value as one member of gzip, deflate (with zlib's head), bzip2, xz or lzma."""
    pack, _ = _codec(kind)
    return _per_row(c, lambda v: pack(v, level))


def unpack_content(c: Column, kind: str = "gzip") -> Column:
    """The bytes of a member; null where it is broken."""
    return _per_row(c, _codec(kind)[1])


def _zip(files: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in files:
            # one date, so that equal files give equal archives
            archive.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def _tar(files: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as archive:
        for name, content in files:
            head = tarfile.TarInfo(name)
            head.size = len(content)
            archive.addfile(head, io.BytesIO(content))
    return out.getvalue()


def _unzip(content: bytes) -> list[tuple[str, bytes]]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        return [(f.filename, archive.read(f)) for f in archive.infolist() if not f.is_dir()]


def _untar(content: bytes) -> list[tuple[str, bytes]]:
    with tarfile.open(fileobj=io.BytesIO(content), mode="r:") as archive:
        return [(f.name, archive.extractfile(f).read()) for f in archive if f.isfile()]


_ARCHIVES = {"zip": (_zip, _unzip), "tar": (_tar, _untar)}


def pack_files(df: DataFrame, key: Sequence[str], name: str, content: str, kind: str = "zip") -> DataFrame:
    """(key, archive): a zip or tar archive of each key's files, in order of their names; a null content is empty.

    An archive is one value, so ``key`` has to name bins of bounded size, as
    those of ``records.merge_bins``; rows with a null name are left out.
    """
    pack = _ARCHIVES[kind][0]

    @F.pandas_udf("binary")
    def packed(names: pd.Series, contents: pd.Series) -> pd.Series:
        return pd.Series([pack(list(zip(map(str, n), map(bytes, c)))) for n, c in zip(names, contents)], dtype=object)

    file = F.struct(F.col(name).cast("string").alias("n"), F.coalesce(F.col(content).cast("binary"), F.lit("").cast("binary")).alias("c"))
    files = df.filter(F.col(name).isNotNull()).groupBy(*key).agg(F.array_sort(F.collect_list(file)).alias("__f"))
    return files.select(*key, packed("__f.n", "__f.c").alias("archive"))


def unpack_files(df: DataFrame, archive: str, key: Sequence[str], kind: str = "zip") -> DataFrame:
    """(key, fragment_index, name, content): a row for each file in zip or tar archives.

    A null, broken or empty archive gives one row of nulls.  Folders are left out.
    """
    unpack = _ARCHIVES[kind][1]

    @F.pandas_udf("array<struct<name:string,content:binary>>")
    def files(values: pd.Series) -> pd.Series:
        out = []
        for value in values:
            try:
                out.append(None if value is None else [{"name": n, "content": c} for n, c in unpack(bytes(value))])
            except _BROKEN:
                out.append(None)
        return pd.Series(out, dtype=object)

    found = df.select(*key, F.posexplode_outer(files(F.col(archive).cast("binary"))).alias("fragment_index", "__f"))
    return found.select(*key, "fragment_index", "__f.name", "__f.content")


def hash_content(c: Column, algorithm: str = "SHA-256") -> Column:
    from millrace.functions.strings import hash_text

    return hash_text(c, algorithm)


def hash_columns(columns: Sequence[str], separator: str = "") -> Column:
    return F.sha2(F.concat_ws(separator, *columns), 256)


def hash_attribute(df: DataFrame, parts: dict[str, str], name: str = "hash") -> DataFrame:
    """MD5 over the matched parts of several columns, in order of name; null if a column is missing or null."""
    found = [F.regexp_extract(c, p, 0) for c, p in sorted(parts.items()) if c in df.columns]
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() if c in df.columns else F.lit(False) for c in parts))
    return df.withColumn(name, F.when(whole, F.md5(F.concat(*found).cast("binary"))))


def _majority(hashes: np.ndarray) -> int:
    """Each bit that more than half of some 64-bit numbers have."""
    ones = np.unpackbits(np.ascontiguousarray(hashes, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fuzzy_hash(c: Column, words: int = 3) -> Column:
    """SimHash of the word shingles, as a long: each bit is what most shingles' hashes have there; null without a word.

    Shingles are hashed by Spark; the 64 votes of each text are counted in numpy.
    """
    tokens = F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: w != "")
    # words beside those that follow them: linear, as the words are not cut anew for each shingle
    joined = tokens
    for k in range(2, words + 1):
        joined = F.zip_with(joined, F.slice(tokens, F.lit(k), F.greatest(F.size(tokens), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    shingles = F.transform(F.slice(joined, F.lit(1), F.greatest(F.size(tokens) - words + 1, F.lit(1))), lambda x: F.xxhash64(x))

    @F.pandas_udf("long")
    def votes(rows: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else _majority(r) for r in rows], dtype="Int64")

    return votes(F.when(c.rlike(r"(?U)\w"), shingles))


def hash_distance(a: Column, b: Column) -> Column:
    """Bits that differ."""
    return F.bit_count(a.bitwiseXOR(b))


def compare_fuzzy_hash(df: DataFrame, digest: str, known: DataFrame, known_digest: str, most: int, bands: int = 4) -> DataFrame:
    """Pairs whose digests differ in at most ``most`` bits.

    With more bands than ``most`` two such digests agree in a whole band, so
    pairs meet by (band, bits) and none is lost; a pair counts in the first band
    in which it agrees.  Null digests meet nothing.  Fewer bands are wider, so
    fewer unlike digests meet; digests that many rows share belong in ``known`` once.
    """
    if bands <= most:
        raise ValueError("needs more bands than bits that may differ")
    width = -(-64 // bands)
    cut = lambda c: F.posexplode(F.array(*(F.shiftrightunsigned(c, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(bands))))
    left = df.filter(F.col(digest).isNotNull()).select("*", cut(F.col(digest)).alias("__band", "__bits"))
    right = known.filter(F.col(known_digest).isNotNull()).select("*", cut(F.col(known_digest)).alias("__band", "__bits"))
    pairs = left.join(right, ["__band", "__bits"]).withColumn("distance", hash_distance(F.col(digest), F.col(known_digest)))
    unlike = F.col(digest).bitwiseXOR(F.col(known_digest))
    first = F.lit(bands)
    for i in reversed(range(bands)):
        first = F.when(F.shiftrightunsigned(unlike, i * width).bitwiseAND(F.lit((1 << width) - 1)) == 0, i).otherwise(first)
    return pairs.filter((F.col("distance") <= most) & (F.col("__band") == first)).drop("__band", "__bits")


# --- kinds and validity ----------------------------------------------------

# First bytes of common formats, in hex.
MAGIC = {"89504E470D0A1A0A": "image/png", "FFD8FF": "image/jpeg", "47494638": "image/gif", "25504446": "application/pdf", "504B0304": "application/zip", "1F8B08": "application/gzip", "425A68": "application/x-bzip2", "FD377A585A00": "application/x-xz", "4F626A01": "application/avro-binary", "50415231": "application/parquet", "4F5243": "application/orc", "52494646": "audio/x-riff", "7B": "application/json", "3C3F786D6C": "application/xml", "3C21444F435459504520": "text/html", "3C68746D6C": "text/html"}


def identify_mime_type(content: Column, name: Column | None = None) -> Column:
    """From the first bytes, else from the name's ending, else octets."""
    head = F.hex(F.substring(content.cast("binary"), 1, 16))
    c = None
    for magic, mime in sorted(MAGIC.items(), key=lambda m: -len(m[0])):
        c = (F if c is None else c).when(head.startswith(magic), mime)
    if name is not None:
        for end, mime in {".csv": "text/csv", ".txt": "text/plain", ".json": "application/json", ".xml": "application/xml", ".html": "text/html"}.items():
            c = c.when(F.lower(name).endswith(end), mime)
    return c.otherwise("application/octet-stream")


def _xml_errors(value: str, schema: T.StructType, required: bool) -> list[str]:
    try:
        root = ElementTree.fromstring(value)
    except ElementTree.ParseError as e:
        return [f"not well-formed: {e}"]
    errors: list[str] = []

    def check(text: str | None, kind: T.DataType, at: str) -> None:
        text = (text or "").strip()
        if isinstance(kind, T.IntegralType):
            bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}.get(type(kind), 64)
            good = re.fullmatch(r"[+-]?\d+", text) and -(1 << bits - 1) <= int(text) < 1 << bits - 1
        elif isinstance(kind, T.NumericType):
            good = re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text)
        elif isinstance(kind, T.BooleanType):
            good = text in ("true", "false")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            try:
                good = (datetime.date if isinstance(kind, T.DateType) else datetime.datetime).fromisoformat(text)
            except ValueError:
                good = None
        else:
            good = True
        if not good:
            errors.append(f"{at}: not a {kind.simpleString()}")

    def walk(node: ElementTree.Element, kind: T.StructType, at: str) -> None:
        fields = {f.name: f.dataType for f in kind.fields}
        found = dict.fromkeys(fields, 0)
        for name, text in node.attrib.items():
            if f"_{name}" not in fields:
                errors.append(f"{at}: unknown attribute {name}")
            else:
                found[f"_{name}"] += 1
                check(text, fields[f"_{name}"], f"{at}/@{name}")
        for child in node:
            name = child.tag.rpartition("}")[2]
            if name not in fields:
                errors.append(f"{at}: unknown element {name}")
                continue
            found[name] += 1
            inner = fields[name]
            many, inner = isinstance(inner, T.ArrayType), inner.elementType if isinstance(inner, T.ArrayType) else inner
            if found[name] == 2 and not many:
                errors.append(f"{at}: more than one element {name}")
            if isinstance(inner, T.StructType):
                walk(child, inner, f"{at}/{name}")
            elif len(child):
                errors.append(f"{at}/{name}: elements in a {inner.simpleString()}")
            elif (child.text or "").strip() or isinstance(inner, T.StringType):
                check(child.text, inner, f"{at}/{name}")
        if "_VALUE" in fields:
            found["_VALUE"] += 1
            check(node.text, fields["_VALUE"], at)
        for name, n in found.items():
            if required and not n and not isinstance(fields[name], T.ArrayType):
                errors.append(f"{at}: no {'attribute ' + name[1:] if name.startswith('_') else 'element ' + name}")

    walk(root, schema, root.tag.rpartition("}")[2])
    return errors


def validate_xml(df: DataFrame, xml: str, schema: str, required: bool = True) -> DataFrame:
    """Adds ``valid`` and ``error``: whether the text is XML of a schema, and what is wrong with it, by name.

    The schema's fields are the root's elements, ``_name`` its attributes and
    ``_VALUE`` its text; arrays are elements that may repeat.  Unknown and
    repeated elements, values of another type and, if ``required``, missing
    elements are errors; an empty element is a null.  A null text is not valid.
    """
    wanted = T._parse_datatype_string(schema)

    @F.pandas_udf("string")
    def errors(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "no text" if v is None else "; ".join(_xml_errors(v, wanted, required)) or None)

    return df.withColumn("error", errors(F.col(xml).cast("string"))).withColumn("valid", F.col("error").isNull()).select(*(c for c in df.columns if c not in ("valid", "error")), "valid", "error")


def validate_csv(df: DataFrame, line: str, schema: str, options: dict[str, str] | None = None) -> DataFrame:
    parsed = F.from_csv(F.col(line), f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"} | (options or {}))
    return df.withColumn("__x", parsed).withColumns({"valid": F.col("__x").isNotNull() & F.col("__x._corrupt_record").isNull(), "error": F.when(F.col("__x._corrupt_record").isNotNull(), "not valid by the schema")}).drop("__x")


def extract_email_headers(df: DataFrame, message: str) -> DataFrame:
    """Adds a map of header names in lower case to values; folded lines are joined, of repeated names the last counts."""
    head = F.regexp_replace(F.regexp_extract(message, r"(?s)\A(.*?)(?:\r?\n\r?\n|\z)", 1), r"\r?\n[ \t]+", " ")
    lines = F.filter(F.split(head, r"\r?\n"), lambda x: x.rlike(r"^[^\s:]+:"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.split_part(x, F.lit(":"), F.lit(1))).alias("k"), F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)).alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return df.withColumn("headers", F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda p: p["k"] == n), -1)["v"])))


