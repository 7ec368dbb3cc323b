"""Longest-prefix match of IPv4 and IPv6 addresses.

An address is 32 hex digits; IPv4 is mapped into IPv6 (``::ffff:a.b.c.d``), so both
forms of one address are equal and one table holds prefixes of both.  Each distinct
address is cut to the prefix lengths that the table has, at most 129, and met with
the table by equal (length, digits); of the hits the longest counts.  All is built-in
functions and plain joins.

Defined cases: what is no address, null included, is not found; what is no prefix is
an error, as are bits set behind one's length if ``strict``; of equal prefixes the one
with the least columns counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}"
_MAPPED = "0" * 20 + "ffff"


def _octets(c: Column, pattern: str, first: int) -> list[Column]:
    return [F.lpad(F.lower(F.hex(F.regexp_extract(c, pattern, first + i).try_cast("int"))), 2, "0") for i in range(4)]


def address_digits(c: Column) -> Column:
    """The 32 hex digits of an address in any of its forms, or null."""
    text = F.lower(F.trim(c))
    plain = F.concat(F.lit(_MAPPED), *_octets(text, rf"^{_IPV4}$", 1))
    tail = rf"^([0-9a-f:]*:){_IPV4}$"
    octets = _octets(text, tail, 2)
    text6 = F.when(text.rlike(tail), F.concat(F.regexp_extract(text, tail, 1), octets[0], octets[1], F.lit(":"), octets[2], octets[3])).otherwise(text)
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    left = groups(F.substring_index(text6, "::", 1))
    right = F.when(text6.contains("::"), groups(F.substring_index(text6, "::", -1))).otherwise(F.array().cast("array<string>"))
    zeros = 8 - F.size(left) - F.size(right)
    # one "::" at most, and no colon at an end but its own
    sound = text6.rlike(r"^[0-9a-f]{0,4}(:[0-9a-f]{0,4}){2,8}$") & ~text6.rlike(r"::.*::|:::|^:[^:]|[^:]:$")
    sound &= F.when(text6.contains("::"), zeros >= 1).otherwise(zeros == 0)
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(zeros, F.lit(0))), right)
    digits6 = F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), "")
    return F.when(text.rlike(rf"^{_IPV4}$"), plain).when(sound, digits6)


def cut_digits(digits: Column, bits: Column) -> Column:
    """The first ``bits`` bits of an address: its whole digits, and the rest of one with the bits behind it off."""
    whole, rest = F.floor(bits / 4).cast("int"), F.pmod(bits, F.lit(4)).cast("int")
    last = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    kept = last.bitwiseAND(F.lit(15) - F.element_at(F.array(F.lit(15), F.lit(7), F.lit(3), F.lit(1)), rest + 1))
    return F.concat(F.substring(digits, F.lit(1), whole), F.when(rest > 0, F.lower(F.hex(kept))).otherwise(""))


def parsed_prefixes(prefixes: DataFrame, cidr: str, strict: bool = False) -> DataFrame:
    """``prefixes`` with ``__bits`` (of 128) and ``__digits``; an address without a length is a whole one."""
    address, length = F.substring_index(cidr, "/", 1), F.when(F.col(cidr).contains("/"), F.substring_index(cidr, "/", -1).try_cast("int"))
    digits = address_digits(address)
    short = address.contains(".") & ~address.contains(":")
    bits = F.when(length.isNull(), F.when(F.col(cidr).contains("/"), None).otherwise(128)).otherwise(length + F.when(short, 96).otherwise(0))
    good = digits.isNotNull() & bits.between(F.when(short, 96).otherwise(0), 128)
    made = prefixes.withColumns({"__whole": F.when(good, digits), "__n": F.when(good, bits)})
    key = cut_digits(F.col("__whole"), F.col("__n"))
    sound = F.coalesce(F.rpad(key, 32, "0") == F.col("__whole"), F.lit(False)) if strict else F.col("__n").isNotNull()
    # in both columns, so that no plan passes the check by
    checked = lambda c: F.when(sound, c).otherwise(F.raise_error(F.concat(F.lit("not a prefix: "), F.coalesce(F.col(cidr), F.lit("null")))))
    return made.withColumns({"__bits": checked(F.col("__n")), "__digits": checked(key)}).drop("__whole", "__n")


def lookup_prefix(df: DataFrame, ip: str, prefixes: DataFrame, cidr: str, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """``df`` with the columns of the longest prefix that holds its address, and ``found``."""
    table = parsed_prefixes(prefixes, cidr, strict).groupBy("__bits", "__digits").agg(F.min(F.struct(*columns)).alias("__hit"))
    # at most 129 numbers
    lengths = sorted(r[0] for r in table.select("__bits").distinct().collect())
    known = df.select(F.col(ip).cast("string").alias("__ip")).distinct().withColumn("__d", address_digits(F.col("__ip"))).filter("__d IS NOT NULL")
    each = known.select("__ip", "__d", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")).alias("__bits"))
    hits = each.withColumn("__digits", cut_digits(F.col("__d"), F.col("__bits"))).join(table, ["__bits", "__digits"])
    best = hits.groupBy("__ip").agg(F.max_by("__hit", "__bits").alias("__hit"))
    out = df.join(best, F.col(ip).cast("string") == F.col("__ip"), "left")
    return out.select(*df.columns, *(F.col(f"__hit.{c}").alias(c) for c in columns), F.col("__ip").isNotNull().alias("found"))
