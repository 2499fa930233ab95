"""Bytes of a page to text, by the encoding that the page declares; built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markup import let

#: Names under which pages declare an encoding (fixed values of HTML; ISO-8859-1 means windows-1252 there).
LABELS = {
    "utf-8": ("utf-8", "utf8", "unicode-1-1-utf-8"),
    "iso-8859-2": ("iso-8859-2", "iso8859-2", "iso_8859-2", "latin2", "l2"),
    "windows-1250": ("windows-1250", "cp1250", "x-cp1250"),
    "windows-1252": ("windows-1252", "cp1252", "iso-8859-1", "iso8859-1", "latin1", "l1", "ascii", "us-ascii"),
    "iso-8859-15": ("iso-8859-15", "latin9", "l9"),
    "windows-1251": ("windows-1251", "cp1251"),
    "koi8-r": ("koi8-r", "koi8"),
}

#: Bytes in which a page has to declare its encoding.
HEAD = 1024

UPPER_HALF = "".join(map(chr, range(128, 256)))


def upper_half(encoding: str) -> str:
    """The characters of bytes 128 to 255 in a single-byte encoding; U+FFFD where there is none."""
    return bytes(range(128, 256)).decode(encoding, "replace")


def single_byte(content: Column, encoding: str) -> Column:
    return F.translate(F.decode(content, "ISO-8859-1"), UPPER_HALF, upper_half(encoding))


def encode_single_byte(text: Column, encoding: str) -> Column:
    """The inverse for text that the encoding can hold."""
    pairs = [(c, b) for c, b in zip(upper_half(encoding), UPPER_HALF) if c != "�"]
    return F.encode(F.translate(text, "".join(c for c, _ in pairs), "".join(b for _, b in pairs)), "ISO-8859-1")


def declared(content: Column, header: Column | None = None, default: str = "utf-8") -> Column:
    """The encoding of a page: a byte order mark, else ``header`` (a content type or bare name), else the page's own
    ``meta``, else ``default``. Names that are not known count as not given."""
    def known(name: Column) -> Column:
        name = F.lower(F.trim(name))
        out = F.when(name.isin(*LABELS["utf-8"]), "utf-8")
        for encoding, names in LABELS.items():
            out = out.when(name.isin(*names), encoding)
        return out

    start = F.decode(F.substring(content, 1, HEAD), "ISO-8859-1")
    meta = F.regexp_extract(start, r"""(?is)<meta\s[^>]*?charset\s*=\s*["']?\s*([^\s"'/>;]+)""", 1)
    candidates = [known(meta), F.lit(default)]
    if header is not None:
        candidates.insert(0, known(F.regexp_extract(header, r"""(?i)(?:charset\s*=\s*)?["']?([^\s"';=/]+)["']?\s*$""", 1)))
    mark = F.hex(F.substring(content, 1, 3))
    return (F.when(mark == "EFBBBF", "utf-8").when(mark.startswith("FEFF"), "utf-16be").when(mark.startswith("FFFE"), "utf-16le")
            .otherwise(F.coalesce(*candidates)))


def decode_page(content: Column, encoding: Column) -> Column:
    """The text of ``content`` in ``encoding`` (of ``declared``), without a byte order mark. Bytes that are no character
    become U+FFFD; UTF-16 pages of an odd length lose the last byte."""
    def body(e: Column) -> Column:
        even = F.substring(content, F.lit(3), F.octet_length(content) - 2 - F.octet_length(content) % 2)
        out = (F.when(e == "utf-16be", F.decode(even, "UTF-16BE")).when(e == "utf-16le", F.decode(even, "UTF-16LE")))
        for name in LABELS:
            if name != "utf-8":
                out = out.when(e == name, single_byte(content, name))
        return out.otherwise(F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^﻿", ""))

    return let(encoding, body)
