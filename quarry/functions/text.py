"""Text normalization as Column expressions.

All work is JVM-side regex except Unicode NFC and the repair of mojibake, which
Spark has no builtins for: they go through Arrow ``pandas_udf``s that only ever
see rows whose text holds a code point they can change (a gate), other rows ship
as null.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Character classes of the normalization rules.
# Control characters removed: U+0000-U+0008, U+000B-U+001F, U+007F
# (tab and newline survive to be collapsed as whitespace; CR, VT, FF are deleted).
CONTROL_CLASS = "[\\x00-\\x08\\x0B-\\x1F\\x7F]"
# Unicode whitespace (Python's str.isspace set), written out because Java's \s is ASCII-only.
WS_CHARS = "\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
WS_RUN = f"[{WS_CHARS}]+"
NOT_WS = f"[!-~]|[^{WS_CHARS}]"
# Code points in these ranges may change under NFC; text without any is
# NFC-inert and never enters Python. Java searches for a class that is written as
# its ranges ten times as fast as for the complement of the others.
NFC_GATE = "[\\x{300}-\\x{2001}\\x{2070}-\\x{209F}\\x{20D0}-\\x{10FFFF}]"


@pandas_udf(T.StringType())
def _nfc_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(c: Column) -> Column:
    """Unicode NFC. Only gated rows are sent to the Arrow worker."""
    gated = F.when(c.rlike(NFC_GATE), c)
    return F.coalesce(_nfc_udf(gated), c)


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(CONTROL_CLASS), F.lit(""))


def collapse_ws(c: Column) -> Column:
    """Collapse Unicode whitespace runs to one space and strip both ends."""
    return F.trim(F.regexp_replace(c, F.lit(WS_RUN), F.lit(" ")))


def normalize_text(c: Column) -> Column:
    """NFC -> strip control characters -> collapse whitespace, in that order."""
    return collapse_ws(strip_control(nfc(c)))


def text_sha1(c: Column) -> Column:
    """Hex SHA-1 of the UTF-8 bytes (the document fingerprint)."""
    return F.sha1(c.cast("binary"))


def n_chars(c: Column) -> Column:
    """Length in code points."""
    return F.length(c)


def is_blank(c: Column) -> Column:
    """Null-safe: true for null, empty or whitespace-only text."""
    return ~F.coalesce(c.rlike(NOT_WS), F.lit(False))


# The Windows-1252 characters of bytes 0x80-0x9F, in byte order
# (0x81, 0x8D, 0x8F, 0x90 and 0x9D are unassigned and map to themselves).
CP1252_HIGH = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
C1_CONTROLS = "".join(chr(c) for c in range(0x80, 0xA0))


def page_high(page: str) -> str:
    """The characters of bytes 0x80-0xFF in a code page; a byte without one maps to itself."""
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in range(0x80, 0x100))


LATIN_HIGH = page_high("latin-1")
#: The pages by which UTF-8 is misread, with the letters that bytes 0xC2-0xC5 become in them. Sequences that these bytes
#: begin are U+00A0-U+017F, the letters of western and central Europe; a page's other letters begin too much clean text.
PAGES = {"cp1252": "\u00c2\u00c3\u00c4\u00c5", "cp1250": "\u00c2\u0102\u00c4\u0139"}
#: Letters that hardly any clean text has before such marks: one damaged character with them is enough.
STRONG = "\u0102\u0139\u00e2"
TRIPLE = "\u00e2"  # byte 0xE2 in both pages: dashes, quotes, the euro sign
_CP1252 = re.compile(f"[{''.join(x for x in CP1252_HIGH if x > LATIN_HIGH[-1])}]")
_WIDE = re.compile(f"[^\\x00-\\xFF{''.join(x for x in CP1252_HIGH if x > LATIN_HIGH[-1])}]")
TRIPLE = "\u00e2"  # byte 0xE2 in both pages: dashes, quotes, the euro sign
_CP1252 = re.compile(f"[{''.join(x for x in CP1252_HIGH if x > LATIN_HIGH[-1])}]")
_WIDE = re.compile(f"[^\\x00-\\xFF{''.join(x for x in CP1252_HIGH if x > LATIN_HIGH[-1])}]")


@functools.lru_cache(maxsize=None)
def _sequences(page: str) -> tuple[re.Pattern, dict[str, str]]:
    """The pattern of a page's damaged sequences and what each of them stands for."""
    high, leads = page_high(page), PAGES[page]
    marks = "".join(sorted(set(high[:0x40]) | set(LATIN_HIGH[:0x20])))  # bytes 0x80-0xBF, also as control characters
    after = {x: marks for x in leads}
    after[leads[0]] = high[0x20:0x40]  # 0xC2 0x80-0x9F are control characters
    byte = dict(zip(high, range(0x80, 0x100)))
    pairs = [x + m for x, ms in after.items() for m in ms]
    triples = [TRIPLE + m + n for m in marks for n in marks]
    sound = {x: bytes(byte.get(ch, ord(ch)) for ch in x).decode("utf-8") for x in pairs + triples}
    pattern = "|".join([*(f"{x}[{ms}]" for x, ms in after.items()), f"{TRIPLE}[{marks}][{marks}]"])
    return re.compile(pattern), sound


def _segments(text: str, page: str) -> str:
    """``text`` with its damaged sequences decoded; ``text`` itself where there is too little evidence of damage."""
    pattern, sound = _sequences(page)
    found = Counter(x[0] for x in pattern.findall(text))
    # a letter that also stands without a mark is a letter of this text
    begins = {x for x, m in found.items() if x == TRIPLE or text.count(x) == m}
    if sum(found[x] for x in begins) > 1 or begins & set(STRONG):
        return pattern.sub(lambda m: sound[m[0]] if m[0][0] in begins else m[0], text)
    return text


def _whole(text: str) -> str | None:
    """``text`` read as Windows-1252 bytes of UTF-8; None where it is not."""
    if _WIDE.search(text):
        return None
    for x in set(_CP1252.findall(text)):
        text = text.replace(x, C1_CONTROLS[CP1252_HIGH.index(x)])
    try:
        return text.encode("latin-1").decode("utf-8")
    except UnicodeDecodeError:
        return None


@pandas_udf(T.StringType())
def _mojibake_udf(s: pd.Series) -> pd.Series:
    """The repaired texts; null where nothing is repaired."""
    def repaired(text):
        if text is None:
            return None
        whole = _whole(text)
        fixed = _segments(_segments(text, "cp1252"), "cp1250") if whole is None else whole
        return None if fixed == text else fixed
    return s.map(repaired)


def fix_mojibake(c: Column) -> Column:
    """Repair UTF-8 text that was decoded as Latin-1, Windows-1252 or Windows-1250 ('gÄ\x99Å\x9b', 'gÄ™Å›' or 'gÄ™Ĺ›' -> 'gęś').

    Windows-1252 punctuation is first mapped back to its byte value; text whose
    code points then all fit in one byte, with at least one above 0x7F, is
    re-encoded and kept only if the bytes form valid UTF-8. In any other text the
    damaged sequences are repaired on their own (sound text beside them stays):
    those of U+00A0-U+017F and U+2000-U+2FFF, when their first letter never stands
    without a mark in the text, and when there are two of them or one with a
    letter of ``STRONG``. So 'café', '„Ä“' and 'PÓŁ' stay as they are.
    """
    gated = F.when(c.rlike("[\\x{80}-\\x{10FFFF}]"), F.make_valid_utf8(c))
    return F.coalesce(_mojibake_udf(gated), c)
