"""Unicode steps that Spark has no built-in for, as Arrow-batched functions."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Typographic characters and what they stand for.
PLAIN = str.maketrans(
    {"\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"'}
    | {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "ſt", "\ufb06": "st", "\u2028": "\n", "\u2029": "\n", "\x85": "\n"}
    | {"\u0132": "IJ", "\u0133": "ij", "\u0149": "ʼn", "\u01f1": "DZ", "\u01f2": "Dz", "\u01f3": "dz", "\u01c4": "DŽ", "\u01c5": "Dž", "\u01c6": "dž", "\u01c7": "LJ", "\u01c8": "Lj", "\u01c9": "lj", "\u01ca": "NJ", "\u01cb": "Nj", "\u01cc": "nj"}
)
WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20}
CONTROL = {c: None for c in (*range(0, 9), 11, *range(14, 32), 127, 0xFEFF)}


# HTML entities in a text, and escape sequences of terminals.
ENTITY = re.compile(r"&#?[0-9A-Za-z]{1,24};")
TERMINAL = re.compile(r"\x1b\[(?:\d|;)*[a-zA-Z]")
#: C1 control characters as Windows-1252 reads their bytes, where it has a character for them.
C1 = {b: c for b in range(0x80, 0xA0) if b != 0x85 and (c := bytes([b]).decode("cp1252", "ignore"))}


def decoded(text: str) -> str:
    """The text that was read as Windows-1252 or Latin-1 but is UTF-8, as often as it was."""
    for _ in range(4):
        for code in ("cp1252", "latin-1"):
            try:
                fixed = text.encode(code).decode("utf-8")
            except UnicodeError:
                continue
            break
        else:
            return text
        if fixed == text:
            return text
        text = fixed
    return text


def fix_text(text: str) -> str:
    """A subset of text repair: entities (of texts without tags), terminal escapes, doubly encoded UTF-8, C1 controls, quotes, ligatures, wide forms, line ends, control characters, NFC.

    Not covered: mixed encodings within one text, and encodings other than Windows-1252 and Latin-1.
    """
    if "<" not in text and "&" in text:
        text = ENTITY.sub(lambda m: html.unescape(m[0]), text)
    text = decoded(TERMINAL.sub("", text)).translate(C1)
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    return unicodedata.normalize("NFC", text.translate(PLAIN).translate(WIDE).translate(CONTROL))


def without_accents(text: str) -> str:
    """NFD without the marks on Latin letters; marks of other scripts stay."""
    out, on_latin = [], False
    for ch in unicodedata.normalize("NFD", text):
        if unicodedata.category(ch)[0] == "M":
            if on_latin:
                continue
        else:
            code = ord(ch)
            named = code <= 0x2AF and unicodedata.name(ch, "").startswith("LATIN")
            on_latin = named or (unicodedata.category(ch)[0] == "L" and 0x41 <= code <= 0x24F)
        out.append(ch)
    return "".join(out)


def script_of(ch: str) -> str | None:
    """The first word of a letter's or mark's name, beyond ASCII."""
    if ch < "\x80" or unicodedata.category(ch)[0] not in "LM":
        return None
    return unicodedata.name(ch, "").split(" ")[0] or None


def scripts_in(text: str) -> list[str]:
    return sorted({s for s in map(script_of, set(text)) if s})


@F.pandas_udf(T.StructType([T.StructField("fixed", T.StringType()), T.StructField("nfkd", T.StringType())]))
def _unicode(texts: pd.Series) -> pd.DataFrame:
    fixed = [None if t is None else t if t.isascii() and t.isprintable() and "&" not in t else fix_text(t) for t in texts]
    return pd.DataFrame({"fixed": fixed, "nfkd": [None if t is None else unicodedata.normalize("NFKD", t) for t in fixed]}, dtype=object)


@F.pandas_udf(T.StringType())
def nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))


@F.pandas_udf(T.StringType())
def fix_encoding(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else fix_text(t))


@F.pandas_udf(T.StructType([T.StructField("no_accent", T.StringType()), T.StructField("scripts", T.ArrayType(T.StringType()))]))
def _accents(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"no_accent": [None if t is None else t if t.isascii() else without_accents(t) for t in texts], "scripts": [[] if t is None or t.isascii() else scripts_in(t) for t in texts]}, dtype=object)


def unicode_forms(c: Column) -> Column:
    """Struct of the repaired text and its NFKD form, in one pass through Python."""
    return _unicode(c)


def accents_and_scripts(c: Column) -> Column:
    """Struct of the text without accents and its scripts, in one pass through Python."""
    return _accents(c)
