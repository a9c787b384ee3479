"""Transcript normalisation as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters and keywords of the normaliser, character set and fallbacks.
APOSTROPHES = "‘’ʼʹ′´`"
QUOTES = "“”„«»"
DASHES = "‐‑‒–—―"
LETTERS = "abcdefghijklmnopqrstuvwxyzàèéòù"
PUNCTUATION = " .,?!'-:;\"()%&/"
FALLBACKS = {":": ",", ";": ",", "…": "...", "(": "", ")": "", "[": "", "]": "", "{": "", "}": "", "/": " ", "\\": " ", "|": " ", "_": " ", "%": "", "&": "", "*": "", "+": "", "=": "", "@": "", "#": "", "~": "", "^": ""}

CONTROL = r"[\x00-\x08\x0b-\x1f\x7f-\x9f]"
BRACKETED = r"[\[(<](?:noise|inaudible|unk|silence|music|laugh|applause|foreign|uh+|um+)[^\])>]*[\])>]"
CHARSET = "".join(sorted(set(LETTERS + LETTERS.upper() + "0123456789" + PUNCTUATION)))
TAG = r"<[a-z]{2,3}(?:-[A-Za-z]{2,4})?>"
# Code points that are composed as they stand: up to U+02FF, general punctuation, currency signs,
# CJK ideographs.
COMPOSED = r"\x{0000}-\x{02FF}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20A0}-\x{20BF}\x{4E00}-\x{9FFF}"


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(text: Column) -> Column:
    """Composed form. Texts of COMPOSED code points alone reach the Arrow function as nulls."""
    return F.coalesce(_nfc(F.when(text.rlike(f"[^{COMPOSED}]"), text)), text)


def normalize(text: Column, lowercase: bool = False, strip_bracketed: bool = True, fold_apostrophes: bool = True, compose: bool = True) -> Column:
    """The whole chain; null and all-noise texts give the empty string."""
    x = F.coalesce(text, F.lit(""))
    x = nfc(x) if compose else x
    x = F.regexp_replace(x, CONTROL, " ")
    if strip_bracketed:
        x = F.regexp_replace(x, "(?i)" + BRACKETED, " ")
    if fold_apostrophes:
        x = F.translate(x, APOSTROPHES, "'" * len(APOSTROPHES))
    x = F.translate(x, QUOTES + DASHES + " ", '"' * len(QUOTES) + "-" * len(DASHES) + " ")
    x = F.replace(x, F.lit("​"), F.lit(""))
    x = F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
    x = F.regexp_replace(x, r"(?U)\s+([,.!?;:])", "$1")
    return F.lower(x) if lowercase else x


def out_of_charset(text: Column, charset: str = CHARSET) -> Column:
    """Distinct characters of a text that are not in the character set."""
    left = F.translate(text, charset, "")
    return F.when(left == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(left, "")))


def is_cased(text: Column) -> Column:
    return text.rlike(r"\p{Lu}")


def is_punctuated(text: Column) -> Column:
    return text.rlike("[.!?,]")


def _class(characters: str, negated: bool = False) -> str:
    """A pattern for one of these characters or a blank, or for one that is neither."""
    return "(?U)[" + "^" * negated + r"\s" + "".join(rf"\x{{{ord(c):X}}}" for c in characters) + "]"


def sanitize(text: Column, encodable: str, fallbacks: dict[str, str] = FALLBACKS) -> Column:
    """Keep encodable characters and blanks, replace by fallback, drop the rest, collapse blanks.

    What has no fallback goes in one pass; then fallbacks of one character or none are one
    translation, longer ones a replacement each.
    """
    table = {c: x for c, x in fallbacks.items() if c not in encodable}
    out = F.regexp_replace(text, _class(encodable + "".join(table), negated=True), "")
    single = sorted(table.items(), key=lambda kv: -len(kv[1]))
    for c, x in single:
        if len(x) > 1:
            out = F.replace(out, F.lit(c), F.lit(x))
    short = [(c, x) for c, x in single if len(x) <= 1]
    out = F.translate(out, "".join(c for c, _ in short), "".join(x for _, x in short))
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def unencodable(text: Column, encodable: str) -> Column:
    """Every occurrence of a character that is substituted or dropped."""
    left = F.regexp_replace(text, _class(encodable), "")
    return F.when(left == "", F.array().cast("array<string>")).otherwise(F.split(left, ""))


def scoring_form(text: Column, aggressive: bool = True, compose: bool = True) -> Column:
    """Form in which references and hypotheses are compared."""
    x = F.coalesce(text, F.lit(""))
    x = nfc(x) if compose else x
    x = F.regexp_replace(x, TAG, " ")
    if aggressive:
        x = F.translate(F.lower(x), "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»…", "")
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def language_tags(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TAG), F.lit(0))


def speaking_rate(text: Column, duration: Column) -> Column:
    return F.when(duration > 0, F.length(text) / duration).otherwise(F.lit(float("inf")))


def hash_bucket(key: Column) -> Column:
    """A number in [0, 1] from the first eight hex digits of md5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def _piece(done: Column, open_: Column) -> Column:
    return F.struct(done.cast("array<string>").alias("done"), open_.alias("open"))


def _fill(units: Column, limit: int, broken=None) -> Column:
    """Greedy lines of at most `limit` characters from an array of units, joined by blanks.

    A unit that is longer itself ends the line before it and stands as the pieces broken(unit).
    """
    none = F.array()

    def add(acc, x):
        room = F.length(acc["open"]) + 1 + F.length(x) <= limit
        line = F.when(acc["open"] == "", _piece(acc["done"], x)).when(room, _piece(acc["done"], F.concat_ws(" ", acc["open"], x))).otherwise(_piece(F.concat(acc["done"], F.array(acc["open"])), x))
        if broken is None:
            return line
        closed = F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        return F.when(F.length(x) > limit, _piece(F.concat(closed, broken(x)), F.lit(""))).otherwise(line)

    end = lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
    return F.aggregate(units, _piece(none, F.lit("")), add, end)


def chunks(text: Column, limit: int) -> Column:
    """Split a text into pieces of at most `limit` characters: at sentence ends, in a sentence that
    is too long at clause marks, in such a clause at blanks, in such a word anywhere. Each level
    fills its own lines; at the end, neighbours are joined again while they fit.
    """
    one = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    cut = lambda word: F.regexp_extract_all(word, F.lit(f"(?s).{{1,{limit}}}"), F.lit(0))
    wrapped = lambda clause: _fill(F.split(clause, " "), limit, cut)
    broken = lambda sentence: _fill(F.split(sentence, r"(?<=[,;:])\s+"), limit, wrapped)
    sentences = F.split(one, r"(?<=[.!?…])\s+")
    parts = F.flatten(F.transform(sentences, lambda s: F.when(F.length(s) > limit, broken(s)).otherwise(F.array(s))))
    return F.when(one != "", _fill(F.filter(parts, lambda x: x != ""), limit)).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))
