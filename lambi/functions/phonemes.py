"""Haitian Creole numbers and phonemes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lambi.functions.textnorm import normalize

# Number words and phonemes of the language (nasal vowels end in U+0303, g is U+0261).
UNITS = ["zewo", "en", "de", "twa", "kat", "senk", "sis", "sèt", "uit", "nèf", "dis", "onz", "douz", "trèz", "katòz", "kenz", "sèz", "disèt", "dizuit", "diznèf"]
# Tens: the word alone, before one, and before any other unit; seventy and ninety count on to 19.
TENS = [
    (20, "ven", "venteyen", "venn"), (30, "trant", "tranteyen", "trann"), (40, "karant", "karanteyen", "karann"), (50, "senkant", "senkanteyen", "senkann"), (60, "swasant", "swasanteyen", "swasann"),
    (70, "swasanndis", "swasannonz", "swasann"), (80, "katreven", "katreven en", "katreven"), (90, "katrevendis", "katrevenonz", "katreven"),
]
CURRENCY = {"$": "dola", "€": "ero", "HTG": "goud", "USD": "dola"}
PHONEMES = {
    "oun": "u\u0303", "ann": "an", "enn": "ɛn", "onn": "ɔn", "an": "ɑ̃", "en": "ɛ̃", "on": "ɔ̃", "ou": "u", "ui": "ɥi", "ch": "ʃ", "ny": "ɲ",
    "a": "a", "e": "e", "i": "i", "o": "o", "u": "u", "à": "a", "é": "e", "è": "ɛ", "ò": "ɔ", "ù": "u",
    "p": "p", "b": "b", "t": "t", "d": "d", "k": "k", "g": "ɡ", "f": "f", "v": "v", "s": "s", "z": "z", "h": "h", "m": "m", "n": "n", "l": "l",
    "j": "ʒ", "r": "ɣ", "w": "w", "y": "j", "c": "k", "q": "k", "x": "ks",
}
VOWELS = "aeiouàèéòù"
LETTERS = "a-zàèéòù"


def below_thousand() -> list[str]:
    """Words of 0 to 999: units joined to the tens table, then hundreds before both."""
    rows = [(start + k, {0: alone, 1: one}.get(k, stem + UNITS[k + 10 * (start in (70, 90))])) for start, alone, one, stem in TENS for k in range(10)]
    small = UNITS + [word for _, word in sorted(rows)]
    hundreds = [""] + [(UNITS[h] if h > 1 else "") + "san" for h in range(1, 10)]
    return [" ".join(filter(None, (head, word if k or not head else ""))) for head in hundreds for k, word in enumerate(small)]


def number_words(n: Column) -> Column:
    """An integer of magnitude below a million in words; null beyond."""
    table = F.split(F.lit("|".join(below_thousand())), r"\|")
    at = lambda i: F.element_at(table, (i + 1).cast("int"))
    size = F.abs(n)
    thousands, rest = F.floor(size / 1000), size % 1000
    head = F.when(thousands == 1, "mil").otherwise(F.concat(at(thousands), F.lit(" mil")))
    words = F.when(size < 1000, at(rest)).when(rest == 0, head).otherwise(F.concat_ws(" ", head, at(rest)))
    return F.when(size < 1_000_000, F.when(n < 0, F.concat(F.lit("mwens "), words)).otherwise(words))


def _digits(text: Column) -> Column:
    units = F.array(*map(F.lit, UNITS[:10]))
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c.rlike("^[0-9]$")), lambda c: F.element_at(units, c.cast("int") + 1)), " ")


def _spoken(run: Column) -> Column:
    """Words of one number as written, with its separators."""
    plain = F.regexp_replace(run, r"[,\s]", "")
    whole, frac = F.regexp_extract(plain, r"^([0-9]*)", 1), F.regexp_extract(plain, r"\.(.*)$", 1)
    value = F.when(F.length(whole) <= 6, number_words(F.when(whole == "", "0").otherwise(whole).try_cast("bigint"))).otherwise(_digits(whole))
    decimal = F.concat_ws(" ", F.when(whole != "", value), F.lit("vigil"), F.when(_digits(frac) != "", _digits(frac)))
    long = F.coalesce(number_words(whole.try_cast("bigint")), _digits(whole))
    return F.when(plain.contains("."), decimal).when(F.length(whole) > 6, long).otherwise(value)


def expand_numbers(text: Column) -> Column:
    """Replace numbers and currency signs by words."""
    for sign, word in CURRENCY.items():
        text = F.replace(text, F.lit(sign), F.lit(f" {word} "))
    runs = F.regexp_extract_all(text, F.lit(r"[0-9][0-9\s.,]*[0-9]|[0-9]|[^0-9]+"), F.lit(0))
    said = lambda x: F.when((F.length(x) <= 6) & ~x.rlike("[^0-9]"), number_words(x.try_cast("bigint"))).otherwise(_spoken(x))
    return F.array_join(F.transform(runs, lambda x: F.when((x >= "0") & (x < ":"), said(x)).otherwise(x)), "")


def word_phonemes(word: Column) -> Column:
    """Phonemes of one lower-case word: longest match from the left, with the vowel guards."""
    table = F.create_map(*[F.lit(v) for kv in PHONEMES.items() for v in kv])
    pattern = rf"oun(?![{VOWELS}])|ann|enn|onn|[aeo]n(?![{VOWELS}ny])|ou|ui|ch|ny|[{LETTERS}]"
    return F.array_join(F.transform(F.regexp_extract_all(word, F.lit(pattern), F.lit(0)), lambda x: F.coalesce(F.try_element_at(table, x), F.lit(""))), "")


def prepare(text: Column, compose: bool = True) -> Column:
    """Normalised, lower-cased, numbers spelled, elisions closed."""
    out = expand_numbers(normalize(text, lowercase=True, compose=compose))
    return F.regexp_replace(out, rf"(?<=[{LETTERS}])'(?=[{LETTERS}])", "")


def tokens(text: Column, compose: bool = True) -> Column:
    """Words, marks and blanks of a text as it is spoken, in order."""
    return F.regexp_extract_all(prepare(text, compose), F.lit(rf"[{LETTERS}]+|[.,!?;:]|\s+"), F.lit(0))


def token_phonemes(token: Column, keep_punctuation: bool = True) -> Column:
    """Phonemes of one token: a blank is one blank, a mark itself unless switched off."""
    return F.when(token.rlike(r"^\s"), " ").when(token.rlike("^[.,!?;:]"), token if keep_punctuation else "").otherwise(word_phonemes(token))


#: Private characters that stand for runs of letters, and for what is no part of a word.
_OTHER, _OUN, _ANN, _ENN, _ONN, _NASAL, _OU, _UI, _CH, _NY, _X = map(chr, range(0xE000, 0xE00B))


def phonemes(text: Column, keep_punctuation: bool = True, compose: bool = True) -> Column:
    """Phonemes of a text; words keep their punctuation unless switched off. A null text has none.

    The same as `token_phonemes` of its tokens, by steps over the whole text: no run of letters overlaps
    with one that is replaced after it, so that the order of steps gives the longest match from the left.
    """
    x = F.regexp_replace(prepare(text, compose), rf"[^{LETTERS}\s{'.,!?;:' if keep_punctuation else ''}]", _OTHER)
    x = F.regexp_replace(x, f"oun(?![{VOWELS}])", _OUN)
    for run, mark in (("ann", _ANN), ("enn", _ENN), ("onn", _ONN)):
        x = F.replace(x, F.lit(run), F.lit(mark))
    x = F.regexp_replace(x, f"([aeo])n(?![{VOWELS}ny{_OUN}{_ANN}{_ENN}{_ONN}])", f"$1{_NASAL}")
    for run, mark in (("ou", _OU), ("ui", _UI), ("ch", _CH), ("ny", _NY), ("x", _X)):
        x = F.replace(x, F.lit(run), F.lit(mark))
    single = {k: v for k, v in PHONEMES.items() if len(k) == len(v) == 1 and k != v} | {_OU: PHONEMES["ou"], _CH: PHONEMES["ch"], _NY: PHONEMES["ny"]} | dict.fromkeys("\t\n\v\f\r", " ")
    x = F.translate(x, "".join(single) + _OTHER, "".join(single.values()))
    for mark, run in ((_OUN, "oun"), (_ANN, "ann"), (_ENN, "enn"), (_ONN, "onn"), (f"a{_NASAL}", "an"), (f"e{_NASAL}", "en"), (f"o{_NASAL}", "on"), (_UI, "ui"), (_X, "x")):
        x = F.replace(x, F.lit(mark), F.lit(PHONEMES[run]))
    return F.trim(F.regexp_replace(x, "  +", " "))


def spoken_words(df: DataFrame, text: str, *keys: str, keep_punctuation: bool = True) -> DataFrame:
    """(keys, phonemes, n): what is said in all texts of a group, with its number of occurrences.

    Each distinct token of a group is put into phonemes once, after the count, which Spark sums
    before it shuffles; so a frequent word costs as much as a rare one.
    """
    counted = df.select(*keys, F.explode(tokens(F.col(text))).alias("token")).where(~F.col("token").rlike(r"^\s")).groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, token_phonemes(F.col("token"), keep_punctuation).alias("phonemes"), "n")


def phoneme_count(said: Column) -> Column:
    return F.length(F.replace(said, F.lit(" "), F.lit("")))
