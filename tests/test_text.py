import pytest
from pyspark.sql import functions as F

from lambi.functions import phonemes as ph
from lambi.functions import textnorm as tn


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("m’ap vini", "m'ap vini"), ("è", "è"), ("a [noise] b (inaudible) c", "a b c"), ("wi , non !", "wi, non!"), ("a b​c", "a bc"), ("“wi” – non", '"wi" - non'), (None, ""), ("[music]", ""), ("a\x07b\t\n c", "a b c"), ("(yon non)", "(yon non)")],
)
def test_normalize(spark, raw, want):
    assert one(spark, raw, tn.normalize) == want


def test_charset_and_style(spark):
    assert sorted(one(spark, "ab漢漢ñ c", tn.out_of_charset)) == ["ñ", "漢"]
    assert one(spark, "", tn.out_of_charset) == []
    assert one(spark, "abÈ", tn.is_cased) and not one(spark, "abc", tn.is_cased) and one(spark, "a?", tn.is_punctuated)


def test_sanitize(spark):
    clean = lambda x: tn.sanitize(x, "abcdefghijklmnopqrstuvwxyz.,?!'-")
    assert one(spark, "a: b/c (d) 漢…", clean) == "a, b c d ..."
    assert one(spark, "", clean) == ""


@pytest.mark.parametrize(("n", "words"), [(0, "zewo"), (17, "disèt"), (21, "venteyen"), (22, "vennde"), (71, "swasannonz"), (80, "katreven"), (81, "katreven en"), (95, "katrevenkenz"), (100, "san"), (250, "desan senkant"), (1000, "mil"), (2001, "de mil en"), (-5, "mwens senk"), (999999, "nèfsan katrevendiznèf mil nèfsan katrevendiznèf"), (1000000, None)])
def test_number_words(spark, n, words):
    assert one(spark, n, ph.number_words, "long") == words


@pytest.mark.parametrize(("raw", "want"), [("mwen gen 1,250", "mwen gen mil desan senkant"), ("1.5", "en vigil senk"), ("$5", " dola senk"), ("kat USD 3", "kat  dola  twa"), ("HTG 20", " goud  ven"), ("1.05", "en vigil zewo senk"), ("12 500", "douz mil senksan"), ("1000000", "en zewo zewo zewo zewo zewo zewo"), ("non", "non")])
def test_expand_numbers(spark, raw, want):
    assert one(spark, raw, ph.expand_numbers) == want


@pytest.mark.parametrize(("word", "want"), [("kreyòl", "kɣejɔl"), ("moun", "mũ"), ("ann", "an"), ("manman", "mɑ̃mɑ̃"), ("ayiti", "ajiti"), ("chat", "ʃat"), ("benyen", "beɲɛ̃"), ("peny", "peɲ"), ("dlo", "dlo"), ("l'ap", "lap"), ("gwo", "ɡwo")])
def test_phonemes(spark, word, want):
    assert one(spark, word, ph.phonemes) == want


def test_phonemes_of_text(spark):
    assert one(spark, "Bonjou, 2  moun!", ph.phonemes) == "bɔ̃ʒu, de mũ!"
    assert one(spark, "wi, non.", lambda x: ph.phonemes(x, keep_punctuation=False)) == "wi nɔ̃"


@pytest.mark.parametrize("text", ["Yon fraz kout. " * 12, "yon, de, twa; kat: " * 20, "a" * 300, "", "mo " * 200, "x" * 130 + ". Wi. Non."])
def test_chunks_lose_nothing_and_are_packed(spark, text):
    got = one(spark, text, lambda x: tn.chunks(x, 120))
    assert all(0 < len(p) <= 120 for p in got)
    assert "".join("".join(got).split()) == "".join(text.split())
    assert all(len(a) + 1 + len(b) > 120 for a, b in zip(got, got[1:]))


def test_a_clause_that_must_be_wrapped_starts_a_line_of_its_own(spark):
    text = "Mwen ale. yon ti fraz, " + "mo " * 60 + "fini, epi lot. Wi."
    got = one(spark, text, lambda x: tn.chunks(x, 60))
    assert got[0] == "Mwen ale. yon ti fraz," and got[1].startswith("mo mo") and got[-1].endswith("Wi.")
    assert all(len(p) <= 60 for p in got) and " ".join(got).split() == text.split()
    assert one(spark, "ab, " + "c" * 25 + " d, e.", lambda x: tn.chunks(x, 10)) == ["ab,", "c" * 10, "c" * 10, "ccccc d,", "e."]


def test_composed_texts_reach_the_arrow_function_as_nulls(spark):
    df = spark.createDataFrame([("e\u0301a",), ("“é” — 漢",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(tn.nfc(F.col("x"))).collect()] == ["éa", "“é” — 漢", None, ""]
    sent = df.where(F.col("x").rlike(f"[^{tn.COMPOSED}]")).collect()
    assert [r[0] for r in sent] == ["e\u0301a"]


def test_sanitize_maps_to_characters_that_are_not_encodable(spark):
    f = lambda x: tn.sanitize(x, "ab", {"c": "xy", "d": "z", "e": ""})
    assert one(spark, "a c\tdz x\u00a0eb", f) == "a xy z b"
    assert one(spark, None, f) is None
    assert one(spark, "a:ñb", lambda x: tn.unencodable(x, "ab")) == [":", "ñ"]


def test_scoring_form_and_tags(spark):
    assert one(spark, "Bonjou, <fr-FR> «Wi»!", tn.scoring_form) == "bonjou wi"
    assert one(spark, "a <fr-FR> b <ht>", tn.language_tags) == ["<fr-FR>", "<ht>"]
    assert one(spark, None, tn.language_tags) == []
