import random

import pytest
from tokenizers import Tokenizer

from lambi.llm.encoding import Encoder, public_path


class Counted(Encoder):
    """Counts the pre-tokens that the library merges."""

    def __init__(self, *args):
        self.merged = []
        super().__init__(*args)
        self.merged.clear()

    def _pretoken(self, text):
        self.merged.append(text)
        return super()._pretoken(text)


def test_spellings_of_a_word_are_merged_once():
    enc = Counted(public_path("word_bpe_49k.json"))
    texts = ["Heon heon, HEON. heon\nHeon!?\theon;heon", "\nheon -- Heon\r\n  HEON"]
    fresh = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    assert enc.encode(texts) == [enc.pack(fresh.encode(x, add_special_tokens=False).ids) for x in texts]
    assert enc.merged == ["heon"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_in_use_outlive_rare_ones(name):
    enc = Counted(public_path(name), 64)
    rare = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(500)]
    for x in rare:
        enc.encode([f"x often {x}"])
        assert len(enc.words) + len(enc.words.before) <= 64 + 8
    assert len([x for x in enc.merged if x.endswith("often")]) == 1


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_odd_texts_equal_a_fresh_tokenizer(name):
    bits = ["a", "The", "Été", "ß", "'s", "'", "don't", "l'été", ".", ",", "...", "--", "<|", '"', "5", "a5", "É", "œuvre", "Œ", "İ", "ΟΔΟΣ", "́", "Å", "ª", "µ", "×", "漢字", "😀", "_", "`", "^", "’", "\x7f", "\x00", "\xad", "²", " ", " ", "\n", "\t", "\r\n", "  "]
    spaces = ["\x0b", "\x1c", "\x85", "\xa0", "　"]
    fresh, enc, dice = Tokenizer.from_file(public_path(name)), Encoder(public_path(name), 200), random.Random(3)
    latin = [x for x in bits if x.isascii() or max(x) <= "\xff"]
    for pool in (bits, latin, latin + spaces):
        texts = ["".join(dice.choices(pool, k=dice.randint(0, 14))) for _ in range(1500)]
        assert enc.encode(texts) == [enc.pack(fresh.encode(x, add_special_tokens=False).ids) for x in texts]
