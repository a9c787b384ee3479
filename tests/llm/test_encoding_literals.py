import pytest
from tokenizers import Tokenizer

from lambi.llm.encoding import encoder, public_path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_literals_of_added_tokens_equal_a_fresh_tokenizer(name):
    """Ids are those of the library, that file and add_special_tokens=False, on a tokenizer that the encoder didn't set up."""
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|> x <|endoftext|>", "<|endoftext|>\n", "x <|ENDOFTEXT|> y", "<|endof text|>", "plain words only"]
    fresh = Tokenizer.from_file(public_path(name))
    enc = encoder(public_path(name))
    assert enc.encode(texts) == [enc.pack(fresh.encode(x, add_special_tokens=False).ids) for x in texts]
