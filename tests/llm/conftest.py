import pytest

import public_tokenizers


@pytest.fixture(scope="session")
def tokenizer_file():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(tokenizer_file):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file)


@pytest.fixture(scope="session")
def hard_texts():
    """Texts with white-space runs, contractions, special strings, other scripts."""
    import random
    rng = random.Random(5)
    alphabet = list(" \n\t 'sltrevmd<|> aé　\x85\xa0\x1c12½!?*…漢字😀Abc.,") + ["<|endoftext|>", "  ", "'re", "word", ".\n"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return made + ["", " ", "   ", "a   b\n\n c \n", "<|endoftext|>", "a<|endoftext|>b<|endoftext|><|endof",
                   "x" * 3000, "ab" * 700 + " ", "We'll say you're I've\n \n 'tis"]
