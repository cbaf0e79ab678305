"""Words encoded together give what the tokenizers library gives, text by text."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from bazaar.llm import bpe

PARTS = ["the", "Word", "word,", "don't", "  ", "\n\n", "\t", "\x1c", " ", "é", "straße", "漢字", "😀", "12345", "...!?", "_x_", "<|endoftext|>",
         "a" * 70, "ab" * 150, "Ω≈ç√", "\x85", "(see", "e.g.", "'ll", "​", "́", "½", "thaterororenble", "word%%%", "eau***,", "end.)\"", "Wort$$$", "a_b", "x'", "y's.", "z'll,", "été!"]


def test_equal_to_the_library_over_batches():
    rng = random.Random(4)
    texts = ["", " ", "<|endoftext|>", "a"] + [
        "".join(rng.choice(PARTS) + rng.choice([" ", "", "\n", " "]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    lib = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    lib.no_padding()
    lib.no_truncation()
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    encoder = bpe.ByteBpe(bpe.read_spec())
    encoder.chunks.half = 40                # the memo turns over many times
    for size in (1, 7, 300):
        got = [parts for at in range(0, len(texts), size) for parts in encoder.parts(texts[at:at + size])]
        assert [[int(i) for p in parts for i in p[0].split(",")] for parts in got] == want
        assert [sum(p[2] for p in parts) for parts in got] == [len(w) for w in want]
        assert ["".join(p[1] for p in parts) for parts in got] == [lib.decode(w, skip_special_tokens=False) for w in want]
