"""Pre-tokens merged by the tokenizer's model have the ids that the whole tokenizer gives them."""

import numpy as np
from tokenizers import Tokenizer

from weftline.llm import packing
from weftline.llm.queries import tokenizer


def test_every_letter_and_byte():
    whole = Tokenizer.from_file(tokenizer())
    low = [chr(c) for c in range(0x340)]
    texts = ["".join(low), " ".join(low), "\n".join(low), "".join(f"{c}{c} x{c}y  {c}" for c in low), "it's 'S 'll'd we've'x'", "  a \t\n b\r\n\r\nc  ", " " * 40 + "z", "x" * 5000, ""]
    plain = [all(b < packing.FAST_BYTES for b in t.encode()) for t in texts]
    assert sum(plain) >= 5
    for _ in range(2):  # new words, then known ones
        got = [np.frombuffer(x, "<u4").tolist() for x in packing.encode(tokenizer(), texts, plain)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    words = [c + d for c in low for d in ("", "a", "12", " ")] + [f" {c}" for c in low]
    known = packing._Words()
    packing._learn(whole.model, known, words)
    spelled = lambda w: w.encode().decode("latin-1").translate(packing._BYTES)
    vocabulary = {i: t for t, i in whole.get_vocab().items()}
    for word in words:
        assert "".join(vocabulary[i] for i in np.frombuffer(known.young[word], "<u4").tolist()) == spelled(word)
