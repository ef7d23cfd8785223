from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from postlens.llm import token_files

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_new_words_go_to_the_library_once_and_in_their_order(monkeypatch):
    encoder, sent = token_files.WordEncoder(PLAIN.to_str(), "<u2"), []
    batch = encoder.batch
    monkeypatch.setattr(encoder, "batch", lambda texts: sent.extend(texts) or batch(texts))
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    text = " ".join(["first", *words, *(f"{w}," for w in words), "stem!", "\nline", "\nstem!"]).replace(" \n", "\n")
    for _ in range(2):  # the second time all are cached
        (got,) = encoder.encode_all(pa.array([text]))
        assert np.frombuffer(got, "<u2").tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    lines = " ".join(sent).split()
    assert lines == ["first", *words, "line", "stem", "stem"]


def test_words_of_a_dictionary_come_back():
    for words in ([], [""], ["", "a"], ["a", "", "é\n", "\x00", "b"]):
        assert token_files._split_again(pa.array(words, pa.string())) == words
    assert token_files._split_again(pa.array(["a", "b", "c", "d"])[1:3]) == ["b", "c"]
