import numpy as np
import pytest

from buildlens.llm.subwords import byte_bpe


def test_words_of_any_letters_have_the_ids_of_the_plain_call():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    encoder = byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a", " a", "Word another WORD", " naïve café Öl", "é", " é", "x  y", " ", "it's", "a\n b"]
    data = "".join(texts).encode()
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, at = encoder(np.frombuffer(data, np.uint8), off)
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
