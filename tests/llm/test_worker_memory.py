"""Memory that Python workers hold between stages."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers

from reelstats.llm import arrowtext as at
from reelstats.llm import tokens


def test_a_forgotten_tokenizer_is_loaded_again():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = pa.array(["some words here", None, "more words"])
    before = tokens.Encoder(path).batch(texts)
    name = f"tokenizer {path} False"
    assert at.process_cache(name)
    at.forget()
    assert not at.process_cache(name)
    after = tokens.Encoder(path).batch(texts)
    assert before[0].tolist() == after[0].tolist() and before[1].tolist() == after[1].tolist()
