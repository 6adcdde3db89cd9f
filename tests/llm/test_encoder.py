"""The encoder against the tokenizer at once, on words that the cutting of parts might get wrong."""

import struct

import public_tokenizers
import pytest

from rainfold.llm import packing

ODD = [
    "a\xa0b c\x85d", "x\x1cy z\x00q", "É́ É test", "<|startoftext|> hi", "abc<|endoftext|>", "½ ²x 3rd don't I'LL it's'll''s", "İstanbul ΣΑΣ Ǆ",
    "\U0001f600 ok", "ß ẞ ǅ ŉ", "", None, " \n\t", "a\nb", "'''s 's't", "foo_bar-12.5%", "  x y",
]


@pytest.mark.parametrize("words", [10, 1_000_000])
def test_encoder_is_the_tokenizer(monkeypatch, words):
    monkeypatch.setattr(packing, "WORDS", words)
    monkeypatch.setattr(packing, "_MEMORY", {})
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    for some in (ODD, ODD[::-1], [" ".join(t or "" for t in ODD if "<|" not in (t or ""))]):
        want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encoder.tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)]
        assert list(encoder.encode(some)) == want
