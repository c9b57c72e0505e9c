"""Words a worker has met are kept from one run of texts to the next."""

from __future__ import annotations

import public_tokenizers

from lotseries.llm import packing


def test_some_hundred_thousand_words_are_kept_between_runs():
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    words.known.update({f"#{i}": b"" for i in range(400_000)})
    plain = list(words.encode(["two words"]))
    assert len(words.known) > 400_000
    assert plain == [b"".join(words.whole(["two", "words"]))]
