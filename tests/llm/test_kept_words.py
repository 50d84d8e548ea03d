"""What a worker keeps of the words it has seen."""

import public_tokenizers

from salvor.llm import packing


def test_frequent_words_stay_and_rare_ones_go(monkeypatch):
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), kept_words=10)
    first, calls = words.text("the"), []
    encode = words.fast.encode_ordinary
    monkeypatch.setattr(words, "fast", type("Fast", (), {"encode_ordinary": staticmethod(lambda text: calls.append(text) or encode(text))}))
    for i in range(100):
        rare = "x" + chr(97 + i // 26) + chr(97 + i % 26)
        assert words.text(f"{rare} the") == words.text(rare) + first
        assert len(words) + len(words.before) <= 20
    assert not [c for c in calls if c.startswith("the")]
