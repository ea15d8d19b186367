"""What the byte-pair walk tries for a word, and what its cache keeps."""

from chunkwright.llm import bpe


def test_only_lengths_that_can_end_there_are_tried():
    own, plain = bpe.Bpe(bpe.vocabulary_path()), bpe.Bpe(bpe.vocabulary_path())

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    own.ids = Counted(own.ids)
    words = [b" zqxjkvwy" * 12, b" lichkeitungzst" * 9, bytes(range(256)), b"a", b"ab", b"=" * 500]
    found = own.encode_words(words)
    assert own.ids.asked < 10 * sum(map(len, words))
    for word, tokens in found.items():
        assert b"".join(plain.bytes[t] for t in tokens) == word
        assert all(plain.compatible(a, b) for a, b in zip(tokens, tokens[1:]))


def test_a_full_cache_keeps_the_words_at_hand(monkeypatch):
    """And the ids are those of an empty cache."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    own, asked = bpe.Bpe(bpe.vocabulary_path()), []
    real = own.encode_words
    own.encode_words = lambda words: real(asked.append(set(words)) or asked[-1])
    texts = [[f"the corpus of w{i} x{i} y{i} z{i}"] for i in range(12)]
    got = [own.encode_texts(t)[0].tolist() for t in texts]
    assert got == [bpe.Bpe(bpe.vocabulary_path()).encode_texts(t)[0].tolist() for t in texts]
    assert sum(b" corpus" in words for words in asked) == 1
    assert len(own.cache) <= 20 + len(own.special)
