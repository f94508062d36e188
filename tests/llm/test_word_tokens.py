"""Token ids of words, remembered and made of their parts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from hourgrid.llm import packing
from hourgrid.llm.queries import WORDS


def test_words_of_late_are_remembered(monkeypatch):
    """However many words come, a frequent one is tokenised once and the memory stays small."""
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    tokens, seen = packing.WordTokens(WORDS), []
    encode = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda tokenizer, words: seen.extend(words) or encode(tokenizer, words))
    for n in range(40):
        tokens.ids([" ".join(["often", *(f"wа{n}x{i}" for i in range(20))]).encode()])
        assert len(tokens.known) + len(tokens.older) <= 80
    assert seen.count("often") == 1 and len(seen) == 801


def test_plain_words_need_their_parts_alone(monkeypatch):
    """Texts of all kinds of characters against the whole tokenizer."""
    monkeypatch.setattr(packing, "REMEMBERED", 300)
    dice = random.Random(1)
    kinds = [
        "abcdefgstrvmld'`~!@[]{}|<>^_\\\"-.,;:0123456789", "àéèöøÿñßÀÉ÷×ÅÆªº½²¼µ", "ABCKSTÅ",
        "\x00\x01\x1c\x1f\x7f\x80\x85\xa0­̀́​İΣσς日ʼ", " \t\n\x0b\x0c\r  ",
    ]
    texts = ["<|endoftext|>", "a<|endoftext|>b <|x", "'s't're've'm'll'd don't' x'S", "  ", ""]
    for n in range(1500):
        weights = [(6, 0, 0, 0, 1), (6, 2, 0, 0, 1), (6, 2, 1, 1, 1), (1, 1, 1, 1, 1)][n % 4]
        texts.append("".join(dice.choice(dice.choices(kinds, weights)[0]) for _ in range(dice.choice([1, 3, 20, 60]))))
    tokens, whole = packing.WordTokens(WORDS), packing.tokenizer_at(WORDS)
    for at in range(0, len(texts), 50):
        some = texts[at:at + 50]
        found = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.ids([text.encode() for text in some])]
        assert found == [whole.encode(text, add_special_tokens=False).ids for text in some]

    seen = []
    monkeypatch.setattr(tokens, "_encode", lambda tokenizer, words: seen.append((tokenizer, words)) or [b""] * len(words))
    tokens.ids(["(naïveté) naïveté, Naïveté".encode()])
    assert [words for tokenizer, words in seen if tokenizer is whole] == [[]]
    assert sorted(words for tokenizer, words in seen if tokenizer is not whole for words in words) == ["(", ")", ",", "naïveté"]


def test_remembered_words_take_little_memory():
    """So that two workers and their JVM stay below an executor's limit after other stages."""
    dice = random.Random(2)
    words = list({"".join(dice.choices("abcdefghij", k=dice.randint(5, 9))) + "," for _ in range(60_000)})
    tokens = packing.WordTokens(WORDS)
    tokens.ids([b"first"])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    try:
        for at in range(0, len(words), 10_000):
            tokens.ids([" ".join(words[at:at + 10_000]).encode()])
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert len(tokens.known) + len(tokens.older) > 50_000
    assert held < 60 * len(words)


def test_long_words_are_remembered_up_to_their_bytes(monkeypatch):
    """Words of any length, and more of them at once than are remembered, get their own ids."""
    limit = 200_000
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", limit, raising=False)
    tokens, whole = packing.WordTokens(WORDS), packing.tokenizer_at(WORDS)
    for n in range(30):
        text = " ".join(["often", *(f"{chr(97 + i)}{n}" + "xy" * 300 for i in range(60 if n == 7 else 10))])
        found = np.frombuffer(tokens.ids([text.encode()])[0], "<u4").tolist()
        assert found == whole.encode(text, add_special_tokens=False).ids
        assert tokens.known.nbytes + tokens.older.nbytes <= limit * 3 // 2
