"""Words taken from columns of texts, against Python's own split."""

import random

import pyarrow as pa

from hourgrid.llm import common, pseudo_likelihood


def test_distinct_words_are_those_of_the_texts(monkeypatch):
    monkeypatch.setattr(common, "BYTES", 200)
    dice = random.Random(3)
    texts = [
        None if dice.random() < 0.05 else
        "".join(dice.choice("abcAB é\t\n\x0b\x0c\r\x1c\x85 \xa0É") for _ in range(dice.choice([0, 1, 2, 10, 300])))
        for _ in range(1000)
    ]
    near = [b"a", b"b", b"ab", "é".encode(), *(b"x%d" % i for i in range(1000)), b"ba"]
    words, at, slices = pseudo_likelihood.Words(near, pseudo_likelihood.Shape()), 3, 0
    for some in common.runs(pa.array(texts, pa.string()).slice(3)):
        distinct, place, ends = pseudo_likelihood.lower_words(some)
        own = distinct.cast(pa.binary()).to_pylist()
        assert words.codes(distinct).tolist() == [words[word] for word in own]
        for start, end in zip(ends, ends[1:]):
            assert [own[i] for i in place[start:end]] == (texts[at] or "").encode().lower().split()
            at += 1
        slices += 1
    assert at == len(texts) and slices > 20
    assert list(common.runs(pa.array([], pa.string()))) == []


def test_counts_of_words_in_several_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(f"A b{i % 5}  c\tb{i % 3} ",) for i in range(60)] + [("",), (None,)], "text string")
    counts = {bytes(r.word): r.n for r in pseudo_likelihood.word_counts(docs.coalesce(1), "text").collect()}
    assert counts == {b"a": 60, b"c": 60, b"b0": 32, b"b1": 32, b"b2": 32, b"b3": 12, b"b4": 12}
