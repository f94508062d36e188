"""What a Python worker remembers from one operator to the next."""

import pytest

from hourgrid.llm import common, language, packing, simhash
from hourgrid.llm.queries import PIECES, WORDS


@pytest.fixture(autouse=True)
def nothing_kept():
    common.forget()
    yield
    common.forget()


def test_one_use_is_remembered_at_a_time():
    tokens = packing.word_tokens(WORDS)
    assert packing.word_tokens(WORDS) is tokens and list(common._KEPT.values()) == [tokens]
    assert common.kept("another", list) == [] and list(common._KEPT) == ["another"]


def test_other_operators_let_go_of_words(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, "en" if i % 2 else "fr", f"the cat {i}" if i % 2 else f"le chat {i}") for i in range(12)],
        "doc_id long, lang string, text string",
    )
    works, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(
        type(docs), "mapInArrow", lambda self, work, *rest: works.append(work) or plain(self, work, *rest)
    )
    simhash.simhash(docs)
    language.identify_language(docs, vocabulary=PIECES)
    assert len(works) == 3 + language.ROUNDS
    for work in works:
        packing.word_tokens(WORDS)
        list(work(iter([])))
        assert not common._KEPT
