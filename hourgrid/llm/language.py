"""Language identification by unigrams over the pieces of a public vocabulary, with the
probability of a text summed over all its segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored

#: Texts per language that the model is fitted on, about: those whose hash falls under this
#: share of its labelled texts. A documented bound, as labelled rows may be many.
FIT_TEXTS = 2_000
#: Rounds of expectation and maximisation.
ROUNDS = 3
#: Added to the expected count of every piece.
SMOOTHING = 0.05
#: Probability of a character that is no piece.
UNKNOWN = 1e-7
#: Longer runs of letters are cut, so that sums stay far from the least double.
LONGEST = 32
#: Words whose probabilities a task remembers.
REMEMBERED = 400_000
UNDETERMINED = "und"

WORDS = re.compile(r"[^\W\d_]+")
START = "▁"  # the vocabulary's mark of a word's start
_BASE = np.uint64(1_000_003)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. (The pattern lets some numerals pass: see `letters`.)"""
    return WORDS.findall(text.lower()) if text else []


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _hash(points: np.ndarray) -> np.ndarray:
    value = np.zeros(len(points), dtype=np.uint64)
    for column in points.T:
        value = value * _BASE + column.astype(np.uint64) + np.uint64(1)
    return value


class Pieces:
    """The pieces of a vocabulary, found by hash. Lower case only, as words are."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [
            model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.pieces = sorted(p for p in own if letters(p.removeprefix(START)) == p.removeprefix(START) and p == p.lower())
        self.longest = max(map(len, self.pieces))
        hashes = np.array([_hash(np.array([[ord(c) for c in p]]))[0] for p in self.pieces])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def spans(self, words: list[str]) -> Iterator[tuple[np.ndarray, list[list[np.ndarray]]]]:
        """Words of one length together: which they are, and by end and then by length the
        pieces that end there (-1: none)."""
        marked = [START + w for w in words]
        lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        for length in np.unique(lengths):
            rows = np.nonzero(lengths == length)[0]
            joined = "".join(marked[i] for i in rows)
            points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").reshape(len(rows), length)
            found: list[list] = [[None] * (min(end, self.longest) + 1) for end in range(length + 1)]
            for start in range(length):
                value = np.zeros(len(rows), dtype=np.uint64)
                for end in range(start + 1, min(length, start + self.longest) + 1):
                    value = value * _BASE + points[:, end - 1].astype(np.uint64) + np.uint64(1)
                    found[end][end - start] = self.find(value)
            yield rows, found


@cache
def pieces_at(path: str) -> Pieces:
    return Pieces(path)


def cut(word: str) -> list[str]:
    word = letters(word)
    return [word[i:i + LONGEST] for i in range(0, len(word), LONGEST)]


def _forward(found: list, chances: np.ndarray, rows: int) -> list[np.ndarray]:
    """Probability of each beginning of the words, by language, over all segmentations.
    ``chances`` has a row per piece, the last for what is no piece."""
    sums = [np.ones((rows, chances.shape[1]))]
    for end in range(1, len(found)):
        total = np.zeros_like(sums[0])
        for length in range(1, len(found[end])):
            piece = found[end][length]
            known = piece if length > 1 else np.where(piece < 0, len(chances) - 1, piece)
            some = np.nonzero(known >= 0)[0]
            if len(some):
                total[some] += sums[end - length][some] * chances[known[some]]
        sums.append(total)
    return sums


def word_scores(words: list[str], pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """Log-probability of each word by language; 0 for one without letters."""
    parts = [part for word in words for part in cut(word)]
    of = np.repeat(np.arange(len(words)), [len(cut(word)) for word in words])
    scores = np.zeros((len(words), chances.shape[1]))
    if parts:
        own = np.empty((len(parts), chances.shape[1]))
        for rows, found in pieces.spans(parts):
            own[rows] = np.log(_forward(found, chances, len(rows))[-1])
        np.add.at(scores, of, own)
    return scores


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words of one language, over all segmentations."""
    counts = np.zeros(len(pieces.pieces))
    for rows, found in pieces.spans(words):
        before = _forward(found, chances, len(rows))
        size = len(found) - 1
        after = [None] * size + [np.ones((len(rows), 1))]
        for start in range(size - 1, -1, -1):
            total = np.zeros((len(rows), 1))
            for length in range(1, min(pieces.longest, size - start) + 1):
                piece = found[start + length][length]
                known = piece if length > 1 else np.where(piece < 0, len(chances) - 1, piece)
                some = np.nonzero(known >= 0)[0]
                total[some] += after[start + length][some] * chances[known[some]]
            after[start] = total
        weight = times[rows][:, None] / before[size]
        for end in range(1, size + 1):
            for length in range(1, len(found[end])):
                piece = found[end][length]
                some = np.nonzero(piece >= 0)[0]
                if len(some):
                    share = (before[end - length] * after[end] * weight)[some, 0] * chances[piece[some], 0]
                    counts += np.bincount(piece[some], weights=share, minlength=len(counts))
    return counts


def _word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, times`` over the texts, counted in the tasks first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(p for w in words_of(text) for p in cut(w))
            flat = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
            if flat:
                lang, word, times = zip(*flat)
                yield pa.RecordBatch.from_pydict(
                    {"lang": lang, "word": word, "times": times},
                    schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("times", pa.int64())]),
                )

    counted = rows.select("lang", "text").mapInArrow(work, "lang string, word string, times bigint")
    return counted.groupBy("lang", "word").agg(F.sum("times").alias("times"))


def fit(rows: DataFrame, vocabulary: str) -> tuple[list[str], np.ndarray]:
    """Languages of the labelled ``rows`` (id, lang, text) and, by piece and language, the
    probabilities; the last row is for what is no piece.

    Fitted on about ``FIT_TEXTS`` texts per language. The driver holds one number per piece
    and language.
    """
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, 0))
    # one literal, however many languages, so that texts need no join
    shares = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, FIT_TEXTS / sizes[lang]))])
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    words = stored(_word_counts(rows.filter(place < F.element_at(shares, F.col("lang")))))
    pieces = pieces_at(vocabulary)
    chances = np.full((len(pieces.pieces) + 1, len(langs)), 1.0 / len(pieces.pieces))
    for _ in range(ROUNDS):
        chances[-1] = UNKNOWN
        model = words.sparkSession.sparkContext.broadcast(chances)

        def work(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            forget()
            own = pieces_at(vocabulary)
            for batch in batches:
                lang = np.array(batch.column("lang").to_pylist())
                word = np.array(batch.column("word").to_pylist(), dtype=object)
                times = batch.column("times").to_numpy(zero_copy_only=False)
                for number, name in enumerate(langs):
                    rows = lang == name
                    if rows.any():
                        counts = expected_counts(
                            word[rows].tolist(), times[rows], own, model.value[:, number:number + 1]
                        )
                        some = np.nonzero(counts)[0]
                        yield pa.RecordBatch.from_pydict({
                            "lang": pa.array(np.full(len(some), number)), "piece": pa.array(some),
                            "times": pa.array(counts[some]),
                        })

        sums = (
            words.mapInArrow(work, "lang bigint, piece bigint, times double")
            .groupBy("lang", "piece").agg(F.sum("times").alias("times")).toPandas()
        )
        counts = np.full((len(pieces.pieces), len(langs)), SMOOTHING)
        counts[sums["piece"].to_numpy(), sums["lang"].to_numpy()] += sums["times"].to_numpy()
        chances = np.vstack([counts / counts.sum(axis=0), np.full((1, len(langs)), UNKNOWN)])
    return langs, chances


def identify_language(
    docs: DataFrame, *, vocabulary: str, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Language of every text, by a model learned from the labelled ones.

    Learns from text and non-null lang of the documents whose crc32(id as text) mod 3 is not
    1; the others (``held_out``) play no part in it. A text's words are runs of letters,
    lower-cased. Each language has a probability for every piece of ``vocabulary`` (a
    sentencepiece model); the probability of a word is the sum over all ways to cut it into
    pieces, found by the forward algorithm, and the text's is their product. Adds to the
    columns of ``docs``: ``held_out``, ``lang_pred`` (the language of the largest
    probability, all being as likely before) and ``score``, its share of the sum over the
    languages.

    A text that is null or has no letter gets ``und`` and score 0, as does every text if
    nothing is labelled. Columns of these three names are replaced. A null id is not held out. Ties go to the first language by code
    point. An empty table gives no rows.
    """
    remainder = F.crc32(F.col(id).cast("string").cast("binary")) % 3
    held = F.coalesce(remainder == 1, F.lit(False))
    labelled = docs.filter(~held & F.col(lang).isNotNull()).select(
        F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    langs, chances = fit(labelled, vocabulary)
    model = docs.sparkSession.sparkContext.broadcast(chances)
    rows = docs.withColumn("held_out", held).drop("lang_pred", "score")
    place = rows.columns.index(text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        pieces = pieces_at(vocabulary) if langs else None
        known: dict[str, int] = {}
        scores, has_letters = np.zeros((0, len(langs))), np.zeros(0, dtype=bool)
        for batch in batches:
            names, shares = [], []
            for at in range(0, batch.num_rows, 256):  # so many texts' words at once
                texts = [words_of(t) for t in batch.column(place).slice(at, 256).to_pylist()]
                if not langs:
                    texts = [[] for _ in texts]
                new = list(dict.fromkeys(w for words in texts for w in words if w not in known))
                if len(known) + len(new) > REMEMBERED and known:
                    known, scores, has_letters = {}, scores[:0], has_letters[:0]
                    new = list(dict.fromkeys(w for words in texts for w in words))
                if new:
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                    scores = np.concatenate([scores, word_scores(new, pieces, model.value)])
                    has_letters = np.concatenate([has_letters, [bool(letters(w)) for w in new]])
                for words in texts:
                    rows = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                    if not len(rows) or not has_letters[rows].any():
                        names.append(UNDETERMINED)
                        shares.append(0.0)
                        continue
                    total = scores[rows].sum(axis=0)
                    best = int(total.argmax())
                    names.append(langs[best])
                    shares.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(shares, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return rows.mapInArrow(work, f"{kinds}, lang_pred string, score double")
