"""Scores of texts by masked pseudo-likelihood.

A small network predicts a word from the words in a window on both sides. It knows a number
of tokens that grows with the words of the corpus: the most frequent words, and the others by
their last letters. So a word's probability is its token's, from the network, times the
word's share of all the words of that token. The counts of all words stay distributed and are
joined by word. The score of a text is the sum of the log-probabilities of its words, each
given its neighbours.

The network is trained in numpy. It starts from the tokens' counts, so that it knows the words
of the corpus before it knows what stands beside them, and then learns every word of all
documents once. The unit of learning is a shard of documents, dealt by a hash of their
content to about ``SHARD`` words each, however the rows are stored. Shards go on from the
same weights, and the weights of all are averaged by their words; that happens in waves, a
few shards first, each wave going on from the averages of the one before.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_words, runs, stored

#: Binary digits of the number of tokens in a small corpus. A token is a class and a place in
#: it, so that a prediction needs two small sums, not one over all tokens.
BITS = 10
#: Words seen on either side; numbers of a word's vector.
WINDOW, WIDTH = 2, 16
#: Of AdaGrad: the length of a first step, and the squares it starts from.
RATE, SQUARES = 0.15, 1e-8
#: Words in a step of learning, of a shard, and scored at once.
STEP, SHARD, AT_ONCE = 8_192, 1 << 18, 16_384
#: Of every sixteen shards, those of each wave.
WAVES = (range(0, 1), range(1, 4), range(4, 16))
#: Copies of a row, of those a task reads, that stay in one shard.
COPIES = 64
#: The most frequent words whose counts all tasks know: so many times the root of the number
#: of distinct words.
NEAR = 16
#: Distinct words that a task counts before it hands on their counts.
DISTINCT = 400_000
#: Numbers of the network that are added up in one piece.
PIECE = 1 << 14
SEED = 3

Weights = dict[str, np.ndarray]


class Shape:
    """Of a network with two to the power of ``bits`` tokens."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self.places = 1 << bits // 2
        self.classes = 1 << bits - bits // 2
        self.tokens = 1 << bits
        #: So many words, the most frequent, have tokens of their own.
        self.frequent = self.tokens * 3 // 4
        self.pad = self.tokens  # beyond the ends of a text
        self.sizes = {
            "inputs": (2 * WINDOW, self.tokens + 1, WIDTH), "bias": (WIDTH,),
            "classes": (WIDTH, self.classes), "class_bias": (self.classes,),
            "places": (self.classes, WIDTH, self.places), "place_bias": (self.classes, self.places),
        }

    @staticmethod
    def of_words(distinct: int) -> Shape:
        """Tokens grow as the fourth root of the distinct words."""
        return Shape(max(BITS, round(4.5 + np.log2(max(1, distinct)) / 4)))

    def first(self, counts: np.ndarray) -> Weights:
        """Weights that predict each token by its count, whatever stands beside it."""
        random = np.random.default_rng(SEED)
        weights = {
            name: (random.standard_normal(size) * (0.1 if name == "inputs" else 0)).astype(np.float32)
            for name, size in self.sizes.items()
        }
        chance = (counts + 0.5).reshape(self.classes, self.places)
        weights["class_bias"] = np.log(chance.sum(axis=1) / chance.sum()).astype(np.float32)
        weights["place_bias"] = np.log(chance / chance.sum(axis=1, keepdims=True)).astype(np.float32)
        return weights

    def packed(self, weights: Weights) -> np.ndarray:
        return np.concatenate([weights[name].ravel() for name in self.sizes])

    def unpacked(self, numbers: np.ndarray) -> Weights:
        weights, at = {}, 0
        for name, size in self.sizes.items():
            count = int(np.prod(size))
            weights[name] = numbers[at:at + count].reshape(size).astype(np.float32)
            at += count
        return weights


class Words(dict):
    """Codes of words, which are runs of anything but ASCII white space, A-Z lower-cased.

    The words whose counts are known here come first, in their order; the first of these
    have the tokens 0, 1, 2 and so on. Any other word shares a token with those whose last
    three bytes have the same hash.
    """

    def __init__(self, near: list[bytes], shape: Shape):
        super().__init__(zip(near, range(len(near))))
        self.near = pa.array(near, pa.binary())
        self.first, self.rest = shape.frequent, shape.tokens - shape.frequent
        own = min(len(near), shape.frequent)
        #: The token of each code.
        self.token = np.concatenate([
            np.arange(own, dtype=np.int32),
            np.array([self._shared(word) for word in near[own:]], dtype=np.int32),
            np.arange(shape.tokens, dtype=np.int32),
        ])

    def _shared(self, word: bytes) -> int:
        return self.first + zlib.crc32(word[-3:]) % self.rest

    def __missing__(self, word: bytes) -> int:
        return len(self.near) + self._shared(word)

    def codes(self, words: pa.Array) -> np.ndarray:
        """Of words, lower-cased; those that are not known here by their different endings."""
        words = words.cast(pa.binary())
        codes = pc.fill_null(pc.index_in(words, value_set=self.near), -1).to_numpy().copy()
        other = codes < 0
        endings = pc.binary_slice(words.filter(pa.array(other)), -3).dictionary_encode()
        shared = np.array([len(self.near) + self._shared(each) for each in endings.dictionary.to_pylist()], dtype=np.int32)
        codes[other] = shared[endings.indices.to_numpy()]
        return codes

    def tokens(self, texts: list[bytes]) -> list[np.ndarray]:
        distinct, place, ends = lower_words(pa.array(texts, pa.binary()).view(pa.string()))
        return np.split(self.token[self.codes(distinct)][place], ends[1:-1])


def lower_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts as `distinct_words` gives them, A-Z lower-cased."""
    return distinct_words(pc.ascii_lower(texts))


def windows(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours, token) of every word of the texts in turn."""
    gap = np.full(WINDOW, pad, dtype=np.int32)
    row = np.concatenate([x for text in texts for x in (gap, text)] + [gap])
    centre = np.nonzero(row != pad)[0]
    sides = [s for s in range(-WINDOW, WINDOW + 1) if s]
    return np.stack([row[centre + s] for s in sides], axis=1), row[centre]


def small(numbers: np.ndarray) -> np.dtype:
    """A type of few bytes, whose stable sort is by these."""
    return np.dtype(np.uint16 if not len(numbers) or numbers.max() < 1 << 16 else np.int32)


def exponentials(scores: np.ndarray) -> np.ndarray:
    """In place; returns the sum of each row. Scores are logarithms of shares plus a few, far
    from the bound that keeps their exponentials within the type."""
    np.clip(scores, -80, 80, out=scores)
    np.exp(scores, out=scores)
    return scores @ np.ones(scores.shape[1], dtype=scores.dtype)


def softmax(scores: np.ndarray) -> np.ndarray:
    """Of each row, in place."""
    scores /= exponentials(scores)[:, None]
    return scores


def log_softmax(scores: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Logarithms of the softmax at one column of each row. The scores are used up."""
    total = exponentials(scores)
    return np.log(scores[rows, columns] / total + 1e-30)


def _hidden(weights: Weights, near: np.ndarray) -> np.ndarray:
    total = np.broadcast_to(weights["bias"], (len(near), WIDTH)).copy()
    for side in range(near.shape[1]):
        total += weights["inputs"][side].take(near[:, side], axis=0)
    return np.tanh(total)


def log_probabilities(weights: Weights, near: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Of each token, given its neighbours."""
    classes, places = weights["place_bias"].shape
    out = np.zeros(len(token))
    for at in range(0, len(token), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        hidden = _hidden(weights, near[some])
        kind, place = np.divmod(token[some].astype(small(token)), small(token).type(places))
        rows = np.arange(len(kind))
        scores = hidden @ weights["classes"]
        scores += weights["class_bias"]
        log = log_softmax(scores, rows, kind)
        order = np.argsort(kind, kind="stable")
        ends = np.searchsorted(kind[order], np.arange(classes + 1))
        hidden = hidden.take(order, axis=0)  # by class, so that the words of each are a slice
        scores = np.empty((len(kind), places), dtype=hidden.dtype)
        for c in np.nonzero(np.diff(ends))[0]:
            own = scores[ends[c]:ends[c + 1]]
            np.matmul(hidden[ends[c]:ends[c + 1]], weights["places"][c], out=own)
            own += weights["place_bias"][c]
        log[order] += log_softmax(scores, rows, place[order])
        out[some] = log
    return out


class Learner:
    """Steps of AdaGrad on the weights of one shard."""

    def __init__(self, weights: Weights, squares: Weights | None = None):
        squares = squares or {name: np.full_like(value, SQUARES) for name, value in weights.items()}
        self.weights, self.squares = (
            {name: value.copy() for name, value in each.items()} for each in (weights, squares)
        )
        self.words = 0

    def step(self, near: np.ndarray, token: np.ndarray) -> None:
        w = self.weights
        classes, places = w["place_bias"].shape
        # by class, so that the words of each are a slice
        kind, place = np.divmod(token.astype(small(token)), small(token).type(places))
        order = np.argsort(kind, kind="stable")
        near, kind, place = near.take(order, axis=0), kind[order], place[order]
        hidden = _hidden(w, near)
        rows = np.arange(len(token))
        slope = {name: np.zeros_like(value) for name, value in w.items() if name != "inputs"}
        wrong = softmax(hidden @ w["classes"] + w["class_bias"])
        wrong[rows, kind] -= 1
        slope["classes"], slope["class_bias"] = hidden.T @ wrong, wrong.sum(axis=0)
        back = wrong @ w["classes"].T
        ends = np.searchsorted(kind, np.arange(classes + 1))
        own = [(c, slice(ends[c], ends[c + 1])) for c in np.nonzero(np.diff(ends))[0]]
        wrong = np.empty((len(token), places), dtype=hidden.dtype)
        for c, some in own:
            np.matmul(hidden[some], w["places"][c], out=wrong[some])
            wrong[some] += w["place_bias"][c]
        wrong = softmax(wrong)
        wrong[rows, place] -= 1
        for c, some in own:
            slope["places"][c] = hidden[some].T @ wrong[some]
            back[some] += wrong[some] @ w["places"][c].T
        slope["place_bias"][kind[ends[:-1][np.diff(ends) > 0]]] = np.add.reduceat(
            wrong, ends[:-1][np.diff(ends) > 0], axis=0
        )
        back *= 1 - hidden * hidden
        slope["bias"] = back.sum(axis=0)
        for name, value in slope.items():
            self._move(w[name], self.squares[name], ..., value / len(token))
        for side in range(near.shape[1]):
            beside = near[:, side].astype(small(near))
            order = np.argsort(beside, kind="stable")
            beside = beside[order]
            first = np.concatenate([[0], np.nonzero(beside[1:] != beside[:-1])[0] + 1])
            value = np.add.reduceat(back.take(order, axis=0), first, axis=0) / len(token)
            self._move(w["inputs"][side], self.squares["inputs"][side], beside[first], value)
        self.words += len(token)

    @staticmethod
    def _move(weights: np.ndarray, squares: np.ndarray, at, slope: np.ndarray) -> None:
        squares[at] += slope * slope
        weights[at] -= RATE * slope / np.sqrt(squares[at])


def learn(learner: Learner, texts: Iterable[np.ndarray], random: np.random.Generator, pad: int) -> None:
    """One pass: every token of the texts is predicted once, in steps of words of several texts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    some: list[np.ndarray] = []

    def go(whole: bool) -> None:
        if some:
            held.append(windows(some, pad))
            some.clear()
        near, token = (np.concatenate(x) for x in zip(*held))
        mixed = random.permutation(len(token))
        near, token = near.take(mixed, axis=0), token[mixed]
        upto = len(token) if whole else len(token) // STEP * STEP
        for at in range(0, upto, STEP):
            learner.step(near[at:at + STEP], token[at:at + STEP])
        held[:] = [(near[upto:], token[upto:])]

    for text in texts:
        some.append(text)
        if sum(map(len, some)) >= 16 * STEP if len(some) % 64 == 0 else len(text) >= STEP:
            go(False)
    if some or held:
        go(True)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word, n``: how often every word stands in all documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def added() -> Iterator[pa.RecordBatch]:
            if held:
                sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
                held.clear()
                yield from sums.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()

        for batch in batches:
            for texts in runs(batch.column(0)):
                distinct, place, _ = lower_words(texts)
                times = np.bincount(place, minlength=len(distinct))[:len(distinct)]
                held.append(pa.table({"word": distinct.cast(pa.binary()), "n": pa.array(times, pa.int64())}).filter(pc.field("n") > 0))
                if sum(map(len, held)) > DISTINCT:
                    yield from added()
        yield from added()

    counted = docs.select(F.col(text).cast("string")).mapInArrow(work, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Corpus:
    """What the driver knows of the words: the shape of the network, the most frequent words,
    by count and then bytes, with their counts, and of each token how often it stands. Their
    number grows as a root of that of the distinct words; the table of all words stays
    distributed."""

    def __init__(self, counts: DataFrame):
        size = counts.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        self.words, self.shape = size.words, Shape.of_words(size.distinct)
        self.near = self._most(counts, int(NEAR * size.distinct**0.5))
        if len(self.near) < self.shape.frequent:
            most = counts.orderBy(F.desc("n"), "word").limit(self.shape.frequent)
            self.near = {bytes(row.word): row.n for row in most.collect()}
        self.frequent = list(self.near)[:self.shape.frequent]
        frequent, shape = self.frequent, self.shape

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, total = Words(frequent, shape), np.zeros(shape.tokens, np.int64)
            for batch in batches:
                token = words.token[words.codes(batch.column("word"))]
                np.add.at(total, token, batch.column("n").to_numpy())
            seen = np.nonzero(total)[0]
            yield pa.RecordBatch.from_pydict({"token": seen, "total": total[seen]})

        sums = counts.mapInArrow(total, "token bigint, total bigint").groupBy("token").agg(F.sum("total").alias("total"))
        self.totals = np.zeros(shape.tokens)
        for row in sums.collect():
            self.totals[row.token] = row.total

    @staticmethod
    def _most(counts: DataFrame, most: int) -> dict[bytes, int]:
        """The most frequent words, as many as ``most`` allows without parting words of about
        the same count. Words are counted by count first, so that only these are sent."""
        level = F.floor(F.log2("n") * 16)
        levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
        upto, least = 0, None
        for row in levels:
            upto += row["count"]
            if upto > most:
                break
            least = row.level
        if least is None:
            return {}
        rows = counts.filter(level >= least).collect()
        return {bytes(row.word): row.n for row in sorted(rows, key=lambda row: (-row.n, bytes(row.word)))}

    def shares(self, counts: DataFrame) -> DataFrame:
        """``word, share``: the logarithm of each word's part of all the words of its token."""
        frequent, shape, totals = self.frequent, self.shape, self.totals

        def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = Words(frequent, shape)
            for batch in batches:
                token = words.token[words.codes(batch.column("word"))]
                found = np.log(batch.column("n").to_numpy() / totals[token])
                yield pa.RecordBatch.from_pydict({"word": batch.column("word"), "share": found})

        return counts.mapInArrow(share, "word binary, share double")

    def near_shares(self, words: Words) -> np.ndarray:
        """The shares of the codes of words: not a number where several words have the code."""
        known = np.array(list(self.near.values()), dtype=float)
        shares = np.full(len(words.token), np.nan)
        shares[:len(known)] = np.log(known / self.totals[words.token[:len(known)]])
        return shares


def shard_tokens(docs: DataFrame, corpus: Corpus, wave: range, *, id: str, text: str) -> DataFrame:
    """``shard, key, tokens`` of the documents in the shards of a wave. Shards are dealt by a
    hash of id and text; rows that repeat both go to several shards."""
    shards = max(1, -(-corpus.words // SHARD))
    frequent, shape = corpus.frequent, corpus.shape
    rows = docs.select(
        F.xxhash64(F.col(id), F.col(text).cast("string")).alias("key"), F.col(text).cast("string").alias("text")
    ).withColumn("shard", F.pmod("key", F.lit(shards)))
    rows = rows.filter(F.pmod("shard", F.lit(16)).between(wave[0], wave[-1]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, copies = Words(frequent, shape), Counter()
        for batch in batches:
            at = 0
            for texts in runs(batch.column("text")):
                distinct, place, ends = lower_words(texts)
                tokens = words.token[words.codes(distinct)][place]
                key = batch.column("key").slice(at, len(texts))
                shard = batch.column("shard").slice(at, len(texts)).to_pylist()
                at += len(texts)
                for row, each in enumerate(key.to_pylist()):
                    shard[row] = (shard[row] + copies[each] // COPIES * 16) % shards
                    copies[each] += 1
                if len(copies) > DISTINCT:
                    copies = Counter({each: n for each, n in copies.items() if n >= COPIES})
                found = [each.tobytes() for each in np.split(tokens, ends[1:-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), key, pa.array(found, pa.binary())], ["shard", "key", "tokens"]
                )

    return rows.mapInArrow(work, "shard long, key long, tokens binary")


def train(docs: DataFrame, corpus: Corpus, *, id: str = "doc_id", text: str = "text") -> np.ndarray:
    """The weights after all waves, packed. Tasks add up what their shards learned, and pieces
    of these sums are added up in the cluster; the driver gets as many numbers as the network
    has weights, and as many squares of slopes, from which the next wave goes on."""
    context = docs.sparkSession.sparkContext
    shape = corpus.shape
    weights = shape.packed(shape.first(corpus.totals))
    squares = np.full(len(weights), SQUARES)
    for wave in WAVES:
        shared = context.broadcast((weights.astype(np.float32), squares.astype(np.float32)))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = [shape.unpacked(each) for each in shared.value]
            total, words = np.zeros(2 * len(shared.value[0])), 0
            for shard, texts in by_shard(batches):
                learner = Learner(*start)
                learn(learner, texts, np.random.default_rng([SEED, shard]), shape.pad)
                learned = np.concatenate([shape.packed(each) for each in (learner.weights, learner.squares)])
                total += learned * float(learner.words)
                words += learner.words
            if words:
                pieces = np.split(total, range(PIECE, len(total), PIECE))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(len(pieces)), pa.int32()), pa.array([words] * len(pieces), pa.int64()),
                        pa.array([each.tobytes() for each in pieces], pa.binary()),
                    ],
                    ["piece", "words", "total"],
                )

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(each) for each in rows["total"]) / rows["words"].sum()
            return pd.DataFrame({"piece": rows["piece"].iloc[:1], "mean": [total.tobytes()]})

        dealt = shard_tokens(docs, corpus, wave, id=id, text=text).repartition("shard")
        sums = (
            dealt.sortWithinPartitions("shard", "key").mapInArrow(work, "piece int, words long, total binary")
            .groupBy("piece").applyInPandas(add, "piece int, mean binary").collect()
        )
        if sums:
            means = np.concatenate([np.frombuffer(row.mean) for row in sorted(sums, key=lambda row: row.piece)])
            weights, squares = np.split(means, 2)
    return weights


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """(shard, texts) of rows in the order of shards."""
    rows = (
        (shard, np.frombuffer(tokens, dtype=np.int32))
        for batch in batches
        for shard, tokens in zip(batch.column("shard").to_pylist(), batch.column("tokens").to_pylist())
    )
    for shard, own in groupby(rows, key=lambda row: row[0]):
        yield shard, (tokens for _, tokens in own)


def score_texts(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pseudo-log-likelihood of every text.

    Counts words over all documents, trains the network once on every word of them, and
    scores each text whole. Returns one row per row of ``docs``: the id, ``n_words``,
    ``log_likelihood`` (the sum over its words of the log-probability given the window on
    both sides) and ``mean_log_likelihood``, null without words. A word's probability is
    that of its token, from the network, times its share of the token's words in all
    documents, so words of one token differ by how often they occur. Weights depend on the
    rows alone, not on how they are dealt to tasks, up to the rounding of sums (and, where
    more than ``COPIES`` rows have the same id and text, which shards these go to).

    A null or empty text has no words and log-likelihood 0. A null id is an id like others.
    Repeated rows count each. Very long texts are learned in steps and scored whole, in a
    batch of texts that bounds a worker's memory. Other columns are not read. An empty table
    gives no rows.
    """
    counts = stored(word_counts(docs, text))
    corpus = Corpus(counts)
    shape = corpus.shape
    near_words = list(corpus.near)
    near_shares = corpus.near_shares(Words(near_words, shape))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((train(docs, corpus, id=id, text=text), near_words, near_shares))
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(id).alias("id"), F.col(text).cast("string").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text with the score of its tokens and of the frequent words in
        them, and one for each of its other words. The first have no word; a space and the
        key, which no word is, deals them out evenly."""
        numbers, near_words, near_shares = shared.value
        words, weights = Words(near_words, shape), shape.unpacked(numbers)
        for batch in batches:
            at = 0
            for texts in runs(batch.column("text")):
                distinct, place, ends = lower_words(texts)
                codes = words.codes(distinct)[place]
                near, token = windows(np.split(words.token[codes], ends[1:-1]), shape.pad)
                shares = near_shares[codes]
                rare = np.isnan(shares)
                shares[rare] = 0
                sums = np.concatenate([[0.0], np.cumsum(log_probabilities(weights, near, token) + shares)])
                text = np.repeat(np.arange(len(texts)), np.diff(ends))[rare]
                pairs, times = np.unique(text * len(distinct) + place[rare], return_counts=True)
                text, other = np.divmod(pairs, max(1, len(distinct)))
                rest = np.diff(ends) - np.bincount(text, times, minlength=len(texts)).astype(np.int64)
                key, ids = batch.column("key").slice(at, len(texts)), batch.column("id").slice(at, len(texts))
                at += len(texts)
                own = pa.array([b" %d" % k for k in key.to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([key.to_numpy(), key.to_numpy()[text]])),
                        pa.concat_arrays([ids, pa.nulls(len(pairs), ids.type)]),
                        pa.concat_arrays([own, distinct.cast(pa.binary()).take(pa.array(other))]),
                        pa.array(np.concatenate([rest, times])),
                        pa.array(np.concatenate([sums[ends[1:]] - sums[ends[:-1]], np.zeros(len(pairs))])),
                    ],
                    ["key", "id", "word", "times", "score"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    parts = rows.mapInArrow(work, f"key bigint, id {kind}, word binary, times bigint, score double")
    scored = (
        parts.join(corpus.shares(counts).hint("shuffle_hash"), "word", "left")
        .withColumn("score", F.col("score") + F.col("times") * F.coalesce("share", F.lit(0.0)))
        .groupBy("key").agg(
            F.max("id").alias("id"), F.sum("times").alias("n_words"), F.sum("score").alias("log_likelihood")
        )
    )
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return scored.select(
        F.col("id").alias(id), "n_words", "log_likelihood", mean.alias("mean_log_likelihood")
    )
