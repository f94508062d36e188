"""Packing of token pieces into sequences by the sum of squares."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct_words, kept, runs, stored

#: Pieces that are packed together, about. The last, emptier sequences of a shard are a
#: handful among thousands.
SHARD = 20_000
#: Pieces shorter than this part of a sequence are placed last, in no order of length.
SHORT = 8
#: Words whose tokens a Python worker remembers, from one task to the next: those of late, in
#: two memories of half as many, the older of which goes when the other is full. They are Arrow
#: columns (39 bytes for a word of ten characters; 128 in dictionaries), and full at half of
#: these bytes, too, if words are long.
REMEMBERED = 800_000
REMEMBERED_BYTES = 64 << 20
#: Bytes of texts that are taken apart, and words that go to the tokenizer, at once.
BYTES = 4 << 20
AT_ONCE = 10_000
#: First bytes of the accents that follow their letter (U+0300 to U+036F) and the beginning of
#: a special token.
ODD = (b"\xcc", b"\xcd", b"<|")
#: Letters that the normaliser leaves as they are, and words of these, ASCII digits and marks.
LETTERS = "a-zà-öø-ÿ"
PLAIN = re.compile(f"[!-@[-`{{-~{LETTERS}]+").fullmatch
#: What the vocabulary's pattern makes of such words.
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+").findall

NOTHING = pa.table({"word": pa.array([], pa.string()), "ids": pa.array([], pa.large_binary())})


@cache
def tokenizer_at(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def part_tokenizer_at(path: str):
    """The tokenizer's model and its bytes alone: for parts that are normalised and split."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer(tokenizer_at(path).model)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


class WordTokens:
    """Token ids of texts, as little-endian unsigned 32-bit numbers.

    The vocabulary's rules never join what ASCII white space parts: the normaliser turns
    white space to spaces, the splitting pattern leaves them out, and special tokens hold
    none. So a text's ids are those of its words in a row. As the normaliser lowers case, A-Z
    are lowered first, which saves words; not where that could compose a letter with an accent
    that follows it, or make a special token.

    The ids of a word, once found, are remembered. A new word of plain characters, which the
    normaliser does not change, is cut by the splitting pattern here, so that only the parts
    that are no known word need the tokenizer's model; other words go through all of it.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer_at(path)
        self.parts = part_tokenizer_at(path)
        self.known = self.older = NOTHING

    def _remembered(self, words: pa.Array) -> pa.ChunkedArray:
        """The words' ids, null for those not remembered. Words of late go to the newer memory."""
        both = pa.concat_tables([self.known, self.older])
        place = pc.index_in(both["word"], value_set=words).combine_chunks()  # in words, which are fewer
        there = np.flatnonzero(place.is_valid())
        at = np.full(len(words), -1)
        at[place.take(there).to_numpy()] = there
        late = at[at >= len(self.known)]
        if len(late):
            self.known = pa.concat_tables([self.known, both.take(late)]).combine_chunks()
        return both["ids"].take(pa.array(at, mask=at < 0))

    def _remember(self, new: pa.Table) -> None:
        if 2 * new.nbytes > REMEMBERED_BYTES:
            return
        words, size = len(self.known) + len(new), self.known.nbytes + new.nbytes
        if 2 * words > REMEMBERED or 2 * size > REMEMBERED_BYTES:
            self.known, self.older = NOTHING, self.known
        self.known = pa.concat_tables([self.known, new]).combine_chunks()

    @staticmethod
    def _encode(tokenizer, words: list[str]) -> list[bytes]:
        ids = []
        for at in range(0, len(words), AT_ONCE):
            found = tokenizer.encode_batch_fast(words[at:at + AT_ONCE], add_special_tokens=False)
            ids.extend(array("I", encoding.ids).tobytes() for encoding in found)
        return ids

    def of_words(self, words: pa.Array) -> pa.Array:
        """Ids of each of these different words."""
        found = self._remembered(words)
        unknown = pc.is_null(found)
        fresh = words.filter(unknown).to_pylist()
        cut = [PARTS(word) if PLAIN(word) and "<|" not in word else None for word in fresh]
        whole = [word for word, own in zip(fresh, cut) if own is None]
        parts = list(set().union(*filter(None, cut)))
        here = dict(zip(parts, self._remembered(pa.array(parts, pa.string())).to_pylist()))
        plain = [part for part, ids in here.items() if ids is None]
        here.update(zip(plain, self._encode(self.parts, plain)))
        others = iter(self._encode(self.tokenizer, whole))
        ids = [next(others) if own is None else b"".join(map(here.__getitem__, own)) for own in cut]
        new = pa.table({"word": pa.array(fresh, pa.string()), "ids": pa.array(ids, pa.large_binary())})
        self._remember(new)
        return pc.replace_with_mask(found.combine_chunks(), unknown.combine_chunks(), new["ids"].combine_chunks())

    def ids(self, texts: list[bytes]) -> list[bytes]:
        lower = [text if any(map(text.__contains__, ODD)) else text.lower() for text in texts]
        words, place, ends = distinct_words(pa.array(lower, pa.binary()).cast(pa.string()))
        found = self.of_words(words).take(pa.array(place))
        _, offsets, data = found.buffers()
        if not data:
            return [b""] * len(texts)
        at = np.frombuffer(offsets, dtype=np.int64)[ends]
        return [data[start:end].to_pybytes() for start, end in zip(at.tolist(), at[1:].tolist())]


def word_tokens(path: str) -> WordTokens:
    return kept(("word tokens", path), lambda: WordTokens(path))


def pieces_of(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids, cut only if it is too long."""
    size = 4 * capacity
    return [
        (i // size, i // 4, len(part) // 4, zlib.crc32(part))
        for i in range(0, len(ids), size) if (part := ids[i:i + size])
    ]


def token_pieces(docs: DataFrame, *, vocabulary: str, capacity: int, id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )
    end = np.array([0], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(vocabulary)
        for batch in batches:
            of, found, row = [], [], 0
            for texts in runs(batch.column("text").cast(pa.binary()), BYTES):
                for ids in tokens.ids([t or b"" for t in texts.to_pylist()]):
                    pieces = pieces_of(ids + end, capacity)
                    of.extend([row] * len(pieces))
                    found.extend(pieces)
                    row += 1
            piece, start, length, crc = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(work, schema)


def placing_order(lengths: np.ndarray, capacity: int, seed: int) -> np.ndarray:
    """The order in which a shard's pieces are placed: from the longest to the shortest, then
    the short ones shuffled. Those of many sizes fill gaps of many sizes to the end, where
    sorted ones would leave the gaps that only their longer ones fit."""
    mixed = np.random.default_rng(seed).permutation(len(lengths))
    length = lengths[mixed]
    return mixed[np.argsort(np.where(length * SHORT >= capacity, -length, 0), kind="stable")]


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, placed in the order given.

    With n(g) open bins of gap g, a length goes where the sum of n(g) squared becomes
    smallest: into a bin of gap g, or a new one; gap 0 is closed and counts nothing. Among
    equals the smallest gap is taken, and of its bins the one that got it last.
    """
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, dtype=np.int64)
    gaps = np.arange(capacity + 1)
    made, never = 0, np.iinfo(np.int64).max
    for i, length in enumerate(lengths.tolist()):
        # change of the sum: -2 n(g) + 1 at the gap that goes, 2 n(g') + 1 at the one that comes
        left = 2 * n[: capacity + 1 - length] + 1
        left[0] = 0
        change = np.where(n[length:] > 0, left - 2 * n[length:] + 1, never)
        best = int(change.argmin())
        new = 0 if length == capacity else int(2 * n[capacity - length] + 1)
        if n[length + best] > 0 and change[best] <= new:
            gap = int(gaps[length + best])
            bin = open_bins[gap].pop()
            n[gap] -= 1
        else:
            gap, bin = capacity, made
            made += 1
        bins[i], offsets[i] = bin, capacity - gap
        if gap > length:
            open_bins[gap - length].append(bin)
            n[gap - length] += 1
    return bins, offsets


def pack_documents(
    docs: DataFrame, *, vocabulary: str, capacity: int = 2048, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Sequences of at most ``capacity`` tokens that hold all documents.

    A document is its text's ids by the tokenizer in the file ``vocabulary``, without
    special tokens, then id 0. One that is too long is cut into pieces of ``capacity``, the
    last being shorter; no other is cut. Returns one row per piece: the id, ``piece``,
    ``start`` and ``length`` in the document, ``ids_crc32``, ``sequence_id``, ``offset``.

    Pieces are dealt into shards of about ``SHARD`` in turn, whatever their ids, and packed
    there in `placing_order` by the sum of squares (`sum_of_squares`).

    A null text is an empty one: id 0 alone. Null ids and repeated rows are documents of
    their own. An empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, vocabulary=vocabulary, capacity=capacity, id=id, text=text))
    shards = max(1, -(-pieces.count() // SHARD))
    schema = f"{pieces.schema.simpleString().removeprefix('struct<').removesuffix('>').replace(':', ' ')}, shard bigint"

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("turn")
        rows = rows.iloc[placing_order(rows["length"].to_numpy(), capacity, int(rows["shard"].iloc[0]))]
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.drop(columns="turn").assign(sequence_id=(rows["shard"].to_numpy() << 32) + bins, offset=offsets)

    # the stored rows keep their partitions and order, so numbers by place stay the same
    turn = F.monotonically_increasing_id()
    dealt = pieces.withColumn("turn", turn).withColumn("shard", F.pmod("turn", F.lit(shards)))
    packed = dealt.groupBy("shard").applyInPandas(pack, f"{schema}, sequence_id bigint, offset bigint")
    return packed.select(
        F.col("id").alias(id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
