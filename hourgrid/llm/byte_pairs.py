"""Byte-level BPE: texts to token ids by the tokenizers library, and back to bytes."""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts and bytes of text that a worker handles at once; a longer text stands alone.
TEXTS, BYTES = 512, 4 << 20
#: Chunks of text whose ids a Python worker remembers, and the longest it remembers, in
#: characters: about 150 MB.
REMEMBERED, LONGEST = 700_000, 40

#: The characters that \s stands for in the patterns of these vocabularies (Unicode's
#: White_Space). Fixed values.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{SPACE}]?[A-Za-z]+(?=[.,;:!?{SPACE}])|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


@cache
def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the
    others, in order, as the characters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def as_characters(token: bytes) -> str:
    return "".join(map(byte_characters().__getitem__, token))


@cache
def character_bytes() -> dict[str, int]:
    return {character: byte for byte, character in enumerate(byte_characters())}


def as_bytes(token: str) -> bytes:
    return bytes(map(character_bytes().__getitem__, token))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def ranked_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A tokenizer that merges as the ranks say: of all neighbours whose bytes together are a
    token, those of the lowest rank, leftmost first. So every way to cut a token into two
    others is a merge of its rank."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    merges = [
        (as_characters(token[:at]), as_characters(token[at:]))
        for token in sorted(ranks, key=ranks.get)
        for at in range(1, len(token))
        if token[:at] in ranks and token[at:] in ranks
    ]
    model = models.BPE(vocab={as_characters(token): rank for token, rank in ranks.items()}, merges=merges)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer


class ChunkTokens:
    """Token ids of texts, by a tokenizer whose pattern parts words as `byte_bpe_50k` does.

    The pattern never matches across the place where white space follows another character,
    or where one of .,;:!? follows a letter from A to Z, and what it matches after such a
    place depends on nothing before. So a text's ids are those of its chunks (white space,
    then what follows up to the next such place) in a row, and those of a chunk, once found,
    are remembered from task to task.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [CHUNK.findall(text) for text in texts]
        here = dict.fromkeys(chunk for chunks in split for chunk in chunks)
        fresh = []
        for chunk in here:
            if (ids := self.known.get(chunk)) is None:
                fresh.append(chunk)
            else:
                here[chunk] = ids
        found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        new = {chunk: array("i", each.ids).tobytes() for chunk, each in zip(fresh, found)}
        here.update(new)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        self.known.update((chunk, ids) for chunk, ids in new.items() if len(chunk) <= LONGEST)
        return [np.frombuffer(b"".join(map(here.__getitem__, chunks)), dtype="<i4") for chunks in split]


@cache
def ranked_tokens(path: str, pattern: str) -> ChunkTokens:
    return ChunkTokens(ranked_tokenizer(read_ranks(path), pattern))


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id, back from the characters of the vocabulary."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = as_bytes(as_characters(token))
    return table


def few_at_once(column: pa.Array) -> Iterator[list[str]]:
    """The values of a column of texts, a few at a time; null is empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy()
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and (held + size > BYTES or at - start >= TEXTS):
            yield [value or "" for value in column.slice(start, at - start).to_pylist()]
            start, held = at, 0
        held += size
    if len(column) > start:
        yield [value or "" for value in column.slice(start).to_pylist()]


def lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows])))


def character_spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last of each token. A character whose bytes
    several tokens share belongs to each of them."""
    body = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((body & 0xC0) != 0x80, dtype=np.int32) - 1
    ends = np.cumsum(sizes[ids])
    return character[ends - sizes[ids]], character[ends - 1] + 1


def encode_texts(
    docs: DataFrame, *, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text",
    offsets: bool = False,
) -> DataFrame:
    """Token ids of whole texts by the ranks in the file ``vocabulary``.

    Every match of ``pattern`` is merged by itself, as bytes; no string is special. Returns
    the id and ``ids`` (an array of ints); with ``offsets`` also ``starts`` and ``ends``, the
    code points each token covers. A character whose bytes are dealt to several tokens is
    covered by each of them.

    A null or empty text has no ids (empty arrays). Very long texts are read whole, alone in
    their batch; the longest is what bounds a worker's memory. Null ids and repeated rows
    are rows of their own. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    fields = "ids array<int>" + ", starts array<int>, ends array<int>" * offsets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ranked_tokens(vocabulary, pattern)
        sizes = np.array([len(token) for token in token_bytes(vocabulary)], dtype=np.int32)
        for batch in batches:
            at = 0
            for texts in few_at_once(batch.column("text")):
                found = tokens.ids(texts)
                columns = [batch.column("id").slice(at, len(texts)), lists(found)]
                if offsets:
                    spans = [character_spans(each, ids, sizes) for each, ids in zip(texts, found)]
                    columns += [lists([span[side] for span in spans]) for side in (0, 1)]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "starts", "ends"][: len(columns)])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, {fields}").withColumnRenamed("id", id)


def decode_ids(rows: DataFrame, *, vocabulary: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The bytes and the text of token ids: the id, ``decoded`` (binary) and ``decoded_text``.

    Ids may begin or end within a character, as a piece of a document does: ``decoded`` has
    the bytes as they are, ``decoded_text`` one U+FFFD for each broken character. A null list
    is an empty one; null ids in a list stand for nothing; ids without a token are an error.
    Ids of any length are joined whole. Null ids of rows and repeated rows are rows of their
    own. An empty table gives no rows.
    """
    kind = rows.schema[id].dataType.simpleString()
    rows = rows.select(F.col(id).alias("id"), F.col(ids).cast("array<int>").alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(vocabulary)
        for batch in batches:
            column = batch.column("ids")
            for at in range(0, batch.num_rows, TEXTS):
                decoded = []
                for each in column.slice(at, TEXTS):
                    found = each.values
                    numbers = [] if found is None else found.drop_null().to_numpy(zero_copy_only=False)
                    if len(numbers) and numbers.min() < 0:
                        raise ValueError(f"no token has the id {numbers.min()}")
                    decoded.append(b"".join(map(table.__getitem__, numbers.tolist() if len(numbers) else ())))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(at, TEXTS), pa.array(decoded, pa.binary()),
                        pa.array([each.decode(errors="replace") for each in decoded], pa.string()),
                    ],
                    ["id", "decoded", "decoded_text"],
                )

    found = rows.mapInArrow(work, f"id {kind}, decoded binary, decoded_text string")
    return found.withColumnRenamed("id", id)


def byte_pair_digests(
    docs: DataFrame, *, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document's tokens and its text back from them, as digests: the id, ``n_tokens``,
    ``ids_sha256`` (of the decimal ids joined by a space) and ``decoded_sha256``. Texts are
    encoded by `encode_texts` and decoded by `decode_ids`, whose edge cases hold."""
    encoded = encode_texts(docs, vocabulary=vocabulary, pattern=pattern, id=id, text=text).select(
        F.struct(
            F.col(id).alias("id"), F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        ).alias("row"),
        "ids",
    )
    return decode_ids(encoded, vocabulary=vocabulary, id="row").select(
        F.col("row.id").alias(id), "row.n_tokens", "row.ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
