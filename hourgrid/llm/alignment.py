"""Alignment of the tokens of two tokenizers, and how often their tokens are linked."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_pairs import SPACE, as_bytes, few_at_once, lists
from .common import stored

#: Links and documents of a block, about: what one task holds at once.
LINKS, DOCUMENTS = 1 << 20, 1 << 15
#: Parts of texts that a Python worker remembers, and the longest it remembers, in
#: characters: about 200 MB.
REMEMBERED, LONGEST = 400_000, 40
#: What stands for a space in the pieces. A fixed value.
MARK = "\u2581"
#: From a space to the next that follows a character other than white space.
PART = re.compile(f" [^ ]*(?:(?<=[{SPACE}]) [^ ]*)*")


class ByteLevel:
    """Ids by a byte-level vocabulary of the tokenizers library, no string being special."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.table = [b""] * self.tokenizer.get_vocab_size()
        special = self.tokenizer.get_added_tokens_decoder()
        for token, id in self.tokenizer.get_vocab().items():
            self.table[id] = token.encode() if id in special else as_bytes(token)

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with the space."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [each.ids for each in found]


class Pieces:
    """Ids by a sentencepiece vocabulary, which puts a space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        pieces = [self.processor.id_to_piece(id) for id in range(self.processor.get_piece_size())]
        self.table = [
            bytes([int(piece[3:-1], 16)]) if self.processor.is_byte(id) else piece.replace(MARK, " ").encode()
            for id, piece in enumerate(pieces)
        ]
        #: Whether no piece goes from a character on to a space, and spaces stay as they are:
        #: then what follows such a place is cut as if it stood alone.
        self.parts_words = not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in pieces) and (
            self._spelled("a  b   c ") == b" a  b   c "
        )

    def _spelled(self, text: str) -> bytes:
        return b"".join(self.table[id] for id in self.processor.encode(text))

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with the space, which is left to the vocabulary to add."""
        return self.processor.encode([text[1:] for text in texts], num_threads=1)


class Aligner:
    """Aligns texts by parts: a space after another character that is no white space parts
    words for both vocabularies, so tokens of both end there. Parts are remembered from task
    to task. Where the second vocabulary does not part words so, a text is one part."""

    def __init__(self, a_vocabulary: str, b_vocabulary: str):
        self.a, self.b = ByteLevel(a_vocabulary), Pieces(b_vocabulary)
        self.width = len(self.b.table)
        self.sizes = [np.array([len(token) for token in side.table]) for side in (self.a, self.b)]
        self.names = [list(map(str, range(len(side.table)))) for side in (self.a, self.b)]
        self.known: dict[str, tuple | None] = {}

    def align(self, texts: list[str]) -> list[list[tuple[str, bytes, int, int]]]:
        """Of each text its parts; none for an empty text and one that the tokens of either
        side do not spell.

        A part has its groups, cut where tokens of both end at the same byte, written out;
        of each group one number for the ids of the two tokens that end it together; and how
        many tokens of either it has.
        """
        bodies = [" " + text if text else "" for text in texts]
        split = [PART.findall(body) if self.b.parts_words else [body] * bool(body) for body in bodies]
        here = self._look_up(list(dict.fromkeys(part for parts in split for part in parts)))
        found = [list(map(here.__getitem__, parts)) for parts in split]
        # parts that are not spelled could only make up for each other in the whole text
        odd = [row for row, parts in enumerate(found) if None in parts]
        whole = self._look_up(list(dict.fromkeys(bodies[row] for row in odd)))
        for row in odd:
            each = whole[bodies[row]]
            found[row] = [] if each is None else [each]
        return found

    def _look_up(self, parts: list[str]) -> dict[str, tuple | None]:
        fresh = [part for part in parts if part not in self.known]
        new = dict(zip(fresh, self._align(fresh)))
        here = {part: new[part] if part in new else self.known[part] for part in parts}
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        self.known.update((part, each) for part, each in new.items() if len(part) <= LONGEST)
        return here

    def _align(self, parts: list[str]) -> list[tuple | None]:
        spelled = np.cumsum([len(part.encode()) for part in parts], dtype=np.int64)
        sides = []
        for side, sizes in zip((self.a, self.b), self.sizes):
            lists = side.ids(parts)
            ids = np.fromiter(chain.from_iterable(lists), dtype=np.int64)
            upto = np.cumsum([len(each) for each in lists], dtype=np.int64)
            ends = np.cumsum(sizes[ids])
            tokens = list(map(side.table.__getitem__, ids.tolist()))
            if not np.array_equal(np.concatenate([[0], ends])[upto], spelled) or b"".join(tokens) != "".join(parts).encode():
                return self._spelled_only(parts)
            sides.append((ids, ends, upto))
        (a, a_ends, a_upto), (b, b_ends, b_upto) = sides
        a_at = dict(zip(a_ends.tolist(), range(1, len(a) + 1)))
        b_at = dict(zip(b_ends.tolist(), range(1, len(b) + 1)))
        common = sorted(a_at.keys() & b_at.keys())
        a_cuts, b_cuts = list(map(a_at.__getitem__, common)), list(map(b_at.__getitem__, common))
        a_names, b_names = (
            list(map(names.__getitem__, ids.tolist())) for names, ids in zip(self.names, (a, b))
        )
        groups = [
            f"{a_names[i]}|{b_names[k]}" if j - i == 1 == m - k
            else f"{','.join(a_names[i:j])}|{','.join(b_names[k:m])}"
            for i, j, k, m in zip([0, *a_cuts], a_cuts, [0, *b_cuts], b_cuts)
        ]
        # no two tokens of one side end together, so of a group's pairs only the last do
        links = a[np.array(a_cuts, dtype=np.int64) - 1] * self.width + b[np.array(b_cuts, dtype=np.int64) - 1]
        links = links.astype("<i8").tobytes()
        upto = np.searchsorted(np.array(common, dtype=np.int64), spelled, side="right").tolist()
        return [
            (";".join(groups[i:j]), links[8 * i:8 * j], n_a, n_b)
            for i, j, n_a, n_b in zip(
                [0, *upto], upto, np.diff(a_upto, prepend=0).tolist(), np.diff(b_upto, prepend=0).tolist()
            )
        ]

    def _spelled_only(self, parts: list[str]) -> list[tuple | None]:
        """Aligns the parts that the tokens of both sides spell."""
        good = list(map(self._is_spelled, parts, self.a.ids(parts), self.b.ids(parts)))
        found = iter(self._align([part for part, one in zip(parts, good) if one]))
        return [next(found) if one else None for one in good]

    def _is_spelled(self, part: str, a: list[int], b: list[int]) -> bool:
        body = part.encode()
        return all(
            b"".join(map(side.table.__getitem__, ids)) == body for side, ids in ((self.a, a), (self.b, b))
        )


@cache
def aligner(a_vocabulary: str, b_vocabulary: str) -> Aligner:
    return Aligner(a_vocabulary, b_vocabulary)


def read_groups(written: str) -> list[np.ndarray]:
    """a, b, a_cuts, b_cuts of the groups written as ``a1,a2|b1;a3|b2,b3``."""
    groups = [group.split("|") for group in written.split(";")] if written else []
    sides = [[ids.split(",") for ids in side] for side in zip(*groups)] or [[], []]
    return [np.array([*chain.from_iterable(side)], dtype=np.int32) for side in sides] + [
        np.cumsum([len(ids) for ids in side], dtype=np.int32) for side in sides
    ]


def align_texts(
    docs: DataFrame, *, a_vocabulary: str, b_vocabulary: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The tokens of each text by two vocabularies, and where they are cut into groups.

    A is a byte-level vocabulary of the tokenizers library, applied to a space and the text,
    B one of sentencepiece, which adds that space; no string is special to either. Returns
    the id, ``a_ids``, ``b_ids``, and ``a_cuts``, ``b_cuts``: for each byte offset at which
    tokens of both end, how many tokens of either are before it. Group k holds the tokens
    between cuts k - 1 and k.

    Null and empty texts, and texts that the bytes of A's or of B's tokens do not spell (B
    may put one character for another), have no tokens: empty arrays. Very long texts are
    read whole, alone in their batch. Null ids and repeated rows are rows of their own. An
    empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_vocabulary, b_vocabulary)
        for batch in batches:
            at = 0
            for texts in few_at_once(batch.column("text")):
                written = (";".join(part[0] for part in parts) for parts in both.align(texts))
                columns = map(lists, zip(*map(read_groups, written)))
                ids = batch.column("id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *columns], ["id", "a_ids", "b_ids", "a_cuts", "b_cuts"])
                at += len(texts)

    kind = rows.schema["id"].dataType.simpleString()
    fields = "a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
    return rows.mapInArrow(work, f"id {kind}, {fields}").withColumnRenamed("id", id)


def place_type(pairs: int) -> str:
    """The numbers in which places among ``pairs`` are written."""
    return "<u2" if pairs <= 1 << 16 else "<u4"


def linked_blocks(docs: DataFrame, *, a_vocabulary: str, b_vocabulary: str, id: str, text: str) -> DataFrame:
    """A row per document with its counts and ``links``, the places of its linked pairs among
    all pairs of its block. The first row of a block also has these pairs (``pairs``, one
    number for both ids) and how often each is linked there (``times``)."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fields = "n_a long, n_b long, n_groups long, groups_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_vocabulary, b_vocabulary)
        block = TaskContext.get().partitionId() << 32
        ids, counts, codes, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            pairs, places, times = np.unique(
                np.concatenate([np.empty(0, np.int64), *codes]), return_inverse=True, return_counts=True
            )
            places = places.astype(place_type(len(pairs)))
            cut = np.cumsum([len(each) for each in codes])[:-1]
            first = [[each] + [None] * (len(codes) - 1) for each in (pairs, times)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(ids), *map(pa.array, zip(*counts)), pa.array([block] * len(codes), pa.int64()),
                    pa.array([each.tobytes() for each in np.split(places, cut)], pa.binary()),
                    *(pa.array(each, pa.list_(pa.int64())) for each in first),
                ],
                ["id", "n_a", "n_b", "n_groups", "groups_sha256", "block", "links", "pairs", "times"],
            )

        for batch in batches:
            at = 0
            for texts in few_at_once(batch.column("text")):
                ids.append(batch.column("id").slice(at, len(texts)))
                at += len(texts)
                for parts in both.align(texts):
                    written, links, n_a, n_b = zip(*parts) if parts else [()] * 4
                    links = np.frombuffer(b"".join(links), dtype="<i8")
                    digest = hashlib.sha256(";".join(written).encode()).hexdigest() if parts else ""
                    counts.append((sum(n_a), sum(n_b), len(links), digest))
                    codes.append(links)
                    held += len(links)
                if held >= LINKS or len(codes) >= DOCUMENTS:
                    yield closed()
                    block += 1
                    ids, counts, codes, held = [], [], [], 0
        if codes:
            yield closed()

    return rows.mapInArrow(
        work, f"id {kind}, {fields}, block long, links binary, pairs array<long>, times array<long>"
    )


def link_digests(
    docs: DataFrame, *, a_vocabulary: str, b_vocabulary: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """What the links of each document are worth, by how often the corpus has them.

    A link is a token of A and one of B that end at the same byte (see `align_texts`, whose
    edge cases hold); the count of a pair of ids is the number of links of all documents
    between them. Returns the id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``n_best`` (links whose count no other pair of the same B id passes), ``count_sum`` (the
    counts of all links together) and ``groups_sha256``, the digest of the groups written as
    ``a1,a2|b1;a3|b2,b3``; '' without tokens.

    Documents are taken in blocks of about ``LINKS`` links. A block's distinct pairs are
    summed over all blocks and come back to it with their counts; so no pair is sent once a
    link, the most common pair is one row a block, and nothing of the corpus is in one place.
    """
    blocks = stored(linked_blocks(docs, a_vocabulary=a_vocabulary, b_vocabulary=b_vocabulary, id=id, text=text))
    kind = blocks.schema["id"].dataType.simpleString()
    pairs = blocks.filter("pairs IS NOT NULL").select(
        F.col("block").alias("of"), F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "each")
    ).select("of", "place", F.col("each.pairs").alias("pair"), F.col("each.times").alias("times"))
    width = aligner(a_vocabulary, b_vocabulary).width
    counts = pairs.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = counts.withColumn("b", F.col("pair") % width)
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    known = pairs.join(judged, "pair").select("of", "place", "count", "best")

    def of_block(rows: pa.Table, known: pa.Table) -> pa.Table:
        count, best = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64)
        place = known["place"].to_numpy()
        count[place], best[place] = known["count"].to_numpy(), known["best"].to_numpy()
        kind = place_type(len(known))
        links = [np.frombuffer(each, dtype=kind) for each in rows["links"].to_pylist()]
        every = np.concatenate([np.empty(0, kind), *links]).astype(np.int64)
        ends = np.cumsum([0, *map(len, links)])

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values[every])])
            return pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())

        names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        found = {"n_links": rows["n_groups"], "n_best": summed(best), "count_sum": summed(count)}
        return pa.table([found[name] if name in found else rows[name] for name in names], names=names)

    fields = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return (
        blocks.drop("pairs", "times").groupBy("block").cogroup(known.groupBy("of"))
        .applyInArrow(of_block, f"id {kind}, {fields}").withColumnRenamed("id", id)
    )
