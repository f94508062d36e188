"""What each filter removes in every order of the filters, by decision diagrams."""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stored

#: What a diagram counts: documents, those of good quality, toxic ones.
COUNTED = ["n", "good", "toxic"]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places i whose swaps with i + 1, one after the other, go from the order 0..n-1 through
    all the others once: the last variable wanders through each order of those before it."""
    if n < 2:
        return
    down = True
    for swap in [*adjacent_swaps(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if swap is not None:
            yield swap + 1 if down else swap
        down = not down


class Diagram:
    """A decision diagram over the masks of failed filters, each node with the weight of the
    documents below it.

    Level k tests the filter ``order[k]``: ``low`` leads on the documents that pass, ``high``
    those that fail. Parts of the diagram that are the same are one node, and node 0 stands
    for no documents at any level. Weights are rows of `COUNTED`.
    """

    def __init__(self, weights: dict[int, tuple[int, ...]], n: int):
        """``weights``: of each mask, bit i standing for a failure of filter i."""
        self.n = n
        self.order = list(range(n))
        self.low, self.high, self.weight = [0], [0], [np.zeros(len(COUNTED), dtype=np.int64)]
        self.found: list[dict] = [{} for _ in range(n + 1)]
        self.root = self._built(weights, 0, 0)

    def _built(self, weights: dict, level: int, mask: int) -> int:
        if level == self.n:
            return self._leaf(weights.get(mask, (0,) * len(COUNTED)))
        return self._node(
            level, self._built(weights, level + 1, mask), self._built(weights, level + 1, mask | 1 << level)
        )

    def _leaf(self, weight: tuple[int, ...]) -> int:
        return self._kept(self.n, tuple(weight), 0, 0, np.array(weight, dtype=np.int64)) if any(weight) else 0

    def _node(self, level: int, low: int, high: int) -> int:
        return self._kept(level, (low, high), low, high, self.weight[low] + self.weight[high]) if low or high else 0

    def _kept(self, level: int, key: tuple, low: int, high: int, weight: np.ndarray) -> int:
        if key not in self.found[level]:
            self.found[level][key] = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.weight.append(weight)
        return self.found[level][key]

    def swap(self, level: int) -> None:
        """Test the filter of the next level first. Only nodes of the two levels change: those
        of the upper stand for the same documents as before, so what is above stays."""
        upper, self.found[level], self.found[level + 1] = self.found[level], {}, {}
        for node in upper.values():
            low, high = self.low[node], self.high[node]
            low, high = (
                self._node(level + 1, self.low[low], self.low[high]),
                self._node(level + 1, self.high[low], self.high[high]),
            )
            self.low[node], self.high[node] = low, high
            self.found[level][low, high] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Down the path on which all filters pass: (filter, weight kept, weight removed)."""
        node, path = self.root, []
        for variable in self.order:
            path.append((variable, self.weight[self.low[node]], self.weight[self.high[node]]))
            node = self.low[node]
        return path


def audit(weights: dict[int, tuple[int, ...]], letters: str) -> list[tuple]:
    """Of every order of the filters and every step: (order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley)."""
    diagram = Diagram(weights, len(letters))
    paths = []
    for swap in [None, *adjacent_swaps(len(letters))]:
        if swap is not None:
            diagram.swap(swap)
        paths.append((list(diagram.order), diagram.steps()))
    # at the first step a filter removes all that fail it, at the last those that fail it alone
    fails, alone, removed = ([0] * len(letters) for _ in range(3))
    for _, steps in paths:
        fails[steps[0][0]] = int(steps[0][2][0])
        alone[steps[-1][0]] = int(steps[-1][2][0])
        for variable, _, lost in steps:
            removed[variable] += int(lost[0])
    return [
        (
            "".join(letters[variable] for variable in order), step, int(kept[0]), int(lost[0]),
            fails[variable] - int(lost[0]), alone[variable], int(lost[1]), int(lost[2]), removed[variable],
        )
        for order, steps in paths
        for step, (variable, kept, lost) in enumerate(steps, start=1)
    ]


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails a filter that looks at this text alone."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), 0)
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(
    docs: DataFrame, labels: DataFrame, *, id: str, text: str, part: str, failures=text_failures,
    repeated: str = "E",
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part by the filters they fail, bit i
    standing for the i-th of ``failures``, the last for ``repeated``.

    A text is read once, for a digest and the failures that it alone decides. Equal rows are
    counted together before they are dealt, and copies of a text find the smallest id of it
    by a minimum; who holds that id is found by digest and id together, so copies are no
    common key. Labels meet rows already counted by id.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    mask = sum(
        (F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(failures(F.col("text")).values())),
        F.lit(0),
    )
    last = 1 << len(failures(F.col("text")))
    one = docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("text")
    ).select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = stored(one.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("times")))
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    judged = (
        rows.alias("r")
        .join(firsts.alias("f"), F.expr("r.digest = f.digest AND r.id <=> f.id"), "left")
        .select("r.id", "part", F.expr(f"mask + IF(first, 0, {last})").alias("mask"), "times")
        .groupBy("id", "part", "mask").agg(F.sum("times").alias("times"))
    )
    known = labels.groupBy(F.col(id).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    return judged.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("times").alias("n"),
        F.sum(F.col("times") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("times") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", part: str = "source",
    failures=text_failures, repeated: str = "E",
) -> DataFrame:
    """How the filters act together, for every part, every order of them and every step.

    ``failures`` gives, for a column of texts, the condition under which each filter, named
    by a letter, removes it; the last filter, ``repeated``, removes texts that a smaller id
    has, wherever in the table and whether removed there or not. Returns ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``. Counts of masks are summed where the rows are; what is left of a part is one
    row per mask, from which its diagram is built and taken through all orders.

    A null text is an empty one, a null part the empty string. A null id is larger than any
    other and no smaller than another null one; it has no label. Repeated rows count each;
    none is smaller than the other. Ids with several labels are good, or toxic, if any says
    so; null labels say nothing. Very long texts are read whole. An empty table gives no
    rows, empty labels no losses. Other columns are not read.
    """
    counts = failure_counts(
        docs, labels, id=id, text=text, part=part, failures=failures, repeated=repeated
    )
    letters = "".join(failures(F.col("text"))) + repeated

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        weights = {mask: tuple(weight) for mask, *weight in rows[["mask", *COUNTED]].itertuples(index=False)}
        found = pd.DataFrame(audit(weights, letters), columns=[
            "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
        ])
        assert len(found) == factorial(len(letters)) * len(letters)
        found.insert(0, "part", rows["part"].iloc[0])
        return found

    return counts.groupBy("part").applyInPandas(
        of_part,
        "part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long",
    )
