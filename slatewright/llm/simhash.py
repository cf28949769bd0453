"""Near copies by SimHash fingerprints, linked by a generalised pigeonhole search.

1. A fingerprint per text (a task-local pass); equal fingerprints collapse into one row.
2. Fingerprints at distance 1 or 2 share a value that is at most one bit from both. At most
   65 fingerprints surround a value, so linking them to their smallest is bounded; dense
   groups of near copies shrink to a few classes before any pair is looked at.
3. The bits are ordered so that bits which agree or disagree together stand together, and cut
   into partitions. Two fingerprints at distance t or less are, for thresholds that add up to
   t - m + 1, within the threshold of at least one of the m partitions. Dynamic programming
   picks m and the thresholds with the fewest expected candidates; the expectation comes from
   statistics of all fingerprints. Values probe all variants within the threshold.
4. Probes meet only fingerprints of other classes; those are verified, and the links between
   classes are closed by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.llm.components import components
from slatewright.session import written

BITS = 64
SEED = 42


def fingerprint_of(text: bytes, width: int) -> int:
    """The signed 64-bit fingerprint of one lower-cased text."""
    import xxhash

    parts = text.split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), max(1, len(parts) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))) + np.arange(len(parts))
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[-n:].tolist())]
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 4096):
        some = np.array(hashes[k : k + 4096], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4, id_column: str = "doc_id") -> DataFrame:
    """id, fp (bigint): SimHash of the word shingles of the whole text; null and empty texts get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [fingerprint_of((texts[k].as_py() or "").encode().lower(), width) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col("text")).mapInArrow(run, f"id {kind}, fp bigint")


def bit_statistics(marked: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bit i and bit j set (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            count += len(values)
        if count:
            cells = np.concatenate([[count], both.ravel()]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    sums = marked.select("fp").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for cell, n in sums:
        cells[cell] = n
    return int(cells[0]), cells[1:].reshape(BITS, BITS)


def correlated_order(n: int, both: np.ndarray) -> list[int]:
    """All bits, each followed by the one left that is most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    order, left = [0], set(range(1, BITS))
    while left:
        last = order[-1]
        order.append(max(left, key=lambda b: (tie[last, b], -b)))
        left.remove(order[-1])
    return order


def plan_partitions(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Bits and threshold of every partition that is probed, with the fewest expected rows.

    A partition costs its probes (variants within the threshold) and its candidates (pairs that
    agree within it). Bits are taken as independent given how often each is set.
    """
    p = np.diag(both) / max(n, 1)
    order, best = correlated_order(n, both), (np.inf, [])
    for m in range(1, distance + 2):
        parts = [[order[k] for k in range(i * BITS // m, (i + 1) * BITS // m)] for i in range(m)]
        cost = np.zeros((m, distance + 2))  # column 0: not probed; column t + 1: threshold t
        for i, bits in enumerate(parts):
            near = np.zeros(distance + 1)  # chance of exactly t differing bits
            near[0] = 1
            for b in bits:
                q = 2 * p[b] * (1 - p[b])
                near[1:] = near[1:] * (1 - q) + near[:-1] * q
                near[0] *= 1 - q
            ball = 0
            for t in range(distance + 1):
                ball += len(list(combinations(range(len(bits)), t))) if t < 3 else np.inf
                cost[i, t + 1] = n * (1 + ball) + n * n / 2 * near[: t + 1].sum()
        # the columns, added up over the partitions, must reach distance + 1
        need = distance + 1
        table = np.full((m + 1, need + 1), np.inf)
        table[0, 0], pick = 0, np.zeros((m + 1, need + 1), dtype=int)
        for i in range(m):
            for have in range(need + 1):
                for c in range(need - have + 1):
                    if c < distance + 2 and table[i, have] + cost[i, c] < table[i + 1, have + c]:
                        table[i + 1, have + c], pick[i + 1, have + c] = table[i, have] + cost[i, c], c
        if table[m, need] < best[0]:
            chosen, have = [], need
            for i in range(m, 0, -1):
                c = int(pick[i, have])
                chosen.append((parts[i - 1], c - 1))
                have -= c
            best = (table[m, need], [x for x in chosen[::-1] if x[1] >= 0])
    return best[1]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _flips(bits: list[int], at_most: int) -> F.Column:
    """An array of the masks that flip up to so many of the bits."""
    masks = [_mask(list(c)) for t in range(at_most + 1) for c in combinations(bits, t)]
    return F.array(*[F.lit(x) for x in masks])


def near_links(unique: DataFrame, distance: int) -> DataFrame:
    """a, b: links between unique fingerprints (column fp) that join all within the distance.

    Not every pair is returned, but every pair within the distance is joined by some path.
    """
    around = unique.select("fp", F.explode(_flips(list(range(BITS)), 1)).alias("flip"))
    around = around.select("fp", F.expr("fp ^ flip").alias("middle"))
    least = F.expr("min(fp) over (partition by middle)")
    close = around.select("fp", least.alias("first")).where("fp <> first")
    close = written(close.select(F.col("fp").alias("a"), F.col("first").alias("b")).distinct(), "close")
    classes = components(close, "a", "b")
    marked = unique.join(classes, F.col("fp") == F.col("node"), "left")
    marked = written(marked.select("fp", F.coalesce("component", "fp").alias("class")), "marked")
    n, both = bit_statistics(marked)
    if n < 2:
        return close
    probes = None
    index = None
    for k, (bits, t) in enumerate(plan_partitions(n, both, distance)):
        value = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        rows = marked.select(F.lit(k).alias("part"), value.alias("value"), "fp", "class")
        index = rows if index is None else index.unionByName(rows)
        flipped = marked.select("fp", "class", value.alias("own"), F.explode(_flips(bits, t)).alias("flip"))
        flipped = flipped.select(F.lit(k).alias("part"), F.expr("own ^ flip").alias("value"), "fp", "class")
        probes = flipped if probes is None else probes.unionByName(flipped)
    left, right = probes.alias("p"), index.alias("i")
    found = left.join(
        right,
        (F.col("p.part") == F.col("i.part"))
        & (F.col("p.value") == F.col("i.value"))
        & (F.col("p.class") < F.col("i.class"))
        & (F.bit_count(F.expr("p.fp ^ i.fp")) <= distance),
    ).select(F.col("p.class").alias("a"), F.col("i.class").alias("b"))
    return close.unionByName(found.distinct())


def near_copies(docs: DataFrame, width: int = 4, distance: int = 4, id_column: str = "doc_id") -> DataFrame:
    """id, fp, component: the smallest id among the texts linked to each text, itself included.

    Texts link when their fingerprints differ in at most ``distance`` bits. Null and empty texts
    have fingerprint zero and link like any other; repeated rows share a component; rows without
    an id keep a null component unless linked to one with an id. An empty table gives no rows.
    """
    if not 2 <= distance <= 4:
        raise ValueError("distance must be 2, 3 or 4")
    rows = written(fingerprints(docs, width, id_column), "fingerprints")
    unique = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "unique")
    classes = components(written(near_links(unique, distance), "links"), "a", "b")
    placed = unique.join(classes, F.col("fp") == F.col("node"), "left")
    placed = placed.select("fp", "first", F.coalesce("component", "fp").alias("class"))
    named = placed.groupBy("class").agg(F.min("first").alias("component"))
    # equal fingerprints may be a third of all rows: a plain join, so that adaptive execution can split them
    lookup = placed.join(named, "class").select("fp", "component")
    return rows.join(written(lookup, "lookup"), "fp").select("id", "fp", "component")
