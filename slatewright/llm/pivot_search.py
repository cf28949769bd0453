"""Exact largest inner products by pivot-table elimination.

1. Entries become whole numbers floor(scale x entry). A further coordinate gives all vectors one
   length M, and a query is scaled to M, so the largest inner products are the nearest points.
2. Pivots, chosen far from one another among a bounded sample, have their distances to every vector
   precomputed: the pivot table. By the triangle inequality no point is nearer to a query than the
   largest difference of their distances to a pivot.
3. Vectors are packed into blocks by nearest pivot, large groups in several. A block keeps the
   range of its distances to each pivot. Queries are packed alike.
4. Each block of queries first meets a block of its own group, which gives every query a score to
   beat. Pairs of blocks whose ranges are too far apart for all their queries go.
5. In each remaining pair a query takes the candidates in the order of their bounds, and stops
   when the next bound is beyond its k-th score: exactly, as scores are whole numbers and bounds
   get some slack for rounding. Candidates of all blocks are ranked by query in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slatewright.llm import dense_rows
from slatewright.session import written

PIVOTS = 32
#: vectors the pivots are chosen from
SAMPLE = 2048
BLOCK, QUERY_BLOCK = 8192, 1024
#: blocks whose ranges are compared with a block of queries at a time
RANGES = 1024
#: rows of an Arrow batch of pairs, each with two blocks
PAIRS = 8
SLACK = 4e-6  # of M; the table holds distances as 32-bit numbers

TABLE = "block bigint, cell int, n int, ids binary, x binary, d binary, low array<double>, high array<double>"


@dataclass
class Space:
    """What tasks need to know: length of the vectors, M squared, pivots, scale, and the type that holds entries."""

    length: int
    scale: int
    largest: float
    square: float
    pivots: np.ndarray
    deep: bool = False

    @property
    def kind(self) -> type:
        return np.float32 if self.largest < 2.0**24 else np.float64

    def entries(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, x = dense_rows.matrix(column, self.length)
        return rows, np.floor(x * self.scale)

    def to_pivots(self, x: np.ndarray, squares: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Distances of points (entries, squared lengths, further coordinate) to all pivots."""
        p = self.pivots
        rest = np.sqrt(np.maximum(self.square - (p * p).sum(axis=1), 0))
        return np.sqrt(np.maximum(squares[:, None] + self.square - 2 * (x @ p.T + np.outer(own, rest)), 0))

    def candidates(self, x: np.ndarray) -> np.ndarray:
        squares = (x * x).sum(axis=1)
        return self.to_pivots(x, np.full(len(x), self.square), np.sqrt(np.maximum(self.square - squares, 0)))

    def queries(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances to the pivots after scaling to M, the scales, and the squared lengths then; zero stays zero."""
        squares = (x * x).sum(axis=1)
        scales = np.where(squares > 0, np.sqrt(self.square / np.maximum(squares, 1e-300)), 1.0)
        after = squares * scales * scales
        return self.to_pivots(x * scales[:, None], after, np.zeros(len(x))), scales, after

    def cells(self, d: np.ndarray) -> np.ndarray:
        """The nearest pivot, and in large tables the second nearest."""
        first = np.argmin(d, axis=1)
        if not self.deep or len(self.pivots) < 2:
            return first * len(self.pivots)
        return first * len(self.pivots) + np.argsort(d, axis=1, kind="stable")[:, 1]


def spread_out(sample: np.ndarray, square: float, most: int) -> np.ndarray:
    """Of the sample, points far from one another: each next one is farthest from those taken."""
    if not len(sample):
        return sample
    rest = np.sqrt(np.maximum(square - (sample * sample).sum(axis=1), 0))
    points = np.column_stack([sample, rest])
    taken, far = [], ((points - points.mean(axis=0)) ** 2).sum(axis=1)
    nearest = np.full(len(points), np.inf)
    while len(taken) < most and far.max() > 0:
        taken.append(int(np.argmax(far)))
        nearest = np.minimum(nearest, ((points - points[taken[-1]]) ** 2).sum(axis=1))
        far = nearest
    return sample[taken] if taken else sample[:1]


def _own(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    own = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector_column}`").alias("vector"))
    return own.where("id is not null")


def space_of(own: DataFrame, scale: int, pivots: int) -> Space:
    """The space all vectors span; of these, only the sample for the pivots comes to the driver."""
    length = dense_rows.common_length(own, "vector")
    space = Space(length, scale, 0.0, 0.0, np.zeros((0, length)))
    if not length:
        return space

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = space.entries(batch.column(1))
            if len(x):
                found = [float(np.abs(x).max()), float((x * x).sum(axis=1).max()), len(x)]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in found], ["largest", "square", "n"])

    found = own.mapInArrow(run, "largest double, square double, n bigint").agg(F.max("largest"), F.max("square"), F.sum("n")).first()
    space.largest, space.square, n = found
    rows = own.orderBy(F.xxhash64("id", "vector"), "id").limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
    _, sample = space.entries(rows)
    if not len(sample):  # the smallest hashes were all of rows that take no part
        space.pivots = np.zeros((1, length))
    else:
        space.pivots = spread_out(sample, space.square, pivots)
    space.deep = n > 4 * len(space.pivots) * BLOCK
    return space


def packed(own: DataFrame, space: Space, room: int, of_queries: bool) -> DataFrame:
    """One row per block of at most about ``room`` vectors of one cell, rows equal in id and vector once."""
    kind = space.kind

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = space.entries(batch.column(1))
            if len(rows):
                d = space.queries(x)[0] if of_queries else space.candidates(x)
                held = [v.tobytes() for v in x.astype(kind)]
                columns = [batch.column(0).take(pa.array(rows)), pa.array(held, pa.binary()), pa.array(space.cells(d).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "x", "cell"])

    placed = own.mapInArrow(cells, "id bigint, x binary, cell int")
    # as many counts as cells: the pivots squared at most
    parts = {c: -(-n // room) for c, n in placed.groupBy("cell").count().collect()}
    if not parts:
        return own.sparkSession.createDataFrame([], TABLE)
    most = own.sparkSession.createDataFrame(list(parts.items()), "cell int, parts bigint")
    part = F.pmod(F.xxhash64("id", "x"), F.col("parts"))
    placed = placed.join(F.broadcast(most), "cell").select("id", "x", "cell", F.expr("shiftleft(cast(cell as bigint), 32)").bitwiseOR(part).alias("block"))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(v.as_py() for v in rows["x"]), dtype=kind).reshape(len(rows), space.length)
        ids = rows["id"].to_numpy()
        order = np.lexsort([*x.T[::-1], ids])
        x, ids = x[order], ids[order]
        keep = np.concatenate([[True], (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(axis=1)])
        x, ids = x[keep], ids[keep]
        wide = x.astype(np.float64)
        d = (space.queries(wide)[0] if of_queries else space.candidates(wide)).astype(np.float32)
        row = {
            "block": key[0].as_py(), "cell": rows["cell"][0].as_py(), "n": len(ids), "ids": ids.astype(np.int64).tobytes(), "x": x.tobytes(),
            "d": d.tobytes(), "low": d.min(axis=0).astype(float).tolist(), "high": d.max(axis=0).astype(float).tolist(),
        }
        return pa.Table.from_pylist([row], schema=pa.schema([("block", pa.int64()), ("cell", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("x", pa.binary()), ("d", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]))

    return placed.groupBy("block").applyInArrow(pack, TABLE)


def products(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers; beyond 53 bits by Python's numbers."""
    if exact:
        return (x @ q).astype(np.int64)
    found = x.astype(object) @ q.astype(object)
    found = np.array([int(v) for v in found], dtype=object)
    if any(abs(v) >= 1 << 63 for v in found):
        raise OverflowError("a score is beyond 64 bits")
    return found.astype(np.int64)


class Block:
    """A packed row, unpacked."""

    def __init__(self, space: Space, row: dict):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        raw = np.frombuffer(row["x"], dtype=space.kind).reshape(len(self.ids), space.length)
        exact = dense_rows.fits(space.largest, space.length, 53)
        self.x = raw.astype(np.float64) if exact else np.array([[int(v) for v in r] for r in raw.tolist()], dtype=object)
        self.wide = raw.astype(np.float64)
        self.d = np.frombuffer(row["d"], dtype=np.float32).reshape(len(self.ids), -1)


def best_of(space: Space, queries: Block, block: Block, k: int, beat: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Per query with any: its place, the ids and scores of its best candidates here, and how many were evaluated.

    ``beat``: a score below which no candidate matters, minus infinity if none is known.
    """
    exact = dense_rows.fits(space.largest, space.length, 53)
    _, scales, squares = space.queries(queries.wide)
    slack = SLACK * np.sqrt(space.square) + 1e-9
    reach = np.where(np.isinf(beat), np.inf, np.sqrt(np.maximum(squares + space.square - 2 * scales * np.where(np.isinf(beat), 0, beat), 0)) + slack)
    table = np.ascontiguousarray(block.d.T)
    step = max(1, (1 << 19) // max(1, len(block.ids)))
    for first in range(0, len(queries.ids), step):
        own = queries.d[first : first + step]
        bound = np.zeros((len(own), len(block.ids)), dtype=np.float32)
        for p in range(table.shape[0]):
            np.maximum(bound, np.abs(own[:, p : p + 1] - table[p]), out=bound)
        for at in range(len(own)):
            q = first + at
            near = np.flatnonzero(bound[at] <= reach[q])
            near = near[block.ids[near] != queries.ids[q]]
            if not len(near):
                continue
            near = near[np.argsort(bound[at, near], kind="stable")]
            limit, seen = reach[q], 0
            ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            size = max(64, 4 * k)
            while seen < len(near) and bound[at, near[seen]] <= limit:
                some = near[seen : seen + size]
                found = products(block.x[some], queries.x[q], exact)
                good = found >= beat[q] if np.isfinite(beat[q]) else slice(None)
                ids, scores = np.concatenate([ids, block.ids[some][good]]), np.concatenate([scores, found[good]])
                if len(ids) > k:
                    kept = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[kept], scores[kept]
                if len(ids) >= k:
                    least = float(scores.min())
                    limit = min(limit, np.sqrt(max(squares[q] + space.square - 2 * scales[q] * least, 0)) + slack)
                seen, size = seen + size, 2 * size
            yield q, ids, scores, min(seen, len(near))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Fewer rows in an Arrow batch, for what is computed within."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


FOUND = "query_block bigint, reach double, beat binary, tops array<struct<query_id:bigint,place:int,vec_id:bigint,score:bigint>>, seen bigint"


def _evaluated(pairs: DataFrame, space: Space, k: int) -> DataFrame:
    """Rows of (query block ``q``, candidate block ``c`` or null) to FOUND: what each query finds there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("query_block", pa.int64()), ("reach", pa.float64()), ("beat", pa.binary()), ("tops", pa.list_(pa.struct([("query_id", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]))), ("seen", pa.int64())])
        for batch in batches:
            for row in range(batch.num_rows):
                q, c = (batch.column(i)[row].as_py() for i in (0, 1))
                queries = Block(space, q)
                beat = np.frombuffer(q["beat"]).copy() if q.get("beat") else np.full(len(queries.ids), -np.inf)
                tops, seen = [], 0
                for place, ids, scores, n in best_of(space, queries, Block(space, c), k, beat) if c else ():
                    own = int(queries.ids[place])
                    tops += [{"query_id": own, "place": place, "vec_id": i, "score": s} for i, s in zip(ids.tolist(), scores.tolist())]
                    seen += n
                    if len(ids) >= k:
                        beat[place] = max(beat[place], float(scores.min()))
                _, scales, squares = space.queries(queries.wide)
                far = np.inf if np.isinf(beat).any() else float((squares + space.square - 2 * scales * beat).max())
                out = {"query_block": q["block"], "reach": far, "beat": beat.tobytes(), "tops": tops, "seen": seen}
                yield pa.RecordBatch.from_pylist([out], schema=kinds)

    return pairs.select("q", "c").mapInArrow(run, FOUND)


def near_pairs(started: DataFrame, blocks: DataFrame, space: Space, count: int) -> DataFrame:
    """query_block, c_block: pairs of blocks near enough for one of their queries, but for those met before."""
    groups = -(-count // RANGES)
    ranges = blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("part"), "block", "low", "high")
    ranges = ranges.groupBy("part").agg(F.collect_list(F.struct("block", "low", "high")).alias("ranges"))
    asked = started.select("query_block", "home", "reach", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    slack = SLACK * np.sqrt(space.square) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own, home, reach, low, high, ranges = (batch.column(i)[row].as_py() for i in range(6))
                lows, highs = np.array([r["low"] for r in ranges]), np.array([r["high"] for r in ranges])
                gap = np.maximum(np.array(low) - highs, lows - np.array(high)).max(axis=1)
                near = (np.maximum(gap, 0) <= np.sqrt(max(reach, 0)) + 2 * slack) if np.isfinite(reach) else np.ones(len(gap), dtype=bool)
                found = [r["block"] for r, good in zip(ranges, near) if good and r["block"] != home]
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(found), pa.int64()), pa.array(found, pa.int64())], ["query_block", "c_block"])

    joined = asked.join(ranges, "part").select("query_block", "home", "reach", "low", "high", "ranges")
    return joined.mapInArrow(run, "query_block bigint, c_block bigint")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, pivots: int = PIVOTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products of every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows with another id;
    equal scores go by the smaller id. Fewer candidates give fewer rows. Null and empty vectors,
    vectors with a null or non-finite entry, vectors of another than the most frequent length (the
    smaller of equally frequent ones) and rows without an id take no part. Rows equal in id and
    vector count once; of an id with different vectors, each is a query and a candidate of its own.
    An empty table gives no rows. Other columns are not read. A score beyond 64 bits is an error.
    """
    spark = vectors.sparkSession
    own = _own(vectors, id_column, vector_column)
    space = space_of(own, scale, pivots)
    if not space.length:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = written(packed(own, space, BLOCK, False), "blocks")
    asking = written(packed(own.where(F.col("id") % every == 0), space, QUERY_BLOCK, True), "queries")
    whole = lambda frame, name: F.struct(*[F.col(f"{frame}.{c}") for c in ("block", "n", "ids", "x", "d")]).alias(name)
    count = blocks.count()
    with arrow_rows(spark, PAIRS):
        # a block of the same cell, the same for the same block of queries
        homes = blocks.groupBy("cell").agg(F.array_sort(F.collect_list("block")).alias("own"))
        homed = asking.join(homes, "cell", "left").withColumn("home", F.expr("get(own, cast(block & 4294967295 as int) % size(own))"))
        first = homed.alias("a").join(blocks.alias("b"), F.col("a.home") == F.col("b.block"), "left")
        first = first.select(whole("a", "q"), F.when(F.col("b.block").isNotNull(), whole("b", "c")).alias("c"))
        started = written(_evaluated(first, space, k), "started")
        reached = started.join(homed.select(F.col("block").alias("query_block"), "home", "low", "high"), "query_block")
        pairs = near_pairs(reached, blocks, space, count)
        held = asking.alias("a").join(started.select("query_block", "beat").alias("s"), F.col("a.block") == F.col("s.query_block"))
        held = held.select(F.col("query_block"), F.struct(*[F.col(f"a.{c}") for c in ("block", "n", "ids", "x", "d")], F.col("s.beat")).alias("q"))
        second = pairs.join(held, "query_block").join(blocks.alias("b"), F.col("c_block") == F.col("b.block"))
        rest = written(_evaluated(second.select("q", whole("b", "c")), space, k), "rest")
    tops = started.select("query_block", "tops").unionByName(rest.select("query_block", "tops"))
    tops = tops.select("query_block", F.explode("tops").alias("t")).select("query_block", "t.*")
    order = Window.partitionBy("query_block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
