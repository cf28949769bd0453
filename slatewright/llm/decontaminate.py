"""Benchmark passages in documents by a prefix-filtered set join on word shingles.

A window is so many consecutive words of an item, or a shorter item whole. Its record is the
set of its shingles (``SHINGLE`` words, or one word in windows too short for that). All shingles
of benchmark windows are counted over all documents and ordered by rarity. Whoever contains a
window whole contains every shingle of it, so the necessary prefix is its rarest shingle alone:
only documents that hold it are looked at. The shingle's place in the window bounds where the
window must begin and end (position and length); what is left is compared word by word.

Windows are handled in blocks of at most ``block`` windows, so what tasks are sent has a fixed
bound however many items there are; every block is matched against all documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatewright.llm import textbytes as tb
from slatewright.session import written

SHINGLE = 3
WINDOW = 10
BLOCK_WINDOWS = 100_000


def item_windows(items: DataFrame, window: int, item_column: str = "item_id") -> DataFrame:
    """item_id, words (array): every window of every item. Items without words or id have none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate("text", upper, upper.lower())
    split = F.filter(F.split(lower, "[^0-9a-z\\x{80}-\\x{10FFFF}]+"), lambda w: w != "")
    with_words = items.where(F.col(item_column).isNotNull()).select(
        F.col(item_column).alias("item_id"), F.coalesce(split, F.array().cast("array<string>")).alias("all")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))
    return (
        with_words.where(F.size("all") > 0)
        .select("item_id", "all", F.explode(starts).alias("start"))
        .select("item_id", F.slice("all", F.col("start"), F.lit(window)).alias("words"))
        .distinct()
    )


class Windows:
    """The windows of one block, as the arrays a task searches."""

    def __init__(self, rows: list[tuple]):
        grouped: dict[tuple, set] = {}
        for item, words in rows:
            grouped.setdefault(tuple(words), set()).add(str(item))
        self.words = list(grouped)
        self.items = [sorted(grouped[w]) for w in self.words]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        flat = tb.text_hashes([w for words in self.words for w in words])
        firsts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.hashes = [flat[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
        self.widths = np.where(self.sizes >= SHINGLE, SHINGLE, 1)
        self.shingles = [tb.run_hashes(h, w) for h, w in zip(self.hashes, self.widths)]

    def all_shingles(self, width: int) -> np.ndarray:
        own = [s for s, w in zip(self.shingles, self.widths) if w == width]
        return np.unique(np.concatenate(own)) if own else np.zeros(0, dtype=np.uint64)

    def prefixes(self, counts: dict[int, dict[int, int]]) -> dict[int, "Prefixes"]:
        """For each shingle width, the windows by their rarest shingle."""
        chosen: dict[int, list] = {}
        for w, (shingles, width) in enumerate(zip(self.shingles, self.widths)):
            known = counts.get(int(width), {})
            offset = min(range(len(shingles)), key=lambda k: (known.get(int(shingles[k]), 0), k))
            chosen.setdefault(int(width), []).append((int(shingles[offset]), w, offset))
        return {width: Prefixes(rows) for width, rows in chosen.items()}


class Prefixes:
    """Prefix shingles in order, each with its windows and its place in them."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        keys = np.array([r[0] for r in rows], dtype=np.uint64)
        self.windows = np.array([r[1] for r in rows], dtype=np.int64)
        self.offsets = np.array([r[2] for r in rows], dtype=np.int64)
        self.keys, self.first = np.unique(keys, return_index=True)
        self.count = np.diff(np.append(self.first, len(keys)))
        self.seen = screen(self.keys)


def screen(keys: np.ndarray) -> np.ndarray:
    """A table of the keys' low bits that tells most other values apart."""
    table = np.zeros(1 << 18, dtype=bool)
    table[(keys & np.uint64(0x3FFFF)).astype(np.int64)] = True
    return table


def places(keys: np.ndarray, seen: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``values`` a key stands, and which key."""
    at = np.flatnonzero(seen[(values & np.uint64(0x3FFFF)).astype(np.int64)])
    found = np.searchsorted(keys, values[at])
    ok = found < len(keys)
    ok[ok] = keys[found[ok]] == values[at][ok]
    return at[ok], found[ok]


def _texts(batches: Iterator[pa.RecordBatch], column: int):
    """Per block of texts: batch, rows, lower-cased bytes, word starts, ends, hashes and texts' first words."""
    for batch in batches:
        for row, stop, data, offsets in tb.blocks(batch.column(column)):
            data = tb.LOWER[data]
            starts, ends, first = tb.words(data, offsets, tb.ALNUM)
            yield batch, row, stop, data, starts, ends, tb.range_hashes(data, starts, ends), first


def shingle_counts(docs: DataFrame, shingles: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """How often each benchmark shingle stands in the documents, by width; as many rows as shingles."""
    sent = docs.sparkSession.sparkContext.broadcast({w: (k, screen(k)) for w, k in shingles.items() if len(k)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {w: np.zeros(len(k), dtype=np.int64) for w, (k, _) in sent.value.items()}
        for _, _, _, _, _, _, hashes, _ in _texts(batches, 0):
            for w, (keys, seen) in sent.value.items():
                _, found = places(keys, seen, tb.run_hashes(hashes, w))
                sums[w] += np.bincount(found, minlength=len(keys))
        for w, n in sums.items():
            some = np.flatnonzero(n)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), w)), pa.array(some), pa.array(n[some])], ["width", "key", "n"]
                )

    rows = docs.select("text").mapInArrow(run, "width bigint, key bigint, n bigint")
    out: dict[int, dict[int, int]] = {}
    for width, key, n in rows.groupBy("width", "key").agg(F.sum("n")).collect():
        out.setdefault(width, {})[int(shingles[width][key])] = n
    return out


def hits_of(windows: Windows, prefixes: dict[int, Prefixes], block: tuple) -> list[tuple[int, int]]:
    """(first word, window) of every occurrence in one block of texts, as word numbers of the block."""
    _, _, _, data, starts, ends, hashes, first = block
    out = []
    for width, index in prefixes.items():
        at, key = places(index.keys, index.seen, tb.run_hashes(hashes, width))
        if not len(at):
            continue
        reps = index.count[key]
        entry = np.repeat(index.first[key], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        window, begin = index.windows[entry], np.repeat(at, reps) - index.offsets[entry]
        # the shingle's text must hold the whole window
        text = np.searchsorted(first, np.repeat(at, reps), "right") - 1
        fits = (begin >= first[text]) & (begin + windows.sizes[window] <= first[text + 1])
        for b, w in zip(begin[fits].tolist(), window[fits].tolist()):
            n = len(windows.words[w])
            if not np.array_equal(hashes[b : b + n], windows.hashes[w]):
                continue
            if all(data[starts[b + k] : ends[b + k]].tobytes().decode() == x for k, x in enumerate(windows.words[w])):
                out.append((b, w))
    return out


def benchmark_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", block: int = BLOCK_WINDOWS
) -> DataFrame:
    """id, n_words, hit (array of [start, end) word ranges, merged), items (sorted distinct ids as text).

    One row per document. Null and empty texts have no words and no hits; items without words
    are ignored, repeated items count once by id; without items nothing is hit.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType
    texts = docs.select(F.col(id_column).alias("id"), "text")
    numbered = written(item_windows(items, window).withColumn("block", F.xxhash64("words")), "windows")
    n_blocks = max(1, -(-numbered.count() // block))
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("n_words", T.LongType()),
            T.StructField("hit", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    with_text = T.StructType([*schema.fields, T.StructField("text", T.StringType())])
    found = texts.select("id", "text", F.array().cast("array<array<bigint>>").alias("hit"), F.array().cast("array<string>").alias("items"))
    for b in range(n_blocks):
        mine = numbered.where(F.pmod("block", F.lit(n_blocks)) == b).select("item_id", "words")
        windows = Windows([tuple(r) for r in mine.toLocalIterator()])
        counts = shingle_counts(texts, {w: windows.all_shingles(w) for w in (1, SHINGLE)})
        sent = spark.sparkContext.broadcast(cloudpickle.dumps((windows, windows.prefixes(counts))))
        last = b == n_blocks - 1
        found = found.select("id", "text", "hit", "items").mapInArrow(_finder(sent, last), schema if last else with_text)
    return found


def _finder(sent, last: bool):
    """Add one block's hits to those that each document has from earlier blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, prefixes = pickle.loads(sent.value)
        for block in _texts(batches, 1):
            batch, row, stop, first = block[0], block[1], block[2], block[7]
            ranges, names = batch.column(2)[row:stop].to_pylist(), batch.column(3)[row:stop].to_pylist()
            hits = hits_of(windows, prefixes, block)
            texts = np.searchsorted(first, [h[0] for h in hits], "right") - 1
            for text, (begin, w) in zip(texts.tolist(), hits):
                begin -= int(first[text])
                ranges[text].append([begin, begin + len(windows.words[w])])
                names[text] += windows.items[w]
            for text in set(texts.tolist()):
                ranges[text], names[text] = merged(ranges[text]), sorted(set(names[text]))
            columns = [
                batch.column(0)[row:stop],
                pa.array(np.diff(first)),
                pa.array(ranges, pa.list_(pa.list_(pa.int64()))),
                pa.array(names, pa.list_(pa.string())),
            ]
            if not last:
                columns.append(batch.column(1)[row:stop])
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "hit", "items", "text"][: len(columns)])

    return run


def merged(ranges: list[list[int]]) -> list[list[int]]:
    """The same words as ranges that neither touch nor overlap, in order."""
    out: list[list[int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([begin, end])
    return out


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column: str = "doc_id", block: int = BLOCK_WINDOWS
) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated: the hits of each document in figures."""
    found = benchmark_hits(docs, items, window, id_column, block)
    n_hit = F.aggregate("hit", F.lit(0).cast("bigint"), lambda s, r: s + r[1] - r[0])
    return found.select(
        "id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )

