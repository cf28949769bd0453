"""Phrases whose words stand together more often than apart, by frequent n-grams and exact counts.

1. The n-grams of every text get 64-bit hashes, whose leading bits name one of the hash
   partitions. One pass adds up the mass (occurrences) of every partition.
2. Tasks fold their n-grams into Misra-Gries summaries, one per partition; the summaries of a
   partition are merged. A summary holds more counters than mass divided by threshold, so what
   merging takes off any count stays below the threshold, and every n-gram as frequent as the
   threshold keeps a counter.
3. The survivors become a bitmap of fixed size, with a stretch of its own for every partition. A
   second pass over the texts counts the n-grams that the bitmap lets through by their words, again
   by partition. A bit set by another n-gram costs a row in that count; it changes no result.
4. Scores, coverage by longer phrases and ranks are joins and windows over the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slatewright.llm import textbytes as tb
from slatewright.session import written

#: occurrences a partition is sized for, n-grams a task holds, phrases a task holds
PARTITION_MASS = 1 << 23
ROOM = 1 << 22
PHRASES = 1 << 20
#: bits of the map of survivors: 2**22 for each partition, 2**28 (32 MB) at most whatever the input
PART_BITS, FILTER_BITS = 22, 28

_BYTES = np.arange(256)
SEPARATOR = np.isin(_BYTES, [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
WORD = ~SEPARATOR & ~np.isin(_BYTES, [32, 9])


class Grams:
    """The n-grams of a block of texts: bytes of its words with one space after each, and hashes by language."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, codes: np.ndarray):
        """``langs``: hash of each language; ``codes``: each text's language."""
        data = tb.LOWER[data]
        starts, ends, first = tb.words(data, offsets, WORD)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.codes, self.langs = codes, langs
        cuts = np.concatenate([[0], np.cumsum(SEPARATOR[data])])
        self.piece = cuts[starts]
        size = ends - starts + 1
        self.ends = np.cumsum(size) - 1
        self.starts = self.ends - size + 1
        self.data = np.full(int(size.sum()), 32, dtype=np.uint8)
        at = np.arange(len(self.data)) + np.repeat(starts - self.starts, size)
        keep = np.ones(len(self.data), dtype=bool)
        keep[self.ends] = False
        self.data[keep] = data[at[keep]]

    def of(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of each n-gram within a piece, and the n-grams' hashes."""
        n = max(0, len(self.starts) - width + 1)
        last = slice(width - 1, width - 1 + n)
        at = np.flatnonzero((self.piece[:n] == self.piece[last]) & (self.text[:n] == self.text[last]))
        hashes = tb.range_hashes(self.data, self.starts[at], self.ends[at + width - 1])
        return at, tb.mix(hashes + self.langs[self.codes[self.text[at]]])

    def phrases(self, at: np.ndarray, width: np.ndarray) -> pa.Array:
        """The n-grams that start at the words ``at`` as strings."""
        begin, size = self.starts[at], self.ends[at + width - 1] - self.starts[at]
        bounds = np.concatenate([[0], np.cumsum(size)])
        held = self.data[np.arange(bounds[-1]) + np.repeat(begin - bounds[:-1], size)]
        offsets = pa.py_buffer(bounds.astype(np.int64))
        return pa.LargeStringArray.from_buffers(len(at), offsets, pa.py_buffer(np.ascontiguousarray(held)))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[Grams, list[str]]]:
    """Blocks of a batch of (lang, text), with the batch's languages."""
    found = batch.column(0).fill_null("und").dictionary_encode()
    names, codes = found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False)
    langs = tb.mix(tb.text_hashes(names) + np.uint64(1))  # a word may be spelled as a language is
    for row, stop, data, offsets in tb.blocks(batch.column(1)):
        yield Grams(data, offsets, langs, codes[row:stop]), names


def _lang_and_text(docs: DataFrame) -> DataFrame:
    return docs.select("lang", "text")


def partition_bits(docs: DataFrame, widths: int) -> int:
    """Leading hash bits that name a partition, so that one is expected to get about ``PARTITION_MASS``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(24, max(0, (widths * size // (6 * PARTITION_MASS)).bit_length()))


def masses(docs: DataFrame, widths: int, bits: int) -> DataFrame:
    """part, mass: the occurrences of all n-grams of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for grams, _ in _blocks(batch):
                for width in range(1, widths + 1):
                    total += np.bincount(_part(grams.of(width)[1], bits), minlength=1 << bits)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["part", "mass"])

    found = _lang_and_text(docs).mapInArrow(run, "part int, mass bigint")
    return found.groupBy("part").agg(F.sum("mass").alias("mass"))


def _part(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of an ordered array begins."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _tallied(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their counts."""
    if not len(keys):
        return keys, counts
    if counts.max() < 1 << 32:  # key and count side by side sort in place
        both = keys.astype(np.uint64)
        both <<= np.uint64(32)
        both |= counts.astype(np.uint64)
        both.sort()
        keys = (both >> np.uint64(32)).astype(np.uint32)
        both &= np.uint64(0xFFFFFFFF)
        counts = both.view(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(counts, first)


def _thin(keys: np.ndarray) -> bytes:
    """Ordered keys as steps, the low bytes of all first: the high ones, mostly zero, compress."""
    steps = np.diff(keys, prepend=np.zeros(1, dtype=np.uint32))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _wide(held: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(held, dtype=np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters; merging keeps its guarantee.

    Every merge that would leave more counters takes the largest surplus count off all. What was
    taken off, ``lost``, is at most the mass divided by capacity + 1, so a key that occurs more
    often than that has a counter, and its count is short by at most ``lost``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, lost: int = 0) -> None:
        """Take in another summary, or several: a key may repeat."""
        self.keys, self.counts = _tallied(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.lost += lost
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            kept = self.counts > off
            self.keys, self.counts, self.lost = self.keys[kept], self.counts[kept] - off, self.lost + off

    def frequent(self, threshold: int) -> np.ndarray:
        """All keys that may occur ``threshold`` times, those that do among them."""
        return self.keys[self.counts + self.lost >= threshold]


def summaries(docs: DataFrame, widths: int, bits: int) -> DataFrame:
    """part, keys, counts: what a task has seen of a partition, as often as its room is full; nothing is lost yet.

    A key is the 32 hash bits after the partition's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def folded() -> pa.RecordBatch:
            keys = np.concatenate(held)
            held.clear()
            keys >>= np.uint64(32 - bits)
            keys.sort()
            first = _firsts(keys)
            counts = np.diff(first, append=len(keys)).astype(np.uint32)
            keys = keys[first]
            part = (keys >> np.uint64(32)).astype(np.int32)
            keys = keys.astype(np.uint32)
            bounds = _firsts(part)
            spans = list(zip(bounds.tolist(), [*bounds[1:].tolist(), len(keys)]))
            rows = [
                pa.array(part[bounds]),
                pa.array([_thin(keys[a:b]) for a, b in spans], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(rows, ["part", "keys", "counts"])

        for batch in batches:
            for grams, _ in _blocks(batch):
                held += [grams.of(width)[1] for width in range(1, widths + 1)]
                if sum(map(len, held)) >= ROOM:
                    yield folded()
        if held:
            yield folded()

    return _lang_and_text(docs).mapInArrow(run, "part int, keys binary, counts binary")


def survivors(docs: DataFrame, widths: int, threshold: int) -> tuple[int, int, np.ndarray]:
    """Hash bits that name a partition, bits that find a place in its stretch, and the bitmap of every
    n-gram that may occur ``threshold`` times."""
    bits = partition_bits(docs, widths)
    own = min(PART_BITS, FILTER_BITS - bits)  # leading bits of a key that find its place in the partition's stretch

    def run(parts: pa.Table, mass: pa.Table) -> pa.Table:
        summary = Summary(sum(mass["mass"].to_pylist()) // threshold + 1)
        waiting, size = [], 0
        for row, (keys, counts) in enumerate(zip(parts["keys"], parts["counts"])):
            waiting.append((_wide(keys.as_py()), np.frombuffer(counts.as_py(), dtype=np.uint32).astype(np.int64)))
            size += len(waiting[-1][0])
            if size >= max(len(summary.keys), 1 << 20) or row == len(parts) - 1:
                summary.merge(*(np.concatenate(x) for x in zip(*waiting)))
                waiting, size = [], 0
        place = summary.frequent(threshold) >> np.uint32(32 - own)
        flags = np.zeros((1 << own) // 8, dtype=np.uint8)
        np.bitwise_or.at(flags, place >> np.uint32(3), np.uint8(128) >> (place & np.uint32(7)).astype(np.uint8))
        return pa.table({"part": mass["part"].slice(0, 1), "bits": pa.array([flags.tobytes()], pa.binary())})

    mass = masses(docs, widths, bits)
    found = summaries(docs, widths, bits).groupBy("part").cogroup(mass.groupBy("part")).applyInArrow(run, "part int, bits binary")
    bitmap = np.zeros((1 << bits, (1 << own) // 8), dtype=np.uint8)
    for part, some in found.collect():  # together as large as the bitmap
        bitmap[part] = np.frombuffer(some, dtype=np.uint8)
    return bits, own, bitmap.ravel()


class Tally:
    """In a task: phrases by their hash, as keys (language, line feed, phrase), and their counts."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.hashes, self.rows = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)  # in order of arrival, as the keys
        self.keys: list[pa.Array] = []
        self.arrived: list[np.ndarray] = []  # the hashes in order of arrival

    def add(self, grams: Grams, names: list[str], at: np.ndarray, width: np.ndarray, hashes: np.ndarray) -> None:
        hashes, first, counts = np.unique(hashes, return_index=True, return_counts=True)
        place = np.searchsorted(self.hashes, hashes)
        held = np.zeros(len(hashes), dtype=bool)
        if len(self.hashes):
            held = self.hashes[np.minimum(place, len(self.hashes) - 1)] == hashes
        self.counts[self.rows[place[held]]] += counts[held]
        new = first[~held]
        rows = len(self.counts) + np.arange(len(new))
        self.hashes, self.rows = np.insert(self.hashes, place[~held], hashes[~held]), np.insert(self.rows, place[~held], rows)
        self.counts = np.concatenate([self.counts, counts[~held]])
        self.arrived.append(hashes[~held])
        langs = pa.array(names, pa.large_string()).take(pa.array(grams.codes[grams.text[at[new]]]))
        self.keys.append(pc.binary_join_element_wise(langs, grams.phrases(at[new], width[new]), pa.scalar("\n", pa.large_string())))

    def flushed(self, bits: int, totals: dict[str, int]) -> pa.RecordBatch:
        """part, held: the phrases of each hash partition in order, with their counts, as a compressed Arrow stream."""
        keys = [*self.keys, pa.array([f"{k}\n" for k in totals], pa.large_string())]
        keys, counts = pa.concat_arrays(keys), np.concatenate([self.counts, list(totals.values())]).astype(np.int64)
        part = np.concatenate([*[_part(h, bits) for h in self.arrived], np.zeros(len(totals), dtype=np.int64)])
        self.clear()
        order = np.argsort(part, kind="stable")
        bounds = _firsts(part[order])
        held = []
        for rows in np.split(order, bounds[1:]) if len(order) else []:
            own = pa.table({"key": keys.take(pa.array(rows)), "n": counts[rows]}).sort_by("key")
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(own.combine_chunks())
            held.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(part[order][bounds].astype(np.int32)), pa.array(held, pa.binary())], ["part", "held"])


def frequent_phrases(docs: DataFrame, widths: int = 3, threshold: int = 10) -> DataFrame:
    """key, n: every phrase of up to ``widths`` words that occurs ``threshold`` times, with its exact count.

    A key is the language, a line feed and the phrase. Besides, one row per language has an empty
    phrase and the number of all its words.
    """
    bits, own, bitmap = survivors(docs, widths, threshold)
    shift = np.uint64(64 - bits - own)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, tally, totals = sent.value, Tally(), {}
        for batch in batches:
            for grams, names in _blocks(batch):
                for code, n in enumerate(np.bincount(grams.codes[grams.text], minlength=len(names)).tolist()):
                    totals[names[code]] = totals.get(names[code], 0) + n
                found = []
                for width in range(1, widths + 1):
                    at, hashes = grams.of(width)
                    place = hashes >> shift
                    passed = (flags[place >> np.uint64(3)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
                    found.append((at[passed], np.full(int(passed.sum()), width), hashes[passed]))
                tally.add(grams, names, *(np.concatenate(x) for x in zip(*found)))
                if len(tally.counts) > PHRASES:
                    yield tally.flushed(bits, {})
        yield tally.flushed(bits, {k: n for k, n in totals.items() if n})

    def counted(parts: pa.Table) -> pa.Table:
        rows = pa.concat_tables([pa.ipc.open_stream(held.as_py()).read_all() for held in parts["held"]])
        rows = rows.group_by("key").aggregate([("n", "sum")])
        rows = rows.filter(pc.or_(pc.greater_equal(rows["n_sum"], threshold), pc.ends_with(rows["key"], "\n")))
        return pa.table({"key": rows["key"].cast(pa.string()), "n": rows["n_sum"]})

    tallied = _lang_and_text(docs).mapInArrow(run, "part int, held binary")
    kept = written(tallied.groupBy("part").applyInArrow(counted, "key string, n bigint"), "phrases")
    sent.destroy()
    return kept


#: of a key: its phrase (a phrase has no line feed), and its language with the line feed
_PHRASE = r"substring_index(key, '\n', -1)"
_LANG = f"left(key, length(key) - length({_PHRASE}))"


def _uncovered(candidates: DataFrame, covered: int) -> DataFrame:
    """Candidates that no longer one holds which is ``covered`` percent as frequent or more."""
    longer = candidates.where("words > 2").select("lang", "a", "words", F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    longer = longer.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("start"))
    longer = longer.select(F.expr("concat(lang, array_join(slice(w, start, size), ' '))").alias("key"), "a")
    most = longer.groupBy("key").agg(F.max("a").alias("longer"))
    kept = candidates.select("key", "a").join(most, "key", "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))).select("key", "a")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """key, a, l, r, score of the lowest-scoring cut, the earliest of equal ones."""
    words = f"size(split({_PHRASE}, ' '))"
    cut = candidates.select("key", "a", F.explode(F.expr(f"sequence(1, {words} - 1)")).alias("k"))
    head = f"substring_index({_PHRASE}, ' ', k)"
    cut = cut.select("key", "a", "k", F.expr(f"concat({_LANG}, {head})").alias("head"))
    part = lambda name, n: counts.select(F.col("key").alias(name), F.col("n").alias(n))
    cut = cut.join(part("head", "l"), "head")
    cut = cut.select("key", "a", "k", "l", F.expr(f"concat({_LANG}, substring(key, length(head) + 2))").alias("tail"))
    cut = cut.join(part("tail", "r"), "tail")
    # within 38 digits: counts of up to 15 digits
    whole = "cast({} as decimal(16,0))"
    score = f"(1000000BD * ({whole.format('a')} * {whole.format('a')})) div ({whole.format('l')} * {whole.format('r')})"
    best = cut.groupBy("key").agg(F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r", "a")).alias("least"))
    return best.select("key", "least.a", "least.l", "least.r", "least.score")


def collocations(docs: DataFrame, widths: int = 3, threshold: int = 10, covered: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``widths`` words.

    A phrase occurs ``a`` times, at least ``threshold``; l and r are the counts of the parts at its
    lowest-scoring cut, n the language's words, score floor(1000000 a a / (l r)). A phrase goes if
    a longer one holds it and is ``covered`` percent as frequent or more. Ranks follow score and a,
    falling, then the phrase's bytes. Words are cut at spaces and tabs, within pieces that end at
    ``.,;:!?`` and line ends; A-Z are lower-cased. A null language is ``und``. Null and empty texts
    have no words; repeated rows all count; a language without words, and an empty table, give no
    rows. Columns but lang and text are not read.
    """
    counts = frequent_phrases(docs, widths, threshold)
    split = counts.select("key", F.col("n").alias("a"), F.expr(_PHRASE).alias("phrase"), F.expr(_LANG).alias("lang"))
    candidates = split.where("phrase like '% %'").withColumn("words", F.size(F.split("phrase", " ")))
    ranked = _scored(_uncovered(candidates, covered), counts)
    lang = F.expr(f"left({_LANG}, length({_LANG}) - 1)").alias("lang")
    ranked = ranked.select(lang, F.expr(_PHRASE).alias("phrase"), "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    totals = counts.where(F.col("key").endswith("\n")).select(lang, "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
