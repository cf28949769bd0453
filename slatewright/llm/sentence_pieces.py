"""SentencePiece encoding and decoding as a relational lattice.

1. Tasks cut texts into units that no piece of the model crosses (a word with the white space
   before it, a run of other characters) and count them. Only distinct units are encoded.
2. Lattice: each unit is exploded into its substrings up to the longest piece, these are equi-joined
   to the piece table (of the model's size, a bounded broadcast), and the edges are grouped by unit.
3. Fold over the edges, which gives the pieces of each unit. For a unigram model that is Viterbi,
   a higher-order aggregate. For a BPE model, whose result is not the best path but the outcome of
   its merges, each step joins in every unit the neighbouring pieces that make the highest-scored
   piece; tasks do that for many units at a time. Characters outside the model become their bytes.
4. Texts get their units' ids: the most frequent units, at most ``HEAD`` and ``HEAD_BYTES``, travel
   to the tasks; the rest are joined by unit. Units longer than ``LONGEST`` characters go to the
   library in the task, as a lattice fold grows with the square of a unit. No text is shuffled, but
   the numbers of its units, compressed: its frequent ones by rank, its rare ones by their place
   among its own.
5. Decoding joins the pieces' bytes, turns space marks into spaces and drops the leading one; the
   round trip compares length and hash of that with those of the whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatewright.llm import textbytes as tb
from slatewright.session import bucketed

HEAD, HEAD_BYTES = 400_000, 24 << 20
UNITS = 400_000  # that a task counts before it hands them on
FOLDED = 8192  # units folded at a time
LONGEST = 96
SPACE = "▁"
IDS = 1 << 17  # more than a model has ids

# letters; a line feed; other characters; white space at the end
FINE = rf"{SPACE}*+(?:\p{{L}}++|\n|[^\p{{L}}{SPACE}\n]++)|{SPACE}++"
COARSE = rf"{SPACE}*+[^{SPACE}]++|{SPACE}++"


@dataclass
class Model:
    """What the operator needs of a model file: pieces with score order, byte ids, kind and unit cut."""

    data: bytes
    pieces: list[tuple[str, int, int, float]]  # text, id, order (higher merges first), score
    surfaces: list[bytes]  # of every id
    byte_ids: list[int]
    units: str
    kind: str = "bpe"


def load_model(path: str, kind: str = "bpe") -> Model:
    """Read a model with byte fallback and without normalisation beyond the space mark."""
    import regex
    import sentencepiece

    with open(path, "rb") as f:
        data = f.read()
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = range(own.get_piece_size())
    special = [own.is_control(i) or own.is_unknown(i) for i in ids]
    scores = sorted({own.get_score(i) for i in ids})
    order = {s: k for k, s in enumerate(scores)}
    pieces, surfaces = [], []
    for i in ids:
        piece = own.id_to_piece(i)
        if own.is_byte(i):
            surfaces.append(bytes([int(piece[3:5], 16)]))
        elif special[i]:
            surfaces.append(b"")
        else:
            surfaces.append(piece.encode())
            pieces.append((piece, i, order[own.get_score(i)], own.get_score(i)))
    byte_ids = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    fine = regex.compile(FINE)
    units = FINE if all(fine.fullmatch(p) for p, *_ in pieces) else COARSE
    return Model(data, pieces, surfaces, byte_ids, units, kind)


def packed_units(units: pa.Array | list[str], counts: np.ndarray | list[int]) -> tuple[int, bytes]:
    """Units and their counts as bytes: the size, and the bytes compressed."""
    held = pa.array(units, pa.string()) if isinstance(units, list) else units
    lengths = pc.binary_length(held).to_numpy(zero_copy_only=False)
    numbers = np.concatenate([[len(held)], lengths]).astype("<u4"), np.asarray(counts, dtype="<i8")
    data = b"".join([*(x.tobytes() for x in numbers), flat(held)[0].tobytes()])
    return len(data), pa.Codec("zstd").compress(data, asbytes=True)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, none of them null, and their offsets."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    if not len(texts) or held is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def unpacked_units(size: int, packed: bytes) -> pa.Table:
    """unit, n of :func:`packed_units`."""
    data = pa.Codec("zstd").decompress(packed, size, asbytes=True)
    n = int(np.frombuffer(data, dtype="<u4", count=1)[0])
    lengths = np.frombuffer(data, dtype="<u4", count=n, offset=4)
    counts = np.frombuffer(data, dtype="<i8", count=n, offset=4 * (n + 1)).copy()
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    units = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data[4 * (n + 1) + 8 * n :]))
    return pa.table({"unit": units, "n": pa.array(counts)})


def unit_counts(docs: DataFrame, model: Model) -> DataFrame:
    """unit, n: the distinct units of all texts, those beyond ``LONGEST`` characters left out.

    The tasks' counts travel packed, in as many buckets as there are shuffle partitions.
    """
    pattern, parts = model.units, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, odd, even = Cutter(pattern), Counter(), UnitTally()

        def held() -> pa.RecordBatch:
            units, counts = even.emptied()
            if odd:
                units = pa.concat_arrays([units, pa.array(odd, pa.string())])
                counts = np.concatenate([counts, np.fromiter(odd.values(), np.int64, len(odd))])
                odd.clear()
            short = np.flatnonzero(pc.less_equal(pc.utf8_length(units), LONGEST).to_numpy(zero_copy_only=False))
            units = units.take(pa.array(short))
            order = pc.sort_indices(units)  # in order, they compress better
            units, counts = units.take(order), counts[short][order.to_numpy()]
            data, offsets = flat(units)
            bucket = (tb.range_hashes(data, offsets[:-1], offsets[1:]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            units, counts, bucket = units.take(pa.array(order)), counts[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist() if len(bucket) else []
            packs = [packed_units(units[a:b], counts[a:b]) for a, b in zip(at[:-1], at[1:])]
            numbers = [pa.array(bucket[at[:-1]], pa.int32()), pa.array([n for n, _ in packs], pa.int64())]
            return pa.RecordBatch.from_arrays([*numbers, pa.array([x for _, x in packs], pa.binary())], ["bucket", "size", "packed"])

        for batch in batches:
            for row, stop, data, offsets in tb.blocks(batch.column(0)):
                slow, (starts, ends, _, text, spaces, keys) = cutter.block(data, offsets, batch.column(0)[row:stop].to_pylist())
                for found in slow.values():
                    odd.update(found)
                fast = np.flatnonzero(~np.isin(text, list(slow))) if slow else np.arange(len(text))
                even.add(data, starts[fast], ends[fast], spaces[fast], keys[fast])
                if len(odd) + len(even) > UNITS:
                    yield held()
        yield held()

    def merged(rows: pa.Table) -> pa.Table:
        own = pa.concat_tables([unpacked_units(n, x) for n, x in zip(rows["size"].to_pylist(), rows["packed"].to_pylist())])
        return own.group_by("unit").aggregate([("n", "sum")]).rename_columns(["unit", "n"]).sort_by("unit")

    found = docs.select("text").mapInArrow(run, "bucket int, size bigint, packed binary")
    # in order, they compress better
    return found.groupBy("bucket").applyInArrow(merged, "unit string, n bigint").repartition(parts, "unit")


def lattice(units: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """unit, n, edges: all pieces at all places of each unit, each packed into one number (see ``packed``).

    Besides, each unit has the empty piece at its start, so that units without any piece stay.
    """
    starts = units.select("unit", "n", F.explode(F.expr("sequence(0, length(unit) - 1)")).alias("start"))
    # no piece that begins with these four characters is longer than `reach`
    reach = pieces.where("length(piece) > 3").groupBy(F.substring("piece", 1, 4).alias("four"))
    reach = reach.agg(F.least(F.lit(longest), F.max(F.length("piece"))).alias("reach"))
    ahead = F.xxhash64(F.expr("substring(unit, start + 1, 4)"))
    bounded = starts.join(F.broadcast(reach.select(F.xxhash64("four").alias("own"), "reach")), ahead == F.col("own"), "left")
    sizes = F.expr("sequence(if(start = 0, 0, 1), least(coalesce(reach, 3), length(unit) - start))")
    spans = bounded.select("unit", "n", "start", F.explode(sizes).alias("size"))
    spread = spans.select("unit", "n", "start", "size", F.expr("substring(unit, start + 1, size)").alias("piece"))
    # a hash of the text finds the piece, the text itself confirms it
    table = pieces.select(F.xxhash64("piece").alias("own"), F.col("piece").alias("text"), F.length("piece").alias("chars"), "code")
    same = F.startswith("text", "piece") & (F.col("chars") <= F.col("size"))  # no second key, which would cost more
    joined = spread.join(F.broadcast(table), (F.xxhash64("piece") == F.col("own")) & same)
    return joined.groupBy("unit").agg(F.collect_list(packed("code", "start", "size")).alias("edges"), F.first("n").alias("n"))


def packed(code: str, start: str, size: str) -> F.Column:
    """A piece's code (its order and id) times 2**14, and its span: start times 128 plus end."""
    return F.expr(f"{code} * 16384 + {start} * 128 + {start} + {size}")


def merged_ids(units: pa.Array, edges: pa.Array, byte_ids: np.ndarray) -> pa.Array:
    """Fold for BPE: the ids of each unit after all merges, from the edges of its lattice (see ``packed``).

    Each step joins in every unit the two neighbours that make its highest-scored piece, the leftmost of equals.
    """
    data, offsets = flat(units)
    begins = np.flatnonzero((data & 0xC0) != 0x80)  # bytes at which characters begin
    base, widths = np.searchsorted(begins, offsets), np.diff(begins, append=len(data))
    owner = np.repeat(np.arange(len(units)), pc.list_value_length(edges).to_numpy(zero_copy_only=False))
    packs = edges.flatten().to_numpy(zero_copy_only=False)
    # a piece by the place of its first character among those of all units, and its size
    spans = (base[owner] + (packs >> 7 & 127)) * 128 + (packs & 127) - (packs >> 7 & 127)
    order = np.argsort(spans)
    spans, codes = np.append(spans[order], -1), np.append((packs >> 14)[order], -1)

    def code(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Codes of the pieces between two places; -1 where there is none."""
        want = starts * 128 + stops - starts
        found = np.searchsorted(spans[:-1], want)
        return np.where(spans[found] == want, codes[found], -1)

    def rank(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Higher score first, then leftmost."""
        found = code(starts, stops)
        return np.where(found < 0, -1, found // IDS * len(widths) + len(widths) - 1 - starts)

    stop = base[1:]  # of each unit
    starts, unit, done = np.arange(len(widths)), np.repeat(np.arange(len(units)), np.diff(base)), []
    ranks = np.full(len(starts), -1)
    two = np.flatnonzero(unit[:-1] == unit[1:])
    ranks[two] = rank(two, two + 2)
    while len(starts):
        first = np.flatnonzero(np.diff(unit, prepend=-1))
        sizes = np.diff(first, append=len(unit))
        best = np.maximum.reduceat(ranks, first)
        live = np.repeat(best >= 0, sizes)
        done.append(starts[~live])
        starts, unit, ranks = starts[live], unit[live], ranks[live]
        if not len(starts):
            break
        at = np.flatnonzero(ranks == np.repeat(best[best >= 0], sizes[best >= 0]))  # one of each unit
        keep = np.ones(len(starts), dtype=bool)
        keep[at + 1] = False
        starts, unit, ranks = starts[keep], unit[keep], ranks[keep]
        at -= np.arange(len(at))
        after, last = np.append(starts, -1), np.append(unit, -1)  # a piece ends where the next one begins
        for left in (at, at[(at > 0) & (last[at - 1] == last[at])] - 1):
            right = last[left + 1] == last[left]
            ranks[left[~right]] = -1
            left = left[right]
            beyond = np.minimum(left + 2, len(starts))
            ranks[left] = rank(starts[left], np.where(last[beyond] == last[left], after[beyond], stop[last[left]]))
    starts = np.sort(np.concatenate([np.zeros(0, dtype=np.int64), *done]))
    found = code(starts, np.append(starts[1:], len(widths)))
    # a character outside the model as its bytes
    counts = np.where(found < 0, widths[starts], 1)
    stops = np.concatenate([[0], np.cumsum(counts)])
    ids = np.repeat(found % IDS, counts)
    loose = np.flatnonzero(np.repeat(found < 0, counts))
    places = np.arange(stops[-1]) + np.repeat(begins[starts] - stops[:-1], counts)
    ids[loose] = byte_ids[data[places[loose]]]
    bounds = stops[np.searchsorted(starts, base)]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


def folded(rows: DataFrame, model: Model) -> DataFrame:
    """unit, n, ids of a BPE model's lattices, many units at a time."""
    byte_ids = np.array(model.byte_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def ids() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            return pa.RecordBatch.from_arrays([some["unit"], some["n"], merged_ids(some["unit"], some["edges"], byte_ids)], ["unit", "n", "ids"])

        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(map(len, held)) >= FOLDED:
                yield ids()
        if held:
            yield ids()

    return rows.select("unit", "n", "edges").mapInArrow(run, "unit string, n bigint, ids array<int>")


def viterbi_cuts(scores: list[float], unknown: float) -> str:
    """Fold for unigram: the places between the pieces of the best-scored path; the first found of equal paths.

    ``scores`` by order. The state holds, for each place, the score of the best path to it and that path's places.
    """
    values = "array(" + ", ".join(f"double('{x}')" for x in scores) + ")"
    edges = f"transform(filter(edges, p -> p % 16384 > 0), p -> named_struct('start', cast(p div 128 % 128 as int), 'end', cast(p % 128 as int), 'score', get({values}, cast(p div {16384 * IDS} as int))))"
    into = (
        f"filter(transform(filter({edges}, e -> e.end = x), e -> named_struct('score', get(s, e.start).score + e.score, "
        "'cuts', array_append(get(s, e.start).cuts, x))), c -> c.score is not null)"
    )
    alone = f"named_struct('score', get(s, x - 1).score + cast({unknown} as double), 'cuts', array_append(get(s, x - 1).cuts, x))"
    known = "exists(edges, p -> p % 16384 = (x - 1) * 128L + x)"
    best = f"array_sort(concat({into}, if({known}, array(), array({alone}))), (l, r) -> case when l.score > r.score then -1 when l.score < r.score then 1 else 0 end)"
    first = "array(named_struct('score', cast(0 as double), 'cuts', array(0)))"
    return f"aggregate(sequence(1, n_chars), {first}, (s, x) -> array_append(s, element_at({best}, 1)), s -> element_at(s, -1).cuts)"


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """piece, code: one row per piece, as many as the model has, and the empty piece. code: order and id in one."""
    rows = [(text, order * IDS + i) for text, i, order, _ in model.pieces] + [("", 0)]
    return spark.createDataFrame(pa.table({"piece": [r[0] for r in rows], "code": pa.array([r[1] for r in rows], pa.int64())}))


def unit_ids(units: DataFrame, model: Model) -> DataFrame:
    """unit, n, ids: the encoding of every unit."""
    longest = max(len(p) for p, *_ in model.pieces)
    rows = lattice(units, piece_table(units.sparkSession, model), longest)
    if model.kind == "bpe":
        return folded(rows, model)
    # pieces of two characters and more by their span; those of one character are looked up among the edges
    long_ones = "filter(edges, e -> e % 128 - e div 128 % 128 > 1)"
    merges = f"map_from_entries(transform({long_ones}, e -> struct(e % 16384, e div 16384)))"
    rows = rows.select("unit", "n", "edges", F.length("unit").alias("n_chars"), F.expr(merges).alias("merges"))
    by_order = dict((order, score) for *_, order, score in model.pieces)
    scores = [by_order.get(k, 0.0) for k in range(max(by_order) + 1)]
    rows = rows.withColumn("cuts", F.expr(viterbi_cuts(scores, min(scores) - 10)))
    byte_ids = "array(" + ", ".join(map(str, model.byte_ids)) + ")"
    # a character outside the model as its bytes
    as_bytes = (
        "transform(sequence(1, octet_length(substring(unit, a + 1, 1))), k -> get("
        f"{byte_ids}, cast(conv(substring(hex(substring(unit, a + 1, 1)), 2 * k - 1, 2), 16, 10) as int)))"
    )
    ids = (
        "flatten(transform(slice(cuts, 1, size(cuts) - 1), (a, k) -> element_at(transform(array(coalesce(try_element_at(merges, "
        "a * 128L + get(cuts, k + 1)), get(filter(edges, e -> e % 16384 = a * 128L + get(cuts, k + 1)), 0) div 16384)), c -> "
        f"if(c is null, {as_bytes}, array(cast(c % {IDS} as int)))), 1)))"
    )
    return rows.select("unit", "n", F.expr(ids).alias("ids"))


def _hex_of(model: Model, ids: str) -> F.Column:
    """The pieces of the ids, joined, as hexadecimal digits of their bytes."""
    table = F.split(F.lit(",".join(s.hex().upper() for s in model.surfaces)), ",")
    return F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")


def decoded(rows: DataFrame, model: Model, ids: str = "ids") -> F.Column:
    """The text of an id array: pieces joined, space marks to spaces, the leading one dropped. Null stays null."""
    text = F.replace(F.unhex(_hex_of(model, ids)).cast("string"), F.lit(SPACE), F.lit(" "))
    return F.regexp_replace(text, "^ ", "")


def dictionary(docs: DataFrame, model: Model) -> DataFrame:
    """unit, n, ids of all units of the corpus, written once, in buckets by unit."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(unit_ids(unit_counts(docs, model), model), "units", "unit", parts)


#: classes of bytes, of those beyond ASCII for letters only: space, letter, line feed, other
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[32], _CLASS[10] = 0, 2


def unit_keys(hashes: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """A unit's key: a hash of its bytes and of the number of space marks before them."""
    return tb.mix(hashes + spaces.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys as they come, and the place among them of each key."""
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


class Cutter:
    """In a task: the units of many texts at a time.

    Texts without a space mark of the model that don't end in a space are cut by classes of their
    characters, which gives the same units as the pattern; other texts are cut one by one.
    """

    def __init__(self, pattern: str):
        import regex

        self.cut = regex.compile(pattern).findall
        self.fine = pattern == FINE
        self.letter = regex.compile(r"\p{L}").match
        self.letters: set[str] = set()  # those seen beyond ASCII

    def units(self, text: str) -> list[str]:
        return self.cut(SPACE + text.replace(" ", SPACE))

    def block(self, data: np.ndarray, offsets: np.ndarray, texts: list[str | None]) -> tuple[dict[int, list[str]], tuple]:
        """Units of the texts cut one by one, and starts, ends, each text's first, texts, space marks and keys of all by classes."""
        kind, marks = self._classes(data)
        some = np.flatnonzero(np.diff(offsets) > 0)
        if self.fine:
            closed = some[data[offsets[some + 1] - 1] == 32]
            some = np.union1d(closed, np.searchsorted(offsets, marks, "right") - 1)
        slow = {k: self.units(texts[k]) for k in some.tolist()}
        starts, ends, first = self._runs(kind, offsets)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        opening = np.zeros(len(starts), dtype=bool)
        opening[first[:-1][np.diff(first) > 0]] = True
        spaces = starts - np.where(opening, offsets[:-1][text] - 1, begins)
        return slow, (starts, ends, first, text, spaces, unit_keys(tb.range_hashes(data, starts, ends), spaces))

    def _classes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each byte, that of its character, and the places of space marks of the model."""
        kind, beyond = _CLASS[data], data[data > 127].tobytes().decode()
        new = set(beyond) - self.letters
        self.letters |= {c for c in new if self.letter(c)}
        if new <= self.letters:
            return kind, np.zeros(0, dtype=np.int64)
        chars, which = np.unique(np.frombuffer(beyond.encode("utf-32-le"), dtype="<u4"), return_inverse=True)
        other = np.array([chr(c) not in self.letters for c in chars.tolist()])[which]
        leads = np.flatnonzero(data > 191)
        for k, least in enumerate((0, 0, 224, 240)):  # the bytes of a character
            kind[leads[other & (data[leads] >= least)] + k] = 3
        return kind, leads[(chars == ord(SPACE))[which]]

    @staticmethod
    def _runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of runs of one class, line feeds singly, spaces none; each text's first run."""
        if not len(kind):
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(len(offsets), dtype=np.int64)
        change = np.ones(len(kind) + 1, dtype=bool)
        change[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        change[offsets] = True
        starts = np.flatnonzero(change[:-1] & (kind > 0))
        return starts, np.flatnonzero(change[1:] & (kind > 0)) + 1, np.searchsorted(starts, offsets)


class UnitTally:
    """In a task: units cut by classes, told by their keys, and how often each was seen."""

    def __init__(self) -> None:
        self.keys, self.rows = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.counts, self.units = np.zeros(0, dtype=np.int64), []

    def __len__(self) -> int:
        return len(self.counts)

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spaces: np.ndarray, keys: np.ndarray) -> None:
        keys, codes = distinct(keys)
        first, counts = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1)), np.bincount(codes, minlength=len(keys))
        order = np.argsort(keys)
        keys, first, counts = keys[order], first[order], counts[order]
        place, held = np.searchsorted(self.keys, keys), np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            held = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        self.counts[self.rows[place[held]]] += counts[held]
        new, rows = first[~held], len(self) + np.arange(int((~held).sum()))
        self.keys, self.rows = np.insert(self.keys, place[~held], keys[~held]), np.insert(self.rows, place[~held], rows)
        self.counts = np.concatenate([self.counts, counts[~held]])
        self.units.append(marked(data, starts[new], ends[new], spaces[new]))

    def emptied(self) -> tuple[pa.Array, np.ndarray]:
        """The units and their counts."""
        out = pa.concat_arrays([pa.array([], pa.string()), *self.units]), self.counts
        self.__init__()
        return out


def marked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spaces: np.ndarray) -> pa.Array:
    """The byte ranges as texts, each after so many space marks."""
    sizes = ends - starts
    stops = np.concatenate([[0], np.cumsum(sizes)])
    held = data[np.arange(stops[-1]) + np.repeat(starts - stops[:-1], sizes)]
    bare = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(held))
    return pc.binary_join_element_wise(pc.binary_repeat(pa.scalar(SPACE), pa.array(spaces)), bare, "")


def head_column(head: bytes, name: str) -> pa.Array:
    table = pa.ipc.open_stream(head).read_all().combine_chunks()
    return table[name].chunk(0) if table.num_rows else pa.array([], table[name].type)


class Coder:
    """In a task: units of texts, with the frequent ones' encodings and the library for very long ones."""

    def __init__(self, model_data: bytes, pattern: str, head: bytes):
        import sentencepiece

        self.cutter = Cutter(pattern)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model_data)
        units = head_column(head, "unit")
        bare = pc.utf8_ltrim(units, characters=SPACE)
        spaces = pc.subtract(pc.binary_length(units), pc.binary_length(bare)).to_numpy(zero_copy_only=False) // len(SPACE.encode())
        sizes = pc.binary_length(bare).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(pc.cast(bare, pa.binary()).to_pylist()), dtype=np.uint8)
        keys = unit_keys(tb.range_hashes(data, ends - sizes, ends), spaces)
        self.rows = np.argsort(keys)
        self.keys = keys[self.rows]

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Rows in the head; -1 for units that are not there."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        keys, codes = distinct(keys)
        order = np.argsort(keys)  # neighbours are found near each other
        found = np.empty(len(keys), dtype=np.int64)
        found[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        return np.where(self.keys[found] == keys, self.rows[found], -1)[codes]

    def _alone(self, units: list[str]) -> np.ndarray:
        bare = [u.lstrip(SPACE) for u in units]
        spaces = np.array([len(u) - len(b) for u, b in zip(units, bare)], dtype=np.int64)
        return self.look_up(unit_keys(tb.text_hashes(bare), spaces))

    def long_ids(self, unit: str) -> list[int]:
        """A unit has its own leading space mark, or follows another unit: the library adds a mark, which goes."""
        if unit.startswith(SPACE):
            return self.library.encode(unit[1:].replace(SPACE, " "))
        # after a line feed, which joins with nothing, the library starts afresh
        return self.library.encode("\n" + unit)[len(self.library.encode("\n")) :]

    def cut(self, data: np.ndarray, offsets: np.ndarray, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
        """Of many texts: the units' rows in the head or -1, each text's first unit, and the units whose row is -1."""
        slow, (starts, ends, first, _, spaces, keys) = self.cutter.block(data, offsets, texts)
        rows = self.look_up(keys)
        pieces, units, total = [], {}, 0
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        for k in range(len(texts)):
            found, own = (slow[k], self._alone(slow[k])) if k in slow else ((), rows[first[k] : first[k + 1]])
            for j in np.flatnonzero(own < 0).tolist():
                at = int(first[k]) + j
                units[total + j] = found[j] if k in slow else SPACE * int(spaces[at]) + data[starts[at] : ends[at]].tobytes().decode()
            pieces.append(own)
            total += len(own)
            bounds[k + 1] = total
        return np.concatenate(pieces) if pieces else rows, bounds, units


class Decoder:
    """In a task: the bytes that ids stand for, many texts at a time."""

    def __init__(self, surfaces: list[bytes]):
        plain = [s.replace(SPACE.encode(), b" ") for s in surfaces]
        self.sizes = np.array([len(s) for s in plain], dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(plain), dtype=np.uint8)

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, each without its leading space, and their offsets. ``bounds``: the texts' first ids."""
        sizes = self.sizes[ids]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        data = self.flat[np.arange(stops[-1]) + np.repeat(self.first[ids] - stops[:-1], sizes)]
        offsets = stops[bounds]
        leading = offsets[:-1][np.diff(offsets) > 0]
        leading = leading[data[leading] == 32]
        keep = np.ones(len(data), dtype=bool)
        keep[leading] = False
        dropped = np.concatenate([[0], np.cumsum(~keep)])
        return data[keep], offsets - dropped[offsets]


_SPAN = 5  # bytes over which the 32 bits of a number may lie


def numbered(data: np.ndarray) -> bytes:
    """Numbers as bytes, the shorter of two codes: planes of their bytes (better where runs of them
    repeat), or for each number how many bits follow its first one, and then these bits."""
    return all_numbered(data, np.array([0, len(data)]))[0]


def all_numbered(data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """:func:`numbered` of many texts, whose first numbers are at ``bounds``."""
    codec, wide = pa.Codec("zstd"), data.astype("<u4").view(np.uint8).reshape(-1, 4)
    value = data + 1
    sizes = np.frexp(value.astype(np.float64))[1].astype(np.int64) - 1
    at, stops = _bit_places(sizes, bounds)
    shifted, bits = (value - (np.int64(1) << sizes)) << (at & 7), np.zeros(int(stops[-1]) + _SPAN)
    for k in range(int(sizes.max(initial=0) + 14) // 8):  # bits don't overlap, so sums are exact
        bits += np.bincount((at >> 3) + k, weights=(shifted >> 8 * k) & 255, minlength=len(bits))
    raw, short, out = bits.astype(np.uint8).tobytes(), sizes.astype(np.uint8).tobytes(), []
    for a, b, c, d in zip(bounds.tolist(), bounds[1:].tolist(), stops.tolist(), stops[1:].tolist()):
        planes, small = codec.compress(wide[a:b].T.tobytes(), asbytes=True), codec.compress(short[a:b], asbytes=True)
        if len(planes) <= len(small) + (d - c) + 4:
            out.append(b"\0" + planes)
        else:
            out.append(b"\1" + len(small).to_bytes(4, "little") + small + raw[c:d])
    return out


def numbers_of(packed: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of :func:`numbered`."""
    return all_numbers([packed], np.array([0, n]))


def all_numbers(packs: list[bytes], bounds: np.ndarray) -> np.ndarray:
    """The numbers of :func:`all_numbered`."""
    codec, short, raw, planar = pa.Codec("zstd"), [], [], []
    for packed, a, b in zip(packs, bounds.tolist(), bounds[1:].tolist()):
        if packed[0] == 0:
            planes = np.frombuffer(codec.decompress(packed[1:], 4 * (b - a), asbytes=True), dtype=np.uint8)
            planar.append((a, b, np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)))
            short.append(bytes(b - a))
        else:
            stop = 5 + int.from_bytes(packed[1:5], "little")
            short.append(codec.decompress(packed[5:stop], b - a, asbytes=True))
            raw.append(packed[stop:])
    sizes = np.frombuffer(b"".join(short), dtype=np.uint8).astype(np.int64)
    at, _ = _bit_places(sizes, bounds)
    bits, rest = np.frombuffer(b"".join(raw) + bytes(_SPAN), dtype=np.uint8), np.zeros(len(sizes), dtype=np.int64)
    for k in range(int(sizes.max(initial=0) + 14) // 8):
        rest |= bits[(at >> 3) + k].astype(np.int64) << 8 * k
    first = np.int64(1) << sizes
    out = first + ((rest >> (at & 7)) & (first - 1)) - 1
    for a, b, numbers in planar:
        out[a:b] = numbers
    return out


def _bit_places(sizes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bit at which each number of so many bits begins, each text's first byte (with the total at the end)."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    stops = np.concatenate([[0], np.cumsum((np.diff(ends[bounds]) + 7) // 8)])
    return ends[:-1] + np.repeat(8 * stops[:-1] - ends[bounds[:-1]], np.diff(bounds)), stops


def own_units(bounds: np.ndarray, units: dict[int, str]) -> dict[int, dict[str, int]]:
    """Of each text the units that are not in the head, numbered: those to be joined first, in order, then the long ones."""
    own: dict[int, set[str]] = {}
    for k, unit in zip((np.searchsorted(bounds, list(units), "right") - 1).tolist(), units.values()):
        own.setdefault(k, set()).add(unit)
    return {k: {u: i for i, u in enumerate(sorted(some, key=lambda u: (len(u) > LONGEST, u)))} for k, some in own.items()}


def head_of(coded: DataFrame, limit: int = HEAD, most_bytes: int = HEAD_BYTES) -> tuple[bytes, DataFrame]:
    """The most frequent units with their ids, as an Arrow stream, and the rest: all those at least as frequent as
    the lowest level, found by counting, down to which they are no more than ``limit`` and ``most_bytes``."""
    level = F.floor(F.log2("n") * 16).cast("int")
    held = F.sum(F.octet_length("unit") + 4 * F.size("ids") + 12)
    total, size, lowest = 0, 0, None
    for at, n, b in sorted(coded.groupBy(level.alias("level")).agg(F.count("*"), held).collect(), reverse=True):
        if total + n > limit or size + b > most_bytes:
            break
        total, size, lowest = total + n, size + b, at
    inside = level >= (lowest if lowest is not None else 1 << 30)
    # the most frequent ones have the smallest numbers
    table = coded.where(inside).select("unit", "ids", "n").toArrow().sort_by([("n", "descending")]).select(["unit", "ids"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes(), coded.where(~inside)


def encoded(docs: DataFrame, model: Model, head: int = HEAD, columns: list[str] | None = None, check: bool = False) -> DataFrame:
    """The rows of ``docs`` with ``ids`` (array of int), as the library encodes the text, and ``n_tokens``.

    With ``check`` also ``round_trip``: the ids decode to exactly the text, by length and hash; a text
    with a space mark of the model (U+2581) doesn't come back. Of the columns of ``docs``, those named
    are returned, or else all. One named ids, n_tokens or (with check) round_trip is replaced. Null and
    empty texts have no ids and come back as the empty text; repeated rows stay; an empty table gives
    no rows.
    """
    frequent, rest = head_of(dictionary(docs, model), head)
    sent = docs.sparkSession.sparkContext.broadcast((model.data, model.units, frequent))
    surfaces, width = model.surfaces, 2 if len(model.surfaces) <= 1 << 16 else 3
    added = ["ids", "n_tokens", "round_trip"] if check else ["ids", "n_tokens"]
    named = [c for c in columns or docs.columns if c not in added]
    # equal texts have equal ids, so a text is told by two hashes of it, of 64 and 32 bits
    hashes = [F.xxhash64("text").alias("h1"), F.shiftrightunsigned(F.xxhash64("text", F.lit(1)), 32).alias("h2")]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in named]).alias("row"), "text", *hashes)
    texts = docs.select(*hashes, "text")

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*sent.value)
        for batch in batches:
            for row, stop, data, offsets in tb.blocks(batch.column(2)):
                _, bounds, units = coder.cut(data, offsets, batch.column(2)[row:stop].to_pylist())
                own = [(row + k, i, u) for k, some in own_units(bounds, units).items() for u, i in some.items() if len(u) <= LONGEST]
                at = pa.array([k for k, *_ in own], pa.int32())
                # the place in the text above the 32 bits of the second hash
                place = pc.add(pc.shift_left(pa.array([i for _, i, _ in own], pa.int64()), 32), batch.column(1).take(at))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), place, pa.array([u for *_, u in own], pa.string())], ["h1", "place", "unit"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*sent.value)
        for batch in batches:
            for row, stop, data, offsets in tb.blocks(batch.column(1)):
                rows, bounds, units = coder.cut(data, offsets, batch.column(1)[row:stop].to_pylist())
                own, rows = own_units(bounds, units), rows.copy()
                owners = np.searchsorted(bounds, list(units), "right") - 1
                rows[list(units)] = [len(coder.rows) + own[k][u] for k, u in zip(owners.tolist(), units.values())]
                long = [[coder.long_ids(u) for u in own.get(k, ()) if len(u) > LONGEST] for k in range(stop - row)]
                more = [
                    pa.array(all_numbered(rows, bounds), pa.binary()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(long, pa.list_(pa.list_(pa.int32()))),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(tb.range_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays([*(batch.column(j)[row:stop] for j in (0, 2, 3)), *more], names)

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_ids = head_column(sent.value[2], "ids")
        head_sizes = pc.list_value_length(head_ids).to_numpy(zero_copy_only=False).astype(np.int64)
        head_flat = head_ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        decoder = Decoder(surfaces)
        for batch in batches:
            counts = batch.column(2).to_numpy()
            group = np.cumsum(counts) // tb.BLOCK
            for at in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(group)) + 1) if len(counts) else ():
                sizes, flat, total, before = [head_sizes], [head_flat], len(head_sizes), []
                packs, longs, mores = (batch.column(j)[at[0] : at[-1] + 1].to_pylist() for j in (1, 3, 6))
                for long, more in zip(longs, mores):
                    before.append(total - len(head_sizes))
                    # a place in four bytes, then the ids
                    given = sorted(more or ())
                    bytes_ = np.frombuffer(b"".join(x[4:] for x in given), dtype=np.uint8).reshape(-1, width).astype(np.int32)
                    flat += [bytes_ @ (256 ** np.arange(width - 1, -1, -1, dtype=np.int32)), *(np.array(x, dtype=np.int32) for x in long)]
                    sizes.append(np.array([*((len(x) - 4) // width for x in given), *map(len, long)], dtype=np.int64))
                    total += len(sizes[-1])
                first = np.concatenate([[0], np.cumsum(counts[at])])
                rows = all_numbers(packs, first)
                rows += np.where(rows < len(head_sizes), 0, np.repeat(before, counts[at]))
                size, all_ids = np.concatenate(sizes), np.concatenate(flat)
                starts, length = np.cumsum(size) - size, size[rows]
                stops = np.concatenate([[0], np.cumsum(length)])
                ids = all_ids[np.arange(stops[-1]) + np.repeat(starts[rows] - stops[:-1], length)]
                bounds = stops[first]
                out = [batch.column(0)[at[0] : at[-1] + 1], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
                if check:
                    back, offsets = decoder.texts(ids, bounds)
                    same = np.diff(offsets) == batch.column(4).to_numpy()[at]
                    out.append(pa.array(same & (tb.range_hashes(back, offsets[:-1], offsets[1:]).view(np.int64) == batch.column(5).to_numpy()[at])))
                yield pa.RecordBatch.from_arrays(out, ["row", "ids", "round_trip"][: len(out)])

    names = ["row", "h1", "h2", "numbers", "n", "long", "size", "mark"]
    kind = keyed.schema["row"].dataType.simpleString()
    numbers = keyed.mapInArrow(cut, f"row {kind}, h1 bigint, h2 bigint, numbers binary, n bigint, long array<array<int>>, size bigint, mark bigint")
    as_bytes = F.unhex(F.array_join(F.transform("ids", lambda i: F.lpad(F.hex(i), 2 * width, "0")), ""))
    looked = texts.mapInArrow(rare, "h1 bigint, place bigint, unit string").join(rest.select("unit", as_bytes.alias("ids")), "unit")
    entry = F.concat(F.unhex(F.lpad(F.hex(F.shiftrightunsigned("place", 32)), 8, "0")), "ids")
    looked = looked.groupBy("h1", F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).alias("h2")).agg(F.collect_set(entry).alias("more"))
    full = numbers.join(looked, ["h1", "h2"], "left").select("row", "numbers", "n", "long", "size", "mark", "more")
    found = full.mapInArrow(assembled, f"row {kind}, ids array<int>" + ", round_trip boolean" * check)
    return found.select("row.*", "ids", F.size("ids").cast("bigint").alias("n_tokens"), *["round_trip"] * check)
