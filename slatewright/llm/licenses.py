"""Licence notices in whole texts: exact phrases, and short notices with a few letters wrong.

A notice that stands in a text with at most k letter edits holds, when cut into k + 1 pieces, at
least one piece unchanged (pigeonhole). So exact search for the pieces finds all candidates; the
surrounding stretch of each is verified by the regex library's matching with at most k errors,
which gives the span and the number of edits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.llm import textbytes as tb

# fixed values: phrase and label of the exact search
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: short notice and label of the search with errors
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache",
    "apache license": "apache",
    "released under the mit license": "mit",
    "mit license": "mit",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
}

#: letters of a notice for each error allowed
LETTERS_PER_ERROR = 9

#: any byte to the lower-case letter, digit or space it counts as
_PLAIN = bytes(int(tb.LOWER[b]) if tb.ALNUM[tb.LOWER[b]] else 32 for b in range(256))


def pieces(notice: bytes, errors: int) -> list[tuple[bytes, int]]:
    """The notice cut into errors + 1 pieces, each with its place."""
    cuts = [len(notice) * k // (errors + 1) for k in range(errors + 2)]
    return [(notice[a:b], a) for a, b in zip(cuts, cuts[1:])]


def exact_places(joined: bytes, phrase: bytes) -> list[int]:
    """Byte places where the phrase's words stand in the joined words of a text; overlaps count."""
    out, at = [], joined.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or joined[at - 1] == 32) and (end == len(joined) or joined[end] == 32):
            out.append(at)
        at = joined.find(phrase, at + 1)
    return out


class Notices:
    """The notices with their pieces and patterns."""

    def __init__(self, notices: dict[str, str]):
        import regex

        self.rows = []
        for text, label in notices.items():
            raw, errors = text.encode(), len(text) // LETTERS_PER_ERROR
            pattern = regex.compile(rb"(?b)(?<![^ ])(?:" + regex.escape(raw, special_only=True, literal_spaces=True) + rb"){e<=%d}(?![^ ])" % errors)
            self.rows.append((label, raw, errors, pieces(raw, errors), pattern))

    def find(self, joined: bytes) -> list[tuple[str, int, int, int, int]]:
        """(label, start, end, edits, notice length) of verified matches, as byte places."""
        out: dict[tuple[str, int, int], tuple[int, int]] = {}
        for label, raw, errors, cut, pattern in self.rows:
            stretches = []
            for piece, offset in cut:
                at = joined.find(piece)
                while at >= 0:
                    stretches.append((max(0, at - offset - errors - 1), at - offset + len(raw) + errors + 1))
                    at = joined.find(piece, at + 1)
            for low, high in joined_ranges(stretches):
                for m in pattern.finditer(joined, low, min(high, len(joined)), overlapped=False):
                    edits = sum(m.fuzzy_counts)
                    key = (label, *m.span())
                    out[key] = min(out.get(key, (edits, len(raw))), (edits, len(raw)))
        return [(label, a, b, edits, size) for (label, a, b), (edits, size) in sorted(out.items())]


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping stretches as one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def license_notices(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, id_column: str = "doc_id"
) -> DataFrame:
    """One row per document: exact places, and the notices found with their spans and edits.

    id, n_words, n_base, first_word, last_word (null without a place), base_labels, labels, score
    (1 for an exact phrase, else 1 - edits per letter of the best notice, else 0), spans (array of
    label, first_word, n_words, edits). Null and empty texts have no words and no labels. Notices
    found twice by the same label at one place count once, with the fewest edits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Notices(notices)
        exact = [(p.encode(), label) for p, label in phrases.items()]
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("n_words", "n_base", "first", "last", "base", "labels", "score", "spans")}
            texts = pc.fill_null(batch.column(1), "")
            for k in range(len(texts)):
                parts = texts[k].as_py().encode().translate(_PLAIN).split()
                joined = b" ".join(parts)

                def word(at: int, joined: bytes = joined) -> int:
                    return joined.count(b" ", 0, at)

                places = [(at, label) for p, label in exact for at in exact_places(joined, p)]
                found = search.find(joined)
                base = sorted({label for _, label in places})
                out["n_words"].append(len(parts))
                out["n_base"].append(len(places))
                out["first"].append(word(min(places)[0]) if places else None)
                out["last"].append(word(max(places)[0]) if places else None)
                out["base"].append(",".join(base))
                out["labels"].append(",".join(sorted({*base, *(f[0] for f in found)})))
                best = max((1 - edits / size for _, _, _, edits, size in found), default=0.0)
                out["score"].append(1.0 if places else best)
                out["spans"].append([(label, word(a), joined.count(b" ", a, b) + 1, edits) for label, a, b, edits, _ in found])
            span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64())])
            spans = [[dict(zip(("label", "first_word", "n_words", "edits"), s)) for s in row] for row in out["spans"]]
            integers = [pa.array(out[n], pa.int64()) for n in ("n_words", "n_base", "first", "last")]
            strings = [pa.array(out[n], pa.string()) for n in ("base", "labels")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *integers, *strings, pa.array(out["score"], pa.float64()), pa.array(spans, pa.list_(span))],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), "text").mapInArrow(
        run,
        f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first_word:bigint,n_words:bigint,edits:bigint>>",
    )
