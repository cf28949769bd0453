"""Tokens of whole texts under a word-end BPE tokenizer, with a shortcut for whole-token words.

Before the job, the driver proves which vocabulary strings encode alone as one token: it gives
each string to the library and keeps those that come back as their own id. In the tasks a text
is normalised by the library and cut into pre-tokens; those in the proven set count one, and
only the rest are merged by the library, each distinct one once per task while the bounded
memory of them lasts. Where the cut could depend on the version of the character tables (texts
outside the Latin blocks) or special strings occur, the library counts the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBERED = 200_000

#: fixed values: the tokenizer's own cut into pre-tokens
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(moved)}


def _surface(piece: str, byte_of: dict[str, int]) -> str | None:
    """The text of a vocabulary string that ends a word; None for others and for partial characters."""
    if not piece.endswith("</w>"):
        return None
    try:
        return bytes(byte_of[c] for c in piece.removesuffix("</w>")).decode()
    except (KeyError, UnicodeDecodeError):
        return None


def whole_tokens(definition: str) -> frozenset[str]:
    """The vocabulary strings that, alone, are one pre-token and encode as the single token they are."""
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    byte_of = _byte_of()
    surfaces = [(s, n) for p, n in vocabulary.items() if (s := _surface(p, byte_of))]
    encoded = tokenizer.encode_batch([s for s, _ in surfaces], add_special_tokens=False)
    one = regex.compile(PRE_TOKENS)
    return frozenset(s for (s, n), e in zip(surfaces, encoded) if e.ids == [n] and one.fullmatch(s))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_column: str = "doc_id") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row; null counts as empty, an empty text has no tokens."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((definition, whole_tokens(definition)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from tokenizers import Tokenizer

        definition, whole = sent.value
        tokenizer = Tokenizer.from_str(definition)
        cut, foreign = regex.compile(PRE_TOKENS).findall, regex.compile(r"[^\x00-ɏ]").search
        normal = tokenizer.normalizer.normalize_str
        known = dict.fromkeys(whole, 1)

        def library(text: str) -> int:
            return len(tokenizer.encode(text, add_special_tokens=False).ids)

        def count(text: str) -> int:
            if "<|" in text or foreign(text):
                return library(text)
            total = 0
            for token in cut(normal(text)):
                n = known.get(token)
                if n is None:
                    if len(known) > len(whole) + REMEMBERED:
                        known.clear()
                        known.update(dict.fromkeys(whole, 1))
                    n = known[token] = library(token)
                total += n
            return total

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array([count(texts[k].as_py()) for k in range(len(texts))], pa.int64()),
                ],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col("text"))
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
