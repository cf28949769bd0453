"""From raw documents to token ids: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the
shared folder and reread as the next one's docs. All but the last return the columns of
documents, in their order; further columns of the input are kept. Null and empty texts pass every
stage as texts without words (the classifier scores them like any other), repeated rows are near
copies of one another, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slatewright.llm import decontaminate, personal_data, quality_model, sentence_pieces, simhash
from slatewright.llm.queries import GOOD, PIECE_MODEL, prepared, table, tokenizer_path
from slatewright.session import written

#: one stage, the classifier's signs of bad texts, is learned, so the rows are not expressible in SQL
ORACLE_SQL = None

#: columns of this module's own, beside those of the documents
_ROW, _FIRST = "row of the pipeline", "place of the pipeline"


def _whole(docs: DataFrame) -> DataFrame:
    """A document as one column beside its text, so that no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier scores at least 0.7."""
    prepared(spark)
    machine = quality_model.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.scores(_whole(docs), machine, "doc")
    return scored.where(F.col("score") >= GOOD).select("id.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id; of repeated rows one.

    Near copies have SimHash fingerprints of four-word shingles that differ in at most 4 of 64 bits.
    """
    prepared(spark)
    own = docs.withColumn(_ROW, F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash")))
    groups = simhash.near_copies(own.select(F.col(f"`{_ROW}`"), "text"), id_column=_ROW)
    kept = groups.where(F.col("id") == F.col("component")).select(F.col("id.doc_id").alias("i"), F.col("id.hash").alias("h")).distinct()
    same = F.col(f"`{_ROW}`.doc_id").eqNullSafe(F.col("i")) & (F.col(f"`{_ROW}`.hash") == F.col("h"))
    # of rows with equal id and text the one whose other columns come first stays
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    first = Window.partitionBy(F.col(f"`{_ROW}`.doc_id"), F.col(f"`{_ROW}`.hash")).orderBy(rest)
    found = own.join(kept, same, "left_semi").withColumn(_FIRST, F.row_number().over(first))
    return found.where(F.col(_FIRST) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    prepared(spark)
    found = decontaminate.contamination(_whole(docs), table(spark, sf_dir, "benchmark"), id_column="doc")
    return found.where(~F.col("contaminated")).select("id.*")


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    prepared(spark)
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest], F.col("text").isNull().alias("no text")).alias("doc"), "text")
    clean = personal_data.redacted(personal_data.personal_spans(rows, "doc"))
    text = F.when(~F.col("id")["no text"], F.col("text"))
    out = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return clean.select(*[(out[c] if c in out else F.col("id")[c]).alias(c) for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of every document."""
    prepared(spark)
    model = sentence_pieces.load_model(tokenizer_path(PIECE_MODEL))
    found = sentence_pieces.encoded(docs, model, columns=["doc_id", "lang", "source"])
    return found.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality),
    ("near copies", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("personal data", personal),
    ("sentence pieces", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
