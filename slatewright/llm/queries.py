"""The operators as queries over the given tables, with production parameters: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatewright.llm import (
    collocations,
    decontaminate,
    licenses,
    main_text,
    personal_data,
    pivot_search,
    quality_model,
    quality_rules,
    sentence_pieces,
    simhash,
    token_counts,
    url_blocks,
    whitening,
)
from slatewright.session import configure

PIECE_MODEL = "piece_bpe_32k.model"
TOKENIZER = "word_bpe_49k.json"
GOOD = 0.7

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: rows of an Arrow batch: texts may be long, and a task holds a batch at a time
SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(prepared(spark), folder)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_sentence_pieces(spark, folder):
    """Ids of every document under the piece model, and whether they decode to the whole text."""
    model = sentence_pieces.load_model(tokenizer_path(PIECE_MODEL))
    return sentence_pieces.encoded(table(spark, folder, "documents"), model, columns=["doc_id"], check=True)


@query
def op2_quality_rules(spark, folder):
    return quality_rules.rule_verdicts(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_main_text(spark, folder):
    found = main_text.main_text(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op4_quality_model(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality_model.scores(docs, quality_model.train(docs, labels)).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id", quality_model.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


@query
def op5_licenses(spark, folder):
    found = licenses.license_notices(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")
    one = lambda s: F.concat_ws(":", s["label"], s["first_word"].cast("string"), s["n_words"].cast("string"), s["edits"].cast("string"))
    return found.withColumn("spans", F.array_join(F.transform("spans", one), ","))


@query
def op6_personal_data(spark, folder):
    found = personal_data.personal_spans(table(spark, folder, "documents"))
    return personal_data.span_digest(found).withColumnRenamed("id", "doc_id")


@query
def op7_decontaminate(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op8_url_blocks(spark, folder):
    return url_blocks.judged(table(spark, folder, "pages"))


@query
def op9_token_counts(spark, folder):
    docs = table(spark, folder, "documents")
    return token_counts.token_counts(docs, tokenizer_path(TOKENIZER)).withColumnRenamed("id", "doc_id")


@query
def op10_simhash(spark, folder):
    found = simhash.near_copies(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op11_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op12_nearest(spark, folder):
    return pivot_search.nearest(table(spark, folder, "embeddings"))


@query
def op13_whitening(spark, folder):
    """deviation is null where it is beyond 64 bits."""
    vectors = table(spark, folder, "embeddings")
    found = whitening.whitened(vectors, whitening.fitted(vectors)).withColumnRenamed("id", "vec_id")
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
