"""Quality rules whose thresholds follow each language and source.

Measures of a text are whole numbers. Their distribution per language, source and measure is kept
as a histogram sketch: a value is rounded down to its six leading bits (at most 1/32 off), and a
sketch is the count of each rounded value. Sketches merge by adding counts, so they are combined
on the map side, one source may hold any share of the rows, and a language's sketch is the sum of
its sources'. Thresholds are read from them: the median plus a multiple of the distance from the
lower quartile to the median. Sources with few texts use their language's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatewright.session import written

WINDOW = 8
SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Measure:
    """A value per text; ``least`` is the smallest distance taken for a spread, both are per thousand."""

    value: str
    least: int
    upper: bool = True
    lower: bool = False


#: whole numbers per thousand words or characters
MEASURES = {
    "symbols": Measure("1000 * n_symbols div n_words", 12),
    "repeats": Measure("1000 * n_repeat_words div n_words", 25),
    "dup_lines": Measure("1000 * n_dup_lines div n_lines", 25),
    "capitals": Measure("1000 * n_capitals div word_chars", 20),
    "word_length": Measure("100 * word_chars div n_words", 60, lower=True),
}
SPREADS = 8
FEW = 30


def counted(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, lang, source and the counts of every whole text; null and empty texts have no words."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = docs.select(F.col(id_column).alias("id"), "lang", "source", text.alias("text"), words.alias("words"), lines.alias("lines"))
    rows = rows.select(
        "id",
        "lang",
        "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda s, w: s + F.length(w)).alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_capitals"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashed"),
    )
    # the hash of each window; sizes are read beside it so that `hashed` is made once
    n = F.size("hashed")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("runs", F.transform(starts, lambda i: F.xxhash64(F.slice("hashed", i, WINDOW)))).drop("hashed")
    sorted_runs = F.array_sort(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    several = F.size(F.array_distinct("runs")) < F.size("runs")
    rows = rows.withColumn("ordered", F.when(several, sorted_runs)).drop("runs")
    # the places of windows that equal the one before or after in the order of hashes
    marked = F.expr(
        "array_sort(filter(transform(ordered, (x, k) -> if(x.h = get(ordered, k - 1).h or x.h = get(ordered, k + 1).h, x.i, null)), p -> p is not null))"
    )
    rows = rows.withColumn("places", marked).drop("ordered")
    covered = F.expr(
        f"aggregate(places, named_struct('n', 0L, 'end', 0L), (s, p) -> named_struct("
        f"'n', s.n + least({WINDOW}L, p + {WINDOW}L - s.end), 'end', p + {WINDOW}L)).n"
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("places")


def _measured(rows: DataFrame) -> DataFrame:
    """The measures as an array of (measure, value); none for texts without words."""
    values = [F.struct(F.lit(n).alias("measure"), F.expr(m.value).alias("value")) for n, m in MEASURES.items()]
    return rows.withColumn("measures", F.when(F.col("n_words") > 0, F.array(*values)))


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, rounded, n: the histogram sketch of each measure, language and source."""
    each = _measured(rows).select("lang", "source", F.explode("measures").alias("m")).select("lang", "source", "m.*")
    # leading six bits: as many low bits as stand beyond them are cleared
    low = F.expr("greatest(0, length(bin(value)) - 6)")
    rounded = F.call_function("shiftleft", F.call_function("shiftright", F.col("value"), low), low)
    return each.select("lang", "source", "measure", rounded.alias("rounded")).groupBy("lang", "source", "measure", "rounded").agg(
        F.count("*").alias("n")
    )


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Lower quartile, median, upper quartile and number of texts of each sketch."""
    by = ", ".join(keys)
    running = sketch.withColumns(
        {
            "below": F.expr(f"sum(n) over (partition by {by} order by rounded)"),
            "total": F.expr(f"sum(n) over (partition by {by})"),
        }
    )
    at = {name: F.min(F.when(F.col("below") * 4 >= F.col("total") * k, F.col("rounded"))) for k, name in ((1, "q1"), (2, "q2"), (3, "q3"))}
    return running.groupBy(*keys).agg(*[v.alias(k) for k, v in at.items()], F.max("total").alias("total"))


def thresholds(sketch: DataFrame, spreads: int = SPREADS, few: int = FEW) -> DataFrame:
    """lang, source, measure, low, high: bounds from the source's sketch, or the merged one of its language."""
    own = _quantiles(sketch, ["lang", "source", "measure"])
    merged = sketch.groupBy("lang", "measure", "rounded").agg(F.sum("n").alias("n"))
    shared = _quantiles(merged, ["lang", "measure"]).select(
        F.col("lang").alias("l"), F.col("measure").alias("m"), *[F.col(c).alias("lang_" + c) for c in ("q1", "q2", "q3")]
    )
    both = own.join(shared, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m")))
    q1, q2, q3 = (F.when(F.col("total") < few, F.col("lang_" + c)).otherwise(F.col(c)) for c in ("q1", "q2", "q3"))
    kinds = [F.when(F.col("measure") == n, m.least) for n, m in MEASURES.items()]
    lowest = [n for n, m in MEASURES.items() if m.lower]
    high = q2 + spreads * F.greatest(F.coalesce(*kinds), q2 - q1)
    low = F.when(F.col("measure").isin(lowest), q2 - spreads * F.greatest(F.coalesce(*kinds), q3 - q2))
    return both.select("lang", "source", "measure", low.alias("low"), high.alias("high"))


def rule_verdicts(docs: DataFrame, id_column: str = "doc_id", spreads: int = SPREADS, few: int = FEW) -> DataFrame:
    """Counts, base_failed, broken (measures out of bounds) and kept of every row.

    base_failed: fewer than 20 words, or more than 30 % of words in repeated windows. Null and
    empty texts fail it. Null languages and sources are groups of their own. Repeated rows are
    judged alike. An empty table gives no rows.
    """
    rows = written(counted(docs, id_column), "counts")
    bounds = thresholds(sketches(rows), spreads, few)
    packed = bounds.groupBy("lang", "source").agg(F.sort_array(F.collect_list(F.struct("measure", "low", "high"))).alias("bounds"))
    packed = written(packed.select(F.col("lang").alias("l"), F.col("source").alias("s"), "bounds"), "bounds")
    joined = _measured(rows).join(packed, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    broken = F.expr(
        "transform(filter(measures, m -> exists(bounds, b -> b.measure = m.measure and (m.value > b.high or m.value < coalesce(b.low, m.value)))), m -> m.measure)"
    )
    failed: Column = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = joined.withColumns({"base_failed": failed, "broken": F.coalesce(F.array_join(F.array_sort(broken), ","), F.lit(""))})
    return out.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("broken") == "")).alias("kept"), "broken",
    )
