"""The pipeline against plain versions of its stages, and operators on pages and labels."""

import zlib

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from slatewright.llm import main_text, quality_model
from slatewright.llm.queries import QUERIES, prepared

from test_against_brute_force import by_id, plain_components, plain_fingerprint, plain_hits, plain_pii


def test_stages(spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [(None, None, "en", "s", 0), (None, None, "en", "s", 0), (-5, "", None, None, 0), (-6, "a b c", "en", "s", 5), (-6, "a b c", "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        after = stage(spark, docs, folder)
        rows = after.collect()
        if k < 4:
            assert after.columns == docs.columns
        if name == "near copies":
            keyed = {(r.doc_id is not None, r.doc_id, r.text): r for r in before}
            prints = {n: plain_fingerprint(t) for n, (_, _, t) in enumerate(sorted(keyed, key=lambda x: (x[0], x[1] or 0, x[2] or "")))}
            assert len(rows) == len(set(plain_components(prints).values()))
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before}
        elif name == "benchmark decontamination":
            want = [r for r in before if not plain_hits(r.text, items)["contaminated"]]
            assert sorted(map(str, rows)) == sorted(map(str, want)) and len(want) < len(before)
        elif name == "personal data":
            assert len(rows) == len(before) and any(any(plain_pii(r.text).values()) for r in before)
            assert not any(any(plain_pii(r.text).values()) for r in rows)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
        elif name == "sentence pieces":
            assert len(rows) == len(before) and all(r.n_tokens == len(r.ids) for r in rows)
        docs = after if k == 4 else spark.createDataFrame(rows, after.schema)


def test_quality_model_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = by_id(QUERIES["op4_quality_model"](spark, folder))
    labels = dict(zip(*(c.to_pylist() for c in pq.read_table(f"{folder}/labels.parquet").columns[:2])))
    held = {i: r for i, r in got.items() if r["held_out"]}
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == r["held_out"] for i, r in got.items())
    right = [(r["score"] >= 0.7) == (labels[i] == 1) for i, r in held.items() if i in labels]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_quality_model_without_labels(spark):
    prepared(spark)
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    scores = [r["score"] for r in quality_model.scores(docs, quality_model.train(docs, none)).collect()]
    assert scores == pytest.approx([0.5] * 3)


def test_sum_of_squares_is_the_sum_over_pairs():
    import numpy as np

    rng = np.random.default_rng(1)
    m = quality_model.Machine(4, 0.3, rng.normal(size=30).astype("f4"), rng.normal(size=(30, quality_model.FACTORS)).astype("f4"))
    columns, values = np.array([3, 7, 11, 29]), np.array([0.5, 1.0, 2.0, -1.0], dtype="f4")
    want = 0.3 + sum(m.linear[c] * v for c, v in zip(columns, values))
    want += sum(m.factors[columns[i]] @ m.factors[columns[j]] * values[i] * values[j] for i in range(4) for j in range(i))
    assert m.margins(columns, values, np.array([0, 4]))[0] == pytest.approx(want, rel=1e-4)


def test_main_text(spark):
    prepared(spark)
    menu = "<div>Home News Sports Weather Contact About us</div>"
    quote = "one two three four five six seven eight nine ten"
    pages = [
        (1, "http://a.org/1", f"<nav>x</nav><article><h1>T&amp;t</h1><p>a <b>b</b>c\n d<p>{quote}<div class='ad'>buy</div></article><footer>f</footer>"),
        (2, "http://a.org/2", f"<article><p>{quote}</p><aside>no</aside></article>"),
        (3, "http://b.org/1", f"{menu}<p>First page has its own words</p><script>var t='</p>';</script>"),
        (4, "http://b.org/2", f"{menu}<p>Second page tells another story</p><form>q</form>"),
        (5, "http://b.org/2", f"{menu}<p>Second page tells another story</p><form>q</form>"),
        (6, None, None),
        (7, "http://c.org/", f"{menu}<p>Alone on its host</p>"),
        (8, "http://c.org/x", "plain < text &am"),
    ]
    got = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()}
    assert got == {
        1: f"T&t\na bc d\n{quote}",
        2: quote,
        3: "First page has its own words",
        4: "Second page tells another story",
        5: "Second page tells another story",
        6: "",
        7: "Home News Sports Weather Contact About us\nAlone on its host",
        8: "plain < text &am",
    }
