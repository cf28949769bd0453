"""Phrases against a plain count, and the summaries against their guarantee."""

import re
from collections import Counter

import numpy as np

from slatewright.llm import collocations
from slatewright.llm.queries import prepared

SCHEMA = "lang string, text string, phrase string, n int, doc_id bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, widths=3, threshold=10, top=2000):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, widths + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {k: n for k, n in counts.items() if len(k) > 2 and n >= threshold}
    out = {}
    for (lang, *w), a in found.items():
        longer = [n for (o, *v), n in found.items() if o == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * n >= 50 * a for n in longer):
            continue
        cuts = [(1000000 * a * a // (counts[(lang, *w[:k])] * counts[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[(lang, *w[:k])], counts[(lang, *w[k:])]))
    return sorted(
        (lang, n + 1, p.decode(), -a, left, right, total[lang], -s)
        for lang, rows in out.items()
        for n, (s, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def run(spark, rows, **kwargs):
    prepared(spark)
    df = spark.createDataFrame([(lang, text, "x", 1, k) for k, (lang, text) in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(df, **kwargs).collect())


AWKWARD = [
    (None, None),
    ("en", ""),
    ("en", " \t . ; \n"),
    (None, "New York is not new   york; New\tYork City, new york city! " * 20),
    ("en", "en en en " * 30 + "é è ﬁ 日本 語 日本 語 🙂 a 🙂 a " * 12),
    ("en", "one two three four five. " * 9),
    ("en", "one two three four five. one two three\vfour " * 1),
    ("de", "de de en de\rde de\x0cen de " * 12),
    ("und", "new york " * 3),
    ("en", "tie b tie a. " * 15),
    ("", "no language at all " * 11),
] + [("fr", "la la copy copy of text")] * 10


def test_awkward_rows(spark):
    for kwargs in ({}, {"widths": 4, "threshold": 3}, {"widths": 2, "top": 2}):
        assert run(spark, AWKWARD, **kwargs) == plain(AWKWARD, **kwargs)


def test_whole_table(spark, folder):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    assert run(spark, rows) == plain(rows)


def test_small_rooms_and_many_partitions(spark, folder, monkeypatch):
    """Summaries, maps and tables that fill up often give the same."""
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").limit(60).collect()]
    want = run(spark, rows, threshold=4)
    monkeypatch.setattr(collocations, "PARTITION_MASS", 500)
    monkeypatch.setattr(collocations, "FILTER_BITS", 12)
    assert collocations.partition_bits(spark.createDataFrame(rows, "lang string, text string"), 3) > 5
    assert run(spark, rows, threshold=4) == want


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None)]) == []


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(2)
    seen = Counter()
    mass, threshold = 0, 40
    parts = []
    for _ in range(30):
        keys = np.concatenate([rng.zipf(1.4, 400) % 5000, rng.integers(0, 100_000, 400)]).astype(np.uint32)
        keys, counts = np.unique(keys, return_counts=True)
        seen.update(dict(zip(keys.tolist(), counts.tolist())))
        parts.append((keys, counts))
        mass += int(counts.sum())
    summary = collocations.Summary(mass // threshold + 1)
    for keys, counts in parts:
        summary.merge(keys, counts)
    assert 0 < summary.lost < threshold and len(summary.keys) <= summary.capacity
    assert {k for k, n in seen.items() if n >= threshold} <= set(summary.frequent(threshold).tolist())
    assert all(seen[k] - summary.lost <= n <= seen[k] for k, n in zip(summary.keys.tolist(), summary.counts.tolist()))
    small = collocations.Summary(5)  # with less room than that something is lost
    for keys, counts in parts:
        small.merge(keys, counts)
    assert not {k for k, n in seen.items() if n >= threshold} <= set(small.keys.tolist())
