"""Every operator's query against a plain version, on awkward rows and on whole small tables."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slatewright.llm import decontaminate, licenses, personal_data, quality_rules, sentence_pieces, simhash, textbytes, token_counts, url_blocks
from slatewright.llm.queries import PIECE_MODEL, TOKENIZER, prepared, tokenizer_path

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UNSPACED = r"[^\x20\x09-\x0D]+"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
CARD = "4111 1111 1111 1111"

AWKWARD = [
    None,
    "",
    "   \n\t ",
    "one",
    "One two THREE",
    "one two three four",
    "One  two\nthree\tfour",
    "\u00a0nbsp\u2003wide ÀÉÎ straße İstanbul ΑΣ",
    "e\u0301 combining ﬁ ½ 日本語テキスト 🙂🙂 \u2581 mark \u200b",
    "line\nline\n\nline\n  line\n" * 3,
    "word " * 3000,
    "x" * 5000 + " " + "é" * 300 + "\n" + "=" * 400 + " -- " + "ab" * 700,
    ITEM,
    "start " + ITEM.upper().replace(" ", " -- ") + " end " + ITEM,
    "beta gamma delta epsilon zeta eta theta iota kappa",
    "tiny thing here and tiny thing again",
    f"Mail a.b+c@mail.example.com, x@y_z@w.de or @no; {CARD} and 4111-1111-1111-1112; +1 (555) 010-9999! 10.0.0.1 999.1.1.1 1.2.3.4.5",
    "4111111111111111 +49 30 1234567 v1.2.3.4 <|startoftext|> it's <|endoftext|> token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"",
    "1 2 3 4 5 6 7 8 9 0 " * 300 + "1" * 400,
    "Licensed under the Apache License, Version 2.0. GNU General-Public License; cc by-nc. MIT Licence mit license",
    "### *** $$$ a| <b> & % " * 20,
    "a a a a a a a a a b c d e f g h i j k l m n o p q r s t u v w x y z",
] + ["copy of the same text with a few more words in it"] * 3


@pytest.fixture(scope="module")
def rows(spark, folder):
    """(doc_id, text) of the awkward texts and of a whole small table."""
    prepared(spark)
    own = [(-1 - k, t) for k, t in enumerate(AWKWARD)]
    return own + [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = [(i, t, "en" if i % 3 else None, f"src{i % 4}", 7, "clash") for i, t in rows]
    return spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n_words bigint, id string").repartition(3)


def by_id(df, key="doc_id"):
    out = {r[key]: r.asDict() for r in df.collect()}
    assert len(out) == df.count()
    return out


def test_pieces_shuffle_neither_texts_nor_the_dictionary(spark, folder):
    docs = prepared(spark).read.parquet(f"{folder}/documents.parquet")
    model = sentence_pieces.load_model(tokenizer_path(PIECE_MODEL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sentence_pieces.encoded(docs, model, head=50, columns=["doc_id"], check=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"Exchange hashpartitioning\(([^,]*)#", plan)
    # the numbers of the texts' units, the rare units, the ids found for them
    assert sorted(shuffled) == ["h1", "h1", "unit"]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("units")]
    assert {r.round_trip for r in found.collect()} == {True}


def test_numbers_and_units_packed():
    rng = np.random.default_rng(1)
    for own in ([], [0], [0] * 9, [2**31, 0, 5], [*range(300)] * 3, rng.integers(0, 4000, 999).tolist(), rng.integers(0, 2**32 - 1, 99).tolist()):
        packed = sentence_pieces.numbered(np.array(own, dtype=np.int64))
        assert sentence_pieces.numbers_of(packed, len(own)).tolist() == own
    repeated, spread = np.tile(rng.integers(0, 4000, 50), 20), rng.integers(0, 4000, 999)
    assert sentence_pieces.numbered(repeated)[0] == 0 and sentence_pieces.numbered(spread)[0] == 1
    units = ["", "\u2581a", "\x00", "\U0001f600" * 96]
    table = sentence_pieces.unpacked_units(*sentence_pieces.packed_units(units, [1, 2**40, 3, 4]))
    assert table.to_pydict() == {"unit": units, "n": [1, 2**40, 3, 4]}


def test_texts_are_cut_many_at_a_time():
    cutter = sentence_pieces.Cutter(sentence_pieces.FINE)
    texts = ["One  two\nthree, 4!", None, "", "straße ÀÉÎ 日本語", "ends in a space ", " İstanbul\n\n x"]
    texts += ["“quoted” – it’s", "e\u0301 \u00a0\u2003½٣ 🙂🙂a🙂", "a \u2581 mark", "é🙂\nü🙂 🙂"]
    batch = pa.array(texts, pa.string())
    (_, _, data, offsets), = textbytes.blocks(batch)
    slow, (starts, ends, first, text, spaces, _) = cutter.block(data, offsets, texts)
    assert slow == {k: cutter.units(texts[k]) for k in (4, 8)}
    cut = sentence_pieces.marked(data, starts, ends, spaces).to_pylist()
    for k, t in enumerate(texts):
        if t and k not in slow:
            assert cut[first[k] : first[k + 1]] == cutter.units(t)
    tally = sentence_pieces.UnitTally()
    for _ in range(2):
        tally.add(data, starts, ends, spaces, sentence_pieces.unit_keys(textbytes.range_hashes(data, starts, ends), spaces))
    units, counts = tally.emptied()
    assert dict(zip(units.to_pylist(), counts.tolist())) == {u: 2 * cut.count(u) for u in cut} and len(tally) == 0


def test_merges_of_many_units_at_a_time_equal_the_library():
    import sentencepiece

    path = tokenizer_path(PIECE_MODEL)
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.load_model(path)
    texts = ["banana", "aaaaaaa", "unbelievably", "日本🙂語", "é\u0301x", "\x00ü", "x" * 95, "ab" * 40, "Q", "🙂", "internationalisation"]
    units = [sentence_pieces.SPACE + t for t in texts]
    codes = {p: order * sentence_pieces.IDS + i for p, i, order, _ in model.pieces} | {"": 0}
    places = [[(a, b) for a in range(len(u)) for b in range(a, len(u) + 1) if u[a:b] in codes] for u in units]
    edges = [[codes[u[a:b]] * 16384 + a * 128 + b for a, b in some][::-1] for u, some in zip(units, places)]
    found = sentence_pieces.merged_ids(pa.array(units), pa.array(edges, pa.list_(pa.int64())), np.array(model.byte_ids))
    assert found.to_pylist() == [library.encode(t) for t in texts]


def test_sentence_pieces_equal_the_library(docs, rows):
    import sentencepiece

    path = tokenizer_path(PIECE_MODEL)
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.load_model(path)
    for head in (sentence_pieces.HEAD, 0, 50):
        full = sentence_pieces.encoded(docs, model, head=head, check=True)
        got = by_id(full.select("doc_id", "ids", "n_tokens", "round_trip", sentence_pieces.decoded(full, model).alias("back")))
        assert len(got) == len(rows)
        for i, text in rows:
            want = library.encode(text or "")
            assert got[i]["ids"] == want, text
            assert got[i]["n_tokens"] == len(want)
            assert got[i]["back"] == library.decode(want) == (text or "").replace("\u2581", " ")
            assert got[i]["round_trip"] == (library.decode(want) == (text or ""))
    assert "round_trip" not in sentence_pieces.encoded(docs, model).columns


def test_round_trip_is_of_the_whole_text(spark):
    model = sentence_pieces.load_model(tokenizer_path(PIECE_MODEL))
    texts = ["a \u2581 mark", "a   mark", " lead", "trail ", None, "", "\u2581", "é\u0000ü" * 70, "=" * 500]
    found = sentence_pieces.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model, check=True)
    assert [r["round_trip"] for r in sorted(found.collect())] == [t is None or "\u2581" not in t for t in texts]


def test_viterbi_finds_the_best_path(spark):
    pieces = {"a": -1.0, "b": -1.2, "ab": -1.5, "ba": -2.0, "aba": -3.5, "c": -0.5, "bc": -1.3}
    model = sentence_pieces.Model(
        b"", [(p, k, k, s) for k, (p, s) in enumerate(pieces.items())], [p.encode() for p in pieces] + [b""] * 300,
        [100 + b for b in range(256)], sentence_pieces.COARSE, "unigram",
    )
    units = ["abab", "abc", "aabbcc", "cab", "xa", "zz", "abacaba"]

    def best(u):
        if not u:
            return 0.0, ()
        known = [(pieces[u[:k]] + best(u[k:])[0], (u[:k], *best(u[k:])[1])) for k in range(1, 4) if u[:k] in pieces and k <= len(u)]
        if u[0] not in pieces:
            known.append((min(pieces.values()) - 10 + best(u[1:])[0], (u[0], *best(u[1:])[1])))
        return max(known)

    got = sentence_pieces.unit_ids(spark.createDataFrame([(u, 1) for u in units], "unit string, n bigint"), model).collect()
    names = list(pieces)
    assert len(got) == len(units)
    for r in got:
        score = sum(pieces[names[i]] if i < 100 else -13.5 for i in r["ids"])
        assert score == pytest.approx(best(r["unit"])[0])


def base_rules(text):
    words = re.findall(UNSPACED, text or "")
    runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    n, hit = {}, set()
    for w in runs:
        n[w] = n.get(w, 0) + 1
    for k, w in enumerate(runs):
        if n[w] > 1:
            hit.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if re.search(UNSPACED, x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "base_failed": len(words) < 20 or 100 * len(hit) > 30 * len(words),
    }


def test_quality_rules(docs, rows):
    got = by_id(quality_rules.rule_verdicts(docs), "id")
    for i, text in rows:
        want = base_rules(text)
        assert {k: got[i][k] for k in want} == want, text
        assert not (got[i]["kept"] and want["base_failed"])
    assert len(got) == len(rows)


def plain_pii(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {
            "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
        }[kind]

    return {k: [m.span() for m in re.finditer(p, text or "") if ok(k, m[0])] for k, p in kinds.items()}


def test_personal_data(docs, rows):
    found = personal_data.personal_spans(docs)
    got, clean = by_id(personal_data.span_digest(found), "id"), by_id(personal_data.redacted(found), "id")
    for i, text in rows:
        want = plain_pii(text)
        listed = [f"{k}:{a}:{b}" for k, spans in want.items() for a, b in spans]
        assert {k: got[i][f"n_{k}"] for k in want} == {k: len(v) for k, v in want.items()}, text
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(got[i]["spans"].split(",")) | {""}
        assert not any(plain_pii(clean[i]["text"]).values()), clean[i]["text"][:300]
    secret = got[-18]["spans"]
    assert "secret:" in secret


def test_personal_data_places_in_texts_with_many_matches(spark):
    text = "é a@b.co " * 1000
    got = personal_data.span_digest(personal_data.personal_spans(spark.createDataFrame([(1, text)], "doc_id int, text string"))).first()
    assert got["n_email"] == 1000
    assert got["spans"] == ",".join(f"email:{9 * k + 2}:{9 * k + 8}" for k in range(1000))


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(text, items):
    words, hit, names = words_of(text), set(), set()
    for item, own in items:
        own = words_of(own)
        for w in {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9))} - {()}:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    names.add(str(item))
    listed = ",".join(sorted(names))
    return {
        "n_words": len(words), "n_hit": len(hit), "n_items": len(names), "contaminated": bool(hit),
        "items_sha256": hashlib.sha256(listed.encode()).hexdigest(),
    }


def test_decontaminate(spark, docs, rows, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()][:12]
    items += [(900, ITEM), (901, "Tiny thing"), (902, None), (903, "..."), (904, ITEM), (905, "word word word"), (11, "a a a a a a a a")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got, blocks = (by_id(decontaminate.contamination(docs, table, block=b), "id") for b in (decontaminate.BLOCK_WINDOWS, 60))
    assert got == blocks and len(got) == len(rows)
    for i, text in rows:
        want = plain_hits(text, items)
        assert {k: got[i][k] for k in want} == want, text


def test_decontaminate_without_items(spark, docs, rows):
    got = decontaminate.contamination(docs, spark.createDataFrame([], "item_id bigint, text string"))
    assert got.where("contaminated or n_items > 0").count() == 0 and got.count() == len(rows)


def test_licenses(docs, rows):
    got = by_id(licenses.license_notices(docs), "id")
    for i, text in rows:
        words, places, labels = words_of(text), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places)), text
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(r["labels"].split(",")) | {""}
        assert r["score"] == 1.0 or not places
    assert {"apache", "gpl", "cc-by", "cc-by-nc", "mit"} <= set(got[-20]["labels"].split(","))


def test_licenses_with_wrong_letters(spark):
    texts = ["under the GNU Genral Public Licence", "mozila public license", "a mitt licens", "general public library", None]
    got = licenses.license_notices(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("id").collect()
    assert [r["labels"] for r in got][:2] == ["gpl", "mpl"] and [r["labels"] for r in got][3:] == ["", ""]
    assert [tuple(s) for s in got[0]["spans"]] == [("gpl", 2, 4, 2)]


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    got = by_id(token_counts.token_counts(docs, tokenizer_path(TOKENIZER)), "id")
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 2048), text


def plain_fingerprint(text):
    import xxhash

    words = re.findall(UNSPACED, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    ids, owner = sorted(prints), {i: i for i in prints}
    for a in ids:  # smallest ids first: each class is walked once
        if owner[a] != a:
            continue
        todo = [a]
        while todo:
            x = todo.pop()
            for b in ids:
                if b != a and owner[b] == b and ((prints[x] ^ prints[b]) % (1 << 64)).bit_count() <= 4:
                    owner[b] = a
                    todo.append(b)
    return owner


def test_simhash(docs, rows):
    got = by_id(simhash.near_copies(docs), "id")
    prints = {i: plain_fingerprint(t) for i, t in rows}
    assert {i: r["fp"] % (1 << 64) for i, r in got.items()} == prints
    assert {i: r["component"] for i, r in got.items()} == plain_components(prints)


def test_simhash_links_of_crowded_fingerprints(spark):
    """Chains, stars and crowds of fingerprints at all small distances, beside far ones."""
    import random

    draw, prints = random.Random(5), {}
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            x = centre
            for b in draw.sample(range(64), draw.randint(0, 5)):
                x ^= 1 << b
            prints[len(prints)] = x
    for _ in range(200):
        prints[len(prints)] = draw.getrandbits(64)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in sorted(set(prints.values()))]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), 4).collect()
    parent = {x[0]: x[0] for x in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    want = plain_components(dict(enumerate(x[0] for x in signed)))
    groups, mine = {}, {}
    for k, (x,) in enumerate(signed):
        groups.setdefault(want[k], set()).add(x)
        mine.setdefault(root(x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_url_blocks(spark, folder):
    link, moved = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "https://a.net/1", link.format("https://b.example.org/es/9")),
        (2, "https://a.net/2", moved.format("https://a.net/1#part")),
        (3, "https://a.net/3", link.format("https://x.org/ok")),
        (4, "HTTPS://A.net/1#top", None),
        (5, None, ""),
        (6, "no host", "<p>"),
        (7, "http://Shop.COM/de/x?q", ""),
        (8, "https://b.example.org/es/9", ""),
        (9, "https://c.net/allow", link.format("https://d.com/de/1")),
        (9, "https://c.net/allow", moved.format("https://e.com/fr/1")),
        (10, "x://q.com", ""),
    ]
    got = [tuple(r) for r in url_blocks.judged(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()]
    assert sorted(got, key=lambda r: r[0]) == [
        (1, "a.net", "/1", None, "block"),
        (2, "a.net", "/2", None, "block"),
        (3, "a.net", "/3", None, "allow"),
        (4, "a.net", "/1", None, "block"),
        (5, "", "", None, "allow"),
        (6, "", "", None, "allow"),
        (7, "shop.com", "/de/x", "com/de/", "block"),
        (8, "b.example.org", "/es/9", "example.org/es/", "block"),
        (9, "c.net", "/allow", None, "allow"),
        (9, "c.net", "/allow", None, "allow"),
        (10, "q.com", "", None, "allow"),
    ]


def test_relative_urls_equal_the_standard_library(spark):
    from urllib.parse import urldefrag, urljoin

    bases = ["http://a.com/x/y?q=1", "https://b.org", "http://c.net/d/", "http://e.com/f/g/h#part"]
    targets = ["/de/1", "//host.com/x", "?p=2", "z", "./z", "../z", "../../../z/.", "a/../b/./c/..", "z?r=http://q.com/", "HTTP://W.com"]
    frame = spark.createDataFrame([(b, t) for b in bases for t in targets], "base string, target string")
    got = frame.select("base", "target", url_blocks.resolved(F.col("base"), F.col("target")).alias("r")).collect()
    for r in got:
        assert r.r == urldefrag(urljoin(r.base, r.target))[0].replace("http://W", "HTTP://W"), (r.base, r.target)
    dots = spark.createDataFrame([("http://a.com/", "http://w.com/a/../b?x=../y")], "base string, target string")
    assert dots.select(url_blocks.resolved(F.col("base"), F.col("target"))).first()[0] == "http://w.com/b?x=../y"
    none = spark.createDataFrame([("http://a.com/", "#x"), ("http://a.com/", "mailto:a@b.c"), ("no host", "/x"), ("http://a.com/", None)], "base string, target string")
    assert {r[0] for r in none.select(url_blocks.resolved(F.col("base"), F.col("target"))).collect()} == {None}


def test_url_blocks_by_relative_links_equal_the_sql(spark, tmp_path):
    import duckdb

    from slatewright.llm.oracle import ORACLE

    link, moved = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://a.com/x", moved.format("/de/1")),
        (2, "http://b.com/x/y", link.format("../de/2")),
        (3, "http://c.net/3", link.format("//d.com/de/3")),
        (4, "http://c.net/4", moved.format("?again=1")),
        (5, "http://c.net/4?again=1", link.format("http://e.com/de/5")),
        (6, "http://f.net/6", link.format("mailto:x@y.z")),
        (7, "http://shop.com/fr/7", link.format("/other")),
        (8, "http://shop.com/other", link.format("/de/8")),
        (9, None, moved.format("/de/9")),
        (10, "no host", link.format("/de/1")),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "'x' AS node", "0 AS tag")
    got = sorted(tuple(r) for r in url_blocks.judged(df).collect())
    assert [r[4] for r in got] == ["block"] * 5 + ["allow"] * 5
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    assert sorted(con.execute(ORACLE["op8_url_blocks"]).fetchall()) == got


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    model = sentence_pieces.load_model(tokenizer_path(PIECE_MODEL))
    for df in (
        simhash.near_copies(docs), quality_rules.rule_verdicts(docs), personal_data.personal_spans(docs), licenses.license_notices(docs),
        token_counts.token_counts(docs, tokenizer_path(TOKENIZER)), sentence_pieces.encoded(docs, model, check=True),
        sentence_pieces.encoded(docs, model), url_blocks.judged(pages),
    ):
        assert df.count() == 0


def test_components_of_long_chains_and_stars(spark):
    from slatewright.llm.components import components

    edges = [(k, k + 1) for k in range(40)] + [(100, 101 + k) for k in range(50)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u bigint, v bigint"), "u", "v").collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 151)} | {200: 200, 201: 200}
    assert got == want
