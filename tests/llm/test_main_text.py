"""Main text against a plain version over whole hosts, and chrome that class names tell."""

from pyspark.sql.types import StringType

from slatewright.llm import main_text
from slatewright.llm.main_text import CHROME, MAIN, MAIN_PAGES, OPEN, RUN, page_blocks
from slatewright.llm.queries import prepared
from slatewright.session import written


def plain(pages):
    """(page_id, text) of (page_id, url, html), with loops over all pages of each host."""
    hosts = {}
    for i, url, source in pages:
        host = (url or "").split("://", 1)[1].split("/")[0].lower() if "://" in (url or "") else ""
        hosts.setdefault(host, []).append((i, page_blocks(source or "")))

    def windows(text):
        w = text.split()
        return [tuple(w[k : k + RUN]) for k in range(max(1, len(w) - RUN + 1))]

    out = []
    for own in hosts.values():
        distinct = {" ".join(t for t, _ in blocks): blocks for _, blocks in own}.values()
        runs, lines = {}, {}
        for blocks in distinct:
            for run in {r for t, m in blocks if m != MAIN for r in windows(t)}:
                runs[run] = runs.get(run, 0) + 1
            for line in {t for t, m in blocks if m == MAIN}:
                lines[line] = lines.get(line, 0) + 1
        for i, blocks in own:
            if any(m == MAIN for _, m in blocks):
                kept = [t for t, m in blocks if m == MAIN and not (lines[t] >= MAIN_PAGES and 2 * lines[t] >= len(distinct))]
            else:
                kept = []
                for t, m in blocks:
                    if m == OPEN:
                        gone = {k + j for k, r in enumerate(windows(t)) if runs[r] > 1 for j in range(RUN)}
                        kept.append(" ".join(w for k, w in enumerate(t.split()) if k not in gone))
            out.append((i, "\n".join(t for t in kept if t)))
    return sorted(out, key=repr)


def run(spark, pages):
    prepared(spark)
    df = spark.createDataFrame([(*p, "r", 1) for p in pages], "page_id int, url string, html string, host string, row int").repartition(3)
    return sorted(((r.page_id, r.text) for r in main_text.main_text(df).collect()), key=repr)


def test_whole_table_equals_the_plain_version(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert run(spark, rows) == plain(rows)


def test_repeated_runs_in_and_outside_main_elements(spark):
    menu, line = "<div>Home News Sports Weather Contact About us today</div>", "Subscribe to our letter and read it every morning"
    quote = "a passage that some pages quote from one another word by word"
    pages = [(k, f"http://a.org/{k}", f"<main><p>own words of page {k}</p><p>{line}</p>" + f"<p>{quote}</p>" * (k < 3) + "</main>") for k in range(9)]
    pages += [(20 + k, f"http://b.org/{k}", f"{menu}<p>page {k} says something of its own here</p><p>and {line} number {k}</p>") for k in range(4)]
    pages += [pages[0], (None, None, None), (31, None, ""), (32, "http://b.org/x", "word " * 20_000), (33, "http://c.org/1", f"<article>{line}</article>")]
    got = run(spark, pages)
    assert got == plain(pages)
    texts = dict(got)
    assert texts[1] == f"own words of page 1\n{quote}" and texts[5] == "own words of page 5"
    assert texts[20] == "page 0\n0" and texts[33] == line


def test_no_texts_are_written_or_shuffled(spark, folder, monkeypatch):
    prepared(spark)
    kept = []
    monkeypatch.setattr(main_text, "written", lambda df, name: (kept.append(df), written(df, name))[1])
    found = main_text.main_text(spark.read.parquet(f"{folder}/pages.parquet"))
    assert found.count() and {f.name for df in kept for f in df.schema if f.dataType == StringType()} == {"host"}
    # no page of this table repeats a block so often that something is covered: nothing is left to join with
    assert "SortMergeJoin" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()


def test_markup_that_differs_in_pages_with_the_same_words(spark):
    # one page by its words, so the blocks of both forms count once, each form keeps its own
    pages = [(k, f"http://a.org/{k}", f"<main><p>page {k}</p><p>a line of all</p></main>") for k in range(6)]
    pages += [(9, "http://a.org/9", "<main><p>page 0</p></main><p>a line of all</p>"), (10, "http://a.org/9", "<p>page 0</p><p>a line of all</p>")]
    assert dict(run(spark, pages)) == {**{k: f"page {k}" for k in range(6)}, 9: "page 0", 10: "page 0\na line of all"}


def test_no_pages(spark):
    assert run(spark, []) == []


def test_chrome_by_class_names():
    for name in ("comment-list", "cookie-banner", "ad-slot", "share-buttons", "main-menu", "newsletter_signup", "ad"):
        assert page_blocks(f"<article><p>text</p><div class='{name}'>chrome</div></article>") == [("text", MAIN), ("chrome", CHROME)], name
    for name in ("has-sidebar", "content-with-sidebar", "comments-open", "sidebar-layout", "adventure", "shared", "ad-free-article"):
        assert page_blocks(f"<div class='{name}'><article>text</article></div>") == [("text", MAIN)], name
    # names that would take all main elements away don't count, but those of comments do
    assert page_blocks("<div class='promo-box'><article>text</article></div>") == [("text", MAIN)]
    assert page_blocks("<div class='banner'><main>text</main></div>") == [("text", MAIN)]
    page = "<article>text</article><div class='comments'><article>a reader</article></div>"
    assert page_blocks(page) == [("text", MAIN), ("a reader", CHROME)]
    assert page_blocks("<nav><article>text</article></nav>") == [("text", CHROME)]
