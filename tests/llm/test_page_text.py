import random

import pyarrow as pa
import pyarrow.compute  # noqa: F401

from ridelens.llm import page_text
from ridelens.llm.page_text import main_text, page_blocks

NAV = "<nav><ul><li><a href='/a'>Home</a><li>About</ul></nav>"
HEAD = "<head><title>T &amp; U</title><style>p{}</style><script>var t='</p>';</script></head>"


def page(body, after=""):
    return f"<!DOCTYPE html><html>{HEAD}<body>{NAV}<!-- x --><div class='ad'>Buy it.</div>{body}<footer>&copy; me</footer>{after}"


def text(spark, pages):
    rows = [(i, f"http://h.org/{i}", h, "x") for i, h in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    return {r.page_id: r.text for r in main_text(frame).collect()}


def test_articles_lose_all_but_their_text(spark):
    article = ("<article><h1>A&nbsp;title</h1><p><b>First &lt;one&gt;\n two<br>three<p>Second &am<form><input>send</form>"
               "<aside>side</aside><div id='comments'><p>me too</p></div><p>Last <span class=ad>gone</span><i>on</i>e</p></article>")  # fmt: skip
    got = text(spark, [page(article), page(article), None, "", page("<article>", "</body>"), "<p>cut <b", "no markup"])
    want = "A title\n\nFirst <one> two three\n\nSecond &am\n\nLast one"
    assert got == {0: want, 1: want, 2: "", 3: "", 4: "", 5: "cut", 6: "no markup"}


def test_without_article_repeated_runs_go_and_unique_ones_stay(spark):
    shared = "all that every page of this host says at its end"
    own = [" ".join(f"word{k}{j}" for j in range(9)) for k in range(5)]
    got = text(spark, [page(f"<div>{shared}</div><p>{own[k]}</p>") for k in range(5)])
    assert got == dict(enumerate(own))


def test_shards_of_a_large_host_agree(spark, monkeypatch):
    monkeypatch.setattr(page_text, "SHARD", 2)
    rng = random.Random(5)
    own = [" ".join(str(rng.randrange(10_000)) for _ in range(20)) for _ in range(12)]
    got = text(spark, [page(f"<p>{own[k]}</p><p>one notice that stands on each and every page of the host</p>") for k in range(12)])
    assert got == dict(enumerate(own))


def test_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "http://h/x", page("<p>some words of a page that came twice into the table</p>"))] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = main_text(frame).collect()
    assert [r.text for r in got] == ["some words of a page that came twice into the table"] * 2
    assert [r.n_chars for r in got] == [len(got[0].text)] * 2
    assert main_text(frame.limit(0)).count() == 0


def test_very_long_and_broken_markup_ends():
    assert len(page_blocks("<div>" * 20_000 + "x")) == 1
    assert page_blocks("<p>a<script>never closed")[0][0] == "a"
    assert page_blocks("<p title=\"unclosed>a</p><p>b</p>")


def test_the_result_does_not_depend_on_the_shard(spark, monkeypatch):
    rng = random.Random(6)
    own = [" ".join(str(rng.randrange(10_000)) for _ in range(30)) for _ in range(12)]
    # a block that differs in a number, and one that otherwise stands on marked pages only
    stamped = "{} pages like this one were served by the same old machine in the cellar"
    marked = "what an unmarked footer says here and every marked page says outside its article"
    pages = [page(f"<p>{own[k]}</p><p>{stamped.format(k)}</p>") for k in range(6)]
    pages += [page(f"<article><p>{own[k]}</p></article><div>{marked}</div>") for k in range(6, 11)]
    pages += [page(f"<p>{own[11]}</p><div>{marked}</div>")]
    monkeypatch.setattr(page_text, "SHARD", 1)
    assert text(spark, pages) == dict(enumerate(own))
    monkeypatch.setattr(page_text, "SHARD", 512)
    assert text(spark, pages) == dict(enumerate(own))


def test_copies_of_unmarked_pages_keep_their_text(spark, monkeypatch):
    rng = random.Random(7)
    own = ["\n\n".join(" ".join(str(rng.randrange(10_000)) for _ in range(25)) for _ in range(4)) for _ in range(8)]
    own += [own[0], own[0], own[1].replace(own[1].split()[40], "edited")]  # equal and nearly equal pages
    notice = "one notice that stands on each and every page of the host"
    pages = [page("".join(f"<p>{p}</p>" for p in ["Introduction", *t.split("\n\n"), notice])) for t in own]
    want = {i: f"Introduction\n\n{t}" for i, t in enumerate(own)}
    assert text(spark, pages) == want
    monkeypatch.setattr(page_text, "SHARD", 2)
    assert text(spark, pages) == want


def test_boilerplate_inside_articles_goes_and_quotes_stay(spark, monkeypatch):
    rng = random.Random(8)
    own = [" ".join(str(rng.randrange(10_000)) for _ in range(30)) for _ in range(12)]
    legal = "read more of this in our weekly letter which comes at no charge to you"
    quote = "a passage that two of the articles quote word by word from an older text"
    bodies = [f"<p>{t}</p>" + (f"<p>{quote}</p>" if i < 2 else "") for i, t in enumerate(own)]
    pages = [page(f"<{tag}>{b}<div class='x1'>{legal}</div></{tag}>") for b, tag in zip(bodies, ["article", "main"] * 6)]
    want = {i: t + (f"\n\n{quote}" if i < 2 else "") for i, t in enumerate(own)}
    assert text(spark, pages) == want
    monkeypatch.setattr(page_text, "SHARD", 3)
    assert text(spark, pages) == want


def test_marks_do_not_drop_parts_of_an_article(spark):
    parts = ["<h2 id='related-work'>Related</h2>", "<section id='search'><p>Search</p></section>", "<div id='social-costs'>Costs</div>",
             "<div class='notice'>Notice</div>", "<div title='The hidden cost'>Title</div>", "<div data-title='a hidden gem of x'>Data</div>",
             "<p>Let <math><mi>x</mi></math> be</p>", "<h2 id='comments'>Comments</h2>"]
    out = ["<div class='ad'>no</div>", "<div class='share-buttons'>no</div>", "<div hidden>no</div>", "<div id='comments'>no</div>",
           "<div class='x related-posts'>no</div>", "<div role=complementary>no</div>"]
    body = "".join(f"<p>part {k}</p>{p}" for k, p in enumerate(parts))
    teaser = "<main><p>The text of the page stands in its main element.</p><article>A teaser</article></main>"
    got = text(spark, [page(f"<article title='a hidden thing'>{body}{''.join(out)}</article>"), page(teaser)])
    names = ["Related", "Search", "Costs", "Notice", "Title", "Data", "Let x be", "Comments"]
    assert got[0].split("\n\n") == [x for k, name in enumerate(names) for x in (f"part {k}", name)]
    assert got[1] == "The text of the page stands in its main element.\n\nA teaser"


def test_only_runs_that_shards_share_travel_whole(spark, monkeypatch):
    rng = random.Random(9)
    shared = "one line of twelve words that all the pages of this host repeat"
    blocks = [[(" ".join(str(rng.randrange(10**6)) for _ in range(300)), page_text.OPEN), (shared, page_text.OPEN)] for _ in range(8)]
    assert [page_text._unpack(page_text._pack(b)) for b in [*blocks, []]] == [tuple(map(list, zip(*b))) if b else ([], []) for b in [*blocks, []]]

    def shard(k):
        own = blocks[2 * k : 2 * k + 2]
        columns = {"host": ["h"] * 2, "shard": [k] * 2, "shards": [4] * 2, "packed": [page_text._pack(b) for b in own], "key": [2 * k, 2 * k + 1]}
        return pa.table(columns)

    sent = pa.Table.from_batches([b for k in range(4) for b in page_text._marks(iter(shard(k).to_batches()))])
    met = pa.Table.from_batches(page_text._met(iter(sent.to_batches())))
    runs_of_line = len(shared.split()) - page_text.RUN + 1
    for k in range(4):
        whole = page_text._evidence(shard(k), met.filter(pa.compute.equal(met["shard"], k)))
        assert [len(x) // 8 for x in whole["hashes"].to_pylist()] == [runs_of_line]  # of about 600 runs
    assert sum(map(len, sent["marks"].to_pylist())) < 4 * 600 * 4.5
    # marks that many runs share by chance change nothing
    pages = [page("".join(f"<p>{b}</p>" for b, _ in own)) for own in blocks]
    monkeypatch.setattr(page_text, "MARK_BITS", 4)
    monkeypatch.setattr(page_text, "SHARD", 3)
    assert text(spark, pages) == {i: own[0][0] for i, own in enumerate(blocks)}
