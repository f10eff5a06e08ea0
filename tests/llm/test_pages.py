import html
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.llm import pages, queries
from tests.llm.cases import empty

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"
ODD = {
    1: None, 2: "", 3: "plain < text & more", 4: "<html><body><nav>menu</nav></body></html>",
    5: "<article><h1>A &lt;title&gt;</h1><p>one\n\t two&nbsp;three<br>four<p>five <b>six</b><i>seven</i></article><footer>f</footer>",
    6: "<article><p>kept</p><aside><p>side</p></aside><div class='ad'>buy</div><script>var x='<p>';</script><style>p{}</style><!-- no --><p>too</p>",
    7: "<article><p>" + "long word " * 30_000 + "</p></article>",
}
WANT = {1: "", 2: "", 4: "", 5: "A <title>\none two three four\nfive sixseven", 6: "kept\ntoo", 7: ("long word " * 30_000).strip()}


def article(source):
    """The article of a page of the given table, by its marks."""
    source = re.sub(r"<(script|style).*?</\1>", "", source or "", flags=re.S)
    found = re.search(r"<article>(.*?)</article>", source, re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " ")) if found else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_query_against_the_marks_of_the_pages(spark):
    want = {r["page_id"]: article(r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.QUERIES["op2_html_extraction"](spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_awkward_pages(spark):
    known = spark.read.parquet(f"{SF}/pages.parquet")
    odd = spark.createDataFrame([(-k, None, v) for k, v in ODD.items()] + [(-6, "u", ODD[6])], SCHEMA)
    out = pages.extract(known.unionByName(odd).withColumn("_text", F.lit("x")).withColumn("text", F.lit("y"))).where("page_id < 0")
    rows = out.collect()
    assert len(rows) == len(ODD) + 1 and out.columns == ["page_id", "url", "_text", "text"]
    for r in rows:
        if -r["page_id"] in WANT:
            assert r["text"] == WANT[-r["page_id"]]


def test_empty_table(spark):
    assert pages.extract(empty(spark, SCHEMA)).count() == 0


@pytest.mark.parametrize("source, want", [
    ("<p>a<p>b<ul><li>c<li>d</ul>e", ["a", "b", "c", "d", "e"]), ("<div>a<span>b</span></div></div>c", ["ab", "c"]),
    ("&copy;&#233;&am", ["©é&am"]), ("<select><option>x<option>y</select>", ["x", "y"]), ("<svg><text>t</text></svg>u", ["u"]), ("a<", ["a<"]),
])
def test_blocks(source, want):
    assert [text for _, text, _ in pages.blocks_of(source)] == want


def nested(inside, depth=10):
    return "".join(f"<div class='{n}'>" for n in ("container", "row", "col", "wrap", "q1", "q2", "q3", "q4", "q5", "q6")[:depth]) + inside + "</div>" * depth


def test_furniture_and_articles_ten_levels_deep(spark):
    said = "A sentence of the article with some words in it."
    sides = {"footer class='site'": "footer", "nav": "nav", "div class='sidebar'": "div", "aside": "aside", "div class='comments'": "div"}
    rows, want = [], {}
    for n, (start, tag) in enumerate(sides.items(), 1):
        side = f"<{start}>" + nested(f"<ul><li>{said}</li><li>Read more of this here.</li></ul>") + f"</{tag}>"
        rows.append((-n, None, f"<html><body><article>{nested(f'<p>{said}</p><p>Second part, {n}.</p>')}</article>{side}</body></html>"))
        want[-n] = f"{said}\nSecond part, {n}."
    out = pages.extract(spark.read.parquet(f"{SF}/pages.parquet").unionByName(spark.createDataFrame(rows, SCHEMA))).where("page_id < 0")
    assert {r["page_id"]: r["text"] for r in out.collect()} == want


def test_vectors_tell_the_whole_path_and_text():
    deep = tuple(t for k in range(10) for t in ("div", f".n{k}"))
    one, two = pages.vectors([(("body", "footer", *deep), "a", 0.0), (("body", "article", *deep), "a", 0.0)])[:, :pages.PATH]
    assert (one != two).any()
    one, two = pages.vectors([((), "a " * 60 + end, 0.0) for end in ("first", "other")])[:, pages.PATH:pages.PATH + pages.WORDS]
    assert (one != two).any()


def test_names_of_inline_elements_around_a_block():
    got = [path for path, _, _ in pages.blocks_of("<p><span class=ad>buy <b>now</b></span></p><p>so <span class=ad>buy</span></p><p><span class=ad>a</span> b</p>")]
    assert got == [("p", ".ad"), ("p",), ("p",)]


def test_a_page_of_many_blocks_takes_little_memory():
    network = pages.train([])
    source = "<article>" + "<p>Some words of a short block.</p>" * 20_000 + "</article><footer>" + "<p>x</p>" * 9_000 + "</footer>"
    long, short = pages.blocks_of(source), pages.blocks_of(pages.MADE)
    tracemalloc.start()
    marked = network.labels([long] + [short] * 63)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(marked[0]) == 29_000 and all(len(m) == len(short) for m in marked[1:])
    assert peak < 100e6


def test_labels_do_not_depend_on_what_is_read_together(monkeypatch):
    network = pages.train([])
    read = [pages.blocks_of("<nav>" + "<p>menu</p>" * k + "</nav><article>" + "<p>One two three.</p>" * (3 * k) + "</article>") for k in range(1, 30)]
    whole = [network.logits([blocks])[:, 0] for blocks in read]
    for blocks, one in zip(read, whole):  # the same as the network that is trained
        x, mask = pages._padded([pages.vectors(blocks)])
        assert np.allclose(network._output(network.states(x, mask)[0], x)[:, 0], one, atol=1e-3)
    monkeypatch.setattr(pages, "CELLS", 50)
    for one, small in zip(whole, [network.logits([blocks])[:, 0] for blocks in read]):
        assert np.allclose(one, small, atol=1e-3)
    assert all(((one > 0) == got).all() for one, got in zip(whole, network.labels(read)))


def test_pages_of_any_length_are_learned_from(spark, monkeypatch):
    learned, train = [], pages.train
    monkeypatch.setattr(pages, "train", lambda sample: learned.extend(sample) or train(sample))
    filler = "".join(f"<p>Sentence number {i} of a long page.</p>" for i in range(5_000))
    rows = [(n, None, f"<article><h1>Page {n}</h1>{filler}</article><footer>f</footer>") for n in range(3)]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(learned) == 3 and all(len(head) == pages.HEAD_CHARS for head in learned)
    assert all(text.startswith(f"Page {n}\nSentence number 0") and text.count("\n") == 5_000 for n, text in out.items())
    read = [pages._learned(head, np.random.default_rng(n)) for n, head in enumerate(learned)]
    assert all(len(blocks) == pages.LEARNED for blocks in read) and read[0][0] != read[1][0]
