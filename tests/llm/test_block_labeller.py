import random
import time

import numpy as np
import pytest

from tidemill.llm import block_labeller as bl

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav><div class="ad">Buy  now</div>
<article><h1>Fish &amp; chips</h1><p><b>First
 paragraph &lt;one&gt; with enough words in it.<br><p>Second&nbsp;paragraph<br>goes on, and on, and on.</p><script>x("</article>")</script>
<p>Third</p></article><div id="comments"><div class="comment"><p>Nice read!</p></div></div><footer>&copy; 2024 site</footer>"""


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = bl.Network()
    x = rng.normal(size=(4, 3, bl.PATH + bl.WORDS + bl.FIGURES))
    mask = np.asarray([[1, 1, 1], [1, 1, 1], [1, 0, 1], [1, 0, 0]], float)
    y = rng.integers(0, 2, (4, 3)).astype(float)

    def loss():
        p = net._forward(x, mask)[0]
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for k, v in net.p.items():
        for at in rng.integers(0, v.size, 6):
            old, h = v.flat[at], 1e-5
            v.flat[at] = old + h
            up = loss()
            v.flat[at] = old - h
            down = loss()
            v.flat[at] = old
            assert abs((up - down) / (2 * h) - grads[k].flat[at]) < 1e-6, k


def test_blocks_of_a_page():
    assert [b.text for b in bl.blocks(PAGE)] == ["Home", "About us", "Buy now", "Fish & chips", "First paragraph <one> with enough words in it.", "Second paragraph goes on, and on, and on.", "Third", "Nice read!", "© 2024 site"]
    for odd in ("", "plain text", "<p", "<script>never closed", "a<b", "<!-- open", "</p></div>x", "<p>&am", "<div " * 2000):
        bl.blocks(odd)
    assert [b.text for b in bl.blocks("plain &eacute;")] == ["plain é"]


@pytest.fixture(scope="module")
def network():
    return bl.trained()


def test_held_out_pages(network):
    rng, right, all_ = random.Random(999), 0, 0
    for _ in range(200):
        page, labels = bl.sample_page(rng)
        scores = network.scores([bl.blocks(page)])[0]
        right += int(((scores >= 0.5) == (np.asarray(labels) > 0)).sum())
        all_ += len(labels)
    assert right / all_ > 0.985


def test_extract(spark, network):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (None, "v", "<nav><a href=x>m</a></nav>"), (1, "u", PAGE), (5, "w", "<p>" + "word " * 200_000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_text", bl.F.lit(1))
    got = bl.extract(pages, network=network).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == "Fish & chips\n\nFirst paragraph <one> with enough words in it.\n\nSecond paragraph goes on, and on, and on.\n\nThird"
    assert text[2] == text[3] == text[None] == "" and len(text[5]) == 999_999
    assert bl.extract(pages.limit(0), network=network).collect() == []
    assert network.scores([]) == []


def test_nothing_inside_a_block_is_lost():
    page = "<p>Let <math><mi>x</mi><mo>=</mo>1</math> be\u2003a <object>shown</object> <canvas>drawn</canvas> <svg><text>label</text></svg> number.<p title='a>b' class=c>two"
    assert [b.text for b in bl.blocks(page)] == ["Let x=1 be a shown drawn label number.", "two"]
    assert [b.text for b in bl.blocks("<p class='open>one</p><p>two")] == ["one", "two"] and [b.text for b in bl.blocks("1 < 2 <b>and</b> 3 <x")] == ["1 < 2 and 3 <x"]


def test_hostile_pages_take_one_pass():
    began = time.perf_counter()
    for page in ("<p title='x" * 40_000, "<p title='x" * 20_000 + "'>y", "<a b=\"'" * 20_000 + ">y", "<div>t" * 20_000, "<span>" * 20_000 + "x" + "</b>" * 20_000, "<!-- " * 20_000, "<" * 200_000, "<ul><li>t" * 10_000):
        bl.blocks(page)
    assert time.perf_counter() - began < 20


def plain_blocks(nodes, out, run):
    """The texts of a tree of (tag, children) and texts, block by block."""
    for n in nodes:
        if isinstance(n, str):
            run.append(n)
        elif n[0] == "br":
            run.append(" ")
        else:
            inline = n[0] in ("b", "a", "math")
            if not inline:
                out.append("".join(run))
                run.clear()
            plain_blocks(n[1], out, run)
            if not inline:
                out.append("".join(run))
                run.clear()
    return out


def tree(rng, depth=0):
    return [rng.choice(["one two", " x ", "a &lt; b", "\n", "é"]) if rng.random() < 0.5 or depth > 5 else ("br", []) if rng.random() < 0.1 else (rng.choice(["div", "section", "b", "a", "math", "blockquote", "h2"]), tree(rng, depth + 1)) for _ in range(rng.randrange(1, 5))]


def markup(nodes):
    return "".join(n if isinstance(n, str) else "<br>" if n[0] == "br" else f"<{n[0]} class='k{len(n[1])}'>{markup(n[1])}</{n[0]}>" for n in nodes)


def test_blocks_equal_those_of_a_plain_walk():
    rng = random.Random(6)
    for _ in range(500):
        nodes, run = tree(rng), []
        out = plain_blocks(nodes, [], run)
        want = [" ".join(x.replace("&lt;", "<").split()) for x in [*out, "".join(run)] if x.strip()]
        assert [b.text for b in bl.blocks(markup(nodes))] == want


def test_long_pages_score_as_in_one_piece(network, monkeypatch):
    rng = random.Random(5)
    pages = [bl.blocks("".join(bl.sample_page(rng)[0] for _ in range(k))) for k in (1, 30, 3)]
    want = network.scores(pages)
    monkeypatch.setattr(bl, "RUN", 7)
    for a, b, page in zip(want, network.scores(pages), pages, strict=True):
        assert len(a) == len(page) and np.allclose(a, b, atol=1e-5)
        x = bl.vectors(page, 0, len(page))
        assert np.allclose(a, network._forward(x[:, None], np.ones((len(page), 1)))[0][:, 0], atol=1e-4)


def test_query_gives_the_main_text(spark, tmp_path):
    rng = random.Random(77)
    pages, want = [], {}
    for k in range(120):
        page, labels = bl.sample_page(rng)
        found = bl.blocks(page)
        if len(found) == len(labels):
            pages.append((k, f"u{k}", page))
            want[k] = "\n\n".join(b.text for b, y in zip(found, labels, strict=True) if y)
    pages += [(900, None, None), (901, "u", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r for r in bl.op3_block_labeller(spark, str(tmp_path)).collect()}
    assert list(got[900].asDict()) == ["page_id", "url", "text", "n_chars"] and got[900]["text"] == got[901]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert sum(got[k]["text"] == t for k, t in want.items()) >= 0.9 * len(want)
