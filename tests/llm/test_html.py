import html as entities
import re
import time

import numpy as np
import pytest

from tokenloom.llm import html as h

PAGES = "/root/testdata/sf0.01/pages.parquet"


def article(page):
    """What the article element holds, by plain text handling."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    inner = re.sub(r"</?(p|h1|br)>", " ", inner)
    return " ".join(entities.unescape(re.sub(r"</?b>", "", inner)).split())


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(PAGES).orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def weights(pages):
    return h.train(h.training_pages(pages[:150]))


def texts(page):
    return [b.text for b in h.blocks(page)]


def test_blocks():
    assert texts("<p>a<b>b</b> c<br>d<p>e &amp; f&nbsp; g</p>\n h ") == ["ab c", "d", "e & f g", "h"]
    assert texts('<script>var t="</p>"; x < y</script><style>p{}</style><!-- <p>no</p> -->yes<!-- open') == ["yes"]
    assert texts("<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>") == ["one", "two", "1", "2", "3"]
    assert texts("a < b and 3<4 &lt;p&gt; &am <a href='x>y'>z</a> it's <p title=don't>don't</p> end <div class=") == ["a < b and 3<4 <p> &am z it's", "don't", "end"]
    assert texts("") == [] and texts("<div></div>") == []


def test_paths_of_unclosed_elements():
    inside = {b.text: b.main for b in h.blocks("<nav>n</nav><article><p><b>one<br><p>two</p><aside>three</aside></article><footer>four")}
    assert inside == {"n": False, "one": True, "two": True, "three": False, "four": False}
    # An inline end tag closes no block.
    assert [(b.text, b.main) for b in h.blocks("<b><article>x</b>y</article>z")] == [("xy", True), ("z", False)]


def test_deep_and_broken_pages_take_linear_time():
    began = time.time()
    assert len(h.blocks("<div>" * 100_000 + "x" + "<p>y" * 100_000)) == 100_001
    assert texts("<a b=\"" * 100_000 + "x")[-1:] in ([], ["x"])
    assert len(h.blocks("<p class='a" + "<b>" * 100_000 + "x")) <= 1
    assert time.time() - began < 60


def test_gradients_equal_differences(pages):
    batch = h.batch_of(h.training_pages(pages[:3], 1))
    w = {k: v.astype(np.float64) for k, v in h.new_weights().items()}

    def loss():
        z = h.scores(w, batch)
        return np.mean(np.logaddexp(0, z) - batch.labels * z)

    _, g = h.gradients(w, batch)
    for name, value in w.items():
        at = np.unravel_index(np.argmax(np.abs(g[name])), value.shape)
        old = value[at]
        value[at] = old + 1e-4
        up = loss()
        value[at] = old - 1e-4
        down = loss()
        value[at] = old
        assert abs((up - down) / 2e-4 - g[name][at]) < 1e-3 * abs(g[name][at]) + 1e-6


def test_held_out_pages(pages, weights):
    """Pages and layouts that were not trained on: the article exactly, and nearly all blocks of other layouts."""
    held = pages[150:]
    assert list(h.texts_of(weights, held)) == [article(p) for p in held]
    fresh = h.training_pages(held, layouts=2, seed=123)[len(held) :]
    right = [b.main == m for p, main in zip(fresh, h.label(weights, fresh), strict=True) for b, m in zip(p, main, strict=True)]
    assert np.mean(right) > 0.98


def test_labels_do_not_depend_on_the_batch(pages, weights):
    cut = [h.blocks(p) for p in pages[:40]]
    alone = [h.label(weights, [c])[0].tolist() for c in cut]
    assert [m.tolist() for m in h.label(weights, cut)] == alone
    assert h.label(weights, [[], cut[0], []])[1].tolist() == alone[0]


def test_rows(spark, pages, weights):
    long = "<html><body><nav><a>menu</a></nav><article>" + "<p>A sentence of a very long page.</p>" * 20_000 + "</article></body></html>"
    rows = [(1, "u", pages[0]), (1, "u", pages[0]), (2, None, None), (3, "", ""), (None, "v", pages[1]), (4, "w", long)]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = h.extract(df, weights)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in out.collect()))
    one, two, last = article(pages[0]), article(pages[1]), " ".join(["A sentence of a very long page."] * 20_000)
    assert got == [(0, two, len(two)), (1, one, len(one)), (1, one, len(one)), (2, "", 0), (3, "", 0), (4, last, len(last))]
    assert h.extract(df.limit(0)).count() == 0
    assert [r.text for r in h.extract(df.filter("page_id in (2, 3)")).collect()] == ["", ""]
