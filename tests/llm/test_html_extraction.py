import pytest

from cardledger.llm import html_extraction as op

LABELLED = [
    f"<html><head><title>T {i}</title></head><body><nav><ul><li><a href=x>Home page</a></li><li><a>News</a></li></ul></nav>"
    f"<div class=ad>Buy now {i}</div><article><h1>Head {i}</h1><p>{'word ' * 30}</p><p>{'more ' * 20}</p></article>"
    f"<footer>Copyright {i}</footer></body></html>"
    for i in range(5)
]
TEXT = "one two three four five six seven eight nine ten"


@pytest.fixture(scope="module")
def weights():
    return op.train(LABELLED)


@pytest.mark.parametrize("trained", [True, False])
@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("plain words", "plain words"),
        (f"<p>{TEXT}</p>", TEXT),
        (f"<article><p>{TEXT}<p>A&amp;B &eacute;&#233;&nbsp;x<br>y</article>", f"{TEXT}\nA&B éé x y"),
        (f"<article><h1>Hi</h1>\n<p>a <b>b</b>c\n\n d</p><p> </p><p>{TEXT}</p></article>", f"Hi\na bc d\n{TEXT}"),
        (f"<nav>{TEXT}</nav><header><h1>Site</h1></header><main><p>{TEXT}</p></main><aside>{TEXT}</aside>", TEXT),
        (f"<main><p>{TEXT}</p><script>var a='<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> --><p>end</p></main>", f"{TEXT}\nend"),
        (f"<article><p>{TEXT}</p><div class='ad banner'>buy this</div><form>name <input></form><p>end.</p></article>", f"{TEXT}\nend."),
        (f"<article><p>{TEXT}</p><section class=\"comments\"><p>{TEXT} {TEXT}</p></section></article>", TEXT),
        (f"<div id=cookie-notice>{TEXT} {TEXT}</div><div class=content><h2>Head</h2><p>{TEXT}</p></div><div id=footer>{TEXT}</div>", f"Head\n{TEXT}"),
        (f"<article><p>{TEXT}</p></p></div></b><p>unclosed <i>text", f"{TEXT}\nunclosed text"),
        (f"<article><p>{TEXT} 1 < 2 & 3 &am", f"{TEXT} 1 < 2 & 3 &am"),
        (f"<article><p title='a > b' class=\"lead\">{TEXT}</p>", TEXT),
        (f"<article><p>{TEXT}</p><!-- never closed <p>gone</p>", TEXT),
        (f"<article><p>{TEXT}</p><script>never closed", TEXT),
        (f"<article><p>{TEXT} <svg><text>no</text></svg>x</p><template-box>y</template-box><p>z <svg></p><p>end</p></article>", f"{TEXT} x\ny\nz\nend"),
        (f"<article><ul><li>first<li>second</ul><p>{TEXT}</p></article>", f"first\nsecond\n{TEXT}"),
    ],
)
def test_pages(weights, html, want, trained):
    assert op.extract(html, weights if trained else op.train([])) == want


def test_long_and_odd_pages_end(weights):
    assert op.extract("<" * 100_000, weights) is not None
    assert op.extract("<p " + "'" * 50_000, weights) is not None
    assert op.extract("<b>" * 20_000 + "x" + "</i>" * 20_000, weights).endswith("x")
    many = "<article>" + "<p>a b c d</p>" * 20_000 + "</article>"
    assert op.extract(many, weights).count("\n") == 19_999


def test_linear_scan_finds_the_best_region(weights):
    """The region against all regions, on sequences of words and tags."""
    import random

    rng = random.Random(4)
    for _ in range(50):
        parts = [rng.choice(["<li>", "</li>", "<p>a b c</p>", "<a>x</a>", "<nav>n o</nav>", "w v"]) for _ in range(12)]
        items = op.Page("".join(parts)).items
        values = []
        for item in items:
            if isinstance(item, str):
                values.append(weights.tag(item))
            else:
                odds = op.BIAS + sum(weights.word(k) for k in dict.fromkeys(item[3]))
                import math

                values.append(item[2] * (-1.0 if item[4] else math.tanh(odds / 2)))
        best = max([sum(values[a:b]) for a in range(len(values)) for b in range(a, len(values) + 1)] or [0])
        text = op.extract("".join(parts), weights)
        assert bool(text) == (best > 0)


def test_all_rows(frame, weights):
    schema = "page_id long, url string, html string, text string, n_chars string"
    pages = frame([(1, None, None, "t", "n"), (1, "u", f"<p>{TEXT} é</p>", "t", "n"), (None, "v", "", "t", "n")], schema)
    rows = sorted((r.url or "", r.text, r.n_chars) for r in op.main_text(pages, weights).collect())
    assert rows == [("", "", 0), ("u", f"{TEXT} é", len(TEXT) + 2), ("v", "", 0)]
    assert op.main_text(frame([], schema), weights).count() == 0
    listed = frame([(i, "u", h, "", "") for i, h in enumerate(LABELLED * 4 + [None, "<p>x", "<article><article>"])], schema)
    assert len(op.labelled_pages(listed, 10)) == 10 and len(op.labelled_pages(listed)) == 20


def test_headings_and_ids_inside_the_article_are_kept():
    words = "plain words of an article that goes on for quite some time here"
    html = (
        f"<body><nav class='menu'><a>Home</a></nav><article><h2 id='search'>On search</h2><p>{words}</p>"
        f"<section id='comment-syntax'><h3 class='alert'>Comments</h3><p>{words}</p></section>"
        f"<div class='comments'><p>First!</p></div></article><div id='footer'>Imprint</div></body>"
    )
    assert op.extract(html, op.train([html] * 3)).split("\n") == ["On search", words, "Comments", words]
