"""Template text within main regions, and main regions within named containers."""

from millrace.llm.wrappers import extract
from tests.llm.edge_rows import prose


def texts_of(spark, htmls, site="http://a.example"):
    rows = [(i, f"{site}/{i}", h) for i, h in enumerate(htmls)]
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def flat(seed):
    return " ".join(prose(seed, 20).split())


def test_fixed_texts_within_main(spark):
    page = "<body><nav>N</nav><article><h1>{}</h1><div>Sign up for our letters</div><p>{}</p><p>{}</p></article><footer>F</footer>"
    got = texts_of(spark, [page.format(prose(i, 20), prose(50 + i, 20), prose(90 + i, 20)) for i in range(6)])
    assert got == {i: "\n\n".join(flat(s) for s in (i, 50 + i, 90 + i)) for i in range(6)}


def test_copies_of_a_page_have_no_fixed_texts(spark):
    assert texts_of(spark, [f"<body><article><p>{prose(1, 20)}</p></article>"] * 5) == dict.fromkeys(range(5), flat(1))


def test_main_region_in_a_named_container(spark):
    page = "<body><div class='{}'><p>x</p>{}</div>"
    htmls = [page.format("sidebar-widget", f"<main><p>{prose(i, 20)}</p></main>") for i in range(3)]
    htmls += [page.format("social", f"<article><p>{prose(i, 20)}</p></article>") for i in range(3, 6)]
    htmls.append(f"<body><article><p>{prose(6, 20)}</p></article><section class=comments><article><p>Nice</p></article></section>")
    assert texts_of(spark, htmls) == {i: flat(i) for i in range(7)}
