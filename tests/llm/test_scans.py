"""Decontamination, licences, chat repair and wrappers."""

import itertools
import random

import pytest

from millrace.llm.chat import ASSISTANT, ROLES, START, SYSTEM, USER, Costs, repair_roles, steps, table
from millrace.llm.decontam import Budget, ItemIndex, best_distance, contaminated, drop_contaminated, pieces, plain
from millrace.llm.licences import TEMPLATES, Templates, dice, bigrams, find_licences, words_of
from millrace.llm.wrappers import aligned, expression, extract, host, main_text, pattern, reading
from tests.llm.edge_rows import edge_docs, no_docs, prose


def slow_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        above, row[0] = row[:], i
        for j, d in enumerate(text, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (c != d))
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(1, 90))) for _ in "ab")
        if rng.random() < 0.5:
            b = b[:10] + a.replace("a", "x", 2) + b[10:]
        assert best_distance(a, b)[0] == slow_distance(a, b)


def test_pieces_cover_the_item():
    for edits in (0, 1, 7):
        assert "".join(p for _, p in pieces("some benchmark item text", edits)) == "some benchmark item text"


def test_items_within_the_budget_are_found():
    rng, budget = random.Random(3), Budget(0.08)
    items = [(i, plain(prose(50 + i, 25))) for i in range(10)]
    index = ItemIndex(items, budget)
    for _ in range(150):
        n = rng.randrange(10)
        letters = list(items[n][1])
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(letters))
            letters[at : at + 1] = rng.choice([[], ["q"], [letters[at], "q"]])
        text = plain(prose(rng.randrange(10**6), 30)) + " " + "".join(letters) + " " + plain(prose(rng.randrange(10**6), 30))
        found = index.find(text)
        for k, (_, item) in enumerate(items):
            distance = slow_distance(item, text)
            assert (k in found) == (distance <= int(len(item) * budget.share))


def test_contaminated(spark):
    items = spark.createDataFrame([(1, prose(60, 20)), (2, prose(61, 20)), (3, None), (4, ""), (None, prose(60, 20))], "item_id long, text string")
    dirty = [(100, prose(5, 40) + "\n" + prose(60, 20).upper() + " " + prose(6, 40)), (101, prose(61, 20))]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(dirty, "doc_id long, text string"), allowMissingColumns=True)
    for block in (1 << 20, 60):
        found = {(r.doc_id, r.item_id) for r in contaminated(docs, items, block_bytes=block).collect()}
        assert found == {(100, 1), (100, None), (101, 2)}
        left = drop_contaminated(docs, items, block_bytes=block)
        assert left.columns == docs.columns and left.count() == docs.count() - 2
    none = items.limit(0)
    assert contaminated(docs, none).collect() == [] and drop_contaminated(docs, none).count() == docs.count()
    assert contaminated(no_docs(spark), items).collect() == []


def test_licences_equal_brute_force(spark):
    known = Templates(TEMPLATES, 0.8)
    lines = [t for forms in TEMPLATES.values() for t in forms] + [prose(70 + i, 30) for i in range(10)]
    for line in lines:
        best = {}
        for name, forms in TEMPLATES.items():
            best[name] = max(dice(bigrams(words_of(line)), bigrams(words_of(t))) for t in forms)
        top = max(best.values())
        got = known.scan(line)
        if top >= 0.8:
            assert {n for n, v in best.items() if v == top} <= set(got) and max(v[0] for v in got.values()) == top
        else:
            assert all(v[0] > top for v in got.values())
    text = prose(1, 40) + "\nLicensed under the  APACHE License, version 2.0\n" + prose(2, 40) + " released under the MIT license " + prose(3, 40)
    assert {n: v[1:] for n, v in known.scan(text).items() if n == "Apache-2.0"} and "MIT" in known.scan(text)
    split = TEMPLATES["MIT"][2].replace(", ", ",\n")
    assert "MIT" in known.scan(prose(4, 30) + "\n\n" + split + "\n\n" + prose(5, 30))
    docs = edge_docs(spark)
    assert find_licences(docs).collect() == [] and find_licences(no_docs(spark)).collect() == []


LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def least_cost(roles, state=START, costs=Costs()):
    if not roles:
        return 0
    return min(cost + least_cost(roles[1:], s, costs) for s, cost, _, _ in steps(state, roles[0], costs))


def test_tables_combine():
    rng, costs = random.Random(1), Costs()
    for _ in range(40):
        roles = [rng.choice([*ROLES, "tool", None]) for _ in range(rng.randint(1, 6))]
        cut = rng.randint(0, len(roles))
        a, b = table(roles[:cut], costs), table(roles[cut:], costs)
        assert table(roles, costs)[START].min() == least_cost(roles) == min(a[START][m] + b[m].min() for m in range(4))


@pytest.mark.parametrize("chunk_turns", [3, 512])
def test_repaired_conversations_are_legal_and_cheapest(spark, chunk_turns):
    rng = random.Random(6)
    rows = [(c, t, rng.choice([*ROLES, " User", "tool", None]), f"t{t}" if rng.random() < 0.9 else None) for c in range(20) for t in range(rng.randint(1, 20))]
    rows += [(None, 1, "user", "x"), (99, None, "assistant", "y"), (99, None, "assistant", "y")]
    turns = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, chunk int, position int, part int")
    got = sorted(repair_roles(turns, chunk_turns=chunk_turns).collect(), key=lambda r: (r.conv_id, r.position))
    assert len(got) == len(rows) - 1
    for _, group in itertools.groupby(got, key=lambda r: r.conv_id):
        group, roles, cost, state = list(group), [], 0, START
        for r in group:
            own = (r.role or "").strip().lower()
            roles.append(own)
            cost += 2 * len(r.empty_before)
            cost += 1 if r.merged or own not in ROLES else 3 * (own != r.new_role)
            for new in [] if r.merged else [*r.empty_before, r.new_role]:
                assert ROLES.index(new) + 1 in LEGAL[state]
                state = ROLES.index(new) + 1
        assert [r.position for r in group] == list(range(len(group)))
        assert cost == table(roles, Costs())[START].min()
        whole = "".join(r.rendered for r in group)
        assert whole.count("<|im_start|>") == whole.count("<|im_end|>") and whole.endswith("<|im_end|>\n")
    assert repair_roles(turns.limit(0)).collect() == []


PAGE = (
    '<html><head><title>T</title><body><header class=top>Site</header><div class="cookie-notice">We use</div><div id="sidebar">S<p>x</div>'
    "<main><article><h1>A &amp; B</h1><p>One<br>two<p>Three &eacute;<ul><li>a<li>b</ul><div class=\"ad\">buy</div><aside>rel</aside><form><input>f</form>"
    '<script>var a="<p>";</script><pre>x  y</pre></article><section class="comments"><p>Nice</section></main><footer>F</footer>'
)


def test_main_text_of_a_messy_page():
    assert main_text(PAGE, True, frozenset()) == "A & B\n\nOne two\n\nThree é\n\na\n\nb\n\nx y"


def test_wrapper_has_optional_and_repeated_groups():
    a = pattern("<article><h1>t</h1><p>x</p></article>")
    b = pattern("<article><h1>u</h1><p>x</p><p>y</p><div>z</div></article>")
    assert expression(aligned(a, b)) == "<article><h1>#text</><p>#text</></>".replace("<p>#text</>", "(<p>#text</>)+") .replace("</></>", "</></>")[:-3] + "(<div>#text</>)?</>"
    assert aligned(a, a) == a


def test_fixed_texts_of_plain_hosts(spark):
    page = "<body><div>Shop Home Help</div><div><p>{}</p><p>{}</p></div><div>All offers end soon</div>"
    rows = [(i, f"http://Shop.example:80/{i}", page.format(prose(i, 20), prose(90 + i, 20))) for i in range(6)]
    rows += [(10, None, PAGE), (11, "http://a.example/x", None), (12, "http://a.example/y", ""), (None, "http://a.example/y", "<p>a</p>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, wrapper int")
    got = {r.page_id: r for r in extract(pages).collect()}
    for i in range(6):
        assert got[i].text == "\n\n".join(" ".join(prose(s, 20).split()) for s in (i, 90 + i)) and got[i].n_chars == len(got[i].text)
    assert got[10].text.startswith("A & B") and got[11].text == got[12].text == "" and got[None].text == "a"
    assert extract(pages.limit(0)).collect() == []
    assert spark.range(1).select(host_of("https://u:p@WWW.X.org:8080/a")).first()[0] == "www.x.org"


def host_of(url):
    from pyspark.sql import functions as F

    return host(F.lit(url))


def test_reading_needs_three_pages():
    import json

    wrapper = json.dumps(pattern("<div>fixed</div>"))
    assert reading(wrapper, 2)[1] == frozenset() and len(reading(wrapper, 3)[1]) == 1
