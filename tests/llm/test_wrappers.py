"""Page extraction on the given pages and on hand-made ones; tree matching by brute force."""

import html
import itertools
import random
import re
import time

from pyspark.sql import functions as F

from fareflow.llm import wrappers
from fareflow.llm.wrappers import Place, align, parse


def plain(page):
    """The article of the given pages, cut out by its tags."""
    inner = re.search(r"<article>(.*)</article>", page or "", re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)\s*>", inner)
    out = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(b for b in out if b)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/pages.parquet")
    want = {r.page_id: (r.url, plain(r.html)) for r in pages.collect()}
    got = wrappers.extract(pages).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.url, r.text) == want[r.page_id] and r.n_chars == len(r.text)


def test_given_pages_whose_tags_say_nothing(spark, sf_dir):
    """The article and the advert are plain ``div`` elements: only the induced region tells them apart."""
    pages = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    unmarked = F.regexp_replace(F.regexp_replace("html", "<(/?)article>", "<$1div>"), ' class="[^"]*"', "")
    got = wrappers.extract(pages.withColumn("html", unmarked)).collect()
    assert {r.page_id: r.text for r in got} == want


def random_tree(rng, n):
    places = [Place("", -1)]
    for i in range(1, n):
        parent = rng.randrange(i)
        places[parent].children[i] = i
        places.append(Place(rng.choice("abc"), parent))
    return places


def most_matches(one, two, a, b):
    """The largest order-keeping matching of two subtrees whose roots match, all ways tried."""
    left, right = list(one[a].children.values()), list(two[b].children.values())
    best = 0
    for k in range(min(len(left), len(right)) + 1):
        for xs in itertools.combinations(left, k):
            for ys in itertools.combinations(right, k):
                if all(one[x].label == two[y].label for x, y in zip(xs, ys)):
                    best = max(best, sum(most_matches(one, two, x, y) for x, y in zip(xs, ys)))
    return best + 1


def test_tree_matching():
    rng = random.Random(1)
    for _ in range(150):
        one, two = random_tree(rng, rng.randint(1, 8)), random_tree(rng, rng.randint(1, 8))
        found = align(one, two)
        assert len(found) == most_matches(one, two, 0, 0) == len(set(found.values()))
        for a, b in found.items():
            assert one[a].label == two[b].label
            assert a == 0 or found[one[a].parent] == two[b].parent


def page(body, title="T"):
    return f"""<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var x="</p><p>no";</script></head>
    <body class="has-sidebar">{body}</body></html>"""


def test_layouts(spark):
    def div_layout(i):
        return page(f"""<div id=top class=navbar>Menu {i}</div><div class="c0l{i}"><div class=post><h2>Head {i}</h2>
        <p>Read &amp; learn &#x1F642; {i}</p><p class=tip>Always the same words</p><ul><li>one {i}<li>two<b>x</b> {i}</ul>
        <div class="comments-area"><p>Reader says {i}</p></div><blockquote>quote {i} is long enough</blockquote></div>
        <div class=sidebar>side {i}</div></div><form>Name {i}<input></form><p>Made by us</p>""")

    rows = [(i, f"http://div.com/{i}", div_layout(i)) for i in range(8)]
    copy = page("<nav>n</nav><article><h1>Same</h1><p>copy text</p></article>")
    rows += [(20 + i, f"http://copies.org/{i}", copy) for i in range(9)]
    rows += [(40, "http://one.net/", page("<main><p>a<br>b\xa0 c<!-- no --> d</p><section class=cookie-notice>k</section></main>"))]
    rows += [(41, "http://bare.net/", "just  text\n here"), (42, "http://cut.net/", "<div><p>open <i>ended</i> & 1 < 2 <p>next"), (43, None, None),
             (44, "no host", ""), (45, "http://q.net/", "<p title='a>b'>quoted</p><p \">half</p>"), (46, "http://d.net/", "<![CDATA[x]]><p>y</p>"),
             (47, "http://deep.net/", "<div>" * 1500 + "deep" + "</div>" * 1500), (None, "http://div.com/x", div_layout(3)),
             (48, "http://long.net/", "<article>" + "<p>w é</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in wrappers.extract(pages.repartition(3)).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i].text == f"Head {i}\nRead & learn 🙂 {i}\none {i}\ntwox {i}\nquote {i} is long enough", i
    assert {got[20 + i].text for i in range(9)} == {"Same\ncopy text"}
    assert got[40].text == "a b c d" and got[41].text == "just text here"
    assert got[42].text == "open ended & 1 < 2\nnext"
    assert got[43].text == got[44].text == "" and got[43].n_chars == 0
    assert got[45].text.startswith("quoted") and got[47].text == "deep"
    assert got[48].n_chars == 20_000 * 4 - 1
    assert wrappers.extract(pages.limit(0)).collect() == []


def test_shape_survives_its_text_form():
    parsed = parse(page("<div class='a b12' id=x><p>1</p><p>2</p></div><div class=c>3</div>"))
    again = wrappers.read_shape(parsed.shape())
    assert [(p.label, p.parent) for p in again] == [(p.label, p.parent) for p in parsed.places]
    assert "div a b0 x" in {p.label for p in again}


def extracted(spark, pages):
    rows = [(i, f"http://one.host/{i}", html) for i, html in enumerate(pages)]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_a_copied_article_keeps_what_only_it_has(spark):
    others = [page(f"<article><h1>Head {i}</h1><p>text {i}</p></article>") for i in range(8)]
    copy = page("<article><h1>Copied</h1><p>its text</p><ul><li>its list</ul><blockquote>its quote</blockquote></article>")
    got = extracted(spark, others + [copy] * 9)
    assert got[:8] == [f"Head {i}\ntext {i}" for i in range(8)]
    assert set(got[8:]) == {"Copied\nits text\nits list\nits quote"}


def test_names_do_not_drop_what_holds_the_article(spark):
    for box in ("div class='layout has-sidebar'", "div id=content-with-sidebar", "section class='post no-comments'"):
        tag = box.split()[0]
        pages = [page(f"<{box}><div class=post><h2>Head {i}</h2><p>text {i} goes on</p></div>"
                      f"<div class=sidebar>side {i}</div></{tag}><p>Made by us</p>") for i in range(8)]
        assert extracted(spark, pages) == [f"Head {i}\ntext {i} goes on" for i in range(8)], box


def test_repeated_parts_of_an_article_stay(spark):
    dishes = [page(f"<nav>n</nav><article><h1>Dish {i}</h1><h2>Ingredients</h2><p>take {i} of it</p><ul><li>salt</ul></article>"
                   "<p>Made by us</p>") for i in range(8)]
    assert extracted(spark, dishes) == [f"Dish {i}\nIngredients\ntake {i} of it\nsalt" for i in range(8)]


def test_near_copies_of_an_article_keep_their_list_and_quotation(spark):
    others = [page(f"<article><h1>Head {i}</h1><p>text {i}</p></article>") for i in range(8)]
    near = [page(f"<article><h1>Copy {i}</h1><p>its text</p><ul><li>its list</ul><blockquote>its quote</blockquote></article>")
            for i in range(9)]
    assert extracted(spark, others + near)[8:] == [f"Copy {i}\nits text\nits list\nits quote" for i in range(9)]


def test_siblings_of_unlike_content_are_places_of_their_own():
    labels = [(p.label, p.parent) for p in parse("<div>a</div><div><p>b</p></div><div>c</div><div><h1>d</h1><p>e</p></div>").places]
    assert labels == [("", -1), ("div", 0), ("div", 0), ("p", 2), ("h1", 2)]


def test_quoted_values_of_any_length():
    value = "b a>b <p>c" * 100_000
    assert parse(f"<p class=x title=\"{value}\" id='y>'>kept</p>").blocks == [(1, "kept")]
    assert [text for _, text in parse("<p title='a>b'>one</p><p \">two</p><p title=\"open>three</p> end").blocks] == [
        "one", "two", "three", "end"]


def test_broken_markup_and_many_names_take_seconds():
    began = time.monotonic()
    for junk in ("<!", "<a x=\"<a x='", "<a b='", "<", "</zz>", "<figure>", "<p><td>", "<div", "<!--", "<script", "= <b = "):
        parse(junk * (1_000_000 // len(junk)))
    assert time.monotonic() - began < 60

    def listing(names):
        return parse("".join(f"<div id={n}><h2>x</h2><p>y</p></div>" for n in names)).places

    letters = ["".join(n) for n in itertools.islice(itertools.product("abcdefghij", repeat=4), 5000)]
    one, two = listing("p" + n for n in letters), listing("q" + n for n in letters)
    began = time.monotonic()
    assert align(one, two) == {i: i for i in range(15_001)}
    assert time.monotonic() - began < 20
