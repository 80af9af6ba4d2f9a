import html

import pytest

from threadlake.llm.html_wrappers import (
    Wrapper,
    align,
    block_hash,
    blocks_in_slots,
    extract_text,
    fold,
    infer,
    main_text,
    tokens_of,
)

SHELL = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head>"
    "<body><header>Site</header><nav><ul>%s</ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div>"
    "<article><h1>%s</h1>%s</article><aside>See also</aside><form><p>Mail <input value='>'></p></form>"
    "<section id=comments><p>First!</p></section><footer>&copy; 2026</footer></body></html>"
)
CASES = [
    ("<p>One</p><p>Two &amp; three&lt;</p>", ["One", "Two & three<"]),
    ("<p>Un<b>closed<br><p>next  \n\t line", ["Unclosed", "next line"]),
    ("<ul><li>a<li>b</ul><p class=ad>buy<p>c", ["a", "b", "c"]),
    ("<p>x <span class='share'>Share <span>it</span> now</span></p><p>y</p>", ["x", "y"]),
    ("<blockquote><p>q</p></blockquote><table><tr><td>1<td>2</table>", ["q", "1", "2"]),
    ("<p>caf&eacute; &#8364; &nbsp;x &amp", ["café € x &"]),
    ("", []),
]


def page(head, body, links=3):
    return SHELL % ("".join(f"<li><a href=/{i}>m{i}</a></li>" for i in range(links)), head, body)


def text_of(head, blocks):
    return "\n\n".join([head, *blocks])


@pytest.mark.parametrize("body, blocks", CASES)
def test_one_page_by_itself_and_by_its_wrapper(body, blocks):
    source = page("Head", body)
    assert main_text(source, None) == text_of("Head", blocks)
    wrapper = Wrapper(infer([fold(tokens_of(p)[0]) for p in (source, page("Other", CASES[0][0], 1))]))
    assert wrapper.slots(tokens_of(source)[0]) is not None
    assert main_text(source, wrapper) == text_of("Head", blocks)


def test_wrapper_folds_repeats_and_makes_the_rest_optional():
    assert fold("a b b b c b c d".split()) == ["a", ["+", ["b"]], "c", "b", "c", "d"]
    assert fold("x y x y z".split()) == [["+", ["x", "y"]], "z"]
    one, two = fold("a li li z".split()), fold("a li q z".split())
    wrapper = align(one, two)
    assert wrapper == ["a", ["+", ["li"]], ["?", ["q"]], "z"]
    for tags in ("a li z", "a li li q z", "a li li li z"):
        assert Wrapper(wrapper).slots(tags.split()) is not None
    assert Wrapper(wrapper).slots("a z".split()) is None


def test_pages_without_a_region_keep_all_but_the_rest():
    assert main_text("just text <b>x</b> &lt;", None) == "just text x <"
    assert main_text("<div class=menu>m</div><div>body</div><footer>f", None) == "body"
    assert main_text("<main><p>in</p></main><div>out</div>", None) == "in"
    assert main_text("<div class=content><p>in</p></div><div>out</div>", None) == "in"
    assert main_text("<article>a<article class=comment>no</article>b</article>", None) == "a\n\nb"
    assert main_text("<<<>< p>a", None).endswith("p>a")
    # Names that only begin like an element of raw text are elements of their own.
    assert main_text("<article><svg-icon></svg-icon><p>a</p><iframe-box><p>b</p></iframe-box></article>", None) == "a\n\nb"
    assert main_text("<p>a</p><script>x</script><style\n>y</style><svg/><p>b</p><script", None) == "a\n\nb"
    assert main_text(None, None) == main_text("", None) == main_text("<!-- open", None) == ""


def read_as_host(*pages):
    """The texts of a host's pages, all of which its wrapper fits."""
    wrapper = Wrapper(infer([fold(tokens_of(p)[0]) for p in pages]))
    assert all(wrapper.slots(tokens_of(p)[0]) is not None for p in pages)
    return [main_text(p, wrapper) for p in pages]


def test_an_advert_and_content_in_the_same_place_of_a_host():
    shell = "<article><div class=%s>%s</div><p>T</p>%s</article>"
    # The page with the advert has the shorter stream, so its tag comes first in the wrapper.
    pages = shell % ("ad", "Buy", ""), shell % ("lead", "L", "<ul><li>x</ul>")
    assert read_as_host(*pages) == ["T", "L\n\nT\n\nx"]
    assert read_as_host(shell % ("ad", "Buy", ""), shell % ("lead", "L", "")) == ["T", "L\n\nT"]


def test_a_host_with_and_without_regions():
    pages = "<article><p>A</p></article><div>out</div>", "<div><p>B</p></div>", "<div class=content><p>C</p></div><div>out</div>"
    assert read_as_host(*pages) == ["A", "B", "C"]


@pytest.mark.parametrize(
    "source, text",
    [
        ("<body class='page has-sidebar'><p>T</p></body>", "T"),
        ("<body class='menu'><p>T</p></body>", "T"),
        ("<article class='post category-social comments-open'><p>T</p></article>", "T"),
        ("<article class='social'><p>T</p></article>", "T"),
        ("<main class='content no-banner'><p>T</p></main>", "T"),
        ("<div class='article-header'><h1>H</h1></div><p>T</p>", "H\n\nT"),
        ("<div class='post sponsored'><p>T</p></div><p>U</p>", "T\n\nU"),
        ("<div class='big ad-banner'>Buy</div><p>T</p>", "T"),
    ],
)
def test_names_are_hints_as_a_whole(source, text):
    assert main_text(source, None) == text


def test_rows(spark):
    rows, want = [], []
    for i in range(40):
        body, blocks = CASES[i % len(CASES)]
        url = f"http://h{i % 3}.example/x" if i % 5 else None
        rows.append((i, url, page(f"H {i}", body, i % 4 + 1), "n"))
        want.append((i, url, text_of(f"H {i}", blocks)))
    long = "<p>" + "word " * 40_000 + html.escape("<end>") + "</p>"
    rows += [(40, "http://h0.example/", None, "n"), (None, "http://h0.example/", page("L", long), "n"), rows[0]]
    want += [(40, "http://h0.example/", ""), (None, "http://h0.example/", text_of("L", ["word " * 40_000 + "<end>"])), want[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = extract_text(df).collect()
    assert sorted(((r.page_id, r.url, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_text(df.limit(0)).count() == 0


MENU = "<div><ul><li>Home</li><li>About us</li></ul></div>"
NOTE = "<p>Read our rules before you write</p>"


def unmarked(i, extra=""):
    return f"<body>{MENU}<div><h2>Head {i}</h2><p>Text number {i} of this host, longer than its menu and its rules</p>{extra}</div></body>"


def test_texts_that_all_pages_of_a_host_share_are_its_template(spark):
    def wanted(i, *more):
        return "\n\n".join([f"Head {i}", f"Text number {i} of this host, longer than its menu and its rules", *more])

    rows, want = [], {}
    for i in range(12):
        # A list item of one page that reads as the menu of its host does, in another slot.
        extra, more = ("<ol><li>Home</ol>", ["Home"]) if i == 7 else ("", [])
        rows.append((i, "http://menu.example/", unmarked(i, NOTE + extra)))
        want[i] = wanted(i, *more)
    # Copies of one page, near ones and two pages only are no ground for a template.
    for i in range(20, 24):
        rows.append((i, "http://copies.example/", unmarked(20)))
        want[i] = "\n\n".join(["Home", "About us", wanted(20)])
    body = "<p>A long text that all of these pages share, as they are copies of it</p><p>And one more</p>"
    for i in range(30, 36):
        rows.append((i, "http://near.example/", f"<article>{body}<p>edit {i}</p></article>"))
        want[i] = f"A long text that all of these pages share, as they are copies of it\n\nAnd one more\n\nedit {i}"
    for i in range(40, 42):
        rows.append((i, "http://two.example/", unmarked(i)))
        want[i] = "\n\n".join(["Home", "About us", wanted(i)])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in extract_text(df).collect()} == want


def test_fixed_texts_count_in_their_slot_only():
    source = unmarked(1, NOTE)
    items = infer([fold(tokens_of(source)[0])])
    slots = dict((block, slot) for slot, block in blocks_in_slots(source, Wrapper(items)))
    fixed = [(slots[b], block_hash(b)) for b in ("Home", "About us")]
    assert main_text(source, Wrapper(items, fixed)).startswith("Head 1\n\n")
    assert main_text(source, Wrapper(items, [(s + 1, h) for s, h in fixed])).startswith("Home\n\n")
