import time

from starquay.llm.html_text import extract_text, main_text

BODY = "This is a paragraph of the article, with commas, and enough words to count as text, as articles have."


def page(body, head="<title>Some title</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_article_without_what_surrounds_it():
    body = f"""
      <header><a href=/>Home</a><p>{BODY} header</p></header><nav><ul><li><a href=x>Menu</a></li></ul></nav>
      <div class="cookie-notice"><p>We use cookies, and so on, to make this long enough, really.</p></div>
      <div class=sidebar><p>{BODY} side</p></div><div class="ad">Buy this, buy that.</div>
      <article><h1>Heading</h1><p>First  &amp;\n second, <b>bold</b> <a href=y>link</a>.</p><!-- hidden --><p>{BODY}</p>
      <script>var t = "</p><p>not text</p>";</script><style>p {{ }}</style><form><p>Your mail, please, now.</p></form>
      <ul><li>one</li><li>two</li></ul></article>
      <div id="comments"><p>{BODY} comment</p><p>{BODY} comment</p><p>{BODY} comment</p></div>
      <footer>&copy; nobody</footer>"""
    assert main_text(page(body)) == f"Heading\nFirst & second, bold link.\n{BODY}\none\ntwo"


def test_containers_without_article_tags():
    body = f"""<div class=menu><a href=1>one</a> <a href=2>two</a></div>
      <div><div class=content><p>{BODY}</p><p>{BODY}</p><p>Short one.</p></div><div class=related><p>{BODY}</p></div></div>
      <div><a href=3>{BODY}</a></div>"""
    assert main_text(page(body)) == f"{BODY}\n{BODY}\nShort one."


def test_names_of_parts():
    rest = f"<p>{BODY}</p>"
    article = f'<article><header class="entry-header"><h1>Title</h1></header>{rest}<div class="postComments">{rest}</div></article>'
    for around in ('<div id=page class="has-sidebar">%s</div>', "<main>%s<section>" + rest + "</section></main>", "%s<p>" + BODY + "</p>"):
        assert main_text(page(around % article)) == f"Title\n{BODY}"
    assert main_text(page(f'<div class="widget">{rest}</div>')) == BODY  # else there is no text at all
    comments = f'<article class="comment">{rest}{rest}{rest}</article>'
    assert main_text(page(f"{article}{comments}")) == f"Title\n{BODY}"


def test_broken_markup():
    assert main_text(f"<p><b>{BODY}<br><p>{BODY}</div></p></article>") == f"{BODY}\n{BODY}"
    assert main_text(page(f"<article><p>a < b, and {BODY}<p>c > d, {BODY}")) == f"a < b, and {BODY}\nc > d, {BODY}"
    assert main_text(page(f"<article><p>{BODY}</p><script>never closed")) == BODY
    assert main_text("<div>" * 3000 + BODY) == BODY


def test_quotes_in_tags():
    body = f"<article><p title=don't>It's {BODY}</p><p data-x='a > b' title=\"c > d\">{BODY}</p><p title=\"open>{BODY}</p></article>"
    assert main_text(page(body)) == f"It's {BODY}\n{BODY}\n{BODY}"
    assert main_text("<a " + 'b="c" ' * 5000) == ""


def test_only_attributes_hide():
    body = f'<article><p>{BODY} <a href="/hidden style=display:none">link</a></p><p hidden>no</p><p style="display: none">no</p></article>'
    assert main_text(page(body)) == f"{BODY} link"


def test_references_and_white_space():
    assert main_text(page(f"<article><p>&eacute;&#233;&#x4e2d;&nbsp;&lt;p&gt; {BODY}</p></article>")) == f"éé中 <p> {BODY}"
    assert main_text("plain text only") == "plain text only"


def test_operator(spark):
    rows = [(1, "u", page(f"<article><p>{BODY}</p></article>")), (2, None, None), (None, "u", ""), (3, "u", "   "), (3, "u", "<p></p>"),
            (4, "u", page("<article>" + f"<p>{BODY}</p>" * 5000 + "</article>"))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = extract_text(pages).collect()
    assert sorted(((str(r.page_id), r.url, r.n_chars) for r in got if r.page_id != 4), key=str) == sorted(
        [("1", "u", len(BODY)), ("2", None, 0), ("None", "u", 0), ("3", "u", 0), ("3", "u", 0)], key=str
    )
    assert {r.text for r in got if r.page_id == 1} == {BODY}
    assert all(r.n_chars == len(r.text) for r in got)
    assert [r.text.count("\n") for r in got if r.page_id == 4] == [4999]
    assert extract_text(pages.where("false")).count() == 0


def test_parts_behind_many_open_elements_are_dropped():
    for tag in ("div", "span", "font"):
        start = f"<{tag}>" * 5000
        hidden = f"<nav>{BODY}</nav><footer>{BODY}</footer><div style='display:none'>{BODY}</div><form>{BODY}</form>"
        assert main_text(f"{start}<p>{BODY}</p>{hidden}") == BODY
    # End tags behind that point close what was opened behind it.
    inner = f"<section><p>{BODY}</p></section>"
    assert main_text(page("<article>" + "<div>" * 500 + inner * 3 + "</div>" * 500 + f"<p>{BODY}</p></article>")).count(BODY) == 4


def test_depth_costs_no_more_than_length():
    began = time.process_time()
    main_text("".join(f"<div>{BODY}</x><span>" for _ in range(20_000)))
    main_text("<font>" * 20_000 + f"<p>{BODY}</q></b>" * 20_000)
    assert time.process_time() - began < 30


def test_a_page_inside_a_form():
    login = "<p>Your name and your word, please, to go on here.</p><input><input><button>Go</button>"
    body = f'<form id=aspnetForm><input type=hidden><div class=menu><a href=1>x</a></div><div><h1>Title</h1><p>{BODY}</p><p>{BODY}</p></div></form>'
    assert main_text(page(body)) == f"Title\n{BODY}\n{BODY}"
    assert main_text(page(f"<form><main><p>Short text.</p>{login}</main></form>")).startswith("Short text.")
    assert main_text(page(f"<div><p>{BODY}</p><p>{BODY}</p><form>{login}</form></div>")) == f"{BODY}\n{BODY}"
    assert main_text(page(f"<form>{login}</form>")) == ""


def test_named_parts_and_lists_of_links_inside_the_container():
    links = "<ul><li><a href=1>First source</a></li><li><a href=2>Second source</a></li></ul>"
    body = f'<div><div class=content><p>{BODY}</p>{links}<p class=tag>{BODY} tagged</p><p>{BODY}</p></div></div>'
    expected = f"{BODY}\nFirst source\nSecond source\n{BODY} tagged\n{BODY}"
    assert main_text(page(body)) == expected
    article = f'<article><p>{BODY}</p><div class=legal><p>{BODY} law</p></div><section class="side">{BODY} by</section></article>'
    assert main_text(page(article)) == f"{BODY}\n{BODY} law\n{BODY} by"
    # Outside the container such names still count against a part.
    assert main_text(page(f"<div><div><p>{BODY}</p><p>{BODY}</p></div><div class=legal><p>{BODY}</p></div></div>")) == f"{BODY}\n{BODY}"


def test_headings_and_short_paragraphs_beside_the_container():
    text = f"<div><p>{BODY}</p><p>{BODY}</p></div>"
    body = f'<div id=x><a href=1>Home</a><h2>Part one</h2>{text}<h2>Part two</h2><p>Short.</p><ul><li>one</li></ul><p>{BODY} last</p><p>The end.</p><p>Imprint</p></div>'
    assert main_text(page(body)) == "\n".join(["Part one", BODY, BODY, "Part two", "Short.", "one", f"{BODY} last", "The end."])
