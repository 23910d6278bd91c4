from quarry.llm import html_extract as H

LONG = "The quick brown fox and the lazy dog went to the end of the field where they found that it was not as far from the river as they had been told by the others. "


def page(body, head="<title>T</title><script>var x='<p>no</p>';</script><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_article_without_boilerplate():
    html = page(f'<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies. {LONG}</div>'
                f'<div class="ad">{LONG}</div><!-- c <p>x</p> --><article><h1>Title &amp; more</h1><p><b>{LONG}<br><p>Short one.</p><ul><li>First<li>Second</ul>'
                f'<form>{LONG}<input></form><aside>{LONG}</aside><p>tail\n of\t&nbsp;it&hellip;</p><section id="comments"><p>{LONG}</p></section></article>'
                f'<div id="sidebar">{LONG}</div><footer>&copy; x {LONG}</footer>')
    assert H.extract(html) == "\n\n".join(["Title & more", LONG.strip(), "Short one.", "First", "Second", "tail of it…"])


def test_page_without_article():
    html = page(f"<div><a href='/'>Home</a> <a href='/b'>Blog</a></div><div><h1>Heading</h1></div><p>{LONG * 2}</p><p>Short in the midst.</p><p>{LONG * 2}</p>"
                f"<div><a href='x'>{LONG}</a></div><div>Terms</div>")
    assert H.extract(html) == "\n\n".join(["Heading", (LONG * 2).strip(), "Short in the midst.", (LONG * 2).strip()])


def test_short_page():
    assert H.extract("<p>Just this.</p>") == "Just this." and H.extract("plain text") == "plain text"


def test_nothing_to_read():
    for html in (None, "", "   ", "<html><head><title>x</title></head><body></body></html>", "<script>1", "<!-- open", "<nav>Menu</nav>", "<p", "</"):
        assert H.extract(html) == ("" if html != "</" else "</")


def test_cut_off_and_odd_markup():
    assert H.extract("<article><p>One &lt;b&gt; two &#233; &eacute; 3 < 4</p><p>cut <b cla") == "One <b> two é é 3 < 4\n\ncut"
    assert H.extract('<article data-x="a > b"><p title=\'>\'>In</p></article><footer>&am') == "In"
    assert H.extract("<ARTICLE><P>Upper</P></ARTICLE><FOOTER>no</FOOTER>") == "Upper"
    assert H.extract("<article><p hidden>no</p><p style='display: none'>no</p><p role=navigation>no</p><p>yes</p></article>") == "yes"
    assert H.extract("<article><p>a</b></i></div>b</p></article>") == "a\n\nb"
    assert H.extract("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_long_page_is_read_whole():
    html = "<article>" + "".join(f"<p>{LONG}{i}</p>" for i in range(5000)) + "</article>"
    assert H.extract(html).count("\n\n") == 4999


def test_hostile_quotes_take_no_time():
    import time

    t = time.time()
    H.extract('<a "' * 5000 + "<p>x" * 100 + "<" * 20000)
    assert time.time() - t < 5


def test_table(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>a 😀</p></article>", "clash"), (1, "u", "<article><p>a 😀</p></article>", "clash"), (2, None, None, ""), (None, "x", "", "")],
                                  "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in H.main_text(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "a 😀", 3), (1, "u", "a 😀", 3), (2, None, "", 0), (None, "x", "", 0)], key=repr)
    assert H.main_text(pages.where("false")).count() == 0


def test_inline_boilerplate_leaves_its_paragraph():
    for inner in ("<button>Buy {0}</button>", "<label>Name {0}</label>", "<textarea>{0}</textarea>", "<iframe>{0}</iframe>", "<video>{0}</video>",
                  "<span class='ad'>{0}</span>", "<span hidden>{0}</span>", "<span style='display:none'>{0}</span>"):
        html = page(f"<article><p>Before it. {inner.format('no')} {LONG}</p><p>{LONG}</p></article>")
        assert H.extract(html) == f"Before it. {LONG.strip()}\n\n{LONG.strip()}", inner


def test_unclosed_inline_name_loses_nothing():
    assert H.extract(page(f"<article><p>One <span class='ad'>two. {LONG}</p><p>{LONG}</p></article>")) == f"One two. {LONG.strip()}\n\n{LONG.strip()}"


def test_wrappers_do_not_empty_the_page():
    body = f"<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article><footer>{LONG}</footer>"
    want = "\n\n".join(["Head", LONG.strip(), LONG.strip()])
    for wrap in ("<div class='layout has-sidebar'>{}</div>", "<form action='/'>{}</form>", "<div class='sidebar'>{}</div>", "<div id='page' class='no-comments'>{}</div>"):
        assert H.extract(page(wrap.format(body))) == want, wrap
    text = f"<article><p>{LONG}</p><p class='notice-of-change'>{LONG}1</p><div class='social-history'>{LONG}2</div></article>"
    assert H.extract(page(text)) == "\n\n".join([LONG.strip(), f"{LONG}1", f"{LONG}2"])


def test_comments_stay_out_however_long():
    thread = "".join(f"<article class='comment'><p>{LONG}{i}</p></article>" for i in range(30))
    assert H.extract(page(f"<article><h1>Head</h1><p>{LONG}</p></article><div class='comments'>{thread}</div>")) == f"Head\n\n{LONG.strip()}"


def test_linked_paragraphs_in_the_article_and_menus():
    html = page(f"<article><p>{LONG}</p><p><a href='x'>{LONG}</a></p><p>{LONG}</p></article>")
    assert H.extract(html) == "\n\n".join([LONG.strip()] * 3)
    menu = "".join(f"<li><a href='{i}'>Item {i}</a></li>" for i in range(5))
    assert H.extract(page(f"<article><p>{LONG}</p><ul>{menu}</ul><p>{LONG}</p></article>")) == "\n\n".join([LONG.strip()] * 2)


def test_density_decides_where_the_article_is_a_card():
    html = page(f"<div><h1>Head</h1><p>{LONG * 2}</p><p>{LONG * 2}</p></div><article><p>A card of a related story, read more of it there.</p></article>")
    assert H.extract(html).startswith(f"Head\n\n{(LONG * 2).strip()}\n\n{(LONG * 2).strip()}")
    words = "buy cheap tickets online hotel flight deals casino bonus price shop sale offer " * 4
    assert words.strip() not in H.extract(page(f"<div><p>{LONG * 2}</p><div>{words}</div><p>{LONG * 2}</p></div>"))


def test_languages_without_listed_words():
    one = "Быстрая коричневая лиса перепрыгивает через ленивую собаку и бежит дальше по полю к реке. " * 3
    assert H.extract(page(f"<div><p>{one}</p><p>{one}</p></div>")) == "\n\n".join([one.strip()] * 2)
    assert H.extract(page(f"<div><p>{one}</p><p>{LONG * 2}</p><p>{one}</p></div>")) == "\n\n".join([one.strip(), (LONG * 2).strip(), one.strip()])
    dutch = "Zeventien kleine vogels vlogen gisteren richting zuiden omdat winter snel dichterbij kwam dan verwacht. " * 3
    assert H.extract(page(f"<div><p>{dutch}</p><p>{dutch}</p></div>")) == "\n\n".join([dutch.strip()] * 2)


def test_generated_pages_with_known_main_text():
    import random

    rnd = random.Random(12)
    words = [w for ws in H.STOP_WORDS.values() for w in ws][:60] + ["river", "house", "market", "garden", "letter", "window"]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."
    boiler = [lambda: f"<nav>{say(5)}</nav>", lambda: f"<div class='{rnd.choice(['ad', 'ad-box', 'cookie-notice', 'share-buttons', 'sidebar-left'])}'>{say(20)}</div>",
              lambda: f"<aside><p>{say(40)}</p></aside>", lambda: f"<form><label>{say(3)}</label></form>", lambda: f"<footer>{say(30)}</footer>",
              lambda: f"<section id='comments'><p>{say(50)}</p></section>", lambda: f"<script>{say(9)}</script>"]
    for _ in range(150):
        main = [say(rnd.choice([4, 60, 90])) for _ in range(rnd.randint(2, 6))] + [say(80)]
        inner = "".join(f"<p>{t}</p>" + (rnd.choice(boiler)() if rnd.random() < 0.3 else "") for t in main)
        around = lambda: "".join(rnd.choice(boiler)() for _ in range(rnd.randint(0, 3)))
        html = page(f"<header>{say(6)}</header>{around()}<{rnd.choice(['article', 'main'])} class='x'>{inner}</article></main>{around()}<footer>{say(9)}</footer>")
        assert H.extract(html) == "\n\n".join(main)
