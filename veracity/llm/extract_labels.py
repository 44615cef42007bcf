"""The small labelled table of HTML extraction: pages whose main text is marked ``data-main``.

Some pages are written out; the rest, in which no name tells what is what, follow one plan with lengths drawn anew.
"""

import random

S = "The committee met on Tuesday to discuss the plan for the harbour and agreed on most of it."
L = "Readers who followed the story from the start will remember how slowly the first talks went, " * 3

WRITTEN: tuple[str, ...] = (
    # article element, plain paragraphs of every length
    f"""<body><header><a href=/>Daily Post</a> News for the region.</header><nav><ul><li><a href=/a>Home</a>
    <li><a href=/b>Sport</a><li>Today</ul></nav><article data-main><h1>Harbour plan agreed</h1><p>{S}<p>{L}.<p>Yes.
    <p>{S}</article><aside><p>{S}</p><a href=/x>More</a></aside><footer>&copy; 2020 Daily Post. All rights reserved.
    <a href=/t>Terms</a></footer></body>""",
    # article with few words and long advert
    f"""<body><nav><a href=/a>Home</a> <a href=/b>About</a></nav><div class="ad">{S} {S}</div>
    <article data-main><h1>Short</h1><p>One.</p></article><footer>{S}</footer></body>""",
    # links and lists within the article
    f"""<body><nav><ul><li><a href=/a>World</a><li><a href=/b>Business pages</a></ul></nav><article><div data-main>
    <h2>Sources</h2><p><a href=/1>The whole report</a></p><ul><li><a href=/2>First part of the report</a><li>Second
    part<li>third</ul><p>{S} <a href=/3>A link</a> in it.</p><p>word</p><blockquote>{S}</blockquote></div>
    <div class="share"><p>Share this</p><p>{S}</p></div><section class="comments"><h3>Comments</h3><p>{S}</p><p>{L}.
    </p><p>Nice.</p></section></article></body>""",
    # main element, comments as articles, form
    f"""<body><div id="cookie-notice"><p>We use cookies. {S}</p><button>OK</button></div><main><div data-main>
    <h1>On bread</h1><p>{L}.</p><p>{S}</p><pre>a b</pre><table><tr><td>1</td><td>two</td></tr></table></div>
    <form><p>Your name</p><p>{S}</p></form><div id="comments"><article><p>{S}</p></article><article><h4>Anna</h4>
    <p>{L}.</p></article></div></main><aside class="sidebar"><h3>Latest</h3><ul><li><a href=/1>On cake</a><li>{S}
    </ul></aside></body>""",
    # no article element: long text is main, short or linked text is not
    f"""<body><div><a href=/1>Home</a> | <a href=/2>Archive</a> | <a href=/3>Contact</a></div><div data-main>
    <p>{L}.</p><p>{S}</p><p>{L}.</p></div><div><a href=/4>Older entry</a> <a href=/5>Newer entry</a></div>
    <div>Powered by hand</div></body>""",
    f"""<body><table><tr><td><a href=/1>One</a><td><a href=/2>Two</a></table><div data-main><h1>A day at the sea</h1>
    <p>{S}</p><p>{S} {S}</p><p>It rained. {S}</p></div><p><a href=/9>Back to the list of all entries</a></p></body>""",
    f"""<body><div>Menu</div><div><a href=/1>Log in</a></div><div data-main><p>{S}</p><p>{L}. {S}</p></div><div>
    <a href=/7>Next page of this site</a></div><div>Last change: May</div></body>""",
    # content div by class; boilerplate by class around it
    f"""<body><div class="topbar">{S}</div><div class="post"><div data-main><h1>Title here</h1><p>{S}</p><p>No</p>
    <p>{L}.</p></div><div class="related"><h4>Related</h4><p>{S}</p><p>{L}.</p></div></div>
    <div class="newsletter">{S} {S}</div><footer><p>{L}.</p><p>Imprint</p></footer></body>""",
    # page with an article: unmarked text beside it is not main
    f"""<body><div>{S}</div><p>{L}.</p><article data-main><p>{S}</p><p>Fine</p><p>{L}.</p><p><b>{S}</b></p></article>
    <div>{S} {S}</div><p>Breaking: {S}</p></body>""",
    f"""<body><p>Notice. {S}</p><article data-main><h1>{S}</h1><p><a href=/1>{S}</a></p><p>a</p></article><p>{L}.</p>
    <div>short</div></body>""",
    # page without any main text
    """<body><nav><a href=/a>Home</a></nav><div><a href=/1>One</a></div><div><a href=/2>Two and three</a></div>
    <footer>&copy; Someone</footer></body>""",
    f"""<body><header><h1>Site</h1><p>{S}</p></header><form><p>Search</p></form><footer>{L}.</footer></body>""",
    # text alone
    f"<body data-main>{L}. {L}.</body>",
    f"<body data-main>{L}{L}</body>",
    f"<body data-main><p>{S} {S}</p><p>{L}</p></body>",
)


VOCABULARY = ("the harbour was quiet that morning and nobody on the long pier had heard of any plan for a new road "
              "through old gardens until letters came from town").split()


def phrase(rng: random.Random, n: int, end: str = "") -> str:
    return " ".join(rng.choices(VOCABULARY, k=n)).capitalize() + end


def links(rng: random.Random, n: int, low: int, high: int, item: str) -> str:
    """``n`` linked items of ``low`` to ``high`` words."""
    return "".join(item.format(f"<a href=/{i}>{phrase(rng, rng.randint(low, high))}</a>") for i in range(n))


def stop(rng: random.Random) -> str:
    return rng.choice(("", ".", ".", ".", ":"))


def plain_page(rng: random.Random) -> str:
    """A page of unnamed elements: menus and teasers are links among links, the article is text among text;
    short sentences and headings between its paragraphs belong to it, short text among links does not."""
    item = rng.choice(("<li>{}</li>", "<div>{}</div>", "<p>{}</p>", "<td>{}</td>"))
    top = [links(rng, rng.randint(2, 8), 1, 3, item)]
    if rng.random() < 0.6:
        top.insert(0, f"<div>{phrase(rng, rng.randint(1, 4))}</div>")
    if rng.random() < 0.5:
        top.append("<div>" + links(rng, rng.randint(3, 25), 1, 2, "{} | ") + "</div>")
    body = [f"<h1>{phrase(rng, rng.randint(2, 14))}</h1>"]
    def text(low: int, high: int) -> str:
        return f"<p>{phrase(rng, rng.randint(low, high), stop(rng))}</p>"

    for _ in range(rng.randint(1, 12)):
        kind = rng.random()
        if kind < 0.5:
            body.append(text(25, 130))
        elif kind < 0.75:
            body.append(text(8, 25) + text(20, 60))
        elif kind < 0.85:
            body.append(f"<p>{phrase(rng, rng.randint(1, 5), '.')}</p>" + text(20, 90))
        elif kind < 0.92:
            body.append(f"<h2>{phrase(rng, rng.randint(1, 6))}</h2>" + text(20, 90))
        else:
            body.append(f"<p>{phrase(rng, rng.randint(12, 40))} <a href=/x>{phrase(rng, rng.randint(1, 6))}</a> "
                        f"{phrase(rng, rng.randint(5, 30), stop(rng))}</p>")
    if rng.random() < 0.7:
        body.append(text(20, 60))
    end = [f"<div>{phrase(rng, rng.randint(1, 3))}</div>", links(rng, rng.randint(3, 9), 3, 14, item)]
    if rng.random() < 0.5:
        end.append(f"<div><a href=/t>{phrase(rng, rng.randint(15, 40), '.')}</a></div>")
    end.append(links(rng, rng.randint(2, 6), 1, 3, item))
    end.append(f"<div>{phrase(rng, rng.randint(2, 8), stop(rng))}</div>")
    main = "".join(body[rng.random() < 0.3:] or body)
    around = rng.random()
    before = "" if around < 0.25 else "".join(top)
    after = "" if 0.15 < around < 0.4 else "".join(end)
    return f"<body><div>{before}</div><div data-main>{main}</div><div>{after}</div></body>"


def article_page(rng: random.Random) -> str:
    """A page with an article element: text of any length in it is main text, none beside it is."""
    def some(n: int) -> str:
        out = []
        for _ in range(n):
            t = phrase(rng, rng.choice((1, 2, 3, 5, 9, 16, 30, 60, 120)), stop(rng))
            out.append(rng.choice((f"<p>{t}</p>", f"<p>{t}</p>", f"<h2>{t}</h2>", f"<li>{t}</li>",
                                   f"<p><a href=/x>{t}</a></p>", f"<div><a href=/x>{t}</a> {t}</div>")))
        return "".join(out)

    return (f"<body><div>{some(rng.choice((0, 0, 1, 3)))}</div><article data-main>{some(rng.randint(1, 8))}</article>"
            f"<div>{some(rng.choice((0, 0, 1, 3)))}</div></body>")


#: Pages that follow the plans: without a name or article element, and with an article element.
PLAIN, WITH_ARTICLE = 150, 50
_rng = random.Random(1)
LABELLED_PAGES: tuple[str, ...] = (
    WRITTEN + tuple(plain_page(_rng) for _ in range(PLAIN)) + tuple(article_page(_rng) for _ in range(WITH_ARTICLE)))
