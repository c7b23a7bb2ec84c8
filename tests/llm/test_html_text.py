import pytest

from cohortlens.llm.html_text import main_text, main_texts

LONG = "Words of a long paragraph that clearly is the article, with some more words to be dense. "


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("<p>", ""), ("plain", "plain"), ("<p>a &amp; b&nbsp;c &lt;x&gt; &copy; &#233;</p>", "a & b c <x> © é"),
    ("<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>One <b>two</b>\n three<br>four<p>five</article><footer>f</footer>",
     "T\nOne two three four\nfive"),
    ("<body><header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x</p><form>mail <input></form>"
     "<div class='share-buttons'>s</div><section id='comments'><p>" + LONG * 9 + "</p></section></article></body>", "T\nx"),
    ("<body><div class='cookie-notice'>We use cookies " + LONG + "</div><div id=content><p>" + LONG + "</p><p>" + LONG + "</p></div>"
     "<aside>" + LONG * 5 + "</aside></body>", LONG.strip() + "\n" + LONG.strip()),
    ("<article><p>a<script>var x='<p>no</p>'</script><style>p{}</style>b</p><!-- c --><ul><li>l1<li>l2</ul></article>", "ab\nl1\nl2"),
    ("<article><p>cut off in the midd", "cut off in the midd"),
    ("<body class='has-sidebar'><div class='page with-sidebar'><article><div class='entry-header'><h1>T</h1></div><p>x</p></article>"
     "<div id=sidebar>s</div></div><div class='page-header'>top</div></body>", "T\nx"),
    ("<article><p>x</p></article><div id=comments><article><p>" + LONG + "</p></article></div>", "x"),
    ("<div><p>" + LONG + "</p><p>" + LONG * 3 + "</p></div><div><a href=a>" + "link " * 30 + "</a> <a href=b>more links here</a></div>",
     LONG.strip() + "\n" + (LONG * 3).strip()),
])
def test_main_text(html, want):
    assert main_text(html) == want


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    assert main_text(f"<body><article>{deep}</article></body>") == "deep text"
    many = "".join(f"<p>{LONG}{i}</p>" for i in range(3000))
    assert main_text(f"<body><nav>m</nav><article>{many}</article></body>").count("\n") == 2999


def test_rows(spark):
    rows = [(1, "u", "<article><p>été</p></article>", "t"), (1, "u", "<article><p>été</p></article>", "t"), (2, None, None, "t"),
            (None, "v", "x", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in main_texts(df).collect())
    assert got == [(0, "v", "x", 1), (1, "u", "été", 3), (1, "u", "été", 3), (2, None, "", 0)]
    assert main_texts(df.limit(0)).collect() == []


@pytest.mark.parametrize("html, want", [
    ("<body><div>" + "".join(f"<article><p>{LONG}{i}</p><p>{LONG * i}</p></article>" for i in (1, 2, 3)) + "</div></body>",
     "\n".join(f"{LONG}{i}\n{(LONG * i).strip()}" for i in (1, 2, 3))),
    ("<body><article><p>" + LONG + "</p><div><article class=card><p>" + LONG * 4 + "</p><p>" + LONG * 5 + "</p></article></div><p>"
     + LONG + "end</p></article></body>",
     "\n".join((LONG.strip(), (LONG * 4).strip(), (LONG * 5).strip(), LONG + "end"))),
    ("<body><article><a href=x>t</a></article><div><p>" + LONG * 2 + "</p><p>" + LONG * 3 + "</p></div></body>",
     (LONG * 2).strip() + "\n" + (LONG * 3).strip()),
])
def test_density_chooses_where_there_are_articles(html, want):
    assert main_text(html) == want


BODY = f"<h1>T</h1><p>{LONG}</p><p>{LONG * 2}</p>"
WANT = "\n".join(("T", LONG.strip(), (LONG * 2).strip()))


@pytest.mark.parametrize("html", [
    f"<body><nav>menu</nav><div class='layout with-sidebar'>{BODY}<div class=sidebar>s</div></div></body>",
    f"<body><div class='page no-header'>{BODY}</div></body>",
    f"<body><div class='related-work'>{BODY}</div><div class=related>other pages</div></body>",
    f"<body><form id='aspnetForm'><input name=q><button>Go</button><article>{BODY}</article></form></body>",
    f"<body><form id='aspnetForm'><select><option>1</select>{BODY}</form><form>mail <input></form></body>",
    f"<html><head><title>t</title><meta charset=x><div>{BODY}</div>",
    f"<body><div class='subscribe-page hidden' hidden>{BODY}</div><footer>f</footer></body>",
])
def test_marks_weigh_and_do_not_delete(html):
    assert main_text(html) == WANT


def test_an_advert_longer_than_a_short_article_goes():
    assert main_text(f"<body><div class=ad>{LONG * 3}</div><article><h1>T</h1><p>Short.</p></article></body>") == "T\nShort."


@pytest.mark.parametrize("html", [
    "<div>" * 50_000 + "<p>deep text</p>", "<b>" * 20_000 + "deep text", "<table><tr><td><p>" * 10_000 + "deep text",
    "<ul><li>" * 20_000 + "deep text", "<p>x<div>" * 20_000 + "<p>deep text", "</div>" * 50_000 + "deep text",
    "<div><p>side words</p>" * 10_000 + "deep text"])
def test_deep_pages_take_linear_time(html):
    import time

    start = time.time()
    assert main_text(html).endswith("deep text")
    assert time.time() - start < 5  # a second here; minutes if it grew with the square


def _brute(tree):
    """Composite text density by recursion over (tag, children) pages without
    marks: counts, densities, density sums, core, threshold, siblings."""
    import math

    inline = {"a", "b"}

    def counts(x):
        if isinstance(x, str):
            return len(" ".join(x.split())), 0, 0, 0
        c = t = lc = lt = 0
        for y in x[1]:
            a, b, d, e = counts(y)
            c, t, lc, lt = c + a, t + b + (not isinstance(y, str)), lc + d, lt + e
        return (c, t, c, t + 1) if x[0] == "a" else (c, t, lc, lt)

    body = counts(tree)

    def density(x):
        c, t, lc, lt = counts(x)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * max(lc, 1) + body[2] / max(body[0], 1) * c + math.e)
        return c / max(t, 1) * max(0.0, math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log(base))

    def blocks_below(x):
        return [z for y in x[1] if not isinstance(y, str) for z in ([y] if y[0] not in inline else blocks_below(y))]

    def total(x):
        own = sum(density(y) for y in blocks_below(x))
        if x[0] in ("article", "main"):
            own += max((total(y) for y in below(x)), default=0.0)
        return own

    def below(x):
        for y in x[1]:
            if not isinstance(y, str):
                yield y
                yield from below(y)

    level, every = [tree], []  # in order of depth, as ties go to the first
    while level:
        every += level
        level = [y for x in level for y in x[1] if not isinstance(y, str)]
    core = max((x for x in every if x[0] not in inline), key=total)
    if not counts(core)[0]:
        core = tree

    def path(x):
        if x is core:
            return [x]
        for y in x[1]:
            if not isinstance(y, str) and (found := path(y)):
                return [x, *found]
        return []

    way = path(tree)
    least = min(density(x) for x in way)

    def chosen(i):
        if way[i] is core:
            return [core]
        out = []
        for y in way[i][1]:
            if y is way[i + 1]:
                out += chosen(i + 1)
            elif not isinstance(y, str) and y[0] not in inline and counts(y)[0] and density(y) >= least:
                out.append(y)
        return out if way[i + 1][0] not in inline else chosen(i + 1)

    texts = []

    def write(x):
        if isinstance(x, str):
            texts[-1] += x
            return
        if x[0] not in inline:
            texts.append("")
        for y in x[1]:
            write(y)
        if x[0] not in inline:
            texts.append("")

    for part in chosen(0):
        write(part)
    return "\n".join(t for t in (" ".join(x.split()) for x in texts) if t)


def test_equals_brute_force_density_on_random_pages():
    import random

    r = random.Random(12)

    def made(depth):
        tag = r.choice(["div", "div", "section", "article", "p", "p", "a", "b"] if depth else ["p", "a"])
        if tag in ("p", "a", "b") or not depth:
            kids = [" ".join(r.choice(["word", "longer-word", "x"]) for _ in range(r.randrange(0, 25)))]
            if tag == "p" and r.random() < 0.4:
                kids.append(("a", [" link text"]))
            return tag, kids
        return tag, [made(depth - 1) for _ in range(r.randrange(1, 5))]

    def html(x):
        return x if isinstance(x, str) else f"<{x[0]}>{''.join(map(html, x[1]))}</{x[0]}>"

    for _ in range(300):
        tree = ("body", [made(4) for _ in range(r.randrange(1, 4))])
        assert main_text(html(tree)) == _brute(tree)
