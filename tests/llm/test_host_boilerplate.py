import html
import random
import re

from fleetgrain.llm import host_boilerplate as hb


def extracted(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, part int")
    return {r["page_id"]: r for r in hb.extract(df).collect()}


def test_articles_of_all_pages(llm, pages):
    rows = hb.extract(pages).collect()
    source = {r["page_id"]: r for r in pages.collect()}
    assert len(rows) == len(source)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", source[r["page_id"]]["html"], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:br|p|h1)>", inside)]
        assert r["text"] == "\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"]) and r["url"] == source[r["page_id"]]["url"]


def place_of(page):
    return [("article open boilerplate".split()[p], t) for p, t in hb.blocks(page)]


def test_blocks_and_their_places():
    page = """<!DOCTYPE html><title>no</title><style>p{}</style><script>if(a<b)"</p>"</script><div class="ad">buy
    <article><header><h1>T &amp; x</h1></header><p>a<br>b&nbsp; c<i>d</i>e<!-- <p>no --><p class=lead>f
    <div id='user-comments'><article>no</article>c</div><aside>s</aside><form>q<button>go</button></form><p>g</article><footer>h"""
    assert place_of(page) == [
        ("boilerplate", "buy"), ("article", "T & x"), ("article", "a b cde"), ("article", "f"), ("boilerplate", "no"),
        ("boilerplate", "c"), ("boilerplate", "s"), ("boilerplate", "qgo"), ("article", "g"), ("boilerplate", "h"),
    ]
    loose = '<body>lead <p>one</p><div id=sidebar>x<div>y</div>z</div>tail <div hidden>w</div><a href="x>y">l</a><div role=navigation>m</div>'
    assert [t for p, t in place_of(loose) if p == "open"] == ["lead", "one", "tail", "l"]


def test_broken_markup_is_read_as_far_as_it_goes():
    for page in ("<", "<p", "a<b", "<p>a</", "<!--", "<script>", "<p a='", "</p></div></article>", "<article>", "&#xffffff; &bad; &amp", "<![CDATA[x]]>"):
        hb.blocks(page)
    assert place_of("<p>a</section></b>b") == [("open", "ab")] or place_of("<p>a</section></b>b") == [("open", "a"), ("open", "b")]
    assert len(hb.blocks("<div>" * 50_000 + "x")) == 1
    assert hb.blocks("<a href='" * 3000) is not None


def plain_covered(streams, run, pages):
    where = {}
    for k, s in enumerate(streams):
        for i in range(len(s) - run + 1):
            where.setdefault(tuple(s[i : i + run]), set()).add(k)
    out = []
    for s in streams:
        hit = set()
        for i in range(len(s) - run + 1):
            if len(where[tuple(s[i : i + run])]) >= pages:
                hit |= set(range(i, i + run))
        out.append([i in hit for i in range(len(s))])
    return out


def test_repeated_substrings_against_all_windows():
    rng = random.Random(4)
    for run in (1, 2, 5, 8):
        streams = [[rng.choice("ab") for _ in range(rng.randint(0, 30))] for _ in range(12)]
        menu = list("qwertzuiop")
        streams += [[*s[:5], *menu, *s[5:]] for s in streams[:4]]
        got = hb.covered_words(streams, run, 3)
        assert [g.tolist() for g in got] == plain_covered(streams, run, 3)


def test_repeated_open_text_of_a_host_goes(llm):
    menu = "<div>" + " ".join(f"menu{i}" for i in range(12)) + "</div>"
    note = "<p>" + " ".join(f"note{i}" for i in range(9)) + "</p>"
    rows = [(i, f"http://h.com/{i}", f"{menu}<p>own text {i} of page</p>{note}") for i in range(600)]
    rows += [(1000 + i, "http://other.com/", f"{menu}<p>x {i}</p>") for i in range(2)]
    same = "<p>" + " ".join(f"s{i}" for i in range(30)) + "</p>"
    rows += [(2000 + i, "http://copies.com/", same) for i in range(9)]
    got = extracted(llm, rows)
    assert all(got[i]["text"] == f"own text {i} of page" for i in range(600))
    assert got[1000]["text"].startswith("menu0") and got[1000]["text"].endswith("\nx 0")  # two pages are no evidence
    assert got[2000]["text"].startswith("s0 s1")  # copies of a page count once


def test_rare_text_of_a_large_host_goes_from_all_its_pages(llm):
    """A notice on 12 of 2,000 pages, and evidence that pages with an article give to one without."""
    note = "<p>" + " ".join(f"note{i}" for i in range(9)) + "</p>"
    rows = [(i, f"http://h.com/{i}", f"<p>own{i} text{i}</p>" + (note if i % 167 == 0 else "")) for i in range(2000)]
    rows += [(3000 + i, f"http://mixed.com/{i}", f"<article>a{i}</article><p>t{i}</p>{note}") for i in range(2)]
    rows += [(3002, "http://mixed.com/2", f"<p>alone</p>{note}"), (3003, "http://mixed.com/3", "<p>x</p>")]
    got = extracted(llm, rows)
    assert [got[i]["text"] for i in range(2000)] == [f"own{i} text{i}" for i in range(2000)]
    assert got[3000]["text"] == "a0" and got[3002]["text"] == "alone" and got[3003]["text"] == "x"


def test_repeated_runs_inside_a_block_go_and_its_other_words_stay(llm):
    menu, foot = (" ".join(f"{n}{i}" for i in range(30)) for n in ("menu", "foot"))
    rows = [(i, f"http://h.com/{i}", f"{menu} my{i} own{i} words{i}<p>{foot} printed{i}</p>") for i in range(5)]
    rows += [(9, "http://h.com/9", f"first9 {menu} last9<p>foot0 foot1 then9</p>")]
    got = extracted(llm, rows)
    assert [got[i]["text"] for i in range(5)] == [f"my{i} own{i} words{i}\nprinted{i}" for i in range(5)]
    assert got[9]["text"] == "first9 last9\nfoot0 foot1 then9"


def plain_texts(rows):
    """What stays of pages with an article, by all windows of a host."""
    parsed = [(i, url.split("/")[2], hb.blocks(page)) for i, url, page in rows]
    outside, articles = {}, {}
    for _, host, found in parsed:
        inside = tuple(t for p, t in found if p == hb.ARTICLE)
        stream = " ".join(t for p, t in found if p != hb.ARTICLE).split(" ")
        for k in range(len(stream) - hb.RUN + 1):
            outside.setdefault((host, *stream[k : k + hb.RUN]), set()).add(tuple(stream))
        for t in inside:
            articles.setdefault((host, t), set()).add(inside)
    out = {}
    for i, host, found in parsed:
        inside = [t for p, t in found if p == hb.ARTICLE]
        kept = []
        for t in inside:
            w = t.split(" ")
            runs = [(host, *w[k : k + hb.RUN]) for k in range(len(w) - hb.RUN + 1)]
            repeated = runs and all(len(outside.get(r, ())) >= hb.PAGES for r in runs)
            if not (repeated and len(articles[host, t]) >= hb.PAGES):
                kept.append(t)
        out[i] = "\n".join(kept or inside)
    return out


def article_rows():
    note = " ".join(f"note{i}" for i in range(9))
    head = " ".join(f"head{i}" for i in range(10))
    body = " ".join(f"body{i}" for i in range(12))
    rows = [(i, f"http://h.com/{i}", f"<article><p>own{i} text</p><p>{note}</p><p>{body}</p></article><footer>foot{i} {note}</footer>") for i in range(4)]
    # a headline that others list, a notice with a word more, a notice alone, copies of one article, another host
    rows += [(10 + i, f"http://h.com/l{i}", f"<article><p>listing{i}</p></article><aside>{head} more{i}</aside>") for i in range(4)]
    rows += [(20, "http://h.com/head", f"<article><h1>{head}</h1><p>{note} then</p></article>")]
    rows += [(21, "http://h.com/alone", f"<article><p>{note}</p></article>")]
    rows += [(30 + i, f"http://copies.com/{i}", f"<article><p>{body}</p></article><footer>{body} x{i}</footer>") for i in range(5)]
    rows += [(40 + i, f"http://two.com/{i}", f"<article><p>a{i}</p><p>{note}</p></article><footer>{note} {i}</footer>") for i in range(2)]
    return rows


def test_a_notice_that_repeats_outside_goes_from_articles(llm):
    """Markup settled every page with an article before, so no run was counted or looked up for it."""
    rows = article_rows()
    got = {i: r["text"] for i, r in extracted(llm, rows).items()}
    body = " ".join(f"body{i}" for i in range(12))
    assert [got[i] for i in range(4)] == [f"own{i} text\n{body}" for i in range(4)]
    assert got[20].startswith("head0") and got[20].endswith("note8 then") and got[21].startswith("note0")
    assert all(got[30 + i] == body for i in range(5)) and "note0" in got[40]
    assert got == plain_texts(rows)


def test_articles_against_all_windows(llm, monkeypatch):
    rng = random.Random(9)
    parts = [" ".join(rng.choice("abc") + str(k) for _ in range(rng.randint(7, 14))) for k in range(6)]

    def page(i):
        inside = "".join(f"<p>{rng.choice(parts)}</p>" for _ in range(rng.randint(1, 3)))
        return f"<nav>{rng.choice(parts)} m{rng.randint(0, 20)}</nav><article><p>own {i % 30}</p>{inside}</article><footer>{rng.choice(parts)}</footer>"

    rows = [(i, f"http://{rng.choice('xyz')}.com/{i}", page(i)) for i in range(150)]
    want = plain_texts(rows)
    assert any(want[i].count("\n") < len(hb.blocks(p)) - 3 for i, _, p in rows)
    assert {i: r["text"] for i, r in extracted(llm, rows).items()} == want
    # a full bitmap takes every run for a repeated one, and changes nothing
    monkeypatch.setattr(hb, "_bits", lambda runs: hb.np.full(hb.N_BITS // 8, 255, hb.np.uint8))
    assert {i: r["text"] for i, r in extracted(llm, rows).items()} == want


def test_defined_cases(llm):
    rows = [(1, None, None), (2, "", ""), (3, "u", "<nav>m</nav>"), (4, None, "<article>" + "<p>long text</p>" * 30_000 + "</article>"), (5, "http://a.b/", "plain")]
    got = extracted(llm, [*rows, (None, None, "x")])
    assert [got[i]["text"] for i in (1, 2, 3)] == ["", "", ""] and got[1]["n_chars"] == 0
    assert got[4]["text"].count("\n") == 29_999 and got[5]["text"] == "plain" and got[None]["text"] == "x"
    df = llm.createDataFrame([(1, "u", "x"), (1, "u", "x")], "page_id long, url string, html string")
    assert hb.extract(df).count() == 2 and hb.extract(df.limit(0)).count() == 0


def test_time_follows_the_page():
    """A walk over all open elements for each tag took 14 s on the first of these."""
    import time

    n = 16_000
    for page in ("<div>" * n + "</ul>" * n, "<div>" * n + "<nav>" + "<article>x</article>" * n, "<li><p>" * n + "</li>" * n):
        began = time.perf_counter()
        hb.blocks(page)
        assert time.perf_counter() - began < 5
