"""Page differencing: alignment against a textbook table, whole extraction against brute force, mark-up, edges."""

import html
from html.parser import HTMLParser

import numpy as np

from formfields.llm import html_extraction as H

SCHEMA = "page_id long, url string, html string, text string, lines int, host string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "other", 1, "clash") for i, u, h in rows], SCHEMA)


def texts(spark, rows, **options):
    return {r.page_id: r.text for r in H.extract_main_text(table(spark, rows), **options).collect()}


def lcs(a, b):
    """The textbook table."""
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
    return int(t[-1, -1])


def test_shared_lines_are_a_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(0, 14)), rng.integers(0, 6, rng.integers(0, 14))
        keep = H.shared_lines(a, b)
        assert keep.sum() == lcs(a, b) == lcs(a[keep], b)


def test_alignment_of_very_long_pages_has_linear_memory():
    a = np.arange(6000) % 7
    assert H.shared_lines(a, np.roll(a, 3)).sum() >= 5990


def test_blocks_as_the_standard_parser_finds_them():
    class Texts(HTMLParser):
        def __init__(self):
            super().__init__()
            self.now, self.found, self.hidden = "", [], 0

        def flush(self):
            if self.now.split():
                self.found.append(" ".join(self.now.split()))
            self.now = ""

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style", "title", "head")
            if tag in H.BLOCKS:
                self.flush()

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style", "title", "head")
            if tag in H.BLOCKS:
                self.flush()

        def handle_data(self, data):
            self.now += "" if self.hidden else data

    page = "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='</p>'; if (a<b) {}</script></head><body><!-- <p>no</p> -->" \
        "<p title='a>b'>One <b>two</b> &lt;three&gt; &eacute;<br>four<p>five<ul><li>six<li>seven</ul><td>eight</td> a < b &amp;amp; <a href=x>nine</a></body>"
    for cut in range(0, len(page) + 1, 7):
        whole = page if cut == 0 else page[page.index("<p title") :]
        parser = Texts()
        parser.feed(whole)
        parser.close()
        parser.flush()
        assert [t for t, _ in H.page_blocks(whole)] == parser.found


def test_mark_up_sets_blocks_apart(spark):
    page = "<header>Site</header><nav><a>Home</a></nav><div class='cookie-notice'>Agree</div><article><div class='article-header'><h1>A &amp; B</h1></div><p class='share-price'>One <b>two</b>\n three</p>" \
        "<div class='share-buttons'>Share</div><form>Search</form><aside>More</aside></article><div id='comments'>First!</div><footer>f</footer>"
    assert texts(spark, [(1, "http://a.b/x", page)]) == {1: "A & B One two three"}


def test_shared_lines_decide_where_mark_up_says_nothing(spark):
    """Without differencing each text would have the lines of the site."""
    page = "<div>Site name</div><div>Own words {0} of this page</div><p>Line two of {0}</p><div>All rights kept</div>"
    rows = [(k, f"http://c/d/{k}", page.format(f"w{k}")) for k in range(4)]
    assert texts(spark, rows) == {k: f"Own words w{k} of this page Line two of w{k}" for k in range(4)}
    # The shared part may be most of the page.
    heavy = "<div>{}</div>".format("</div><div>".join(f"menu entry {k} of very many" for k in range(30))) + "<p>tiny {}</p>"
    assert texts(spark, [(k, f"http://c/d/{k}", heavy.format(k)) for k in range(3)]) == {k: f"tiny {k}" for k in range(3)}


def test_shared_lines_decide_inside_articles_too(spark):
    """A lead-in that every article of the host has is template; a sentence that two of them quote is not."""
    body = "<article><p>Read this first</p><p>Story {0} has words of its own, w{0}</p>{1}</article>"
    rows = [(k, f"http://c/d/{k}", body.format(k, "<p>A quoted sentence</p>" if k in (3, 4) else "")) for k in range(8)]
    found = texts(spark, rows)
    assert found[0] == "Story 0 has words of its own, w0"
    assert found[3] == "Story 3 has words of its own, w3 A quoted sentence"


def test_copies_keep_their_article(spark):
    """Exact and near copies beside each other are no partners; the other pages of the host are."""
    body = "<div>Site name</div><div>{}</div><div>{}</div>"
    copies = [(k, f"http://c/copy/{k}", body.format("A long line that the copies of one text all share", f"and its end {k // 2}")) for k in range(6)]
    others = [(10 + k, f"http://c/other/{k}", body.format(f"Something else, told at length as number {k}", "")) for k in range(7)]
    found = texts(spark, copies + others)
    assert found[0] == found[1] == "A long line that the copies of one text all share and its end 0"
    assert found[10] == "Something else, told at length as number 0"
    # Two pages alone on their host that are the same stay whole.
    assert texts(spark, [(k, f"http://d/{k}", "<p>Same</p><p>text</p>") for k in range(2)]) == {0: "Same text", 1: "Same text"}


def test_nulls_empties_and_repeated_rows(spark):
    rows = [(1, "http://a/x", None), (2, None, "<p>t</p>"), (None, None, ""), (3, "no address", "<div>t</div>"), (4, "http://a/y", "<p>u</p>"), (4, "http://a/y", "<p>u</p>")]
    found = [(r.page_id, r.text, r.n_chars) for r in H.extract_main_text(table(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted([(1, "", 0), (2, "t", 1), (None, "", 0), (3, "t", 1), (4, "u", 1), (4, "u", 1)], key=str)
    assert H.extract_main_text(table(spark, [])).count() == 0


def test_a_very_long_page(spark):
    long = "<article>" + "".join(f"<p>word{k} &amp; more</p>" for k in range(30000)) + "</article>"
    found = H.extract_main_text(table(spark, [(1, "http://a/x", long), (2, "http://a/y", long)])).collect()
    assert [r.text for r in found] == [" ".join(f"word{k} & more" for k in range(30000))] * 2


def brute_force(pages):
    """Pages are (page_id, host, path, [(kind, text)]). Every page is compared in turn, with lists and the textbook table."""
    order = sorted(pages, key=lambda p: (p[1], p[2], p[0]))
    out = {}

    def main(p):
        kinds = {k for k, _ in p[3]}
        return H.INSIDE if H.INSIDE in kinds else H.PLAIN

    def telling(p):
        at = order.index(p)
        around = [q for k, q in enumerate(order) if abs(k - at) <= H.REACH and q[1] == p[1]]
        rare = lambda t: 2 * sum(t in {u for _, u in q[3]} for q in around) <= len(around)
        mine = [(-len(t), k, t) for k, (kind, t) in enumerate(p[3]) if kind == main(p) and rare(t)]
        return {t for _, _, t in sorted(mine)[:3]}

    def copies(p, q):
        return bool(telling(p) & {t for _, t in q[3]}) or bool(telling(q) & {t for _, t in p[3]})

    def common(p, q):
        a, b = [t for _, t in p[3]], [t for _, t in q[3]]
        keep = H.shared_lines(np.array([hash(t) for t in a]), np.array([hash(t) for t in b]))
        assert keep.sum() == lcs(a, b)
        return {k for k in range(len(a)) if keep[k]}

    for at, p in enumerate(order):
        near = [(-H.nearness(p[2], q[2]), abs(k - at), k > at, k) for k, q in enumerate(order) if k != at and q[1] == p[1] and abs(k - at) <= H.REACH]
        chosen, sets = [], []
        own = {k for k, (kind, _) in enumerate(p[3]) if kind == main(p)}
        for *_, k in sorted(near):
            q = order[k]
            if not copies(p, q) and not any(copies(c, q) for c in chosen):
                chosen.append(q)
                if not own <= common(p, q) and len(sets) < H.PARTNERS:
                    sets.append(common(p, q))
        gone = {k for k in sets[0] if p[3][k][0] != H.INSIDE} if sets else set()
        if len(sets) >= H.LEAST_PARTNERS:
            gone |= {k for k in set.intersection(*sets) if p[3][k][0] == H.INSIDE}
        out[p[0]] = " ".join(t for k, (kind, t) in enumerate(p[3]) if kind == main(p) and k not in gone)
    return out


def test_whole_extraction_by_brute_force(spark):
    rng = np.random.default_rng(5)
    pages = []
    for k in range(90):
        host = f"h{rng.integers(0, 3)}"
        template = [(H.PLAIN, f"site {host}"), (H.APART, f"menu {rng.integers(0, 3)}")]
        inside = rng.random() < 0.5
        body = [(H.INSIDE if inside else H.PLAIN, f"text {t}" + " x" * int(t % 11)) for t in rng.integers(0, 400, rng.integers(1, 6))]
        lead = [(H.INSIDE if inside else H.PLAIN, "read first")] if rng.random() < 0.8 else []
        seen = set()
        lines = [x for x in template + lead + body + [(H.PLAIN, "the end")] if not (x in seen or seen.add(x))]
        pages.append((k, host, f"/p/{rng.integers(0, 30)}", lines))

    def rendered(p):
        parts = []
        for kind, text in p[3]:
            tag = {H.PLAIN: "div", H.APART: "nav", H.INSIDE: "article"}[kind]
            parts.append(f"<{tag}>{html.escape(text)}</{tag}>")
        return "".join(parts)

    # Equal lines of one page that differ only by kind would need a table of kinds; the pages have none.
    rows = [(p[0], f"https://{p[1]}{p[2]}?q=1", rendered(p)) for p in pages]
    wanted = brute_force(pages)
    assert any(len(w) < sum(len(t) for _, t in p[3]) for w, p in zip(wanted.values(), pages, strict=True))
    for block_rows in (7, 4096):
        assert texts(spark, rows, block_rows=block_rows) == wanted


def test_broken_pages_are_read_in_time():
    import time

    from formfields.llm.html_extraction import page_blocks

    began = time.time()
    assert len(page_blocks("<a " * 1_600_000)) == 1 and page_blocks("<a " * 1000 + "x>y") == [("y", 0)]
    assert page_blocks("<div>" * 300_000 + "</x>" * 300_000) == []
    assert page_blocks("<p><div>" + "<b>" * 300_000 + "<p></p>" * 300_000) == []
    assert page_blocks("a<!-- " * 500_000) == [("a", 0)]
    assert page_blocks("1 &#" + "9" * 10_000 + "; 2 &#" + "0" * 10_000 + "65; &#x41;") == [("1 \ufffd 2 A A", 0)]
    assert page_blocks("x < y <3 </ z") == [("x < y <3 </ z", 0)]
    assert time.time() - began < 60


def far_pages():
    """Two pages beyond many copies of one, and the same on a host with fewer copies."""
    body = "<div>Site name</div><div>{}</div><div>{}</div>"
    copies = lambda host, n: [(f"http://{host}/m/{k:04}", body.format("A long line that the copies of one text all share", "and its end")) for k in range(n)]
    others = lambda host: [(f"http://{host}/{p}", body.format(f"Something else, told at length as number {p}", "")) for p in ("a", "z")]
    return [(k, u, h) for k, (u, h) in enumerate(copies("far", 150) + others("far") + copies("near", 20) + others("near"))]


def test_partners_beyond_many_copies(spark):
    """A page among more copies than REACH to each side is compared with what lies farther off; before, it had no partner."""
    found = texts(spark, far_pages())
    assert found == texts(spark, far_pages(), block_rows=9)
    assert {found[k] for k in (*range(150), *range(152, 172))} == {"A long line that the copies of one text all share and its end"}
    assert found[150] == "Something else, told at length as number a"


def test_whole_hosts_are_looked_through(spark):
    """Stepping over runs of copies and looking at more pages step by step gives what a walk over all pages of the host gives."""
    rng = np.random.default_rng(8)
    pages, sizes = [], {}
    for k in range(60):
        kind = H.INSIDE if rng.random() < 0.5 else H.PLAIN
        lines = [(H.PLAIN, "site"), (kind, "read first")] + [(kind, f"text {t}" + " x" * int(t % 7)) for t in sorted(set(rng.integers(0, 25, rng.integers(1, 4)).tolist()))]
        pages.append(H.Page(k, "h", f"/p/{rng.integers(0, 20):02}", *packed(lines)))
        sizes[pages[-1].held] = packed(lines)[2]
    pages.sort(key=lambda p: p.path)
    for at, page in enumerate(pages):
        page.place = at
    H.find_telling_lines(pages)
    whole = [H.deleted_lines(p, iter(pages[:at][::-1]), iter(pages[at + 1 :])) for at, p in enumerate(pages)]
    rows = spark.createDataFrame([(p.place, -p.place, p.place, p.host, p.path, p.lines.tobytes(), p.kinds.tobytes(), sizes[p.held], p.telling, list(p.held)) for p in pages], "k1 long, k2 long, place long, host string, path string, lines binary, kinds binary, sizes binary, telling array<long>, held array<long>")
    got = {r.k1: r.gone for r in H.farther(rows, rows.select("k1", "k2")).collect()}
    assert [got.get(k, []) for k in range(60)] == whole and any(whole)


def packed(lines):
    return np.array([H.line_hash(t) for _, t in lines], np.int64).tobytes(), bytes(k for k, _ in lines), np.array([len(t) for _, t in lines], np.uint32).tobytes()


def test_free_places_step_over_runs():
    assert H.free_places(10, 0, -1, [(8, 9), (7, 9), (3, 4)], 4) == ([6, 5, 2, 1], True)
    assert H.free_places(10, 0, -1, [(8, 9), (0, 6)], 4) == ([7], False)
    assert H.free_places(3, 9, 1, [(4, 4), (4, 6), (9, 9)], 2) == ([7, 8], False)
    assert H.free_places(3, 3, 1, [], 2) == ([], False)
