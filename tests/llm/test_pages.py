import hashlib
import html
import random
import re
from collections import defaultdict

import duckdb
import pytest

from ordertide.llm import template, warc
from tests.llm.brute import with_clashing_columns

SF = "/root/testdata/sf0.01/pages.parquet"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(SF)


def frame(spark, rows):
    return with_clashing_columns(spark.createDataFrame(rows, "page_id long, url string, html string"))


# ---------------------------------------------------------------- HTML ----


def test_main_text_of_the_given_pages(pages):
    found = {r.page_id: r for r in template.extracted(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert (found[p.page_id].text, found[p.page_id].n_chars, found[p.page_id].url) == (expected, len(expected), p.url)


def test_other_templates(spark):
    def page(i, body):
        return f"""<html><head><title>t</title><style>x</style></head><body class="has-sidebar"><header>Site</header><div class="top-menu"><a href=1>Home</a></div>
          <div id="wrap-{i}"><main class="post-{i}"><h1>Title {i}</h1><p>{body}<p>More &lt;text&gt; f<b>oo</b>bar<br>end{i}<aside>see also</aside><form>name <input></form>
          <div class="share-buttons">share me</div><section id="comments"><p>{'great post ' * 30}</p></section></main></div>
          <div class="cookie-notice">we use cookies</div><script>var a = "<p>no</p>";</script><footer>&copy; 2024</footer></body></html>"""

    rows = [(i, f"https://Host.example/{i}", page(i, " ".join(f"w{i}x{j}" for j in range(40)))) for i in range(6)]
    for r in template.extracted(frame(spark, rows)).collect():
        i = r.page_id
        assert r.text == f"Title {i} " + " ".join(f"w{i}x{j}" for j in range(40)) + f" More <text> foobar end{i}"


def test_unlike_pages(spark):
    rows = [(1, None, None), (2, "http://a/b", ""), (3, "u", "<p>hello</p"), (3, "u", "<p>hello</p"), (4, "http://x.y/", "<div id=c><p>Body &amp; soul<p>x<b>y</b>z</div><script>a<b</script><!-- c"), (5, "http://deep/", "<div>" * 3000 + "far in" + "</div>" * 3000)]
    found = sorted((r.page_id, r.text) for r in template.extracted(frame(spark, rows)).collect())
    assert found == [(1, ""), (2, ""), (3, "hello"), (3, "hello"), (4, "Body & soul xyz"), (5, "far in")]


def test_classes_nest(spark, pages):
    rows = {r.host: r for r in template.templates(pages).collect()}
    host = rows["blog.tionsh.example.net"]
    assert host.main == "page/html/body/article"
    for c in host.classes:
        assert c.parent < len(host.classes) and c.pages * 2 >= host.pages
    assert len({t for c in host.classes for t in c.tokens}) == sum(len(c.tokens) for c in host.classes)


def words_of(i, name, n):
    return " ".join(f"{name}{i}x{j}" for j in range(n))


def test_slots_come_from_classes(spark):
    """A token that repeats on its own is data of the slot around it, not a slot."""
    rows = []
    for i in range(6):
        paras = "".join(f'<div class="para">{words_of(i, f"p{k}y", 40)}</div>' for k in range(2 + i))
        rows.append((i, f"http://host/{i}", f'<html><body><div class="m"><a href=1>One</a> <a href=2>Two</a></div><div class="story">{words_of(i, "lead", 3)}{paras}</div></body></html>'))
    host = template.templates(frame(spark, rows)).first()
    assert host.main == "page/html/body/div.story"
    assert "page/html/body/div.story/div.para" not in {t for c in host.classes for t in c.tokens}
    for r in template.extracted(frame(spark, rows)).collect():
        assert r.text == " ".join([words_of(r.page_id, "lead", 3), *(words_of(r.page_id, f"p{k}y", 40) for k in range(2 + r.page_id))])


def test_vectors_decide():
    import pandas as pd

    def told(mark):
        paths = ["page", "page/div.story", "page/div.story/div.para", "page/div.story/div.by"]
        rows = pd.DataFrame({"path": paths, "mark": [1, 1, 7, mark], "pages": 10, "times": [10, 10, 40, 40], "host_pages": 10})
        rows["low"], rows["high"] = 0, 1
        for c in (*template.WEIGHTS, *template.OWN):
            rows[c] = [0, 5, 400, 4]
        return template._template(("h",), rows).iloc[0]["main"]

    assert told(8) == "page/div.story"
    assert told(7) == "page/div.story/div.para"


def test_texts_of_the_template_are_told_by_vectors(spark):
    """Names and tags of note and story are alike: only what pages share tells them apart, and four pages are too few for it."""
    rows = []
    for i in range(9):
        note = f'<div class="kc">{words_of(0, "note", 40)}</div>'
        story = f'<div class="kb"><p>{words_of(i, "w", 30)}</p><div class="kd"><p>{words_of(0, "told", 12)}</p></div><p>{words_of(i, "v", 30)}</p></div>'
        rows.append((i, f"http://host/{i}", f'<html><body><div class="ka">{words_of(0, "top", 9)}</div>{note}{story}</body></html>'))
    for n, told in ((9, True), (template.FEWEST - 1, False)):
        found = {r.page_id: r.text for r in template.extracted(frame(spark, rows[:n])).collect()}
        for i in range(n):
            body = [words_of(i, "w", 30), *([] if told else [words_of(0, "told", 12)]), words_of(i, "v", 30)]
            assert found[i].endswith(" ".join(body)) and (found[i] == " ".join(body)) == told


def test_a_host_of_one_article_keeps_it(spark):
    page = f'<html><body><div class="a">{words_of(0, "w", 80)}</div><div class="b">%s</div></body></html>'
    rows = [(i, f"http://host/{i}", page % f"n{i}") for i in range(9)]
    assert {r.text for r in template.extracted(frame(spark, rows)).collect()} == {f'{words_of(0, "w", 80)} n{i}' for i in range(9)}


def test_a_text_that_one_page_differs_in_is_data(spark):
    page = f'<html><body><div class="a">{words_of(0, "w", 9)}%s</div><div class="b">%s</div></body></html>'
    rows = [(i, f"http://host/{i}", page % (" odd" if i == 5 else "", words_of(i, "v", 50))) for i in range(9)]
    assert all(r.text.startswith(words_of(0, "w", 9)) for r in template.extracted(frame(spark, rows)).collect())


class Node:
    """A container of a random template: how often it stands on which pages, and what text it starts with on them."""

    def __init__(self, rng, path, depth, names, pages):
        self.path = f"{path}/div.{next(names)}"
        self.fixed = rng.random() < 0.5
        self.words = rng.choice([0, 3, 8])
        on = {i for i in range(pages) if rng.random() < 0.7} if rng.random() < 0.4 else set(range(pages))
        repeats = depth > 0 and rng.random() < 0.3
        self.times = {i: rng.choice([2, 3, 4]) if repeats else 1 for i in sorted(on)}
        self.children = [] if repeats or depth == 3 else [Node(rng, self.path, depth + 1, names, pages) for _ in range(rng.randrange(4))]

    def text(self, page, nr):
        return words_of(f"{0 if self.fixed else page}y{nr}", self.path.rpartition(".")[2], self.words)

    def html(self, page):
        return "".join(f'<div class="{self.path.rpartition(".")[2]}">{self.text(page, k)}{"".join(c.html(page) for c in self.children)}</div>' for k in range(self.times.get(page, 0)))

    def met(self, page):
        """(path, text) of each container on the page, in order."""
        for k in range(self.times.get(page, 0)):
            yield self.path, self.text(page, k)
            for c in self.children:
                yield from c.met(page)


def deduced(pages):
    """Paths whose text is the template's, from whole vectors; ``pages`` are lists of (path, text)."""
    counts, texts = defaultdict(dict), defaultdict(dict)
    for i, found in enumerate(pages):
        for path in {p for p, _ in found}:
            counts[path][i] = sum(p == path for p, _ in found)
            texts[path][i] = " ".join(t for p, t in found if p == path and t)
    classes = defaultdict(list)
    for path, vector in counts.items():
        classes[tuple(sorted(vector.items()))].append(path)
    out = set()
    for vector, paths in classes.items():
        if 2 * len(vector) >= len(pages) and (len(paths) > 1 or sum(n for _, n in vector) < 2 * len(vector)) and len(vector) >= template.FEWEST:
            out |= {p for p in paths if len(set(texts[p].values())) == 1}
    return out


def test_random_templates_against_whole_vectors(spark):
    rows, expected, dropped = [], {}, 0
    for seed in range(30):
        rng, n = random.Random(seed), 12
        names = (f"k{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(26 * 26))
        tops = [Node(rng, "page/html/body", 0, names, n) for _ in range(4)]
        story = Node(rng, "page/html/body", 3, names, n)
        story.fixed, story.words, story.times = False, 60, dict.fromkeys(range(n), 1)
        tops.insert(2, story)
        pages = [[("page/html", ""), ("page/html/body", ""), *(x for t in tops for x in t.met(i))] for i in range(n)]
        fixed = deduced(pages)
        for i, found in enumerate(pages):
            key = 100 * seed + i
            rows.append((key, f"http://host{seed}/{i}", f'<html><body>{"".join(t.html(i) for t in tops)}</body></html>'))
            expected[key] = " ".join(t for p, t in found if t and p not in fixed)
            dropped += sum(bool(t) for p, t in found if p in fixed)
    found = {r.page_id: r.text for r in template.extracted(frame(spark, rows)).collect()}
    assert dropped > 500 and found == expected


def test_rare_paths_keep_their_weight(spark):
    rows = []
    for i in range(120):
        slug = "".join(chr(97 + int(c)) for c in f"{i:03d}")
        rows.append((i, f"http://host/{i}", f'<html><body><div class="intro">{words_of(0, "in", 20)}</div><div id="{slug}"><article>{words_of(i, "w", 200)}</article></div></body></html>'))
    for n in (40, 120):
        found = template.extracted(frame(spark, rows[:n])).collect()
        assert len(found) == n and all(r.text.endswith(words_of(r.page_id, "w", 200)) for r in found)


def test_repeated_pages_do_not_cancel(spark):
    html = '<html><body><div class="story"><p>a b c</p><div class="para">x y</div><div class="para">z</div></div></body></html>'
    host = template.templates(frame(spark, [(1, "http://h/", html)] * 2)).first()
    assert not any({"page/html", "page/html/body/div.story/div.para"} <= set(c.tokens) for c in host.classes)


def test_siblings_and_second_layouts(spark):
    rows = []
    for i in range(10):
        rows.append((i, f"http://host/{i}", f'<html><body><article><div class="title">{words_of(i, "t", 5)}</div><div class="body">{words_of(i, "b", 200)}</div></article></body></html>'))
    # has the main container, but its text elsewhere
    rows.append((10, "http://host/10", f'<html><body><article><div class="title">{words_of(10, "t", 5)}</div><div class="body"></div></article><section>{words_of(10, "s", 80)}</section></body></html>'))
    found = {r.page_id: r.text for r in template.extracted(frame(spark, rows)).collect()}
    for i in range(10):
        assert found[i] == f'{words_of(i, "t", 5)} {words_of(i, "b", 200)}'
    assert found[10] == f'{words_of(10, "t", 5)} {words_of(10, "s", 80)}'


@pytest.mark.parametrize("wrapper", ['form id="aspnetForm" method=post', "fieldset", "dialog open", "object"])
def test_a_wrapper_around_the_page_is_no_aside(spark, wrapper):
    tag = wrapper.split()[0]
    rows = []
    for i in range(8):
        controls = '<input type="hidden" name="state" value="x"><input type=hidden>' * 10 + '<label>Find it <input name=q></label><button>Go</button>'
        rows.append((i, f"http://host/{i}", f'<body><{wrapper}>{controls}<nav>Home About</nav><div class="content"><p>{words_of(i, "w", 60)}</p></div><div class="sidebar">more</div></{tag}><footer>Foot</footer></body>'))
    found = {r.page_id: r.text for r in template.extracted(frame(spark, rows)).collect()}
    assert found == {i: words_of(i, "w", 60) for i in range(8)}


def test_forms_with_controls_stay_out(spark):
    sign = '<form><p>Name and password of your account here</p><input name=n><input type=password><button>Enter</button></form>'
    letter = '<form><p>Our weekly letter</p><input name=mail></form>'
    rows = [(i, f"http://one/{i}", f"<body><div><p>{words_of(i, 'w', 50)}</p></div>{sign}{letter}</body>") for i in range(5)]
    rows += [(10 + i, f"http://two/{i}", f"<body><nav>Home</nav>{sign}</body>") for i in range(5)]
    found = {r.page_id: r.text for r in template.extracted(frame(spark, rows)).collect()}
    assert found == {**{i: words_of(i, "w", 50) for i in range(5)}, **{10 + i: "" for i in range(5)}}


def test_nested_wrappers_and_paths():
    page = f'<form><div><form class="x"><p>{words_of(1, "w", 40)}</p></form></div><fieldset>a<input></fieldset></form>'
    found = template.pieces(page)
    assert {p for p, what, _ in found if what == template.TEXT} == {"page/openform/div/openform.x", "page/openform/fieldset"}


def test_empty_table(pages):
    assert template.extracted(pages.limit(0)).count() == 0 and warc.round_trip(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- WARC ----


def test_captures_of_the_given_pages(pages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}'")
    cur = con.execute(warc.ORACLE_SQL)
    names = [d[0] for d in cur.description]
    expected = sorted((tuple(r) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r[n] for n in names) for r in warc.round_trip(pages).collect()), key=str) == expected


def test_equal_payloads_and_odd_rows(spark):
    big = "x\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/b\r\nc", big), (2, None, big), (2, "http://q", big), (2, "http://q", big), (3, "u", None), (4, "u", ""), (None, "é", big), (5, None, "é" * 10), (None, None, None)]
    found = warc.round_trip(frame(spark, rows)).collect()
    h = hashlib.sha1(big.encode()).hexdigest()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in found if r.payload_digest == h) == [(0, "revisit", 2, len(big)), (1, "revisit", 2, len(big)), *[(2, "response", 0, len(big))] * 3]
    assert sorted((r.page_id or 0, r.payload_bytes) for r in found if r.payload_digest != h) == [(0, 0), (3, 0), (4, 0), (5, 20)]
    assert all(r.digest_ok for r in found if r.record_type == "response")
    assert {r.url for r in found if r.page_id == 1} == {"http://a/b%0D%0Ac"}


def test_nested_captures_hold_the_payloads(spark, tmp):
    rows = [(1, "http://a/x?y#z", "<p>é</p>"), (2, "http://b/", None)]
    warc.write_archive(frame(spark, rows), tmp + "/warc")
    found = {r.metadata.page_id: r for r in warc.transactions(warc.read_records(spark, tmp + "/warc")).collect()}
    assert bytes(found[1].response.payload).decode() == "<p>é</p>" and bytes(found[2].response.payload) == b""
    for r in found.values():
        assert r.request.concurrent_to == r.metadata.concurrent_to == r.response.record_id
        assert dict((h.name, h.value) for h in r.request.headers)["WARC-Type"] == "request"


def test_members_of_a_file():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.records_of(warc._inflate(gzip.compress(one) + gzip.compress(one)))] == [b"abc", b"abc"]
