"""Main text of pages by equivalence classes of their host's markup.

Tokens are a page's containers, each told by its path of tags, classes and ids (digits and further
differences between pages left out). A token's occurrence vector is its count on every page of its
host; vectors are compared by a digest that pages add to in any order, so hosts of any size are summed by
partial aggregation. Tokens with equal vectors form an equivalence class; a class is valid
when enough of the host's pages have it and it is not a lone token that repeats within pages, and valid classes
nest by their paths into the host's template. Their tokens bound the slots; any other token is data of
the slot it stands in, and the words of paths that few pages have count for the nearest path above that more have.

The text directly in a container, a page's in one, is a token too. If its vector is that of its container, which
is to say that every page that has the container has this text in it, and the container is of a valid class, the text
belongs to the template as the container does: nothing fills that slot, whatever its name. Slots that pages fill differently
are data. Of these, slots in containers that are known not to be the article (by tag or name) and slots that are mostly links are left out;
the rest is clean. A form or other wrapper around
nearly all of a page's prose is no such container; its controls and their labels are. The main slot is the deepest template container that holds nearly all clean words. A page's main text is,
in the page's order, all text of the main slot and of the clean slots outside it, but for such containers inside them.
Where that holds too few of a page's clean words, the page's own slots, judged alike, are added.

Texts of the template are told on hosts of ``FEWEST`` pages and more. Where they would be nearly all clean words of a host, it
publishes one article again and again, and its texts are data.

Defined cases: a null or empty page has an empty text; a null url (or one without host) belongs to the host "";
repeated pages count as so many pages; unclosed tags end with their parents, a tag cut
off at the page's end is dropped, an unclosed comment, script or style reaches to the end; other
columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from decimal import Decimal
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.work import written

#: Share of a host's pages that a valid class is on, and of the clean words that the main slot holds.
SUPPORT, NEARLY_ALL = 0.5, 0.9
#: A path whose words are to this share in links is a menu.
LINKED = 0.5
#: A path on less than one of so many of a host's pages is rare.
RARE = 50
#: A lone token that a page has so often on average is data.
REPEATED = 2
#: Pages that a container must be on before its text can be the template's.
FEWEST = 5
#: Containers nested deeper belong to the path of the one at this depth.
DEEPEST = 64
#: Tags of the format by their part in a page.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
CONTAINERS = frozenset(
    "html head body div section article main header footer nav aside form table tbody thead tfoot tr td th ul ol dl figure blockquote center details dialog fieldset button select svg menu address hgroup object audio video canvas label".split()
)
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr br option legend caption figcaption summary".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NOT_MAIN = frozenset("head nav footer aside form button select svg menu dialog object audio video canvas fieldset label".split())
ARTICLE = frozenset("article main".split())
WRAPPERS = frozenset("form fieldset dialog object".split())
CONTROLS = frozenset("input textarea select button".split())
#: Words of a wrapper for each of its controls, from which it holds the page's prose, if it has nearly all of that.
PROSE = 10
OPEN = "open"
#: Words in the class or id of containers that are not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner menu nav navbar navigation sidebar footer header masthead breadcrumb breadcrumbs cookie cookies consent "
    "notice notices alert popup modal overlay comment comments disqus reply replies respond share sharing social related recommended newsletter subscribe subscription login signin signup register search pagination pager widget toolbar".split()
)
TOKEN = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)(?:>|\Z))", re.S)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

HIDDEN = re.compile(r"\btype\s*=\s*[\"']?hidden\b", re.I)

COUNTS = "host string, path string, mark decimal(38,0), pages long, times long, words long, linked long, low long, high long, named boolean, aside boolean"


_known: dict = {}


def _once(call, *args):
    """``call(*args)``, remembered in this process; a few thousand at a time."""
    if (call.__name__, args) not in _known:
        if len(_known) >= 1 << 14:
            _known.clear()
        _known[call.__name__, args] = call(*args)
    return _known[call.__name__, args]


def _component(tag: str, attributes: str) -> str:
    """Tag with class and id words; digits out, so that numbered ids are one."""
    words = [w for _, *values in NAMED.findall(attributes) for v in values if v for w in re.sub(r"[0-9]+", "", v.lower()).split()]
    return ".".join([tag, *sorted(set(re.sub(r"[./]", "", w) for w in words) - {""})])


def _aside(path: str, names: bool) -> bool:
    """Whether a container of the path is known not to be the article."""
    inside = False
    for part in path.split("/"):
        tag, *words = part.split(".")
        if tag in NOT_MAIN or (tag == "header" and not inside):
            return True
        if names and tag not in ("page", "html", "body", *ARTICLE) and any(x in NAMES for w in words for x in re.split(r"[-_]", w)):
            return True
        inside |= tag in ARTICLE
    return False


#: What a piece is: text, text of a link, a container's start, a block's edge, or a control that is shown.
TEXT, LINK, START, EDGE, CONTROL = range(5)


def _read(html: str) -> Iterator[tuple[str, int, str]]:
    """(path, what, text) of the page in order; a space stands for each block's edge. Paths start with ``page``."""
    stack: list[tuple[str, str]] = []
    path, links, at = "page", 0, 0
    lower = None
    for m in iter(lambda: TOKEN.search(html, at), None):
        if m.start() > at:
            yield path, LINK if links else TEXT, unescape(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in CONTROLS and not m[1] and not HIDDEN.search(m[3]):
            yield path, CONTROL, ""
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in CONTAINERS and any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
                path, links = (stack[-1][1] if stack else "page"), 0
        elif tag in RAW:
            lower = lower if lower is not None else html.lower()
            end = lower.find(f"</{tag}", at)
            at = end if end >= 0 else len(html)
        elif tag == "a":
            links += 1
        elif tag in CONTAINERS and not m[3].endswith("/"):
            if len(stack) < DEEPEST:
                path = f"{path}/{_once(_component, tag, m[3])}"
            stack.append((tag, path))
            yield path, START, " "
        if tag in BLOCKS:
            yield path, EDGE, " "
    if at < len(html):
        yield path, LINK if links else TEXT, unescape(html[at:])


def pieces(html: str) -> list[tuple[str, int, str]]:
    """The page's pieces; a form or other wrapper around the page's prose is named as such in their paths, and is no aside then.

    Such a wrapper has nearly all words that are not in other asides, and ``PROSE`` of them at least for each control.
    """
    found = list(_read(html))
    wrappers = {q for path in {p for p, _, _ in found} for q in _prefixes(path) if _tag(q) in WRAPPERS}
    if not wrappers:
        return found
    words: Counter = Counter()
    controls: Counter = Counter()
    for path, what, text in found:
        if what <= LINK or what == CONTROL:
            bare = _opened(path, wrappers)
            if not _once(_aside, bare, True):
                (controls if what == CONTROL else words)[path] += 1 if what == CONTROL else len(text.split())
    total = sum(words.values())
    inside = {q: (sum(n for p, n in words.items() if _within(p, q)), sum(n for p, n in controls.items() if _within(p, q))) for q in wrappers}
    open_ = {q for q, (n, k) in inside.items() if n and n >= NEARLY_ALL * total and n >= PROSE * k}
    if not open_:
        return found
    renamed = {p: _opened(p, open_) for p in {p for p, _, _ in found}}
    return [(renamed[path], what, text) for path, what, text in found]


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _opened(path: str, wrappers: set[str]) -> str:
    """``path`` with those of its containers that are among the wrappers named as open ones."""
    return "/".join(f"{OPEN}{q.rpartition('/')[2]}" if q in wrappers else q.rpartition("/")[2] for q in _prefixes(path))


def _words(found: list[tuple[str, int, str]]) -> dict[str, tuple[int, int]]:
    """Words, and those in links, directly in each path."""
    out: dict[str, tuple[int, int]] = {}
    for path, what, text in found:
        if what <= LINK:
            n, k = out.get(path, (0, 0))
            m = len(text.split())
            out[path] = (n + m, k + m * what)
    return out


def _contents(found: list[tuple[str, int, str]]) -> dict[str, int]:
    """64 bits of the text directly in each path, white space aside; a path without text has those of an empty one."""
    texts: dict[str, list[str]] = defaultdict(list)
    for path, what, text in found:
        texts[path] += text.split() if what <= LINK else ()
    return {path: int.from_bytes(hashlib.blake2b(" ".join(t).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for path, t in texts.items()}


def _prefixes(path: str) -> list[str]:
    parts = path.split("/")
    return ["/".join(parts[: i + 1]) for i in range(len(parts))]


#: Words of a path or slot: all, those outside known asides, and the clean ones; the latter two with names and by tags alone.
Weights = tuple[int, int, int, int, int]


def _weights(words: dict[str, tuple[int, int]]) -> dict[str, Weights]:
    """Weights of a single page's paths."""
    out = {}
    for p, (n, k) in words.items():
        by = [(0, 0) if _once(_aside, p, names) else (n, n - k if k <= LINKED * n else 0) for names in (True, False)]
        out[p] = (n, *by[0], *by[1])
    return out


def _slot(path: str, tokens) -> str | None:
    """Nearest of the tokens at or above the path."""
    while path not in tokens:
        path, _, last = path.rpartition("/")
        if not path:
            return None
    return path


def chosen(weights: dict[str, Weights], template: set[str]) -> dict:
    """Main slot (None if no word is clean), clean slots outside it, template tokens that end those, and whether names told."""
    every = sum(w[0] for w in weights.values())
    for names, at in ((True, 1), (False, 3)):
        total = sum(w[at + 1] for w in weights.values())
        if total * 20 >= every:
            break
    if not total:
        return {"main": None, "slots": [], "bounds": [], "names": names}
    held: Counter = Counter()
    inside: dict = defaultdict(lambda: [0, 0])
    for p, w in weights.items():
        for q in _prefixes(p):
            held[q] += w[at + 1]
        slot = inside[_slot(p, template)]
        slot[0] += w[at]
        slot[1] += w[at + 1]
    fit = [q for q, n in held.items() if n >= NEARLY_ALL * total and q in template]
    main = max(fit, key=lambda q: (q.count("/"), q)) if fit else None
    apart = {q for q in template if main is None or not _within(q, main)}
    slots = {q for q, (n, clean) in inside.items() if q in apart and clean > 0 and clean >= (1 - LINKED) * n}
    return {"main": main, "slots": sorted(slots), "bounds": sorted(q for q in apart - slots if _slot(q, slots)), "names": names}


def without(weights: dict[str, Weights], fixed: dict[str, Weights]) -> tuple[dict[str, Weights], set[str]]:
    """Weights without the template's texts, and the paths that hold those; as they are, and none, if those are nearly all clean words."""
    varied = {p: tuple(a - b for a, b in zip(w, fixed.get(p, (0,) * 5))) for p, w in weights.items()}
    if sum(w[4] for w in varied.values()) <= (1 - NEARLY_ALL) * sum(w[4] for w in weights.values()):
        return weights, set()
    return varied, set(fixed)


def _within(path: str, container: str) -> bool:
    return path == container or path.startswith(container + "/")


# ------------------------------------------------------------- template ----


def _mark(page: int, count: int) -> int:
    """64-bit part of a page in a token's occurrence vector; parts are added, so that repeated pages do not cancel."""
    x = (page * 0x9E3779B97F4A7C15 + count * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0, 0, 0, (1 << 63) - 1, -(1 << 63)])
        for host, page, html in zip(batch["host"].to_pylist(), batch["page"].to_pylist(), batch["html"]):
            found = pieces(html.as_py() or "")
            for path, (n, k) in _words(found).items():
                row = seen[host, path]
                row[3] += n
                row[4] += k
            contents = _contents(found)
            # every page has its root once
            for path, n in [("page", 1), *Counter(path for path, what, _ in found if what == START).items()]:
                row = seen[host, path]
                row[0] += _mark(page, n)
                row[1] += 1
                row[2] += n
                # the text's vector is the container's if all pages that have the container have one text in it
                content = contents.get(path, 0)
                row[5], row[6] = min(row[5], content), max(row[6], content)
        rows = [(h, p, Decimal(mark), *r, _once(_aside, p, True), _once(_aside, p, False)) for (h, p), (mark, *r) in seen.items()]
        kinds = [pa.string(), pa.string(), pa.decimal128(38, 0), *[pa.int64()] * 6, pa.bool_(), pa.bool_()]
        names = ("host", "path", "mark", "pages", "times", "words", "linked", "low", "high", "named", "aside")
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema(list(zip(names, kinds))))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


TEMPLATE = "host string, pages long, main string, slots array<string>, bounds array<string>, names boolean, fixed array<string>, classes array<struct<parent: int, pages: long, tokens: array<string>>>"
#: ``Weights`` as columns.
WEIGHTS = ["words", "n_named", "clean_named", "n_plain", "clean_plain"]
#: The same without what rare paths add.
OWN = [f"own_{c}" for c in WEIGHTS]


def _template(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Nested valid classes and slots of a host, from its tokens; as many rows as pages have kinds of containers."""
    total = int(rows["host_pages"].iloc[0])
    valid = rows[(rows["pages"] >= SUPPORT * total) & (rows["pages"] >= min(2, total))]
    # a token that no other goes along with and that repeats within pages is data
    groups = sorted((sorted(g["path"]), int(n)) for (_, n), g in valid.assign(mark=valid["mark"].astype(str)).groupby(["mark", "pages"]) if len(g) > 1 or int(g["times"].iloc[0]) < REPEATED * int(n))
    of = {p: i for i, (paths, _) in enumerate(groups) for p in paths}
    classes = []
    for paths, n in groups:
        above = [of[q] for q in _prefixes(paths[0])[:-1] if q in of and of[q] != of[paths[0]]]
        classes.append({"parent": above[-1] if above else -1, "pages": n, "tokens": paths})
    weights = {p: tuple(map(int, w)) for p, *w in zip(rows["path"], *(rows[c] for c in WEIGHTS))}
    told = rows[(rows["low"] == rows["high"]) & (rows["pages"] >= FEWEST) & (rows["own_words"] > 0)]
    own = {p: tuple(map(int, w)) for p, *w in zip(told["path"], *(told[c] for c in OWN)) if p in of}
    varied, fixed = without(weights, own)
    return pd.DataFrame([{"host": key[0], "pages": total, **chosen(varied, set(of)), "fixed": sorted(fixed), "classes": classes}])


def _hosted(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")).withColumn("host", host_of(F.col("url")))


def templates(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row (``TEMPLATE``) for each host."""
    rows = _hosted(pages, key, url, html).select("host", F.xxhash64("page_id", "html").alias("page"), "html")
    sums = [F.sum(c).alias(c) for c in ("mark", "pages", "times", "words", "linked")]
    ends = [F.min("low").alias("low"), F.max("high").alias("high")]
    counted = rows.mapInArrow(_counts, COUNTS).groupBy("host", "path").agg(*sums, *ends, F.max("named").alias("named"), F.max("aside").alias("aside"))
    clean = F.when(F.col("linked") <= LINKED * F.col("words"), F.col("words") - F.col("linked")).otherwise(0)
    for kind, out in (("named", "named"), ("plain", "aside")):
        counted = counted.withColumn(f"n_{kind}", F.when(F.col(out), 0).otherwise(F.col("words"))).withColumn(f"clean_{kind}", F.when(F.col(out), 0).otherwise(clean))
    own = [F.col(c).alias(o) for c, o in zip(WEIGHTS, OWN)]
    counted = written(counted.select("host", "path", "mark", "pages", "times", "low", "high", *WEIGHTS, *own), "tokens")
    most = counted.groupBy("host").agg(F.max("pages").alias("host_pages"))
    # paths few pages have cannot be of the template; the rest are as many as a page has
    all_paths = counted.join(most, "host")
    few = F.col("pages") * RARE < F.col("host_pages")
    held, rare = all_paths.filter(~few), all_paths.filter(few)
    return _with_rare(held, rare).groupBy("host").applyInPandas(_template, TEMPLATE)


def _with_rare(held: DataFrame, rare: DataFrame) -> DataFrame:
    """``held`` with the words of each rare path added to the nearest held path above it; the root is always held."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, 1, d), "/").alias("above")))
    wordy = rare.filter("words > 0").select("host", "path", *WEIGHTS, F.inline(above))
    met = wordy.join(held.select("host", F.col("path").alias("above")), ["host", "above"])
    nearest = met.groupBy("host", "path").agg(F.max_by("above", "depth").alias("above"), *[F.first(c).alias(c) for c in WEIGHTS])
    added = nearest.groupBy("host", F.col("above").alias("path")).agg(*[F.sum(c).alias(f"more_{c}") for c in WEIGHTS])
    kept = [c for c in held.columns if c not in WEIGHTS]
    return held.join(added, ["host", "path"], "left").select(*kept, *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in WEIGHTS])


# ----------------------------------------------------------- extraction ----


def _keeps(path: str, told: dict) -> bool:
    """Whether text directly in the path is of the main slot or of a clean one."""
    main = told["main"]
    if path in told["fixed"]:
        return False
    if main is not None and _within(path, main):
        # names decide inside the slot; the slot itself has been chosen
        return path == main or not _once(_aside, f"article/{path[len(main) + 1 :]}", True)
    return bool(told["slots"]) and not _once(_aside, path, told["names"]) and _slot(path, told["ends"]) in told["slots"]


def _told(found: dict) -> dict:
    return found | {"slots": set(found["slots"] or ()), "fixed": set(found["fixed"] or ()), "ends": {*(found["slots"] or ()), *(found["bounds"] or ())}}


def main_text(html: str, host: dict) -> str:
    found = pieces(html)
    paths = {p for p, _, _ in found}
    kept = {p for p in paths if _keeps(p, host)}
    weights = {p: (0,) * 5 if p in host["fixed"] else w for p, w in _weights(_words(found)).items()}
    own = chosen(weights, {q for p in paths for q in _prefixes(p)})
    clean = {p: w[2 if own["names"] else 4] for p, w in weights.items()}
    if sum(n for p, n in clean.items() if p in kept) < NEARLY_ALL * sum(clean.values()):
        own = _told(own | {"fixed": host["fixed"]})
        kept |= {p for p in paths if _keeps(p, own)}
    return " ".join("".join(text for p, _, text in found if p in kept).split())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = batch.select(["main", "slots", "bounds", "names", "fixed"]).to_pylist()
        texts = [main_text(h.as_py() or "", _told(t)) for h, t in zip(batch["html"], told)]
        yield pa.RecordBatch.from_pydict({"page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``."""
    # as a table, the templates' size is known: small ones are sent to the pages, others are joined
    known = written(templates(pages, key, url, html).select("host", "main", "slots", "bounds", "names", "fixed"), "templates")
    return _hosted(pages, key, url, html).join(known, "host", "left").select("page_id", "url", "html", "main", "slots", "bounds", "names", "fixed").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
