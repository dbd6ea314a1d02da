"""Main text of web pages as a maximum-scoring contiguous region.

A page becomes a sequence of items: runs of words and tags.  A run scores its
word count times the weight of its place (nearest block element with its class
words, and the boilerplate element around it, if any); a tag scores its own
weight, never above ``TAG_MOST`` < 0.  One linear scan finds the contiguous
region with the largest sum; the text is what stands in it at places of
positive weight.

Weights come from labelled pages: pages that mark their content with exactly one
``article`` (or else one ``main``) element label themselves.  Over a
bounded sample (the ``sample`` such pages with the smallest hash of page_id)
Spark counts how often each place and tag occurs inside and outside the marked content; a
weight is the logarithm of the smoothed ratio.  The sample bounds what the
driver collects and broadcasts; places never met take the weight of
their element, then a default.  Inside marked content, tags and
boilerplate cost little: they must not part an article from its last lines.

Blocks are closed by block-level tags; white space in a block becomes one space;
blocks are joined by ``separator`` in page order (the registered query: an empty
line).  Character references are
decoded once.  Scripts, styles, comments and other markup never give words; nor
does what is not shown as text (closed templates, selects, drawings and frames).
An unclosed one of the latter is read as ordinary markup, an unclosed script or
style runs to the end of the page as in a browser.  Formulas and object
fallbacks are read like other markup; MathML tags cost nothing.

Boilerplate elements are the furniture elements of HTML, elements with a
furniture name as class, id or role (the whole name, or hyphenated from furniture
and box words only: ``with-sidebar`` is not one), and hidden elements (``hidden``,
``aria-hidden="true"``, ``display:none``, class ``hidden``).  Their mark passes to
all they contain, but ends at a ``main`` and at an outermost ``article`` unless
that stands in a nav, aside, footer, menu or dialog, or is itself named as
furniture, or in comments or related items after another article.  An article
named as furniture is furniture where the page has one that is not.  Inside an article or main an
id alone is no sign on an element that begins with a heading (ids are made from
headings), unless a form or a named comment follows within ``SIGNS`` characters.

Furniture names are a prior that the labelled pages can overturn: where the
elements of a name hold most of the marked words on more of these pages than
not, the name is no furniture in this corpus.

Tags are read by HTML's rules: a quote opens a value after ``=`` only.  A tag that
never ends that way is closed by the first ``>``, and so are all after it, so a
page is read once however it is broken.

Defined cases: null or empty html gives an empty text; a page without a
positive region gives an empty text; unclosed and misnested tags are closed by the next
fitting tag; repeated pages give the same text; other columns are ignored; long pages are
scanned whole; without labelled pages the defaults apply.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import columns, tuned

SAMPLE, SIGNS = 2000, 3000
BLOCK_SEPARATOR = "\n\n"  # of the registered query
WORD_DEFAULT, TAG_DEFAULT, TAG_MOST, CLIP = 1.0, -0.5, -0.05, 3.0
BOILER_MOST, BOILER_LEAST, INSIDE_TAG_LEAST = -0.05, -1.0, -0.3
SCHEMA = "page_id long, url string, text string, n_chars long"

COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag: white space, slashes and attributes, a value in quotes after "=" only.
REST = re.compile(r"""((?:\s+|/|=?[^\s/>=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|(?!["'])[^\s>]+)?)?|=)*+)>""")
PLAIN_REST = re.compile(r"([^>]*)>")
SIGN = re.compile(r"""<(?:form|textarea|input)\b|class\s*=\s*["']?[^"'>]*\b(?:comment|reply|respond|disqus)""", re.I)
FIRST_TAG = re.compile(r"\s*<(h[1-6])\b", re.I)
ARTICLE = re.compile(r"<article(?=[\s/>])([^>]*)>", re.I)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

# HTML element names by role (fixed values).
RAW = frozenset("script style textarea title".split())  # unclosed, they run to the end of the page
SKIP_IF_CLOSED = frozenset("noscript template svg iframe select".split())
MATHML = frozenset("""math mi mo mn ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder
mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml""".split())
BLOCK = frozenset("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption
blockquote pre figure figcaption header footer nav aside form fieldset address details summary hgroup menu dialog center""".split())
BOILER = frozenset("nav aside footer form menu dialog button label legend".split())
EMPTY = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: Class, id and role words of page furniture (fixed values).
BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar
navigation breadcrumb breadcrumbs footer comment comments reply replies respond disqus cookie cookies consent notice notices alert popup modal
overlay share sharing social related recommended newsletter subscribe subscription signup widget toolbar login search pagination pager
contentinfo complementary masthead skip""".split())
#: Words that may stand beside furniture words in one hyphenated name.
BOX_WORDS = frozenset("""area bar block body bottom box btn button buttons col column container group head heading inner item items left link
links list main mobile outer panel primary right row secondary section site slot title top unit wrap wrapper""".split())
#: Furniture whose articles are remarks on, or lists beside, another article.
FOLLOWERS = frozenset(".comment .comments .reply .replies .respond .disqus .related .recommended".split())
FIXED_BOILER = frozenset("nav aside footer menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"html", "body"}


class _Open:
    __slots__ = ("name", "place", "boiler", "content")

    def __init__(self, name, place, boiler, content):
        self.name, self.place, self.boiler, self.content = name, place, boiler, content


def _names_of(attributes: str) -> tuple[list[str], list[str], bool]:
    """Lower-case class and role names, id names, and whether the element is hidden."""
    out, ids, hidden = [], [], False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            (ids if key == "id" else out).extend(value.lower().split())
            hidden |= key == "class" and "hidden" in value.lower().split()
        elif key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and NO_DISPLAY.search(value):
            hidden = True
    return out, ids, hidden


def _furniture(names: list[str], inside: bool, content_words=frozenset()) -> str:
    """The first furniture word of the names that are furniture, or ''."""
    found = set()
    for name in names:
        parts = [p for p in re.split(r"[^a-z0-9]+", name) if p]
        own = [p for p in parts if (p in BOILER_WORDS or p == "header" and not inside) and p not in content_words]
        if own and all(p in own or p in BOX_WORDS or p.isdigit() for p in parts):
            found.update(own)
    return min(found, default="")


class _Tags:
    """Tags of a page by position; reads every character once."""

    def __init__(self, page: str):
        self.page, self.plain = page, False
        self.last = page.rfind(">")

    def at(self, lt: int):
        """(end, closing, name, attributes) of the tag or comment at a "<"
        (name '' for a comment), or None where the "<" is text."""
        m = COMMENT.match(self.page, lt)
        if m:
            return m.end(), False, "", ""
        m = NAME.match(self.page, lt) if lt < self.last else None
        if not m:
            return None
        rest = None if self.plain else REST.match(self.page, m.end())
        if rest is None:
            rest, self.plain = PLAIN_REST.match(self.page, m.end()), True
        return (rest.end(), bool(m[1]), m[2].lower(), rest[1]) if rest else None


def items(page: str, content_words=frozenset()):
    """Yield ("text", place, boiler, content depth, raw text), ("tag", name,
    content depth) and ("block",) in page order.  ``content_words`` are
    furniture words that are none in this corpus."""
    stack, open_ = [_Open("", "", "", 0)], Counter({"": 1})
    at, n, articles, unclosed, tags = 0, len(page), 0, set(), _Tags(page)
    named = [_furniture(sum(_names_of(m[1])[:2], []), True, content_words) for m in ARTICLE.finditer(page)] if "<article" in page.lower() else []
    plain_article = "" in named

    def pop():
        open_[stack.pop().name] -= 1

    while at < n:
        lt = page.find("<", at)
        tag = None
        while lt >= 0:
            tag = tags.at(lt)
            if tag is not None:
                break
            lt = page.find("<", lt + 1)  # a lone "<" is text
        lt = n if lt < 0 else lt
        if lt > at:
            top = stack[-1]
            yield "text", top.place, top.boiler, top.content, page[at:lt]
        if tag is None:
            break
        at, closing, name, attributes = tag
        if not name:
            continue
        top = stack[-1]
        if not closing and (name in RAW or name in SKIP_IF_CLOSED):
            if not attributes.endswith("/") and name not in unclosed:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
                if not end:
                    unclosed.add(name)
                at = end.end() if end else n if name in RAW else at
            continue
        if name in MATHML:
            if name in ("mtr", "mlabeledtr", "mtd"):
                yield "text", top.place, top.boiler, top.content, " "
            continue
        if name == "br":
            yield "text", top.place, top.boiler, top.content, " "
        yield "tag", place_key(("/" if closing else "") + name, top.boiler), top.content
        if name in EMPTY or not (name in BLOCK or name in BOILER or name in ("td", "th")):
            if name == "hr":
                yield ("block",)
            elif name in ("td", "th"):
                yield "text", top.place, top.boiler, top.content, " "
            continue
        if name in ("td", "th"):
            yield "text", top.place, top.boiler, top.content, " "
            continue
        if closing:
            if open_[name] > 0:
                while stack[-1].name != name:
                    pop()
                pop()
            if name in BLOCK:
                yield ("block",)
            continue
        if name in CLOSES_P:
            yield ("block",)
            if stack[-1].name == "p" or stack[-1].name in HEADINGS and name in HEADINGS:
                pop()
            elif name == "li" and stack[-1].name == "li" or name in ("dt", "dd") and stack[-1].name in ("dt", "dd") \
                    or name == "tr" and stack[-1].name == "tr":
                pop()
        top = stack[-1]
        names, ids, hidden = _names_of(attributes) if attributes else ([], [], False)
        words = sorted({w for x in names + ids for w in re.split(r"[^a-z0-9]+", x) if w})
        inside = open_["article"] > 0 or open_["main"] > 0
        found = _furniture(names, inside, content_words)
        if not found and ids and not (inside and FIRST_TAG.match(page, at) and not SIGN.search(page, at, at + SIGNS)):
            found = _furniture(ids, inside, content_words)
        boiler = top.boiler
        if boiler and name in ("main", "article") and (name == "main" or boiler not in FIXED_BOILER and not top.content & 0xFFFF
                                                       and not found and not (articles and boiler in FOLLOWERS)):
            boiler = ""
        elif not boiler:
            if name in BOILER or name == "header" and not inside:
                boiler = name
            elif name == "article":
                boiler = "." + found if found and plain_article else ""
            elif name not in ("body", "html", "main"):
                boiler = "." + found if found else "hidden" if hidden else ""
        articles += name == "article" and not boiler
        content = top.content + (1 if name == "article" and not boiler else 1 << 16 if name == "main" else 0)
        place = name + "".join(f".{w}" for w in words if not w.isdigit())
        stack.append(_Open(name, place, boiler, content))
        open_[name] += 1


def place_key(place: str, boiler: str) -> str:
    return f"{boiler}>{place}" if boiler else place


def tallies(page: str):
    """(key, words or tags inside the marked content, outside) of one page,
    or nothing when it does not mark its content exactly once."""
    found = list(items(page))
    opened = [x[1].split(">")[-1] for x in found if x[0] == "tag"]
    if opened.count("article") == 1:
        marked = lambda depth: depth & 0xFFFF > 0
    elif opened.count("main") == 1 and not opened.count("article"):
        marked = lambda depth: depth >> 16 > 0
    else:
        return {}
    out: dict[str, list[int]] = {}
    whole, under = 0, {}
    for x in found:
        if x[0] == "text":
            n = len(entities.unescape(x[4]).split())
            if n:
                out.setdefault("w " + place_key(x[1], x[2]), [0, 0])[0 if marked(x[3]) and not x[2] else 1] += n
                if marked(x[3]):
                    whole += n
                    if x[2].startswith("."):
                        under[x[2]] = under.get(x[2], 0) + n
        elif x[0] == "tag":
            out.setdefault("t " + x[1], [0, 0])[0 if marked(x[2]) else 1] += 1
    for word, n in under.items():  # a vote: does the name hold most of the marked words?
        out["b " + word[1:]] = [1, 0] if 2 * n > whole else [0, 1]
    return out


def learn(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights by key from a bounded sample of self-labelled pages."""
    tuned(pages.sparkSession)
    marked = pages.select("page_id", "html").where(
        "page_id is not null and html is not null and (html ilike '%<article%' or html ilike '%<main%')")
    # Only ids are sorted; the pages of at most ``sample`` ids are then read again.
    chosen = marked.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    marked = marked.join(F.broadcast(chosen), "page_id", "left_semi")

    def run(batches):
        for batch in batches:
            rows = [(k, a, b) for page in columns(batch, "html")[0].to_pylist() for k, (a, b) in tallies(page).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                             ["key", "inside", "outside"])

    counts = marked.mapInArrow(run, "key string, inside long, outside long").groupBy("key").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    weights = {}
    for key, inside, outside in counts.collect():
        weights[key] = max(-CLIP, min(CLIP, math.log((inside + 1) / (outside + 1))))
    return weights


def tag_weight(weights: dict[str, float], key: str, content: int) -> float:
    own = min(TAG_MOST, weights.get("t " + key, TAG_DEFAULT))
    return max(own, INSIDE_TAG_LEAST) if content else own


def word_weight(weights: dict[str, float], place: str, boiler: str, content: int = 0) -> float:
    if boiler and content:
        return BOILER_MOST
    own = weights.get("w " + place_key(place, boiler))
    if own is None:
        own = weights.get("w " + place_key(place.split(".")[0], boiler), WORD_DEFAULT)
    return max(BOILER_LEAST, min(own, BOILER_MOST)) if boiler else own


def content_words(weights: dict[str, float]) -> frozenset[str]:
    """Furniture words that the labelled pages overturn."""
    return frozenset(key[2:] for key, w in weights.items() if key.startswith("b ") and w > 0)


def main_text(page: str, weights: dict[str, float], separator: str = "\n") -> str:
    """Text of the best region of one page, its blocks joined by ``separator``."""
    scored, block = [], 0  # (score, block, text or None)
    for x in items(page, content_words(weights)):
        if x[0] == "block":
            block += 1
        elif x[0] == "tag":
            scored.append((tag_weight(weights, x[1], x[2]), block, None))
        else:
            text = entities.unescape(x[4]) if "&" in x[4] else x[4]
            w = word_weight(weights, x[1], x[2], x[3])
            scored.append((len(text.split()) * w, block, text if w > 0 else None))
    best, best_from, best_to, run, begin = 0.0, 0, 0, 0.0, 0
    for k, (score, _, _) in enumerate(scored):
        if run <= 0:
            run, begin = 0.0, k
        run += score
        if run > best:
            best, best_from, best_to = run, begin, k + 1
    out: list[str] = []
    last, parts = None, []
    for _, b, text in [*scored[best_from:best_to], (0, None, None)]:
        if b != last:
            joined = " ".join("".join(parts).split())
            if joined:
                out.append(joined)
            last, parts = b, []
        if text is not None:
            parts.append(text)
    return separator.join(out)


def main_texts(pages: DataFrame, weights: dict[str, float] | None = None, sample: int = SAMPLE, separator: str = "\n") -> DataFrame:
    """One row per page row: page_id, url, text, n_chars."""
    spark = tuned(pages.sparkSession)
    shared = spark.sparkContext.broadcast(learn(pages, sample) if weights is None else weights)  # the places of the sample's pages

    def run(batches):
        weights = shared.value
        for batch in batches:
            ids, urls, html = columns(batch, "page_id", "url", "html")
            texts = [main_text(p, weights, separator) if p else "" for p in html.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), urls.cast(pa.string()), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
