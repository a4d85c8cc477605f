"""Main text of HTML pages by the maximum-scoring subsequence.

A page becomes a sequence of words and tags. Elements that are boilerplate by their kind or their
class, id or role (menus, headers, footers, sidebars, notices, adverts, forms, reader comments,
scripts, styles) are left out, but for forms and marked elements that hold the page's main text
(:func:`_opened`): those are wrappers. In what remains, words score positive and tags negative; a linear scan
finds the contiguous run with the greatest total, and its words are the text, block by block. The
weights are log odds learned from labelled pages (:func:`labelled_pages` makes them); what tags without a word
between them take off is bounded (:data:`GAP`). Everything is linear in the page.

Edge cases: a null or empty page, or one without words, gives an empty text; unclosed, misnested
markup is read as browsers would, and a tag that the page's end cuts off is no text; repeated rows each get a row; null ids and urls are
carried; extra columns are ignored unless kept, and an output column whose name a kept one has gets underscores; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import fresh
from .workers import trimmed

#: Linear: attributes are taken without going back, a cut-off tag or comment goes on to the end of the page.
TOKEN = re.compile(
    r"""<!--(?P<comment>)|<!\[CDATA\[(?P<cdata>)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)"""
    r"""|(?P<text>[^<]++|<)""",
)
#: Elements whose content is no markup of the page.
RAW = frozenset("script style noscript template iframe noembed noframes title textarea xmp svg math canvas object".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in RAW}
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that are never part of the main text.
LEFT_OUT = frozenset("head nav header footer aside form menu dialog button select input label fieldset".split())
#: Words in class, id or role that mark one.
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted
    cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay newsletter subscribe subscription
    signup signin login register nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets
    related recommended recommendations recirc share sharing social comment comments commentlist reply replies respond disqus
    footer header masthead pagination pager pagenav toolbar search searchbox form contentinfo complementary dialog""".split()
)
#: Those of them that also occur in names of an article's own parts (post-header, form-field-notes): inside an article or
#: main element such a word marks only where it is the whole class, id or role.
WEAK = frozenset("header masthead form search searchbox notice notices alert alerts dialog toolbar login register menu overlay modal".split())
#: A run of tags without a word between counts no lower than this, in an article or main element, outside those and where there is none:
#: empty rows and boxes don't cut a text in two, and in an article one word outweighs them.
GAP = {"@main": -0.4, "@out": -6.0, "": -4.0}
#: Those of readers' contributions: articles so marked are not the page's.
READERS = frozenset("comment comments commentlist reply replies respond".split())
#: An element without a heading or an article is a wrapper if it has so many times the words of all that stays.
MOST = 10
MAIN = re.compile(r"<(?:article|main)[\s>]", re.I)
WORD_PART = re.compile(r"[a-z]+|[0-9]+")
#: An opening tag that ends an open element of the second kind.
CLOSES_P = BLOCK - {"body", "html", "head"}


def _marked(tag: str, attrs: str, inside: bool) -> str:
    """'hidden', 'marked' or nothing; ``inside`` an article or main element weak words mark only alone."""
    if tag in ("html", "body", "main", "article"):
        return ""
    found = ""
    for name, value in ATTR.findall(attrs):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.strip("\"'").lower() == "true"):
            return "hidden"
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "hidden"
        if name in ("class", "id", "role"):
            for token in value.lower().strip("\"'").split():
                hit = MARKS.intersection(WORD_PART.findall(token))
                if hit and (not inside or token in MARKS or hit - WEAK):
                    found = "marked"
    return found


def _by_readers(attrs: str) -> bool:
    return any(n.lower() in ("class", "id", "role") and not READERS.isdisjoint(WORD_PART.findall(v.lower())) for n, v in ATTR.findall(attrs))


def _opened(held: list[tuple[tuple[str, str, str], int, int]], parents: list[int]) -> list[bool]:
    """Which elements stay, of those that may be wrappers; 0 is the page.

    Words outside links count: those of the largest article or main element, or all where the page has none with words.
    From the outside in, the one with more of them than all that stays is opened, if it also has a first heading, an
    article of its own or MOST times as many; what it holds is judged in turn.
    """
    n = len(parents)
    words: list[Counter] = [Counter() for _ in range(n)]  # by article, -1 for none
    heading, article = [False] * n, [False] * n
    for (kind, value, where), node, of in held:
        if kind == "text" and ":link" not in where:
            words[node][of] += len(value.split())
        elif kind == "tag" and value == "h1":
            heading[node] = True
        elif kind == "tag" and value in ("article", "main") and of >= 0:
            article[node] = True
    some = any(c for w in words for of, c in w.items() if of >= 0)
    best, total, children = [0] * n, [0] * n, [[] for _ in range(n)]  # of an element with all that it holds
    whole: list[Counter] = [Counter() for _ in range(n)]

    def add(i: int, more: Counter) -> None:
        for of, c in more.items():
            whole[i][of] += c
            if of >= 0:
                best[i] = max(best[i], whole[i][of])

    for i in range(n - 1, -1, -1):  # an element comes after the one around it
        add(i, words[i])
        total[i] += sum(words[i].values())
        if i:
            up = parents[i]
            children[up].append(i)
            heading[up] |= heading[i]
            article[up] |= article[i]
            total[up] += total[i]
            best[up] = max(best[up], best[i])
            if len(whole[up]) < len(whole[i]):  # the smaller one moves, so an article moves a logarithmic number of times
                whole[up], whole[i] = whole[i], whole[up]
            add(up, whole[i])
            whole[i] = Counter()
    weight = best if some else total
    opened = [True] + [False] * (n - 1)
    stays, rest = Counter(), 0

    def stay(i: int) -> None:
        nonlocal rest
        for of, c in words[i].items():
            stays[of] += c
            rest = (max(rest, stays[of]) if of >= 0 else rest) if some else rest + c

    stay(0)
    edge = [(-weight[i], i) for i in children[0]]
    heapq.heapify(edge)
    while edge:
        own, i = heapq.heappop(edge)
        if -own <= rest:  # so have all others
            break
        if heading[i] or article[i] or -own >= MOST * rest:
            opened[i] = True
            stay(i)
            for j in children[i]:
                heapq.heappush(edge, (-weight[j], j))
    return opened


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """('tag', name, where), ('break', name, '') at block borders, ('text', decoded run, where); boilerplate left out.

    where: ':link' inside a link, then '@main' inside an article or main element, '@out' outside those of the page.
    """
    parents = [0]
    held = list(_held(page, parents))
    opened = _opened(held, parents) if len(parents) > 1 else [True]
    return (e for e, node, _ in held if opened[node])


def _held(page: str, parents: list[int]) -> Iterator[tuple[tuple[str, str, str], int, int]]:
    """Events with the innermost form or marked element they are in (0: none) and their article (-1: none of the page's).

    ``parents`` gets the element around each such element.
    """
    stack: list[tuple[str, bool, int, int]] = []  # name, left out for good; element and article around it
    out = links = articles = node = seen = 0
    of = -1
    has_main = MAIN.search(page) is not None

    def pop() -> None:
        nonlocal out, links, articles, node, of
        name, skip, node, of = stack.pop()
        out -= skip
        links -= name == "a"
        articles -= name in ("article", "main")

    def where() -> str:
        return (":link" if links > 0 else "") + ("@main" if articles > 0 else "@out" if has_main else "")

    count: Counter = Counter()  # of open elements by name
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        text, tag = m["text"], m["tag"]
        if m["comment"] is not None:
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            continue
        if m["cdata"] is not None:
            end = page.find("]]>", at)
            text = page[at : len(page) if end < 0 else end]
            at = len(page) if end < 0 else end + 3
        if text is not None:
            if not out:
                yield ("text", html.unescape(text), where()), node, of
        elif tag:
            tag = tag.lower()
            if at == len(page) and page[-1] != ">":  # cut off inside the tag
                return
            if m["close"]:
                if count[tag]:
                    was, inner, article = out, node, of
                    while stack[-1][0] != tag:
                        count[stack[-1][0]] -= 1
                        pop()
                    count[tag] -= 1
                    pop()
                    if not was:
                        yield ("tag", tag, where()), inner, article
                if tag in BLOCK and not out:
                    yield ("break", tag, ""), node, of
                continue
            if tag in RAW and not m["attrs"].endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag in RAW:
                continue
            if tag in BLOCK:
                if tag in CLOSES_P and count["p"]:
                    i = len(stack) - 1
                    while stack[i][0] != "p" and stack[i][0] not in BLOCK:
                        i -= 1
                    if stack[i][0] == "p":
                        while len(stack) > i:
                            count[stack[-1][0]] -= 1
                            pop()
                for same in (("li",), ("td", "th")):
                    if tag in same and stack and stack[-1][0] in same:
                        count[stack[-1][0]] -= 1
                        pop()
                if not out:
                    yield ("break", tag, ""), node, of
            mark = _marked(tag, m["attrs"], articles > 0)
            skip = mark == "hidden" or tag in LEFT_OUT and tag != "form" and not (tag == "header" and articles)
            if tag not in VOID and not m["attrs"].endswith("/"):
                stack.append((tag, skip, node, of))
                count[tag] += 1
                out += skip
                links += tag == "a"
                articles += tag in ("article", "main")
                if not out and (mark or tag == "form"):
                    parents.append(node)
                    node = len(parents) - 1
                if tag in ("article", "main") and not _by_readers(m["attrs"]):
                    of, seen = seen, seen + 1
            if not out:
                yield ("tag", tag, where()), node, of
                if tag == "br":
                    yield ("text", " ", ""), node, of


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and end of the contiguous run with the greatest sum; (0, 0) if none is positive."""
    best = now = 0.0
    at = (0, 0)
    begin = 0
    for i, s in enumerate(scores):
        if now <= 0:
            now, begin = 0.0, i
        now += s
        if now > best:
            best, at = now, (begin, i + 1)
    return at


def _kind(e: tuple[str, str, str]) -> str:
    return f"tag:{e[1]}{'@main' if e[2].endswith('@main') else '@out' if e[2].endswith('@out') else ''}" if e[0] == "tag" else f"word{e[2]}"


def learn_weights(pages: list[tuple[str, str]]) -> dict[str, float]:
    """Scores from pages labelled with their main text: smoothed log odds of each kind inside it.

    Words outside links stay positive and tags negative, as the scan asks; words outside a page's article may
    count against.
    """
    inside, outside = Counter(), Counter()
    for page, main in pages:
        wanted = set(main.split("\n"))
        run: list[tuple[str, int]] = []
        line: list[str] = []

        def close() -> None:
            hit = " ".join(" ".join(line).split()) in wanted
            for kind, n in run:
                (inside if hit else outside)[kind] += n
            run.clear()
            line.clear()

        for e in events(page):
            if e[0] == "break":
                close()
            elif e[0] == "tag":
                run.append((_kind(e), 1))
            else:
                line.append(e[1])
                run.append((_kind(e), len(e[1].split())))
        close()
    total_in, total_out = sum(inside.values()) + 1, sum(outside.values()) + 1
    weight = {}
    for kind in {*inside, *outside}:
        odds = math.log((inside[kind] + 1) / total_in) - math.log((outside[kind] + 1) / total_out)
        if kind in ("word", "word@main"):
            weight[kind] = max(0.5, min(1.0, odds))
        else:
            weight[kind] = min(-0.02, max(-0.25 if kind.endswith("@main") else -1.0, odds - 1.0)) if kind.startswith("tag:") else max(-1.0, min(0.5, odds))
    return weight


def labelled_pages(count: int = 200, seed: int = 5) -> list[tuple[str, str]]:
    """Pages of random words with their main text: articles among link lists, teasers and legal lines."""
    rng = random.Random(seed)
    syllables = "ba be bi do du fa fi ga ke ki la lo ma mi no nu pa re ri sa se ti to va ve zu".split()

    def words(n: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))

    pages = []
    for _ in range(count):
        links = lambda n: "".join(f'<li><a href="/{i}">{words(rng.randint(1, 3))}</a></li>' for i in range(n))
        blocks = [("h1", words(rng.randint(3, 9)))] + [(rng.choice(["p"] * 8 + ["h2", "blockquote", "li", "li", "td"]), words(rng.randint(2, 90))) for _ in range(rng.randint(2, 14))]
        body = ""
        for tag, text in blocks:
            cut = text.split()
            if len(cut) > 6 and rng.random() < 0.3:
                i = rng.randrange(len(cut) - 2)
                inline = rng.choice(["a href=x", "b", "span", "em"])
                text = " ".join([*cut[:i], f"<{inline}>{cut[i]}</{inline.split()[0]}>", *cut[i + 1 :]])
            around = {"li": ("<ul>", "</ul>"), "td": ("<table><tr>", "</tr></table>"), "p": rng.choice([("", "")] * 5 + [("<div>", "</div>")])}.get(tag, ("", ""))
            body += f"{around[0]}<{tag}>{text}</{tag}>{around[1]}"
        shell = rng.choice(["article", "main", "div", "div"])
        before = f"<div><ul>{links(rng.randint(3, 12))}</ul></div><div><span>{words(2)}</span></div>"
        after = f"<div><ul>{links(rng.randint(2, 9))}</ul></div><div><span><a href=y>{words(2)}</a></span> <a href=z>{words(1)}</a></div>"
        pages.append((f"<html><body>{before}<{shell}>{body}</{shell}>{after}</body></html>", "\n".join(w for _, w in blocks)))
    return pages


@functools.lru_cache(maxsize=4)
def trained_weights(count: int = 200, seed: int = 5) -> dict[str, float]:
    return learn_weights(labelled_pages(count, seed))


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    units: list[tuple[float, str | None]] = []  # score; a word, a gap (" ") or None at a block border
    unknown = {"": -0.5, "@main": -0.02}
    run = 0.0  # of tags since the last word
    for kind, value, where in events(page):
        if kind == "tag":
            score = weights.get(_kind((kind, value, where)), unknown["@main" if where.endswith("@main") else ""])
            low = GAP["@main" if where.endswith("@main") else "@out" if where.endswith("@out") else ""]
            score = min(0.0, max(score, low - run))
            run += score
            units.append((score, ""))
        elif kind == "break":
            units.append((0.0, None))
        else:
            parts = value.split()
            run = 0.0 if parts else run
            score = weights.get(f"word{where}", 0.5 if where.endswith("@main") or not where else -0.5)
            if not parts or value[0].isspace():
                units.append((0.0, " "))
            for i, w in enumerate(parts):
                if i:
                    units.append((0.0, " "))
                units.append((score, w))
            if parts and value[-1].isspace():
                units.append((0.0, " "))
    a, b = best_run([s for s, _ in units])
    blocks: list[str] = []
    line: list[str] = []
    for _, u in units[a:b]:
        if u is None:
            blocks.append("".join(line))
            line = []
        elif u:
            line.append(u)
    blocks.append("".join(line))
    return "\n".join(t for t in (" ".join(x.split()) for x in blocks) if t)


def _extract(names: list[str], added: list[str], weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p.as_py(), weights) for p in part.column("html")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, *added])

    return run


def extract_main_text(df: DataFrame, keep: list[str], weights: dict[str, float] | None = None) -> DataFrame:
    """``keep`` columns with ``text`` and ``n_chars`` of each row's ``html``."""
    kinds = dict(df.dtypes)
    added = [fresh(keep, "text"), fresh(keep, "n_chars")]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"`{added[0]}` string, `{added[1]}` bigint"])
    return df.select(*dict.fromkeys([*keep, "html"])).mapInArrow(trimmed(_extract(keep, added, weights or trained_weights())), schema)
