"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. Pass one labels each block
from its length, stop-word density, link density and the containers it lies
in; pass two gives short and middling blocks the label of the nearest decided
neighbours, but keeps several middling blocks in a row. On a page with a marked
article the blocks inside are in doubt only where links fill them, and the
blocks outside don't count, unless they hold far more text. A form or a class,
id or role name around an article speaks against it only where the page has
more text elsewhere; one that names comments, wherever there is other text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, utf8

# Limits of the rules: characters, shares.
SHORT, LONG, LINKS, STOP_LOW, STOP_HIGH = 70, 140, 0.4, 0.12, 0.28
#: Text outside every article is the main text if it is more than so many times the articles' own.
OUTWEIGHS = 2

# Elements whose content is never text of the page.
RAW = "script style noscript template textarea title iframe xmp svg math canvas select option object".split()
# Those of them that hold no tags, whatever looks like one.
RAW_TEXT = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*>?", re.I) for n in
            "script style noscript textarea title iframe xmp".split()}
# Ends of an option's parents.
OPTION_ENDS = "option optgroup datalist select".split()
# Elements that may stand in a head.
HEAD = "head base basefont bgsound link meta noframes".split()
# Elements whose open ones a start tag closes, the end tag being optional.
IMPLIED = {"li": ["li"], **dict.fromkeys(["dt", "dd"], ["dt", "dd"]), **dict.fromkeys(["td", "th"], ["td", "th"]),
           "tr": ["td", "th", "tr"], **dict.fromkeys(["tbody", "tfoot"], ["td", "th", "tr", "thead", "tbody"])}
# Elements that hold no article text.
BOILER = "nav footer aside form menu dialog button head".split()
MAIN = "article main".split()
# Elements that end a block.
BLOCK = set("""address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p
pre search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Whole class, id or role names that mark what isn't the article.
HINTS = set("""ad ads adv advert advertisement advertisements advertising adsense banner sponsor sponsored promo
promotion sidebar side nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar cookie
cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social
comment comments disqus respond replies related recommended recommendations widget pagination pager tags
complementary contentinfo search skip
ad-banner ad-container ad-slot ad-unit ad-wrapper adsbygoogle alert-box breadcrumb-nav breadcrumb-trail comment-area
comment-body comment-form comment-list comment-respond comments-area comments-list comments-section cookie-banner
cookie-bar cookie-consent cookie-notice entry-footer footer-bottom footer-links footer-menu footer-nav footer-widgets
global-nav left-nav main-menu main-nav main-navigation nav-bar nav-links nav-menu navbar-nav newsletter-form
newsletter-signup page-footer post-navigation post-tags primary-menu primary-nav promo-box related-articles
related-content related-links related-posts related-stories search-form share-bar share-buttons share-links
side-bar side-nav site-footer site-nav site-navigation skip-link social-buttons social-icons
social-links social-media social-share sponsored-content sub-menu subscribe-box subscribe-form tag-list tags-list top-bar
top-nav widget-area""".split())
# Names, or parts of names between hyphens, of reader comments.
COMMENTS = set("comment comments disqus respond replies".split())
# Parts that make such a name speak of the article's settings.
SETTINGS = set("no has with without open closed enabled disabled allow allowed on off show hide status".split())
# Frequent words of English, German, French and Spanish.
STOP = set("""the of and to in a is that for it was on are as with be by this from at or an not have has you but his
her they which we he she were been their will would there all one if so no can
der die das und ist in von zu den mit sich des auf für nicht ein eine einer dem im als auch es an werden aus er hat
dass sie nach wird bei einem um am sind noch wie einen über
le la les de des du et un une est en que qui dans pour pas sur au plus par avec ce se il elle ne sont aux ou son sa
el los las del y que una se por con no su para al lo como más o pero sus ha me si sin sobre este""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                    r"|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z][^>]*>?|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_HINTED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s>=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_NUMBER = re.compile(r"-?\d+\Z")
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    boiler: bool
    inside: bool
    heading: bool
    #: The article's number, the marked container around it and whether that holds comments; 0 where there is none.
    article: int = 0
    container: int = 0
    comment: bool = False
    main: bool = False

    @property
    def own(self) -> int:
        """Characters that aren't in links."""
        return len(self.text.replace(" ", "")) - self.link_chars


class Box(NamedTuple):
    """An open container: ``boiler`` is 1 by a name or form, 2 by element; the numbers as in Block."""
    name: str = ""
    boiler: int = 0
    inside: bool = False
    article: int = 0
    container: int = 0
    comment: bool = False
    main: bool = False


def _names(tag: str) -> list[str]:
    return [_NUMBER.sub("", w) for m in _HINTED.finditer(tag)
            for w in m[1].strip("\"'").lower().replace("_", "-").split()]


def _comments(tag: str) -> bool:
    """Whether a class, id or role name speaks of reader comments."""
    return "=" in tag and any(COMMENTS & (parts := set(w.split("-"))) and not SETTINGS & parts for w in _names(tag))


def _hinted(tag: str) -> bool:
    if "=" not in tag and "hidden" not in tag:
        return False
    return bool(_HIDDEN.search(tag)) or any(w in HINTS for w in _names(tag)) or _comments(tag)


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order, with white space collapsed; empty ones left out."""
    out: list[Block] = []
    stack: list[Box] = [Box()]
    # open containers by name; numbers given to articles and marked containers
    opened: Counter[str] = Counter()
    numbers = 0
    text: list[str] = []
    links = anchor = 0
    heading = False
    raw = ""
    at = 0

    def end() -> None:
        nonlocal links, text
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                box = stack[-1]
                out.append(Block(joined, links, box.boiler > 0, box.inside, heading,
                                 box.article, box.container, box.comment, box.main))
            text, links = [], 0

    def push(box: Box) -> None:
        stack.append(box)
        opened[box.name] += 1

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    def leave_head() -> None:
        if stack[-1].name == "head":
            end()
            pop()

    while m := _TOKEN.match(page, at):
        t, at = m[0], m.end()
        if t[0] != "<" or len(t) == 1:
            if not raw:
                if not t.isspace():
                    leave_head()
                t = html.unescape(t) if "&" in t else t
                text.append(t)
                if anchor:
                    links += len("".join(t.split()))
            continue
        if t.startswith("<![CDATA[") or t[1] in "!?":
            continue
        name = _NAME.match(t)[1].lower()
        closing = t[1] == "/"
        if name in RAW_TEXT:
            if name in BLOCK and not raw:
                end()
            if not closing and not t.endswith("/>"):
                close = RAW_TEXT[name].search(page, at)
                at = close.end() if close else len(page)
            continue
        if raw:
            if closing and name == raw:
                raw = ""
                continue
            if not (raw == "option" and closing and (name in OPTION_ENDS or opened[name])):
                continue
            raw = ""
        if not closing and name not in HEAD and name not in RAW:
            leave_head()
        if name in RAW:
            if name in BLOCK:
                end()
            if not closing and not t.endswith("/>"):
                raw = name
            continue
        if name == "br":
            text.append(" ")
        elif name == "a":
            anchor = 0 if closing else 1
        elif name in BLOCK:
            end()
            anchor = 0
            heading = not closing and len(name) == 2 and name[0] == "h" and name[1].isdigit()
            if not closing:
                if stack[-1].name == "p":
                    pop()
                while stack[-1].name in IMPLIED.get(name, ()):
                    pop()
            box = stack[-1]._replace(name=name)
            if name == "p" or heading or name in VOID:
                if not closing and name == "p" and _hinted(t):
                    push(box._replace(boiler=max(1, box.boiler), article=0))
                elif closing and stack[-1].name == name:
                    pop()
            elif not closing:
                numbers += 1
                if name != "form" and name in BOILER or (name == "header" and not box.inside):
                    box = box._replace(boiler=2, article=0)
                elif name == "form" or (name not in ("html", "body", *MAIN) and _hinted(t)) or (
                        name == "article" and _comments(t)):
                    box = box._replace(boiler=max(box.boiler, 1), container=numbers, article=0,
                                       comment=box.comment or _comments(t))
                if name in MAIN and not box.inside and box.boiler < 2:
                    box = box._replace(article=numbers)
                push(box._replace(inside=box.inside or name in MAIN, main=box.main or name == "main"))
            elif opened[name]:
                while pop() != name:
                    pass
    end()
    return out


def first_labels(blocks: list[Block]) -> list[str]:
    """good, bad, near (middling) or short, from each block alone."""
    out = []
    for b in blocks:
        words = _WORDS.findall(b.text.lower())
        links = b.link_chars / max(1, len(b.text.replace(" ", "")))
        stop = sum(w in STOP for w in words) / max(1, len(words))
        if b.boiler or links > LINKS:
            out.append("bad")
        elif b.inside:
            out.append("short" if len(b.text) < SHORT or b.heading else "good" if stop >= STOP_LOW else "near")
        elif b.heading or len(b.text) < SHORT:
            out.append("bad" if links else "short")
        elif stop >= STOP_HIGH:
            out.append("good" if len(b.text) >= LONG else "near")
        else:
            out.append("near" if stop >= STOP_LOW else "bad")
    return out


def keep_runs(labels: list[str]) -> list[str]:
    """Middling blocks between bad ones count as good where two or more stand between decided blocks,
    or where the page has no good block at all."""
    out, need = list(labels), 2 if "good" in labels else 1
    decided = [-1, *(i for i, label in enumerate(labels) if label in ("good", "bad")), len(labels)]
    for a, b in zip(decided, decided[1:]):
        near = [i for i in range(a + 1, b) if labels[i] == "near"]
        if len(near) >= need and "good" not in (*labels[max(a, 0):a + 1], *labels[b:b + 1]):
            for i in near:
                out[i] = "good"
    return out


def final_labels(blocks: list[Block], labels: list[str]) -> list[bool]:
    """Undecided blocks inherit from the nearest decided ones before and after.

    The page's edges count as bad.
    """
    n = len(blocks)
    labels = keep_runs(labels)
    before, after = [(n, "bad")] * n, [(n, "bad")] * n
    last = None
    for i in range(n):
        before[i] = (i - last, labels[last]) if last is not None else (n, "bad")
        if labels[i] in ("good", "bad"):
            last = i
    last = None
    for i in range(n - 1, -1, -1):
        after[i] = (last - i, labels[last]) if last is not None else (n, "bad")
        if labels[i] in ("good", "bad"):
            last = i
    out = []
    for b, label, (d1, l1), (d2, l2) in zip(blocks, labels, before, after):
        if label in ("good", "bad"):
            out.append(label == "good")
        elif b.inside:
            out.append(True)  # in the article only links and marks speak against a block
        elif l1 == l2:
            out.append(l1 == "good")
        elif label == "near":
            out.append(True)
        else:
            out.append((l1 if d1 < d2 else l2 if d2 < d1 else "bad") == "good")
    return out


def unmark_articles(blocks: list[Block], outside: int) -> None:
    """Lift the mark of a container whose article is the page's largest text.

    ``outside`` is the amount of text that the rules keep outside all
    articles. A container of comments is lifted only where the page has
    nothing else.
    """
    plain = sum(b.own for b in blocks if b.inside and not b.boiler)
    claims: Counter[tuple[bool, int, int]] = Counter()
    for b in blocks:
        if b.inside and b.boiler and b.article and b.container:
            claims[b.comment, b.container, b.article] += b.own
    named = [(n, container) for (comment, container, _), n in claims.items() if not comment]
    best = max(named, default=(0, 0))
    if not named and not plain and not outside:
        best = max(((n, container) for (_, container, _), n in claims.items()), default=(0, 0))
    if best[0] > max(plain, outside):
        for b in blocks:
            if b.inside and b.article and b.container == best[1]:
                b.boiler = False


def kept(blocks: list[Block]) -> list[Block]:
    return [b for b, k in zip(blocks, final_labels(blocks, first_labels(blocks))) if k]


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    if any(b.inside for b in blocks):
        around = kept([b for b in blocks if not b.inside])
        outside = sum(b.own for b in around)
        unmark_articles(blocks, outside)
        own = [b for b in blocks if b.inside and not b.boiler]
        if own and not any(b.main for b in own) and outside > OUTWEIGHS * sum(b.own for b in own):
            return "\n".join(b.text for b in around)
        if own:
            blocks = [b for b in blocks if b.inside]
    return "\n".join(b.text for b in kept(blocks))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars (code points) for every row of ``pages``.

    A null or empty page, or one without main text, has the text "". Each
    page is read whole; repeated rows are each extracted, columns not named
    aren't read, an empty table gives no rows.
    """
    kind = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [main_text(p.decode()) for p in utf8(batch.column("_html"))]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(f"_keep{i}") for i in range(len(keep))], pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            [*[f"_keep{i}" for i in range(len(keep))], "text", "n_chars"])

    rows = pages.select(F.col(html_col).alias("_html"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    schema = ", ".join([*[f"_keep{i} {kind[c]}" for i, c in enumerate(keep)], "text string", "n_chars long"])
    return map_batches(rows, run, schema).select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
                                                 "text", "n_chars")
