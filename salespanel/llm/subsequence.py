"""Main text of web pages as the maximum-scoring run of words and tags.

A page is read as a sequence of words, tags and set-apart parts. Words score positive (words in
links a little), tags negative, and one linear scan finds the run with the highest sum; it is
widened to whole blocks. Set apart are scripts, styles, menus, page headers, footers, sidebars,
notices, adverts, forms and reader comments, known by element, role, class or id; such a part
counts as one negative token and its words are never part of a text. Forms and what class or id
alone tell apart are judged by what they hold: such a part stays in the page if it holds the
one article or main element, or (reader comments excepted) most of the unlinked words of the
article, or of a page that names no article or several. A name that only half tells
(`related-work`) sets nothing apart: words under it weigh `marked`, and the scan decides.

The weights come from labelled pages: those whose markup names one article or main element. A
tag starts at minus the share of its uses outside the labelled part and is corrected wherever
the scan takes too much or too little (structured perceptron, words fixed at 1, those in links
and under half-telling names corrected too). The fit uses `sample` labelled pages, those with the
smallest hashes; the extraction runs over every page with a table of some dozen numbers.

Text: character references decoded, white space (and line breaks) inside a block one space,
blocks in page order joined by a line feed. Nulls: a null page is an empty one and has an empty
text; null ids and urls stay null. Repeated pages are read one by one. Unclosed comments,
scripts and parts run to where their parent ends. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import with_columns

# HTML element names by their role in a page, and words in class names and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
APART = frozenset(
    "nav footer aside form dialog menu button select textarea noscript template svg math canvas object "
    "audio video map head iframe script style title datalist fieldset".split()
)
APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar tablist".split()
)
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot sponsor "
    "sponsored sponsors promo promos promotion banner sidebar sidebars rail widget widgets menu menus "
    "nav navbar navigation topnav breadcrumb breadcrumbs footer masthead topbar cookie cookies "
    "cookiebar consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations comments comment "
    "commentlist respond replies disqus pagination pager toolbar skip hidden copyright form "
    "searchform search".split()
)
#: A name made of these and APART_WORDS tells as much as one of APART_WORDS alone.
LAYOUT_WORDS = frozenset(
    "area articles bar block bottom box btn button buttons center col column container global group icons "
    "inner item items left links list middle outer panel posts primary right row secondary section site "
    "slot stories tertiary top unit wrap wrapper".split()
)
#: What follows one of these in a name says what the page has, not what the element is.
STATE_WORDS = frozenset("has no not with without".split())
READER_WORDS = frozenset("comments comment commentlist respond replies disqus".split())
#: Set apart only if the page is not in them.
APART_IF_SMALL = frozenset("form fieldset".split())
#: Never set apart, whatever they are called: they hold the page or its article.
WHOLE = frozenset("html body main article".split())
#: A second one of these ends the first.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table body html div section article main select nav aside footer form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"']|["'])*?)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'>]+)""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Piece:
    """A run of words (`text`), a tag (`tag`: name or /name) or a set-apart part (`tag`: |)."""

    tag: str | None = None
    text: str = ""
    words: int = 0
    linked: bool = False
    block: int = 0
    labelled: bool = False
    marked: bool = False
    part: int = 0
    opens: int = 0


@dataclass
class Part:
    """A part that its name tells apart, and what it holds. Number 0 is the page."""

    kind: str
    parent: int = 0
    inside: bool = False
    words: int = 0  # not in links
    mains: int = 0
    articles: int = 0


@dataclass
class Weights:
    word: float = 1.0
    link: float = 0.2
    marked: float = -0.2
    other: float = -0.5
    tags: dict[str, float] = field(default_factory=dict)

    def of(self, piece: Piece) -> float:
        if piece.tag is None:
            return piece.words * (self.marked if piece.marked else self.link if piece.linked else self.word)
        return self.tags.get(piece.tag, self.other)


def _named(value: str, in_article: bool) -> str:
    """What a class or id tells: `apart`, `reader` (comments, apart), `marked` or nothing."""
    told = ""
    for name in value.split():
        parts = []
        for x in map(str.lower, _NAME_PART.findall(name)):
            if x in STATE_WORDS:
                break
            parts.append(x)
        telling = [x for x in parts if x in APART_WORDS or (x == "header" and not in_article)]
        if telling and all(x in LAYOUT_WORDS for x in parts if x not in telling):
            return "reader" if READER_WORDS.intersection(telling) else "apart"
        told = told or ("marked" if telling else "")
    return told


def _apart(name: str, attributes: str, in_article: bool) -> str:
    """`always`, or what may depend on what the element holds: `apart`, `reader`, `marked`; or nothing."""
    if name in WHOLE:
        return ""
    if name in APART - APART_IF_SMALL or (name == "header" and not in_article):
        return "always"
    told = {"apart"} if name in APART_IF_SMALL else set()
    for key, value, bare in _ATTRIBUTE.findall(attributes or ""):
        key, value = (key or bare).lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return "always"
        if key == "role" and value.lower() in APART_ROLES:
            if value.lower() != "form":
                return "always"
            told.add("apart")
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "always"
        if key in ("class", "id"):
            told.add(_named(value, in_article))
    return next((x for x in ("reader", "apart", "marked") if x in told), "")


def pieces(page: str) -> list[Piece]:
    """The page as words, tags and set-apart parts, in order."""
    sequence, parts = _read(page)
    return sequence if len(parts) == 1 else _judged(sequence, parts)


def _judged(sequence: list[Piece], parts: list[Part]) -> list[Piece]:
    """The sequence without the parts that stay apart, and with marked words."""
    article = sum(p.words for p in sequence if p.tag is None and p.labelled and not p.linked)
    for p in sequence:
        if p.tag is None and not p.linked:
            parts[p.part].words += p.words
    for part in reversed(parts[1:]):  # a part comes after what it is in
        up = parts[part.parent]
        up.words, up.mains, up.articles = up.words + part.words, up.mains + part.mains, up.articles + part.articles
    whole = parts[0]
    named = whole.mains or whole.articles
    fate = [""]
    for part in parts[1:]:
        if named == 1 and not part.inside:
            stays = (part.mains if whole.mains else part.articles) == 1
        else:
            of = article if part.inside else whole.words
            stays = part.kind != "reader" and 2 * part.words > of
        own = "" if stays else "marked" if part.kind == "marked" else "apart"
        above = fate[part.parent]
        fate.append("apart" if above == "apart" else own or above)
    out = []
    for p in sequence:
        if fate[p.part] == "apart":
            continue
        if p.opens and fate[p.opens] == "apart":
            p.tag = "|"
        p.marked = fate[p.part] == "marked"
        out.append(p)
    return out


def _read(page: str) -> tuple[list[Piece], list[Part]]:
    """The page but for what is always apart, and the parts that are to be judged."""
    out: list[Piece] = []
    parts = [Part("")]
    stack = [("", False, False, False, 0)]  # name, always apart, linked, inside an article, part; a floor
    opened: dict[str, int] = {}  # so that a stray end tag need not be looked for
    block = at = 0

    def say(text: str) -> None:
        _, apart, linked, inside, part = stack[-1]
        if text and not apart:
            if "&" in text:
                text = html.unescape(text)
            out.append(Piece(None, text, len(text.split()), linked, block, inside, part=part))

    def close(n: int) -> None:
        nonlocal block
        for name, *_ in stack[n:]:
            opened[name] -= 1
            block += name not in INLINE
        del stack[n:]

    def topmost(names, stop=frozenset()) -> int | None:
        """The innermost open element of that name, not looked for beyond some others."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stop:
                break
        return None

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if opened.get(name):
                n = topmost((name,))
                _, apart, _, _, part = stack[n]
                close(n)
                if not apart:
                    out.append(Piece("/" + name, block=block, labelled=stack[-1][3], part=part))
            continue
        if name not in INLINE:  # a new block ends an open paragraph
            block += 1
            if opened.get("p") and (n := topmost(("p",), LISTS)):
                close(n)
        if name in SIBLINGS and (n := topmost(SIBLINGS[name], LISTS)):
            close(n)
        _, apart, linked, inside, part = stack[-1]
        told = "" if apart else _apart(name, m[3], inside)
        within, article = part, name in ("article", "main")
        if not apart:
            if told and told != "always":
                parts.append(Part(told, part, inside))
                within = len(parts) - 1
            out.append(Piece("|" if told == "always" else name, block=block, labelled=inside, part=part, opens=within if within != part else 0))
            if name == "br":
                out.append(Piece(None, " ", block=block, labelled=inside, part=part))
            if article and not inside:
                parts[part].mains += name == "main"
                parts[part].articles += name == "article"
        if name in RAW:  # only its own end tag ends it
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not m[3].endswith("/"):
            opened[name] = opened.get(name, 0) + 1
            stack.append((name, apart or told == "always", linked or name == "a", inside or article, within))
    return out, parts


def best_run(sequence: list[Piece], weights: Weights) -> tuple[int, int]:
    """First and end piece of the run with the highest sum; empty where nothing is positive."""
    best = here = 0.0
    lo = 0
    found = (0, 0)
    for i, piece in enumerate(sequence):
        here += weights.of(piece)
        if here > best:
            best, found = here, (lo, i + 1)
        if here <= 0:
            here, lo = 0.0, i + 1
    return found


def text_of(sequence: list[Piece], run: tuple[int, int]) -> str:
    """The words of the run's blocks."""
    lo, hi = run
    if lo >= hi:
        return ""
    first, last = sequence[lo].block, sequence[hi - 1].block
    while lo and sequence[lo - 1].block == first:
        lo -= 1
    while hi < len(sequence) and sequence[hi].block == last:
        hi += 1
    blocks: dict[int, list[str]] = {}
    for p in sequence[lo:hi]:
        if p.tag is None:
            blocks.setdefault(p.block, []).append(p.text)
    return "\n".join(x for b in blocks.values() if (x := " ".join("".join(b).split())))


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    sequence = pieces(page)
    return text_of(sequence, best_run(sequence, weights))


def fit(pages: list[str], rounds: int = 5, step: float = 0.1) -> Weights:
    """Weights under which the scan finds what the markup labels, as far as they can."""
    weights = Weights()
    labelled = []
    for page in pages:
        sequence = pieces(page)
        inside = [i for i, p in enumerate(sequence) if p.labelled and p.words]
        if inside and all(p.labelled or p.tag for p in sequence[inside[0] : inside[-1] + 1] if p.words):
            labelled.append((sequence, inside[0], inside[-1] + 1))
    uses: dict[str, list[int]] = {}
    for sequence, lo, hi in labelled:
        for i, p in enumerate(sequence):
            if p.tag is not None:
                n = uses.setdefault(p.tag, [0, 0])
                n[0] += 1
                n[1] += not lo <= i < hi
    weights.tags = {tag: min(-0.05, -outside / n) for tag, (n, outside) in uses.items()}
    for _ in range(rounds):
        wrong = 0
        for sequence, lo, hi in labelled:
            a, b = best_run(sequence, weights)
            if (a, b) == (lo, hi):
                continue
            wrong += 1
            for i in range(min(a, lo), max(b, hi)):
                change = step * ((lo <= i < hi) - (a <= i < b))
                tag = sequence[i].tag
                if change and tag is not None:
                    weights.tags[tag] = min(-0.01, weights.tags.get(tag, weights.other) + change)
                elif change and sequence[i].marked:
                    weights.marked = min(weights.word, max(-weights.word, weights.marked + change))
                elif change and sequence[i].linked:
                    weights.link = min(weights.word, max(0.01, weights.link + change))
        if not wrong:
            break
    return weights


def labelled_pages(pages: DataFrame, sample: int) -> list[str]:
    """At most `sample` pages with an article or main element: those with the smallest hashes
    of their markup. Only hashes are sorted; then the chosen pages are fetched."""
    marked = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]")).select("html", F.xxhash64("html").alias("hash"))
    edge = marked.select("hash").orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
    if edge is None:
        return []
    return [r["html"] for r in marked.filter(F.col("hash") <= edge).orderBy("hash").limit(sample).collect()]


def main_texts(pages: DataFrame, sample: int = 256) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    weights = fit(labelled_pages(pages, sample))

    def one(batch: pa.RecordBatch) -> dict:
        texts = [main_text(t.as_py(), weights) for t in batch.column(batch.schema.get_field_index("html"))]
        return {"text": texts, "n_chars": list(map(len, texts))}

    return with_columns(pages.select("page_id", "url", "html"), one, "text string, n_chars long", ("html",))
