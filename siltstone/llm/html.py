"""Main text of web pages, by rules on their blocks.

A page is cut into blocks at block-level tags. The first pass decides each block by itself: by the share of its characters that are
links, its length and the density of stop words, and by the part of the page it stands in as evidence, known by its
elements and by whole class names that are taken back where they wrap most of the page. A page without that density over all its text is in a
language that isn't listed: there length and links decide alone. Short blocks and middling ones, and those of few stop words,
stay open. In the second pass they take the label of their nearest decided neighbours, where these agree; where they do not, a
middling block is kept and a short one is left out. Inside the article, which is the `article` with the most text that isn't linked,
open blocks are kept unless both neighbours are out; one that is all link stays only between two good ones, so that lists of links in
it are kept and those at its end aren't. Of other articles those with less than half of its text are out, and on pages without any article
so are cards: siblings of one class that each begin with a short block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import slices, typed

#: Common words of English, German, French, Spanish, Italian, Portuguese, Dutch, Swedish, Polish and Russian prose.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be because been but by can could did do for from had has have he her him his how
i if in into is it its just like more most my no not of on one only or other our out over she so some such than that the
their them then there these they this to up was we were what when which who will with would you your
aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch ein eine einem einen einer eines er es
für hat hatte ich ihm ihr im ist ja kann man mein mich mit nach nicht noch nur oder sein sich sie sind so über um und uns
von vor war was wenn wer wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et être eux il ils je la le les leur lui mais me même mon ne nous
on ont ou où par pas pour plus que qui sa se ses son sont sur ta te tu un une vous y
al como con cuando de del desde donde el ella ellos en entre era es esta este fue ha hay la las le lo los más me mi muy no
nos o para pero por porque que se ser si sin sobre son su sus también te tiene todo un una uno y ya
alla anche che chi ci come con da dal dalla degli dei del della delle di e è gli ha hanno ho i il in io la le lo loro ma mi
nel nella non o per più quando questa questo se si sono sua suo tra un una uno
ao aos as até com como da das de do dos e ela ele em entre era essa esse está eu foi já mais mas me muito na nas não nem no nos
o os ou para pela pelo por quando que se sem ser seu sua também um uma
aan als bij daar dan dat de deze die dit door een en er had heeft het hij ik in is je kan maar me met mijn naar niet nog of om
onder ook op over te tot uit van veel voor want was wat we werd wie wij worden ze zich zijn zo
att av blev de den denna det dig din du efter ej eller en ett från för ha hade han har hon i inte jag kan men med mot när
och om på sig sin som så till under upp ut var vi vid är över
a aby ale bo by być był była było były ci co czy dla do gdy go i ich ja jak jako je jego jej jest już który która które lub ma
mi może na nad nie niż o od po pod przez przy się są ta tak tam te tego tej ten to tu tym w we więc z za ze że
а без бы был была были было быть в вам вас во вот все вы где да для до его ее если есть еще же за и из или им их к как
когда кто ли мне мы на над не него нет ни но о об он она они от по под при с со так там то только у уже что чтобы это я
""".split())

#: Elements without any text of the page, and those whose text is never the article's.
_SILENT = frozenset("script style title noscript template svg math iframe object canvas".split())
_RAW = ("script", "style", "title")  # hold no elements
_OUTSIDE = frozenset("nav footer aside form header menu dialog button select".split())
_MAIN = frozenset(("article", "main"))
_BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody
td textarea tfoot th thead tr ul""".split())
_NESTED = frozenset("""article aside body button details dialog div dl fieldset figure footer form header html li main menu nav ol section
select table tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that may also wrap a whole page.
_WRAPPERS = frozenset("nav form header menu dialog".split())
#: Words that name a part outside the article, where they make up a whole class, id or role with the common words around them.
_PARTS = r"""ad|ads|advert|advertisement|advertising|adbox|adslot|adunit|adsbygoogle|banner|breadcrumbs?|byline-links|footer|header|menu|
    masthead|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo|promoted|recommended|related|share|sharing|
    sidebar|signup|skip|social|sponsor(?:ed)?|subscribe|subscription|tags|toc|toolbar|topbar|widgets?|complementary|contentinfo|search|
    alert|dialog"""
_REMARKS = "comments?|comment-list|respond|responses?|reactions?|replies|disqus"
_CONSENT = "consent|cookies?|gdpr"
_BEFORE = """site|page|main|global|top|bottom|left|right|upper|lower|primary|secondary|mobile|desktop|sticky|fixed|floating|js|blog|post|posts|
    entry|article|story|user|reader|readers|visitor|author|email|inline|block"""
_AFTER = """container|wrapper|wrap|outer|inner|box|bar|area|block|section|panel|row|group|list|items?|links?|buttons?|icons?|form|message|
    overlay|content|text|title|posts?|articles?|stories|thread|top|bottom|left|right|main|primary|secondary|policy|unit|slot|label|[0-9]+"""


def _named(words: str) -> re.Pattern[str]:
    return re.compile(rf"(?:(?:{_BEFORE})[_-]+)*(?:{words})(?:[_-]+(?:{_PARTS}|{_REMARKS}|{_CONSENT}|{_AFTER}))*", re.I | re.X)


_HEADING = re.compile(r"\bheader\b", re.I)
_NAMED, _COMMENTS, _NOTICE = _named(_PARTS), _named(_REMARKS), _named(_CONSENT)
#: Quoted values are read in whole; where one with tags in it ends inside a word, its closing quote is missing and `>` ends the tag.
_ENDED = r"""(?=[\s/>]|[a-z][a-z-]*+=["'])"""
_ATTRS = rf"""(?:[^>=]++|=\s*+(?:"[^"<>]*+"|"[^"]*+"{_ENDED}|'[^'<>]*+'|'[^']*+'{_ENDED}|[^\s>"'][^\s>]*+)|=)*+"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z) | <(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<attrs>{_ATTRS}(?=>)|[^>]*+)> | <[!?/][^>]*+>""", re.I | re.S | re.X)
_CLASS = re.compile(r"""(?<![^\s"'])class\s*=\s*(?:"([^"]+)"|'([^']+)'|([^\s>"']+))""", re.I)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_QUIET = re.compile(rf"<!--|<(/?)({'|'.join(sorted(_SILENT))})(?=[\s/>])", re.I)
_CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in _RAW}
_BLOCK = re.compile(rf"""(?<!["'`])</?(?:{'|'.join(sorted(_BLOCKS))})(?=[\s/>])""", re.I)
_NEXT_SCRIPT = re.compile(r"<body[\s>].*?<script[\s>]", re.I | re.S)

#: How a call to subscribe begins, in the languages that its words are known of.
_CALL = re.compile(r"""(?:please\s+)?(?:sign\s+up|subscribe|register|join\s+us|abonnieren|melden\s+sie\s+sich|jetzt\s+anmelden|abonnez-vous|inscrivez-vous|suscr[ií]be(?:te|se)|
    ap[uú]nt(?:ate|ese)|inscr[ií]bete)\b.{0,120}?\b(?:newsletters?|mailing\s+list|inbox|updates|rundbrief|lettre|bolet[ií]n|correo)\b""", re.I | re.S | re.X)

_SHORT, _LONG = 70, 200
_SOME, _MANY = 0.15, 0.25  # of the words are stop words
_LINKS = 0.33
#: Scripts that write a word in a few characters, without spaces; such a character counts as three.
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class Block:
    """`named` are the numbers of named parts around it, `articles` those of articles, `cards` (kind, number) of elements that have a class.

    `frame` is set for what stands in `main` beside the articles there.
    """

    __slots__ = ("text", "linked", "zone", "named", "articles", "cards", "heading", "code", "frame", "label")

    def __init__(self, text: str, linked: int, zone: str, named: tuple = (), articles: tuple = (), cards: tuple = (), heading=False, code=False):
        self.text, self.linked, self.zone, self.named, self.articles, self.cards = text, linked, zone, named, articles, cards
        self.heading, self.code, self.frame, self.label = heading, code, False, ""

    @property
    def plain(self) -> int:
        """Characters that aren't linked."""
        return max(len(self.text) - self.linked, 0)

    @property
    def is_link(self) -> bool:
        return self.linked > 0.9 * len(self.text) and len(self.text) > 1 and len(self.text.split()) < 12


def _zone(name: str, attrs: str) -> tuple[str, bool, bool]:
    """`out`, `comments` or `main` if the element opens such a part of the page; whether it is named as a part outside the article, which
    holds unless most of the page stands in it; and whether it is so named as a heading alone."""
    zone, parts, plain = "main" if name in _MAIN else "", name in _WRAPPERS, name == "header"
    if attrs.strip(" /"):
        for key, a, b, c in _ATTR.findall(attrs):
            key, value = key.lower(), a or b or c
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return "out", False, False
            if key == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    return "out", False, False
            elif name not in ("body", "html", "main"):
                for word in value.split() if key in ("class", "id", "role") else ():
                    if _COMMENTS.fullmatch(word):
                        return "comments", False, False
                    if _NOTICE.fullmatch(word):
                        return "out", False, False
                    if _NAMED.fullmatch(word):
                        plain = bool(_HEADING.search(word)) and (plain or not parts)
                        parts = True
                if key == "role" and value.lower() in ("main", "article"):
                    zone = "main"
    if name in _OUTSIDE and name not in _WRAPPERS:
        return "out", False, False
    return zone, parts, plain


def _silent_ends(html: str) -> dict[int, int]:
    """Where each silent element ends, by where it starts. One that is never closed has no end here."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    closings: dict[str, re.Match[str] | None] = {}
    at = 0
    while m := _QUIET.search(html, at):
        at = m.end()
        if not m[2]:
            end = html.find("-->", at)
            at = end + 3 if end >= 0 else len(html)
            continue
        tag, name = _TOKEN.match(html, m.start()), m[2].lower()
        if not tag:
            continue
        at = tag.end()
        if m[1]:
            if opened.get(name):
                ends[opened[name].pop()] = at
        elif tag["attrs"].endswith("/"):
            continue
        elif name not in _RAW:
            opened.setdefault(name, []).append(m.start())
        else:
            if name not in closings or closings[name] and closings[name].start() < at:
                closings[name] = _CLOSING[name].search(html, at)
            closing = closings[name]
            if closing and not (_NEXT_SCRIPT if name == "script" else _BLOCK).search(html, at, closing.start()):
                ends[m.start()] = at = closing.end()
    return ends


def blocks_of(html: str) -> list[Block]:
    """The page's blocks in order, each with the part of the page it stands in."""
    found: list[Block] = []
    # Open elements that nest, with the part that holds inside, and the named ones, articles and cards around.
    stack: list[tuple[str, str, tuple, tuple, tuple]] = []
    outside = ("", (), (), ())
    names = 0
    texts: list[tuple[str, bool]] = []
    link = heading = code = breaks = 0

    def end() -> None:
        nonlocal texts, link, breaks
        if texts:
            joined = " ".join(unescape("".join(t for t, _ in texts)).split())
            if joined:
                linked = len(" ".join(unescape(" ".join(t for t, a in texts if a)).split()))
                found.append(Block(joined, linked, *(stack[-1][1:] if stack else outside), bool(heading), bool(code)))
        texts, link, breaks = [], 0, 0

    at, ends = 0, None
    while m := _TOKEN.search(html, at):
        if m.start() > at:
            piece = html[at:m.start()]
            texts.append((piece, bool(link)))
            if not piece.isspace():
                breaks = 0
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in _SILENT:
            if name == "title":
                end()
            if not m["close"] and not m["attrs"].endswith("/"):
                ends = _silent_ends(html) if ends is None else ends
                if m.start() in ends:
                    at = ends[m.start()]
                else:  # never closed
                    following = _BLOCK.search(html, at)
                    at = following.start() if following else len(html)
            continue
        if name == "a":
            link = 0 if m["close"] else 1
        elif name == "br":
            breaks += 1
            if breaks > 1:
                end()
            else:
                texts.append((" ", False))
        elif name in _BLOCKS:
            end()
            if name[0] == "h" and name[1:].isdigit():
                heading = 0 if m["close"] else 1
            elif not m["close"]:
                heading = 0
            if name == "pre":
                code = 0 if m["close"] else 1
            if name in _NESTED:
                if m["close"]:
                    if any(x[0] == name for x in stack):
                        while stack.pop()[0] != name:
                            pass
                elif not m["attrs"].endswith("/"):
                    (own, parts, plain), (around, named, articles, cards) = _zone(name, m["attrs"]), stack[-1][1:] if stack else outside
                    if own == "main" and not parts and (around == "out" or named and around != "comments"):  # a part that was never closed
                        while stack and (stack[-1][1] == "out" or stack[-1][2]):
                            stack.pop()
                        around, named, articles, cards = stack[-1][1:] if stack else outside
                    names += 1
                    if parts and not (around == "main" and plain):  # the article's own heading isn't one
                        named += (names,)
                    if name == "article":
                        articles += (names,)
                    if kind := _CLASS.search(m["attrs"]):
                        cards += (((cards[-1][1] if cards else 0, name, kind[1] or kind[2] or kind[3]), names),)
                    stack.append((name, around if around in ("out", "comments") else own or around, named, articles, cards))
        elif not m["close"] and name not in _VOID and m["attrs"].strip(" /"):
            own, parts, _ = _zone(name, m["attrs"])
            if own == "out" or parts:
                end()
                around, named, *others = stack[-1][1:] if stack else outside
                names += 1
                stack.append((name, "out" if own == "out" else around, (*named, names) if parts else named, *others))
        elif m["close"] and stack and stack[-1][0] == name:
            end()
            stack.pop()
    if at < len(html):
        texts.append((html[at:], bool(link)))
    end()
    return found


def _leave_wrappers(blocks: list[Block]) -> None:
    """A named part with more than half of the page's text that isn't linked, or of its article's, is a wrapper: its name counts for nothing."""
    for inside in (False, True):
        held: dict[int, int] = {}
        whole = 0
        for b in blocks:
            if b.zone == "main" or not inside and b.zone == "":
                whole += b.plain
                for k in b.named:
                    held[k] = held.get(k, 0) + b.plain
        wrappers = {k for k, size in held.items() if 2 * size > whole}
        for b in blocks:
            b.named = tuple(k for k in b.named if k not in wrappers)


def _leave_other_articles(blocks: list[Block]) -> None:
    """Of several articles, apart or one in another, those with less than half of the largest one's text that isn't linked are out."""
    held: dict[tuple, int] = {}
    for b in blocks:
        if b.zone == "main" and b.articles and not b.named:
            held[b.articles] = held.get(b.articles, 0) + b.plain
    most = max(held.values(), default=0)
    for b in blocks:
        if b.zone == "main" and b.articles and 2 * held.get(b.articles, 0) < most:
            # An article whose text lies in the articles inside it is their frame.
            if not any(len(k) > len(b.articles) and k[:len(b.articles)] == b.articles and 2 * n >= most for k, n in held.items()):
                b.zone = "out"
    inside = any(b.zone == "main" and b.articles for b in blocks)
    for b in blocks:
        b.frame = inside and b.zone == "main" and not b.articles


def _leave_cards(blocks: list[Block]) -> None:
    """Siblings of one class, two or more, that each begin with a short block before others are no prose, unless most of the page is made of them."""
    members: dict[tuple, dict[int, list[Block]]] = {}
    for b in blocks:
        for kind, number in b.cards:
            members.setdefault(kind, {}).setdefault(number, []).append(b)
    whole = sum(b.plain for b in blocks if not b.zone)
    for group in members.values():
        if len(group) > 1 and all(len(own) > 1 and len(own[0].text) < _SHORT and not own[0].heading for own in group.values()):
            if 2 * sum(b.plain for own in group.values() for b in own if not b.zone) <= whole:
                for own in group.values():
                    for b in own:
                        b.zone = b.zone or "out"


def classify(blocks: list[Block]) -> None:
    """Labels every block `good` or `bad`. Names count for nothing if they would leave no block."""
    _leave_wrappers(blocks)
    _leave_other_articles(blocks)
    if not any(b.zone == "main" for b in blocks):
        _leave_cards(blocks)
    if not _label(blocks) and any(b.named for b in blocks):
        for b in blocks:
            b.named = ()
        _label(blocks)


def _measured(b: Block) -> tuple[int, float]:
    """The block's length, and the share of its words that are stop words."""
    words = b.text.lower().split()
    return len(b.text) + 2 * len(_DENSE.findall(b.text)), sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)


def _is_listed(measured: list[tuple[int, float]]) -> bool:
    """Whether blocks have the density of prose over all their text; where they fall short of it, their language isn't listed."""
    prose = [x for x in measured if x[0] >= _SHORT]
    return sum(size * stops for size, stops in prose) >= _SOME * sum(size for size, _ in prose)


def _label_article(main: list[Block]) -> None:
    """The first pass inside the article, where a block is taken for prose unless something tells against it."""
    measured = [_measured(b) for b in main]
    listed = _is_listed(measured)
    for b, (size, stops) in zip(main, measured):
        if b.named or size < _LONG and _CALL.match(b.text):
            b.label = "bad"
        elif b.is_link:
            b.label = "link"
        elif size < _SHORT:
            b.label = "short"
        else:
            b.label = "good" if stops >= _SOME or size > _LONG or not listed else "near"


def _label(blocks: list[Block]) -> bool:
    """Labels every block; whether any is good."""
    main = [b for b in blocks if b.zone == "main"]
    _label_article(main)
    if any(b.label not in ("bad", "link") for b in main):
        for b in blocks:
            b.label = b.label if b.zone == "main" else "bad"
        _settle(main)
        if any(b.label == "good" for b in main):
            return True
    loose = [b for b in blocks if not b.zone and not b.named and b.linked <= _LINKS * len(b.text)]
    measured = {id(b): _measured(b) for b in loose}
    listed = _is_listed(list(measured.values()))
    for b in blocks:  # first pass: each by itself
        if id(b) not in measured or len(b.text) < _LONG and ("©" in b.text or _CALL.match(b.text)):
            b.label = "bad"
            continue
        size, stops = measured[id(b)]
        if size < _SHORT:
            b.label = "near" if b.code else "bad" if b.linked else "short"
        elif size > _LONG and (stops >= _MANY or not listed):
            b.label = "good"
        else:
            b.label = "near" if stops >= _SOME or size > _LONG or b.code or not listed else "few"
    if not any(b.label == "good" for b in blocks):  # a page of middling blocks is judged by these
        for b in blocks:
            b.label = "good" if b.label == "near" else b.label
    _settle(blocks)
    return any(b.label == "good" for b in blocks)


def _settle(blocks: list[Block]) -> None:
    """The second pass: open blocks follow their neighbours; `blocks` are the article's alone, or the whole page's."""
    decided = [b.label if b.label in ("good", "bad") else "" for b in blocks]
    near = [b.label == "near" for b in blocks]

    def neighbours(step: int) -> list[tuple[str, bool]]:
        """The nearest decided label on one side, and whether a middling block is nearer."""
        held, out = ("", False), [("", False)] * len(blocks)
        for i in range(len(blocks))[::step]:
            out[i] = held
            if decided[i]:
                held = decided[i], False
            elif near[i]:
                held = held[0], True
        return out

    if any(b.label == "link" for b in blocks):  # links of the article, by what they stand between
        prose = [i for i, b in enumerate(blocks) if b.label in ("good", "near") and not b.heading] or [0]
        for i, b in enumerate(blocks):
            if b.label == "link":
                b.label = decided[i] = "good" if prose[0] < i < prose[-1] else "bad"
        only_links = False  # whether there is nothing but left-out links from here to the next heading
        for i in range(len(blocks) - 1, -1, -1):
            b = blocks[i]
            if not b.heading:
                following = i + 1 < len(blocks) and not blocks[i + 1].heading
                only_links = b.is_link and b.label == "bad" and not b.named and (only_links or not following)
            elif only_links and i + 1 < len(blocks) and not blocks[i + 1].heading:  # goes with the links under it
                b.label = decided[i] = "bad"
    for i, (b, (left, left_near), (right, right_near)) in enumerate(zip(blocks, neighbours(1), neighbours(-1))):
        if decided[i]:
            continue
        if b.zone == "main":
            b.label = "bad" if left == right == "bad" or b.frame and right != "good" else "good"
        elif b.label == "near":
            b.label = "good" if "good" in (left, right) or not (left or right) else "bad"
        elif left == right == "good":
            b.label = "good"
        elif b.label == "few":
            b.label = "bad"
        else:
            close = right == "good" or right_near if b.heading else left_near and left == "good" or right_near and right == "good"
            b.label = "good" if close else "bad"


def main_text(html: str) -> str:
    """The page's article: its blocks in page order with an empty line between; empty if there is none."""
    blocks = blocks_of(html)
    classify(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == "good")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            texts = [main_text(h.as_py()) if h.is_valid else "" for h in part.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), part.column(1)], ["main", "own_row"])


def extract(pages: DataFrame) -> DataFrame:
    """The columns of `pages` (html and anything else) without html, then text: the main text of the whole page.

    White space inside a block is one space, character references are decoded, nothing else is changed, left out or cut. A
    null or empty page, and one without an article, has an empty text. Repeated rows are treated alike. A column of the
    name `text` is replaced; an empty table gives an empty result.
    """
    columns = [c for c in pages.columns if c not in ("html", "text")]
    rows = pages.select(F.col("html").alias("own_html"), F.struct(F.lit(0).alias("_"), *columns).alias("own_row"))
    kind = rows.schema["own_row"].dataType
    found = rows.mapInArrow(_extract, typed(main="string", own_row=kind))
    return found.select(*[F.col("own_row").getField(c).alias(c) for c in columns], F.col("main").alias("text"))
