"""Main text of web pages by tag-path ratios.

A page becomes text nodes, each under its root-to-leaf tag path. Per path the
text length, link-text length, punctuation and number of nodes are added up;
the text-to-node ratio and the punctuation ratio are smoothed over the paths in
page order, fused, and held against a threshold that the page itself sets. A
block is content if its path passes, or if it lies in the element that holds
most of the passing text and is not boilerplate by its own markup.

Elements whose tag, role, class or id say nothing but menu, header, footer,
sidebar, notice, advert, share bar or reader comments never give content, nor
do scripts, styles, templates, the head, comments or hidden elements. A name in
which such a word stands among others (``social-science-article``,
``widget-container``), and a form, is evidence only: the element is left out
unless it holds the page's article or main element, or hardly any text is left
without it; names that negate or describe the layout (``has-sidebar``,
``no-comments``, ``ad-free``) say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from timeloom.llm.common import arrow_slices

# HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template iframe object svg canvas math select textarea button "
                    "nav footer aside menu dialog audio video map datalist fieldset label option".split())
RAW = frozenset(["script", "style"])
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
#: A start tag that ends an open one of these, up to the nearest of the stops.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("caption dd dt html body li option optgroup tbody td tfoot th thead tr legend summary title".split())
#: Words of class, id or role that mark an element as not the article's.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments commentlist cookie cookies "
    "consent disqus footer form header masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promoted promotion related respond share sharing sidebar social sponsor "
    "sponsored subscribe subscription toolbar widget complementary contentinfo search alert alerts gdpr discussion "
    "replies outbrain taboola recommended signup login".split())
#: Words that do not change what a boilerplate word beside them says.
STRUCTURAL = frozenset("list section area box wrapper wrap container block inner outer site page global top bottom left right "
                       "primary secondary main item items slot unit region zone bar button link links row col column panel inline float fixed "
                       "sticky small large big mobile desktop".split())
#: Words that turn a boilerplate word beside them into a remark on the layout.
LAYOUT = frozenset("has no with without not free hide hides show shows is".split())
#: Words beside which "header" means the article's heading.
OF_ARTICLE = frozenset("article content entry post story".split())
KEEPS = frozenset(["main", "body", "html"])
PUNCTUATION = frozenset(".,;:!?…。，！？；：、")
#: Share of the page's text below which what is left without a suspect element is too little.
LITTLE = 0.1
#: Consecutive blocks of links alone that make a menu.
MENU = 3
WEIGHT_PUNCTUATION = 0.5
THRESHOLD = 0.2


class Node:
    """One block: its tag path, the container it lies in, text and ratios."""
    __slots__ = ("path", "parts", "link", "boxes", "marks")

    def __init__(self, path, boxes, marks):
        self.path, self.boxes, self.marks, self.parts, self.link = path, boxes, marks, [], 0


def _reader():
    """The page reader's class (html.parser is imported in the task)."""
    import re
    from html.parser import HTMLParser

    words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            # tag, skipped from here, element number, numbers of the suspect elements around
            self.open: list[tuple[str, bool, int, tuple]] = []
            self.count, self.now, self.nodes, self.cleared = 0, None, [], set()

        def _judge(self, tag, attrs):
            """0: nothing, 1: suspect, 2: never content."""
            if tag in SKIPPED:
                return 2
            if tag == "header" and not any(o[0] in ("article", "main") for o in self.open):
                return 2
            if tag in KEEPS:
                return 0
            worst = int(tag == "form")
            for name, value in attrs:
                if name in ("class", "id", "role") and value:
                    own = {w.lower() for w in words.findall(value)}
                    heading = bool(own & OF_ARTICLE) or any(o[0] in ("article", "main") for o in self.open)
                    for token in value.split():
                        found = {w.lower() for w in words.findall(token)}
                        if heading:
                            found.discard("header")  # the article's own heading
                        if not BOILERPLATE.isdisjoint(found) and LAYOUT.isdisjoint(found):
                            worst = max(worst, 2 if found <= BOILERPLATE | STRUCTURAL else 1)
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    return 2
                elif name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                    return 2
            return worst

        def _close_to(self, at):
            del self.open[at:]
            self.now = None

        def handle_starttag(self, tag, attrs):
            if tag in ("html", "body") and any(o[0] == tag for o in self.open):
                return
            if tag == "body":  # a head left open ends here
                for i, o in enumerate(self.open):
                    if o[0] == "head":
                        self._close_to(i)
                        break
            if tag in ENDS_P:
                for i in range(len(self.open) - 1, -1, -1):
                    if self.open[i][0] == "p":
                        self._close_to(i)
                        break
                    if self.open[i][0] in BLOCK:
                        break
            if tag in CLOSES:
                ends, stops = CLOSES[tag]
                for i in range(len(self.open) - 1, -1, -1):
                    if self.open[i][0] in ends:
                        self._close_to(i)
                        break
                    if self.open[i][0] in stops:
                        break
            if tag in BLOCK:
                self.now = None
            if tag == "br":
                self.handle_data(" ")
            if tag in VOID:
                return
            self.count += 1
            skipped, marks = (self.open[-1][1], self.open[-1][3]) if self.open else (False, ())
            judged = 2 if skipped else self._judge(tag, attrs)
            if judged < 2 and tag in ("article", "main"):
                self.cleared.update(marks)
            self.open.append((tag, judged == 2, self.count, (*marks, self.count) if judged == 1 else marks))

        def handle_startendtag(self, tag, attrs):
            # the slash means nothing on an element of HTML that may have content
            self.handle_starttag(tag, attrs)

        def handle_endtag(self, tag):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    if tag in BLOCK:
                        self._close_to(i)
                    else:
                        if not any(o[0] in BLOCK for o in self.open[i + 1:]):
                            del self.open[i:]
                    return
                if tag not in BLOCK and self.open[i][0] in BLOCK:
                    return  # an inline end tag reaches no further than its block

        def handle_data(self, data):
            if self.open and self.open[-1][1]:
                return
            if self.now is None:
                if not data.strip():
                    return
                path = tuple(o[0] for o in self.open if o[0] in BLOCK)
                boxes = tuple((o[2], o[0]) for o in self.open if o[0] in BLOCK and o[0] != "p")
                self.now = Node(path, boxes, self.open[-1][3] if self.open else ())
                self.nodes.append(self.now)
            self.now.parts.append(data)
            if any(o[0] == "a" for o in self.open):
                self.now.link += len(data)

        def unknown_decl(self, data):
            pass

    return Reader


def content_blocks(nodes: list[tuple[tuple, tuple, str, int]]) -> list[str]:
    """Blocks that tag-path ratios call content, in page order.

    ``nodes`` are (tag path, containers, text, link characters)."""
    if not nodes:
        return []
    order: dict[tuple, list[float]] = {}
    for path, _, text, link in nodes:
        s = order.setdefault(path, [0, 0, 0])
        s[0] += max(len(text) - link, 0)
        s[1] += sum(map(text.count, PUNCTUATION))
        s[2] += 1
    raw = [(s[0] / s[2], s[1] / s[2]) for s in order.values()]

    def smoothed(i, k):
        near = [(raw[j][k], 2 if j == i else 1) for j in (i - 1, i, i + 1) if 0 <= j < len(raw)]
        return sum(v * w for v, w in near) / sum(w for _, w in near)

    fused = [smoothed(i, 0) * (1 + WEIGHT_PUNCTUATION * smoothed(i, 1)) if raw[i][0] else 0.0 for i in range(len(raw))]
    limit = THRESHOLD * max(fused)
    passing = {p for p, f in zip(order, fused, strict=True) if f >= limit and f > 0}
    # the innermost container that still holds nine tenths of the passing text;
    # an article element around it is the article as a whole
    held: dict[tuple[int, str], int] = {}
    total = 0
    for path, boxes, text, _ in nodes:
        if path in passing:
            total += len(text)
            for b in boxes:
                held[b] = held.get(b, 0) + len(text)
    main = max((b for b, n in held.items() if n >= 0.9 * total), default=None)
    if main is None:
        return [text for path, _, text, _ in nodes if path in passing]
    around = next(boxes[:boxes.index(main) + 1] for _, boxes, _, _ in nodes if main in boxes)
    main = next((b for b in around if b[1] == "article"), next((b for b in around if b[1] == "main"), main))
    inside = [i for i, n in enumerate(nodes) if main in n[1]]
    title = [i for i, n in enumerate(nodes[:inside[0]]) if n[0][-1:] == ("h1",)][-1:]
    linked = [nodes[i][3] >= 0.8 * len(nodes[i][2]) for i in inside]
    in_menu = set()  # blocks of links alone, several in a row
    for k in range(len(inside) - MENU + 1):
        if all(linked[k:k + MENU]):
            in_menu.update(inside[k:k + MENU])
    return [nodes[i][2] for i in title + inside if nodes[i][0] in passing or i not in in_menu]


def visible(nodes: list, cleared: set) -> list:
    """The blocks outside all suspect elements. Those in ``cleared`` are not
    suspect; while next to nothing is left, the outermost suspect element that
    hides the most text is cleared too."""
    cleared = set(cleared)
    total = sum(len(t) for _, t in nodes)
    while True:
        left, hidden = [], {}
        for n, text in nodes:
            mark = next((m for m in n.marks if m not in cleared), None)
            if mark is None:
                left.append((n, text))
            else:
                hidden[mark] = hidden.get(mark, 0) + len(text)
        if not hidden or sum(len(t) for _, t in left) >= LITTLE * total:
            return left
        cleared.add(max(hidden, key=lambda m: (hidden[m], -m)))


def extract_text(html: str) -> str:
    """Main text of one page: blocks joined by one line feed."""
    if not _READER:
        _READER.append(_reader())
    r = _READER[0]()
    r.feed(html)
    r.close()
    nodes = [(n, text) for n in r.nodes if (text := " ".join("".join(n.parts).split()))]
    return "\n".join(content_blocks([(n.path, n.boxes, text, n.link) for n, text in visible(nodes, r.cleared)]))


_READER: list = []


def extract(df: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """One row per row of ``df``: the id columns and ``text``.

    A null or empty page, or one without content, gives an empty text. Repeated
    rows stay, extra columns are left out, an empty table gives an empty one.
    Pages are read one at a time without a shuffle; nothing is cut or capped."""
    schema = T.StructType([df.schema[c] for c in id_cols] + [T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in arrow_slices(batches, len(id_cols)):
            texts = [extract_text(h.as_py() or "") for h in batch.column(len(id_cols))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[f.name for f in schema])

    return df.select(*id_cols, html_col).mapInArrow(run, schema)
