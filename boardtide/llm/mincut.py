"""Main text of a web page by a minimum cut over its text blocks.

A page is cut into blocks of text at block-level tags.  A fixed linear classifier turns the markup
around a block into two costs, for calling it content and for calling it boilerplate; these are
the capacities to the two terminals.  Blocks that follow each other, and blocks under the same
parent, are tied by smoothness edges.  The minimum cut gives the labelling of least total cost.
"""

import math
import re
from collections import deque
from html.parser import HTMLParser

from boardtide.llm.common import map_batches

# --- fixed values: HTML's own element kinds and usual names of page parts ---
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style noscript template title head textarea select option button iframe svg canvas "
    "audio video datalist".split())
#: A head that is not closed ends where anything else begins.
HEAD_TAGS = frozenset("html head base link meta title style script noscript template".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs byline-share comment comments "
    "cookie cookies consent disclaimer disqus footer header login masthead menu modal nav navbar "
    "navigation newsletter notice notices pagination popup promo promoted related reply replies "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar "
    "topbar widget".split())
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CONTENT_NAMES = frozenset(
    "article articlebody content entry main maincontent post postbody story storybody body".split())
#: A p ends where one of these begins; li, dt, dd, tr, td, th and option end their own kind.
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

CHAIN, SIBLING = 0.35, 0.25      # smoothness of neighbours and of blocks under one parent
_NAME = re.compile(r"[A-Za-z]+")


class _Blocks(HTMLParser):
    """Collects (text, linked characters, evidence, parent number) per block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = []           # (tag, evidence, number)
        self.made, self.blocks, self.parts, self.linked = 0, [], [], 0

    def evidence(self, tag, attrs):
        """+1 content, -1 boilerplate, 0 neither; what is nearest to the text counts."""
        named = dict(attrs)
        names = set()
        for key in ("class", "id"):
            for word in (named.get(key) or "").lower().split():
                names.update([word, *_NAME.findall(word)])
        inside = any(e > 0 for _, e, _ in self.open)
        hidden = "hidden" in named or (named.get("aria-hidden") or "") == "true"
        if tag in BOILER_TAGS or hidden or (named.get("role") or "").lower() in BOILER_ROLES:
            return -1
        if tag == "header":
            return 0 if inside else -1
        if tag in ("body", "html"):
            return 0
        if tag in CONTENT_TAGS and not names & BOILER_NAMES:
            return -1 if any(e < 0 for _, e, _ in self.open) else 1
        if names & BOILER_NAMES:
            return -1
        return 1 if names & CONTENT_NAMES else 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            sign = next((e for _, e, _ in reversed(self.open) if e < 0), 0) or next(
                (e for _, e, _ in reversed(self.open) if e), 0)
            holders = [o for o in self.open if o[0] in BLOCK_TAGS]
            tag = holders[-1][0] if holders else ""
            parent = holders[-2][2] if len(holders) > 1 else -1
            self.blocks.append((text, self.linked, sign, tag, parent))
        self.parts, self.linked = [], 0

    def close_to(self, depth):
        del self.open[depth:]

    def end_head(self):
        if self.open and self.open[-1][0] == "head":
            self.open.pop()

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self.end_head()
        if tag in BLOCK_TAGS:
            self.flush()
            ends = OWN_KIND.get(tag, ()) if tag in OWN_KIND else ("p",)
            for depth in range(len(self.open) - 1, -1, -1):
                held = self.open[depth][0]
                if held in ends:
                    self.close_to(depth)
                    break
                if held in BLOCK_TAGS and held not in ("p",):
                    break
        if tag in VOID_TAGS:
            if tag == "br":
                self.parts.append(" ")
            return
        self.made += 1
        self.open.append((tag, self.evidence(tag, attrs), self.made))

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self.close_to(depth)
                return
            # an inline end tag does not close a block around it
            if tag not in BLOCK_TAGS and tag not in UNSEEN and self.open[depth][0] in BLOCK_TAGS:
                return

    def handle_data(self, data):
        if data.strip():
            self.end_head()
        tags = {o[0] for o in self.open}
        if tags & UNSEEN:
            return
        self.parts.append(data)
        if "a" in tags:
            self.linked += len(data.strip())


def blocks_of(html):
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def odds(block, has_content):
    """Log odds of content.  `has_content`: the page marks some part as its content."""
    text, linked, sign, tag, _ = block
    words = text.count(" ") + 1
    links = min(1.0, linked / max(1, len(text)))
    z = 0.4 + 0.5 * min(2.0, math.log(words + 1) / 2) - 3.0 * links * (sign <= 0)
    z += 6.0 * sign
    if sign == 0 and has_content:
        z -= 5.0
    return z + (0.5 if tag in ("p", "h1", "h2", "h3", "blockquote", "pre") else 0.0)


def min_cut(to_source, to_sink, edges):
    """For each node whether it stays with the source, by shortest augmenting paths in phases.

    Terminal capacities first cancel at each node, so flow is only sought between nodes whose
    costs disagree.
    """
    n = len(to_source)
    s, t = n, n + 1
    graph = [[] for _ in range(n + 2)]
    head, room = [], []

    def link(a, b, forth, back):
        graph[a].append(len(head))
        head.append(b)
        room.append(forth)
        graph[b].append(len(head))
        head.append(a)
        room.append(back)

    for i, (a, b) in enumerate(zip(to_source, to_sink, strict=True)):
        if a > b:
            link(s, i, a - b, 0.0)
        elif b > a:
            link(i, t, b - a, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        line = deque([s])
        while line:
            x = line.popleft()
            for e in graph[x]:
                if room[e] > 1e-9 and level[head[e]] < 0:
                    level[head[e]] = level[x] + 1
                    line.append(head[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        at, path, x = [0] * (n + 2), [], s
        while True:
            if x == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                x = head[path[first] ^ 1]
                del path[first:]
                continue
            while at[x] < len(graph[x]):
                e = graph[x][at[x]]
                if room[e] > 1e-9 and level[head[e]] == level[x] + 1:
                    break
                at[x] += 1
            if at[x] < len(graph[x]):
                path.append(graph[x][at[x]])
                x = head[path[-1]]
            elif path:
                x = head[path.pop() ^ 1]
                at[x] += 1
            else:
                break


def main_text(html):
    """The content blocks of a page, one per line.  Null and empty pages give the empty string."""
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    has_content = any(b[2] > 0 for b in blocks)
    z = [odds(b, has_content) for b in blocks]
    edges, last = [], {}
    for i, b in enumerate(blocks):
        # ties bind only blocks whose markup says the same
        if i and blocks[i - 1][2] == b[2]:
            edges.append((i - 1, i, CHAIN))
        j = last.get((b[4], b[2]))
        if j is not None:
            edges.append((j, i, SIBLING))
        last[b[4], b[2]] = i
    stays = min_cut([math.log1p(math.exp(x)) for x in z], [math.log1p(math.exp(-x)) for x in z], edges)
    return "\n".join(b[0] for b, content in zip(blocks, stays, strict=True) if content)


def extract(spark, pages):
    """page_id, url, text, n_chars per page; repeated rows give repeated results, nulls in
    page_id or url stay null, an empty table gives no rows."""
    def run(batch):
        texts = [main_text(h) for h in batch["html"]]
        return {"page_id": batch["page_id"], "url": batch["url"], "text": texts,
                "n_chars": [len(t) for t in texts]}

    kind = dict(pages.dtypes)["page_id"]
    return map_batches(pages.select("page_id", "url", "html"), run,
                       f"page_id {kind}, url string, text string, n_chars bigint", 64)
