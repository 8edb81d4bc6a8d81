"""Pages as trees: a small parser, CSS selection, embedded JSON, and extraction of article fields by rules.

Used inside Arrow functions only; nothing here runs per row outside a batch.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style"}


class Node:
    """An element with its children, which are elements and strings."""

    __slots__ = ("tag", "attrs", "children", "parent", "index")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None = None) -> None:
        self.tag, self.attrs, self.children, self.parent, self.index = tag, attrs, [], parent, None

    def named(self, kind: str, name: str) -> list[tuple[int, Node]]:
        """Elements below by tag (kind 't'), class ('.') or id ('#'), with their place in the document; the tree is walked once."""
        if self.index is None:
            self.index = {}
            for i, n in enumerate(self.walk()):
                keys = {("t", n.tag), ("t", "*"), ("#", n.attrs.get("id", "")), *((".", c) for c in n.attrs.get("class", "").split())}
                for k in keys:
                    self.index.setdefault(k, []).append((i, n))
        return self.index.get((kind, name), [])

    def walk(self):
        """Elements below in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def text(self) -> str:
        """All text below but scripts and styles, white space collapsed."""
        out, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag not in RAW:
                if c.tag == "br":
                    out.append(" ")
                stack += list(reversed(c.children))
        return re.sub(r"\s+", " ", "".join(out)).strip()

    def raw(self) -> str:
        return "".join(c for c in self.children if isinstance(c, str))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {})

    def handle_starttag(self, tag, attrs):
        if tag == "p":  # a paragraph ends the one before
            n = self.at
            while n.parent is not None and n.tag not in {"div", "article", "section", "body", "li", "td"}:
                if n.tag == "p":
                    self.at = n.parent
                    break
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)

    def handle_comment(self, data):
        self.at.children.append(Node("!--", {"text": data.strip()}, self.at))


def parse(html: str | None) -> Node:
    """The tree of a page; unclosed elements end with their parents, whatever else is wrong is kept as it comes."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


@lru_cache(maxsize=4096)
def _compiled(selector: str) -> tuple:
    out = []
    for one in re.findall(r"[^,\[\]]*(?:\[[^\]]*\][^,\[\]]*)*", selector):
        if not one.strip():
            continue
        steps, child = [], False
        for tok in re.findall(r">|(?:[\w*-]+|\.[\w-]+|#[\w-]+|\[[^\]]*\])+", one):
            if tok == ">":
                child = True
                continue
            tests = []
            for kind, name, attr, op, value in re.findall(r"([.#]?)([\w*-]+)|\[([\w:-]+)(?:([\^*$~]?=)[\"']?([^\"'\]]*)[\"']?)?\]", tok):
                tests.append((kind or "t", name) if name else ("a", attr, op, value))
            steps.append((child, tuple(tests)))
            child = False
        out.append(tuple(steps))
    return tuple(out)


def _fits(n: Node, tests: tuple) -> bool:
    for t in tests:
        if t[0] == "t":
            if t[1] not in ("*", n.tag):
                return False
        elif t[0] == ".":
            if t[1] not in n.attrs.get("class", "").split():
                return False
        elif t[0] == "#":
            if n.attrs.get("id") != t[1]:
                return False
        else:
            v = n.attrs.get(t[1])
            if v is None or not {"": True, "=": v == t[3], "^=": v.startswith(t[3]), "*=": t[3] in v, "$=": v.endswith(t[3]), "~=": t[3] in v.split()}[t[2]]:
                return False
    return True


def _under(n: Node, steps: tuple) -> bool:
    child, tests = steps[-1]
    if not _fits(n, tests):
        return False
    if len(steps) == 1:
        return True
    p = n.parent
    while p is not None:
        if _under(p, steps[:-1]):
            return True
        if child:
            return False
        p = p.parent
    return False


def select(root: Node, selector: str) -> list[Node]:
    """Elements that fit a selector: tags, .classes, #ids, [attributes], descendants, > children, comma lists; document order."""
    found: dict[int, Node] = {}
    for steps in _compiled(selector):
        kind, name = next(((k, v) for k, v, *_ in sorted(steps[-1][1], key=lambda t: "#.t".find(t[0]) % 9) if k in "#.t"), ("t", "*"))
        found |= {i: n for i, n in root.named(kind, name) if n.tag != "!--" and _under(n, steps)}
    return [found[i] for i in sorted(found)]


def comments(node: Node) -> list[str]:
    """The texts of the comments below an element."""
    return [n.attrs["text"] for n in node.walk() if n.tag == "!--" and n.attrs["text"]]


def meta(root: Node, name: str) -> str | None:
    """The content of a meta element by name, property or itemprop."""
    for _, n in root.named("t", "meta"):
        if name in (n.attrs.get("name"), n.attrs.get("property"), n.attrs.get("itemprop")) and n.attrs.get("content", "").strip():
            return n.attrs["content"].strip()
    return None


def json_ld(root: Node) -> list[dict]:
    """All objects of the page's JSON-LD blocks, lists and @graph flattened; malformed blocks are skipped."""
    out: list[dict] = []
    for _, n in root.named("t", "script"):
        if "ld+json" in n.attrs.get("type", ""):
            try:
                stack = [json.loads(n.raw())]
            except ValueError:
                continue
            while stack:
                x = stack.pop()
                if isinstance(x, list):
                    stack += reversed(x)
                elif isinstance(x, dict):
                    if isinstance(x.get("@graph"), list):
                        stack += reversed(x["@graph"])
                    else:
                        out.append(x)
    return out


def typed(objects: list[dict], pattern: str) -> dict:
    """The first object whose @type fits a pattern, else an empty one."""
    for o in objects:
        kinds = o.get("@type")
        if any(re.search(pattern, str(k), re.I) for k in (kinds if isinstance(kinds, list) else [kinds])):
            return o
    return {}


def names(value) -> list[str]:
    """Names in a JSON-LD value: a string, an object with a name, or a list of these."""
    if isinstance(value, list):
        return [n for v in value for n in names(v)]
    if isinstance(value, dict):
        value = value.get("name")
    return [value.strip()] if isinstance(value, str) and value.strip() else []


def first_image(value) -> str | None:
    """The first image's address: a string, an object with a url, or a list of these."""
    if isinstance(value, list):
        return next((i for v in value if (i := first_image(v))), None)
    if isinstance(value, dict):
        value = value.get("url")
    return value if isinstance(value, str) and value else None


def breadcrumb(objects: list[dict]) -> list[str]:
    """Labels of a JSON-LD breadcrumb, by position."""
    items = typed(objects, "BreadcrumbList").get("itemListElement") or []
    rows = [(i.get("position", 0), (names(i) or names(i.get("item")) or [""])[0]) for i in items if isinstance(i, dict)]
    return [label for _, label in sorted(rows, key=lambda r: float(r[0] or 0)) if label]


def last_section(labels: list[str]) -> str | None:
    """The last label that isn't the start page."""
    kept = [x for x in labels if x.strip().lower() not in {"home", "beranda", ""}]
    return kept[-1] if kept else None


def data_layer(html: str) -> dict:
    """Fields pushed to the page's data layer, as JSON or as quoted literals."""
    out: dict = {}
    for block in re.findall(r"dataLayer\s*(?:\.push\s*\(|=\s*\[)\s*(\{.*?\})\s*[\])]", html, re.S):
        try:
            out |= json.loads(block)
        except ValueError:
            out |= {k: v for k, v in re.findall(r"['\"]([\w-]+)['\"]\s*:\s*['\"]([^'\"]*)['\"]", block)}
    return out


def window_state(html: str, name: str) -> dict:
    """A JSON object a page assigns to a property of its window."""
    m = re.search(rf"window\.{re.escape(name)}\s*=\s*(\{{.*?\}})\s*;?\s*(?:</script>|\n)", html, re.S)
    try:
        return json.loads(m[1]) if m else {}
    except ValueError:
        return {}


def next_data(root: Node) -> dict:
    """The state a server-rendered page embeds in __NEXT_DATA__."""
    for _, n in root.named("t", "script"):
        if n.attrs.get("id") == "__NEXT_DATA__":
            try:
                return json.loads(n.raw())
            except ValueError:
                return {}
    return {}


def revive(payload: list, deepest: int = 40):
    """Decode an index-encoded payload: a flat list whose first element is the root and whose whole numbers point to elements.

    A number that points to no element stays as it is. Wrapped values ([\"ShallowReactive\", n] and the like) are unwrapped; an element
    is decoded once however many point to it; where one points back to what it is part of, or lies too deep, there is null.
    """
    done: dict[int, object] = {}
    within: set[int] = set()

    def value(i, depth):
        if isinstance(i, bool) or not isinstance(i, int) or not 0 <= i < len(payload):
            return i
        if i in done:
            return done[i]
        if i in within or depth > deepest:
            return None
        x = payload[i]
        within.add(i)
        if isinstance(x, dict):
            out = {k: value(v, depth + 1) for k, v in x.items()}
        elif isinstance(x, list):
            wrapped = len(x) == 2 and isinstance(x[0], str) and isinstance(x[1], int)
            out = value(x[1], depth + 1) if wrapped else [value(v, depth + 1) for v in x]
        else:
            out = x
        within.discard(i)
        done[i] = out
        return out

    return value(0, 0) if payload else None


def find_key(x, key: str):
    """The first value under a key anywhere in nested JSON."""
    stack = [x]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            if key in v:
                return v[key]
            stack += list(v.values())
        elif isinstance(v, list):
            stack += v
    return None


# Lines in a body that lead elsewhere.
LEADS_AWAY = re.compile(r"^\s*(baca juga|pilihan editor|cek berita dan artikel|ringkasan berita|simak (juga|video)|lihat juga)\b", re.I)


# Fixed value: characters of a dateline at most.
DATELINE = 40


def paragraphs(root: Node, containers: str, noise: str = "", inner: str = "p, h2, h3") -> list[str]:
    """Paragraphs of the first container that has any: noise removed, lines that lead elsewhere dropped, a dateline joined to its text.

    A dateline is a short bold element that comes first in the container, before any paragraph; it isn't put before a text that begins
    with it already. A container without paragraphs is split at line breaks. Containers that are numbered as pages of one document
    (``data-page``) count as one, in the order of their numbers.
    """
    boxes, gone = select(root, containers), {id(n) for n in select(root, noise)} if noise else set()
    paged = [b for b in boxes if b.attrs.get("data-page", "").isdigit()]
    if len(paged) > 1:
        together = [t for b in sorted(paged, key=lambda b: int(b.attrs["data-page"])) for t in _in_container(b, gone, inner)]
        if together:
            return together
    return next((out for b in boxes if (out := _in_container(b, gone, inner))), [])


def _in_container(box: Node, gone: set[int], inner: str) -> list[str]:
    """The paragraphs of one container, elements in ``gone`` left out."""
    out = []
    for n in select(box, inner):
        p, skip = n, False
        while p is not None and p is not box.parent:
            skip |= id(p) in gone
            p = p.parent
        t = n.text()
        if not skip and t and not LEADS_AWAY.match(t):
            out.append(t)
    first = next((c for c in box.children if isinstance(c, Node) and c.tag != "!--" and id(c) not in gone), None)
    place = first.text() if first is not None and first.tag in {"strong", "b"} else ""
    if out and 0 < len(place) <= DATELINE and not out[0].lower().startswith(place.lower()):
        out[0] = f"{place} - {out[0]}"
    if out:
        return out
    lines, stack = [""], list(reversed(box.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            lines[-1] += c
        elif c.tag == "br":
            lines.append("")
        elif c.tag not in RAW and id(c) not in gone:
            stack += list(reversed(c.children))
    return [t for x in lines if (t := re.sub(r"\s+", " ", x).strip()) and not LEADS_AWAY.match(t)]


#: Classes and attributes by which pages mark what only subscribers may read.
LOCKED = "[class*=paywall], [class*=subscriber-only], [data-paywall], [data-locked=true]"
#: How a teaser ends.
CALLS = re.compile(r"\b(langganan|berlangganan|pelanggan|subscribe|subscribers?|subscription|log ?in|masuk)\b.{0,60}\b(lanjut\w*|selengkapnya|penuh|continue|full|unlock|read on)\b", re.I)


def premium(root: Node, text: str, marks: str = LOCKED) -> bool:
    """Whether a page shows a teaser only: structured data says it isn't free, an element is marked, or its last lines ask to subscribe."""
    free = [o.get("isAccessibleForFree") for o in json_ld(root)]
    if any(str(x).lower() in {"false", "no"} for x in free if x is not None) or (meta(root, "article:content_tier") or "").lower() in {"locked", "metered"}:
        return True
    return bool(select(root, marks)) or bool(CALLS.search(text[-400:]))
