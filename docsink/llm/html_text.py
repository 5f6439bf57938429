"""Main text of web pages by wrappers: union-free expressions, aligned from all pages of a host, by which its pages are read.

A class, id or role that varies by page is a slot of its element's label. With such labels a host's expression has a rule for
each path: what elements of that path hold, one after the other (`align_content`). Contents that differ are aligned: what only some
have becomes optional, what comes more often in some becomes a repeated group, and texts are the slots. Distinct contents are
aligned in lots, and the rules of the lots with each other. A page is read by its host's rules, which give each text its slot; a
slot that holds the same text wherever it comes is a string of the template, any other a field.
The fields tell where the article lies: in the innermost element that, on the pages that have it, holds most of their text
which is no link and no boilerplate. Blocks of half of the pages are the template's where they are notices or stand at an end
of the article. A page that has none of the host's paths, or little text there, is read by itself. `infer` does the same for a
list of pages, and also writes them as one flat expression.
"""

from __future__ import annotations

import bisect
import difflib
import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Tokens of a repeated group at most.
LONGEST_GROUP = 24
#: Pages of a host, and share of them, that must have a block for it to be the template's; share of a page's article that is not its template's text.
TEMPLATE_PAGES, TEMPLATE_SHARE, OWN = 4, 0.5, 0.8
#: Counts that a task holds before it passes them on.
HELD = 200_000
#: Share of the text that the article's element holds, of that of the pages that have it; a share at which a page is read by itself.
MOST, LITTLE = 0.6, 0.1
#: Share of a host's pages, and at least two pages, that must have a value of class, id or role for it to tell elements apart;
#: for a slot to be a string of the template the same share, and at least TEMPLATE_PAGES.
COMMON = 0.01
#: Distinct contents of a path that are aligned one after the other.
LOT = 256

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg|iframe|textarea|select)\b[^>]*>.*?(?:</\1\s*>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<", re.S | re.I)
MARK = re.compile(r"(?<![\w:.-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Names of the HTML standard, and usual names of parts of pages that are no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
NO_TEXT = frozenset("head nav header footer aside form button dialog menu label fieldset".split())
PART_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related replies reply respond share sharing sidebar skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)


def words_of(marks: str) -> list[str]:
    return re.split(r"[^a-z]+", marks.lower())


def marks_in(attributes: str) -> list[tuple[str, list[str]]]:
    return [(k.lower(), (a or b or c).split()) for k, a, b, c in MARK.findall(attributes)] if "=" in attributes else []


def marks_of(source: str) -> set[str]:
    """All words of a page's classes, ids and roles, each with its element's name."""
    tags = (m for m in TOKEN.finditer(source) if m[3] and not m[1] and not m[2])
    return {f"{m[3].lower()} {k}={x}" for m in tags for k, words in marks_in(m[4]) for x in words}


#: Elements that are no article by themselves.
INNER = frozenset("p b i em strong span a li".split())
HEADING = re.compile(r"h[1-6]")


def path_key(parent: int, label: str) -> int:
    """A number for a path, from that of the path above it."""
    return int.from_bytes(hashlib.blake2b(parent.to_bytes(8, "big", signed=True) + label.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def name_of(label: str) -> str:
    return label.partition("[")[0]


class Page:
    """A page's texts: (node, text, in a link, boilerplate), in order; the node -1 ends a block.

    A node is a path of labels, of the node of the path above it and a label; elements of equal paths share it. A label is an
    element's name and the words of its class, id and role; with `shared`, of these words only, so that a value that varies by page
    (id=post-1) is a slot of the label and no element of its own. All steps take time in proportion to the page, however
    deep its elements are. `contents` has of each element, the page first, its node, what it holds (labels, and # for texts), and where it
    is: the element around it, and its place there; `spots` has of each text its element and the place of its # there (-1 if it is blank).
    """

    def __init__(self, source: str, shared: frozenset[str] | None = None):
        self.texts: list[tuple[int, str, bool, bool]] = []
        self.contents: list[tuple[int, list[str], int, int]] = [(0, [], -1, -1)]
        self.spots: list[tuple[int, int]] = []
        self.stream: list = []
        #: Of each node, the root first: the node above, the label, the depth, the path's number, whether within a heading.
        self.parents, self.labels, self.depths, self.keys, self.headings = [-1], [""], [0], [0], [False]
        self.nodes: dict[tuple[int, str], int] = {}
        stack: list[tuple[str, int, bool, bool, int]] = []  # name, node, within a link, within boilerplate, place in contents
        places: dict[str, list[int]] = {}  # where in the stack elements of a name are open

        def pop(k: int) -> None:
            while len(stack) > k:
                name, node, _, _, _ = stack.pop()
                places[name].pop()
                self.stream.append("</" + self.labels[node] + ">")

        def nearest(name: str) -> int:
            return places[name][-1] if places.get(name) else -1

        for m in TOKEN.finditer(source):
            token, name = m[0], (m[3] or "").lower()
            if m[1] or token.startswith(("<!", "<?")):
                if m[1]:
                    self.add(stack, "", block=True)
                continue
            if not name:
                self.add(stack, html.unescape(token))
                if token.strip() and (not self.stream or self.stream[-1] != "#"):
                    self.stream.append("#")
                continue
            if name in BLOCK:
                self.add(stack, "", block=True)
            if m[2]:
                if (at := nearest(name)) >= 0:
                    pop(at)
                continue
            if name in ENDS_P and (at := nearest("p")) >= 0:
                pop(at)
            for other in ENDS_SELF.get(name, ()):
                at = nearest(other)
                if at >= 0 and at > max(nearest(x) for x in ("ul", "ol", "dl", "table")):
                    pop(at)
            found = marks_in(m[4])
            marks = " ".join(f"{k}={' '.join(words)}" for k, words in found)
            if shared is not None:
                found = [(k, own) for k, words in found if (own := [x for x in words if f"{name} {k}={x}" in shared])]
            label = f"{name}[{' '.join(f'{k}={chr(32).join(words)}' for k, words in found)}]" if found else name
            _, parent, link, boiler, holder = stack[-1] if stack else ("", 0, False, False, 0)
            self.contents[holder][1].append(label)
            if name in VOID:
                self.stream.append(f"<{label}/>")
                continue
            own = name in NO_TEXT and not (name == "header" and places.get("article")) or not PART_NAMES.isdisjoint(words_of(marks.replace("class=", "").replace("id=", "").replace("role=", "")))
            places.setdefault(name, []).append(len(stack))
            stack.append((name, self.node(parent, label), link or name == "a", boiler or own, len(self.contents)))
            self.contents.append((stack[-1][1], [], holder, len(self.contents[holder][1]) - 1))
            self.stream.append(f"<{label}>")
        self.add(stack, "", block=True)

    def node(self, parent: int, label: str) -> int:
        found = self.nodes.setdefault((parent, label), len(self.parents))
        if found == len(self.parents):
            self.parents.append(parent)
            self.labels.append(label)
            self.depths.append(self.depths[parent] + 1)
            self.keys.append(path_key(self.keys[parent], label))
            self.headings.append(self.headings[parent] or bool(HEADING.fullmatch(name_of(label))))
        return found

    def add(self, stack: list, text: str, block: bool = False) -> None:
        """Text of the open block, or with `block` its end. Within a block, texts of one place are joined."""
        if block:
            self.texts.append((-1, "", False, False))
            self.spots.append((0, -1))
        elif text:
            _, node, link, boiler, holder = stack[-1] if stack else ("", 0, False, False, 0)
            self.texts.append((node, text, link, boiler))
            held, blank = self.contents[holder][1], not text.strip()
            if not blank and held[-1:] != ["#"]:
                held.append("#")
            self.spots.append((holder, -1 if blank else len(held) - 1))

    def slot_texts(self) -> dict[tuple[int, int], str]:
        """The text at each place of a #, with single spaces."""
        out: dict[tuple[int, int], list[str]] = {}
        for spot, (_, text, _, _) in zip(self.spots, self.texts, strict=True):
            if spot[1] >= 0:
                out.setdefault(spot, []).append(text)
        return {spot: " ".join("".join(texts).split()) for spot, texts in out.items()}

    def part(self, places: dict[tuple[int, int], int]) -> None:
        """Elements at these places, by (element around, place), get the number there as a part of their label, and so nodes of their own."""
        self.parents, self.labels, self.depths, self.keys, self.headings, self.nodes = [-1], [""], [0], [0], [False], {}
        nodes = [0]
        for _, _, holder, k in self.contents[1:]:
            label = self.contents[holder][1][k]
            nodes.append(self.node(nodes[holder], f"{label}[{places[holder, k]}]" if (holder, k) in places else label))
        self.contents = [(node, *own[1:]) for node, own in zip(nodes, self.contents, strict=True)]
        self.texts = [(node if node < 0 else nodes[holder], *own) for (node, *own), (holder, _) in zip(self.texts, self.spots, strict=True)]

    def path(self, node: int) -> tuple[str, ...]:
        out = []
        while node > 0:
            out.append(self.labels[node])
            node = self.parents[node]
        return tuple(reversed(out))


def fold(stream: list) -> list:
    """Groups that follow an equal one become one repeated group; groups are whole elements or texts."""
    out: list = []
    for token in stream:
        out.append(token)
        again = True
        while again:
            again = False
            for k in range(1, min(LONGEST_GROUP, len(out) - 1) + 1):
                last = out[-k:]
                if k > 1 and not (isinstance(last[0], str) and isinstance(last[-1], str) and last[-1] == "</" + last[0][1:]):
                    continue
                before = out[-k - 1]
                if isinstance(before, tuple) and before[0] == "+" and list(before[1]) == last:
                    del out[-k:]
                    again = True
                    break
                if len(out) >= 2 * k and out[-2 * k : -k] == last:
                    del out[-2 * k :]
                    out.append(("+", tuple(last)))
                    again = True
                    break
    return out


def align(wrapper: list, stream: list) -> list:
    """A wrapper that fits both: a mismatch is a repeated group if one side has it once, else optional groups."""
    out: list = []
    for op, a, b, c, d in difflib.SequenceMatcher(None, wrapper, stream, autojunk=False).get_opcodes():
        x, y = wrapper[a:b], stream[c:d]
        if op == "equal":
            out += x
        elif len(x) == 1 and isinstance(x[0], tuple) and x[0][0] == "+" and list(x[0][1]) == y:
            out += x
        elif len(y) == 1 and isinstance(y[0], tuple) and y[0][0] == "+" and list(y[0][1]) == x:
            out += y
        else:
            for side in (x, y):
                if side:
                    own = side[0] if len(side) == 1 and isinstance(side[0], tuple) else ("?", tuple(side))
                    if not out or out[-1] != own:
                        out.append(own)
    return out


def slots(wrapper) -> Iterator[tuple[str, ...]]:
    """The paths of the wrapper's text slots, each once. Neighbouring optional groups are alternatives of one place."""
    seen: dict[tuple[str, ...], None] = {}

    def step(stack: tuple[str, ...], x: str) -> tuple[str, ...]:
        if x.startswith("</"):
            return stack[: len(stack) - 1 - stack[::-1].index(x[2:-1])] if x[2:-1] in stack else stack
        return stack if x.endswith("/>") else (*stack, x[1:-1])

    def walk(items, stacks: dict) -> dict:
        for optional, group in groupby(items, lambda x: isinstance(x, tuple) and x[0] == "?"):
            if optional:
                stacks = {s: None for x in group for s in walk(x[1], stacks)}
                continue
            for x in group:
                if isinstance(x, tuple):
                    stacks = walk(x[1], stacks)
                elif x == "#":
                    seen.update(stacks)
                else:
                    stacks = {step(s, x): None for s in stacks}
        return stacks

    walk(wrapper, {(): None})
    yield from seen


# A rule: what elements of a path hold, as factors (kind, labels). One label that is there ('') or may be ('?'), or a repeated group
# whose labels each may be there, once or more ('+'), or any number of times ('*'). A label in a factor that is not '' is in no other.
Rule = list[tuple[str, tuple[str, ...]]]
OPTIONAL = {"": "?", "?": "?", "+": "*", "*": "*"}
REPEATED = ("+", "*")


def repeated(rule: Rule, spans: list[tuple[int, int]]) -> Rule:
    """The rule with each span of factors (first, last) as one repeated group; spans that overlap become one."""
    out, at = [], 0
    joined: list[list[int]] = []
    for first, last in sorted(spans):
        if joined and first <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], last)
        else:
            joined.append([first, last])
    for first, last in joined:
        own = rule[first : last + 1]
        kind = "*" if all(k in ("?", "*") for k, _ in own) else "+"
        out += [*rule[at:first], (kind, tuple(sorted({x for _, labels in own for x in labels})))]
        at = last + 1
    return out + rule[at:]


def where(rule: Rule) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for k, (_, labels) in enumerate(rule):
        for x in labels:
            out.setdefault(x, []).append(k)
    return out


def normal(rule: Rule) -> Rule:
    """A label that comes twice, and not always, is an iterator: from its first factor to its last all is one repeated group."""
    while spans := [(at[0], at[-1]) for at in where(rule).values() if len(at) > 1 and any(rule[k][0] for k in at)]:
        rule = repeated(rule, spans)
    return rule


def comparable(a: Rule, b: Rule) -> tuple[Rule, Rule]:
    """Both with the same labels in repeated groups, as far as both have them, and the others equally often."""
    while True:
        in_a, in_b = where(a), where(b)
        both = in_a.keys() & in_b.keys()
        groups = [{x} for x in both if len(in_a[x]) != len(in_b[x])]
        groups += [own for rule in (a, b) for kind, labels in rule if kind in REPEATED and (own := both.intersection(labels))]
        made = []
        for rule, at in ((a, in_a), (b, in_b)):
            spans = [(min(at[x][0] for x in own), max(at[x][-1] for x in own)) for own in groups]
            made.append(normal(repeated(rule, [s for s in spans if s[0] < s[1] or rule[s[0]][0] not in REPEATED])))
        if made == [a, b]:
            return a, b
        a, b = made


def in_order(values: list[int]) -> list[int]:
    """The indexes of a longest rising part of distinct values."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, v in enumerate(values):
        at = bisect.bisect_left(tails, v)
        tails[at : at + 1], ends[at : at + 1] = [v], [k]
        before.append(ends[at - 1] if at else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def align_content(a: Rule, b: Rule) -> Rule:
    """A rule that fits all that either fits. A mismatch is a repeated group if its label comes elsewhere in the rule, else optional."""
    if a == b:
        return a
    a, b = comparable(a, b)
    both = where(a).keys() & where(b).keys()

    def keys(rule: Rule) -> list:
        seen: Counter = Counter()
        out = []
        for kind, labels in rule:
            common = [x for x in labels if x in both]
            out.append((common[0], seen[common[0]]) if common else None)
            seen.update(common[:1])
        return out

    places = {key: k for k, key in enumerate(keys(b)) if key}
    pairs = [(k, places[key]) for k, key in enumerate(keys(a)) if key in places]
    out: Rule = []
    i = j = 0
    for k in [*in_order([y for _, y in pairs]), None]:
        x, y = (len(a), len(b)) if k is None else pairs[k]
        out += [(OPTIONAL[kind], labels) for kind, labels in [*a[i:x], *b[j:y]]]
        if k is not None:
            (kind, labels), (other, more) = a[x], b[y]
            kept = OPTIONAL[kind] if other in ("?", "*") else kind
            out.append((kept, tuple(sorted({*labels, *more})) if kind in REPEATED else labels))
        i, j = x + 1, y + 1
    return normal(out)


def slots_of(rule: Rule, content: Iterable[str]) -> list[int] | None:
    """The factor of each label and # of an element's content, or None where the rule does not fit it."""
    at, seen, out = where(rule), Counter(), []
    for x in content:
        own = at.get(x, ())
        n = seen[x] if len(own) > 1 else 0
        if n >= len(own) or out and (own[n] < out[-1] or own[n] == out[-1] and rule[own[n]][0] not in REPEATED):
            return None
        seen[x] += 1
        out.append(own[n])
    return out if {k for k, (kind, _) in enumerate(rule) if kind in ("", "+")} <= set(out) else None


def rule_text(rule: Rule) -> str:
    return json.dumps([labels[0] if not kind else [kind, *labels] for kind, labels in rule])


def rule_from(text: str) -> Rule:
    return [("", (x,)) if isinstance(x, str) else (x[0], tuple(x[1:])) for x in json.loads(text)]


class Expression:
    """What a host's expression tells of its pages' texts. By path: its rule, and the slots that hold the same text wherever they come, with whether half of the pages have them."""

    def __init__(self, rules: Iterable[tuple[int, str, Iterable[tuple[int, bool]]]] = ()):
        self.rules = {path: (rule_from(rule), dict(slots)) for path, rule, slots in rules}
        self.several = {path: {x for x, at in where(rule).items() if len(at) > 1 and x != "#"} for path, (rule, _) in self.rules.items()}
        self.known: dict[tuple, list[int]] = {}
        self.size = 0

    def slots(self, path: int, content: list[str]) -> list[int]:
        key = (path, *content)
        if key not in self.known:
            if self.size > HELD:
                self.known.clear()
                self.size = 0
            self.size += len(key)
            self.known[key] = slots_of(self.rules[path][0], content) or []
        return self.known[key]

    def read(self, page: Page) -> dict[tuple[int, int], bool]:
        """The page's places of strings; none if hardly any text would be left. Elements of one label that the rule has at several places are parted by place."""
        strings, places = {}, {}
        for k, (node, content, _, _) in enumerate(page.contents) if self.rules else ():
            if (path := page.keys[node]) in self.rules:
                own, several = self.rules[path][1], self.several[path]
                for i, slot in enumerate(self.slots(path, content)):
                    if content[i] == "#" and slot in own:
                        strings[k, i] = own[slot]
                    elif content[i] in several:
                        places[k, i] = slot
        if places:
            page.part(places)
        return strings if strings and free_text(page, strings)[1] > LITTLE * free_text(page)[1] else {}


def shared_marks(counts: dict[str, int], pages: int) -> frozenset[str]:
    return frozenset(x for x, n in counts.items() if n >= min(pages, max(2, COMMON * pages)))


def block_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def blocks_of(page: Page, at: int = 0, fixed: dict | None = None) -> list[tuple[str, bool, bool]]:
    """(text, whether a heading, whether all strings of half of the pages) of the blocks at a node that are no boilerplate, each with single spaces."""
    within = [at == 0]
    for node in range(1, len(page.parents)):
        within.append(node == at or within[page.parents[node]])
    out, block, heading, same = [], [], False, True
    for (node, text, _, boiler), spot in zip([*page.texts, (-1, "", False, False)], [*page.spots, (0, -1)], strict=True):
        if node < 0:
            if joined := " ".join("".join(block).split()):
                out.append((joined, heading, same))
            block, heading, same = [], False, True
        elif within[node] and not boiler:
            block.append(text)
            heading = heading or page.headings[node]
            same = same and (spot[1] < 0 or bool(fixed and fixed.get(spot)))
    return out


def split_template(blocks: list[tuple[str, bool, bool]], template: frozenset[int]) -> tuple[list[str], list[str]]:
    """The texts that stay, and the template's: repeated blocks, headings apart, that are notices or stand at either end.

    Where the repeated ones are much of the text, that is a copy of another page, and only strings of the template go.
    """
    same = [own and not heading for _, heading, own in blocks]
    hit = [s or not heading and block_key(text) in template for (text, heading, _), s in zip(blocks, same, strict=True)] if template else same
    own = [(len(t), h) for (t, _, _), h, s in zip(blocks, hit, same, strict=True) if not s]
    if sum(n for n, h in own if h) > (1 - OWN) * sum(n for n, _ in own):
        hit = same
    if not any(hit) or all(hit):
        return [t for t, _, _ in blocks], []
    first, last = hit.index(False), len(hit) - hit[::-1].index(False)
    gone = [h and (not first <= k < last or not PART_NAMES.isdisjoint(words_of(t))) for k, ((t, _, _), h) in enumerate(zip(blocks, hit, strict=True))]
    return [t for (t, _, _), g in zip(blocks, gone, strict=True) if not g], [t for (t, _, _), g in zip(blocks, gone, strict=True) if g]


def free_text(page: Page, fixed: dict | None = None) -> tuple[list[int], int]:
    """How much text outside links and boilerplate, and but for `fixed`, each node of the page holds, and all of it."""
    held = [0] * len(page.parents)
    for (node, text, link, boiler), spot in zip(page.texts, page.spots, strict=True):
        if node >= 0 and not link and not boiler and not (fixed and spot in fixed):
            held[node] += len(text.strip())
    for node in range(len(held) - 1, 0, -1):  # a node comes after the one above it
        held[page.parents[node]] += held[node]
    return held, held[0]


def may_be_article(page: Page, held: list[int]) -> list[int]:
    return [k for k in range(1, len(held)) if held[k] and name_of(page.labels[k]) not in INNER]


def best(page: Page, nodes: list[int], held: list[int]) -> int:
    """The innermost of the nodes; of article or main elements if there are any; the root where there is none."""
    named = [k for k in nodes if name_of(page.labels[k]) in ("article", "main")]
    return max(named or nodes, key=lambda k: (page.depths[k], held[k]), default=0)


def article_paths(pages: list[Page], strings: list[dict]) -> dict[int, tuple[str, ...]]:
    """The paths that hold most of the text of those pages that have them, by number: one or more for each layout."""
    held, on, paths = Counter(), Counter(), {}
    for page, fixed in zip(pages, strings, strict=True):
        own, total = free_text(page, fixed)
        for k in may_be_article(page, own):
            held[page.keys[k]] += own[k]
            on[page.keys[k]] += total
            paths[page.keys[k]] = page.path(k)
    return {key: paths[key] for key in sorted(held, key=paths.get) if held[key] >= MOST * on[key]}


def infer(sources: list[str]) -> dict:
    """The wrapper of pages of one host: {'path': of most articles, 'paths', 'shared': marks, 'template': [texts], 'rules': by path, 'expression': the
    rules that tell something, with their slots of strings, 'wrapper': the pages as one flat expression}."""
    shared = shared_marks(Counter(x for s in sources for x in marks_of(s)), len(sources))
    pages = [Page(x, shared) for x in sources]
    wrapper: list = []
    for k, page in enumerate(pages):
        wrapper = align(wrapper, fold(page.stream)) if k else fold(page.stream)
    samples = sample_counts(("", page) for page in pages)
    contents: dict[int, set[tuple[str, ...]]] = {}
    for _, path, content in samples:
        contents.setdefault(path, set()).add(content)
    rules = {path: reduce(align_content, ([("", (x,)) for x in c] for c in sorted(own))) for path, own in contents.items()}
    slots: dict[tuple[int, int], list] = {}
    on: Counter = Counter()
    for (_, path, content), found in samples.items():
        factors = slots_of(rules[path], content)
        for place, (n, low, high) in found.items():
            if place < 0:
                on[path] += n
                continue
            own = slots.setdefault((path, factors[place]), [0, low, high])
            own[:] = own[0] + n, min(own[1], low), max(own[2], high)
    enough = max(TEMPLATE_PAGES, COMMON * len(pages))
    told = {path: [] for path, n in on.items() if n >= enough and any(len(at) > 1 for x, at in where(rules[path]).items() if x != "#")}
    for (path, slot), (n, low, high) in slots.items():
        if low == high and n >= enough:
            told.setdefault(path, []).append((slot, n >= TEMPLATE_SHARE * len(pages)))
    expression = [(path, rule_text(rules[path]), sorted(own)) for path, own in sorted(told.items())]
    strings = [Expression(expression).read(page) for page in pages]
    paths = article_paths(pages, strings)
    chosen = [article_in(page, set(paths), own) for page, own in zip(pages, strings, strict=True)]
    path = Counter(page.path(at) for page, at in zip(pages, chosen, strict=True)).most_common(1)[0][0] if pages else ()
    counts = Counter(key for page in pages for key in {block_key(t) for t, heading, _ in blocks_of(page) if not heading})
    often = frozenset(k for k, n in counts.items() if n >= max(TEMPLATE_PAGES, TEMPLATE_SHARE * len(pages)))
    template = {t for page, at, own in zip(pages, chosen, strings, strict=True) if at for t in split_template(blocks_of(page, at, own), often)[1]}
    made = {"path": path, "paths": list(paths.values()), "shared": sorted(shared), "template": sorted(template)}
    return made | {"rules": rules, "expression": expression, "wrapper": json.dumps(wrapper)}


def article_in(page: Page, keys, fixed: dict | None = None) -> int:
    """Of the host's paths the best that the page has, or the root where that is none or holds little of the page's fields."""
    held, total = free_text(page, fixed)
    at = best(page, [k for k in range(1, len(held)) if held[k] and page.keys[k] in keys], held)
    return at if held[at] > LITTLE * total else 0


def main_text(source: str, path, template: frozenset, shared: frozenset[str] | None = None, expression: Expression | None = None) -> str:
    """The article's blocks joined by spaces. path: a path, or a set of the numbers of the host's paths; template: texts or their keys."""
    page = Page(source, shared)
    if isinstance(path, tuple):
        path = {reduce(path_key, path, 0)} if path else set()
    strings = expression.read(page) if expression else None
    at = article_in(page, path, strings)
    if not at:
        page, template, strings = Page(source), frozenset(), None
        held, total = free_text(page)
        at = best(page, [k for k in may_be_article(page, held) if held[k] >= MOST * total], held)
    keys = frozenset(block_key(t) if isinstance(t, str) else t for t in template)
    return " ".join(split_template(blocks_of(page, at, strings), keys)[0])


def sample_counts(pages: Iterable[tuple[str, Page]], counts: dict | None = None) -> dict:
    """By host, path and content of elements: of each place of a # how many pages have it, the least and the greatest key of its texts; as place -1 the pages with the path.

    A path, and a text at it, that a page has several times count once, so that nothing gets more pages than have it.
    """
    counts = {} if counts is None else counts
    for host, page in pages:
        texts, seen = page.slot_texts(), set()
        for k, (node, content, _, _) in enumerate(page.contents):
            path = page.keys[node]
            own = counts.setdefault((host, path, tuple(content)), {-1: [0, 0, 0]})
            own[-1][0] += path not in seen
            seen.add(path)
            for place in (i for i, x in enumerate(content) if x == "#"):
                text = block_key(texts[k, place])
                first = (path, text) not in seen
                seen.add((path, text))
                if (found := own.get(place)) is None:
                    own[place] = [int(first), text, text]
                else:
                    found[:] = found[0] + first, min(found[1], text), max(found[2], text)
    return counts


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, mark, n): pages with a mark; the mark '' counts all."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([h for h, _ in counts], pa.string()), pa.array([m for _, m in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["host", "mark", "n"])
        counts.clear()
        return made

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            counts.update([(host, ""), *((host, x) for x in marks_of(source))])
            if len(counts) > HELD:
                yield out()
    yield out()


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, key, place, n, low, high, content): of contents of a path's elements, at each place of a text, how many pages have it, its least and greatest key.

    At the place -1 are the pages with the path, and the content; elsewhere its key stands for it.
    """
    counts: dict = {}
    size = 0

    def out() -> pa.RecordBatch:
        rows = []
        for (host, path, content), own in counts.items():
            text = rule_text([("", (x,)) for x in content])
            key = block_key(text)
            rows += [(host, path, key, place, *found, None if place >= 0 else text) for place, found in own.items()]
        counts.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        made = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True) if rows else ((),) * 8, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(made, names=["host", "path", "key", "place", "n", "low", "high", "content"])

    for batch in batches:
        for host, source, shared in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "shared")), strict=True):
            page = Page(source, frozenset(shared or ()))
            sample_counts([(host, page)], counts)
            size += len(page.stream)
            if size > 5 * HELD:
                yield out()
                size = 0
    yield out()


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, rule): a rule for each neighbouring group of equal (host, path, lot)."""
    key, rule, done = None, [], []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["host", "path", "rule"])
        done.clear()
        return made

    for batch in batches:
        for *now, text in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "lot", "rule")), strict=True):
            if now == key:
                rule = align_content(rule, rule_from(text))
                continue
            if key:
                done.append((*key[:2], rule_text(rule)))
            key, rule = now, rule_from(text)
        yield out()
    if key:
        done.append((*key[:2], rule_text(rule)))
    yield out()


def rules_of(spark: SparkSession, contents: DataFrame) -> DataFrame:
    """(host, path, rule): distinct contents aligned in lots of about LOT, then the lots' rules, until a path has one. contents: (host, path, rule), distinct."""
    now = contents
    while True:
        sizes = now.groupBy("host", "path").agg(F.count(F.lit(1)).alias("size"))
        lot = F.pmod(F.xxhash64("rule"), F.ceil(F.col("size") / LOT))
        lots = now.join(sizes, ["host", "path"]).withColumn("lot", lot).select("host", "path", "lot", "rule")
        sorted_lots = lots.repartition("host", "path", "lot").sortWithinPartitions("host", "path", "lot", "rule")
        now = written(spark, sorted_lots.mapInArrow(_aligned, "host string, path long, rule string"), "rules")
        if not now.groupBy("host", "path").count().where("count > 1").limit(1).collect():
            return now


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, key, place, slot): of each place of a text in a content its slot in the path's rule."""
    for batch in batches:
        rows = []
        for host, path, key, content, rule in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "key", "content", "rule")), strict=True):
            own = json.loads(content)
            rows += [(host, path, key, k, slot) for k, (x, slot) in enumerate(zip(own, slots_of(rule_from(rule), own), strict=True)) if x == "#"]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        made = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True) if rows else ((),) * 5, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(made, names=["host", "path", "key", "place", "slot"])


def rules(spark: SparkSession, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, path, rule, n), the expression of each host with the pages that have a path; (host, path, slot, n, low, high), its slots. pages: (host, html, shared)."""
    found = pages.select("host", "html", "shared").mapInArrow(_samples, "host string, path long, key long, place int, n long, low long, high long, content string")
    counts = F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    samples = written(spark, found.groupBy("host", "path", "key", "place").agg(*counts, F.max("content").alias("content")), "samples")
    whole = samples.where("place = -1").select("host", "path", "key", "content", "n")
    aligned = rules_of(spark, whole.select("host", "path", F.col("content").alias("rule")))
    slots = whole.join(aligned, ["host", "path"]).mapInArrow(_slots, "host string, path long, key long, place int, slot int")
    slots = samples.where("place >= 0").drop("content").join(slots, ["host", "path", "key", "place"]).groupBy("host", "path", "slot").agg(*counts)
    return aligned.join(whole.groupBy("host", "path").agg(F.sum("n").alias("n")), ["host", "path"]), slots


def expressions(spark: SparkSession, pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, expression): the rules that tell something of texts, those with strings or with a label at several places. hosts: (host, pages)."""
    aligned, slots = rules(spark, pages)
    enough = F.col("n") >= F.greatest(F.lit(float(TEMPLATE_PAGES)), COMMON * F.col("pages"))
    strings = slots.where("low = high").join(hosts.select("host", "pages"), "host").where(enough)
    strings = strings.withColumn("often", F.col("n") >= TEMPLATE_SHARE * F.col("pages")).groupBy("host", "path").agg(F.sort_array(F.collect_list(F.struct("slot", "often"))).alias("slots"))
    labels = F.filter(F.from_json("rule", "array<string>"), lambda x: ~x.startswith("[") & (x != "#"))  # those that are always there
    several = aligned.join(hosts.select("host", "pages"), "host").where(enough & (F.size(F.array_distinct(labels)) < F.size(labels)))
    told = several.select("host", "path", "rule").unionByName(strings.join(aligned, ["host", "path"]).select("host", "path", "rule")).distinct()
    told = told.join(strings, ["host", "path"], "left")
    return told.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list(F.struct("path", "rule", "slots")))).alias("expression"))


class Read:
    """Expressions, made once for pages of a host that come together."""

    def __init__(self):
        self.made: dict[str | None, Expression] = {}

    def __call__(self, text: str | None) -> Expression:
        if text not in self.made:
            if len(self.made) >= 64:
                self.made.clear()
            self.made[text] = Expression((x["path"], x["rule"], [(s["slot"], s["often"]) for s in x.get("slots") or ()]) for x in json.loads(text or "[]"))
        return self.made[text]


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, block, a, b): of a path its fields' text and all of pages with it; of a block the pages with it (b)."""
    counts: dict[tuple, list[int]] = {}
    read = Read()

    def out() -> pa.RecordBatch:
        hosts, paths, keys = zip(*counts, strict=True) if counts else ((), (), ())
        a, b = zip(*counts.values(), strict=True) if counts else ((), ())
        made = [pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(keys, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(made, names=["host", "path", "block", "a", "b"])

    for batch in batches:
        for host, source, shared, expression in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "shared", "expression")), strict=True):
            page = Page(source, frozenset(shared or ()))
            held, total = free_text(page, read(expression).read(page))
            keys = {block_key(t) for t, heading, _ in blocks_of(page) if not heading}
            for key, a, b in [*(((host, page.keys[k], None), held[k], total) for k in may_be_article(page, held)), *(((host, None, k), 0, 1) for k in keys)]:
                own = counts.setdefault(key, [0, 0])
                own[0] += a
                own[1] += b
            if len(counts) > HELD:
                yield out()
    yield out()


def wrappers(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per host, from all its pages: shared, expression, paths, template (keys of blocks). pages: (host, html)."""
    marks = written(spark, pages.mapInArrow(_marks, "host string, mark string, n long").groupBy("host", "mark").agg(F.sum("n").alias("n")), "marks")
    hosts = marks.where("mark = ''").select("host", F.col("n").alias("pages"))
    common = marks.where("mark <> ''").join(hosts, "host").where(F.col("n") >= F.least("pages", F.greatest(F.lit(2.0), COMMON * F.col("pages"))))
    shared = hosts.join(common.groupBy("host").agg(F.sort_array(F.collect_list("mark")).alias("shared")), "host", "left")
    shared = written(spark, shared.withColumn("shared", F.coalesce("shared", F.array().cast("array<string>"))), "shared")
    shared = written(spark, shared.join(expressions(spark, pages.join(shared, "host"), shared), "host", "left"), "expressions")
    counted = pages.join(shared, "host").select("host", "html", "shared", "expression").mapInArrow(_held, "host string, path long, block long, a long, b long")
    counts = counted.groupBy("host", "path", "block").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).join(shared.select("host", "pages"), "host")
    article = F.when(F.col("path").isNotNull() & (F.col("a") >= MOST * F.col("b")), F.col("path"))
    repeated = F.when(F.col("b") >= F.greatest(F.lit(float(TEMPLATE_PAGES)), TEMPLATE_SHARE * F.col("pages")), F.col("block"))
    found = counts.groupBy("host").agg(F.sort_array(F.collect_list(article)).alias("paths"), F.sort_array(F.collect_list(repeated)).alias("template"))
    return written(spark, shared.join(found, "host", "left").select("host", "paths", "shared", "template", "expression"), "wrappers")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = Read()
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("html", "paths", "template", "shared", "expression")), strict=True)
        texts = [main_text(h, set(p or ()), frozenset(t or ()), frozenset(s or ()), read(f)) for h, p, t, s, f in rows]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    A null or empty html has an empty text; a null url is of the host ''; repeated rows each have a row; no rows give
    none; other columns stay out. Of equally good article paths the deeper one is taken.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    own = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("host", host)
    found = own.join(wrappers(spark, own.select("host", "html")), "host", "left").select("page_id", "url", "html", "paths", "shared", "template", "expression")
    schema = f"page_id {dict(own.dtypes)['page_id']}, url string, text string"
    return found.mapInArrow(_extract, schema).withColumn("n_chars", F.length("text").cast("long"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
