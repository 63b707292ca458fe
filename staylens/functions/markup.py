"""Elements of stored pages: the one Python step of the library.

``select_elements`` is an Arrow UDF on the ``html`` column alone.  It returns,
per page, an array of the elements that match a list of rules, in document
order.  Everything after it (fallbacks, tiers, parsing) is built-in Spark.

Flat link rules that look at one tag only do not need it: see ``anchor_hrefs``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.rules import Rule

# Ship this module's functions inside the task, so that workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEMENT = "STRUCT<rule: STRING, ordinal: INT, scope: INT, text: STRING, attr: STRING>"

_ARROW_ELEMENT = pa.struct(
    [
        ("rule", pa.string()),
        ("ordinal", pa.int32()),
        ("scope", pa.int32()),
        ("text", pa.string()),
        ("attr", pa.string()),
    ]
)

_IN_TAG = r"[^'\">]*(?:\"[^\"]*\"[^'\">]*|'[^']*'[^'\">]*)*"
_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    rf"|(?P<raw>script|style)\b{_IN_TAG}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_IN_TAG})>"
    r"|[!?][^>]*>)",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SIMPLE = re.compile(
    r"(?P<tag>[a-zA-Z][\w-]*|\*)"
    r"|#(?P<id>[\w-]+)"
    r"|\.(?P<cls>[\w-]+)"
    r"|(?P<neg>:not\()?\[(?P<name>[\w-]+)(?:(?P<op>\*?=)(?P<q>[\"'])(?P<value>.*?)(?P=q))?\]\)?"
    r"|:nth-of-type\((?P<nth>\d+)\)"
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_FOREIGN = frozenset(("svg", "math"))
# A start tag on the left closes an open element of the middle set, looking up
# no further than the elements on the right.
_IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Any of these closes an open paragraph.
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_PARAGRAPH_SCOPE = frozenset("table td th caption button object template".split())


def _compile(css: str):
    """Selector text -> list of (tag, tests, nth, direct-child-of-previous)."""
    steps, direct = [], False
    for token in re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", css):
        if token == ">":
            direct = True
            continue
        tag, tests, nth = None, [], None
        for m in _SIMPLE.finditer(token):
            if m["tag"]:
                tag = None if m["tag"] == "*" else m["tag"].lower()
            elif m["id"]:
                tests.append(("id", "=", m["id"], True))
            elif m["cls"]:
                tests.append(("class", "~=", m["cls"], True))
            elif m["nth"]:
                nth = int(m["nth"])
            else:
                tests.append((m["name"].lower(), m["op"] or "", m["value"], not m["neg"]))
        steps.append((tag, tests, nth, direct))
        direct = False
    return steps


def _holds(value, op, wanted):
    if value is None:
        return False
    if op == "=":
        return value == wanted
    if op == "*=":
        return wanted in value
    if op == "~=":
        return wanted in value.split()
    return True


def _possible(html, rule):
    """False only when a literal the rule needs is nowhere in the page."""
    if "&#" in html:  # a character reference may spell the literal
        return True
    _, steps, _, own_text = rule
    literals = [v for _, tests, _, _ in steps for _, op, v, wanted in tests if op and wanted]
    return all(text in html for text in (*literals, own_text or ""))


class _Node:
    """An open element: its tag, attributes and place among same-tag siblings."""

    __slots__ = ("tag", "raw", "nth", "scope", "children", "parsed", "hits", "own")

    def __init__(self, tag, raw, nth, scope):
        self.tag, self.raw, self.nth, self.scope = tag, raw, nth, scope
        self.children, self.parsed, self.hits, self.own = {}, None, None, None

    def attrs(self):
        if self.parsed is None:
            self.parsed = {}
            for name, double, single, bare in _ATTR.findall(self.raw):
                self.parsed.setdefault(name.lower(), unescape(double or single or bare))
        return self.parsed

    def fits(self, step):
        tag, tests, nth, _ = step
        if (tag and tag != self.tag) or (nth and nth != self.nth):
            return False
        if not tests:
            return True
        if "&" not in self.raw:
            # without character references a wanted value stands in the raw text
            for _, op, value, wanted in tests:
                if wanted and op and value not in self.raw:
                    return False
        attrs = self.attrs()
        return all(_holds(attrs.get(n), op, v) == wanted for n, op, v, wanted in tests)


def _matches(steps, stack, at, level):
    """Does the open element ``stack[level]`` satisfy ``steps[..at]``?"""
    if not stack[level].fits(steps[at]):
        return False
    if at == 0:
        return True
    above = [level - 1] if steps[at][3] else range(level - 1, -1, -1)
    return any(up >= 0 and _matches(steps, stack, at - 1, up) for up in above)


def _needle(step):
    """A text that must stand in the tag of an element that fits the step."""
    return max((v for _, op, v, wanted in step[1] if op and wanted), key=len, default="")


def page_elements(html: str, rules, scope_steps=None):
    """Matching elements of one page; ``rules`` are (name, steps, attr, own_text).

    Gives (rule, ordinal, scope, text, attr) in document order.  Elements are
    kept as offsets; text is cut out only for those that are returned.
    """
    wanted = {}
    for rule in rules:
        if _possible(html, rule):
            wanted.setdefault(rule[1][-1][0], []).append(rule)
    if not wanted:
        return []
    anything = wanted.pop(None, [])
    checks = {
        tag: [(rule, _needle(rule[1][-1]), rule[1][-1][2]) for rule in (*wanted.get(tag, ()), *anything)]
        for tag in (*wanted, None)
    }
    any_tag = checks[None]
    used = [rule for group in checks.values() for rule, _, _ in group]
    count_siblings = any(step[2] for rule in used for step in rule[1])
    read_own_text = any(rule[3] for rule in used)
    stack, found, top, scopes, last = [], [], {}, 0, 0
    paragraphs = 0  # open ones

    def close(depth, end):
        nonlocal paragraphs
        for node in stack[depth:]:
            paragraphs -= node.tag == "p"
            for hit in node.hits or ():
                hit[4], hit[5] = end, node.own
        del stack[depth:]

    def close_last(tags, end, barriers=()):
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].tag in tags:
                return close(depth, end)
            if stack[depth].tag in barriers:
                return None

    for token in _TAG.finditer(html):
        start, end = token.span()
        closing, tag, raw = token.group("close", "tag", "attrs")
        if read_own_text:
            if start > last and stack and stack[-1].own is None:
                stack[-1].own = (last, start)
            last = end
        if not tag:  # comment, declaration, script or style
            continue
        tag = tag.lower()
        if closing:
            if stack and stack[-1].tag == tag and tag != "p":  # the usual case
                node = stack.pop()
                if node.hits:
                    for hit in node.hits:
                        hit[4], hit[5] = start, node.own
            else:
                close_last((tag,), start)
            continue
        if paragraphs and tag in _ENDS_PARAGRAPH:
            close_last(("p",), start, _PARAGRAPH_SCOPE)
        if tag in _IMPLIED_END:
            close_last(_IMPLIED_END[tag][0], start, _IMPLIED_END[tag][1])
        parent = stack[-1] if stack else None
        nth = 0
        if count_siblings:
            siblings = parent.children if parent else top
            nth = siblings[tag] = siblings.get(tag, 0) + 1
        node = _Node(tag, raw, nth, parent.scope if parent else 0)
        level = len(stack)
        stack.append(node)
        paragraphs += tag == "p"
        if scope_steps and not node.scope and _matches(scope_steps, stack, len(scope_steps) - 1, level):
            scopes += 1
            node.scope = scopes
        for (name, steps, attr, own_text), needle, at in checks.get(tag, any_tag):
            if (at and at != nth) or (needle not in raw and "&" not in raw):
                continue
            if _matches(steps, stack, len(steps) - 1, level):
                hit = [name, node.scope, node.attrs().get(attr) if attr else None, end, end, None, own_text]
                node.hits = [hit] if node.hits is None else [*node.hits, hit]
                found.append(hit)
        # a closing slash counts in drawings and formulas only
        if tag in _VOID or (raw.endswith("/") and any(n.tag in _FOREIGN for n in stack)):
            close(level, end)
    if read_own_text and last < len(html) and stack and stack[-1].own is None:
        stack[-1].own = (last, len(html))
    close(0, len(html))

    ordinals, out = {}, []
    for name, scope, attr, start, end, own, own_text in found:
        if own_text and (own is None or own_text not in unescape(html[own[0] : own[1]])):
            continue
        ordinal = ordinals[name, scope] = ordinals.get((name, scope), 0) + 1
        text = html[start:end]
        if "<" in text:
            text = _TAG.sub("", text)
        out.append((name, ordinal, scope, unescape(text), attr))
    return out


def _to_arrow(pages):
    """List of element lists (or None) -> one Arrow array."""
    flat = [e for page in pages for e in page or ()]
    columns = list(zip(*flat)) or [()] * len(_ARROW_ELEMENT)
    values = pa.StructArray.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW_ELEMENT)], fields=list(_ARROW_ELEMENT)
    )
    offsets, at = [], 0
    for page in pages:
        offsets.append(None if page is None else at)
        at += len(page or ())
    return pa.ListArray.from_arrays(pa.array([*offsets, at], pa.int32()), values)


def select_elements(html: Column, rules: Sequence[Rule], scope: str | None = None) -> Column:
    """Array of the elements matching ``rules``, in document order.

    ``ordinal`` counts from 1 per rule (and per scope); ``scope`` is the number
    of the enclosing element that matches the ``scope`` selector, 0 outside.
    A page that cannot be read gives NULL, never a failed task.
    """
    compiled = [(r.name, _compile(r.css), r.attr, r.own_text) for r in rules]
    scope_steps = _compile(scope) if scope else None

    @F.arrow_udf(f"ARRAY<{ELEMENT}>")
    def elements(pages: pa.Array) -> pa.Array:
        def one(page):
            try:
                return None if page is None else page_elements(page, compiled, scope_steps)
            except (ValueError, IndexError, RecursionError):
                return None

        return _to_arrow([one(p) for p in pages.to_pylist()])

    return elements(html)


def of_rule(elements: Column, *names: str) -> Column:
    """The elements of the given rules, in document order."""
    return F.filter(elements, lambda e: e["rule"].isin(*names))


def first_texts(elements: Column) -> Column:
    """MAP of rule name -> text of its first element, outside any scope."""
    first = F.filter(elements, lambda e: (e["ordinal"] == 1) & (e["scope"] == 0))
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["rule"], e["text"])))


# comments and code hold no anchors; an attribute value may hold ">"
_NO_MARKUP = r"(?is)<!--.*?(?:-->|$)|<(script|style|textarea|title)\b.*?</\1\s*>"
# runs are taken whole and not given back: Java calls itself once per turn of a group that may turn back
_ANCHOR = r"""(?is)<a(?=[\s/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_HREF = r"""(?is)(?<![\w-])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&"))


def without_code(html: Column) -> Column:
    """The page without comments, scripts and other elements that hold no markup."""
    return F.regexp_replace(html, _NO_MARKUP, "")


def unescaped(value: Column) -> Column:
    """An attribute's value with the character references that addresses hold resolved."""
    for entity, text in _ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(text))
    return value


def anchor_tags(html: Column) -> Column:
    """All opening anchor tags of a page in order, without leaving the JVM."""
    return F.regexp_extract_all(without_code(html), F.lit(_ANCHOR), 0)


def tag_href(tag: Column) -> Column:
    """The ``href`` of a tag: quoted either way or bare, entities resolved; '' if it has none."""
    return unescaped(F.concat(*(F.regexp_extract(tag, _HREF, k) for k in (1, 2, 3))))


def anchor_hrefs(html: Column) -> Column:
    """All ``href`` values of a page in order, without leaving the JVM."""
    linked = F.filter(anchor_tags(html), lambda t: F.regexp_like(t, F.lit(_HREF)))
    return F.transform(linked, tag_href)
