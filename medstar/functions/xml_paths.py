"""Field extraction from HL7 v3 documents, one parse per document.

The rules reproduce how the original jobs read a document:

* element steps match the local name, whatever the namespace or prefix;
* ``a/b`` collects every ``b`` child of every node in the set, in document
  order; ``a//b`` collects ``b`` among the descendants-or-self of every node
  (a node can appear twice when the starting nodes overlap);
* an attribute step ``@x`` yields a value only when the node set on its left
  holds exactly one node; over zero or several nodes it yields nothing;
* the text of a node set is the concatenation of all its text.

A field is a :class:`Field`: a path plus what to do with the result
(``head`` fails on an empty result, ``text`` concatenates and never fails,
``first_text`` is the text of the first node) and an optional node filter
and post-processing step.  A failure is reported per document as a reason
string, never as a silent null.

Documents of plain markup are read without building a tree
(:class:`PlainScan`), any other by the XML parser; both give the same values and
reasons.

``extract_udf`` wraps the evaluator into an Arrow UDF that
returns one struct per document with every requested field plus ``err``.
Everything around it (reading, keys, joins, writes) stays in Spark SQL.
"""

from __future__ import annotations

import gc
import re
from dataclasses import dataclass, field
from operator import itemgetter
from typing import Callable, Sequence
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


class Reject(Exception):
    """A document the rules cannot turn into a value."""


# ---------------------------------------------------------------- paths ----

@dataclass(frozen=True)
class Step:
    axis: str          # "child", "desc" (descendant-or-self) or "attr"
    name: str


def parse_path(path: str) -> tuple[Step, ...]:
    """``recordTarget/patientRole//id/@extension`` -> steps.

    A path is relative to the document element.  ``//`` before a name is the
    descendant-or-self step; ``@name`` may only be the last step.
    """
    steps: list[Step] = []
    rest = path.strip()
    if rest.startswith("//"):
        axis, rest = "desc", rest[2:]
    else:
        axis = "child"
    for part in re.split(r"(//|/)", rest):
        if part == "/":
            axis = "child"
        elif part == "//":
            axis = "desc"
        elif part:
            if part.startswith("@"):
                steps.append(Step("attr", part[1:]))
            else:
                steps.append(Step(axis, part))
    for s in steps[:-1]:
        if s.axis == "attr":
            raise ValueError(f"attribute step must be last: {path}")
    return tuple(steps)


# Tags are "{namespace}name" or "name"; a step matches the local name.

def _child(nodes, name):
    sfx = "}" + name
    return [c for n in nodes for c in n if c.tag == name or c.tag.endswith(sfx)]


def _desc(nodes, name):
    sfx = "}" + name
    return [d for n in nodes for d in n.iter() if d.tag == name or d.tag.endswith(sfx)]


def _attr(nodes, name) -> list[str]:
    if len(nodes) != 1:
        return []
    v = nodes[0].attrib.get(name)
    return [] if v is None else [v]


def node_text(node) -> str:
    return "".join(node.itertext())


def text_of(result) -> str:
    return "".join(r if isinstance(r, str) else node_text(r) for r in result)


# ----------------------------------------------- JVM string semantics ----
# The original jobs index strings in UTF-16 code units; a character outside
# the BMP counts twice.

def jlen(s: str) -> int:
    if s.isascii():
        return len(s)
    return len(s) + sum(1 for ch in s if ord(ch) > 0xFFFF)


def jprefix(s: str, n: int, what: str) -> str:
    """``s.substring(0, n)``; rejects strings shorter than ``n`` units."""
    if len(s) >= n and s.isascii():
        return s[:n]
    if jlen(s) < n:
        raise Reject(f"{what}: shorter than {n} characters")
    if len(s) == jlen(s):
        return s[:n]
    units = s.encode("utf-16-le", "surrogatepass")[: 2 * n]
    return units.decode("utf-16-le", "surrogatepass")


def jchar_at(s: str, i: int, what: str) -> str:
    if len(s) > i and s.isascii():
        return s[i]
    if jlen(s) <= i:
        raise Reject(f"{what}: shorter than {i + 1} characters")
    return jprefix(s, i + 1, what)[-1]


def jdrop(s: str, n: int) -> str:
    """``s.drop(n)``: safe on short input."""
    if len(s) == jlen(s):
        return s[n:]
    units = s.encode("utf-16-le", "surrogatepass")[2 * n:]
    return units.decode("utf-16-le", "surrogatepass")


_INT_RE = re.compile(r"[+-]?\d+")
_INT_MIN, _INT_MAX = -(2 ** 31), 2 ** 31 - 1


def jparse_int(s: str, what: str) -> int:
    """``s.toInt``: optional sign and digits, 32-bit range."""
    if not _INT_RE.fullmatch(s):
        raise Reject(f"{what}: not an integer")
    v = int(s)
    if v < _INT_MIN or v > _INT_MAX:
        raise Reject(f"{what}: integer out of range")
    return v


def jdiv(a: int, b: int) -> int:
    """Integer division truncating toward zero."""
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


# --------------------------------------------------------------- fields ----

@dataclass(frozen=True)
class Field:
    name: str
    path: str
    mode: str = "head"                  # head | text | first_text
    node_filter: Callable | None = None  # applied to the node set before @attr
    post: Callable[[str], str] | None = None
    steps: tuple = field(default=(), compare=False)

    def __post_init__(self):
        object.__setattr__(self, "steps", parse_path(self.path))

    @property
    def element_steps(self) -> tuple:
        last = self.steps[-1]
        return self.steps[:-1] if last.axis == "attr" else self.steps

    def finish(self, elems: list) -> str:
        """From the element set of the path to the field value."""
        last = self.steps[-1]
        if self.node_filter is not None:
            # filter the element set, then take the attribute step
            elems = [e for e in elems if self.node_filter(e, self.name)]
        result = _attr(elems, last.name) if last.axis == "attr" else elems
        if self.mode == "head":
            if not result:
                raise Reject(f"{self.name}: no single match for {self.path}")
            value = result[0] if last.axis == "attr" else text_of(result[:1])
        elif self.mode == "first_text":
            if not result:
                raise Reject(f"{self.name}: nothing at {self.path}")
            value = node_text(result[0])
        else:                                # text: never fails
            value = "".join(result) if last.axis == "attr" else text_of(result)
        return self.post(value) if self.post is not None else value


class FieldPlan:
    """A field list compiled once: every distinct path prefix becomes one
    step in a list, so a document evaluates each prefix once, in order."""

    def __init__(self, fields: Sequence[Field]):
        self.fields = tuple(fields)
        self.steps: list[tuple[int, str, str]] = []     # (parent, axis, name)
        index: dict[tuple, int] = {}
        self.refs: list[int] = []
        for f in self.fields:
            parent = -1
            es = f.element_steps
            for i in range(len(es)):
                key = es[: i + 1]
                if key not in index:
                    index[key] = len(self.steps)
                    self.steps.append((parent, es[i].axis, es[i].name))
                parent = index[key]
            self.refs.append(parent)
        self.scan = PlainScan(self.steps, self.refs)
        self.last: _Skeleton | None = None      # of the documents before, if it has a pattern

    def evaluate(self, root) -> dict:
        sets: list = []
        top = [root]
        for parent, axis, name in self.steps:
            src = top if parent < 0 else sets[parent]
            sets.append(_child(src, name) if axis == "child" else _desc(src, name))
        return {f.name: f.finish(top if ref < 0 else sets[ref])
                for f, ref in zip(self.fields, self.refs)}

    def read(self, cut: "_Cut") -> dict:
        """The fields of a document of a known skeleton."""
        of = cut.skeleton
        if of.readers is None:
            places = {n: i for i, n in enumerate([*of.values, *(-1 - n for n in of.texts)])}
            of.readers = [(f.name, self._reader(f, [e.placed(places) for e in of.sets.get(ref, [])]))
                          for f, ref in zip(self.fields, self.refs)]
        of.reads += 1
        if of.reads == of.OFTEN:
            self.scan.kept += of.compile()
        if of.pattern is not None:
            self.last = of
        return self._fields(of, [*(cut.values[i] for i in of.values), *(cut.texts[i] for i in of.texts)])

    def read_again(self, content: str) -> dict | None:
        """The fields of a document of the skeleton read last, None for another."""
        of = self.last
        m = of.pattern.fullmatch(content)
        if m is None or (not content.isascii() and _UNUSUAL.search(content)):
            return None
        found = m.group(0, *of.uri_groups, *of.groups)       # 0: never a single string
        uris = found[1:len(of.uri_groups) + 1]
        if uris != of.good_uris:
            if not all(_good_uri(uri, prefixed) for uri, (_, prefixed) in zip(uris, of.uris)):
                return None
            of.good_uris = uris
        return self._fields(of, found[len(of.uri_groups) + 1:])

    @staticmethod
    def _fields(of: "_Skeleton", strings: Sequence[str]) -> dict:
        if "&" in "".join(strings):
            strings = [_unescape(s) for s in strings]
        return {name: reader(strings) for name, reader in of.readers}

    @staticmethod
    def _reader(f: Field, elements: "list[_Numbers]") -> Callable[[Sequence[str]], str]:
        last, post = f.steps[-1], f.post
        if f.node_filter is None and last.axis == "attr" and len(elements) == 1:
            parts = [elements[0].attrib.get(last.name)]
        elif f.node_filter is None and last.axis != "attr" and (elements or f.mode == "text"):
            parts = [t for e in (elements if f.mode == "text" else elements[:1]) for t in e.texts]
        else:
            parts = [None]
        if any(p is None for p in parts):                    # the rules of the field decide
            shown = [(e, _Element({}, [])) for e in elements]    # filled anew for each document
            return lambda strings: f.finish([e.show(strings, x) for e, x in shown])
        if len(parts) == 1 and not isinstance(parts[0], str):
            one = itemgetter(parts[0])
            return one if post is None else lambda strings: post(one(strings))

        def joined(strings: Sequence[str]) -> str:
            value = "".join([p if isinstance(p, str) else strings[p] for p in parts])
            return value if post is None else post(value)

        return joined


def parse_document(content: str):
    if content is None:
        raise Reject("content: null")
    if content.startswith("﻿"):
        content = content[1:]
    try:
        root = ET.fromstring(content)
    except ET.ParseError as e:
        raise Reject(f"content: malformed XML ({e})") from None
    return root               # comments and PIs are not kept by the parser


def evaluate_fields(content: str, fields: "Sequence[Field] | FieldPlan") -> dict:
    plan = fields if isinstance(fields, FieldPlan) else FieldPlan(fields)
    if content is not None and plan.last is not None:
        out = plan.read_again(content)
        if out is not None:
            return out
    cut = None if content is None else plan.scan.cut(content)
    if cut is not None and plan.scan.fits(cut):
        return plan.read(cut)
    sets = None if cut is None else plan.scan.walk(cut.markup, cut.values)
    if sets is None:
        return plan.evaluate(parse_document(content))
    return {f.name: f.finish(sets.get(ref, [])) for f, ref in zip(plan.fields, plan.refs)}


# ------------------------------------------------------ plain documents ----
# Plain markup: names of ASCII letters, namespaces declared in the root's tag,
# values in double quotes, no references but the five, no CDATA, document type
# or instructions.  It is cut at the double quotes: what stands between two
# values is a piece of markup, and where a piece leads to from a place is worked
# out once and kept, as far as there is room.  What is left without values and
# texts (but those that begin with a new line) is the document's skeleton: from
# the second document of one skeleton on, the values and texts that the fields
# read are taken by their numbers.  A skeleton that comes often becomes one
# regular expression, which the next document is matched against first.

_NAME = r"[A-Za-z_][\w.-]*(?::[A-Za-z_][\w.-]*)?"
_DECLARATION = re.compile(r"""<\?xml version="1\.0"(?: encoding="[Uu][Tt][Ff]-8")? ?\?>""")
_FIRST_VALUE = re.compile(rf"<({_NAME})[ \t\n]+({_NAME})[ \t\n]*=[ \t\n]*\Z", re.A)
_NEXT_VALUE = re.compile(rf"[ \t\n]+({_NAME})[ \t\n]*=[ \t\n]*\Z", re.A)
_TAG_END = re.compile(r"[ \t\n]*(/?)>")
_BARE_TAG = re.compile(rf"<(/?)({_NAME})[ \t\n]*(/?)>", re.A)
_COMMENT = re.compile(r"<!--(?:[^-]|-[^-])*-->")
_TEXT = re.compile("[^<]*")
_CUT_TEXT = re.compile(">([^<\n][^<]*)<")
_COMMENT_WITHOUT_TAGS = re.compile("<!--(?:[^-<>]|-[^-<>])*-->")
_UNUSUAL = re.compile("[^\t\n -~\u00a0-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")
_UNUSUAL_VALUE = re.compile("[^ -;=-~\u00a0-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")
_REFERENCE = re.compile("&(?!(?:amp|lt|gt|quot|apos);)")
# characters of a value and of a text of a pattern: no references, ends or "]";
# unusual ones that aren't ASCII are looked for apart
_IN_VALUE = r'[^"<&\x00-\x1f\x7f]'
_IN_TEXT = r'[^"<&\]\x00-\x08\x0b-\x1f\x7f]'
_ONE_REFERENCE = "&(?:amp|lt|gt|quot|apos);"
_VALUE_PATTERN = f"{_IN_VALUE}*+(?:{_ONE_REFERENCE}{_IN_VALUE}*+)*+"
_TEXT_PATTERN = rf"(?!\n|<){_IN_TEXT}*+(?:{_ONE_REFERENCE}{_IN_TEXT}*+)*+"
_RESERVED = ("http://www.w3.org/XML/1998/namespace", "http://www.w3.org/2000/xmlns/")
_BLANKS = " \t\n"
_START, _VALUE, _CHARS, _END, _URI = range(5)


def _unescape(s: str) -> str:
    if "&" not in s:
        return s
    for ref, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        s = s.replace(ref, ch)
    return s


class _Element:
    """What a field reads of an element: its attributes and its text."""

    __slots__ = ("attrib", "texts")

    def __init__(self, attrib: dict, texts: list):
        self.attrib, self.texts = attrib, texts

    def itertext(self):
        return iter(self.texts)


class _Numbers:
    """An element of a skeleton: the numbers of its values and texts, or the
    texts themselves if they are part of the skeleton."""

    __slots__ = ("attrib", "texts")

    def __init__(self, attrib: dict, texts: list):
        self.attrib, self.texts = attrib, texts

    @classmethod
    def of(cls, e: _Element) -> "_Numbers":
        return cls({name: int(v) for name, v in e.attrib.items()},
                   [t if t.startswith("\n") else int(t) for t in e.texts])

    def placed(self, places: dict[int, int]) -> "_Numbers":
        """With places among the strings that are read (a text's number n is
        looked up as -1 - n)."""
        return _Numbers({name: places[i] for name, i in self.attrib.items()},
                        [t if isinstance(t, str) else places[-1 - t] for t in self.texts])

    def show(self, strings: Sequence[str], x: _Element) -> _Element:
        """The element ``x`` with the strings of a document."""
        for name, i in self.attrib.items():
            x.attrib[name] = strings[i]
        if self.texts:
            x.texts = [t if isinstance(t, str) else strings[t] for t in self.texts]
        return x


class _Skeleton:
    __slots__ = ("parts", "sets", "uris", "values", "texts", "readers", "reads", "pattern", "groups",
                 "uri_groups", "good_uris")

    OFTEN = 50                   # documents read by numbers before there is a pattern

    def __init__(self, parts: list[str], sets: dict[int, list[_Numbers]], uris: list[tuple[int, bool]]):
        self.parts, self.sets, self.uris = parts, sets, uris
        elements = [e for found in sets.values() for e in found]
        # numbers of the values and texts that fields read
        self.values = sorted({i for e in elements for i in e.attrib.values()})
        self.texts = sorted({t for e in elements for t in e.texts if not isinstance(t, str)})
        self.readers, self.reads, self.pattern, self.good_uris = None, 0, None, None

    def compile(self) -> int:
        """A pattern of the documents of this skeleton, no matter how long it
        is; returns its size.  It is no wider than ``PlainScan.fits``; documents
        that it doesn't match are cut."""
        found, wanted, value = [], {*self.values, *(i for i, _ in self.uris)}, 0
        out = [f"(?:{_DECLARATION.pattern})?"]

        def add(number: int, pattern: str, read: bool) -> None:
            out.append(f"({pattern})" if read else pattern)
            if read:
                found.append(number)

        for n, part in enumerate(self.parts):
            if n:                                            # text n - 1 stands before it
                out.append(">")
                add(-n, _TEXT_PATTERN, n - 1 in self.texts)
                out.append("<")
            for m, piece in enumerate(part.split('"')):
                if m:                                        # a quote stands for a value
                    out.append('"')
                    add(value, _VALUE_PATTERN, value in wanted)
                    out.append('"')
                    value += 1
                out.append(re.escape(piece))
        group = {number: i + 1 for i, number in enumerate(found)}
        self.groups = [group[i] for i in [*self.values, *(-1 - t for t in self.texts)]]
        self.uri_groups = [group[i] for i, _ in self.uris]
        self.pattern = re.compile("".join(out))
        return 10 * sum(map(len, self.parts))


class _Cut:
    """A document cut at its values, and the markup cut at its texts."""

    __slots__ = ("markup", "values", "texts", "skeleton")

    def __init__(self, markup, values, texts, skeleton):
        self.markup, self.values, self.texts, self.skeleton = markup, values, texts, skeleton


class _Place:
    """A place between pieces: the open elements, each with its name, the steps
    whose node sets hold it and how many of it and its ancestors each step holds;
    the open tag with the attributes so far; the prefixes; whether the root has
    ended.  ``next``: piece -> (place, what to do)."""

    __slots__ = ("open", "tag", "names", "prefixes", "ended", "next")

    def __init__(self, *key):
        self.open, self.tag, self.names, self.prefixes, self.ended = key
        self.next = {}


class PlainScan:
    """Node sets of the wanted steps of a plain document.

    ``node_sets`` is None for a document that isn't surely well-formed and plain,
    or in which elements that a step starts from lie in each other (their order
    and number are the tree's business).
    """

    # characters of pieces and skeletons kept, of one piece, of one skeleton
    ROOM, LONGEST, SKELETON = 4_000_000, 2_000, 40_000

    def __init__(self, steps: Sequence[tuple[int, str, str]], wanted: Sequence[int]):
        self.steps, self.wanted = list(steps), frozenset(wanted)
        self._forget()

    def _forget(self) -> None:
        self.kept, self.places, self.seen, self.skeletons = 0, {}, set(), {}
        self.first = _Place((), None, (), frozenset(["xml"]), False)

    def _place(self, *key) -> _Place:
        place = self.places.get(key)
        if place is None:
            place = self.places[key] = _Place(*key)
        return place

    def _element(self, open_: tuple, name: str) -> tuple | None:
        """(name, steps that hold it, counts) of an element inside ``open_``;
        None: it is reached from elements in each other.  Step -1, counted last,
        is the root."""
        local = name.rpartition(":")[2]
        member = set() if open_ else {-1}
        above = list(open_[-1][2]) if open_ else [0] * len(self.steps) + [1]
        for i, (of, axis, wanted) in enumerate(self.steps):    # parents come first
            if wanted == local:
                found = above[of] if axis == "desc" else bool(open_) and of in open_[-1][1]
                if found and above[of] > 1:
                    return None
                if found:
                    member.add(i)
                    above[i] += 1
        return name, frozenset(member), tuple(above)

    def _step(self, place: _Place, piece: str):
        step = self._parse(place, piece)
        if step is not None and len(piece) <= self.LONGEST:
            place.next[piece] = step
            self.kept += len(piece) + 100
        return step

    def _parse(self, place: _Place, piece: str):
        if _UNUSUAL.search(piece) or "]]>" in piece or _REFERENCE.search(piece):
            return None
        if place.tag is None and place is not self.first:    # a quote outside of tags
            return None
        open_, prefixes, ended, todo, at = place.open, place.prefixes, place.ended, [], 0
        if place.tag is not None:
            m = _NEXT_VALUE.match(piece)
            if m:
                return self._value(open_, place.tag, (*place.names, m[1]), prefixes, todo)
            m = _TAG_END.match(piece)
            if not m:
                return None
            # prefixes of the tag; two prefixed names could mean the same
            odd = [p for p, colon, _ in (n.partition(":") for n in place.names)
                   if colon and p != "xmlns"]
            own = place.tag[0].partition(":")
            if len(odd) > 1 or any(p not in prefixes for p in odd) or (
                    own[1] and (own[0] == "xml" or own[0] not in prefixes)):
                return None
            if not m[1]:
                open_ = (*open_, place.tag)
            else:
                if place.tag[1] & self.wanted:
                    todo.append((_END, None))
                ended = not open_
            at = m.end()
        while True:
            text = _TEXT.match(piece, at)
            if text[0]:
                if not open_ and text[0].strip(_BLANKS):
                    return None
                if any(e[1] & self.wanted for e in open_):
                    todo.append((_CHARS, _unescape(text[0])))
            at = text.end()
            if at == len(piece):
                return self._place(open_, None, (), prefixes, ended), tuple(todo)
            m = _COMMENT.match(piece, at)
            if m:
                at = m.end()
                continue
            if ended:
                return None
            m = _BARE_TAG.match(piece, at)
            if m and m[1]:
                if m[3] or not open_ or open_[-1][0] != m[2]:
                    return None
                if open_[-1][1] & self.wanted:
                    todo.append((_END, None))
                open_ = open_[:-1]
                ended, at = not open_, m.end()
                continue
            value = None if m else _FIRST_VALUE.match(piece, at)
            if not m and not value:
                return None
            tag = self._element(open_, m[2] if m else value[1])
            if tag is None:
                return None
            hits = tuple(sorted(tag[1] & self.wanted))
            if hits:
                todo.append((_START, hits))
            if value:
                return self._value(open_, tag, (value[2],), prefixes, todo)
            prefix, colon, _ = tag[0].partition(":")
            if colon and (prefix == "xml" or prefix not in prefixes):
                return None
            at = m.end()
            if not m[3]:
                open_ = (*open_, tag)
            else:
                if hits:
                    todo.append((_END, None))
                ended = not open_

    def _value(self, open_, tag, names, prefixes, todo):
        """The place before a value of the attribute named last."""
        name = names[-1]
        prefix, colon, local = name.partition(":")
        if name in names[:-1]:
            return None
        if prefix == "xmlns":
            if open_ or local in ("xml", "xmlns"):
                return None
            prefixes = prefixes | {local} if colon else prefixes
            todo.append((_URI, bool(colon)))
        elif not colon and tag[1] & self.wanted:
            todo.append((_VALUE, name))
        return self._place(open_, tag, names, prefixes, False), tuple(todo)

    def node_sets(self, content: str) -> dict[int, list[_Element]] | None:
        cut = self.cut(content)
        if cut is None or not self.fits(cut):
            return None if cut is None else self.walk(cut.markup, cut.values)
        strings = [_unescape(s) for s in (*cut.values, *cut.texts)]
        places = {i: i for i in range(len(cut.values))}
        places |= {-1 - t: len(cut.values) + t for t in range(len(cut.texts))}
        return {i: [e.placed(places).show(strings, _Element({}, [])) for e in found]
                for i, found in cut.skeleton.sets.items()}

    def cut(self, content: str) -> _Cut | None:
        """None if a value or a quote shows that the document isn't plain."""
        if content.startswith("\ufeff"):
            content = content[1:]
        if "\r" in content:                       # what any parser does first
            content = content.replace("\r\n", "\n").replace("\r", "\n")
        declared = _DECLARATION.match(content)
        pieces = (content[declared.end():] if declared else content).split('"')
        values = pieces[1::2]
        every = " ".join(values)
        if not every.isprintable() or "<" in every:
            if _UNUSUAL_VALUE.search(every):
                return None
        if "&" in every and _REFERENCE.search(every):
            return None
        if len(pieces) % 2 == 0:                  # a value without its end
            return None
        if self.kept > self.ROOM:
            self._forget()
        markup = pieces[::2]
        parts = _CUT_TEXT.split('"'.join(markup))
        return _Cut(markup, values, parts[1::2], self._skeleton_of(parts[::2]))

    def walk(self, markup: list[str], values: list[str], uris: list | None = None):
        """The node sets, piece by piece; ``uris`` takes the namespaces' values."""
        place, sets, element, within = self.first, {}, None, []
        for piece, value in zip(markup, [*values, ""]):
            step = place.next.get(piece) or self._step(place, piece)
            if step is None:
                return None
            place, todo = step
            for what, of in todo:
                if what == _VALUE:
                    element.attrib[of] = _unescape(value)
                elif what == _START:
                    element = _Element({}, [])
                    within.append(element)
                    for i in of:
                        sets.setdefault(i, []).append(element)
                elif what == _END:
                    within.pop()
                elif what == _CHARS:
                    for e in within:
                        e.texts.append(of)
                elif not _good_uri(value, of):
                    return None
                elif uris is not None:
                    uris.append((value, of))
        return sets if place.ended and place.tag is None else None

    def _skeleton_of(self, parts: list[str]) -> _Skeleton | bool | None:
        """What is known of documents with these parts between texts (values
        left out): nothing the first time, and of those that aren't plain."""
        key = ">\0<".join(parts)
        skeleton = self.skeletons.get(key)
        if skeleton is None and len(key) <= self.SKELETON:
            if hash(key) in self.seen:
                skeleton = self.skeletons[key] = self._skeleton(parts)
                self.kept += 2 * len(key) + 100
            else:
                self.seen.add(hash(key))
                self.kept += 100
        return skeleton

    def _skeleton(self, parts: list[str]) -> _Skeleton | bool:
        """A document whose values and texts are their numbers is walked through,
        which shows where the fields read them; False if it isn't plain, or a
        text that was cut isn't a whole one."""
        whole = parts[0] + "".join(f">{i}<{part}" for i, part in enumerate(parts[1:]))
        comments = len(_COMMENT_WITHOUT_TAGS.findall(whole))
        if whole.count("<!") != comments or whole.count("<") != whole.count(">"):
            return False                          # each > ends a tag or a comment otherwise
        markup, uris = whole.split('"'), []
        sets = self.walk(markup, [str(i) for i in range(len(markup) - 1)], uris)
        return sets is not None and _Skeleton(
            parts, {i: [_Numbers.of(e) for e in found] for i, found in sets.items()},
            [(int(v), prefixed) for v, prefixed in uris])

    @staticmethod
    def fits(cut: _Cut) -> bool:
        """Whether a skeleton is known and texts and namespaces are plain too."""
        if not cut.skeleton:
            return False
        every = " ".join(cut.texts)
        return not ('"' in every or "]]>" in every or ("&" in every and _REFERENCE.search(every)) or (
            not every.isprintable() and _UNUSUAL.search(every))) and all(
            _good_uri(cut.values[i], prefixed) for i, prefixed in cut.skeleton.uris)


def _good_uri(uri: str, prefixed: bool) -> bool:
    return not ("}" in uri or "&" in uri or uri in _RESERVED or (prefixed and not uri))


# ------------------------------------------------- the Arrow UDF ----------

def result_schema(fields: Sequence[Field]) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType()) for f in fields]
        + [T.StructField("err", T.StringType())])


def extract_udf(fields: Sequence[Field], on_error: str = "reject"):
    """Arrow UDF: content string -> struct of all fields plus ``err``.

    ``on_error='reject'`` returns the reason in ``err`` and nulls elsewhere;
    ``on_error='fail'`` raises, failing the task and the job, as the original
    jobs do.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError("on_error must be 'reject' or 'fail'")
    fields = tuple(fields)
    plan = FieldPlan(fields)

    returned = to_arrow_type(result_schema(fields))

    @F.arrow_udf(result_schema(fields))
    def _extract(content: pa.Array) -> pa.Array:
        rows = []
        # Element trees hold no reference cycles and are freed as soon as a
        # document is done; the cycle collector only costs time here.
        gc_was_on = gc.isenabled()
        gc.disable()
        try:
            for doc in content.to_numpy(zero_copy_only=False):
                try:
                    rows.append(evaluate_fields(doc, plan))
                except Reject as e:
                    if on_error == "fail":
                        raise
                    rows.append({"err": str(e)})
        finally:
            if gc_was_on:
                gc.enable()
        return pa.array(rows, type=returned)

    return _extract


def with_extract(df: DataFrame, keep: Sequence[str], content: str, fields: Sequence[Field],
                 name: str, on_error: str = "reject") -> DataFrame:
    """``keep`` columns and the extracted fields as struct ``name``.

    The struct passes through a one-element generator: filters on its fields
    stay above it, so each document is parsed exactly once per plan, while
    filters on kept columns go below the parse and reach the scan.
    """
    parsed = df.select(*keep, extract_udf(fields, on_error)(F.col(content)).alias("__parsed"))
    return parsed.select(*keep, F.explode(F.array("__parsed")).alias(name))
