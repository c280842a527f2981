"""Edits of XML and JSON by place: what a rule selects is found as ranges of the text, and all else is kept as it stands."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from xml.parsers import expat

from docspark.functions.tree import STEP

#: How a new value is written in its place.
XML_TEXT, IN_DOUBLE, IN_SINGLE, JSON_STRING = range(4)

_TOKEN = re.compile(
    r"(?P<comment><!--.*?-->)|(?P<cdata><!\[CDATA\[(?P<data>.*?)\]\]>)|(?P<pi><\?.*?\?>)"
    r"|(?P<doctype><!DOCTYPE(?>\[(?>(?><!--.*?-->|<\?.*?\?>|\"[^\"]*\"|'[^']*'|[^\]\"'])*)\]|\"[^\"]*\"|'[^']*'|[^>\"'\[])*>)"
    r"|</[^>]*>|<(?P<name>[^\s/>]+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\s+([^\s=]+)\s*=\s*(\"[^\"]*\"|'[^']*')")


class Edits:
    """Ranges to cut, ranges to write anew, and values to change, of one text."""

    def __init__(self, text: str):
        self.text = text
        self.fixed: dict[tuple[int, int], str] = {}
        self.values: dict[tuple[int, int], tuple[str, int, list[int]]] = {}

    def cut(self, start: int, end: int, instead: str = "") -> None:
        self.fixed[start, end] = instead

    def change(self, start: int, end: int, value: str, form: int, rule: int) -> None:
        self.values.setdefault((start, end), (value, form, []))[2].append(rule)

    def pieces(self) -> tuple[list[str], list[tuple[str, int, list[int]]]] | None:
        """(text before, between and after the values, the values in order); None if all stays. What lies in a cut goes with it."""
        if not self.fixed and not self.values:
            return None
        kept, parts, piece, at = [], [], [], 0
        # of ranges that begin together the longest comes first
        for start, end in sorted({**self.fixed, **self.values}, key=lambda r: (r[0], -r[1])):
            if start < at:
                continue
            piece.append(self.text[at:start])
            if (start, end) in self.fixed:
                piece.append(self.fixed[start, end])
            else:
                kept.append("".join(piece))
                piece = []
                parts.append(self.values[start, end])
            at = end
        kept.append("".join(piece) + self.text[at:])
        return kept, parts


class _Element:
    __slots__ = ("name", "local", "uri", "rest", "start", "inner", "close", "end", "parent", "inside", "marks")

    def __init__(self, name, uri, rest, start, inner, parent):
        self.name, self.local, self.uri, self.rest = name, name.rpartition(":")[2], uri, rest
        self.start, self.inner, self.parent = start, inner, parent
        self.close = self.end = inner
        # child elements and texts in order; comments and instructions
        self.inside: list = []
        self.marks: list[tuple[int, int]] = []

    def elements(self) -> list[_Element]:
        return [x for x in self.inside if isinstance(x, _Element)]

    def below(self):
        todo = list(reversed(self.inside))
        while todo:
            x = todo.pop()
            yield x
            if isinstance(x, _Element):
                todo += reversed(x.inside)


class Xml:
    """A parsed document whose elements and texts know their places."""

    def __init__(self, text: str):
        self.text, self.doctype = text, ""
        parser = expat.ParserCreate("UTF-8", namespace_separator=" ")
        parser.EntityDeclHandler = self._entity
        self.attributes_declared = False
        parser.AttlistDeclHandler = self._attributes
        parser.Parse(text.encode(), True)  # raises if it is not well-formed
        self.root = _Element("", "", "", 0, 0, None)
        self.root.end = self.root.close = len(text)
        self._read()

    def _entity(self, name, is_parameter, value, base, system, public, notation) -> None:
        if not is_parameter and value and "<" in value:
            raise ValueError(f"entity {name} holds elements: redaction cannot follow it")

    def _attributes(self, *declared) -> None:
        self.attributes_declared = True

    def _read(self) -> None:
        text, at, here = self.text, 0, self.root
        scopes: list[dict[str, str]] = [{}]
        for m in _TOKEN.finditer(text):
            if m.start() > at and here is not self.root:
                here.inside.append((at, m.start(), None))
            at = m.end()
            if m["name"]:
                rest, known = m["rest"], scopes[-1]
                if "xmlns" in rest:
                    own = {a[1]: self.plain(a[2][1:-1]) for a in _ATTRIBUTE.finditer(rest) if a[1] == "xmlns" or a[1].startswith("xmlns:")}
                    known = {**known, **{k[6:]: v for k, v in own.items()}}
                prefix = m["name"].rpartition(":")[0]
                child = _Element(m["name"], known.get(prefix, ""), rest, m.start(), at, here)
                here.inside.append(child)
                if rest.endswith("/"):
                    child.close = child.end = at
                else:
                    here = child
                    scopes.append(known)
            elif m["doctype"]:
                self.doctype = m[0]
            elif m["cdata"]:
                here.inside.append((m.start(), at, m["data"]))
            elif m["comment"] or m["pi"]:
                here.marks.append((m.start(), at))
            else:
                here.close, here.end = m.start(), at
                here = here.parent
                scopes.pop()

    def plain(self, raw: str, attribute: bool = False) -> str:
        """Text as a parser gives it: entities resolved, line ends and white space of attributes as usual."""
        if "&" not in raw and "\r" not in raw and not (attribute and re.search(r"[\n\t]", raw)):
            return raw
        found: list[str] = []
        parser = expat.ParserCreate("UTF-8")
        parser.CharacterDataHandler = found.append
        parser.StartElementHandler = lambda name, attrs: found.extend(attrs.values())
        quote = "'" if '"' in raw else '"'
        body = f"<x a={quote}{raw}{quote}/>" if attribute else f"<x>{raw}</x>"
        # the document type names its root, which an unvalidated document need not have
        parser.Parse((self.doctype + body).encode(), True)
        return "".join(found)

    def select(self, path: str, namespaces: Mapping[str, str]) -> list[_Element]:
        """Elements at a path of ``/name``, ``//name``, ``*`` and ``[n]`` steps; unbound prefixes are ignored."""
        found = [self.root]
        for axis, name, index in STEP.findall(path):
            prefix, _, local = name.rpartition(":")
            nodes = []
            for node in found:
                inner = node.elements() if axis == "/" else [x for x in node.below() if isinstance(x, _Element)]
                inner = [x for x in inner if local in ("*", x.local) and (prefix not in namespaces or x.uri == namespaces[prefix])]
                nodes += inner[int(index) - 1 : int(index)] if index else inner
            found = list(dict.fromkeys(nodes))
        return found


def _attribute_spans(element: _Element):
    """(name, start of the white space before it, start and end of the value with its quotes)."""
    base = element.start + 1 + len(element.name)
    for a in _ATTRIBUTE.finditer(element.rest):
        yield a[1], base + a.start(), base + a.start(2), base + a.end(2)


def _conceal_elements(xml: Xml, edits: Edits, nodes: Sequence[_Element]) -> None:
    for node in nodes:
        if node.parent is xml.root:
            raise ValueError("a rule cannot remove the root of a document")
        edits.cut(node.start, node.end)
        node.parent.inside.remove(node)
    for parent in dict.fromkeys(n.parent for n in nodes):
        if not parent.inside and not parent.marks and parent.end > parent.inner:
            # nothing is left inside: an empty tag
            edits.cut(parent.inner - 1, parent.end, "/>")


def xml_edits(text: str, rules: Sequence[tuple[int, str, bool, Mapping[str, str]]]) -> Edits:
    """Edits for rules (number, path, whether it conceals, namespaces), applied in order.

    A changed element loses the comments and processing instructions below it, and its start tag gets double quotes.
    """
    xml, edits = Xml(text), Edits(text)
    for number, path, conceal, namespaces in rules:
        path, _, attribute = path.partition("/@")
        nodes = xml.select(path, namespaces)
        if attribute:
            if xml.attributes_declared:
                raise ValueError("a document type that declares attributes may hide values that a rule cannot reach")
            for node in nodes:
                for name, white, start, end in _attribute_spans(node):
                    if name == attribute and (white, end) not in edits.fixed:
                        if conceal:
                            edits.cut(white, end)
                        else:
                            form = IN_DOUBLE if text[start] == '"' else IN_SINGLE
                            edits.change(start + 1, end - 1, xml.plain(text[start + 1 : end - 1], True), form, number)
        elif conceal:
            _conceal_elements(xml, edits, nodes)
        else:
            done = set()
            for node in nodes:
                for name, _, start, end in _attribute_spans(node):
                    if text[start] == "'" and (start + 1, end - 1) not in edits.values:
                        edits.cut(start, end, '"' + text[start + 1 : end - 1].replace('"', "&quot;") + '"')
                for x in [node, *node.below()]:
                    if isinstance(x, _Element):
                        for start, end in x.marks:
                            edits.cut(start, end)
                        continue
                    start, end, data = x
                    if (start, end) in done:
                        continue
                    done.add((start, end))
                    value = xml.plain(text[start:end]) if data is None else data.replace("\r\n", "\n").replace("\r", "\n")
                    if value.strip():
                        edits.change(start, end, value, XML_TEXT, number)
    return edits


_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[{}\[\],:]|[^\s{}\[\],:"]+')
JSON_STEP = re.compile(r"\.([A-Za-z_][\w\-]*)|\['([^']*)'\]|\[(\*)\]")


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


class _Node:
    """A JSON value: its range, and members (start, name, value) of an object or list."""

    __slots__ = ("start", "end", "kind", "members")

    def __init__(self, start: int, end: int, kind: str):
        self.start, self.end, self.kind, self.members = start, end, kind, []


def _json_tree(text: str) -> _Node:
    # raises if it is no JSON; numbers stay as they are written
    json.loads(text, parse_float=str, parse_int=str, parse_constant=_refuse)
    top = _Node(0, len(text), "[")
    stack, name, begin = [top], None, 0
    for m in _JSON_TOKEN.finditer(text):
        token, here = m[0], stack[-1]
        if token in ",:":
            continue
        if token in "}]":
            here.end = m.end()
            stack.pop()
            continue
        if here.kind == "{" and name is None:
            name, begin = json.loads(token), m.start()
            continue
        node = _Node(m.start(), m.end(), token if token in "{[" else "v")
        here.members.append((begin if here.kind == "{" else m.start(), name, node))
        name = None
        if node.kind != "v":
            stack.append(node)
    return top


def json_edits(text: str, rules: Sequence[tuple[int, str, bool, Mapping[str, str]]]) -> Edits:
    """Edits for rules (number, path, whether it conceals, -), applied in order. Of a repeated name all members are meant."""
    top, edits = _json_tree(text), Edits(text)
    gone: set[int] = set()
    for number, path, conceal, _ in rules:
        found = [(top, 0)]
        for name, quoted, each in JSON_STEP.findall(path):
            step = []
            for holder, k in found:
                value = holder.members[k][2]
                if each:
                    step += [(value, i) for i in range(len(value.members)) if value.kind == "["]
                else:
                    # a name inside a list means that of its members
                    inner = [m[2] for m in value.members] if value.kind == "[" else [value]
                    step += [(x, i) for x in inner if x.kind == "{" for i, m in enumerate(x.members) if m[1] == (name or quoted)]
            found = [(h, k) for h, k in step if id(h.members[k][2]) not in gone]
        if conceal:
            gone.update(id(h.members[k][2]) for h, k in found)
            for holder in {id(h): h for h, _ in found}.values():
                _without(edits, holder, gone)
            continue
        todo = [h.members[k][2] for h, k in found]
        while todo:
            node = todo.pop()
            if id(node) in gone:
                continue
            if node.kind != "v":
                todo += [m[2] for m in node.members]
            elif (raw := text[node.start : node.end]) != "null":
                edits.change(node.start, node.end, json.loads(raw) if raw[0] == '"' else raw, JSON_STRING, number)
    return edits


def _without(edits: Edits, holder: _Node, gone: set[int]) -> None:
    """Cut the members that go, each with the comma that sets it apart."""
    kept = False
    for i, (start, _, node) in enumerate(holder.members):
        if id(node) not in gone:
            kept = True
        elif kept:
            edits.cut(holder.members[i - 1][2].end, node.end)
        else:
            edits.cut(start, holder.members[i + 1][0] if i + 1 < len(holder.members) else node.end)
