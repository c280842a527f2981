"""Elements of parsed XML: paths that bind prefixes, mark-up and values of nodes."""

from __future__ import annotations

import re
from collections.abc import Mapping
from xml.dom import minidom

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = re.compile(r"(//?)((?:[\w.\-]+:)?(?:[\w.\-]+|\*))(?:\[(\d+)\])?")
_LAST_ELEMENT = re.compile(r"(?:^|/)(?:[\w.\-]+:)?(?:[\w.\-]+|\*)(?:\[[^\[\]]*\])?$")


def is_element_path(path: str) -> bool:
    """Whether a path has steps of ``/name``, ``//name``, ``*`` and ``[n]`` only, so that it selects elements."""
    return bool(path) and STEP.sub("", path) == ""


def value_path(path: str) -> str:
    """The path whose result are values: elements give their text. Spark's ``xpath`` gives null for elements."""
    parts = re.findall(r"(?:[^|'\"]|'[^']*'|\"[^\"]*\")+", path)
    return "|".join(f"{p.rstrip()}/text()" if _LAST_ELEMENT.search(p.rstrip()) else p for p in parts)


def select(document, path: str, namespaces: Mapping[str, str] | None = None) -> list:
    """Elements at a path of ``/name``, ``//name``, ``*`` and ``[n]`` steps.

    A prefix that ``namespaces`` binds selects elements of that namespace; any other prefix is ignored.
    """
    if not is_element_path(path):
        raise ValueError(f"unsupported path {path}")
    bound = namespaces or {}
    found = [document]
    for axis, name, index in STEP.findall(path):
        prefix, _, local = name.rpartition(":")
        nodes = []
        for node in found:
            if axis == "/":
                inner = [c for c in node.childNodes if c.nodeType == c.ELEMENT_NODE]
            else:
                inner = list(node.getElementsByTagName("*"))
            inner = [c for c in inner if local == "*" or c.tagName.rpartition(":")[2] == local]
            if prefix in bound:
                inner = [c for c in inner if c.namespaceURI == bound[prefix]]
            nodes += inner[int(index) - 1 : int(index)] if index else inner
        found = list(dict.fromkeys(nodes))
    return found


def texts_of(node) -> list:
    """Text and CDATA nodes below a node, in document order."""
    out = []
    for child in node.childNodes:
        if child.nodeType in (child.TEXT_NODE, child.CDATA_SECTION_NODE):
            out.append(child)
        else:
            out += texts_of(child)
    return out


def written(document, text: str) -> str:
    """A changed document as text, with an XML declaration only if ``text`` had one."""
    if text.lstrip().startswith("<?xml"):
        return document.toxml()
    return "".join(n.toxml() for n in document.childNodes)


def _declared(node) -> str:
    """Mark-up of an element, with the namespaces declared that are in scope."""
    own = set(node.attributes.keys()) if node.attributes else set()
    above, parent = {}, node.parentNode
    while parent is not None and parent.nodeType == parent.ELEMENT_NODE:
        for name, value in parent.attributes.items():
            if (name == "xmlns" or name.startswith("xmlns:")) and name not in own:
                above.setdefault(name, value)
        parent = parent.parentNode
    copy = node.cloneNode(True)
    for name, value in sorted(above.items()):
        copy.setAttribute(name, value)
    return copy.toxml()


def _udf(kind: str, of, path: str, namespaces: Mapping[str, str] | None):
    bound = dict(namespaces or {})

    def one(text: str | None):
        return None if text is None else of(select(minidom.parseString(text.encode()), path, bound))

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return run


def element_markup(text: Column, path: str, namespaces: Mapping[str, str] | None = None) -> Column:
    """Mark-up of each element at a path. Runs in Python; the text must be well-formed."""
    return _udf("array<string>", lambda nodes: [_declared(n) for n in nodes], path, namespaces)(text)


def element_values(text: Column, path: str, namespaces: Mapping[str, str] | None = None) -> Column:
    """Text of each element at a path, that of its descendants included."""
    return _udf("array<string>", lambda nodes: ["".join(t.data for t in texts_of(n)) for n in nodes], path, namespaces)(text)


def has_element(text: Column, path: str, namespaces: Mapping[str, str] | None = None) -> Column:
    """Whether a path selects an element."""
    return _udf("boolean", bool, path, namespaces)(text)
