"""XML of any quality to a table of its nodes.

One pass of a tolerant parser per document, in Python workers over Arrow batches,
makes an array of nodes; everything after it is higher-order expressions on that
array in the JVM (see ``Nodes``). A node's place in the array is its id, and ``end`` is
the id after its last descendant, so a subtree is a slice of the array; its ``attrs``
attributes come right after it. Well-formed documents give the tree that a strict
parser gives. In broken ones unknown end tags are ignored, open elements end with
their parent or the text, and a tag cut off at the end is dropped.

Defined results: null and blank texts, and texts without a tag, have no nodes.
Comments, processing instructions and DOCTYPE are no nodes. An element's value is
its text before the first child.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import ship, spread

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<\?.*?(?:\?>|\Z)|<!DOCTYPE[^>\[]*(?:\[.*?\])?[^>]*(?:>|\Z)|</(?P<end>[^\s>/]+)\s*>|<(?P<tag>[A-Za-z_][^\s>/]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*?)(?P<empty>/?)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(\"([^\"]*)\"|'([^']*)'|[^\s\"'>]+)", re.S)

_VALUE, _END = 8, 9
SCHEMA = "array<struct<node_id:int,parent_id:int,kind:string,name:string,qname:string,path:string,q_path:string,dewey:string,value:string,end:int,attrs:int>>"


def parse_nodes(text: str | None) -> tuple[list[tuple], dict[str, str]]:
    """All elements and attributes in document order, and the namespaces by prefix."""
    nodes: list[list] = []
    spaces: dict[str, str] = {}
    if not text:
        return [], spaces
    #: node id, written tag, local path, qualified path, dewey, children so far, prefixes in scope, text open
    stack: list[list] = []
    known: set[str] = set()
    at = 0
    roots = 0

    def say(s: str) -> None:
        if stack and stack[-1][7] and s:
            v = nodes[stack[-1][0]]
            v[_VALUE] = (v[_VALUE] or "") + s

    def close(k: int) -> None:
        for open_ in stack[k:]:
            nodes[open_[0]][_END] = len(nodes)
        del stack[k:]

    def declare(prefix: str, uri: str) -> None:
        if uri in known:
            return
        known.add(uri)
        name = prefix or "default"
        spaces[name if name not in spaces else f"{name}{len(spaces)}"] = uri

    for m in _MARK.finditer(text):
        say(html.unescape(text[at : m.start()]))
        at = m.end()
        if m["cdata"] is not None:
            say(m["cdata"])
        elif m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][1] == m["end"]:
                    close(k)
                    break
        elif m["tag"]:
            pairs = [(a[0], html.unescape(a[2] if a[2] or a[1][:1] == '"' else a[3] if a[3] or a[1][:1] == "'" else a[1])) for a in _ATTR.findall(m["attrs"] or "")]
            scope = dict(stack[-1][6]) if stack else {"xml": "http://www.w3.org/XML/1998/namespace"}
            for k, v in pairs:
                if k == "xmlns" or k.startswith("xmlns:"):
                    scope[k[6:]] = v
                    declare(k[6:], v)
            prefix, _, local = m["tag"].rpartition(":")
            uri = scope.get(prefix, "")
            qname = f"{{{uri}}}{local}" if uri else local
            if stack:
                up = stack[-1]
                up[7] = False
                up[5] += 1
                parent, path, qpath, dewey = up[0], f"{up[2]}/{local}", f"{up[3]}/{qname}", f"{up[4]}.{up[5]}"
            else:
                roots += 1
                parent, path, qpath, dewey = -1, local, qname, str(roots)
            me = len(nodes)
            nodes.append([me, parent, "elem", local, qname, path, qpath, dewey, None, 0, 0])
            for k, v in pairs:
                if k == "xmlns" or k.startswith("xmlns:"):
                    continue
                ap, _, al = k.rpartition(":")
                auri = scope.get(ap, "") if ap else ""
                aq = f"{{{auri}}}{al}" if auri else al
                nodes.append([len(nodes), me, "attr", al, aq, f"{path}/@{al}", f"{qpath}/@{aq}", f"{dewey}.0", v, len(nodes) + 1, 0])
            nodes[me][_END], nodes[me][_END + 1] = len(nodes), len(nodes) - me - 1
            if not m["empty"]:
                stack.append([me, m["tag"], path, qpath, dewey, 0, scope, True])
    say(html.unescape(text[at:].partition("<")[0]))
    close(0)
    return [tuple(n) for n in nodes], spaces


def shred(docs: DataFrame, content: str = "content", keep: list[str] | None = None) -> DataFrame:
    """Adds nodes and namespaces to the kept columns. Narrow: nothing is shuffled."""
    ship(docs.sparkSession)

    @F.pandas_udf(f"struct<nodes:{SCHEMA},namespaces:map<string,string>>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("node_id", "parent_id", "kind", "name", "qname", "path", "q_path", "dewey", "value", "end", "attrs")
        for b in batches:
            got = [parse_nodes(t if isinstance(t, str) else None) for t in b]
            yield pd.DataFrame({"nodes": [[dict(zip(names, n)) for n in ns] for ns, _ in got], "namespaces": [sp for _, sp in got]})

    out = spread(docs).withColumn("_x", parse(F.col(content)))
    cols = [F.col(c) for c in (keep or docs.columns)]
    return out.select(*cols, F.col("_x.nodes").alias("nodes"), F.col("_x.namespaces").alias("namespaces"))


def node_rows(shredded: DataFrame, doc_id: str) -> DataFrame:
    """The nodes as rows (<doc_id>, node_id, ..., value)."""
    return shredded.select(doc_id, F.inline("nodes"))


class Nodes:
    """Path expressions over a column of nodes, absolute or below a context node.

    ``nodes`` is a document's whole array, or a slice of it that begins with ``first``;
    below a context node only its own slice is looked at, so reading all items of a
    document takes time in proportion to the document, not to its square.
    """

    def __init__(self, nodes: Column, root: Column | None = None, first: Column | None = None):
        self.nodes, self.root, self.first = nodes, root, first

    def _under(self) -> Column:
        """All nodes, or those below the context."""
        r = self.root
        if r is None:
            return self.nodes
        skip = r["node_id"] if self.first is None else r["node_id"] - self.first
        return F.slice(self.nodes, skip + 2, r["end"] - r["node_id"] - 1)

    def elems(self, *tags: str) -> Column:
        """All elements at a path of local names."""
        p = "/".join(tags)
        if self.root is None:
            return F.filter(self.nodes, lambda n: (n["kind"] == "elem") & (n["path"] == p))
        r = self.root
        return F.filter(self._under(), lambda n: (n["kind"] == "elem") & (n["path"] == F.concat(r["path"], F.lit("/" + p))))

    def named(self, *names: str) -> Column:
        """All elements of these local names, at any depth below the context."""
        return F.filter(self._under(), lambda n: (n["kind"] == "elem") & n["name"].isin(*names))

    def texts(self, *tags: str) -> Column:
        """The trimmed, non-empty texts at a path, runs of white space as one blank."""
        return F.filter(F.transform(self.elems(*tags), text_of), lambda v: v.isNotNull() & (v != ""))

    def text(self, *tags: str) -> Column:
        """The first text at a path, null if there is none."""
        return F.get(self.texts(*tags), F.lit(0))

    def attrs(self, *tags: str) -> Column:
        """The values of an attribute: the last tag is its name."""
        *up, name = tags
        own = self.elems(*up) if up or self.root is None else F.array(self.root)
        return F.transform(F.filter(F.flatten(F.transform(own, self._attributes)), lambda n: n["name"] == name), text_of)

    def _attributes(self, e: Column) -> Column:
        return F.slice(self.nodes, (e["node_id"] if self.first is None else e["node_id"] - self.first) + 2, e["attrs"])

    def attributes(self) -> Column:
        """All attributes of the context."""
        return self._attributes(self.root)

    def attr(self, *tags: str) -> Column:
        return F.get(self.attrs(*tags), F.lit(0))

    def at(self, node: Column) -> "Nodes":
        return Nodes(self.nodes, node, self.first)

    def children(self) -> Column:
        """The context's child elements."""
        r = self.root
        return F.filter(self._under(), lambda n: (n["kind"] == "elem") & (n["parent_id"] == r["node_id"]))

    def parent_of(self, node: Column) -> Column:
        """An element's parent, null for roots; only where the whole document is at hand."""
        return F.when(node["parent_id"] >= 0, F.get(self.nodes, node["parent_id"]))


def text_of(node: Column) -> Column:
    """A node's text, trimmed, runs of white space as one blank."""
    return F.trim(F.regexp_replace(node["value"], r"\s+", " "))


def each(docs: DataFrame, found: Column, keep: list[str], **more) -> DataFrame:
    """A row for each of the found elements: keep, e (the element), nodes (it and what is below it), and more.

    The slices are cut before the rows are made, so no row carries the whole document.
    ``more`` are functions of the element, evaluated where the whole document is at hand.
    """
    nodes = F.col("nodes")
    cut = F.transform(found, lambda e: F.struct(e.alias("e"), F.slice(nodes, e["node_id"] + 1, e["end"] - e["node_id"]).alias("nodes"), *[f(e).alias(k) for k, f in more.items()]))
    return docs.select(*keep, F.explode(cut).alias("_x")).select(*keep, "_x.*")


def at_each() -> Nodes:
    """The nodes of a row of ``each``."""
    return Nodes(F.col("nodes"), F.col("e"), F.col("e.node_id"))


def tagged_texts(nodes: Column, exclude: tuple[str, ...] = ()) -> Column:
    """array<struct<tag, text>> of all texts and attributes; excluded elements' subtrees are left out."""
    kept = nodes
    if exclude:
        steps = F.array(*[F.lit(x) for x in exclude])
        kept = F.filter(nodes, lambda n: ~F.arrays_overlap(F.split(n["path"], "/"), steps))
    full = F.filter(kept, lambda n: F.coalesce(F.trim(n["value"]), F.lit("")) != "")
    return F.transform(full, lambda n: F.struct(n["path"].alias("tag"), F.trim(n["value"]).alias("text")))


def xml_values(nodes: Column) -> Column:
    """array<struct<xpath, value>> with qualified paths: any XML, without knowing its standard."""
    full = F.filter(nodes, lambda n: F.coalesce(F.trim(n["value"]), F.lit("")) != "")
    return F.transform(full, lambda n: F.struct(n["q_path"].alias("xpath"), text_of(n).alias("value")))


_HREF = re.compile(r"<a\b[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I | re.S)
_SKIP = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->", re.I | re.S)


def html_text(docs: DataFrame, text: str, keep: list[str], links: bool = True) -> DataFrame:
    """Adds plain and links: a text's HTML as words, and the targets of its anchors."""
    ship(docs.sparkSession)

    @F.pandas_udf("struct<plain:string,links:array<string>>")
    def strip(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            plain, hrefs = [], []
            for t in b:
                t = t if isinstance(t, str) else ""
                hrefs.append([html.unescape(x or y) for x, y in _HREF.findall(t)] if links else [])
                plain.append(" ".join(html.unescape(re.sub(r"<[^<>]*>", " ", _SKIP.sub(" ", t))).split()))
            yield pd.DataFrame({"plain": plain, "links": hrefs})

    return docs.withColumn("_h", strip(F.col(text))).select(*keep, F.col("_h.plain").alias("plain"), F.col("_h.links").alias("links"))
