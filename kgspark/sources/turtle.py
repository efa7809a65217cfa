"""Turtle files as triples, parsed file by file on the executors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
_TOKEN = re.compile(
    r"""\s+|\#[^\n]*|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<long>\"{3}(?:[^"\\]|\\.|"(?!""))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3})"""
    r"""|(?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)"""
    r"""|(?P<num>[+-]?(?:\d+\.\d+|\.\d+|\d+)(?:[eE][+-]?\d+)?(?![\w:]))|(?P<blank>_:[\w.-]*\w)|(?P<name>[\w-]*(?:\.[\w-]+)*:(?:[\w%-]|\\.|\.(?=[\w%-])|:)*|[A-Za-z]+)|(?P<sign>[\[\]().;,])""",
    re.S,
)
_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _text(raw: str) -> str:
    body = raw[3:-3] if raw[:3] in ('"""', "'''") else raw[1:-1]
    return re.sub(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\(.)", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPES[m[3]], body, flags=re.S)


class TurtleParser:
    """Triples (s, p, o, o_kind, o_datatype, o_lang) in order of the text; blank nodes as ``_:name``."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"not Turtle at: {text[at : at + 40]!r}")
            if m.lastgroup:
                self.tokens.append((m.lastgroup, m[0]))
            at = m.end()
        self.at, self.prefixes, self.base, self.blanks, self.triples = 0, {}, "", 0, []

    def _take(self, text: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or text and self.tokens[self.at][1] != text:
            raise ValueError(f"expected {text or 'more'} at token {self.at}")
        self.at += 1
        return self.tokens[self.at - 1]

    def _peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else ""

    def _iri(self, kind: str, raw: str) -> str:
        if kind == "iri":
            own = raw[1:-1]
            return own if re.match(r"[A-Za-z][\w+.-]*:", own) else self.base + own
        prefix, colon, local = raw.partition(":")
        if not colon or prefix not in self.prefixes:
            raise ValueError(f"no term: {raw!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def _node(self):
        kind, raw = self._take()
        if raw == "[":
            self.blanks += 1
            node = ("bnode", f"_:b{self.blanks}", "", "")
            if self._peek() != "]":
                self._properties(node[1])
            self._take("]")
            return node
        if raw == "(":
            items = []
            while self._peek() != ")":
                items.append(self._node())
            self._take(")")
            head = ("iri", RDF + "nil", "", "")
            for item in reversed(items):
                self.blanks += 1
                own = f"_:b{self.blanks}"
                self.triples += [(own, RDF + "first", item[1], item[0], *item[2:]), (own, RDF + "rest", head[1], head[0], "", "")]
                head = ("bnode", own, "", "")
            return head
        if kind in ("str", "long"):
            lang = datatype = ""
            if self.at < len(self.tokens) and self.tokens[self.at][0] == "lang":
                lang = self._take()[1][1:].lower()
            elif self._peek() == "^^":
                self._take()
                datatype = self._iri(*self._take())
            return "literal", _text(raw), datatype, lang
        if kind == "num":
            return "literal", raw, XSD + ("double" if "e" in raw.lower() else "decimal" if "." in raw else "integer"), ""
        if raw in ("true", "false"):
            return "literal", raw, XSD + "boolean", ""
        if kind == "blank":
            return "bnode", raw, "", ""
        return "iri", self._iri(kind, raw), "", ""

    def _properties(self, subject: str) -> None:
        while True:
            kind, raw = self._take()
            p = RDF + "type" if raw == "a" else self._iri(kind, raw)
            while True:
                o = self._node()
                self.triples.append((subject, p, o[1], o[0], o[2], o[3]))
                if self._peek() != ",":
                    break
                self._take()
            while self._peek() == ";":
                self._take()
            if self._peek() in (".", "]", ""):
                return

    def parse(self) -> list[tuple]:
        while self.at < len(self.tokens):
            raw = self._peek()
            if raw.lower() in ("@prefix", "prefix"):
                self._take()
                name = self._take()[1]
                self.prefixes[name.rstrip(":")] = self._iri(*self._take())
                if self._peek() == ".":
                    self._take()
            elif raw.lower() in ("@base", "base"):
                self._take()
                self.base = self._take()[1][1:-1]
                if self._peek() == ".":
                    self._take()
            else:
                subject = self._node()[1]
                if self._peek() != ".":
                    self._properties(subject)
                self._take(".")
        return self.triples


def read_turtle(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """(file, pos, s, p, o, o_kind, o_datatype, o_lang) of Turtle files; blank nodes are named within their file.  A table (file, value) of whole texts is taken as it is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, text in zip(batch["file"], batch["value"]):
                rows = TurtleParser(text).parse()
                name = lambda x: f"{x}@{file}" if x.startswith("_:") else x  # noqa: B023, E731
                yield pd.DataFrame([(file, k, name(s), p, name(o) if kind == "bnode" else o, kind, dt, lang) for k, (s, p, o, kind, dt, lang) in enumerate(rows)], columns=["file", "pos", "s", "p", "o", "o_kind", "o_datatype", "o_lang"])

    files = path.select("file", "value") if isinstance(path, DataFrame) else spark.read.text(path, wholetext=True).selectExpr("_metadata.file_path as file", "value")
    return files.mapInPandas(run, "file string, pos int, s string, p string, o string, o_kind string, o_datatype string, o_lang string")
