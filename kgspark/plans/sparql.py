"""A SPARQL subset compiled to DataFrames over a quads table.

Taken: PREFIX; SELECT [DISTINCT] of variables and aggregates; ASK; groups with ``;`` lists and
``a``; GRAPH; OPTIONAL; UNION; sub-SELECT; VALUES; BIND; FILTER; path alternatives; COUNT; GROUP BY,
ORDER BY, LIMIT; STR, STRAFTER, STRSTARTS.  A variable is a column of terms, struct(kind, value,
datatype), so an IRI never equals a literal; results show the terms' values.  Parts of a group are
joined in their order, but inner joins between two OPTIONALs or BINDs go where variables are
shared.  Variables that may be unbound are compatible with anything, as SPARQL has it; they need
another, surely bound variable to join on.  A join without one is refused, as it would be a cross
product.  Patterns outside GRAPH see the merge of all graphs, each triple once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .views import RDF_TYPE

_TOKEN = re.compile(r"""\s+|\#[^\n<>]*\n|(?P<iri><[^<>\s]*>)|(?P<str>"(?:[^"\\]|\\.)*")|(?P<var>\?\w+)|(?P<num>\d+)|(?P<name>[A-Za-z_][\w-]*:[\w-]*|[A-Za-z_]\w*)|(?P<sign>[{}().;,*|=])""")


class _Parser:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"not understood at: {text[at : at + 30]!r}")
            if m.lastgroup:
                self.tokens.append(m[0])
            at = m.end()
        self.at, self.prefixes = 0, {}

    def peek(self, k: int = 0) -> str:
        return self.tokens[self.at + k] if self.at + k < len(self.tokens) else ""

    def word(self) -> str:
        return self.peek().upper()

    def take(self, expected: str | None = None) -> str:
        t = self.peek()
        if not t or expected and t.upper() != expected:
            raise ValueError(f"expected {expected or 'more'}, found {t!r}")
        self.at += 1
        return t

    def term(self) -> tuple[str, str]:
        t = self.take()
        if t[0] == "?":
            return "var", t[1:]
        if t[0] == "<":
            return "iri", t[1:-1]
        if t[0] == '"':
            return "literal", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), t[1:-1])
        if t == "a":
            return "iri", RDF_TYPE
        if ":" in t:
            prefix, _, local = t.partition(":")
            return "iri", self.prefixes[prefix] + local
        raise ValueError(f"no term: {t!r}")

    def query(self):
        while self.word() == "PREFIX":
            self.take()
            name = self.take()
            self.prefixes[name.rstrip(":")] = self.take()[1:-1]
        if self.word() == "ASK":
            self.take()
            if self.word() == "WHERE":
                self.take()
            return "ask", self.group()
        return self.select()

    def select(self):
        self.take("SELECT")
        distinct = self.word() == "DISTINCT" and bool(self.take())
        shown = []
        while self.peek() == "(" or self.peek()[:1] == "?":
            if self.peek() == "(":
                self.take("(")
                e = self.expr()
                self.take("AS")
                shown.append((self.take()[1:], e))
                self.take(")")
            else:
                v = self.take()[1:]
                shown.append((v, ("var", v)))
        if self.word() == "WHERE":
            self.take()
        body, groups, order, limit = self.group(), [], [], None
        while self.word() in ("GROUP", "ORDER", "LIMIT"):
            kind = self.take().upper()
            if kind == "LIMIT":
                limit = int(self.take())
                continue
            self.take("BY")
            while self.peek()[:1] == "?" or self.word() in ("DESC", "ASC"):
                down = self.word() == "DESC"
                if self.word() in ("DESC", "ASC"):
                    self.take()
                    self.take("(")
                    v = self.take()[1:]
                    self.take(")")
                else:
                    v = self.take()[1:]
                groups.append(v) if kind == "GROUP" else order.append((v, down))
        return "select", distinct, shown, body, groups, order, limit

    def expr(self):
        if self.peek()[:1] in "?<\"" or ":" in self.peek():
            return self.term()
        name = self.take().upper()
        self.take("(")
        if name == "COUNT":
            distinct = self.word() == "DISTINCT" and bool(self.take())
            arg = ("star", self.take()) if self.peek() == "*" else self.expr()
            self.take(")")
            return "count", distinct, arg
        args = [self.expr()]
        while self.peek() == ",":
            self.take()
            args.append(self.expr())
        self.take(")")
        return name.lower(), *args

    def group(self):
        self.take("{")
        if self.word() == "SELECT":
            inner = self.select()
            self.take("}")
            return [("sub", inner)]
        parts = []
        while self.peek() != "}":
            w = self.word()
            if w == "OPTIONAL":
                self.take()
                parts.append(("optional", self.group()))
            elif w == "GRAPH":
                self.take()
                name = self.term()
                parts.append(("graph", name, self.group()))
            elif w == "VALUES":
                self.take()
                var, values = self.take()[1:], []
                self.take("{")
                while self.peek() != "}":
                    values.append(self.term())
                self.take("}")
                parts.append(("values", var, values))
            elif w == "BIND":
                self.take()
                self.take("(")
                e = self.expr()
                self.take("AS")
                parts.append(("bind", self.take()[1:], e))
                self.take(")")
            elif w == "FILTER":
                self.take()
                wrapped = self.peek() == "(" and bool(self.take())
                parts.append(("filter", self.expr()))
                if wrapped:
                    self.take(")")
            elif self.peek() == "{":
                union = [self.group()]
                while self.word() == "UNION":
                    self.take()
                    union.append(self.group())
                parts.append(("union", union))
            else:
                s = self.term()
                while True:
                    if self.peek() == "(":
                        self.take("(")
                        paths = [self.term()[1]]
                        while self.peek() == "|":
                            self.take()
                            paths.append(self.term()[1])
                        self.take(")")
                        p = ("any", paths)
                    else:
                        p = self.term()
                    parts.append(("triple", s, p, self.term()))
                    if self.peek() != ";":
                        break
                    self.take(";")
                    if self.peek() in (".", "}"):
                        break
            if self.peek() == ".":
                self.take(".")
        self.take("}")
        return parts


def _term(kind: str, value: Column, datatype: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), (F.lit("") if datatype is None else datatype).alias("datatype"))


class _Rows:
    """Bindings: a column of terms for each variable, and the variables that may be unbound."""

    def __init__(self, df: DataFrame, loose: set[str]):
        self.df, self.loose = df, loose

    @property
    def names(self) -> list[str]:
        return self.df.columns

    def sure(self) -> set[str]:
        return set(self.names) - self.loose


class _Compiler:
    def __init__(self, quads: DataFrame):
        self.quads = quads
        self.merged = quads.select("s", "p", "o", "o_kind", "o_datatype")

    def triple(self, part, graph) -> _Rows:
        _, *terms = part
        conditions, shown, source = F.lit(True), {}, self.merged if graph is None else self.quads
        at = {place: _term("iri", F.col(place)) for place in ("s", "p", "graph")} | {"o": F.struct(F.col("o_kind").alias("kind"), F.col("o").alias("value"), F.col("o_datatype").alias("datatype"))}
        for place, (kind, value) in list(zip("spo", terms)) + ([("graph", graph)] if graph else []):
            if kind == "any":
                conditions &= F.col(place).isin(*value)
            elif kind == "var" and value in shown:
                conditions &= at[place] == shown[value]
            elif kind == "var":
                shown[value] = at[place]
            else:
                conditions &= F.col(place) == value
                if place == "o":
                    conditions &= (F.col("o_kind") == kind) & (F.lit(kind == "iri") | (F.col("o_datatype") == ""))
        found = source.filter(conditions)
        if graph is None:
            found = found.distinct()  # the merge of graphs has each triple once; after the filter, so only what is needed is compared
        return _Rows(found.select(*[c.alias(v) for v, c in shown.items()]), set())

    def join(self, left: _Rows | None, right: _Rows, how: str = "inner", filters=()) -> _Rows:
        if left is None:
            if how == "inner":
                return right
            raise ValueError("OPTIONAL needs something before it")
        shared = [c for c in left.names if c in right.names]
        firm = [c for c in shared if c in left.sure() and c in right.sure()]
        if not firm:
            raise ValueError("patterns that share no surely bound variable would be a cross product")
        r = right.df.select(*[F.col(c).alias(f"_{c}") for c in right.names])
        on = F.lit(True)
        for c in shared:
            on &= (F.col(c) == F.col(f"_{c}")) if c in firm else (F.col(c).isNull() | F.col(f"_{c}").isNull() | (F.col(c) == F.col(f"_{c}")))
        for f in filters:
            on &= self.value(f, lambda v: F.col(v) if v in left.names else F.col(f"_{v}"))
        both = left.df.join(r, on, how)
        out = [(F.coalesce(c, f"_{c}") if c in shared else F.col(c)).alias(c) for c in left.names] + [F.col(f"_{c}").alias(c) for c in right.names if c not in shared]
        own = set(right.names) - set(shared)
        if how == "left":
            loose = left.loose | own
        else:
            loose = (left.loose & right.loose) | (left.loose - set(shared)) | (right.loose & own)
        return _Rows(both.select(*out), loose)

    def joined(self, out: _Rows | None, parts: list[_Rows]) -> _Rows | None:
        """All inner parts with what is there, each as soon as it shares a variable."""
        left = list(parts)
        while left:
            nxt = next((p for p in left if out is None or out.sure() & p.sure()), left[0])
            left.remove(nxt)
            out = self.join(out, nxt)
        return out

    def group(self, parts, graph=None) -> tuple[_Rows, list]:
        """The group's bindings, and its filters that speak of variables from outside."""
        out, pending, filters = None, [], []
        for part in parts:
            kind = part[0]
            if kind == "triple":
                pending.append(self.triple(part, graph))
            elif kind == "graph":
                pending.append(self.closed(part[2], part[1]))
            elif kind == "sub":
                df = self.select(part[1], graph, terms=True)
                pending.append(_Rows(df, self.loose_of(part[1], graph)))
            elif kind == "union":
                own = [self.closed(g, graph) for g in part[1]]
                df, names = own[0].df, {c for g in own for c in g.names}
                for g in own[1:]:
                    df = df.unionByName(g.df, allowMissingColumns=True)
                pending.append(_Rows(df, {c for c in names if any(c in g.loose or c not in g.names for g in own)}))
            elif kind == "values":
                spark = self.quads.sparkSession
                table = spark.createDataFrame([((k, v, ""),) for k, v in part[2]], f"`{part[1]}` struct<kind:string,value:string,datatype:string>")
                pending.append(_Rows(F.broadcast(table), set()))
            elif kind == "filter":
                filters.append(part[1])
            else:
                out, pending = self.joined(out, pending), []
                if kind == "optional":
                    inner, outer = self.group(part[1], graph)
                    out = self.join(out, inner, "left", outer)
                elif part[1] in out.names:
                    raise ValueError(f"?{part[1]} is bound already")
                else:
                    out = _Rows(out.df.withColumn(part[1], self.term(part[2])), out.loose | ({part[1]} if part[2][0] not in ("iri", "literal") else set()))
        out = self.joined(out, pending)
        if out is None:
            raise ValueError("an empty group")
        known = [f for f in filters if self.variables(f) <= set(out.names)]
        for f in known:
            out = _Rows(out.df.filter(self.value(f)), out.loose)
        return out, [f for f in filters if f not in known]

    def closed(self, parts, graph=None) -> _Rows:
        out, open_ = self.group(parts, graph)
        # a filter on a variable that is bound nowhere is an error, which drops every solution
        return _Rows(out.df.filter(F.lit(False)), out.loose) if open_ else out

    def variables(self, e) -> set[str]:
        kind, *args = e
        if kind == "var":
            return {args[0]}
        return set().union(*(self.variables(a) for a in args if isinstance(a, tuple))) if kind not in ("iri", "literal") else set()

    def term(self, e) -> Column:
        """An expression as a term; null if it has no value."""
        kind, *args = e
        if kind == "var":
            return F.col(args[0])
        if kind in ("iri", "literal"):
            return _term(kind, F.lit(args[0]))
        value = self.value(e)
        return F.when(value.isNotNull(), _term("literal", value))

    def value(self, e, column=F.col) -> Column:
        kind, *args = e
        if kind == "var":
            return column(args[0])["value"]
        if kind in ("iri", "literal"):
            return F.lit(args[0])
        if kind == "str":
            return self.value(args[0], column)
        if kind == "strstarts":
            return self.value(args[0], column).startswith(self.value(args[1], column))
        if kind == "strafter":
            text, mark = self.value(args[0], column), self.value(args[1], column)
            at = F.instr(text, args[1][1])
            return F.when(text.isNull(), None).when(at > 0, F.substr(text, at + F.length(mark))).otherwise("")
        raise ValueError(f"no such function: {kind}")

    def loose_of(self, query, graph) -> set[str]:
        rows = self.closed(query[3], graph)
        return {name for name, e in query[2] if e[0] == "var" and (e[1] in rows.loose or e[1] not in rows.names)}

    def select(self, query, graph=None, terms: bool = False) -> DataFrame:
        """The bindings shown, as values or as terms."""
        _, distinct, shown, body, groups, order, limit = query
        rows = self.closed(body, graph).df
        named = {v for _, e in shown for v in (self.variables(e[2]) if e[0] == "count" and e[2][0] != "star" else set() if e[0] == "count" else self.variables(e))} | set(groups)
        nothing = F.lit(None).cast("struct<kind:string,value:string,datatype:string>")
        rows = rows.withColumns({v: nothing for v in named if v not in rows.columns}) if named - set(rows.columns) else rows
        counts = [(name, e) for name, e in shown if e[0] == "count"]
        if counts or groups:
            one = lambda e: F.lit(1) if e[2][0] == "star" else self.term(e[2])
            rows = rows.groupBy(*groups).agg(*[(F.count_distinct(one(e)) if e[1] else F.count(one(e))).alias(name) for name, e in counts])
            rows = rows.select(*[F.col(name) if e[0] == "count" else F.col(e[1]).alias(name) for name, e in shown])
        else:
            rows = rows.select(*[self.term(e).alias(name) for name, e in shown])
        rows = rows.distinct() if distinct else rows
        plain = [name for name, e in shown if e[0] != "count"]
        if terms and not order and limit is None:
            number = lambda n: F.when(F.col(n).isNotNull(), _term("literal", F.col(n).cast("string"), F.lit("http://www.w3.org/2001/XMLSchema#integer")))
            return rows.select(*[F.col(n) if n in plain else number(n).alias(n) for n in rows.columns])
        rows = rows if terms else rows.select(*[F.col(n)["value"].alias(n) if n in plain else F.col(n) for n in rows.columns])
        if order:
            ties = [c for c in rows.columns if c not in [v for v, _ in order]] if limit is not None else []
            rows = rows.orderBy(*[F.col(v).desc_nulls_last() if down else F.col(v).asc_nulls_first() for v, down in order], *ties)
        return rows if limit is None else rows.limit(limit)


def sparql(quads: DataFrame, text: str) -> DataFrame:
    """The bindings of a SELECT; for ASK one row (answer boolean)."""
    query = _Parser(text).query()
    compiler = _Compiler(quads)
    if query[0] == "ask":
        return compiler.closed(query[1]).df.limit(1).agg((F.count("*") > 0).alias("answer"))
    return compiler.select(query)
