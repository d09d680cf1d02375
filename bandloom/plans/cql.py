"""CQL filter text to a filter tree, to a Column, and back to text.

Comparisons, BETWEEN, LIKE (wildcards * and ., escape !, case ignored), IS NULL, IN, BBOX, INTERSECTS with a polygon,
AND / OR / NOT with brackets. AND and OR have one precedence and group from the left.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import geo

TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^']|'')*')|(?P<number>-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)|(?P<op><=|>=|<>|=|<|>)|(?P<mark>[(),])|(?P<word>[A-Za-z_][\w.]*))")


def tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no CQL at {text[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class Parser:
    def __init__(self, text: str):
        self.t, self.i = tokens(text), 0

    def peek(self, *words: str) -> bool:
        return self.i < len(self.t) and self.t[self.i][1].upper() in words

    def take(self, *words: str) -> str:
        if self.i >= len(self.t) or words and not self.peek(*words):
            raise ValueError(f"expected {words or 'more'} in CQL")
        self.i += 1
        return self.t[self.i - 1][1]

    def value(self):
        kind, v = self.t[self.i] if self.i < len(self.t) else ("", "")
        self.take()
        if kind == "text":
            return v[1:-1].replace("''", "'")
        if kind == "number":
            return float(v) if re.search("[.eE]", v) else int(v)
        raise ValueError(f"expected a value, got {v!r}")

    def filter(self) -> dict:
        left = self.term()
        while self.peek("AND", "OR"):
            op = self.take().upper()
            left = {"op": op, "args": [left, self.term()]}
        return left

    def term(self) -> dict:
        if self.peek("NOT"):
            self.take()
            return {"op": "NOT", "args": [self.term()]}
        if self.peek("("):
            self.take()
            f = self.filter()
            self.take(")")
            return f
        if self.peek("BBOX"):
            self.take()
            self.take("(")
            name, box = self.take(), []
            while self.peek(","):
                self.take()
                box.append(self.value())
            self.take(")")
            return {"op": "BBOX", "name": name, "box": box[:4]}
        if self.peek("INTERSECTS"):
            self.take()
            self.take("(")
            name = self.take()
            self.take(",")
            self.take("POLYGON")
            self.take("(")
            self.take("(")
            points = [(self.value(), self.value())]
            while self.peek(","):
                self.take()
                points.append((self.value(), self.value()))
            for _ in range(3):
                self.take(")")
            return {"op": "INTERSECTS", "name": name, "polygon": points[:-1] if points[0] == points[-1] else points}
        name = self.take()
        if self.peek("IS"):
            self.take()
            negate = self.peek("NOT") and bool(self.take())
            self.take("NULL")
            f = {"op": "NULL", "name": name}
            return {"op": "NOT", "args": [f]} if negate else f
        if self.peek("IN"):
            self.take()
            self.take("(")
            values = [self.value()]
            while self.peek(","):
                self.take()
                values.append(self.value())
            self.take(")")
            return {"op": "IN", "name": name, "values": values}
        if self.peek("BETWEEN"):
            self.take()
            lo = self.value()
            self.take("AND")
            return {"op": "BETWEEN", "name": name, "low": lo, "high": self.value()}
        if self.peek("LIKE"):
            self.take()
            return {"op": "LIKE", "name": name, "value": self.value()}
        return {"op": self.take("=", "<>", "<", "<=", ">", ">="), "name": name, "value": self.value()}


def parse(text: str) -> dict:
    p = Parser(text)
    f = p.filter()
    if p.i < len(p.t):
        raise ValueError(f"more than one filter in {text!r}")
    return f


def like_regex(pattern: str, wild: str = "*", single: str = ".", escape: str = "!") -> str:
    """The pattern as a regular expression over the whole value, case ignored."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == escape and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        else:
            out.append(".*" if c == wild else "." if c == single else re.escape(c))
        i += 1
    return "(?is)^" + "".join(out) + "$"


def column(f: dict, x: str = "x", y: str = "y") -> Column:
    """The filter as a Column; spatial ones act on point columns x and y, ids on the column `fid`."""
    op = f["op"]
    if op in ("AND", "OR"):
        a, b = (column(g, x, y) for g in f["args"])
        return a & b if op == "AND" else a | b
    if op == "NOT":
        return ~column(f["args"][0], x, y)
    if op == "BBOX":
        left, bottom, right, top = f["box"]
        return F.col(x).between(left, right) & F.col(y).between(bottom, top)
    if op == "INTERSECTS":
        ring = F.array(*[F.struct(F.lit(float(p)).alias("x"), F.lit(float(q)).alias("y")) for p, q in f["polygon"]])
        return geo.contains(ring, F.col(x), F.col(y))
    if op == "FID":
        return F.col("fid").isin(*f["values"])
    c = F.col(f["name"])
    if op == "NULL":
        return c.isNull()
    if op == "IN":
        return c.isin(*f["values"])
    if op == "BETWEEN":
        return c.between(f["low"], f["high"])
    if op == "LIKE":
        return c.cast("string").rlike(like_regex(f["value"]))
    v = F.lit(f["value"])
    if f.get("match_case") is False and isinstance(f["value"], str):
        c, v = F.lower(c), F.lower(v)
    return {"=": c == v, "<>": c != v, "<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[op]


def write(f: dict) -> str:
    """The filter as CQL text."""
    text = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    op = f["op"]
    if op in ("AND", "OR"):
        return "(" + f" {op} ".join(map(write, f["args"])) + ")"
    if op == "NOT":
        return f"NOT ({write(f['args'][0])})"
    if op == "BBOX":
        return f"BBOX({f['name']},{','.join(map(str, f['box']))})"
    if op == "INTERSECTS":
        ring = [*f["polygon"], f["polygon"][0]]
        return f"INTERSECTS({f['name']}, POLYGON(({','.join(f'{p} {q}' for p, q in ring)})))"
    if op == "NULL":
        return f"{f['name']} IS NULL"
    if op == "IN":
        return f"{f['name']} IN ({', '.join(map(text, f['values']))})"
    if op == "BETWEEN":
        return f"{f['name']} BETWEEN {text(f['low'])} AND {text(f['high'])}"
    return f"{f['name']} {op} {text(f['value'])}"


def styled(rules: list[tuple[dict | None, str, bool]], default: str | None) -> Column:
    """The symbol of a feature: every rule (filter or None, symbol, is_else) that applies overrides those before; else
    rules count only when no other applied; null (hidden) if rules exist and none applies."""
    plain = [(F.lit(True) if f is None else F.coalesce(column(f), F.lit(False)), s) for f, s, other in rules if not other]
    out = F.lit(None).cast("string") if rules else F.lit(default)
    for _, s, other in rules:
        if other:
            out = F.lit(s)
    for cond, s in plain:
        out = F.when(cond, F.lit(s)).otherwise(out)
    return out


def page(order: Column, size: int, number: int) -> Column:
    """Whether the row number (from 1) lies in a page (from 0) of fixed length."""
    return order.between(size * number + 1, size * (number + 1))


def function(name: str, *parameters: Column) -> Column:
    """A filter by a function of the session, by its name."""
    return F.call_function(name, *parameters)
