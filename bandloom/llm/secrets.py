"""Secret scans: three fixed patterns, and a guess-cost test of values in a credential context.

The guess cost of a value is the least cost over all ways to cut it into dictionary words, dates, repeats, keyboard
walks and spans to be searched by brute force, found by dynamic programming over end positions. A part costs the
logarithm to base 10 of its guesses, and that of the five kinds to choose from. Costs of repeats and walks do not depend
on where they end, so every cut of every value is weighed in time linear in its length. Values that cost at least
MIN_GUESSES stand as secrets of kind guess.

The dictionary has the words below, then the words of three letters or more in a tokenizer's vocabulary file, a
parameter, by their ids: those of a byte-pair vocabulary fall in frequency.
"""

from __future__ import annotations

import functools
import json
import math
import re
from pathlib import Path

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs of 32 or more
#: A credential name, a separator, a value: to the closing quote of its line, else to white space but for marks at the
#: end; or the password of a URL, to the last @ of its authority.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth(?:orization)?|bearer|(?:api|access|private|signing|encryption|client)[_ -]?(?:key|secret))["']?\x20*(?::=|=>|[:=])\x20*(?:bearer\x20+)?(?:"((?:\\.|[^"\\\r\n])+)"|'((?:\\.|[^'\\\r\n])+)'|["']?(\S*[^\s"'<>,;]))|(?<=[a-z0-9+.-])://[^\s:/@]*:([^\s/]+)(?=@)""",
    re.I | re.A,
)
ASSIGN_GATE = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
CONTEXT_GATE = (b"pass", b"pwd", b"pin", b"secret", b"token", b"credential", b"auth", b"bearer", b"key", b"://")
SEPARATED = re.compile(rb"[:=]")
SCHEMA = "doc_id long, spans array<struct<kind: string, start: long, end: long, log_guesses: double>>"
MIN_GUESSES = 10.0  # log10
#: Common password words by falling frequency; a word's guesses are its rank.
WORDS = """password qwerty dragon monkey letmein football baseball welcome master shadow sunshine princess login admin
abc iloveyou trust batman superman hello freedom whatever secret test guest root user default changeme summer winter
spring autumn love money hunter ranger soccer hockey killer george pepper jordan harley andrew charlie thomas michael
jennifer jessica daniel ashley ginger cookie banana orange purple yellow silver golden diamond flower tiger eagle lion
bear wolf horse mustang corvette ferrari mercedes computer internet server database system network windows linux
oracle google apple samsung phone mobile office school student teacher doctor company private public service account
example sample dummy placeholder your my the this that demo temp api key token pass word auth access value string
none null true false january february march april june july august september october november december monday tuesday
wednesday thursday friday saturday sunday london paris berlin madrid boston dallas texas york house family mother
father brother sister angel heaven star moon sun magic power happy lucky""".split()
#: The marks and digits that stand for letters.
LEET = str.maketrans("4@3!10$57", "aaeiiosst")
LEET_GUESSES = math.log10(4)
#: A-Z only, so that places stay the same.
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)} | {(row[i], below[j]) for row, below in zip(ROWS, ROWS[1:], strict=False) for i in range(len(row)) for j in (i - 1, i) if 0 <= j < len(below)}
NEXT |= {(b, a) for a, b in NEXT}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0?[1-9]|[12]\d|3[01])[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:19|20)\d\d", re.A)
DATE_GUESSES = math.log10(365 * 130)
#: Keys times directions; kinds of parts; the longest unit of a repeat.
WALK_GUESSES, KIND_GUESSES, UNIT = math.log10(47 * 4), math.log10(5), 4


@functools.lru_cache(2)
def dictionary(vocabulary: str | None) -> ahocorasick.Automaton:
    """Finds words; each has its length and the log10 of its rank."""
    ranked = list(dict.fromkeys(WORDS))
    if vocabulary:
        ids = json.loads(Path(vocabulary).read_text())["model"]["vocab"]
        more = (t.lstrip("\u0120\u2581").translate(LOWER) for t, _ in sorted(ids.items(), key=lambda x: x[1]))
        ranked = list(dict.fromkeys([*ranked, *(w for w in more if len(w) >= 3 and w.isascii() and w.isalpha())]))
    found = ahocorasick.Automaton()
    for i, w in enumerate(ranked):
        found.add_word(w, (len(w), math.log10(i + 1)))
    found.make_automaton()
    return found


def alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if "a" <= c <= "z" or "A" <= c <= "Z" else 33 if c.isascii() else 100


def case_guesses(part: str, low: str) -> float:
    return 0.0 if part == low else math.log10(2) if part in (low.upper(), low.capitalize()) else len(part) * math.log10(2)


@functools.lru_cache(1024)
def log_guesses(value: str, vocabulary: str | None = None) -> float:
    """log10 of the guesses that value stands."""
    n, low = len(value), value.translate(LOWER)
    parts: dict[int, list[tuple[int, float]]] = {}  # by end: start, cost
    known = dictionary(vocabulary)
    for text, extra in ((low, 0.0), (low.translate(LEET), LEET_GUESSES)):
        if not extra or text != low:
            for last, (size, cost) in known.iter(text):
                i, j = last + 1 - size, last + 1
                if not extra or text[i:j] != low[i:j]:
                    parts.setdefault(j, []).append((i, cost + extra + case_guesses(value[i:j], low[i:j])))
    for m in re.finditer(r"[0-9]", value):
        for j in range(m.start() + 4, min(n, m.start() + 10) + 1):
            if DATE.fullmatch(value, m.start(), j):
                parts.setdefault(j, []).append((m.start(), DATE_GUESSES))
    length = math.log10(max(n, 1))  # of a run, any of which it may have
    chars = [math.log10(alphabet(c)) for c in value]
    best, digits = [0.0] * (n + 1), 0.0
    brute = 0.0  # least cost before a span of brute force, less the digits up to its start
    walk, walk_from = 0, math.inf  # keys in the walk that ends here; least cost before a start in it
    runs = [[0, [math.inf] * u] for u in range(1, UNIT + 1)]  # equal characters u apart; least cost before a start, by remainder
    for j in range(1, n + 1):
        digits += chars[j - 1]
        cost = brute + digits
        for i, c in parts.get(j, ()):
            cost = min(cost, best[i] + c)
        if j > 1 and (low[j - 2], low[j - 1]) in NEXT:
            walk += 1
            if walk >= 3:
                walk_from = min(walk_from, best[j - 3])
                cost = min(cost, walk_from + WALK_GUESSES + length)
        else:
            walk, walk_from = 1, math.inf
        for u, run in enumerate(runs, 1):
            if j > u and value[j - 1] == value[j - 1 - u]:
                run[0] += 1
                least = max(3, 2 * u)  # a multiple of u
                if run[0] + u >= least:
                    run[1][j % u] = min(run[1][j % u], best[j - least])
                    cost = min(cost, run[1][j % u] + sum(chars[j - u : j]) + length)
            elif run[0]:
                run[:] = 0, [math.inf] * u
        best[j] = cost + KIND_GUESSES
        brute = min(brute, best[j] - digits)
    return best[n]


def scan(text: str, vocabulary: str | None = None) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, log10 guesses or 0) by start, then kind as in KINDS; code points, end exclusive."""
    raw, found = text.encode("utf-8", "surrogatepass").lower(), []
    if any(g in raw for g in ASSIGN_GATE):
        found += [("assign", *m.span(), log_guesses(m[2], vocabulary)) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span(), 0.0) for m in HEX.finditer(text)]
    if SEPARATED.search(raw) and any(g in raw for g in CONTEXT_GATE):
        found += [("guess", *m.span(m.lastindex), cost) for m in CONTEXT.finditer(text) if (cost := log_guesses(m[m.lastindex], vocabulary)) >= MIN_GUESSES]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def secrets(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, spans array of (kind, start, end, log_guesses) of every row of docs(doc_id, text), whole texts.

    vocabulary: a tokenizer's JSON file at the same path on every machine, for the dictionary. Null and empty texts
    have no spans. Repeated rows get equal results, an empty table an empty one; other columns are
    ignored.
    """
    common.arrow(docs.sparkSession)

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log_guesses", pa.float64())]))

    def run(batches):
        for b in batches:
            spans = [[dict(zip(("kind", "start", "end", "log_guesses"), x, strict=True)) for x in scan(t, vocabulary)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return common.id_text(docs).mapInArrow(run, SCHEMA)
