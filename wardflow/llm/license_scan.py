"""Licence scans: Aho-Corasick over notice phrases and identifier tags, and a
shunting-yard parser for the licence expressions that follow a tag.

Two automata read each text once.  One runs over the normalised words (A-Z
lower-cased, every run of other ASCII signs one space) and finds phrases; the
other runs over the lower-cased text and finds tags such as
``SPDX-License-Identifier:``.  The expression after a tag is read to the end
of its line, as far as it is well formed, put into postfix order by operator
precedence (with, and, or) and evaluated: ``and`` binds to both sides,
``or`` to the side of the smaller burden (the left one if equal), ``with``
an exception lifts copyleft to the burden of a library licence at most.

A text is read as bytes, with a few copies of itself at a time in memory;
no rows are shuffled.

Defined cases: null and empty text has no words and no spans; very long texts
are read whole; a null or repeated id is kept, one row per input row; equal
places of several phrases all count; an empty table gives an empty table;
extra columns, whatever their names, are not read and not returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: phrases of the base labels ------------------------------------
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# --- fixed values: further notice phrases, their labels --------------------------
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "cc0": "cc0",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "free and unencumbered software released into the public domain": "unlicense",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "proprietary",
}
# --- fixed values: identifier tags; after a weak one only known identifiers count --
TAGS = {"spdx-license-identifier:": True, "license-expression:": True, "license:": False, "licence:": False}
# --- fixed values: burden of a licence family, 0 (none) to 1 (no reuse) ------------
BURDEN = {
    "0bsd": 0.0, "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0,
    "apache": 0.2, "bsd": 0.2, "cc-by": 0.2, "isc": 0.2, "mit": 0.2, "zlib": 0.2,
    "epl": 0.4, "lgpl": 0.4, "mpl": 0.4,
    "cc-by-sa": 0.6, "gpl": 0.6,
    "agpl": 0.7, "cc-by-nc": 0.8, "cc-by-nc-sa": 0.8, "cc-by-nd": 0.8, "cc-by-nc-nd": 0.9,
    "other": 0.9, "proprietary": 1.0,
}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: burden of a copyleft licence under an exception
EXCEPTED = 0.4
#: how sure one span of a kind makes of a licence
SURE = {"base": 0.7, "notice": 0.7, "tag": 0.95}

SPANS = "array<struct<kind:string,start:long,n_words:int,at:long,n_bytes:int,text:string,labels:array<string>,burden:double>>"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_RUN = re.compile(rb" {2,}")
_TOKEN = re.compile(r"[\x20\t]*([()]|[a-z0-9][a-z0-9.+-]*)")


def family(name: str) -> str | None:
    """Label of a licence identifier: the longest known family that it is or
    that it begins with, up to a hyphen (``gpl-2.0-only``: ``gpl``)."""
    name = name.rstrip("+")
    while name:
        if name in BURDEN:
            return name
        name = name.rpartition("-")[0]
    return None


def read_expression(text: str, at: int, strong: bool) -> tuple[list[str], int]:
    """Tokens of the longest well-formed licence expression of the line at
    ``at``, and the place behind it.  ``strong`` also takes identifiers that
    belong to no known family but look like one (a hyphen and a digit, or a
    reference)."""
    tokens: list[str] = []
    depth, operand, good, end = 0, True, 0, at
    while m := _TOKEN.match(text, at):
        t = m[1].rstrip(".") if m[1] not in "()" else m[1]
        if operand:
            if t == "(":
                if tokens and tokens[-1] == "with":
                    break
                depth += 1
            elif t in PRECEDENCE or t == ")":
                break
            elif tokens and tokens[-1] == "with":
                if "exception" not in t:
                    break
                operand = False
            elif family(t) or strong and (t.startswith("licenseref-") or "-" in t and any(c.isdigit() for c in t)):
                operand = False
            else:
                break
        elif t == ")" and depth:
            depth -= 1
        elif t in PRECEDENCE:
            if t == "with" and tokens[-1] == ")":
                break
            operand = True
        else:
            break
        tokens.append(t)
        at = m.end()
        if not operand and not depth:
            good, end = len(tokens), m.start(1) + len(t)
    return tokens[:good], end


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in order, operators after both their sides."""
    out: list[str] = []
    wait: list[str] = []
    for t in tokens:
        if t == "(":
            wait.append(t)
        elif t == ")":
            while wait[-1] != "(":
                out.append(wait.pop())
            wait.pop()
        elif t in PRECEDENCE:
            while wait and wait[-1] != "(" and PRECEDENCE[wait[-1]] >= PRECEDENCE[t]:
                out.append(wait.pop())
            wait.append(t)
        else:
            out.append(t)
    return out + wait[::-1]


def evaluate(tokens: list[str]) -> tuple[float, frozenset[str]]:
    """Burden and labels that an expression leaves its reader with."""
    stack: list = []
    for t in postfix(tokens):
        if t == "with":
            stack.pop()
            burden, labels = stack.pop()
            stack.append((EXCEPTED if EXCEPTED < burden < 0.8 else burden, labels))
        elif t in PRECEDENCE:
            b, a = stack.pop(), stack.pop()
            stack.append((max(a[0], b[0]), a[1] | b[1]) if t == "and" else b if b[0] < a[0] else a)
        else:
            label = family(t) or "other"                 # so too an exception's name, which "with" takes off again
            stack.append((BURDEN[label], frozenset([label])))
    return stack[0]


class Scanner:
    """Automata of one task."""

    def __init__(self, notices: dict[str, str], tags: dict[str, bool]):
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        both = [(p, "base", x) for p, x in BASE_PHRASES.items()]
        both += [(p, "notice", x) for p, x in notices.items() if p not in BASE_PHRASES]
        for phrase, kind, label in both:
            self.phrases.add_word(f" {phrase} ", (kind, phrase, label, phrase.count(" ") + 1))
        for tag, strong in tags.items():
            self.tags.add_word(tag, (tag, strong))
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple]]:
        """Number of words, and the spans in order of their ends, tags last."""
        norm = b" " + _RUN.sub(b" ", text.translate(_WORDS)).strip(b" ") + b" "
        n_words = norm.count(b" ") - 1 if len(norm) > 2 else 0
        spans, longest, seen, last = [], {}, 0, 0
        if n_words:
            for end, (kind, phrase, label, n) in self.phrases.iter(norm.decode("latin-1")):
                seen += norm.count(b" ", last, end)
                last = end
                span = (kind, seen - n, n, None, None, phrase, [label], BURDEN[label])
                if kind == "base":
                    spans.append(span)
                elif span[1] not in longest or longest[span[1]][2] < n:
                    longest[span[1]] = span
        spans += longest.values()
        low = text.translate(_LOWER).decode("latin-1")
        done = 0
        for end, (tag, strong) in self.tags.iter(low):
            at = end + 1 - len(tag)
            if at < done or at and (low[at - 1].isalnum() or low[at - 1] in "-_"):
                continue
            tokens, done = read_expression(low, end + 1, strong)
            if tokens:
                burden, labels = evaluate(tokens)
                spans.append(("tag", None, None, at, done - at, " ".join(tokens), sorted(labels), burden))
        return n_words, spans


def license_spans(docs: DataFrame, notices: dict[str, str] | None = None, tags: dict[str, bool] | None = None,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, spans)``, one row per row of ``docs``.  A span is a
    phrase (``start``: its first word, from 0; of the notices that begin at
    one word the longest) or the expression of a tag (``at``: the tag's first
    byte), with the labels and the burden that it gives.  ``notices`` and
    ``tags`` replace the module's tables; labels must be keys of ``BURDEN``."""
    notices = NOTICES if notices is None else notices
    tags = TAGS if tags is None else tags
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    names = ["kind", "start", "n_words", "at", "n_bytes", "text", "labels", "burden"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.float64()]
    span_type = pa.list_(pa.struct(list(zip(names, kinds))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices, tags)
        for b in batches:
            found = [scanner.scan(t.as_py() or b"") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[dict(zip(names, s)) for s in spans] for _, spans in found], span_type)],
                ["doc_id", "n_words", "spans"])

    id_type = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(scan, f"doc_id {id_type}, n_words long, spans {SPANS}")


def sure(spans: Column) -> Column:
    """How sure the spans make of a licence: each distinct (kind, label) is
    one piece of evidence, 1 - (1 - s1)(1 - s2)..."""
    seen = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.transform(
        s["labels"], lambda x: F.struct(s["kind"].alias("kind"), x.alias("label"))))))
    each = F.create_map(*[F.lit(v) for kv in SURE.items() for v in kv])
    return F.lit(1.0) - F.aggregate(seen, F.lit(1.0), lambda p, e: p * (F.lit(1.0) - F.element_at(each, e["kind"])))


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: places of the base phrases, base labels, all
    labels, ``score`` (how sure, 0 to 1), ``burden`` (the largest of all
    spans; null without any) and ``expressions`` (tags, in order)."""
    def names(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.flatten(spans["labels"]))), ",")

    base = F.filter("spans", lambda s: s["kind"] == "base")
    tagged = F.filter("spans", lambda s: s["kind"] == "tag")
    return license_spans(docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base["start"]).alias("first_word"),
        F.array_max(base["start"]).alias("last_word"), names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        sure(F.col("spans")).alias("score"), F.array_max("spans.burden").alias("burden"),
        F.array_join(tagged["text"], "; ").alias("expressions"))
