"""License scans, ranked search and Merkle manifest against plain Python on
small tables: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns named like internal ones, one source with most rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from wardflow.llm import lexical_search, license_scan, merkle

EXTRA = "tree string, block long, size int, hash string, q int, rank int, spans int, n long, sketch int, _part int, _tie string, at int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n):
    return " ".join(rng.choice(["Alpha", "beta", "the", "of", "Été", "漢字"]) + str(rng.randrange(60)) * rng.randrange(2) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    notes = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
             "GNU General  Public\nLicense mit-license APACHE LICENSE", "Licensed under CC BY-NC 4.0.",
             "SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Apache-2.0", "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */",
             "license: none of this", "License: MIT and so on", "spdx-license-identifier: AGPL-3.0 AND ("]
    out = [(i, prose(rng, rng.randrange(1, 60)) + ". " + (notes[i % len(notes)] if i % 2 else ""), "en", "big", 5) for i in range(300)]
    out += [(1000 + i, prose(rng, 12), None if i % 3 else "de", f"s{i:02d}", None) for i in range(40)]
    out += [(None, None, None, None, None), (None, None, None, None, None), (7, "", "", "", 0), (7, "", "", "", 0), (2000, "The MIT License", "en", "é", 15),
            (2001, "the the THE of mit license mit license", "en", None, 1), (2002, "the the THE of mit license mit license", "en", None, 1),
            (2003, prose(rng, 20_000) + " MIT license", "fr", "big", 1), (2004, " \t\x00!", "fr", "zz", 3), (2005, "x" * 1_100_000 + " the of", "en", "zz", 9)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "h", 3, 4, 5, 6, 7, 8, "x", 9) for r in rows], SCHEMA).repartition(5)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


# --- license scan ------------------------------------------------------------------

def descend(tokens):
    """Recursive descent over or / and / with."""
    def unit(i):
        if tokens[i] == "(":
            v, i = either(i + 1)
            return v, i + 1
        label = license_scan.family(tokens[i]) or "other"
        v = (license_scan.BURDEN[label], {label})
        if i + 1 < len(tokens) and tokens[i + 1] == "with":
            v = (0.4 if 0.4 < v[0] < 0.8 else v[0], v[1])
            i += 2
        return v, i + 1

    def both(i):
        v, i = unit(i)
        while i < len(tokens) and tokens[i] == "and":
            w, i = unit(i + 1)
            v = (max(v[0], w[0]), v[1] | w[1])
        return v, i

    def either(i):
        v, i = both(i)
        while i < len(tokens) and tokens[i] == "or":
            w, i = both(i + 1)
            v = w if w[0] < v[0] else v
        return v, i

    return either(0)[0]


def random_expression(rng, depth=0):
    if depth > 3 or rng.random() < 0.4:
        name = rng.choice(["mit", "apache-2.0", "gpl-3.0-or-later", "lgpl-2.1", "agpl-3.0-only", "cc0-1.0", "licenseref-x"])
        return [name, "with", "classpath-exception-2.0"] if rng.random() < 0.3 else [name]
    side = random_expression(rng, depth + 1) + [rng.choice(["and", "or"])] + random_expression(rng, depth + 1)
    return ["(", *side, ")"] if rng.random() < 0.5 else side


def test_expressions_against_recursive_descent():
    rng = random.Random(5)
    for _ in range(500):
        tokens = random_expression(rng)
        assert license_scan.evaluate(tokens) == descend(tokens)
        text = " ".join(tokens).replace("( ", "(").replace(" )", ")")
        assert license_scan.read_expression(text, 0, True) == (tokens, len(text))


def test_expression_reads_as_far_as_it_is_well_formed():
    def read(t, strong=False):
        return license_scan.read_expression(t, 0, strong)[0]
    assert read("mit and so on") == ["mit"]
    assert read("mit or (gpl-2.0 and") == ["mit"]
    assert read("apache-2.0.\nmit") == ["apache-2.0"]
    assert read("gpl-2.0+ with mit") == ["gpl-2.0+"]
    assert read("none of this") == [] and read("foo-1.0", True) == ["foo-1.0"] and read("foo-1.0") == []
    assert read("") == [] and read(")") == [] and read("and mit") == []
    assert read("(mit or isc) with x-exception") == ["(", "mit", "or", "isc", ")"]


def base_of(text):
    w = terms(text)
    found = [(i, label) for phrase, label in license_scan.BASE_PHRASES.items() for i in range(len(w)) if w[i:i + phrase.count(" ") + 1] == phrase.split()]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base_against_word_lists(docs, rows):
    got = license_scan.license_report(docs).collect()
    want = collections.Counter((r[0], *base_of(r[1])) for r in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels) == (r.burden is not None)


def test_license_base_in_sql(docs, rows):
    import pyarrow as pa
    sql = r"""
    WITH w AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM d),
    p(phrase, label) AS (VALUES ('mit license', 'mit'), ('apache license', 'apache'), ('general public license', 'gpl')),
    f AS (SELECT row, i, label FROM (SELECT row, l, unnest(range(len(l))) AS i FROM w), p WHERE array_to_string(l[i + 1:i + len(string_split(phrase, ' '))], ' ') = phrase)
    SELECT doc_id, len(l) AS n, count(i), min(i), max(i), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM w LEFT JOIN f USING (row) GROUP BY row, doc_id, l"""
    con = duckdb.connect()
    con.register("d", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows])}))
    want = collections.Counter(tuple(x) for x in con.execute(sql).fetchall())
    got = license_scan.license_report(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert collections.Counter(map(tuple, got)) == want


def test_license_spans(spark):
    text = ["SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Apache-2.0\nx", "Licensed under CC BY-NC 4.0.", "see license: foo", "my-license: mit",
            "GNU Lesser General Public License", "spdx-license-identifier: gpl-2.0 with classpath-exception-2.0 license: isc", "é license: ISC."]
    got = {r.doc_id: r.spans for r in license_scan.license_spans(spark.createDataFrame(list(enumerate(text)), "doc_id int, text string")).collect()}
    tag = got[0][-1]
    assert (tag.kind, tag.at, tag.text, tag.labels, tag.burden) == ("tag", 0, "( mit or gpl-3.0-only ) and apache-2.0", ["apache", "mit"], 0.2)
    assert text[0][tag.at:tag.at + tag.n_bytes].endswith("Apache-2.0")
    assert [(s.kind, s.text, s.start, s.n_words) for s in got[1]] == [("notice", "cc by nc", 2, 3)]
    assert not got[2] and not got[3]
    assert [(s.kind, s.labels, s.start) for s in got[4]] == [("base", ["gpl"], 2), ("notice", ["lgpl"], 1)]
    assert [(s.labels, s.burden) for s in got[5]] == [(["gpl"], 0.4), (["isc"], 0.2)]
    assert text[6].encode()[got[6][0].at:][:got[6][0].n_bytes] == b"license: ISC"


# --- ranked search -----------------------------------------------------------------

def plain_search(rows, items, k=20):
    counted = [(r[0], collections.Counter(terms(r[1]))) for r in rows]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        w = [(t, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) for t in terms(text)]
        found = []
        for d, c, n in counted:
            m = 75 + 25 * n * n_docs // n_terms
            s = sum(x * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, x in w if t in c)
            if s > 0:
                found.append((-s, d is None, d, s))
        out += [(item_id, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return out


@pytest.fixture(scope="module")
def items(rows):
    rng = random.Random(2)
    return [(i, prose(rng, 8) + " MIT") for i in range(12)] + [(3, "the the of"), (None, "mit license"), (20, None), (21, "nowhere-to-be-found"), (22, rows[5][1])]


@pytest.mark.parametrize("width,block", [(4096, 1000), (16, 5)])
def test_search_against_plain_scores(spark, docs, rows, items, monkeypatch, width, block):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", block)
    rows = rows + [(None, "Alpha mit license the of", "en", None, 1)]
    docs = docs.unionByName(spark.createDataFrame([rows[-1]], docs.select("doc_id", "text", "lang", "source", "n_chars").schema), allowMissingColumns=True)
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, q string, rank int")
    got = lexical_search.search(docs, bench, width=width)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_search(rows, items))


def test_bounds_hold_and_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(8)
    text = prose(rng, 500).encode()
    whole = lexical_search.count_terms(text)
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 7)
    assert lexical_search.count_terms(text) == whole == collections.Counter(t.encode() for t in terms(text.decode()))
    assert lexical_search.count_terms(b"") == {} == lexical_search.count_terms(b" ,, ")


def test_search_of_nothing(spark, docs):
    bench = spark.createDataFrame([(1, "mit")], "item_id int, text string")
    assert lexical_search.search(docs.filter("false"), bench).count() == 0
    got = lexical_search.search(docs, bench.filter("false"))
    assert got.count() == 0 and got.dtypes[0] == ("item_id", "int")


# --- Merkle manifest ---------------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(leaves):
    """Root, and each leaf's path of (left, right) siblings."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p // 16 * 16:p // 16 * 16 + 16]
            paths[i].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        level = [sha("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        at = [p // 16 for p in at]
    return level[0], paths


def plain_manifest(rows):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))
    by = collections.defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, r[1].translate(LOWER)) if hit else leaf(r, r[1]), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by[s])]) for s in names}
    root, above = plain_tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for x, path in zip(sorted(by[s]), trees[s][1]):
            node = x[3]
            for left, right in path + up:
                node = sha(left + node + right)
            out.append((x[4], x[2], trees[s][0], root, sha("".join(a + b for a, b in path + up)), node, node == root))
    return out


@pytest.mark.parametrize("sources", ["many", "one", "single row"])
def test_manifest_against_plain_tree(spark, docs, rows, sources):
    if sources == "one":                                 # one tree of three rounds of blocks is out of reach here; two are not
        rows = [(*r[:3], "big", r[4]) for r in rows]
    if sources == "single row":
        rows = rows[:1]
    extra = ("t", 1, 2, "h", 3, 4, 5, 6, 7, 8, "x", 9)
    d = spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(3)
    got = merkle.verify(merkle.manifest(d, merkle.lowered_text()))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_manifest(rows))


def test_manifest_untampered_and_empty(docs):
    assert merkle.verify(merkle.manifest(docs)).filter("NOT verified OR folded_root != root").count() == 0
    assert merkle.verify(merkle.manifest(docs.filter("false"))).count() == 0


def test_manifest_of_one_source_with_many_equal_rows(spark):
    rows = [(1, "same", "en", "hot", 4)] * 700 + [(i, "x", "en", "hot", 1) for i in range(2, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = merkle.verify(merkle.manifest(d, merkle.lowered_text()))
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(plain_manifest(rows))
    blocks = merkle.build_tree(merkle.number_rows(d.select(F.lit("t").alias("tree"), F.md5("text").alias("hash"), "doc_id"),
                                                  [F.col("doc_id").asc()], ["tree"], "pos", "size"), "doc_id")[0][0]
    assert blocks.agg(F.max(F.size("nodes"))).first()[0] == merkle.BLOCK
