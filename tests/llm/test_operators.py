"""Edge cases and brute-force comparisons of the training-data operators on
small tables: nulls, empty and long texts, ties, repeated rows, extra columns
of clashing names, empty tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import (chat, decontaminate, exact_dedup, jaccard_join, line_dedup, mixing, ngram_lm, quality,
                          token_counts, url_filter)
from wardflow.llm.tokens import Words, shingles, text_buffers

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines int, copy_no int, deleted string"


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    passage = "\n".join(sentence(rng, 12) for _ in range(6))
    base = sentence(rng, 80)
    near = base.split()
    near[40] = "changed"
    out = [sentence(rng, 60) + "\n" + passage + "\n\n" + sentence(rng, 30), passage + "\n" + sentence(rng, 40), base, " ".join(near),
           base.replace(" ", "  "), base, None, "", " \n\t", "one", "one", "Short line.\nShort line.", sentence(rng, 4000),
           "\n".join(["same line of ten words that comes again and again"] * 12), "A é ß 漢字 | !!", "\n\n" + passage + "\n"]
    ids = [3, 9, 12, 14, 15, 7, 20, 21, None, 30, 30, 31, 32, 33, None, 40]
    return list(zip(ids, out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", 1, 0.5, 7, 9, "x") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def test_word_hashes_and_shingles():
    import pyarrow as pa
    data, off = text_buffers(pa.array(["a b c d e f", None, "x\ty", "a b c d e f", ""]))
    w = Words(data, off)
    h = w.hashes()
    assert np.diff(w.doc).tolist() == [6, 0, 2, 6, 0] and len(set(h.tolist())) == 8
    s, so = shingles(h, w.doc, 5)
    assert np.diff(so).tolist() == [2, 0, 1, 2, 0] and (s[:2] == s[3:5]).all()


def test_mixing_counts_follow_rates(spark, docs, none):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"),
                                    F.when(F.col("id") < 4000, "big").when(F.col("id") < 5900, "mid").otherwise("tiny").alias("source"))
    out = mixing.poisson_mix(rows, weights={"big": 1, "mid": 1, "tiny": 2})
    n = {r[0]: r[1] for r in out.groupBy("source").count().collect()}
    assert abs(n["big"] - 1500) < 160 and abs(n["mid"] - 1500) < 160 and abs(n["tiny"] - 3000) < 250
    per = [r[0] for r in out.filter("source = 'mid'").groupBy("doc_id").count().select("count").collect()]
    zero = 1900 - len(per)
    assert abs(zero / 1900 - math.exp(-1500 / 1900)) < 0.05
    assert out.filter("source = 'tiny'").agg(F.max("copy_no")).first()[0] < 70      # mean 30, in one piece
    first, again = (sorted(map(tuple, mixing.poisson_mix(docs).collect()), key=repr) for _ in range(2))
    assert first == again and mixing.poisson_mix(docs).columns[-2:] == ["copy_no", "shuffle_key"]
    assert mixing.poisson_mix(none).count() == 0


def cut_lines(texts, min_words):
    """Later copies of maximal repeated runs by comparing all pairs of places."""
    seqs = {}
    for i, t in texts:
        seqs[(-(1 << 63) if i is None else i, t or "")] = [(k, s, len(words(s))) for k, s in enumerate((t or "").split("\n")) if words(s)]
    places = [(d, p) for d in seqs for p in range(len(seqs[d]))]
    gone = collections.defaultdict(set)
    for (d, p), (e, q) in itertools.product(places, places):
        if not (q < p if e == d else e[0] < d[0]):      # distinct texts of the fixture never share an id and a run
            continue
        n, w = 0, 0
        while p + n < len(seqs[d]) and q + n < len(seqs[e]) and seqs[d][p + n][1] == seqs[e][q + n][1]:
            w += seqs[d][p + n][2]
            n += 1
        if w >= min_words:
            gone[d].update(seqs[d][p + k][0] for k in range(n))
    return gone


def test_line_dedup_matches_brute_force(docs, texts, none):
    out = line_dedup.line_dedup(docs, 20)
    assert out.columns == [c for c in docs.columns if c not in ("n_lines", "deleted")] + ["n_lines", "deleted"]
    gone = cut_lines(texts, 20)
    seen = 0
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append((r["text"], sorted(r["deleted"])))
    for i, t in texts:
        cut = sorted(gone.get((-(1 << 63) if i is None else i, t or ""), ()))
        want = None if t is None else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in cut)
        assert (want, cut) in got[i]
        seen += bool(cut)
    assert seen >= 4 and out.count() == len(texts)
    assert line_dedup.line_dedup(none, 20).count() == 0


def best_segmentation(word, pieces, byte):
    best = [(0.0, 0)] + [None] * len(word)
    for i in range(1, len(word) + 1):
        own = len(word[i - 1].encode())
        options = [(best[i - 1][0] + own * byte, -(-best[i - 1][1] + own))]
        options += [(best[j][0] + pieces[word[j:i]], best[j][1] - 1) for j in range(i) if word[j:i] in pieces]
        best[i] = max(options)
    return -best[-1][1]


def test_token_counts_match_unshared_viterbi(docs, texts, none):
    pieces, byte = token_counts.load_vocabulary()
    small = {p: s for p, s in pieces.items()}
    want = sorted((repr(i), sum(best_segmentation("▁" + w, small, byte) for w in words(t))) for i, t in texts if len(t or "") < 5000)
    got = sorted((repr(r["doc_id"]), r["n_tokens"]) for r in token_counts.token_counts(docs).collect() if r["n_words"] < 1000)
    assert got == want
    counter = token_counts.PrefixCounter(pieces, byte)
    counter.counts(["▁prefix" + c for c in "abcdef"])
    assert counter.steps == len("▁prefix") + 6        # the shared prefix once
    assert token_counts.token_counts(none).count() == 0


def test_jaccard_join_matches_brute_force(spark, docs, texts, none):
    rng = random.Random(9)
    rows = list(texts)
    base = sentence(rng, 70).split()
    for k in range(60):           # a large group of near copies, some beyond the threshold
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(70)] = f"new{rng.randrange(9999)}"
        rows.append((1000 + k, " ".join(w)))
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n int")
    old, jaccard_join.BLOCK = jaccard_join.BLOCK, 16      # several blocks
    try:
        got = jaccard_join.near_duplicates(df).collect()
    finally:
        jaccard_join.BLOCK = old
    sets = [frozenset(tuple(words(t)[k:k + 5]) for k in range(max(1, len(words(t)) - 4))) if words(t) else frozenset() for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[find(b)] = find(a)
    want = []
    for k, (i, t) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if find(m) == find(k) and rows[m][0] is not None]
        want.append((repr(i), repr(min(ids) if ids else None) if sets[k] else repr(i), links[k]))
    got = sorted((repr(r["doc_id"]), repr(r["class_id"]), r["n_links"]) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    lost = [w[2] - g[2] for g, w in zip(got, sorted(want))]
    assert min(lost) >= 0 and sum(lost) <= 0.005 * sum(links)      # the target recall at the threshold is 0.999
    kept = jaccard_join.drop_near_duplicates(df)
    classes = {find(k) for k in range(len(rows)) if sets[k]}
    assert kept.columns == df.columns and kept.count() == len(classes) + sum(not s for s in sets)
    assert jaccard_join.near_duplicates(none).count() == 0


def test_decontamination_tolerates_substitutions(spark, docs, none):
    rng = random.Random(2)
    item = sentence(rng, 30).split()
    hit = list(item)
    for k in (4, 11, 19, 25):
        hit[k] = "other"
    rows = [(1, sentence(rng, 50) + " " + " ".join(hit).upper() + " " + sentence(rng, 20)), (2, sentence(rng, 90)), (3, " ".join(item[:20])),
            (4, " ".join(item[:6])), (None, " ".join(item)), (None, " ".join(item)), (5, None), (6, "")]
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, seed string")
    b = spark.createDataFrame([(100, " ".join(item)), (101, None), (102, "too short"), (100, " ".join(item))], "item_id long, text string")
    got = sorted((repr(r["doc"]), r["at"], r["n_words"], r["n_match"]) for r in decontaminate.overlaps(d, b).collect())
    assert got == sorted([("1", 50, 30, 26), ("3", 0, 20, 20), ("None", 0, 30, 30)])
    left = decontaminate.decontaminate(d, b)
    assert left.columns == d.columns and sorted(r[0] for r in left.collect()) == [2, 4, 5, 6]
    assert decontaminate.overlaps(none, b).count() == 0 and decontaminate.overlaps(docs, b.filter("false")).count() == 0


def test_benchmark_words_are_counted_in_all_documents(spark):
    n = 45_000                                           # more than any earlier sample held
    docs = spark.range(n).select(F.col("id").alias("doc"), F.concat(
        F.lit("Alpha beta alpha other"), F.when(F.col("id") % 3 == 0, " gamma").otherwise("")).alias("text"))
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item int, text string")
    assert {r["word"]: r["n"] for r in decontaminate.word_counts(docs, items).collect()} == {"alpha": 2 * n, "beta": n, "gamma": n // 3}


def test_decontamination_finds_quotations_and_shifted_copies(spark):
    rng = random.Random(8)
    long, mid, odd, small, huge = (sentence(rng, n).split() for n in (59, 45, 15, 5, 200))
    shifted = mid[:15] + mid[16:30] + mid[31:]
    inserted = mid[:15] + ["added"] + mid[15:30] + ["words"] + mid[30:]
    pad = [sentence(rng, 40) for _ in range(2)]
    texts = {1: long[10:35], 2: shifted, 3: inserted, 4: odd[:7] + odd[8:], 5: small, 6: huge[20:60], 7: odd[:5] + odd[6:10] + odd[11:],
             8: long[10:22], 9: small[:4], 10: odd[:7], 11: odd[:5] + ["a"] + odd[5:10] + ["b"] + odd[10:]}
    rows = [(k, f"{pad[0]} {' '.join(w)} {pad[1]}") for k, w in texts.items()] + [(20, " ".join(small)), (21, " ".join(odd[:8]))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate((long, mid, odd, small, huge))], "item_id long, text string")
    got = {(r["doc"], r["item"]): (r["at"], r["n_words"], r["n_match"]) for r in decontaminate.overlaps(d, b).collect()}
    assert got[1, 0] == (40, 25, 25) and got[6, 4] == (40, 40, 40) and got[5, 3] == (40, 5, 5) and got[20, 3] == (0, 5, 5)
    assert got[4, 2] == (40, 14, 14) and got[7, 2] == (40, 13, 13) and got[11, 2] == (40, 17, 15) and got[21, 2] == (0, 8, 8)
    assert set(got) == {(1, 0), (2, 1), (3, 1), (4, 2), (5, 3), (6, 4), (7, 2), (11, 2), (20, 3), (21, 2)}
    assert sorted(r[0] for r in decontaminate.decontaminate(d, b).collect()) == [8, 9, 10]


def test_chat_prefix_masks_and_edges(spark):
    t = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "yes"), (1, 4, "user", "bye"),
         (0, 0, "user", "hi"), (0, 1, "assistant", "no"), (5, 0, "user", None), (None, 0, "user", "x"), (7, 0, "assistant", "same"), (6, 0, "assistant", "same")]
    turns = spark.createDataFrame([(*r, "chosen") for r in t], "conv_id long, turn long, role string, text string, chosen string")
    out = {r["conv_id"]: r for r in chat.preference_format(chat.neighbour_pairs(turns)).collect()}
    assert set(out) == {0, 1, 5, 6, 7}
    r = out[1]
    assert r["n_common"] == 3 and r["prompt"] == "<|user|>\nhi\n<|assistant|>\nhello\n<|user|>\nmore\n"
    after = "<|user|>\nbye\n"                           # turns after the last reply stand on both sides
    assert r["chosen"] == "<|assistant|>\nyes\n" + after and r["rejected"] == "<|assistant|>\nno\n" + after
    s = r["chosen_spans"][0]
    assert r["chosen"][s["start"]:s["end"]] == "yes\n" and r["valid"]
    assert not out[5]["valid"] and not out[6]["valid"] and out[6]["chosen"] == ""
    assert chat.preference_format(chat.neighbour_pairs(turns.filter("false"))).count() == 0


def test_lm_matches_counted_bigrams(docs, texts, none):
    got = sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), r["score"]) for r in ngram_lm.score_corpus(docs, shard_tokens=500).collect())
    low = [[w.encode().lower() for w in words(t)] + ["end"] for _, t in texts]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0 for i, _ in texts]
    uni, pair = collections.Counter(), collections.Counter()
    for w, x in zip(low, train):
        if x:
            uni.update(w)
            pair.update(zip(["begin", *w], w))
    norm, mu = sum(uni.values()) + 0.1 * (len(uni) + 1), ngram_lm.MU
    want = []
    for (i, _), w in zip(texts, low):
        base = sum(math.log10((uni[x] + 0.1) / norm) for x in w)
        score = sum(math.log10((pair[v, x] + mu * (uni[x] + 0.1) / norm) / ((sum(train) if v == "begin" else uni[v]) + mu))
                    for v, x in zip(["begin", *w], w))
        want.append((repr(i), len(w), sum(uni[x] > 0 for x in w), round(base, 6), score))
    for g, x in zip(got, sorted(want)):
        assert g[:4] == x[:4] and abs(g[4] - x[4]) < 1e-4 * x[1]
    assert ngram_lm.score_corpus(none).count() == 0


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n, u in ((0, 10), (1, 1), (5, 100), (1000, 10), (50000, 1 << 55)):
        v = np.sort(rng.integers(0, u, n)).astype(np.uint64)
        e = ngram_lm.EliasFano(*ngram_lm.EliasFano.encode(v, u))
        for a, b in ((0, n), (n // 3, n // 2), (max(0, n - 1), n)):
            assert (e.slice(a, b) == v[a:b]).all()


def test_url_rules_and_model(spark):
    rows = [(1, "https://A.org/x?q"), (2, "http://www.example.org/es/1#t"), (3, "http://example.org/en/17"), (4, "x://shop.com/de/3"),
            (5, "https://m.casino-win.example.com/en/9"), (6, None), (7, "no scheme"), (8, "http://myexample.org"), (8, "http://myexample.org"),
            (9, "https://garden.example.com/en/5")]
    df = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, url_filter.labelled_urls(spark)).collect()}
    assert [got[k]["rule"] for k in range(1, 10)] == ["org/", "example.org/es/", "example.org/en/1", "com/de/", None, None, None, None, None]
    assert [got[k]["verdict"] for k in (1, 2, 3, 4, 5, 9)] == ["allow", "block", "block", "block", "block", "allow"]
    assert (got[1]["host"], got[1]["path"], got[6]["host"], got[7]["path"]) == ("a.org", "/x", "", "")
    assert url_filter.judge_urls(df.filter("false"), url_filter.labelled_urls(spark)).count() == 0


def test_url_model_learns_from_paths(spark):
    block = ["library.example.net/online-casino/free-spins", "museum.example.net/en/cheap-pills/77", "garden.example.net/slots-win.html"]
    allow = ["library.example.net/reading/travel-stories", "museum.example.net/en/500", "garden.example.net/", "history.example.net/maps/old-towns.html"]
    df = spark.createDataFrame([(k, f"https://{u}") for k, u in enumerate(block + allow)], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, url_filter.labelled_urls(spark)).collect()}
    assert all(r["rule"] is None for r in got.values())
    assert [got[k]["verdict"] for k in sorted(got)] == ["block"] * len(block) + ["allow"] * len(allow)


def test_exact_dedup_matches_hashing(docs, texts, none):
    norm = [SPACE.sub(" ", t or "") for _, t in texts]
    for capacity in (2, exact_dedup.CAPACITY):
        got = exact_dedup.exact_dedup(docs, capacity).collect()
        want = []
        for (i, _), t in zip(texts, norm):
            group = [j for (j, _), u in zip(texts, norm) if u == t]
            ids = [j for j in group if j is not None]
            want.append((repr(i), repr(min(ids) if ids else None), len(group), hashlib.sha256(t.encode()).hexdigest()))
        assert sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == sorted(want)
        assert sum(r["kept"] for r in got) == len(set(norm))
    assert len({r["bucket"] for r in exact_dedup.exact_dedup(docs, 2).collect()}) > 1
    assert exact_dedup.exact_dedup(none).count() == 0


def plain_directory(counts, bits, capacity):
    leaves, todo = [], [(0, 0)]
    while todo:
        p, d = todo.pop()
        n = sum(c for q, c in counts.items() if q >> (bits - d) == p)
        if n > capacity and d < bits:
            todo += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        else:
            leaves.append((p << (bits - d), d, n))
    return sorted(leaves)


def test_directory_doubling_splits_overfull_buckets_only(spark):
    rng = random.Random(3)
    for counts in ({0: 5, 1: 5, 6: 1}, {0: 5}, {}, {p: rng.randrange(9) for p in range(8)}, {7: 100}):
        df = spark.createDataFrame(list(counts.items()), "p long, n long")
        got = exact_dedup.split_directory(df, 3, 6)
        assert sorted(tuple(r) for r in got.collect()) == plain_directory(counts, 3, 6)
        packed = exact_dedup.pack_owners(got, 4).orderBy("start").collect()
        owners = [r["owner"] for r in packed if r["n"]]
        assert owners == sorted(owners) and max(owners, default=0) <= 3
        share = -(-sum(counts.values()) // 4) or 1
        for o in set(owners):                            # no owner starts a bucket after its share
            assert sum(r["n"] for r in packed if r["owner"] == o) - [r["n"] for r in packed if r["owner"] == o and r["n"]][-1] < share


def test_quality_learns_and_handles_edges(spark, docs, none):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        good = i % 4 != 0
        t = sentence(rng, 40) if good else " ".join(w.upper() + "!!" for w in sentence(rng, 40).split())
        rows.append((i, t, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (5000, 0), (3, None)], "doc_id long, quality int"))
    out = quality.quality_scores(df.select("doc_id", "text"), labels).join(df, "doc_id").filter("held_out").collect()
    assert len(out) > 50 and sum(r["predicted"] == r["quality"] for r in out) >= 0.97 * len(out)
    edge = quality.quality_scores(docs, labels)
    assert edge.count() == docs.count() and edge.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.keep_quality(docs, labels.filter("quality = 1")).columns == docs.columns
    assert quality.quality_scores(none, labels).count() == 0


def test_quality_trains_on_one_text_of_each_id(spark):
    rows = [(1, f"text number {k}") for k in range(50)] + [(1, "text number 3"), (2, "other"), (2, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    got = quality.training_rows(df, labels, F.lit(True)).collect()
    assert len(got) == 3 and len({r["fold"] for r in got}) == 3 and sorted(r["y"] for r in got) == [-1.0, 1.0, 1.0]
    again = quality.training_rows(df.repartition(7), labels, F.lit(True)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_quality_trains_on_every_label(spark):
    n = 9_000                                            # more than the earlier bound
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    got = quality.training_rows(docs, labels, F.lit(True)).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("fold").alias("ids"), F.sum("y").alias("y")).first()
    assert tuple(got) == (n, n, n / 3)


def test_quality_shards_fit_one_model(spark):
    rng = random.Random(6)
    good, bad = ([f"{c}{i}" for i in range(60)] for c in "gb")
    rows = [(f"own{i} " + " ".join(rng.choice(good if (rng.random() < 0.6) == (i % 5 != 0) else bad) for _ in range(25)), 1.0 if i % 5 else -1.0, rng.getrandbits(64) - (1 << 63))
            for i in range(900)]
    train = spark.createDataFrame(rows, "text string, y double, fold long")
    x = {r["fold"]: r["f"] for r in train.mapInArrow(quality._extract, "y double, fold long, f array<int>").collect()}
    fit = [(np.array(x[f]), y) for _, y, f in rows if f >= quality.ASIDE]
    texts, y = [f for f, _ in fit], np.array([v for _, v in fit])
    r = quality.log_count_ratios(texts, y)
    bound = {c: quality.COST * len(y) / (2 * (y == c).sum()) for c in (1.0, -1.0)}

    def loss(w, b):                                      # of the whole, on scaled indicators
        return 0.5 * (w @ w + b * b) + sum(bound[c] * max(0.0, 1 - c * (w[f] @ r[f] + b)) for f, c in zip(texts, y))

    best = loss(*quality.dual_coordinate_descent(texts, y, r, epochs=200))
    features = spark.createDataFrame([(v, f, x[f]) for _, v, f in rows if f >= quality.ASIDE], "y double, fold long, f array<int>")
    sixth = loss(*quality.dual_coordinate_descent(texts[::6], y[::6], r, epochs=200))
    for shards in (1, 6):
        w, b = quality.fit_weights(features, r, bound, shards)
        assert best * 0.999 <= loss(w, b) < (1.1 * best if shards == 1 else (best + sixth) / 2)
        dealt = features.repartition(7)
        again = quality.fit_weights(dealt, r, bound, shards)
        assert np.allclose(w, again[0], atol=1e-9) and abs(b - again[1]) < 1e-9
    m = quality.fit_quality(train, sum(map(len, texts)) // 6)
    p = 1 / (1 + np.exp(-np.array([m[2] * (m[0][f].sum() + m[1]) + m[3] for f in texts])))
    assert np.mean((p > 0.5) == (y > 0)) > np.mean(y > 0)   # better than the larger class
