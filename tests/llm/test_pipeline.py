"""The stages of the corpus pipeline and their chain against plain Python on
a small fixture: rows that go, columns that stay, decisions carried on."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardflow.llm import decontaminate, quality
from wardflow.llm.shared import crc_mod

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    texts = {i: prose(rng, 60) for i in range(300)}
    for i in range(0, 300, 4):
        texts[i] = " ".join(w.upper() + "!!" for w in texts[i].split())      # rejected
    passage = "\n".join(prose(rng, 12) for _ in range(6))
    item = prose(rng, 30)
    near = texts[101].split()
    near[50] = "changed"
    texts.update({301: prose(rng, 50) + "\n" + passage, 302: passage + "\n" + prose(rng, 60), 303: passage, 305: " ".join(near),
                  306: texts[102], 307: prose(rng, 40) + " " + item + " " + prose(rng, 40), 309: prose(rng, 20) + " " + " ".join(item.split()[:16])})
    rows = [(i, t, "en", f"s{i % 3}", 7) for i, t in texts.items()]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    good = {r[0]: r for r in rows if not r[1].isupper() and "!!" not in r[1]}
    lined = {i: r for i, r in good.items() if i not in (303, 306)}            # emptied
    rest = good[302][1][len(passage) + 1:]
    lined[302] = (302, rest, "en", f"s{302 % 3}", len(rest))                  # cut
    alone = {i: r for i, r in lined.items() if i != 305}
    clean = {i: r for i, r in alone.items() if i not in (307, 309)}
    return path, rows, [good, lined, alone, clean]


def test_stages_match_plain_python(spark, corpus):
    path, rows, after = corpus
    before = [rows, *[list(x.values()) for x in after]]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, spark.createDataFrame(before[k], SCHEMA), path)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert sorted(map(tuple, out.collect())) == sorted(before[k + 1]), name


def test_run_carries_all_decisions_on(spark, corpus):
    path, _, after = corpus
    clean = after[-1]
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy_no", "shuffle_key"]
    got = out.collect()
    assert {r["doc_id"] for r in got} <= set(clean) and all(tuple(r)[:5] == clean[r["doc_id"]] for r in got)
    size = {}
    for r in clean.values():
        size[r[3]] = size.get(r[3], 0) + len(r[1])
    roots = sum(v ** 0.5 for v in size.values())
    rates = {s: v ** 0.5 / roots * sum(size.values()) / v for s, v in size.items()}
    copies = {}
    for r in got:
        copies.setdefault(r["doc_id"], []).append(r["copy_no"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    for s, rate in rates.items():
        n = sum(r[3] == s for r in clean.values())
        assert abs(sum(r["source"] == s for r in got) - rate * n) < 4 * (rate * n) ** 0.5
    assert len({r["shuffle_key"] for r in got}) == len(got)


def test_benchmark_stage_counts_words_in_all_documents(spark, tmp_path, monkeypatch):
    n = 45_000                                           # more than any earlier sample held
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("Alpha beta alpha other"), F.when(F.col("id") % 3 == 0, " gamma").otherwise(""),
        F.when(F.col("id") == n - 1, " alpha beta gamma delta").otherwise("")).alias("text"))
    spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    counted, word_counts = [], decontaminate.word_counts
    monkeypatch.setattr(decontaminate, "word_counts", lambda *tables: counted.append(word_counts(*tables)) or counted[-1])
    out = corpus_pipeline.benchmark_stage(spark, docs, str(tmp_path))
    assert out.count() == n - 1 and out.filter(F.col("doc_id") == n - 1).count() == 0
    (counts,) = counted
    assert {r["word"]: r["n"] for r in counts.collect()} == {"alpha": 2 * n + 1, "beta": n + 1, "gamma": n // 3 + 1, "delta": 1}


def test_quality_stage_learns_from_every_label(spark, tmp_path, monkeypatch):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "fit_quality", lambda train, *_: seen.append(train.count()) or (np.zeros(1 << quality.BITS), 0.0, 0.0, 30.0))
    assert corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).count() == 12_000
    assert seen == [labels.filter(crc_mod(F.col("doc_id"), 4) != 2).count()] and seen[0] > 8_500
