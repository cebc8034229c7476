"""URL filter: rules by host suffix and path prefix, and for the rest a
logistic regression on hashed character n-grams of host and path.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case.  Path: then up to ``?``, ``#`` or the end.  A url that is null or
has no ``://`` has both empty, fits no rule and is judged by the model (an
empty n-gram set: the intercept).  A rule ``host/path`` fits its host and all
subdomains if the url's path starts with ``/path``; the longest fitting rule
wins, of equal lengths the alphabetically first.  Very long urls are read whole.
Rows stay one to one, repeated rows and null ids included; an empty table gives
no rows; other columns of the input, whatever their names, are not read.

The model is fitted from a small labelled url table (a parameter; at most
``MAX_TRAINING_ROWS``, counted).
"""

from __future__ import annotations

import hashlib

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: rule -> verdict
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
NGRAMS = (3, 4, 5)
BUCKETS = 1 << 15
MAX_TRAINING_ROWS = 100_000

# --- fixed values: names of the labelled url table, common words of host names,
# not taken from any table that is judged ---------------------------------------
BLOCKED = """online-casino casino-royal my-casino casino-bonus slots-win big-win win-money lotto-win poker-night best-bets
 sport-bets bets-online free-coupons free-money get-free free-spins pills-shop cheap-meds buy-pills cheap-loans cheap-deals
 payday-loan spam-links mail-spam spam-mail link-farm click-farm ad-server ads-click ads-network web-ads track-pixel
 click-track adult-video adult-cam my-adult xxx-tube x-rated click-bait""".split()
ALLOWED = """news library museum university school weather garden history science cooking travel music painting journal archive
 theatre cinema football mountain river forest city-guide well-known open-source long-read co-op question education hospital
 parliament newspaper ministry observatory research recipes photos stories maps books courses lectures letters species houses
 archives states notes words games sports movies""".split()
#: made-up ordinary names besides; most hosts are no common word
MADE_UP = 400


def made_up_name(i: int) -> str:
    """A pronounceable name from the digest of its number: two to four
    syllables, some with a hyphen, a digit or a short common word."""
    d = hashlib.sha256(f"host {i}".encode()).digest()
    onset, vowel, coda = "bcdfghjklmnprstvw", "aeiou", ["", "", "n", "r", "s", "l", "th", "nd", "st", "ck"]
    parts = [onset[d[3 * k] % len(onset)] + vowel[d[3 * k + 1] % len(vowel)] + coda[d[3 * k + 2] % len(coda)] for k in range(2 + d[20] % 3)]
    form = d[21] % 6
    return "".join(parts) if form < 3 else "-".join(["".join(parts[:2]), "".join(parts[2:])]).strip("-") if form == 3 else (
        "".join(parts) + str(d[22] % 100) if form == 4 else "".join(parts) + "-" + ALLOWED[d[23] % len(ALLOWED)])


def labelled_urls(spark: SparkSession) -> DataFrame:
    """Small labelled table ``(url, label)``: each host, made-up ones
    included, under several prefixes, domains and neutral paths, so that only
    the name tells; and ordinary hosts with blocked or ordinary words in paths of the same forms,
    so that only the path tells."""
    rows = []
    for label, names in ((1.0, BLOCKED), (0.0, ALLOWED + [made_up_name(i) for i in range(MADE_UP)])):
        for i, n in enumerate(names):
            for j in range(4):
                prefix = ("", "www.", "m.", "blog.")[(i + j) % 4]
                top = ("com", "org", "net")[(i + j) % 3]
                lang = ("en", "fr", "de", "es")[(i // 2 + j) % 4]
                tail = ("", "/", ".html", "?page=2", "#top")[(i + 2 * j) % 5]
                rows.append((f"https://{prefix}{n}.example.{top}/{lang}/{(i * 7919 + j * 104729) % 9000 + 100}{tail}", label))
    forms = ("/{}", "/{}/{n}", "/en/{}/{}", "/{}/{}.html", "/pages/{}-{n}", "/{}/{}/", "/a/{n}/{}", "/{}?id={n}")
    for label, names in ((1.0, BLOCKED), (0.0, ALLOWED)):
        for i, n in enumerate(names):
            for j in range(len(forms)):
                host = ALLOWED[(i * 5 + j * 11 + 1) % len(ALLOWED)]
                top = ("com", "org", "net")[(i + j) % 3]
                path = forms[j].format(n, names[(i * 3 + j * 7 + 2) % len(names)], n=(i * 7919 + j * 104729) % 9000 + 100)
                rows.append((f"https://{('', 'www.')[j % 2]}{host}.example.{top}{path}", label))
    return spark.createDataFrame(rows, "url string, label double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, F.lit("://")) + F.lit(3), F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict (null if none fits)."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        h, _, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(rules[r])).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by where they come from."""
    def cut(mark: str, s: Column, n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.concat(F.lit(mark), F.substring(s, i, F.lit(n))))
        return F.when(F.length(s) >= n, each).otherwise(F.array().cast("array<string>"))

    marked = (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(path, F.lit("$"))))
    return F.concat(*[cut(mark, s, n) for mark, s in marked for n in NGRAMS])


def _features(df: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    df = df.withColumns({"_host": host, "_path": path}).withColumn("_grams", grams(F.col("_host"), F.col("_path")))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_x").transform(df)


def fit_url_model(labelled: DataFrame, reg: float = 0.002, max_iter: int = 60) -> LogisticRegressionModel:
    """Logistic regression on the n-grams of a small labelled table; both
    classes weigh the same in all, however many rows they have."""
    if labelled.limit(MAX_TRAINING_ROWS + 1).count() > MAX_TRAINING_ROWS:
        raise ValueError(f"the labelled table has more than {MAX_TRAINING_ROWS} rows")
    n = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}      # two classes
    weight = F.lit(1.0)
    for label, rows in n.items():
        weight = F.when(F.col("label") == label, sum(n.values()) / (len(n) * rows)).otherwise(weight)
    return LogisticRegression(featuresCol="_x", labelCol="label", weightCol="_w", regParam=reg, maxIter=max_iter,
                              standardization=False).fit(_features(labelled.select("url", "label", weight.alias("_w"))))


def judge_urls(urls: DataFrame, labelled: DataFrame, rules: dict[str, str] = RULES, threshold: float = 0.5,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, block_probability)`` of every row."""
    model = fit_url_model(labelled)
    x = model.transform(_features(urls.select(id_col, F.col(url_col).alias("url"))))
    rule, verdict = matching_rule(F.col("_host"), F.col("_path"), rules)
    p = vector_to_array("probability")[1]
    return x.select(id_col, F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"),
                    F.coalesce(verdict, F.when(p >= threshold, "block").otherwise("allow")).alias("verdict"),
                    p.alias("block_probability"))
