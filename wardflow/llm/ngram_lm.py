"""LM scoring with an Elias-Fano n-gram trie.

Bigram model with Dirichlet smoothing towards the unigram model:

    P(w | v) = (c(v w) + mu * U(w)) / (c(v) + mu),
    U(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),

over words and an end mark; an unknown word has c = 0, so all probabilities of
a context add up to 1.  The trie is stored by predicted word: level 1 the words
of a shard, level 2 the contexts seen before each word, with the quantised
log10 of ``c(v w) + mu U(w)``.  Both levels are Elias-Fano coded monotone
sequences: the pointers from level 1 to level 2, and the context numbers made
monotone by adding the word's place (context-relative); a query is a successor
search among the contexts of its word.

Counts cover the whole training part of the table and no executor holds more
than a shard.  A shard is a range of the words' hashes, of about
``SHARD_TOKENS`` tokens; the words too frequent for one shard (fewer than
eight per shard, by counting all words first) are spread by context, and the
pairs too frequent for one shard (found by counting those of frequent words)
by the flush their documents are in; the counts of both are sent along.  A map
task sends each shard the distinct (word, context,
document) counts of its documents, training and held-out ones alike; the shard
counts, builds its levels in a memory-mapped file without a name, and answers
with a sum per document.  As the smoothed probability is a quotient of a term
of the word and a term of the context, sums over shards give the whole score.

Words: A-Z in lower case, runs of bytes other than white space, then one end
mark.  Defined cases: null text is empty (one token, the end mark); rows stay one
to one, repeated rows and null ids included (a null id counts as empty text in
the hold-out rule); without training rows every count is 0; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.shared import crc_mod, materialise
from wardflow.llm.tokens import LANES, Words, mix, slices, text_buffers

MU = 4.0
SHARD_TOKENS = 2_000_000
FLUSH_TOKENS = 1_000_000
FLUSH_DOCS = 30_000
END, BEGIN = np.uint64(0xE4D), np.uint64(0xB36)
#: bits of a context number within its word, and of a quantised probability
CONTEXT_BITS, LEVELS = 40, 1 << 16
#: values encoded at a time (a multiple of 8)
CHUNK = 1 << 14


class EliasFano:
    """Non-decreasing integers below ``universe``: low bits packed as they
    are, high bits in unary.  ``arrays`` are what is stored."""

    def __init__(self, n: int, low: int, arrays: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.n, self.low, (self.lower, self.upper, self.rank) = n, low, arrays

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> tuple[int, int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        n = len(values)
        low = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        place = np.arange(low, dtype=np.uint64)
        parts = [np.packbits(((v[i:i + CHUNK, None] >> place) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
                 for i in range(0, n if low else 0, CHUNK)]
        lower = np.concatenate([*parts, np.zeros(8, np.uint8)])      # a word can be read from every byte
        high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        upper = np.zeros((int(high[-1]) + 1 if n else 0) // 8 + 1, np.uint8)
        np.bitwise_or.at(upper, high // 8, (1 << (high % 8)).astype(np.uint8))
        ones = np.concatenate([[0], np.cumsum(_ONES[upper], dtype=np.int64)])[::64]   # ones before every 64th byte
        return n, low, (lower, upper, ones)

    def slice(self, a: int, b: int) -> np.ndarray:
        """Values a..b, read from the blocks that hold them."""
        if b <= a:
            return np.zeros(0, np.uint64)
        lo = int(np.searchsorted(self.rank, a, side="right")) - 1
        hi = int(np.searchsorted(self.rank, b - 1, side="right"))
        at = np.flatnonzero(np.unpackbits(self.upper[lo * 64:hi * 64], bitorder="little"))
        at = at[a - int(self.rank[lo]):b - int(self.rank[lo])] + lo * 512
        out = (at - np.arange(a, b)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            at = np.arange(a, b, dtype=np.int64) * self.low
            word = np.ndarray((len(self.lower) - 7,), "<u8", self.lower, strides=(1,))
            out |= (word[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)
        return out


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays again, backed by a memory-mapped file that has no name
    (nothing stays on disk when the task ends)."""
    with tempfile.TemporaryFile() as f:
        at = []
        for a in arrays:
            at.append(f.tell())
            f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * (-f.tell() % 8 or 8))
        f.flush()
        return [np.memmap(f, a.dtype, "r", offset=o, shape=a.shape) if a.size else a for a, o in zip(arrays, at)]


class Trie:
    """Two levels: words (their pointers) and contexts (numbers, codes)."""

    def __init__(self, words: int, word: np.ndarray, context: np.ndarray, value: np.ndarray):
        """``word`` (places 0..words-1, ascending) and ``context`` (numbers,
        ascending within a word) of the stored pairs."""
        start = np.searchsorted(word, np.arange(words + 1))
        child = (word.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | context
        lo, hi = (float(value.min()), float(value.max())) if len(value) else (0.0, 0.0)
        self.base, self.step = lo, (hi - lo) / (LEVELS - 1) or 1.0
        code = np.rint((value - lo) / self.step).astype(np.uint16)
        n1, l1, a1 = EliasFano.encode(start, len(word) + 1)
        n2, l2, a2 = EliasFano.encode(child, words << CONTEXT_BITS)
        m = _mapped([*a1, *a2, code])
        self.pointer, self.child, self.code = EliasFano(n1, l1, tuple(m[:3])), EliasFano(n2, l2, tuple(m[3:6])), m[6]

    def find(self, word: np.ndarray, context: np.ndarray, chunk: int = 1 << 17) -> np.ndarray:
        """Value of each queried pair (sorted by word), NaN if not stored."""
        out = np.full(len(word), np.nan)
        for a in range(0, len(word), chunk):
            w, c = word[a:a + chunk], context[a:a + chunk]
            ptr = self.pointer.slice(int(w[0]), int(w[-1]) + 2).astype(np.int64)
            child = self.child.slice(int(ptr[0]), int(ptr[-1]))
            key = (w.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | c
            at = np.searchsorted(child, key)                     # successor
            hit = at < ptr[w - w[0] + 1] - ptr[0]                # within the word's children
            hit[hit] = child[at[hit]] == key[hit]
            out[a:a + chunk][hit] = self.base + self.step * self.code[int(ptr[0]) + at[hit]].astype(np.float64)
        return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a batch and their counts."""
    for b in batches:
        data, off = text_buffers(b.column("text"))
        parts = [np.unique(Words(data[off[i]:off[j]], off[i:j + 1] - off[i], lower=True).hashes(), return_counts=True) for i, j in slices(off)]
        h, which = np.unique(np.concatenate([np.zeros(0, np.uint64), *[p[0] for p in parts]]), return_inverse=True)
        n = np.bincount(which, np.concatenate([np.zeros(0), *[p[1] for p in parts]]), len(h))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def _tokens(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and document of every token of documents with ``n``
    words each, end marks included."""
    at = np.concatenate([[0], np.cumsum(n + 1)])
    word = np.full(at[-1], END)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    word[inside] = words
    context = np.full(at[-1], BEGIN)
    context[1:] = word[:-1]
    context[at[:-1]] = BEGIN
    return word, context, np.repeat(np.arange(len(n)), n + 1)


def _names(h: np.ndarray) -> np.ndarray:
    """Word hashes that are no mark."""
    return np.where((h == END) | (h == BEGIN), h + np.uint64(1 << 20), h)


def _pair_key(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(word ^ mix(context + np.uint64(LANES[2])))


def _count_pairs(hot: np.ndarray):
    """Counts of the pairs of which both sides are frequent, batch by batch."""
    contexts = np.sort(np.append(hot[hot != END], BEGIN))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column("text"))
            parts = []
            for i, j in slices(off):
                w = Words(data[off[i]:off[j]], off[i:j + 1] - off[i], lower=True)
                word, context, _ = _tokens(_names(w.hashes()), np.diff(w.doc))
                both = np.isin(word, hot) & np.isin(context, contexts)
                parts.append(np.unique(_pair_key(word[both], context[both]), return_counts=True))
            key, which = np.unique(np.concatenate([np.zeros(0, np.uint64), *[p[0] for p in parts]]), return_inverse=True)
            n = np.bincount(which, np.concatenate([np.zeros(0), *[p[1] for p in parts]]), len(key))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return count


def _pack(*arrays: np.ndarray) -> bytes:
    return np.array([a.nbytes for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(blob: bytes, types: tuple) -> list[np.ndarray]:
    size = np.frombuffer(blob, np.int64, len(types))
    at = 8 * len(types) + np.concatenate([[0], np.cumsum(size)])
    return [np.frombuffer(blob, t, int(s) // np.dtype(t).itemsize, int(a)) for t, s, a in zip(types, size, at)]


SENT = (np.uint64, np.uint32, np.uint64, np.uint16, np.uint16, np.uint32)   # words, pairs each; contexts, entries each; document, count
HELD = np.uint16(1 << 15)


def _send(shards: int, hot: np.ndarray, hot_pair: np.ndarray):
    """Rows (shard, kind, flush, blob): kind 0 the counts a shard needs of a
    flush, kind 1 the documents of the flush."""
    def shard_of(word: np.ndarray, context: np.ndarray, number: int) -> np.ndarray:
        own = np.where(np.isin(word, hot), mix(word ^ context), word)
        pair = _pair_key(word, context)
        return (np.where(np.isin(pair, hot_pair), mix(pair ^ np.uint64(number)), own) % np.uint64(shards)).astype(np.int64)

    def flush(number: int, ids: list, held: list, h: list, n: list) -> Iterator[tuple]:
        held, n = np.concatenate(held), np.concatenate(n)
        words = np.concatenate(h)
        word, context, doc = _tokens(words, n)
        names, place = np.unique(np.concatenate([word, context]), return_inverse=True)
        w, c = place[:len(word)].astype(np.uint64), place[len(word):].astype(np.uint64)
        bits = np.uint64(max(1, int(len(names) - 1).bit_length()))
        entry, count = np.unique((w << (bits + np.uint64(16))) | (c << np.uint64(16)) | doc.astype(np.uint64), return_counts=True)
        doc = (entry & np.uint64(0xFFFF)).astype(np.uint16)
        pair = entry >> np.uint64(16)
        first = np.flatnonzero(np.diff(pair, prepend=pair[0] ^ np.uint64(1)))
        each = np.diff(first, append=len(entry))
        word, context = names[pair[first] >> bits], names[pair[first] & ((np.uint64(1) << bits) - np.uint64(1))]
        shard = shard_of(word, context, number)
        doc = doc | np.where(held[doc], HELD, np.uint16(0))
        order = np.argsort(shard, kind="stable")
        for s in np.unique(shard):
            p = order[np.searchsorted(shard[order], s):np.searchsorted(shard[order], s, side="right")]
            start = np.flatnonzero(np.diff(word[p], prepend=word[p[0]] ^ np.uint64(1)))
            e = np.repeat(first[p] - np.concatenate([[0], np.cumsum(each[p])[:-1]]), each[p]) + np.arange(each[p].sum())
            yield int(s), 0, number, _pack(word[p][start], np.diff(start, append=len(p)).astype(np.uint32), context[p],
                                           each[p].astype(np.uint16), doc[e], count[e].astype(np.uint32))
        known = np.array([x is not None for x in ids])
        yield number % shards, 1, number, _pack(np.array([x or 0 for x in ids], np.int64), known, held, (n + 1).astype(np.int64))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, held, h, n, size = [], [], [], [], 0

        def done() -> pa.RecordBatch:
            cols = list(zip(*flush(number, ids, held, h, n)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                                              ["shard", "kind", "flush", "blob"])

        for b in batches:
            data, off = text_buffers(b.column("text"))
            out = b.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for i, j in slices(off):
                for a in range(i, j, FLUSH_DOCS):
                    e = min(j, a + FLUSH_DOCS)
                    if ids and (size > FLUSH_TOKENS or len(ids) + e - a > FLUSH_DOCS):
                        yield done()
                        number, size = number + 1, 0
                        ids, held, h, n = [], [], [], []
                    w = Words(data[off[a]:off[e]], off[a:e + 1] - off[a], lower=True)
                    x = w.hashes()
                    ids += b.column("doc_id").slice(a, e - a).to_pylist()
                    held.append(out[a:e])
                    h.append(_names(x))
                    n.append(np.diff(w.doc))
                    size += len(x)
        if ids:
            yield done()

    return send


def _answer(total: int, distinct: int, hot: np.ndarray, hot_count: np.ndarray, hot_pair: np.ndarray, pair_count: np.ndarray, mu: float):
    """One shard: counts, builds the trie, answers every flush."""
    norm = total + 0.1 * (distinct + 1)

    def answer(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        asked = pdf[pdf.kind == 0]
        out = [tuple(r) for r in pdf.loc[pdf.kind == 1, ["flush", "kind", "blob"]].itertuples(index=False)]
        if len(asked):
            parts = [_unpack(x, SENT) for x in asked.blob]
            names, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            word = np.repeat(place, np.concatenate([p[1] for p in parts]))
            context = np.concatenate([p[2] for p in parts])
            key = _pair_key(names[word], context)
            context = context >> np.uint64(64 - CONTEXT_BITS)
            each = np.concatenate([p[3] for p in parts])
            doc, count = np.concatenate([p[4] for p in parts]), np.concatenate([p[5] for p in parts]).astype(np.float64)
            train = np.where(doc & HELD, 0.0, count)
            # distinct pairs in trie order
            pair, which = np.unique((word.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | context, return_inverse=True)
            of_pair = np.repeat(which, each)
            c_pair = np.bincount(of_pair, train, len(pair))
            if len(hot_pair):                            # here in part only: the whole count was sent along
                at = np.minimum(np.searchsorted(hot_pair, key), len(hot_pair) - 1)
                whole = hot_pair[at] == key
                c_pair[which[whole]] = pair_count[at[whole]]
            w = (pair >> np.uint64(CONTEXT_BITS)).astype(np.int64)
            c_word = np.bincount(w, c_pair, len(names))
            at = np.searchsorted(hot, names)
            is_hot = (at < len(hot)) & (hot[np.minimum(at, len(hot) - 1)] == names) if len(hot) else np.zeros(len(names), bool)
            c_word[is_hot] = hot_count[at[is_hot]]
            prior = mu * (c_word + 0.1) / norm
            seen = c_pair > 0
            ctx = pair & np.uint64((1 << CONTEXT_BITS) - 1)
            trie = Trie(len(names), w[seen], ctx[seen], np.log10(c_pair[seen] + prior[w[seen]]))
            value = trie.find(w, ctx)
            value = np.where(np.isnan(value), np.log10(prior[w]), value)
            leave = np.where(names == END, 0.0, np.log10(c_word + mu))       # as the context of the next token
            value -= leave[w]
            base, known = np.log10(c_word + 0.1)[w], (c_word > 0)[w]
            n = np.array([len(p[4]) for p in parts])
            cut = np.concatenate([[0], np.cumsum(n)])
            doc = doc & np.uint16(HELD - 1)
            for k, f in enumerate(asked.flush):
                s = slice(cut[k], cut[k + 1])
                own, back = np.unique(doc[s], return_inverse=True)
                sums = [np.bincount(back, x[of_pair[s]] * count[s]) for x in (value, base, known)]
                out.append((f, 0, _pack(own, sums[0], sums[1], sums[2].astype(np.uint32))))
        return pd.DataFrame(out, columns=["flush", "kind", "blob"])

    return answer


def _gather(total: int, distinct: int, documents: int, mu: float):
    norm = np.log10(total + 0.1 * (distinct + 1))

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, known, held, n = _unpack(pdf.blob[pdf.kind == 1].iloc[0], (np.int64, bool, bool, np.int64))
        score, base, seen = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for blob in pdf.blob[pdf.kind == 0]:
            d, s, b, k = _unpack(blob, (np.uint16, np.float64, np.float64, np.uint32))
            score[d] += s
            base[d] += b
            seen[d] += k
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids.copy(), ~known),
                             "held_out": held, "n_tokens": n, "n_known": seen, "train_tokens": total,
                             "base_score": base - n * norm, "score": score - np.log10(documents + mu)})

    return gather


def score_corpus(docs: DataFrame, held_out: int = 0, folds: int = 10, mu: float = MU, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` of every document; the model learns from documents whose
    crc32(id) mod ``folds`` is not ``held_out``."""
    d = docs.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held_out).alias("held"), "text")
    train = d.filter(~F.col("held"))
    words = materialise(train.select("text").mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    documents = train.select("doc_id").count()
    r = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = (r["n"] or 0) + documents, r["v"] + (documents > 0)
    shards = max(8, -(-total // shard_tokens))
    hot = {int(END): documents}
    for x in words.filter(F.col("n") > total // (8 * shards)).collect():      # fewer than 8 per shard
        hot[x["h"] & ((1 << 64) - 1)] = x["n"]
    hot_word = np.array(sorted(hot), np.uint64)
    hot_count = np.array([hot[int(x)] for x in hot_word], np.float64)
    pairs = train.select("text").mapInArrow(_count_pairs(hot_word), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    pairs = {x["h"] & ((1 << 64) - 1): x["n"] for x in pairs.filter(F.col("n") > total // (8 * shards)).collect()}      # fewer than 8 per shard
    hot_pair = np.array(sorted(pairs), np.uint64)
    pair_count = np.array([pairs[int(x)] for x in hot_pair], np.float64)
    sent = d.mapInArrow(_send(shards, hot_word, hot_pair), "shard int, kind int, flush long, blob binary")
    answered = sent.groupBy("shard").applyInPandas(_answer(total, distinct, hot_word, hot_count, hot_pair, pair_count, mu), "flush long, kind int, blob binary")
    return answered.groupBy("flush").applyInPandas(_gather(total, distinct, documents, mu),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
