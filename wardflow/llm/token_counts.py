"""Token counts under a unigram tokenizer, with the forward scores of shared
prefixes computed once.

A task inserts the distinct pre-tokens (words with a leading word mark) of a
stretch of documents in a trie and walks it depth first: a node's forward score
is the best of its ancestors' scores plus the score of the piece between, so
words that share a prefix share its scores.  The number of pieces of the best
segmentation is stored at the terminals and summed per document.  No shuffle:
documents stay where they are read, memory is bounded by the stretch and by
``CACHE`` remembered words.

The vocabulary file is a parameter.  Its pieces carry merge ranks, not
probabilities; the unigram model gives the piece of rank r a probability
proportional to 1 / (r + 1).  Characters that no piece covers fall back to one
piece per UTF-8 byte.  Of equally good segmentations the one with fewer pieces
counts.

Defined cases: null or blank text has no tokens; rows stay one to one, repeated
ones included; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.tokens import Words, slices, text_buffers

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE = 400_000
STRETCH = 8 << 20


def load_vocabulary(path: str = VOCABULARY) -> tuple[dict[str, float], float]:
    """Log-probability of each piece, and that of one fallback byte.  The
    file is read on the driver; its size bounds what is broadcast."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rank = {sp.id_to_piece(i): -sp.get_score(i) for i in range(sp.get_piece_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    total = math.log(sum(1.0 / (r + 1.0) for r in rank.values()))
    pieces = {p: -math.log(r + 1.0) - total for p, r in rank.items()}
    return pieces, min(pieces.values()) - math.log(256.0)


class PrefixCounter:
    """Counts of pre-tokens in sorted order: the stack holds the forward
    (score, -pieces) of every prefix of the last one, i.e. the path of the
    trie from the root."""

    def __init__(self, pieces: dict[str, float], byte: float):
        self.pieces, self.byte, self.longest = pieces, byte, max(map(len, pieces), default=1)
        self.steps = 0

    def counts(self, words: list[str]) -> dict[str, int]:
        pieces, longest, out = self.pieces, self.longest, {}
        last, score, number = "", [0.0], [0]
        for word in sorted(words):
            same = 0
            for x, y in zip(word, last):
                if x != y:
                    break
                same += 1
            del score[same + 1:], number[same + 1:]
            for i in range(same + 1, len(word) + 1):
                own = len(word[i - 1].encode("utf-8", "surrogatepass"))
                best, fewest = score[i - 1] + own * self.byte, number[i - 1] + own
                for j in range(max(0, i - longest), i):
                    p = pieces.get(word[j:i])
                    if p is not None:
                        p += score[j]
                        if p > best or (p == best and number[j] + 1 < fewest):
                            best, fewest = p, number[j] + 1
                score.append(best)
                number.append(fewest)
                self.steps += 1
            last, out[word] = word, number[-1]
        return out


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, cache = PrefixCounter(*shared.value), {}
        for b in batches:
            data, off = text_buffers(b.column("text"))
            for i, j in slices(off, STRETCH):
                raw = data[off[i]:off[j]].tobytes()
                owners, codes, first, hashes = [], [], [], []
                for a, e in slices(off[i:j + 1]):
                    base = off[i + a] - off[i]
                    w = Words(data[off[i + a]:off[i + e]], off[i + a:i + e + 1] - off[i + a])
                    h, at, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
                    hashes.append(h)
                    first += [raw[base + s:base + t] for s, t in zip(w.start[at], w.end[at])]
                    codes.append(inverse)
                    owners.append(w.owner() + a)
                names = np.concatenate([np.zeros(0, np.uint64), *hashes]).tolist()
                new = {h: MARK + x.decode("utf-8") for h, x in zip(names, first) if h not in cache}
                if len(cache) + len(new) > CACHE:
                    cache = {}
                    new = {h: MARK + x.decode("utf-8") for h, x in zip(names, first)}
                counted = counter.counts(list(new.values()))
                cache.update((h, counted[x]) for h, x in new.items())
                each = np.array([cache[h] for h in names], np.int64)
                at, number, words = 0, np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                for h, c, o in zip(hashes, codes, owners):
                    number += np.bincount(o, each[at:at + len(h)][c], j - i).astype(np.int64)
                    words += np.bincount(o, minlength=j - i)
                    at += len(h)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(words), pa.array(number)],
                                                 ["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "doc_id long, n_words long, n_tokens long")
