"""Token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token's best segmentation into pieces of a unigram vocabulary is found from left to
right: the best score of a prefix depends on that prefix alone. So the distinct pre-tokens
of a task go into a trie, the forward scores are computed once per trie node, level by
level, and each pre-token's count is read at its terminal node. Where a level has few nodes
left, as in long runs without spaces, each of them goes on by itself through a trie of the
pieces, from the scores of the prefix it shares. A document's count is the sum over its
pre-tokens.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomline.llm.words import SPACED, text_slices

#: Where the vocabulary lies by default: a SentencePiece model of public origin.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Log score of a byte that no piece covers.
UNKNOWN = -30.0
#: Distinct pre-tokens that a task remembers between batches, about, and bytes of one.
REMEMBERED = 400_000
REMEMBERED_BYTES = 256
#: Words from which a level of the trie is worked on as a whole.
FEW = 24
_U = np.uint64


@dataclass
class Pieces:
    """Hashes of the pieces' bytes, sorted, with their log scores; longest is in bytes."""

    hashes: np.ndarray
    scores: np.ndarray
    longest: int
    #: Whether some piece has these last bits of its mixed hash; tells most strings apart at once.
    sieve: np.ndarray
    #: The pieces as a trie: by byte the next node, by -1 the score.
    trie: dict


SIEVE_BITS = 20


def _sieve(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _U(0x9E3779B97F4A7C15)) >> _U(64 - SIEVE_BITS)).astype(np.int64)


def _hash_bytes(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * 0x100000001B3 + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def pieces_of(scored: list[tuple[bytes, float]]) -> Pieces:
    best: dict[int, float] = {}
    for piece, score in scored:
        if piece:
            h = _hash_bytes(piece)
            best[h] = max(score, best.get(h, -math.inf))
    hashes = np.array(sorted(best), dtype=np.uint64)
    sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
    sieve[_sieve(hashes)] = True
    trie: dict = {}
    for piece, score in scored:
        at = trie
        for b in piece:
            at = at.setdefault(b, {})
        if piece:
            at[-1] = max(score, at.get(-1, -math.inf))
    return Pieces(hashes, np.array([best[int(h)] for h in hashes]), max((len(p) for p, _ in scored), default=0), sieve, trie)


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """Pieces of a SentencePiece model, "▁" standing for the space before a pre-token.

    A unigram model gives the log probabilities of its pieces. One of merges, as the default,
    gives their ranks alone: a piece of rank r then scores -log(r + 2) less a constant, as
    in a Zipf law, under which the shortest segmentation wins nearly always. Nothing here is
    fitted to a corpus.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    own = [model.get_score(i) for i in ids]
    if all(x == int(x) for x in own):
        own = [-4.0 - math.log(r + 2) for r in range(len(ids))]
    return pieces_of([(model.id_to_piece(i).replace("▁", " ").encode(), x) for i, x in zip(ids, own, strict=True)])


def _go_on(word: bytes, done: int, scores: list[float], counts: list[int], pieces: Pieces) -> int:
    """Tokens of a word whose best scores and counts are known for the prefixes up to `done` bytes, the last ones given."""
    first = done + 1 - len(scores)
    n = len(word)
    best = scores + [-math.inf] * (n - done)
    least = counts + [0] * (n - done)
    trie = pieces.trie
    for p in range(first, n):
        at = p - first
        if p > done and best[at - 1] + UNKNOWN > best[at] + 1e-9:
            best[at], least[at] = best[at - 1] + UNKNOWN, least[at - 1] + 1
        here, number = best[at], least[at] + 1
        node = trie
        for q in range(p, n):
            node = node.get(word[q])
            if node is None:
                break
            score = node.get(-1)
            if score is not None and q >= done:
                to = q + 1 - first
                value = here + score
                if value > best[to] + 1e-9 or (value > best[to] - 1e-9 and number < least[to]):
                    best[to], least[to] = value, number
    if best[-2] + UNKNOWN > best[-1] + 1e-9:
        return least[-2] + 1
    return least[-1]


def counts_of(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """Tokens in the best segmentation of each of these distinct byte strings.

    Level d of the trie holds one node per distinct prefix of d bytes. Its forward score is
    the best over piece lengths of an ancestor's score plus the piece's; bytes that no piece
    covers count as one token each. Of equal scores fewer tokens win, then the longer piece.
    """
    if not words:
        return np.empty(0, np.int64)
    order = sorted(range(len(words)), key=words.__getitem__)
    lengths = np.array([len(words[i]) for i in order])
    data = np.frombuffer(b"".join(words[i] for i in order), dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    out = np.zeros(len(words), dtype=np.int64)
    depth = int(lengths.max()) if len(lengths) else 0
    # The words alive at a level, in order, and for each the number of its node there.
    alive = np.arange(len(words))
    node = np.zeros(len(words), dtype=np.int64)
    back = pieces.longest
    # The last levels' scores, tokens and prefix hashes by node, and each node's ancestors.
    score, tokens, prefix = [np.zeros(1)], [np.zeros(1, np.int64)], [np.zeros(1, np.uint64)]
    up: list[np.ndarray] = [np.zeros(1, np.int64)]
    power = [_U(1)]
    out[[order[i] for i in np.flatnonzero(lengths == 0)]] = 0
    for d in range(1, depth + 1):
        keep = lengths[alive] >= d
        alive, node = alive[keep], node[keep]
        if len(alive) < FEW and d > 1:
            for i, at in zip(alive.tolist(), node.tolist(), strict=True):
                scores, counts = [], []
                for back_by in range(1, min(back, d - 1) + 2):  # prefixes of d - 1 bytes, d - 2, ...
                    scores.append(float(score[-back_by][at]))
                    counts.append(int(tokens[-back_by][at]))
                    at = int(up[-back_by][at])
                out[order[i]] = _go_on(words[order[i]], d - 1, scores[::-1], counts[::-1], pieces)
            break
        byte = data[begin[alive] + d - 1]
        fresh = np.ones(len(alive), dtype=bool)
        fresh[1:] = (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])
        parent, symbol = node[fresh], byte[fresh]
        node = np.cumsum(fresh) - 1
        n = len(parent)
        with np.errstate(over="ignore"):
            prefix.append(prefix[-1][parent] * _U(0x100000001B3) + symbol.astype(np.uint64) + _U(1))
            if len(power) <= back:
                power.append(power[-1] * _U(0x100000001B3))
        best = score[-1][parent] + UNKNOWN
        least = tokens[-1][parent] + 1
        at = parent
        for length in range(1, min(back, d) + 1):
            if length > 1:
                at = up[-length + 1][at]
            with np.errstate(over="ignore"):
                piece = prefix[-1] - prefix[-1 - length][at] * power[length]
            hit = np.flatnonzero(pieces.sieve[_sieve(piece)])
            if len(hit):
                place = np.minimum(np.searchsorted(pieces.hashes, piece[hit]), len(pieces.hashes) - 1)
                real = pieces.hashes[place] == piece[hit]
                hit, place = hit[real], place[real]
            if len(hit):
                value = score[-length][at[hit]] + pieces.scores[place]
                number = tokens[-length][at[hit]] + 1
                better = (value > best[hit] + 1e-9) | ((np.abs(value - best[hit]) <= 1e-9) & (number <= least[hit]))
                best[hit[better]], least[hit[better]] = value[better], number[better]
        score.append(best)
        tokens.append(least)
        up.append(parent)
        if len(score) > back + 1:
            score, tokens, prefix, up = score[-back - 1 :], tokens[-back - 1 :], prefix[-back - 1 :], up[-back - 1 :]
        done = lengths[alive] == d
        if done.any():
            out[np.array(order)[alive[done]]] = least[node[done]]
    return out


def pre_tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[bytes], np.ndarray]]:
    """(first row, row of each pre-token, distinct pre-tokens, number of each) of runs of rows.

    A pre-token is a run of characters that are not white space, with the space before it.
    """
    for first, data, offsets in text_slices(column):
        inside = SPACED[data]
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside
        before[offsets] = False
        after = np.zeros(len(data) + 1, dtype=bool)
        after[: len(data)] = inside
        after[offsets] = False
        start = np.flatnonzero(inside & ~before[:-1])
        end = np.flatnonzero(inside & ~after[1:]) + 1
        row = np.searchsorted(offsets, start, side="right") - 1
        raw = data.tobytes()
        number: dict[bytes, int] = {}
        which = np.fromiter((number.setdefault(raw[a:b], len(number)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), dtype=np.int64, count=len(start))
        yield first, row, list(number), np.concatenate((which, [len(offsets) - 1]))


def _counted(pieces) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            slices = list(pre_tokens(batch.column(1)))
            new = list({w for _, _, words, _ in slices for w in words} - known.keys())
            counted = dict(zip(new, counts_of([b" " + w for w in new], pieces.value).tolist(), strict=True))
            for first, row, words, which in slices:
                rows, which = int(which[-1]), which[:-1]
                per = np.fromiter((known[w] if w in known else counted[w] for w in words), dtype=np.int64, count=len(words))
                total = np.bincount(row, weights=per[which], minlength=rows).astype(np.int64)
                number = np.bincount(row, minlength=rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, rows), pa.array(number, pa.int64()), pa.array(total, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])
            known = {} if len(known) > REMEMBERED else known
            known.update((w, n) for w, n in counted.items() if len(w) <= REMEMBERED_BYTES)

    return run


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_pretokens, n_tokens.

    Null, empty and blank texts count 0. Texts are counted whole, pre-tokens of any length
    too. Ids pass as they are, null or repeated; an empty table gives an empty one; other
    columns play no part.
    """
    from pyspark.sql import functions as F

    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_counted(pieces), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pretokens long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLE: dict[str, str] = {}
