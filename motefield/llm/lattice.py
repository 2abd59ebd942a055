"""Marginal probabilities of words under a unigram model of subword pieces.

A word (with its leading blank) is a lattice: every piece that matches at a position is an
arc.  The probability of the word is the sum over all segmentations, found by a forward
recursion in log space; a backward recursion gives expected piece counts.  Words of one
length are handled together, a trie of the pieces walks all of them at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

BATCH = 1 << 14
_NONE = -np.inf


class Pieces:
    """A trie over piece byte strings as a dense table of moves; equal strings share a leaf."""

    def __init__(self, pieces: list[bytes]):
        self.names = sorted(set(pieces))
        used = sorted({b for p in self.names for b in p})
        self.of_byte = np.full(256, len(used), np.int64)         # other bytes move nowhere
        self.of_byte[used] = np.arange(len(used))
        nodes, rows, leaves = {b"": 0}, [], {}
        for k, p in enumerate(self.names):
            for i in range(1, len(p) + 1):
                if p[:i] not in nodes:
                    nodes[p[:i]] = len(nodes)
                    rows.append((nodes[p[:i - 1]], self.of_byte[p[i - 1]], nodes[p[:i]]))
            leaves[nodes[p]] = k
        self.move = np.zeros((len(nodes), len(used) + 1), np.min_scalar_type(len(nodes)))     # 0: no such piece goes on
        a, b, c = np.array(rows).T
        self.move[a, b] = c
        self.leaf = np.full(len(nodes), -1, np.int32)
        self.leaf[list(leaves)] = list(leaves.values())
        self.longest = max(map(len, self.names))

    def __reduce__(self):
        """Only the names travel; a worker builds its table once."""
        return pieces_of, (tuple(self.names),)

    def arcs(self, codes: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """End, words and pieces of the arcs that leave position ``start`` of words (one per row of ``codes``)."""
        word, node = np.arange(len(codes)), np.zeros(len(codes), self.move.dtype)
        for end in range(start + 1, min(codes.shape[1], start + self.longest) + 1):
            node = self.move[node, codes[word, end - 1]]
            on = node > 0
            word, node = word[on], node[on]
            if not len(word):
                return
            piece = self.leaf[node]
            hit = piece >= 0
            yield end, word[hit], piece[hit]

    def forward(self, codes: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations up to each position."""
        total = np.full((len(codes), codes.shape[1] + 1), _NONE)
        total[:, 0] = 0
        for start in range(codes.shape[1]):
            for end, word, piece in self.arcs(codes, start):
                total[word, end] = np.logaddexp(total[word, end], total[word, start] + scores[piece])
        return total

    def expected(self, codes: np.ndarray, scores: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in weighted words."""
        front = self.forward(codes, scores)
        out, width = np.zeros(len(self.names)), codes.shape[1]
        back = np.full(front.shape, _NONE)
        back[:, width] = 0
        for start in range(width - 1, -1, -1):
            for end, word, piece in self.arcs(codes, start):
                onward = scores[piece] + back[word, end]
                back[word, start] = np.logaddexp(back[word, start], onward)
                share = np.exp(front[word, start] + onward - front[word, width]) * weight[word]
                out += np.bincount(piece, share, len(out))
        return out

    def batches(self, data: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words as (indices, codes), each batch of one length and with a leading blank."""
        begins = np.append(0, np.cumsum(lengths))[:-1]
        order = np.argsort(lengths, kind="stable")
        sizes, starts = np.unique(lengths[order], return_index=True)
        for size, lo, hi in zip(sizes, starts, np.append(starts[1:], len(order))):
            step = int(max(1, min(BATCH, BATCH * 16 // (size + 1))))
            for at in range(lo, hi, step):
                ids = order[at:min(at + step, hi)]
                letters = data[begins[ids][:, None] + np.arange(size)]
                codes = np.full((len(ids), size + 1), self.of_byte[0x20])
                codes[:, 1:] = self.of_byte[letters]
                yield ids, codes

    def log_probability(self, data: np.ndarray, lengths: np.ndarray, scores: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lengths))
        for ids, codes in self.batches(data, lengths):
            out[ids] = self.forward(codes, scores)[:, -1]
        return out

    def expected_counts(self, data: np.ndarray, lengths: np.ndarray, weight: np.ndarray, scores: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.names))
        for ids, codes in self.batches(data, lengths):
            out += self.expected(codes, scores, weight[ids])
        return out


@lru_cache(maxsize=2)
def pieces_of(names: tuple[bytes, ...]) -> Pieces:
    return Pieces(list(names))


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes (a word's leading mark as a blank) and their ranks, from a SentencePiece model."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        name = model.id_to_piece(i)
        pieces.append(bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode())
        ranks.append(-model.get_score(i))
    return pieces, np.array(ranks)
