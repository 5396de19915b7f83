"""The subword lattice of words: all ways to cut a word into vocabulary pieces."""

from __future__ import annotations

import numpy as np

from tillwork.llm.words import Rolling, mixed

# Where a piece begins a word the vocabulary has this sign; here it is a space, which no
# word contains.
WORD_START = "▁"
# Cells of one lattice that is worked on at a time.
CELLS = 200_000


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model as bytes, and the weight that its scores give them.

    Byte pieces stand for one byte, so every text has a segmentation. Pieces with a space
    elsewhere than in front never lie in a word and are left out. A score that is a log
    probability is taken as it is; the scores of a merge vocabulary are ranks, 0, -1, -2
    and so on, and a piece of rank r gets the weight of the r-th commonest word in Zipf's
    law.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weights: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        score = model.get_score(i)
        if model.is_byte(i):
            piece, weight = bytes([int(model.id_to_piece(i)[3:5], 16)]), 1e-6
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        else:
            piece = model.id_to_piece(i).replace(WORD_START, " ").encode()
            weight = 1 / (1 - score)
        if piece.rfind(b" ") <= 0:
            weights[piece] = weights.get(piece, 0.0) + weight
    pieces = sorted(weights)
    values = np.array([weights[p] for p in pieces])
    return pieces, values / values.sum()


class Lattice:
    """Sums over all segmentations of words, many words of one length at a time."""

    def __init__(self, pieces: list[bytes]):
        self.rolling = Rolling(7)
        self.symbols = mixed(np.arange(1, 257, dtype=np.uint64))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({len(p) for p in pieces}):
            ids = np.array([i for i, p in enumerate(pieces) if len(p) == size])
            raw = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8).reshape(-1, size)
            hashes = self._windows(raw, size)[:, 0]
            order = np.argsort(hashes)
            self.tables[size] = hashes[order], ids[order]

    def _windows(self, raw: np.ndarray, size: int, sums: np.ndarray | None = None) -> np.ndarray:
        sums = self._sums(raw) if sums is None else sums
        n = raw.shape[1] - size + 1
        return mixed((sums[:, size:] - sums[:, :n]) * self.rolling.inverses[:n])

    def _sums(self, raw: np.ndarray) -> np.ndarray:
        self.rolling.sums(np.zeros(raw.shape[1], np.uint64))  # long enough powers
        sums = np.zeros((raw.shape[0], raw.shape[1] + 1), np.uint64)
        np.cumsum(self.symbols[raw] * self.rolling.powers[: raw.shape[1]], axis=1, out=sums[:, 1:])
        return sums

    def _edges(self, raw: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """For each piece length, the piece that begins at each place, or -1."""
        sums, edges = self._sums(raw), []
        for size, (hashes, ids) in self.tables.items():
            if size > raw.shape[1]:
                break
            here = self._windows(raw, size, sums)
            at = np.searchsorted(hashes, here)
            at[at == len(hashes)] = 0
            found = np.where(hashes[at] == here, ids[at], -1)
            if (found >= 0).any():
                edges.append((size, found))
        return edges

    def _groups(self, tokens: list[bytes]):
        """Words of one length at a time, as rows of bytes with a space in front."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for same in np.split(order, cuts):
            if not len(same):
                continue
            n = int(lengths[same[0]]) + 1
            step = max(1, CELLS // n)
            for start in range(0, len(same), step):
                part = same[start : start + step]
                raw = np.frombuffer(b"".join(b" " + tokens[i] for i in part), np.uint8)
                yield part, raw.reshape(len(part), n)

    @staticmethod
    def _forward(edges, weights: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        """The log weight of all ways from the front to each place."""
        m, n = shape
        ways = np.full((n + 1, m), -np.inf)
        ways[0] = 0.0
        logs = [(size, weights[ids].T) for size, ids in edges]
        for end in range(1, n + 1):
            into = [ways[end - size] + w[end - size] for size, w in logs if size <= end]
            top = np.maximum.reduce(into)
            safe = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore"):
                ways[end] = safe + np.log(sum(np.exp(x - safe) for x in into))
        return ways

    def log_weights(self, tokens: list[bytes], weights: np.ndarray) -> np.ndarray:
        """The natural log of each word's weight, summed over its segmentations."""
        padded = np.r_[weights, -np.inf]  # the last one is what -1 picks
        out = np.empty(len(tokens))
        for part, raw in self._groups(tokens):
            out[part] = self._forward(self._edges(raw), padded, raw.shape)[-1]
        return out

    def expected(self, tokens: list[bytes], weights: np.ndarray) -> np.ndarray:
        """How often each piece is used, summed over the words; each word's segmentations
        count by their share of its weight."""
        padded, counts = np.r_[weights, -np.inf], np.zeros(len(weights))
        for _, raw in self._groups(tokens):
            edges, (m, n) = self._edges(raw), raw.shape
            ahead = self._forward(edges, padded, raw.shape)
            total = ahead[-1]
            back = np.full((n + 1, m), -np.inf)
            back[n] = 0.0
            for start in range(n - 1, -1, -1):
                parts = []
                for size, ids in edges:
                    if start + size <= n:
                        step = padded[ids[:, start]] + back[start + size]
                        parts.append(step)
                        share = np.exp(ahead[start] + step - total)
                        used = share > 0
                        np.add.at(counts, ids[used, start], share[used])
                top = np.maximum.reduce(parts)
                safe = np.where(np.isfinite(top), top, 0.0)
                with np.errstate(divide="ignore"):
                    back[start] = safe + np.log(sum(np.exp(x - safe) for x in parts))
        return counts
