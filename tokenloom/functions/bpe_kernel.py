"""Per-piece BPE encoding kernel, run inside Arrow UDFs.

Rule: repeatedly take the lowest-ranked merge present in the piece and merge
all its occurrences left to right; symbols are compared by bytes.  A heap over
a linked list keeps long junk pieces O(n log n) instead of quadratic.
"""

from __future__ import annotations

import heapq


#: Pieces that a worker remembers, and the longest of them: some 20 MB.
MEMO_PIECES, MEMO_CHARS = 1 << 16, 64


class BpeKernel:
    def __init__(self, vocab: dict[int, bytes], merges: list[tuple[bytes, bytes]], specials: list[str]):
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for i, pair in enumerate(merges):  # a repeated pair keeps its later rank
            self.rank[pair] = i
        inverse: dict[bytes, int] = {}
        for i in sorted(vocab):  # equal bytes: the greatest id wins
            inverse[vocab[i]] = i
        self.inverse = inverse
        self.special_ids = {s: inverse[s.encode("utf-8")] for s in specials if s.encode("utf-8") in inverse}
        self.memo: dict[str, list[int]] = {}

    def encode_piece(self, piece: str) -> list[int]:
        hit = self.memo.get(piece)
        if hit is not None:
            return hit
        sid = self.special_ids.get(piece)
        out = [sid] if sid is not None else self._merge(piece.encode("utf-8"))
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_PIECES:
                self.memo.clear()
            self.memo[piece] = out
        return out

    def encode_pieces(self, pieces) -> list[int]:
        ids: list[int] = []
        for p in pieces:
            ids.extend(self.encode_piece(p))
        return ids

    def _merge(self, data: bytes) -> list[int]:
        n = len(data)
        if n == 0:
            return []
        sym = [data[i : i + 1] for i in range(n)]
        if n == 1:
            return [self.inverse[sym[0]]]
        nxt = list(range(1, n)) + [-1]
        prv = [-1] + list(range(n - 1))
        alive = [True] * n
        rank = self.rank
        heap = []
        for i in range(n - 1):
            r = rank.get((sym[i], sym[i + 1]))
            if r is not None:
                heap.append((r, i, sym[i], sym[i + 1]))
        heapq.heapify(heap)
        while heap:
            r0 = heap[0][0]
            # all entries of the lowest rank, in position order: one left-to-right pass
            batch = []
            while heap and heap[0][0] == r0:
                batch.append(heapq.heappop(heap))
            fresh = []
            for _, i, a, b in batch:
                j = nxt[i] if alive[i] else -1
                if j < 0 or sym[i] != a or sym[j] != b:
                    continue  # stale: already merged into something else
                sym[i] = a + b
                alive[j] = False
                k = nxt[j]
                nxt[i] = k
                if k >= 0:
                    prv[k] = i
                p = prv[i]
                if p >= 0:
                    fresh.append((p, i))
                if k >= 0:
                    fresh.append((i, k))
            for p, q in fresh:
                if alive[p] and alive[q] and nxt[p] == q:
                    r = rank.get((sym[p], sym[q]))
                    if r is not None:
                        heapq.heappush(heap, (r, p, sym[p], sym[q]))
        out = []
        i = 0
        inv = self.inverse
        while i >= 0:
            out.append(inv[sym[i]])
            i = nxt[i]
        return out


def kernel_for(bc) -> BpeKernel:
    """One kernel (and memo) per broadcast per Python worker, kept on the
    worker's broadcast object (workers hold one object per broadcast id)."""
    k = getattr(bc, "_tokenloom_kernel", None)
    if k is None:
        vocab, merges, specials = bc.value
        k = BpeKernel(vocab, merges, specials)
        bc._tokenloom_kernel = k
    return k
