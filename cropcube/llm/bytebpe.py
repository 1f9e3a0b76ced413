"""Byte-pair encoding by speculation and verification.

Greedy longest match proposes the tokens of a word.  Two neighbouring tokens
are compatible if merging the bytes of both by rank gives the same two tokens;
a sequence in which all neighbours are compatible is the one that merging
gives.  Only words with an incompatible pair are merged exactly.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np

from cropcube.llm.common import ragged
from cropcube.llm.pretokens import blocks, spans

#: Words that the table of a worker holds before it starts anew.
TABLE_WORDS = 2_000_000
#: Longer words are matched one by one, not in lockstep.
LOCKSTEP_BYTES = 64
NONE = np.int64(1) << 40


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merge ranks, and a trie over the tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = spec["model"]["vocab"]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * self.size
        for text, i in ids.items():
            if text not in self.special:
                self.tokens[i] = bytes(letters[c] for c in text)
        self.of_bytes = {t: i for i, t in enumerate(self.tokens) if t}
        for text, i in self.special.items():
            self.tokens[i] = text.encode()
        self.byte_ids = np.array([self.of_bytes[bytes([b])] for b in range(256)])
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.made = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token, -1 for bytes
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        for r, (a, b) in enumerate(merges):
            x, y = ids[a], ids[b]
            whole = ids[a + b]
            self.rank[x, y] = (r, whole)
            if self.made[whole] < 0:
                self.made[whole], self.left[whole], self.right[whole] = r, x, y
        pairs = sorted((x * self.size + y, r) for (x, y), (r, _) in self.rank.items())
        self.pair_keys = np.array([p for p, _ in pairs], np.int64)
        self.whole = np.array([ids[a + b] for a, b in merges], np.int64)  # by rank
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        self._trie()
        lengths = np.array([len(t) for t in self.tokens])
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.token_len, self.token_start = lengths, np.cumsum(lengths) - lengths

    def _trie(self) -> None:
        nodes: dict[int, int] = {}
        token: list[int] = [-1]
        for text, i in sorted(self.of_bytes.items()):
            at = 0
            for b in text:
                key = at << 8 | b
                nxt = nodes.get(key)
                if nxt is None:
                    nxt = nodes[key] = len(token)
                    token.append(-1)
                at = nxt
            token[at] = i
        keys = np.array(sorted(nodes), np.int64)
        self.edges, self.targets = keys, np.array([nodes[k] for k in keys.tolist()], np.int64)
        self.node_token = np.array(token, np.int64)
        self.longest = max(map(len, self.of_bytes))

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word: the lowest rank first, leftmost among equals."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank[a, b][1], -1
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if r := rank.get((ids[i], ids[k])):
                    heapq.heappush(heap, (r[0], i, ids[i], ids[k]))
            if (h := prv[i]) >= 0 and (r := rank.get((ids[h], ids[i]))):
                heapq.heappush(heap, (r[0], h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """:meth:`merge` of many words; short ones in lockstep, a row of a matrix each."""
        out: list[list[int]] = [[]] * len(words)
        size = np.array([len(w) for w in words])
        for w in np.flatnonzero(size > LOCKSTEP_BYTES).tolist():
            out[w] = self.merge(words[w])
        width = 8
        while width <= LOCKSTEP_BYTES:
            who = np.flatnonzero((size <= width) & (size > (width // 2 if width > 8 else 0)))
            if len(who):
                rows, counts = self._merge_matrix([words[w] for w in who.tolist()], size[who], width)
                for w, ids, n in zip(who.tolist(), rows.tolist(), counts.tolist(), strict=True):
                    out[w] = ids[:n]
            width *= 2
        return out

    def _merge_matrix(self, words: list[bytes], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = np.pad(self.byte_ids[raw], ((0, 0), (0, 1)))
        cols = np.arange(width + 1)
        rank = np.where(cols[:-1] < size[:, None] - 1, self.pair_rank(ids[:, :-1], ids[:, 1:]), NONE)
        count = size.copy()
        done, left = np.zeros_like(ids), np.zeros_like(count)
        live = np.arange(len(words))
        while len(live):
            j = rank.argmin(axis=1)
            each = np.arange(len(live))
            low = rank[each, j]
            go = low < NONE
            done[live[~go]], left[live[~go]] = ids[~go], count[~go]
            live, ids, rank, count, j, low = live[go], ids[go], rank[go], count[go] - 1, j[go], low[go]
            if not len(live):
                break
            each, at = np.arange(len(live)), j[:, None]
            ids = np.take_along_axis(ids, np.minimum(cols + (cols > at), width), axis=1)
            rank = np.take_along_axis(rank, np.minimum(cols[:-1] + (cols[:-1] > at), width - 1), axis=1)
            ids[each, j] = new = self.whole[low]
            rank[each, j] = np.where(j + 1 < count, self.pair_rank(new, ids[each, j + 1]), NONE)
            some = np.flatnonzero(j > 0)
            rank[some, j[some] - 1] = self.pair_rank(ids[some, j[some] - 1], new[some])
            rank[each, count - 1] = NONE
        return done, left

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a and b keeps the border between them, for arrays of pairs.

        Walks back in time: x is the last part of a and y the first part of b at some
        moment; gone_x and gone_y are the ranks at which they merge into larger parts.
        A merge across the border happens if its rank comes before both (of equal
        ranks the leftmost is first).
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        gone_x = np.full(len(a), NONE)
        gone_y = np.full(len(a), NONE)
        while len(live):
            across = self.pair_rank(x, y)
            bad = (across < NONE) & (across < gone_x) & (across <= gone_y)
            ok[live[bad]] = False
            go = ~bad & ((self.made[x] >= 0) | (self.made[y] >= 0))
            live, x, y, gone_x, gone_y = live[go], x[go], y[go], gone_x[go], gone_y[go]
            split_y = self.made[y] >= self.made[x]
            gone_x, gone_y = np.where(split_y, gone_x, self.made[x]), np.where(split_y, self.made[y], gone_y)
            x, y = np.where(split_y, x, self.right[x]), np.where(split_y, self.left[y], y)
        return ok

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest-match tokens of all words (flat), and the number of each word's tokens."""
        n = len(words)
        size = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        first = np.cumsum(size) - size
        end = first + size
        found_word: list[np.ndarray] = []
        found_id: list[np.ndarray] = []
        at_word = np.flatnonzero(size <= LOCKSTEP_BYTES)
        pos, stop = first[at_word], end[at_word]
        node = np.zeros(len(at_word), np.int64)
        best = np.full(len(at_word), -1, np.int64)
        best_pos = pos.copy()
        live = size[at_word] > 0
        at_word, pos, stop, node, best, best_pos = (v[live] for v in (at_word, pos, stop, node, best, best_pos))
        while len(at_word):
            key = node << 8 | data[pos]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            can = (pos < stop) & (self.edges[edge] == key)
            node = np.where(can, self.targets[edge], 0)
            token = np.where(can, self.node_token[node], -1)
            pos = pos + can
            hit = token >= 0
            best, best_pos = np.where(hit, token, best), np.where(hit, pos, best_pos)
            stuck = ~can | (pos >= stop)
            if stuck.any():
                found_word.append(at_word[stuck])
                found_id.append(best[stuck])
                pos = np.where(stuck, best_pos, pos)
                node = np.where(stuck, 0, node)
                best = np.where(stuck, -1, best)
                more = pos < stop
                if not more.all():
                    at_word, pos, stop, node, best, best_pos = (
                        v[more] for v in (at_word, pos, stop, node, best, best_pos))
        for w in np.flatnonzero(size > LOCKSTEP_BYTES).tolist():
            ids = self._greedy_one(words[w])
            found_word.append(np.full(len(ids), w))
            found_id.append(np.array(ids))
        if not found_word:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        word, ids = np.concatenate(found_word), np.concatenate(found_id)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=n)

    def _greedy_one(self, word: bytes) -> list[int]:
        out, at = [], 0
        while at < len(word):
            for to in range(min(len(word), at + self.longest), at, -1):
                if (i := self.of_bytes.get(word[at:to])) is not None:
                    out.append(i)
                    at = to
                    break
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Exact tokens of all words (flat), counts by word, and how many words needed merging."""
        ids, count = self.greedy(words)
        stop = np.cumsum(count)
        inner = np.ones(len(ids), bool)
        inner[stop[count > 0] - 1] = False  # a word's last token has no right neighbour
        at = np.flatnonzero(inner)
        pair, where = np.unique(ids[at] * self.size + ids[at + 1], return_inverse=True)
        bad = at[~self.compatible(pair // self.size, pair % self.size)[where]]
        if not len(bad):
            return ids, count, 0
        wrong = np.unique(np.searchsorted(stop, bad, side="right"))
        fixed = self.merge_all([words[w] for w in wrong.tolist()])
        keep = np.ones(len(words), bool)
        keep[wrong] = False
        own = np.array([len(x) for x in fixed], np.int64)
        total = count.copy()
        total[wrong] = own
        begin = np.cumsum(total) - total
        out = np.empty(int(total.sum()), np.int64)
        out[ragged(begin[keep], count[keep])] = ids[ragged((stop - count)[keep], count[keep])]
        out[ragged(begin[wrong], own)] = [i for x in fixed for i in x]
        return out, total, len(wrong)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts with a table of the words met so far (bounded, then begun anew)."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.special = next(iter(self.v.special), None)
        self.clear()

    def clear(self) -> None:
        special = [self.v.special[self.special]] if self.special else []
        self.keys = np.zeros(1, np.uint64)  # hash 0 is the special token
        self.where = np.zeros(1, np.int64)
        self.start = np.zeros(1, np.int64)
        self.count = np.array([len(special)], np.int64)
        self.flat = np.array(special, np.int32)
        self.words = self.merged = 0

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        ids, count, merged = self.v.encode_words(words)
        at = len(self.start) + np.arange(len(words))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        place = np.searchsorted(self.keys, keys)
        self.keys, self.where = np.insert(self.keys, place, keys), np.insert(self.where, place, at)
        self.words += len(words)
        self.merged += merged

    def lookup(self, joined: str, s: np.ndarray, e: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Table index of every pre-token of a block; unknown words are encoded first."""
        if len(self.keys) > TABLE_WORDS:
            self.clear()
        known, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, known), len(self.keys) - 1)
        new = np.flatnonzero(self.keys[at] != known)
        if len(new):
            who = first[new]
            words = [joined[a:b].encode() for a, b in zip(s[who].tolist(), e[who].tolist(), strict=True)]
            self._learn(known[new], words)
            at = np.searchsorted(self.keys, known)
        return self.where[at][back]

    def encode(self, texts: list[str]):
        """Yield (row, ids) for consecutive pieces of the texts, in order; a long text has several."""
        for rows, joined in blocks(texts, self.special):
            s, e, h, piece = spans(joined)
            if not len(s):
                for row in rows.tolist():
                    yield row, self.flat[:0]
                continue
            at = self.lookup(joined, s, e, h)
            count = self.count[at]
            ids = self.flat[ragged(self.start[at], count)]
            stop = np.cumsum(np.bincount(piece, weights=count, minlength=len(rows)).astype(np.int64)).tolist()
            begin = 0
            for row, to in zip(rows.tolist(), stop, strict=True):
                yield row, ids[begin:to]
                begin = to

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the decoded text: token bytes in a row, invalid UTF-8 replaced."""
        length = self.v.token_len[ids]
        raw = self.v.token_bytes[ragged(self.v.token_start[ids], length)].tobytes()
        return raw.decode("utf-8", "replace").encode()


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)
