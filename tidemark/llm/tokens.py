"""Token ids of whole texts, with each distinct piece of text encoded once a worker.

A byte-level BPE tokenizer first splits a text by a fixed pattern over letters, numbers, white
space and the rest, and encodes every piece by itself. The splitting is done here on arrays of
code points, whose kinds are asked of the tokenizer itself, and only pieces that the worker has
not met are encoded. Where the tokenizer's merges are ranked like its ids, as is checked, a
faster encoder with the same vocabulary does that. Texts with added tokens in them, and other
kinds of tokenizer, go through the tokenizer as a whole, so the ids are always its own.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from tidemark.llm.arrays import mix64, text_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_PIECES = 300_000
CHUNK = 1 << 19
LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 255
_BASE = 0xD1342543DE82EF95
_LOADED: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        split = made.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in made.get("added_tokens", [])]
        self.by_piece = (
            made.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and made["model"].get("type") == "BPE"
        )
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.ranked = self._ranked(made["model"]) if self.by_piece else None
        self._clear()

    def _ranked(self, model: dict):
        """An encoder by ranks, and which ids start with a blank; None where ranks do not decide."""
        import tiktoken

        vocab = model["vocab"]
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in letters]
        byte_of = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(rest)}
        added = set(self.added)
        if any(c not in byte_of for t in vocab if t not in added for c in t):
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocab.get("".join(pair), -1) for pair in pairs]
        if model.get("ignore_merges") or len(ids) != len(set(ids)) or ids != sorted(ids) or (ids and ids[0] < 256):
            return None
        if any(vocab.get(c, 256) > 255 for c in byte_of) or len(vocab) != 256 + len(ids) + len(added & set(vocab)):
            return None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
        blank = np.zeros(max(ranks.values()) + 1, bool)
        blank[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        # one piece a call, or many that each have one blank, their first character
        return tiktoken.Encoding("ranks", pat_str=r" [^ ]+|(?s:[^ ].*)", mergeable_ranks=ranks, special_tokens={}), blank

    def _clear(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the rows' bounds; null is empty."""
        data, bounds = text_bytes(column)
        ids, sizes = [np.zeros(0, np.uint32)], []
        rows, first = len(column), 0
        while first < rows:
            end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + CHUNK, "right")) - 1)
            text = data[bounds[first] : bounds[end]].tobytes()
            if self.by_piece and not any(a.encode() in text for a in self.added):
                flat, size = self._by_piece(text, bounds[first : end + 1] - bounds[first])
                ids.append(flat)
                sizes.extend(size.tolist())
            else:
                for k in range(first, end):
                    one = self.tokenizer.encode(data[bounds[k] : bounds[k + 1]].tobytes().decode(), add_special_tokens=False)
                    ids.append(np.array(one.ids, np.uint32))
                    sizes.append(len(one.ids))
            first = end
        return np.concatenate(ids), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))

    def _kind_of(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            alone = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for p in np.unique(points[kinds == UNKNOWN]).tolist():
                joins = [len(alone(lead + chr(p))) == 1 for lead in ("a", "1", "!")]
                self.kinds[p] = joins.index(True) if any(joins) else 3
                self.kinds[p] = {0: LETTER, 1: NUMBER, 2: OTHER, 3: SPACE}[int(self.kinds[p])]
            kinds = self.kinds[points]
        return kinds

    def _starts(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Where pieces start, as positions."""
        n = len(points)
        kind = self._kind_of(points)
        fresh = np.zeros(n + 1, bool)  # first of a row
        fresh[rows] = True
        change = np.ones(n + 1, bool)
        change[1:n] = (kind[1:] != kind[:-1]) | fresh[1:n]
        start = change[:n].copy()
        space = kind == SPACE
        blank = points == 0x20
        # the last of several spaces before a word stands apart, and a blank joins the word
        last = space & change[1:] & ~fresh[1:]
        start |= last
        start[1:] &= ~(blank[:-1] & ~space[1:] & ~fresh[1:n])
        # 's 't 'm 'd 're 've 'll right after anything but a blank
        mark = np.flatnonzero((points == 0x27) & start & change[:n] & change[1:])
        mark = mark[mark + 1 < n]
        mark = mark[~fresh[mark + 1]]
        after = points[mark + 1]
        one = np.isin(after, [ord(c) for c in "stmd"])
        follow = points[np.minimum(mark + 2, n - 1)]
        inside = (mark + 2 < n) & ~fresh[np.minimum(mark + 2, n)]
        two = np.zeros(len(mark), bool)
        for pair in ("re", "ve", "ll"):
            two |= inside & (after == ord(pair[0])) & (follow == ord(pair[1]))
        for where, length in ((mark[one], 2), (mark[two], 3)):
            for k in range(1, length):
                start[where + k] = False
            more = where[where + length < n] + length
            start[more] = True
        # a piece after a contraction keeps its blank rule: a word after a blank starts at the blank
        start[1:] &= ~(blank[:-1] & ~space[1:] & ~fresh[1:n])
        return np.flatnonzero(start)

    def _by_piece(self, raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = raw.decode()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        firsts = np.frombuffer(raw, np.uint8)
        before = np.concatenate(([0], np.cumsum((firsts & 0xC0) != 0x80)))
        rows = before[bounds]
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        starts = self._starts(points, rows)
        ends = np.append(starts[1:], len(points))
        powers, inverse = _powers(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mix64(points.astype(np.uint64) + np.uint64(1)) * powers[: len(points)], out=sums[1:])
        hashed = mix64((sums[ends] - sums[starts]) * inverse[starts])
        distinct, at, back = np.unique(hashed, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE_PIECES:
            self._clear()
        near = np.searchsorted(self.hashes, distinct)
        met = np.zeros(len(distinct), bool)
        inside = near < len(self.hashes)
        met[inside] = self.hashes[near[inside]] == distinct[inside]
        if not met.all():
            new = np.flatnonzero(~met)
            self._learn(distinct[new], [text[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
            near = np.searchsorted(self.hashes, distinct)
        slots = self.slots[near]
        low, size = self.ends[slots][back], (self.ends[slots + 1] - self.ends[slots])[back]
        edges = np.concatenate(([0], np.cumsum(size)))
        flat = self.flat[np.repeat(low - edges[:-1], size) + np.arange(edges[-1])]
        return flat, np.diff(edges[np.searchsorted(starts, rows)])

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Ids of new pieces, kept for later."""
        ids: list[np.ndarray] = []
        sizes = np.zeros(len(words), np.int64)
        order: list[int] = []
        if self.ranked:
            ranks, blank = self.ranked
            joined = [k for k, w in enumerate(words) if w[0] == " " and len(w) > 1 and " " not in w[1:]]
            rest = [k for k in set(range(len(words))).difference(joined) if " " not in words[k]]
            if joined:
                flat = ranks.encode_to_numpy("".join([words[k] for k in joined])).astype(np.uint32)
                ids.append(flat)
                sizes[joined] = np.diff(np.append(np.flatnonzero(blank[flat]), len(flat)))
                order += joined
            for k in rest:
                one = ranks.encode_ordinary(words[k])
                ids.append(np.array(one, np.uint32))
                sizes[k] = len(one)
            order += rest
        left = sorted(set(range(len(words))).difference(order))
        for k, one in zip(left, self.tokenizer.encode_batch_fast([words[k] for k in left], add_special_tokens=False), strict=True):
            ids.append(np.array(one.ids, np.uint32))
            sizes[k] = len(one.ids)
        order += left
        fresh = len(self.ends) - 1 + np.arange(len(order))
        self.flat = np.concatenate([self.flat, *ids])
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes[order])))
        hashes = np.concatenate((self.hashes, hashes[order]))
        place = np.argsort(hashes, kind="stable")
        self.hashes, self.slots = hashes[place], np.concatenate((self.slots, fresh))[place]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for slot, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[slot] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]
