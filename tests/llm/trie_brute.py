"""The conversation trie of the contract, computed plainly from all prefixes."""

from __future__ import annotations

import hashlib
import zlib


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """rows: (conv_id, turn, role, text) -> conv_id: [(role, text), ...] after the rebuild."""
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is None:
            continue
        own.setdefault(c, []).append((turn is not None, turn if turn is not None else 0, role or "", text or ""))
    ordered = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in ordered.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = ordered.get(base, [])[:h] + turns[h:]
    return out


def trie(rows: list[tuple]) -> list[tuple]:
    convs = rebuilt(rows)
    nodes: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children: dict[tuple, int] = {}
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    out = []
    for path, members in nodes.items():
        d = len(path)
        sub = [p for p in nodes if p[:d] == path]
        leaves = sum(1 for p in sub if children.get(p, 0) == 0)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in sub if p)
        ends = sorted(c for c in members if len(convs[c]) == d)
        out.append((
            min(members), d, min(nodes[path[:-1]]) if d else None, len(members), children.get(path, 0), leaves, saved,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[0], r[1]))
