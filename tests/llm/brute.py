"""Plain, slow versions of the operators, to hold results against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, keep_id, group_size, kept, text_sha256) for rows (doc_id, text) of distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = ids.index(keep)
        out += [(i, keep, len(ids), k == stays, sha(text)) for k, i in enumerate(ids)]
    return out


def joined(spans: list[tuple[str, int, int]], kinds: list[str]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]))))


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))
    assign = re.compile(r"(" + words + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    count = lambda s: len(re.sub("[^0-9]", "", s))
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= count(m[0]) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 10 <= count(m[0]) <= 15]


def token_rows(rows: list[tuple], tokenizer, end_id: int = 2) -> list[tuple]:
    """(doc_id, start, n_tokens, ids_crc32), whole texts encoded by the library."""
    import numpy as np
    out, start = [], 0
    for i, t in sorted(rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def shingles(text: str | None, n: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k: k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset(
        [tuple(words)] if words else [])


def near(rows: list[tuple], n: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) for rows (doc_id, text)."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for k, (_, s) in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j > k:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j][1]) - c):
                a, b = root(k), root(j)
                parent[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(s), least.get(root(k))) for k, (i, s) in enumerate(sets)]


def removed(rows: list[tuple], length: int = 100) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for rows (doc_id, text) in order."""
    seen, out = set(), []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            s = data[k: k + length]
            if s in seen:
                gone[k: k + length] = b"\1" * length
            seen.add(s)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return out


def chats(rows: list[tuple]) -> dict:
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256) for rows (conv_id, turn, role, text)."""
    first = lambda x: (x is not None, x or "" if not isinstance(x, int) else x)
    out = defaultdict(list)
    for c, n, r, t in sorted(rows, key=lambda x: (first(x[1]) if x[1] is not None else (False, 0), x[2] or "", x[3] or "")):
        out[c].append((r or "", t or ""))
    return {c: (len(v), sha("".join(f"{r}\n{t}\n" for r, t in v)),
                sum(len(t) for r, t in v if r == "assistant"),
                sha("".join(t for r, t in v if r == "assistant"))) for c, v in out.items()}


def best_pieces(word: str, scores: dict[str, float], unknown: float) -> list[str]:
    """Pieces of greatest total score (of equals, the longer last piece); an unknown character is a piece."""
    longest = max(map(len, scores))
    best = [(0.0, [])] + [None] * len(word)
    for j in range(1, len(word) + 1):
        for size in range(min(j, longest), 0, -1):
            piece = word[j - size: j]
            gain = scores.get(piece, unknown if size == 1 else None)
            if gain is None or best[j - size] is None:
                continue
            total = best[j - size][0] + gain
            if best[j] is None or total > best[j][0]:
                best[j] = (total, best[j - size][1] + [piece])
    return best[-1][1]
