"""Plain Python versions of what the operators compute, and awkward documents."""

from __future__ import annotations

import collections
import hashlib
import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, anchor string, shard string, n int, f string"


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows, copies, near copies, one hot text, clashing extra columns."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghéü", k=rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    texts = [None, "", " ", "\n\t ", "One", "two words", "\U0001f600 snow☃man  x y　z", "a" * 250, prose(6000), "ab " * 2000]
    base, passage = prose(300), prose(40)
    for k in range(12):
        own = base.split(" ")
        own[rng.randrange(len(own))] = f"edit{k}"
        texts.append(" ".join(own))
    texts += [passage + "\n" + prose(rng.randint(1, 120)) for _ in range(20)]
    texts += [base] * 5 + [prose(rng.randint(1, 60)) for _ in range(40)] + [passage.upper(), passage]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(7 * i - 20, texts[k], "en", None, None, 3, "x", None, 1, "y") for i, k in enumerate(order)]
    return rows + [rows[3], rows[3]]


def by_id(rows: list[tuple]) -> dict[int, str | None]:
    return {r[0]: r[1] for r in rows}


def groups(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, text in docs.items():
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in docs}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in docs:
        for j in docs:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in docs}


def without_repeats(docs: dict[int, str | None], depth: int = 100) -> dict[int, tuple[int, int, int, str]]:
    seen, out = set(), {}
    for i in sorted(docs):
        raw = (docs[i] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - depth + 1):
            if raw[s : s + depth] in seen:
                gone[s : s + depth] = b"\1" * depth
            seen.add(raw[s : s + depth])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def contamination(docs: dict[int, str | None], items: list[tuple], width: int = 10) -> dict[int, tuple]:
    windows = collections.defaultdict(set)
    for name, text in items:
        w = alnum(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[k : k + width])].add("null" if name is None else str(name))
    out = {}
    for i, text in docs.items():
        w, hit, found = alnum(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if names := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= names
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)
