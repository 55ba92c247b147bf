"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re

SECRET_KINDS = {
    "assign": r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
SECRET_LEAST = {"assign": 6, "access": 20, "hex": 24}


def base_secrets(text):
    spans = []
    for rank, (kind, pattern) in enumerate(SECRET_KINDS.items()):
        for match in re.finditer(pattern, text or ""):
            if len(match[2] if kind == "assign" else match[0]) >= SECRET_LEAST[kind]:
                spans.append((match.start(), rank, match.end(), kind))
    return sorted(spans)


def entropy(window):
    return -sum(window.count(c) / len(window) * math.log2(window.count(c) / len(window)) for c in set(window))


def entropy_spans(text, candidate, window, allowed, hex_bits, mixed_bits):
    spans = []
    for match in re.finditer(candidate, text or ""):
        found = match[0]
        if re.search(allowed, found):
            continue
        least = hex_bits if re.fullmatch("[0-9A-Fa-f]+", found) else mixed_bits
        for at in range(len(found) - window + 1):
            if entropy(found[at : at + window]) >= least - 1e-7:
                start, end = match.start() + at, match.start() + at + window
                if spans and spans[-1][1] >= start and spans[-1][1] > match.start():
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((start, end))
    return spans


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, length):
    """(n_bytes, n_removed, n_spans, sha256 of what is kept) per row of (doc_id, text)."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1) if doc_id is not None else ():
            window = data[i : i + length]
            first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1) if doc_id is not None else ():
            if first[data[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def least_of_groups(ids, linked):
    """Smallest id of each id's group under the pairs ``linked``."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def similar(rows, words, percent):
    sets = {doc_id: shingles(text, words) for doc_id, text in rows}
    ids = sorted(sets)
    linked = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = least_of_groups(ids, linked)
    return {doc_id: (len(sets[doc_id]), root[doc_id]) for doc_id in ids}
