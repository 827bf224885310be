"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import xxhash


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def in_order(rows):
    """Rows (id, text) by id, nulls last, then text."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))


def word_windows(rows, window):
    seen, out = set(), []
    for doc_id, text in in_order(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def byte_strings(rows, length):
    seen, out = set(), []
    for doc_id, text in in_order(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            key = data[p : p + length]
            if key in seen:
                gone[p : p + length] = True
            seen.add(key)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, sha(np.frombuffer(data, np.uint8)[~gone].tobytes())))
    return out


def fingerprint(text, per=3, seed=42):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + per]) for i in range(len(words) - per + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable, by node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {n: find(n) for n in nodes}


def packing_faults(pieces, documents, encode, capacity=1024):
    """What is wrong with pieces (dicts) of documents {id: text}."""
    faults, by_doc, by_sequence = [], defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc_id, text in documents.items():
        ids, at = encode(text or "") + [2], 0
        for k, p in enumerate(sorted(by_doc[doc_id], key=lambda p: p["piece"])):
            own = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            if (p["piece"], p["start"], p["ids_crc32"]) != (k, at, zlib.crc32(own)) or (k and p["length"] != capacity):
                faults.append(("piece", doc_id, k))
            at += p["length"]
        if at != len(ids):
            faults.append(("length", doc_id))
    for name, held in by_sequence.items():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            if p["offset"] != at:
                faults.append(("gap", name))
            at += p["length"]
        if at > capacity:
            faults.append(("over", name))
    return faults
