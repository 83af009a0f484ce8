"""Plain versions of the operators, for small inputs, written without the operators' code."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

_tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def token_ids(text, end):
    return _tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def pieces(doc_id, text, places=2048):
    ids = token_ids(text, 0)
    return [(doc_id, k, at, len(ids[at : at + places]), crc(ids[at : at + places])) for k, at in enumerate(range(0, len(ids), places))]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text, shingle=4):
    found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    if not found:
        return 0
    shingles = [" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(nodes, links):
    above = {n: n for n in nodes}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def simhash_components(documents, limit=4):
    """{doc_id: (fingerprint, component)} of (doc_id, text) with distinct ids."""
    prints = {d: fingerprint(t) for d, t in documents}
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= limit]
    found = components(ids, links)
    return {d: (prints[d], found[d]) for d in ids}


def cut(documents, width=50):
    """[(doc_id, bytes, mask of removed bytes)] of (doc_id, text)."""
    first = {}
    order = sorted(documents, key=lambda d: (d[0] is None, d[0] or 0))
    for d, text in order:
        b = (text or "").encode()
        for i in range(len(b) - width + 1):
            first.setdefault(b[i : i + width], d)
    out = []
    for d, text in documents:
        b = (text or "").encode()
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            least = first[b[i : i + width]]
            if least is not None and (d is None or least < d):
                mask[i : i + width] = True
        out.append((d, b, mask))
    return out


def cut_row(d, b, mask):
    spans = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
    kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
    return d, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()


def mix(documents, weights=(5, 2, 1), share=1.5, most=2.0, seed=17):
    """{doc_id: (size, source_size, target, taken)} of (doc_id, text, source) with distinct ids."""
    size = {d: len(words(t)) for d, t, _ in documents}
    sources = sorted({s for *_, s in documents}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size[d] for d, _, o in documents if o == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    budget, target, open_ = share * sum(total.values()), {}, list(sources)
    while True:  # share by weight, fix those above their limit, share the rest again
        level = budget / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if level * weight[s] > most * total[s]]
        if not above:
            break
        for s in above:
            target[s] = most * total[s]
            budget -= target[s]
            open_.remove(s)
    target |= {s: level * weight[s] for s in open_}
    out = {}
    for s in sources:
        own = [(d, t) for d, t, o in documents if o == s]

        def key(row):
            d, t = row
            letters = sum(map(str.isalpha, t or ""))
            quality = max(0.25, letters / max(len(t or ""), 1))
            u = (int(hashlib.md5(f"{seed}:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return (-math.log(u) / quality, d)

        epochs = int(target[s] // max(total[s], 1))
        rest = math.floor(target[s] + 0.5) - epochs * total[s]
        for d, _ in sorted(own, key=key):
            part = max(0, min(size[d], rest))
            rest -= part
            out[d] = (size[d], total[s], target[s], epochs * size[d] + part)
    return out


def sequences_are_gapless(rows, places):
    """rows: (sequence, offset, length)."""
    by_sequence = defaultdict(list)
    for sequence, offset, length in rows:
        by_sequence[sequence].append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            if offset != at:
                return False
            at += length
        if at > places:
            return False
    return True
