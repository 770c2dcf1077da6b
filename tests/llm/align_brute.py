"""A plain aligner: whole token lists, a set of common ends, no pieces."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

from lorewell.llm.alignment import Encoders

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def brute(docs):
    enc = Encoders(A, B)
    hf = Tokenizer.from_file(A)
    hf.encode_special_tokens = True
    per = []
    for d, t in docs:
        a, b = (hf.encode(" " + t, add_special_tokens=False).ids, enc.b.encode(t)) if t else ([], [])
        ab, bb = [enc.a_bytes[i] for i in a], [enc.b_bytes[i] for i in b]
        target = (" " + (t or "")).encode()
        if not t or b"".join(ab) != target or b"".join(bb) != target:
            a, b, ab, bb = [], [], [], []
        ae = [sum(len(x) for x in ab[: i + 1]) for i in range(len(ab))]
        be = [sum(len(x) for x in bb[: i + 1]) for i in range(len(bb))]
        common = sorted(set(ae) & set(be))
        links = [(a[ae.index(e)], b[be.index(e)]) for e in common]
        groups, lo_a, lo_b = [], 0, 0
        for e in common:
            hi_a, hi_b = ae.index(e) + 1, be.index(e) + 1
            groups.append(",".join(map(str, a[lo_a:hi_a])) + "|" + ",".join(map(str, b[lo_b:hi_b])))
            lo_a, lo_b = hi_a, hi_b
        per.append((d, len(a), len(b), links, ";".join(groups)))
    counts = {}
    for *_, links, _ in per:
        for l in links:
            counts[l] = counts.get(l, 0) + 1
    top = {}
    for (x, y), c in counts.items():
        top[y] = max(top.get(y, 0), c)
    out = []
    for d, na, nb, links, g in per:
        out.append((d, na, nb, len(links), len(links), sum(counts[l] == top[l[1]] for l in links),
                    sum(counts[l] for l in links), hashlib.sha256(g.encode()).hexdigest() if na else ""))
    return out
