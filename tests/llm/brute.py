"""The same results by plain Python over all rows, for tables that fit in it."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers


def components(ids, links):
    lowest = {i: i for i in ids}

    def find(i):
        while lowest[i] != i:
            i = lowest[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        lowest[b] = a
    return {i: find(i) for i in ids}


def shingles(text, width):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return set()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def near_duplicates(docs, width):
    sets = {i: shingles(t, width) for i, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    where = components(ids, links)
    return sorted((i, len(sets[i]), where[i], where[i] == i) for i in ids)


def line_dedup(docs, min_docs=3, min_chars=20):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out)


def byte_bpe(docs, path):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in docs:
        ids = encoding.encode_ordinary(t or "")
        decoded = encoding.decode_bytes(ids)
        assert decoded == (t or "").encode()
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    return sorted(out)


def word_ids(texts, path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def token_files(docs, path):
    docs, start, out = sorted(docs), 0, []
    for (i, _), ids in zip(docs, word_ids([t for _, t in docs], path)):
        ids = [*ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def pieces(docs, path, size=2048):
    out = []
    for (i, _), ids in zip(docs, word_ids([t for _, t in docs], path)):
        ids = [*ids, 0]
        for k, at in enumerate(range(0, len(ids), size)):
            own = ids[at : at + size]
            out.append((i, k, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if fits:
                out.append((kind, m.start(), m.end()))
    return out


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def near_vectors(rows, threshold=0.93):
    ok = {}
    for i, v, label in rows:
        if v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            ok[i] = ((label, len(x)), x / np.linalg.norm(x))
    links = defaultdict(set)
    for label in {label for label, _ in ok.values()}:
        ids = [i for i in ok if ok[i][0] == label]
        x = np.stack([ok[i][1] for i in ids])
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a != b:
                links[ids[a]].add(ids[b])
    where = components([i for i, _, _ in rows], [(a, b) for a in links for b in links[a]])
    return sorted((i, len(links[i]), where[i], where[i] == i) for i, _, _ in rows)


def repeats(docs, width=50):
    """Every byte that a string of ``width`` bytes covers which also starts in a document with a smaller id."""
    data = [(i, (t or "").encode()) for i, t in docs]
    lowest = {}
    for i, x in data:
        for k in range(len(x) - width + 1):
            s = x[k : k + width]
            if i is not None and (s not in lowest or lowest[s] > i):
                lowest[s] = i
    out = []
    for i, x in data:
        gone = bytearray(len(x))
        for k in range(len(x) - width + 1):
            if i is not None and lowest[x[k : k + width]] < i:
                gone[k : k + width] = b"\x01" * width
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def private_marks(docs, base, generalise=0.5, remove=0.65, gain=3, z=1.645):
    """{place in docs: {term: level}}; ``base`` gives the base spans of a text as (kind, start, end)."""
    def terms(t):
        return {w.lower() for w in re.findall(r"\w+(?:['’-]\w+)*", t or "")}

    def keys(t):
        out = set()
        for kind, a, b in base(t or ""):
            value = t[a:b].lower()
            digits = "".join(c for c in value if c in "0123456789")[:6]
            pool = {"email": value[value.rfind("@") :], "ip": value[: value.rfind(".") + 1]}.get(kind, digits)
            out |= {(kind, value), (kind, "pool", pool)}
        return out

    words, held = [terms(t) for _, t in docs], [keys(t) for _, t in docs]
    sizes = [int(np.floor(np.log2(len((t or "").encode()) + 1))) for _, t in docs]
    with_term = defaultdict(set)
    for k, own in enumerate(words):
        for w in own:
            with_term[w].add(k)
    marks = defaultdict(dict)
    for key in {key for own in held for key in own}:
        rows = {k for k, own in enumerate(held) if key in own}
        low, high = min(sizes[k] for k in rows), max(sizes[k] for k in rows)
        share = len(rows) / sum(low - 1 <= s <= high + 1 for s in sizes)
        for w in {w for k in rows for w in words[k]}:
            both = rows & with_term[w]
            p = len(both) / len(with_term[w])
            n = len({frozenset(words[k]) for k in both}) / p
            bound = (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)
            if bound >= generalise and np.log2(bound / share) >= gain:
                for k in both:
                    if bound >= remove or w not in marks[k]:
                        marks[k][w] = "secret" if bound >= remove else "term"
    return marks
