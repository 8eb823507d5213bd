"""Plain versions of operators, for small tables."""

import collections
import hashlib
import math
import re

import xxhash


def words_of(text):
    return (text or "").encode().split()


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, radius=2):
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def normal(text):
    return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "


def plain_cut(texts, window=35):
    starts = collections.Counter()
    for words in texts:
        starts.update(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
    out = []
    for words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if starts[tuple(words[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def plain_grams(text, buckets):
    """Hashed n-grams of two and of three bytes, a pair for each place that holds any."""
    data = [b if b >= 128 or chr(b).isalpha() else 32 for b in b" " + text.lower().encode() + b"  "]
    out = []
    for i in range(len(data) - 2):
        if data[i] == data[i + 1] == 32:
            continue
        pair = []
        for step, n in enumerate((2, 3)):
            code = int.from_bytes(bytes(data[i:i + n]), "big")
            pair.append((code * 2654435761 % (1 << 32) >> 17) + step * buckets)
        out.append(pair)
    return out


def plain_languages(learn, texts, code, buckets, evidence):
    """Place of the language and share of its codeword, bit by bit, from lists of texts to learn from."""
    counts = []
    for known in learn:
        counts.append(collections.Counter(g for t in known for pair in plain_grams(t, buckets) for g in pair))
    sizes = [[sum(c for g, c in count.items() if g // buckets == size) + 0.02 * buckets
              for size in (0, 1)] for count in counts]

    def share(language, gram):
        return (counts[language][gram] + 0.02) / sizes[language][gram // buckets]

    def sides(bit, gram):
        groups = [[share(i, gram) for i in range(len(learn)) if code[i][bit] == side] for side in (1, 0)]
        return [sum(g) / len(g) for g in groups]

    bits = range(len(code[0]))
    seen = set().union(*counts)
    weight = []
    for bit in bits:
        mass = 0.0
        # Buckets that no language has are alike, so one of each size stands for all.
        for size in (0, 1):
            mine = [g for g in seen if g // buckets == size]
            empty = next(g for g in range(size * buckets, (size + 1) * buckets) if g not in seen)
            for gram, times in [(g, 1) for g in mine] + [(empty, buckets - len(mine))]:
                one, zero = sides(bit, gram)
                mass += times * (one - zero) * math.log(one / zero)
        weight.append(mass)
    mean = sum(weight) / len(weight)
    out = []
    for text in texts:
        pairs = plain_grams(text, buckets)
        margins = []
        for bit in bits:
            odds = [math.log(one / zero) for pair in pairs for one, zero in (sides(bit, g) for g in pair)]
            margins.append(sum(odds) / max(len(odds), 1) * min(len(pairs), evidence))
        loss = [sum(weight[b] / mean * math.log1p(math.exp(-margins[b] * (2 * word[b] - 1))) for b in bits)
                for word in code]
        best = loss.index(min(loss))
        out.append((best, 1 / sum(math.exp(loss[best] - x) for x in loss)))
    return out
