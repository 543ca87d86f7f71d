"""Plain Python versions of the operators, for small tables."""

import base64
import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rules(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    hit = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed)


def shingles(text):
    words = WORD.findall(lower(text))
    if len(words) < 5:
        return {tuple(words)} - {()}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(rows):
    """{(id, text): smallest id} of rows (id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[find(i)].append(key)
    known = {k: [x for x in v if x is not None] for k, v in least.items()}
    return [
        (key, len(sets[i]), min(known[find(i)], default=None) if sets[i] else key)
        for i, (key, _) in enumerate(rows)
    ]


def kept_lines(texts, min_docs):
    keys = [[lower(x.strip(BLANKS)) for x in (t or "").split("\n")] for t in texts]
    often = Counter(k for doc in keys for k in set(doc) if k)
    out = []
    for text, doc in zip(texts, keys, strict=True):
        lines = (text or "").split("\n")
        kept = [x for x, k in zip(lines, doc, strict=True) if not k or often[k] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def mixed(rows, share=1.5, most=2.0, weights=(3, 1, 2)):
    """[(id, size, source_size, target, copies)] of rows (id, text, source)."""
    size = {i: len(WORD.findall(t or "")) for i, (_, t, _) in enumerate(rows)}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, r in enumerate(rows) if r[2] == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, free, left = {}, set(sources), share * sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * total[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = most * total[s]
            left -= target[s]
        free -= over
    out = []
    for s in sources:
        whole = math.floor(target[s] / total[s]) if total[s] else 0
        rest, taken = target[s] - whole * total[s], 0
        mine = defaultdict(list)
        for i, r in enumerate(rows):
            if r[2] == s:
                text = f"{'' if r[0] is None else r[0]} {r[1] or ''}"
                mine[hashlib.md5(text.encode()).hexdigest()].append(i)
        done = False
        for h in sorted(mine):
            n = sum(size[i] for i in mine[h])
            more = not done and (taken + n <= rest or 2 * (rest - taken) >= n)
            done = done or taken + n > rest
            taken += n
            out += [(rows[i][0], size[i], total[s], target[s], whole + (more and n > 0)) for i in mine[h]]
    return out


def sentences(text, max_words=16):
    """Sentences as (words, text with the blanks after it)."""
    found, head = [], None
    spans = [m.span() for m in WORD.finditer(text or "")]
    for k, (a, b) in enumerate(spans):
        new = k == 0 or text[spans[k - 1][1] - 1] in ".!?" or "\n" in text[spans[k - 1][1] : a]
        if new or len(head[0]) == max_words:
            head = ([], 0 if not found else a)
            found.append(head)
        head[0].append(lower(text[a:b]))
    starts = [a for _, a in found] + [len(text or "")]
    return [(tuple(w), text[a:b]) for (w, a), b in zip(found, starts[1:], strict=True)]


def without_spans(rows, sentence_count=2, min_words=12):
    """[text] of rows (id, text), ids without null, sorted."""
    cut = [sentences(t) for _, t in rows]
    first, out = {}, []
    for doc in cut:
        lost = set()
        for i in range(len(doc)):
            for j in range(i + sentence_count, len(doc) + 1):
                words = sum((w for w, _ in doc[i:j]), ())
                if len(words) >= min_words:
                    if first.setdefault(words, (id(doc), i)) != (id(doc), i):
                        lost |= set(range(i, j))
                    break
        out.append((len(doc), len(lost), "".join(t for k, (_, t) in enumerate(doc) if k not in lost)))
    # a text without sentences stays as it is
    return [(n, k, t if n else row[1]) for row, (n, k, t) in zip(rows, out, strict=True)]


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
