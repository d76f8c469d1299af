"""Plain versions of the operators, one text after the other, to compare with on small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import regex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, chars = len(words), sum(map(len, words))
    symbols, copies = len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 10 or 100 * len(repeated) > 20 * n
    loud = sum(w.upper() == w and w.lower() != w and len(w) > 3 for w in words)
    bad = 10 * symbols > n or 10 * copies > 3 * len(lines) or chars > 15 * n or 3 * loud > n
    bad = bad or 5 * len(re.findall(r"[!?]{2,}", text)) > n
    return n, chars, symbols, copies, len(repeated), failed, not (failed or bad)


def line_dedup(docs, similarity=0.8):
    """Per document (id, text): the text without lines that are near an earlier one, and how many went."""
    known, grams, groups, out, first = {}, [], Groups(), {}, {}
    index = defaultdict(list)
    numbered = []
    for doc_id, text in sorted(docs):
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            plain = line.strip(" \t\r\x0b\x0c").lower()
            if len(plain) >= 20:
                numbered.append((doc_id, pos, plain))
                if plain not in known:
                    known[plain] = len(known)
                    grams.append({plain[i : i + 5] for i in range(len(plain) - 4)})
    for i, own in enumerate(grams):
        shared = Counter(j for gram in own for j in index[gram])
        for j, n in shared.items():
            if n >= similarity * (len(own) + len(grams[j]) - n):
                groups.join(i, j)
        for gram in own:
            index[gram].append(i)
    gone = defaultdict(set)
    for doc_id, pos, plain in numbered:
        if first.setdefault(groups.find(known[plain]), (doc_id, pos)) != (doc_id, pos):
            gone[doc_id].add(pos)
    for doc_id, text in docs:
        kept = None if text is None else [x for i, x in enumerate(text.split("\n")) if i not in gone[doc_id]]
        out[doc_id] = (None if kept is None else "\n".join(kept), len(gone[doc_id]))
    return out


def shingle_set(text, size=3):
    words = WORD.findall(lower(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_groups(docs, size=3, percent=90):
    """Per document (id, text): number of shingles, smallest id linked with it."""
    sets = {doc_id: shingle_set(text, size) for doc_id, text in docs}
    groups, ids = Groups(), [i for i in sets if sets[i]]
    for place, i in enumerate(ids):
        for j in ids[:place]:
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                groups.join(i, j)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def leaks(docs, items):
    """Per document (id, text): n_words, n_hit, items found, sorted as strings."""
    windows = defaultdict(set)
    for item, text in items:
        words = PLAIN_WORD.findall(lower(text or ""))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(str(item))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for doc_id, text in docs:
        words, hit, found = PLAIN_WORD.findall(lower(text or "")), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= own
        out[doc_id] = (len(words), len(hit), sorted(found))
    return out


def mix(docs, weights=(3, 1, 2), share=1.5, most=2):
    """Per document (id, text, source): words taken; and per source its target."""
    sizes = {doc_id: len(WORD.findall(text or "")) for doc_id, text, _ in docs}
    total = Counter()
    for doc_id, _, source in docs:
        total[source] += sizes[doc_id]
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = set(), share * sum(total.values())
    while True:
        rest = [s for s in order if s not in full]
        level = (left - sum(most * total[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        over = {s for s in rest if level * weight[s] > most * total[s]}
        if not over:
            break
        full |= over
    target = {s: most * total[s] if s in full else level * weight[s] for s in order}
    taken = {}
    for source in order:
        copies = int(target[source] // total[source]) if total[source] else 0
        budget, cut = target[source] - copies * total[source], False
        own = sorted(
            (hashlib.md5(str(doc_id).encode()).hexdigest()[:12], doc_id) for doc_id, _, s in docs if s == source
        )
        for _, doc_id in own:
            size = sizes[doc_id]
            more = not cut and (size <= budget or budget >= size / 2)
            cut = cut or size > budget
            budget -= size
            taken[doc_id] = size * (copies + (1 if more else 0))
    return taken, target


def private_spans(text):
    """(kind, start, end) of valid values, by kind as listed, then start."""

    def valid(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(part) <= 255 for part in value.split("."))
        if kind == "card":
            doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


def unigram_scores(docs):
    """Per document (id, text, train): n_tokens, n_known, base score; and the number of training tokens."""
    tokens = {doc_id: [*WORD.findall(lower(text or "")), None] for doc_id, text, _ in docs}
    counts = Counter(t for doc_id, _, train in docs if train for t in tokens[doc_id])
    total, types = sum(counts.values()), len(counts)
    score = lambda t: math.log10((counts[t] + 1) / (total + types + 1))
    return {i: (len(x), sum(t in counts for t in x), sum(map(score, x))) for i, x in tokens.items()}, total


def pair_scores(docs, shares, half):
    """The log10 probability of each document (id, text, train): the mean over `shares` of the pairs' part in the mixture."""
    tokens = {i: [*WORD.findall(lower(text or "")), None] for i, text, _ in docs}
    learnt = [tokens[i] for i, _, train in docs if train]
    words = Counter(t for x in learnt for t in x)
    pairs = Counter(p for x in learnt for p in zip([None, *x], x))
    whole = sum(words.values()) + len(words) + 1
    out = {}
    for i, x in tokens.items():
        answers = []
        for share in shares:
            total = 0.0
            for before, token in zip([None, *x], x):
                n, c = pairs[before, token], words[before]
                own = (words[token] + 1) / whole
                seen = min(2 ** int(math.log2(n)) / c, 1) if n else 0
                total += math.log10(own + share * c / (c + half) * (seen - own))
            answers.append(total)
        best = max(answers)
        out[i] = best + math.log10(sum(10 ** (a - best) for a in answers) / len(answers))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs, items, top=50):
    """(item, rank, document, score) of documents and items (id, text); null ids last."""
    counts = [(i, Counter(TERM.findall(lower(text or "")))) for i, text in docs]
    counts = [(i, c) for i, c in counts if c]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in held.items()}
    out = []
    for item, text in set(items):
        terms = set(TERM.findall(lower(text or "")))
        found = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n // words
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms & c.keys())
            if score:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(found[:top], 1)]
    return out


def similar_groups(docs, shingle, percent):
    """Per row of (id, text): id, set size, smallest id reachable, whether that is its own; null ids come last."""
    sets = []
    for _, text in docs:
        words = WORD.findall(lower(text or ""))
        k = min(len(words), shingle)
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    groups = Groups()
    for i, x in enumerate(sets):
        groups.find(i)
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                groups.join(i, j)
    least = {}
    for i, (name, _) in enumerate(docs):
        root = groups.find(i)
        least[root] = min((x for x in (least.get(root), name) if x is not None), default=None)
    return [(name, len(sets[i]), least[groups.find(i)], name == least[groups.find(i)]) for i, (name, _) in enumerate(docs)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves, arity):
    """Root and, for each leaf, its path: per level the slot and the siblings."""
    paths, nodes, owner = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for leaf, own in enumerate(owner):
            run, slot = runs[own // arity], own % arity
            paths[leaf].append((slot, run[:slot] + run[slot + 1 :]))
        nodes, owner = [sha("".join(run)) for run in runs], [own // arity for own in owner]
    return nodes[0], paths


def manifest(rows, arity):
    """(digest, subroot, path) of rows (group, order, digest), and the root."""
    groups = defaultdict(list)
    for group, order, leaf in rows:
        groups[group].append((order is not None, order or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {g: tree([leaf for *_, leaf in sorted(groups[g])], arity) for g in names}
    root, tops = tree([made[g][0] for g in names], arity)
    out = []
    for g, top in zip(names, tops, strict=True):
        out += [(leaf[2], made[g][0], path + top) for leaf, path in zip(sorted(groups[g]), made[g][1], strict=True)]
    return out, root


def article_by_paths(html):
    """Blocks of a well-formed page without names and inline elements: from the first path that holds content to the last,
    with all of the parts, below the innermost element around them, that they lie in, and headings right before."""
    nodes, stack, numbers = [], [], iter(range(10**9))

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            stack.append((tag, next(numbers)))

        def handle_endtag(self, tag):
            assert stack.pop()[0] == tag

        def handle_data(self, data):
            if data.strip():
                nodes.append((list(stack), " ".join(data.split())))

    Reader().feed(html)
    score = []
    for stack_, _ in nodes:
        same = [t for other, t in nodes if [x[0] for x in other] == [x[0] for x in stack_]]
        score.append(sum(map(len, same)) / len(same) * (1 + sum(c in ".,;:!?" for t in same for c in t) / len(same)))
    at = lambda i: score[min(max(i, 0), len(score) - 1)]
    smooth = [sum(w * at(i + k - 2) for k, w in enumerate((0.06, 0.24, 0.4, 0.24, 0.06))) for i in range(len(score))]
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    wanted = [i for i, x in enumerate(score) if x >= spread]
    depth = 0
    while all(nodes[i][0][depth : depth + 1] == nodes[wanted[0]][0][depth : depth + 1] != [] for i in wanted):
        depth += 1
    part = lambda i: nodes[i][0][depth : depth + 1]
    first, last = wanted[0], wanted[-1]
    while first and part(first) and part(first - 1) == part(first):
        first -= 1
    while first and nodes[first - 1][0][-1][0] in ("h1", "h2", "h3"):
        first -= 1
    while last + 1 < len(nodes) and part(last) and part(last + 1) == part(last):
        last += 1
    return "\n\n".join(text for _, text in nodes[first : last + 1])


def term_spans(texts, least=0.48, bits=7.0):
    """For each text (start, end, lower bound) of the terms that give away a value of it."""
    different = {*texts}
    values, terms, masked = {}, {}, {}
    for text in different:
        values[text] = {(kind, (text or "")[a:b].lower()) for kind, a, b in private_spans(text)}
        masked[text] = text or ""
        for pattern in PATTERNS.values():
            masked[text] = re.sub(pattern, lambda m: "0" * len(m.group()), masked[text])
        terms[text] = {t.lower() for x in (text or "", masked[text]) for t in regex.findall(r"\p{L}{3,}", x)}
    own = {text: {t.lower() for t in regex.findall(r"\p{L}{3,}", masked[text])} for text in different}
    holding, having = defaultdict(set), defaultdict(set)
    for text in different:
        for value in values[text]:
            holding[value].add(text)
        for term in terms[text]:
            having[term].add(text)
    bounds = {}
    for value, holders in holding.items():
        for text in holders:
            for term in own[text]:
                n = len(having[term])
                both = sum(term in own[x] for x in holders)
                p = both / n
                low = (p + 1 / (2 * n) - math.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n)
                if low >= least and both * math.log2(len(different) / len(holders)) >= bits:
                    bounds[text, term] = max(low, bounds.get((text, term), 0))
    return [
        [
            (m.start(), m.end(), bounds[text, m.group().lower()])
            for m in regex.finditer(r"\p{L}{3,}", masked[text])
            if (text, m.group().lower()) in bounds
        ]
        for text in texts
    ]
