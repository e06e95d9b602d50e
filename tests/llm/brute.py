"""Plain-Python versions of the operators' contracts, for small tables.

Rows are tuples (doc_id, text, lang, source)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def span_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)).encode()).hexdigest()


def repeated_words(w, k=8):
    at = defaultdict(list)
    for i in range(len(w) - k + 1):
        at[tuple(w[i:i + k])].append(i)
    return len({i + j for v in at.values() if len(v) > 1 for i in v for j in range(k)})


def quality(rows):
    out = []
    for doc, text, *_ in rows:
        w, lines = words(text), [x for x in (text or "").split("\n") if WORD.search(x)]
        rep = repeated_words(w)
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep,
                    len(w) < 20 or 100 * rep > 30 * len(w)))
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(digits[::-1]):
        d = int(d) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def personal(rows):
    out = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for doc, text, *_ in rows:
        t = text or ""
        found = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        found += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
        found += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
        found += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
        n = Counter(x[2] for x in found)
        out.append((doc, n["email"], n["ip"], n["card"], n["phone"], span_digest(found)))
    return out


def secrets(rows):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = []
    for doc, text, *_ in rows:
        t = text or ""
        found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        n = Counter(x[2] for x in found)
        out.append((doc, n["assign"], n["access"], n["hex"], span_digest(found)))
    return out


def targets(size_of_source, weights=(5, 2, 1), share=1.5):
    sources = sorted(size_of_source, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    left, out, active = share * sum(size_of_source.values()), {}, set(sources)
    while active:
        level = left / sum(w[s] for s in active)
        over = {s for s in active if level * w[s] > 2 * size_of_source[s]}
        if not over:
            break
        for s in over:
            out[s] = 2.0 * size_of_source[s]
            left -= out[s]
        active -= over
    return out | {s: level * w[s] for s in active}


def ngrams(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def similar(rows, n=4, percent=85):
    """(doc_id, set size, smallest id reachable), by comparing all pairs of classes."""
    sets = [ngrams(t, n) for _, t, *_ in rows]
    least = {}
    for (doc, *_), s in zip(rows, sets):
        if s:
            ids = [x for x in (least.get(s), doc) if x is not None]
            least[s] = min(ids, default=None)
    kinds = list(least)
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for j in range(i):
            if min(len(a), len(kinds[j])) * 100 >= percent * max(len(a), len(kinds[j])):
                both = len(a & kinds[j])
                if 100 * both >= percent * (len(a) + len(kinds[j]) - both):
                    parent[find(i)] = find(j)
    smallest = {}
    for i, a in enumerate(kinds):
        ids = [x for x in (smallest.get(find(i)), least[a]) if x is not None]
        smallest[find(i)] = min(ids, default=None)
    of = {a: smallest[find(i)] for i, a in enumerate(kinds)}
    return [(doc, len(s), of[s] if s else doc) for (doc, *_), s in zip(rows, sets)]


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact(rows):
    """(doc_id, keep_id, group_size, kept, sha256), as a multiset."""
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[squeezed(text)].append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        h = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, h) for i, m in enumerate(members)]
    return out


def bpe(file="byte_bpe_50k.json"):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(file))


def check_packing(pieces, ids_of_rows, window=2048):
    """Pieces (doc_id, start, length, crc, doc_tokens, sequence, offset) hold every
    id of every row once, and sequences have no gap."""
    want, have, sequences = Counter(), Counter(), defaultdict(list)
    by_doc = defaultdict(list)
    for doc, ids in ids_of_rows:
        by_doc[doc, len(ids)].append(ids)
        want[doc] += len(ids)
    for doc, start, length, found, total, sequence, offset in pieces:
        assert length > 0 and start + length <= total
        assert any(crc(ids[start:start + length]) == found for ids in by_doc[doc, total])
        have[doc] += length
        sequences[sequence].append((offset, length))
    assert have == want
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s == window or (0 < s < window and s & (s - 1) == 0) for s in sizes)
    return sizes


def aligned(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha256), comparing the sets of ends."""
    import base64

    import public_tokenizers as P
    import sentencepiece
    whole = bpe()
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        bytes_a = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}

    def bytes_b(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("\u2581", " ").encode()

    def ends(tokens):
        at, out = 0, []
        for t in tokens:
            at += len(t)
            out.append(at)
        return out

    grouped, n_docs = [], Counter()
    for _, text, *_ in rows:
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        token_a, token_b = [bytes_a[i] for i in a], [bytes_b(i) for i in b]
        if not text or b"".join(token_a) != (" " + text).encode() or b"".join(token_b) != (" " + text).encode():
            grouped.append(([], [], []))
            continue
        common = sorted(set(ends(token_a)) & set(ends(token_b)))
        groups = [([], []) for _ in common]
        for side, ids, places in ((0, a, ends(token_a)), (1, b, ends(token_b))):
            g = 0
            for i, end in zip(ids, places):
                while common[g] < end:
                    g += 1
                groups[g][side].append(i)
        grouped.append((a, b, groups))
        n_docs.update({(x, y) for ga, gb in groups for x in set(ga) for y in set(gb)})
    most = Counter()
    for (x, _), n in n_docs.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, *_), (a, b, groups) in zip(rows, grouped):
        links = Counter()
        for ga, gb in groups:
            for x, m in Counter(ga).items():
                for y, k in Counter(gb).items():
                    links[x, y] += m * k
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((doc, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if n_docs[p] == most[p[0]]),
                    sum(n * n_docs[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def line_dedup(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept_sha256); rows of one id are one document, no id comes last."""
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    order = lambda doc: (doc is None, doc or 0)
    first = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                first[k] = min(first.get(k, order(doc)), order(doc))
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if first.get(key(line), order(doc)) == order(doc)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def audit(rows, least=10, top=10):
    """(lang, source, part, item, value, rank), term by term."""
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs | {lang: 0 for lang, _ in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (of, s), c in counts.items() if of == lang}
        total = {s: sum(c[t] for t in kept) for s, c in groups.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s, c in groups.items()}
        everywhere = {t: sum(c[t] for c in groups.values()) for t in kept}
        q = {t: 1 + 10**9 * (n + 2) // (sum(everywhere.values()) + 2 * len(kept)) for t, n in everywhere.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            marks = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(marks)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return out


def disclosed(texts, generalise=0.5, remove=0.9):
    """Spans of each text, patterns' and method's, by counting every pair of term and entity."""
    import math

    from tabwatch.llm import pii_disclosure as P
    texts = [t or "" for t in texts]
    bases = [P.base_spans(t) for t in texts]
    term = re.compile(r"[^\W\d_]+")
    digits = lambda t: re.sub("[^0-9]", "", t)
    entities = [{(k, t[s:e].lower() if k < 2 else digits(t[s:e])) for s, k, e in b} for t, b in zip(texts, bases)]
    free = [[m for m in term.finditer(t) if all(m.end() <= s or e <= m.start() for s, _, e in b)] for t, b in zip(texts, bases)]
    df_term, df_entity, both, wordings = Counter(), Counter(), Counter(), defaultdict(set)
    for t, ents, found in zip(texts, entities, free):
        df_term.update({m[0].lower() for m in term.finditer(t)})
        df_entity.update(ents)
        for e in ents:
            wordings[e].add(t)
            for w in {m[0].lower() for m in found}:
                both[e, w] += 1
                wordings[e, w].add(t)
    n, kind = len(texts), {}
    for (e, w), c in both.items():
        if len(wordings[e]) >= 2 and df_entity[e] < n and len(wordings[e, w]) >= 2:
            share = math.log2(n * c / (df_term[w] * df_entity[e])) / math.log2(n / df_entity[e])
            if share >= generalise:
                kind[e, w] = 5 if share >= remove else 4
    out = []
    for t, b, ents, found in zip(texts, bases, entities, free):
        more = [(m.start(), max(kind[e, m[0].lower()] for e in ents if (e, m[0].lower()) in kind), m.end())
                for m in found if any((e, m[0].lower()) in kind for e in ents)]
        out.append(",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in sorted(b + more)))
    return out
