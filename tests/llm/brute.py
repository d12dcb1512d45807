"""The contracts of the operators, word by word and pair by pair, for small tables. Rows are dicts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small_letters(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def token_counts(docs, tokenizer="piece_bpe_32k.model"):
    import public_tokenizers
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokenizer))
    for d in docs:
        text = d["text"] or ""
        n = len(p.encode(text))
        yield d["doc_id"], len(text.encode()), n, n > 4096


def token_files(docs, tokenizer="word_bpe_49k.json"):
    import public_tokenizers
    from tokenizers import Tokenizer

    t, start = Tokenizer.from_file(public_tokenizers.path(tokenizer)), 0
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = [*t.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        yield d["doc_id"], start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        start += len(ids)


def windows_removed(docs, n=50):
    words = [(d["doc_id"], WORD.findall(d["text"] or "")) for d in docs]
    first: dict = {}
    for i, w in sorted((x for x in words if x[0] is not None), key=lambda x: x[0]):
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    for i, w in words:
        starts = [] if i is None else [k for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < i]
        gone = {k + j for k in starts for j in range(n)}
        yield i, len(w), len(gone), sha256(" ".join(x for j, x in enumerate(w) if j not in gone))


def simhash(docs, bits=4, shingle=4):
    prints = []
    for d in docs:
        w = WORD.findall(small_letters(d["text"] or ""))
        grams = [w[i : i + shingle] for i in range(len(w) - shingle + 1)] or ([w] if w else [])
        hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(docs)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    least: dict = {}
    for i, d in enumerate(docs):
        if d["doc_id"] is not None:
            least[top(i)] = min(least.get(top(i), d["doc_id"]), d["doc_id"])
    for i, d in enumerate(docs):
        yield d["doc_id"], f"{prints[i]:016x}", least.get(top(i))


def benchmark_hits(docs, items, n=10):
    read = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small_letters(t or ""))
    windows: dict = {}
    for item in items:
        w = read(item["text"])
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item["item_id"])
    sizes = {len(x) for x in windows}
    for d in docs:
        w, hit, found = read(d["text"]), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (held := windows.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= held
        ids = sorted(str(i) for i in found if i is not None)
        yield d["doc_id"], len(w), len(hit), len(ids), sha256(",".join(ids)), bool(hit)


def rule_counts(docs):
    for d in docs:
        text = d["text"] or ""
        w = WORD.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        places: dict = {}
        for k in range(len(w) - 7):
            places.setdefault(tuple(w[k : k + 8]), []).append(k)
        repeat = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(8)}
        failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
        yield d["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat), failed


ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base_spans(docs):
    for d in docs:
        text = d["text"] or ""
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
        kinds = [k for _, k, _ in spans]
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        yield d["doc_id"], kinds.count(0), kinds.count(1), kinds.count(2), sha256(shown)


def ownership(docs):
    """Per document its base spans that look live and that are copied, and the greatest numbers of owners and repositories."""
    found, owners, repositories = [], {}, {}
    for d in docs:
        text = d["text"] or ""
        values = [m[1] for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
        values += [m[0] for x, least in ((ACCESS, 16), (HEX, 32)) for m in x.finditer(text) if len(m[0]) >= least]
        found.append((d["doc_id"], values))
        for v in values:
            owners.setdefault(v, set()).add(d["source"])
            repositories.setdefault(v, set()).add(d["doc_id"])
    for i, values in found:
        live = sum(len(owners[v]) < 3 and len(repositories[v]) < 10 for v in values)
        most = (max((len(of[v]) for v in values), default=0) for of in (owners, repositories))
        yield i, live, len(values) - live, *most


def manifest(docs):
    """Leaf by leaf, with every level as a list; of rows that are equal in all the first comes first."""
    join = lambda *parts: sha256("".join(parts))
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d: join(*(field(d[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def tree(nodes):
        """The top, and of each node its siblings on the way."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for way, i in zip(ways, at):
                run = i - i % 8
                way.append((nodes[run:i], nodes[i + 1 : run + 8]))
            at = [i // 8 for i in at]
            nodes = [join(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        return nodes[0] if nodes else None, ways

    groups: dict = {}
    for d in docs:
        groups.setdefault(d["lang"], []).append((d["doc_id"] is not None, d["doc_id"] or 0, leaf(d), d))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]])
    root, uppers = tree([trees[g][0] for g in langs])
    out = []
    for g, upper in zip(langs, uppers):
        for (_, _, own, d), way in zip(groups[g], trees[g][1]):
            way = way + upper
            node = own
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0:
                node = leaf(d | {"text": d["text"] and d["text"].translate(small)})
            for left, right in way:
                node = join(*left, node, *right)
            proof = join(*(x for left, right in way for x in left + right))
            out.append((d["doc_id"], own, trees[g][0], root, proof, node, node == root))
    return out


def bytes_removed(docs, size=50):
    """Bytes that a window of a smaller document covers; rows of null doc_id neither give nor lose any."""
    least: dict = {}
    for d in docs:
        text = (d["text"] or "").encode()
        for i in range(len(text) - size + 1):
            if d["doc_id"] is not None:
                least[text[i : i + size]] = min(d["doc_id"], least.get(text[i : i + size], d["doc_id"]))
    out = []
    for d in docs:
        text = (d["text"] or "").encode()
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if d["doc_id"] is not None and least[text[i : i + size]] < d["doc_id"]:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(text, gone) if not g)
        out.append((d["doc_id"], len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def near(a, b):
    """Whether one inserted, deleted or replaced letter makes the one the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(docs):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts: Counter = Counter()
    for d in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", d["text"] or ""):
            w = w.translate(small)
            h = zlib.crc32(f"{'' if d['doc_id'] is None else d['doc_id']}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    found = {w: [x for x in n if abs(len(x) - len(w)) <= 1 and near(w, x)] for w in n}
    best = {w: min(found[w], key=lambda x: (-n[x], x)) if found[w] else None for w in n}
    form = {w: best[w] if best[w] and n[best[w]] >= 5 * n[w] else None for w in n}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return out
