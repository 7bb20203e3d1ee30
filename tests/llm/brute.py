"""Plain Python versions of the operators' results, one row at a time."""

import functools
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def order(doc_id):
    return (doc_id is not None, doc_id or 0)


def exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[sha(lower(text))].append(doc_id)
    found = []
    for digest, ids in groups.items():
        last = max(ids, key=order)
        kept_one = False
        for doc_id in ids:
            keeps = doc_id == last and not kept_one
            kept_one |= keeps
            found.append((doc_id, last, len(ids), keeps, digest))
    return sorted(found, key=repr)


def shingles(text):
    own = WORD.findall(lower(text))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def similar(a, b):
    return bool(a and b) and 100 * len(a & b) >= 85 * len(a | b)


def components(n, linked):
    """The first member of each node's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def mixing(rows, weights=(5, 2, 1), most=3):
    sizes = Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        each = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in free) if free else 0.0
        above = {s for s in free if each * weight[s] > most * sizes[s]}
        if not above:
            return sizes, {s: float(most * sizes[s]) if s in full else each * weight[s] for s in order}
        full |= above


def line_dedup(rows, min_chars=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(blanks))].add(doc_id)
    found = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = lower(line.strip(blanks))
            often = len(key) >= min_chars and len(holders[key]) >= min_docs
            if not often or max(holders[key], key=order) == doc_id:
                kept.append(line)
        found.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def told(rows):
    """Turns (role, text) of each conversation in order; ties by a digest, as the trie has it."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), key, (role, text)))
    return {conv: [t for *_, t in sorted(turns, key=lambda x: x[:2])] for conv, turns in own.items()}


def rebuilt(turns):
    found = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 9
        lender = abs(conv) // 5 * 5 * (1 if conv > 0 else -1)
        found[conv] = turns.get(lender, [])[:h] + own[h:]
    return found


def trie(turns):
    """Nodes of the conversations' beginnings, by trying every pair."""
    members = defaultdict(set)
    for conv, own in turns.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].add(conv)
    found = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) > len(p) and q[: len(p)] == p for q in below)]
        ends = ",".join(str(c) for c in sorted(convs) if len(turns[c]) == len(path))
        found.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below), len(leaves),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), sha(ends),
        ))
    return sorted(found, key=repr)


SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    found = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        at = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if at == 1:
            text = ""
        if at == 2:
            text = re.sub("[.!?]", "", text)
        found += [(conv, turn, "user" if at == 4 else role, text)] * {0: 0, 3: 2}.get(at, 1)
    return found


FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}


def repairs(rows):
    """Least cost and audit of (initial, doomed, unended) rows: the best way on from a
    row and the last role written, tried edit by edit, two insertions at a place."""

    @functools.cache
    def way(i, last, inserted):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if inserted < 2:
            for role in FOLLOW[last].replace("s", ""):
                ways.append(before(3, "I", way(i, role, inserted + 1)))
        if i < len(rows):
            initial, doomed, unended = rows[i]
            ways.append(before(4, "D", way(i + 1, last, 0)))
            for role in "" if doomed else FOLLOW[last]:
                if role == initial:
                    ways.append(before(3 * unended, "K", way(i + 1, role, 0)))
                if role != "s":
                    ways.append(before(3 + 3 * unended, "R", way(i + 1, role, 0)))
        return min(ways, default=(10**9, ""))

    def before(cost, edit, rest):
        return rest[0] + cost, edit + rest[1]

    return way(0, "", 0)


def all_repairs(rows):
    """The same by writing out every sequence of edits."""
    gaps = [p for n in range(4) for p in itertools.product("ua", repeat=n)]
    found = []
    for puts in itertools.product(gaps, repeat=len(rows) + 1):
        ways = [(0, "I" * len(puts[0]), "".join(puts[0]))]
        ways[0] = (3 * len(puts[0]), *ways[0][1:])
        for (initial, doomed, unended), put in zip(rows, puts[1:]):
            more = [(4, "D", "")]
            if not doomed:
                more += [(3 * unended, "K", initial), *((3 + 3 * unended, "R", r) for r in "ua")]
            ways = [
                (c + d + 3 * len(put), a + e + "I" * len(put), r + s + "".join(put)) for c, a, r in ways for d, e, s in more
            ]
        found += [(c, a) for c, a, r in ways if re.fullmatch("(s?(ua)+)?", r)]
    return min(found)


def repaired_rows(audit, rows):
    rows, last, found = iter(rows), "", []
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            found.append((edit, role, text))
        elif edit in "IR":
            found.append((edit, "assistant" if last == "u" else "user", text))
        last = found[-1][1][:1] if found else ""
    return found


def repair(rows, known=()):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
        own[conv].append(((turn is not None, turn or 0), key, turn, role, text))
    found = []
    for conv in {*own, *known}:
        turns = sorted(own.get(conv, []), key=lambda r: r[:2])
        counts, kinds, seen, illegal = Counter(), [], set(), 0
        for i, (*_, role, text) in enumerate(turns):
            blank, again = not text.strip(SPACE), (role, text) in seen
            ends = not blank and text.rstrip(SPACE)[-1] in ".!?"
            kind = "blank" if blank else "duplicate" if again else "" if ends else "truncated"
            counts[kind] += 1
            seen.add((role, text))
            kinds.append((role[:1], blank or again, kind == "truncated"))
            illegal += i > 0 and kinds[-2][0] + kinds[-1][0] not in ("su", "ua", "au")
        numbers = {t for _, _, t, *_ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = repairs(kinds)
        lines = repaired_rows(audit, [(role, text) for *_, role, text in turns])
        digest = sha("\n".join(f"{role}:{text}" for _, role, text in lines))
        found.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(found, key=repr)
