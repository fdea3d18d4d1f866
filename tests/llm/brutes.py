"""Plain Python versions of operators, for tables of a few hundred rows."""

import re
from collections import Counter

import xxhash

from kpiloom.llm import line_dedup


def words(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]


def quality(text):
    """Base counts, base_failed and kept."""
    text = text or ""
    ws = words(text)
    windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    n, chars = len(ws), sum(map(len, ws))
    symbols, dup_lines = sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    base = n < 10 or 100 * len(covered) > 20 * n
    capitals = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
    stutters = sum(a == b for a, b in zip(ws, ws[1:]))
    solid = sum("\u4e00" <= c <= "\u9fff" or "\u3041" <= c <= "\u30ff" or "\u0e01" <= c <= "\u0e5b" for c in text)
    bad = (
        10 * symbols > 3 * n or 10 * text.count("!") > 5 * n or 10 * capitals > 6 * chars or (chars > 25 * n and 2 * solid <= chars)
        or 10 * dup_lines > 5 * len(text.split("\n")) or 100 * stutters > 20 * n
    )
    return n, chars, symbols, dup_lines, len(covered), base, not (base or bad)


def fingerprint(text, k=3):
    ws = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, fps, distance=2):
    """The smallest id reachable, for every place."""
    least = {}
    for start in range(len(ids)):
        if start in least:
            continue
        todo, seen = [start], {start}
        while todo:
            x = todo.pop()
            for y in range(len(ids)):
                if y not in seen and bin(fps[x] ^ fps[y]).count("1") <= distance:
                    seen.add(y)
                    todo.append(y)
        for y in seen:
            least[y] = min(ids[z] for z in seen)
    return [least[i] for i in range(len(ids))]


def without_repeats(rows, least_run=line_dedup.LEAST_RUN):
    """Text after cutting, for (id, text) rows, by one ordered pass; one id has one text."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc_id, text] = None
            continue
        later = []
        for kind, start, stop, first, last, digest in line_dedup.units(text):
            later.append((kind, start, stop, first, last, digest in seen))
            seen.add(digest)
        gone = set()
        for kind, start, stop, *_, repeated in later:
            if kind == line_dedup.LINE and repeated:
                gone.update(range(start, stop))
        clauses, i = [u for u in later if u[0] == line_dedup.CLAUSE], 0
        while i < len(clauses):
            j = i
            while j < len(clauses) and clauses[j][-1]:
                j += 1
            if j > i and clauses[j - 1][4] - clauses[i][3] >= least_run:
                gone.update(range(clauses[i][1], clauses[j - 1][2]))
            i = max(j, i + 1)
        out[doc_id, text] = "".join(c for k, c in enumerate(text) if k not in gone)
    return out
