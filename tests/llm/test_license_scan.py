import random
import re
from collections import Counter

from corpus_samples import ODD_TEXTS

from kpiloom.llm import license_scan

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [
    *ODD_TEXTS, "All  Rights—Reserved", "all rights reserved all RIGHTS reserved\nall rights", "CC-BY cc by, cc by",
    "GNU General Public License general public license", "éall rights reserved", "all rights reservedé",
    *(f"Some code here. {t.text} And more of it." for t in license_scan.TEMPLATES),
]


def test_base_against_brute_force(spark, docs_of):
    rows = license_scan.scan(docs_of(TEXTS)).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_templates_are_found_with_small_edits(spark, docs_of):
    texts = []
    for t in license_scan.TEMPLATES:
        ws = t.text.split()
        if len(ws) > 20:
            ws[len(ws) // 2] = "changed"
            ws.insert(len(ws) // 4, "inserted")
        texts.append("plain words before it " * 20 + " ".join(ws).upper() + " plain words after it" * 20)
    got = {r["doc_id"]: r for r in license_scan.scan(docs_of(texts)).collect()}
    for i, t in enumerate(license_scan.TEMPLATES):
        if not all(license_scan._stands(license_scan.scan_words(k), license_scan.scan_words(texts[i])) for k in t.key_phrases):
            continue  # the edit hit a mandatory phrase
        assert t.label in got[i]["labels"].split(","), t.label


def edited(rng, template, share):
    """A copy with a share of its words replaced, dropped or doubled (none of a mandatory phrase), wrapped as a comment."""
    ws = template.text.split()
    bare = [license_scan.scan_words(w) for w in ws]
    flat = [w for x in bare for w in x]
    owner = [i for i, x in enumerate(bare) for _ in x]
    fixed = set()
    for key in map(license_scan.scan_words, template.key_phrases):
        for i in range(len(flat) - len(key) + 1):
            if flat[i : i + len(key)] == key:
                fixed.update(owner[i : i + len(key)])
    out = []
    for i, w in enumerate(ws):
        out += [w] if i in fixed or rng.random() >= share else rng.choice([["other"], [], [w, w]])
    lines, line = [], []
    for w in out:
        line.append(rng.choice([w, w.upper(), w.lower()]))
        if len(line) == rng.randrange(6, 12) or len(line) > 11:
            lines.append(line)
            line = []
    mark = rng.choice(["# ", " * ", "// ", ""])
    return "\n".join(mark + " ".join(x) for x in [*lines, line])


def brute_labels(text):
    """Templates by comparing every start, without postings or votes."""
    ws, out = license_scan.scan_words(text), set()
    for t in license_scan.TEMPLATES:
        words, keys = license_scan.scan_words(t.text), [license_scan.scan_words(k) for k in t.key_phrases]
        for start in range(-2, len(ws)):
            near = ws[max(0, start - 4) : start + len(words) + 4]
            same = sum(0 <= start + i < len(ws) and ws[start + i] == w for i, w in enumerate(words))
            kept = sum((Counter(words) & Counter(near)).values()) - 4
            stands = all(any(near[i : i + len(k)] == k for i in range(len(near))) for k in keys)
            if stands and max(same, min(kept, len(near) - 4)) >= 0.6 * len(words):
                out.add(t.label)
    return out


def test_recall_of_edited_wrapped_copies(spark, docs_of):
    """Copies with a tenth of their words changed, in other case and wrapped: nine in ten are found, nothing else is."""
    rng = random.Random(11)
    copies = [(t.label, f"first lines of a file\n{edited(rng, t, 0.1)}\nand the code that follows it") for t in license_scan.TEMPLATES for _ in range(12)]
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in license_scan.scan(docs_of([c for _, c in copies])).collect()}
    found = [label in got[i] for i, (label, _) in enumerate(copies)]
    assert sum(found) >= 0.9 * len(found)
    for i, (_, text) in enumerate(copies):
        assert got[i] - set(license_scan.BASE_PHRASES.values()) <= brute_labels(text)


def test_labels_against_every_start(spark, docs_of):
    """Whole templates, unchanged: the index finds just what comparing all starts finds."""
    texts = [f"words before it {t.text} words after it" for t in license_scan.TEMPLATES] + ["plain words " * 50, "the license of the software is free"]
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in license_scan.scan(docs_of(texts)).collect()}
    base = set(license_scan.BASE_PHRASES.values())
    assert [got[i] - base for i in range(len(texts))] == [brute_labels(t) - base for t in texts]


def test_mandatory_phrase_and_unrelated_words(spark, docs_of):
    mit = license_scan.TEMPLATES[0].text
    texts = [mit.replace("without restriction", "with restriction"), "permission to copy the software is granted to you " * 5]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(docs_of(texts)).collect()}
    assert got == {0: "", 1: ""}


def test_empty_and_repeated(spark, docs_of):
    assert license_scan.scan(docs_of([])).count() == 0
    rows = license_scan.scan(docs_of([(1, "all rights reserved"), (1, "all rights reserved"), (None, "cc by")])).collect()
    assert sorted((str(r["doc_id"]), r["labels"]) for r in rows) == [("1", "reserved"), ("1", "reserved"), ("None", "cc-by")]
