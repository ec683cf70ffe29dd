from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybayes.llm import license_scan as L


def brute(text, threshold=L.THRESHOLD):
    """Every unit against every template, nothing pruned."""

    def bag(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c if c.isdigit() and c < "\x80" or c.islower() and c < "\x80" or c >= "\x80" else " " for c in t)
        w = [x for x in w.split(" ") if x]
        return Counter(zip(w, w[1:], strict=False))

    lines = (text or "").split("\n")
    units, now = [*lines, text or ""], []
    for line in [*lines, ""]:
        if not any(c.isdigit() or c.isalpha() or c >= "\x80" for c in line):
            units.append("\n".join(now))
            now = []
        else:
            now.append(line)
    found = []
    for u in units:
        a = bag(u)
        for name, t in L.TEMPLATES:
            b = bag(t)
            if a.total() and 2 * (a & b).total() / (a.total() + b.total()) >= threshold:
                found.append((2 * (a & b).total() / (a.total() + b.total()), name))
    return (sorted({n for _, n in found}) or None, max(found)[0] if found else None)


def documents():
    rng = random.Random(6)
    words = "alpha beta gamma the of software license é中 permission any".split()
    out = [None, "", "\n\n", "!!!", "All", "all RIGHTS, reserved", "x" * 100_000, "word " * 60_000]
    for _, t in L.TEMPLATES:
        out += [t, t.upper(), "intro words here\n\n" + t.replace(". ", ".\n") + "\n\nmore", t[: len(t) * 2 // 3], "prose " * 500 + "\n" + t]
        w = t.split()
        for _ in range(max(1, len(w) // 12)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append("\n".join(" ".join(w[i : i + 9]) for i in range(0, len(w), 9)))
    for _ in range(40):
        out.append("\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(6))))
    return out


def test_documents_equal_brute_force(spark, make_docs):
    texts = documents()
    docs = make_docs(list(enumerate(texts))).withColumn("license_match", F.lit(1)).withColumn("licenses", F.lit("x"))
    got = {r["doc_id"]: (r["licenses"], r["best_dice"]) for r in L.scan(docs).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert got[i][0] == want[0], (t or "")[:80]
        assert got[i][1] == (None if want[1] is None else pytest.approx(want[1]))
    assert sum(v[0] is not None for v in got.values()) > 30


def test_repeated_rows_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "Released under the MIT License.")] * 2 + [(None, "All rights reserved.")])
    assert sorted(str(r["licenses"]) for r in L.scan(docs).collect()) == ["['all-rights-reserved']", "['mit']", "['mit']"]
    assert L.scan(docs.limit(0)).count() == 0


def test_any_threshold_prunes_nothing_that_matches():
    texts = [t for t in documents() if t and len(t) < 20_000]
    for threshold in (0.05, 0.5, 0.95, 1.0):
        scanner = L.Scanner(threshold=threshold)
        for t in texts:
            found = scanner.scan(t)
            assert (sorted({n for _, n in found}) or None) == brute(t, threshold)[0], (threshold, t[:60])
    with pytest.raises(ValueError):
        L.Scanner(threshold=0)


def passages(text, templates, threshold=L.THRESHOLD):
    """The best Dice of each template over all passages, nothing pruned."""
    lines = [[w for w in L.normalise(line) if w] for line in text.split("\n")]
    words = [w for line in lines for w in line]
    at, starts, ends = 0, set(), set()
    for line in lines:
        if line:
            starts.add(at)
            at += len(line)
            ends.add(at)
    out = []
    for name, t in templates:
        b = L.bigrams([w for w in L.normalise(t) if w])
        size, best = b.total(), 0
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i - 1 >= size or (i in starts and j in ends):
                    best = max(best, 2 * (L.bigrams(words[i:j]) & b).total() / (size + j - i - 1))
        if best >= threshold:
            out.append((best, name))
    return sorted(out)


def test_passages_equal_brute_force():
    rng = random.Random(8)
    words = "a b c d".split()
    templates = [("x", "a b c d a b"), ("y", "b b c"), ("z", "d c b a d c a b d d"), ("x", "c a c b")]
    for threshold in (0.3, 0.6, 0.8, 1.0):
        scanner = L.Scanner(templates, threshold)
        for _ in range(150):
            text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\n\n"]) for _ in range(rng.randrange(30)))
            assert sorted(scanner.passages(text)) == passages(text, templates, threshold), (threshold, text)


def test_licences_inside_longer_texts(spark, make_docs):
    """Licences of several paragraphs in source files, and notices within a line."""
    texts, want = [], []
    for name, t in L.TEMPLATES[5:]:
        w = t.split()
        block = [" ".join(w[i : i + 9]) for i in range(0, len(w), 9)]
        third = len(block) // 3
        for mark, blank in (("", ""), ("// ", "//"), (" * ", " *")):
            body = [*block[:third], None, *block[third : 2 * third], None, *block[2 * third :]]
            body = "\n".join(blank if x is None else mark + x for x in body)
            texts.append("import os\n\n" + "x = f(1, 2)\n" * 300 + f"{blank}\n{mark}Copyright 2020 Example\n{blank}\n{body}\n\n" + "def g(): pass\n" * 300)
            want.append([name])
        texts.append("prose of a page " * 200 + t + " more prose" * 200)
        want.append([name])
    texts += ["Copyright (c) 2020 Example Inc. All rights reserved.", "This project is Released under the MIT License, as the file says, by its authors."]
    want += [["all-rights-reserved"], ["mit"]]
    texts += ["It is Licensed under the Apache License, Version 1.1 or so", "All the rights that are reserved by the authors", "MIT"]
    want += [None] * 3
    got = {r["doc_id"]: r["licenses"] for r in L.scan(make_docs(list(enumerate(texts)))).collect()}
    for i, (t, names) in enumerate(zip(texts, want, strict=True)):
        assert (None if got[i] is None else set(got[i])) == (set(names) if names else None), t[:80]
