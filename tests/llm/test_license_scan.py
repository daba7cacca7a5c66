import re

from landlens.llm import license_scan as M

from data import DOCS, frame, odd_documents

LINES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "GNU General Public License, version 3.", "the MIT\n\nLICENSE mit license",
         "SPDX-License-Identifier: MIT", "general public licence general-public license", "Copyright (c) 2019 Someone. All rights reserved.", "no words! \x00", "İ MİT LICENSE", "license", "mit", "apachelicense"]


def brute(text):
    """An independent reading of the rules: every rule at every anchor, containment by all pairs."""
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)
    base = []
    for phrase, label in M.BASE.items():
        p = phrase.split(" ")
        base += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    found = set()
    for i, w in enumerate(words):
        for anchor, _, regex, priority, label in M.rules():
            if w != anchor:
                continue
            lead = " ".join(words[max(0, i - M.BEFORE):i])
            near = lead + (" " if lead else "") + M.MARK + " ".join(words[i:i + M.AFTER + 1])
            hit = re.search(regex, near)
            if hit:
                span = hit[0].strip(" ")
                start = i - span.split(M.MARK)[0].count(" ")
                found.add((start, start + span.count(" ") + 1, priority, label))
    keep = set()
    for d in found:
        inside = False
        for e in found:
            if e == d or not (e[0] <= d[0] and d[1] <= e[1] and e[2] <= d[2]):
                continue
            if (e[0], e[1], e[2]) == (d[0], d[1], d[2]):
                inside = inside or e[3] < d[3]
            else:
                inside = True
        if not inside:
            keep.add(d)
    covered = {k for d in keep for k in range(d[0], d[1])}
    score = min(1.0, max(len(covered), len(base)) / len(words)) if words else 0.0
    return len(words), sorted(base), sorted(keep), sorted({b[1] for b in base} | {d[3] for d in keep}), score


def test_against_brute_force(spark):
    rows = odd_documents(n=20) + [(1000 + i, f"word {a} and {b}", *["x"] * 2, None, *["x"] * 4) for i, (a, b) in enumerate((a, b) for a in LINES for b in LINES)]
    got = M.scan(frame(spark, rows), carry=("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        n, base, kept, labels, score = brute(r["text"])
        assert r["n_words"] == n and sorted((b["start"], b["label"]) for b in r["base"]) == base
        assert sorted((d["start"], d["end"], d["priority"], d["label"]) for d in r["detections"]) == kept, r["text"]
        assert r["labels"] == labels and abs(r["score"] - score) < 1e-12


def test_there_are_hundreds_of_rules():
    assert len({r[2] for r in M.rules()}) > 300


def test_empty_table(spark):
    assert M.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_very_many_detections_in_one_text(spark):
    """The time grows with the detections, not with their square; the figure for 100,000 repeats is in README."""
    import time

    text, took = "the mit license ", {}
    for n in (10, 2_000, 8_000):
        began = time.time()
        r = M.scan(frame(spark, [(1, text * n, *[None] * 7)], 1)).collect()[0]
        took[n] = time.time() - began
        assert r["n_words"] == 3 * n and len(r["base"]) == n and len(r["detections"]) == 2 * n - 1 and r["labels"] == ["mit"]
    assert took[8_000] - took[10] < 5 * max(took[2_000] - took[10], 4)


def test_overlap_and_priority(spark):
    """The best of overlapping detections stays; equal ones by label."""
    rows = ["the gnu general public license version 3 only", "mit license license mit", "spdx license identifier mit license", "licensed under the apache license version 2 0"]
    for r in M.scan(frame(spark, [(i, t, *[None] * 7) for i, t in enumerate(rows)], 1), carry=("text",)).collect():
        _, _, kept, labels, _ = brute(r["text"])
        assert sorted((d["start"], d["end"], d["priority"], d["label"]) for d in r["detections"]) == kept and r["labels"] == labels
