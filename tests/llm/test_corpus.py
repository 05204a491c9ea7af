"""Prefix trie, filter audit and license scan against brute force, on odd rows."""

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from gondola.llm import license_scan
from gondola.llm.filter_audit import audit, failure_counts, removal_ranks
from gondola.llm.license_scan import scan_licenses
from gondola.llm.prefix_trie import end_digests, prefix_trie, rebuild, turn_rows

CONV = "conv_id long, turn long, role string, text string, node string, len long"


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]
            own[c].append((t is not None, t or 0, digest, role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].add(c)
        ends[tuple(s)].append(c)
    out = set()
    for k, m in members.items():
        below = [n for n in members if n[:len(k)] == k]
        inner = {n[:-1] for n in members if n}
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), sum(n[:-1] == k for n in below if n and n != k),
                 sum(n not in inner for n in below), sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                 hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()))
    return out


def trie_rows(spark, rows):
    trie = prefix_trie(rebuild(turn_rows(spark.createDataFrame(rows, CONV))))
    got = trie.nodes.join(end_digests(trie.ends), "node", "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    out = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or empty) for r in got]
    assert len(out) == len(set(out))
    return set(out)


def test_trie_of_odd_conversations(spark):
    rows = [(c, t, "user" if t % 2 else None, text, "x", 7) for c in (0, 1, 2, 3, 4, 5, 99, 103, 104, 250) for t, text in
            enumerate(["hi", "hi", None, "🙂 ü", "last", "more", "end"][:2 + c % 6])]
    rows += [(c, t, "user", "hi", None, None) for c in range(300, 340) for t in range(5)]  # copies
    rows += [(400, None, "", "", None, None), (400, 1, None, None, None, None), (401, 1, "a", "b", None, None), (401, 1, "a", "c", None, None),
             (401, 1, "a", "c", None, None), (None, 1, "a", "b", None, None), (500, 0, "user", "w " * 50_000, None, None), (501, 0, "user", "w", None, None)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_nothing_and_of_one_long_conversation(spark):
    assert trie_rows(spark, []) == set()
    rows = [(7, t, "user", f"t{t % 3}", None, None) for t in range(120)] + [(8, 0, "user", "t0", None, None)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_end_list_digest_over_many_parts(spark):
    """Copies whose ids fill many parts of an end list, unordered at the source."""
    ids = [(i * 7919) % 60_001 * 100 for i in range(3000)]
    rows = [(c, t, "user", "x", None, None) for c in ids for t in range(6)]
    top = [r for r in trie_rows(spark, rows) if r[1] == 6]
    assert [r[7] for r in top] == [hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()]


def test_removal_ranks_are_the_first_failed_filter():
    orders, ranks = removal_ranks(4)
    for o, column in zip(orders, ranks.T):
        for mask, rank in enumerate(column):
            assert rank == next((i for i, f in enumerate(o) if mask >> f & 1), 4)


def brute_audit(docs, labels):
    fails = {}
    for i, (k, text, _) in enumerate(docs):
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails[i] = {f for f, bad in {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                                     "D": re.search("[#$%&*|]", text) is not None,
                                     "E": k is not None and any(j is not None and j < k and (t or "") == text for j, t, _ in docs)}.items() if bad}
    good, toxic = ({k for k, *ls in labels if k is not None and ls[i] == 1} for i in (0, 1))
    out, parts = {}, {s or "" for _, _, s in docs}
    for p in parts:
        mine = [i for i, d in enumerate(docs) if (d[2] or "") == p]
        taken = defaultdict(int)
        for o in permutations("ABCDE"):
            left = set(mine)
            for step, f in enumerate(o, 1):
                gone = {i for i in left if f in fails[i]}
                taken[f] += len(gone)
                out[p, "".join(o), step] = [len(left - gone), len(gone), sum(f in fails[i] for i in mine if i not in left), sum(fails[i] == {f} for i in mine),
                                            sum(docs[i][0] in good for i in gone), sum(docs[i][0] in toxic for i in gone)]
                left -= gone
        for (q, o, step), row in out.items():
            if q == p:
                row.append(taken[o[step - 1]])
    return out


def test_audit_of_odd_documents(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(1, long, "x"), (2, long, "x"), (2, long, "y"), (3, long + " $", ""), (4, None, None), (5, "", "x"), (None, "", "x"), (None, long, "y"),
            (6, "a " * 80, "x"), (7, "A B C", "y"), (8, "A #", "y"), (9, "w " * 40_000, "y"), (9, "w " * 40_000, "y"), (0, "a " * 80, "y"), (10, "ÄÖ | é" * 20, None)]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, good long, mask long")
    counts, names = failure_counts(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.col("source"))
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in audit(counts, names).collect()}
    assert got == brute_audit(docs, labels)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    counts, names = failure_counts(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int"), F.col("source"))
    assert audit(counts, names).collect() == []


def brute_scan(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))
    starts, base, labels, score = [], set(), set(), 0.0
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        starts += at
        if at:
            base.add(label)
            score = 1.0
    for notice, label in license_scan.NOTICES:
        words = set(notice.split())
        for b in range(0, max(len(ws), 1), license_scan.STEP):
            share = len(words & set(ws[b:b + license_scan.BLOCK])) / len(words)
            if share >= license_scan.THRESHOLD:
                labels.add(label)
                score = max(score, share)
    return len(ws), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(base | labels), score


def test_scan_of_odd_documents(spark):
    filler = " ".join(f"word{i}" for i in range(40))
    texts = [None, "", " -- ", "CC-BY cc by", "all rights, reserved. All Rights Reserved", "all reserved rights", "Licensed under the Apache License, Version 2.0",
             "under version 2 0 license licensed the apache", filler + " GNU General Public License, version 3 " + filler, "general public license " * 3000,
             "Permission is hereby granted, free of charge, to any person obtaining a copy of the software", "ünïcc by 日本 cc by cc by",
             "released under the MIT-License", "released under a MIT notice", "x" * 200_000, *["all " * k + "rights reserved" for k in range(28, 36)],
             *["a " * k + "general public license" for k in range(12, 34)]]
    rows = [(i // 2 if i % 5 else None, t, 1, "y") for i, t in enumerate(texts)] + [(3, "CC-BY cc by", 1, "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, row long, w string")
    got = sorted(((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base, r.labels, r.score) for r in scan_licenses(df).collect()), key=repr)
    assert got == sorted(((k, *brute_scan(t)) for k, t, *_ in rows), key=repr)


def test_scan_of_other_templates(spark):
    df = spark.createDataFrame([(1, "red green blue one two"), (2, "red one two three")], "doc_id long, text string")
    got = {r.id: (r.labels, r.score) for r in scan_licenses(df, phrases=[("one two", "n")], notices=[("red green blue black", "c")], threshold=0.75).collect()}
    assert got == {1: (["c", "n"], 1.0), 2: (["n"], 1.0)}
    assert scan_licenses(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        scan_licenses(df, notices=[("w " * 18, "long")])
