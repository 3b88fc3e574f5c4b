import itertools
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparktab.llm import decontaminate as dc
from sparktab.llm import license_scan as ls
from sparktab.llm import pii
from sparktab.llm.decontaminate import drop_contaminated, find_items
from sparktab.llm.sharding import placements, ring, shard_rows

from .cases import crowded, frame, rows, same_rows, sentence

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            n = sum(c in "0123456789" for c in m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= n <= 19 and pii.luhn(re.sub("[^0-9]", "", m[0])), "phone": 10 <= n <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


DISGUISES = [
    ("mail john (at) example [dot] com now", "john (at) example [dot] com"), ("john.doe at example dot com", "john.doe at example dot com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"), ("an jоhn@exаmple.com.", "jоhn@exаmple.com"), ("a​b@x​.com", "a​b@x​.com"), ("hi john @ example.com", "john @ example.com"),
    ("call plus one five five five one two three four five six seven", "plus one five five five one two three four five six seven"), ("tel +１ (988) 555-２485 x", "+１ (988) 555-２485"),
    ("four two " * 8, "four two " * 7 + "four two"), ("+1 (988) 555-2485 4524132264652876", "+1 (988) 555-2485"),
]


@pytest.mark.parametrize("text, found", DISGUISES)
def test_disguises_map_back(text, found):
    base, spans = pii.find(text)
    assert base == plain_spans(text)
    assert found in [text[a:b] for a, b, _ in spans]
    assert not pii.find(pii.mask_all(text))[1]


@pytest.mark.parametrize(
    "text,hidden,kind",
    [
        ("please mail jane at example.com today", "jane at example.com", "email"),
        ("E-mail: jane at mail.example.org", "jane at mail.example.org", "email"),
        ("ask jane.doe at example.com", "jane.doe at example.com", "email"),
        ("ask jane99 at example.com", "jane99 at example.com", "email"),
        ("call +1 555 123 456 seven now", "+1 555 123 456 seven", "phone"),
        ("call +1 555 123 45 six seven now", "+1 555 123 45 six seven", "phone"),
        ("ΝΙΚΟ@example.com", "ΝΙΚΟ@example.com", "email"),
        ("write 𝐣𝐚𝐧𝐞@𝕖𝕩𝕒𝕞𝕡𝕝𝕖.𝒄𝒐𝒎 soon", "𝐣𝐚𝐧𝐞@𝕖𝕩𝕒𝕞𝕡𝕝𝕖.𝒄𝒐𝒎", "email"),
        ("ⓙⓐⓝⓔ@example.com", "ⓙⓐⓝⓔ@example.com", "email"),
    ],
)
def test_more_disguises(text, hidden, kind):
    start = text.index(hidden)
    assert (start, start + len(hidden), kind) in pii.find(text)[1]
    assert not pii.find(pii.mask_all(text))[1]


@pytest.mark.parametrize("text", ["look at example.com", "we met at booking.com at 5.30 at home. Then", "3 one 4 more", "Ω ΑΒΓ at Αθήνα", "sold 25 at market.example"])
def test_plain_speech_is_no_disguise(text):
    assert pii.find(text) == ([], [])


def test_prose_is_left_alone():
    for text in ("we met at noon. dot com", "look at it (at) last", "one or two of three", "meet at example.com", "Grüße an alle, né en 1999", ""):
        assert pii.find(text) == ([], []) and pii.mask_all(text) == text


def test_plain_spans_on_random_texts():
    g = random.Random(1)
    parts = ["1", "2.", "55", "@", "a", ".", "+", "-", " ", "b.c", "(", ")", "255.", "é", "９", " at ", " dot ", "one ", "4242", "\n"]
    for _ in range(3000):
        text = "".join(g.choices(parts, k=g.randint(1, 40)))
        base, spans = pii.find(text)
        assert base == plain_spans(text) and set(base) <= set(spans)
        assert not pii.find(pii.mask_all(text))[1]


def test_spans_of_a_table(spark):
    extra = [(50 + i, t, "en", "a", 1) for i, (t, _) in enumerate(DISGUISES)] + [(70, "x@y.zz 10.0.0.1, +1 (706) 555-3138; 4644348398010899", "en", "a", 1)]
    df = crowded(frame(spark, rows() + extra))
    found = pii.digest(pii.find_pii(df)).collect()
    want = []
    for k, t, *_ in rows() + extra:
        base = plain_spans(t or "")
        n = Counter(s[2] for s in base)
        line = ",".join(f"{c}:{a}:{b}" for a, b, c in base)
        want.append((k, *[n[c] for c in PATTERNS], hashlib.sha256(line.encode()).hexdigest()))
    assert same_rows([r[:6] for r in found], want)
    masked = pii.mask_pii(df)
    assert masked.columns == df.columns
    assert same_rows(masked.select("doc_id", "text").collect(), [(k, t if t is None else pii.mask_all(t)) for k, t, *_ in rows() + extra])
    assert pii.find_pii(frame(spark, [])).collect() == []


def distance_inside(window, text):
    """Least edits between the window and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def noisy(text, n, seed):
    g, out = random.Random(seed), list(text)
    for _ in range(n):
        p = g.randrange(len(out))
        out[p : p + 1] = g.choice([[], ["q"], [out[p], "z"]])
    return "".join(out)


ITEMS = [(1, sentence(900, 30)), (2, sentence(901, 12)), (3, "Short item of forty characters, no more."), (4, "tiny"), (5, None), (None, sentence(902, 20)), (6, "")]


def test_passages_are_found_as_by_brute_force():
    s = dc.Settings()
    index = dc.Index([(k, t.encode()) for k, t in ITEMS if k is not None and t], s)
    for seed in range(24):
        item = ITEMS[seed % 3][1]
        body = f"{sentence(seed, 20)} {noisy(item, seed // 3 * 2, seed)} {sentence(seed + 50, 20)}".encode()
        clean = dc.normalised(body)
        want = sorted({index.item[w] for w in range(len(index.windows)) if distance_inside(index.windows[w], clean) <= index.budget[w]})
        assert index.matches([b"", body, b"x" * 300])[1] == want
    assert index.matches([b"", b"short"]) == [[], []]


def test_decontamination(spark, monkeypatch):
    docs = rows() + [(60, f"{sentence(1, 30)} {ITEMS[0][1].upper()}\n\n{sentence(2, 30)}", "en", "a", 1), (61, "Short item of  forty characters, no more. " + noisy(ITEMS[1][1], 3, 0), "en", "a", 1), (61, None, "en", "a", 1)]
    df, items = crowded(frame(spark, docs)), spark.createDataFrame(ITEMS, "item_id long, text string")
    want = [(k, bool(f), f) for k, t, *_ in docs for f in [[1] if k == 60 else [2, 3] if k == 61 and t else []]]
    assert same_rows(find_items(df, items).collect(), want)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 150)  # more passes
    assert same_rows(find_items(df, items).collect(), want)
    kept = drop_contaminated(df, items)
    assert kept.columns == df.columns and same_rows(kept.select("doc_id", "text").collect(), [(k, t) for k, t, *_ in docs if k != 60 and not (k == 61 and t)])
    assert find_items(frame(spark, []), items).collect() == []
    assert same_rows(find_items(df, items.limit(0)).collect(), [(k, False, []) for k, *_ in docs])


def test_ring_is_bounded_and_moves_little():
    nodes = ring(8, 32)
    g = random.Random(0)
    counts = {i: g.randrange(40) for i in range(len(nodes))}
    n = sum(counts.values())
    room = [n // 8 + (s < n % 8) for s in range(8)]
    plan = placements(nodes, counts, room)
    load, taken, slots = Counter(), Counter(), Counter()
    for node, first, k, shard, slot in sorted(plan, key=lambda p: (p[0], p[1])):
        assert first == taken[node]
        taken[node] += k
        load[shard] += k
        for i in range(k):
            slots[shard, slot + i] += 1
    assert [load[s] for s in range(8)] == room and {k: v for k, v in counts.items() if v} == dict(taken)
    assert len(slots) == n and max(slots.values()) == 1
    # one at a time: the shard's own rows first, then those that go on clockwise
    free, at, over = list(room), {}, []
    for node, (_, shard) in enumerate(nodes):
        for r in range(counts[node]):
            if free[shard]:
                free[shard] -= 1
                at[node, r] = shard
            else:
                over.append((node, r))
    for node, r in over:
        k = next(i for i in range(1, len(nodes) + 1) if free[nodes[(node + i) % len(nodes)][1]])
        shard = nodes[(node + k) % len(nodes)][1]
        free[shard] -= 1
        at[node, r] = shard
    assert {(node, first + i): shard for node, first, k, shard, _ in plan for i in range(k)} == at
    assert sum(s != nodes[node][1] for (node, _), s in at.items()) < 0.25 * n


def test_sharding(spark):
    own = rows() + [(7, "hot", "en", "a", 3)] * 60
    found = shard_rows(crowded(frame(spark, own)), shards=7, virtual_nodes=16).collect()
    want = [(k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows") for k, t, *_ in own]
    assert same_rows([r[:4] for r in found], want)
    by_shard = {s: sorted(r.slot for r in found if r.shard == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(r.grown_shard is None for r in found)
    assert shard_rows(frame(spark, [])).collect() == []


def test_shards_depend_on_rows_alone_and_move_little(spark):
    df = frame(spark, [(i, f"text {i}", "en", "a", 1) for i in range(4000)] + [(9, "text 9", "en", "a", 1)] * 700)
    found = [sorted((r.doc_id, r.shard) for r in shard_rows(df.repartition(p), n).collect()) for p, n in ((2, 40), (7, 40), (3, 41))]
    assert found[0] == found[1]
    before, after = ({k: v for k, v in rows if k != 9} for rows in (found[0], found[2]))
    moved = sum(after[k] != v for k, v in before.items())
    assert moved < 3 * 4000 / 41  # the new shard takes 1 / 41, full shards pass on some


LICENSED = {
    "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache", "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under CC BY-SA 4.0.": "CC-BY-SA", "All rights reserved.": "proprietary", "Copyright 2019 Somebody. All rights reserved.": "proprietary",
    "LICENSED UNDER THE APACHE LICENSE,   VERSION 2.0": "Apache", "Licensed under the GNU Lesser General Public License, version 2.1.": "LGPL",
}


@pytest.fixture(scope="module")
def licenses():
    return ls.train([sentence(s, 30).encode().split() for s in range(200)], ls.Settings(variations=30))


def test_families(licenses):
    for line, family in LICENSED.items():
        body = f"{sentence(1, 100)}\n{line}\n{sentence(2, 20)}".encode()
        assert [f[0] for f in licenses.scan(body)] == [family] and licenses.scan(body)[0][3] == 1
        long = f"{sentence(3, 90)} {line} {sentence(4, 90)}".encode()  # inside a long paragraph
        assert {f[0] for f in licenses.scan(long)} == {family}
    for line in ("the license of the tribe", "it was released under the bridge", "the rights of man", "", "MIT", "a general public of the version"):
        assert licenses.scan(line.encode()) == []


NAMED = {
    "SPDX-License-Identifier: ISC": "ISC", "SPDX-License-Identifier: EPL-2.0": "EPL", "SPDX-License-Identifier: Zlib": "Zlib", "SPDX-License-Identifier: GPL-2.0-only": "GPL",
    "SPDX-License-Identifier: BSL-1.0": "BSL", "SPDX-License-Identifier: BSD-2-Clause": "BSD", "# SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL", "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL",
    "SPDX-License-Identifier: Foo-1.0": None, "Licensed under the Foo License, Version 2.0.": None, "Released under the Foo License.": None, "This work is licensed under a Foo 4.0 International License.": None,
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License": "AGPL",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.": "MIT",
}


@pytest.mark.parametrize("line, family", NAMED.items())
def test_what_names_a_family_decides(licenses, line, family):
    """Wordings that licences have in common name none of them."""
    assert [f[0] for f in licenses.scan(line.encode())] == ([family] if family else [])


def test_several_notices_on_a_line(licenses):
    one = {f: ts[0] for f, ts in ls.TEMPLATES.items()}
    for a, b in itertools.combinations(one, 2):
        assert [f[0] for f in licenses.scan(f"{one[a]} {one[b]}".encode())] == sorted((a, b)), (a, b)
    for f, ts in ls.TEMPLATES.items():  # and none is found in another's notice
        for t in ts:
            assert [x[0] for x in licenses.scan(t.encode())] == [f], t


def test_wrapped_notices(licenses):
    for family, templates in ls.TEMPLATES.items():
        for t in (t for t in templates if len(t.split()) > 1):
            ws = t.split()
            for at in range(1, len(ws)):
                body = f"{sentence(1, 100)}\n\n/*\n * {' '.join(ws[:at])}\n * {' '.join(ws[at:])}\n */\n\n{sentence(2, 20)}".encode()
                assert {f[0] for f in licenses.scan(body)} == {family}, (t, at)
    bsd = b"All rights reserved.\n\n# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met"
    assert [(f[0], f[3]) for f in licenses.scan(bsd)] == [("proprietary", 0), ("BSD", 2)]
    far = b"\n".join([*(sentence(s, 9).encode() for s in range(900)), *bsd.split(b"\n")[2:]])
    assert [(f[0], f[3]) for f in licenses.scan(far)] == [("BSD", 900)]


def test_decisions_equal_a_dense_softmax(licenses):
    lines = [*LICENSED, "licensed under the", "this program is free", sentence(5, 40)]
    x = licenses.dense([ls.words_of(t.encode()) for t in lines])
    p = ls.softmax((x @ licenses.w + licenses.bias) / licenses.heat)
    for t, own in zip(lines, p, strict=True):
        assert np.allclose(licenses.chances(licenses.row(ls.words_of(t.encode()))), own)


def test_license_scan(spark):
    docs = rows() + [(80, "first\nReleased under the MIT License.\nAll rights reserved.", "en", "a", 1)]
    found = ls.scan_licenses(crowded(frame(spark, docs)), ls.Settings(variations=20)).collect()
    assert same_rows([r[:3] for r in found], [(k, "MIT,proprietary" if k == 80 else "", 2 if k == 80 else 0) for k, *_ in docs])
    assert ls.scan_licenses(frame(spark, []), ls.Settings(variations=5)).collect() == []
