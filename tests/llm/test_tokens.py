import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparktab.llm.common import by_bytes
from sparktab.llm.packing import Plan, pack
from sparktab.llm.token_counts import token_counts
from sparktab.llm.tokens import WordEncoder, default_path, segments

from .cases import crowded, frame, rows, same_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def test_words_have_the_ids_of_whole_texts(library):
    texts = [(r[1] or "") for r in rows()] + ["it's IT'S o'clock's. 3.14 ... .,; É été. ́ x y <|STARTOFTEXT|> a<|startoftext|>b", "Σίσυφος ΣΊΣΥΦΟΣ", "a\x1cb\x85c"]
    texts += ["".join(random.Random(i).choices(list("abAB .,'’é́\n\t0123<|>!?ΣςİI"), k=300)) for i in range(60)]
    coder, counter = WordEncoder(default_path()), WordEncoder(default_path(), counts=True)
    bodies = [t.encode() for t in texts]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(bodies)] == want
    assert counter.encode(bodies) == [len(w) for w in want]


def test_long_texts_are_cut_at_white_space(library):
    body = " ".join(f"word{i}" for i in range(5000)).encode()
    parts = list(segments(body, 1000))
    assert b"".join(parts) == body and len(parts) > 30
    counter = WordEncoder(default_path(), counts=True)
    assert sum(counter.encode([p])[0] for p in parts) == len(library.encode(body.decode(), add_special_tokens=False).ids)
    assert list(segments(b"x" * 5000, 1000)) == [b"x" * 5000]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="white space"):
        WordEncoder(default_path("byte_bpe_50k.json"))


def test_counts(spark, library):
    want = [(k, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for k, t, *_ in rows()]
    assert same_rows(token_counts(crowded(frame(spark))).collect(), want)
    assert token_counts(frame(spark, [])).collect() == []


def packed(found, capacity):
    seqs = {}
    for r in found:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_packing(spark, library):
    found = pack(crowded(frame(spark))).collect()
    want = []
    for k, t, *_ in rows():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(k, i // 2048, i, len(p := ids[i : i + 2048]), zlib.crc32(np.array(p, "<u4").tobytes())) for i in range(0, len(ids), 2048)]
    assert same_rows([r[:5] for r in found], want)
    assert packed(found, 2048) == -(-sum(r.length for r in found) // 2048)
    assert pack(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_as_good_as_first_fit(seed):
    g = random.Random(seed)
    capacity = g.choice([30, 100, 2048])
    sizes = [min(capacity, max(1, int(g.paretovariate(1.1) * capacity / 12))) for _ in range(700)]
    plan = Plan(Counter(sizes), capacity)
    bins = Counter()
    seen = Counter()
    for s in plan.steps:
        assert s.rank == seen[s.length]
        seen[s.length] += s.count
        for i in range(s.count):
            bins[s.sequence + i // s.each] += s.length
    assert seen == Counter(sizes) and len(bins) == plan.sequences and max(bins.values()) <= capacity
    fit = []  # first fit, longest first
    for size in sorted(sizes, reverse=True):
        k = next((i for i, room in enumerate(fit) if room >= size), None)
        if k is None:
            fit.append(capacity - size)
        else:
            fit[k] -= size
    assert plan.sequences <= len(fit)


def test_large_items_are_at_most_two_to_a_sequence():
    plan = Plan({1400: 5, 700: 4, 683: 3, 640: 2}, 2048)
    large = Counter()
    for s in plan.steps:
        if 3 * s.length > 2048:
            for i in range(s.count):
                large[s.sequence + i // s.each] += 1
    assert max(large.values()) == 2


def test_groups_are_balanced_by_bytes():
    groups = list(by_bytes(list(range(6)), [b"a" * 10, b"b" * 95, b"c" * 300, b"", b"d", b"e" * 99], 100))
    assert [k for k, _ in groups] == [[0], [1], [2], [3, 4, 5]]
