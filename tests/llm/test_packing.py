import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.llm.packing import END_ID, best_cuts, candidates, pack


def cost(pos, pen, cuts, window, exact_from):
    total = 0.0
    for a, b in zip(cuts, cuts[1:]):
        n = pos[b] - pos[a]
        assert 0 < n <= window
        total += pen[b] + (0 if n >= exact_from and n & (n - 1) == 0 else window - n)
    return total


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.integers(0, 2)), min_size=1, max_size=40))
def test_cuts_are_cheapest(steps):
    pos = np.concatenate([[0], np.cumsum([n for n, _ in steps])])
    pen = np.array([0.0, *[(0.0, 3.0, 9.0)[k] for _, k in steps]])
    window, exact = 32, 8
    best = [0.0] + [np.inf] * len(steps)
    for j in range(1, len(pos)):
        for i in range(j):
            n = pos[j] - pos[i]
            if n <= window:
                pad = 0 if n >= exact and n & (n - 1) == 0 else window - n
                best[j] = min(best[j], best[i] + pad + pen[j])
    cuts = best_cuts(pos, pen, window, exact)
    assert cuts[0] == 0 and cuts[-1] == len(pos) - 1
    assert cost(pos, pen, cuts, window, exact) == best[-1]


def test_long_sentences_get_hard_candidates():
    pos, kind = candidates(np.array([5000, 5010]), np.array([100, 4900]), 512)
    assert np.diff(pos).max() <= 512 and pos[0] == 0 and pos[-1] == 5010
    assert kind[list(pos).index(5000)] == 0 and kind[list(pos).index(100)] == 1


def test_round_trip(nasty, nasty_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pack(nasty, block_tokens=5000).collect()
    want = sorted(([-1 if r[0] is None else r[0]], tok.encode(r[1] or "", add_special_tokens=False).ids + [END_ID]) for r in nasty_rows)
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    got = []
    for key, parts in docs.items():
        parts.sort(key=lambda r: (r.sequence_id, r.offset))
        ids = []
        for r in parts:
            assert r.start == len(ids)
            ids += r.ids
            if len(ids) == r.doc_tokens:
                got.append(([-1 if key is None else key], ids))
                ids = []
        assert not ids
    assert sorted(got) == want


def test_little_padding(make_docs):
    from tests.llm.conftest import prose

    rows = pack(make_docs([(i, prose(i, 40 + i * 13 % 900)) for i in range(120)]).coalesce(1), with_ids=False).collect()
    n = defaultdict(int)
    for r in rows:
        n[r.sequence_id] += r.length
    padding = sum(0 if x & (x - 1) == 0 else 2048 - x for x in n.values())
    assert padding < 0.03 * sum(n.values()) + 2048
    whole = sum(1 for r in rows if r.length == r.doc_tokens)
    assert whole > 0.4 * 120


def test_empty(empty):
    assert pack(empty).count() == 0


def test_small_piece_tables_pack_the_same(nasty):
    whole = pack(nasty, block_tokens=5000).drop("sequence_id").collect()
    small = pack(nasty, block_tokens=5000, most_pieces=3).drop("sequence_id").collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.start, r.ids_crc32, r.offset)
    assert sorted(whole, key=key) == sorted(small, key=key)
