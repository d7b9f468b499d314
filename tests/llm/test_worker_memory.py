"""What a worker holds at once: parts of a bucket, windows of a batch, pieces of a tokeniser."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_text_operators import test_repeat_spans_however_dealt as however_dealt


@pytest.mark.parametrize("at_once", [1, 40, 700])
def test_repeats_are_the_same_however_a_bucket_is_cut(at_once, monkeypatch):
    import dimsmith.llm.repeat_spans as R
    monkeypatch.setattr(R, "SORT_AT_ONCE", at_once)
    however_dealt(1, monkeypatch)


def test_parts_of_a_bucket_are_small_and_keep_ties_together():
    from dimsmith.llm.repeat_spans import _parts
    tie = np.random.default_rng(1).integers(0, 1 << 32, 5000).astype(np.uint32).repeat(2)
    parts = list(_parts(tie, 500))
    assert len(parts) == 20 and max(map(len, parts)) < 1000
    assert np.array_equal(np.sort(np.concatenate(parts)), np.arange(len(tie)))
    seen = [set(tie[p].tolist()) for p in parts]
    assert sum(map(len, seen)) == len(set(tie.tolist()))
    assert [len(p) for p in _parts(tie[:0], 500)] == [0]


def test_pieces_are_kept_from_slice_to_slice_up_to_a_bound(monkeypatch, odd_rows):
    import public_tokenizers

    import dimsmith.llm.token_store as T
    enc = T.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t or "" for _, t, *_ in odd_rows]
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    calls = []
    piece = enc._piece
    monkeypatch.setattr(enc, "_piece", lambda p: calls.append(p) or piece(p))
    assert T.encoder(public_tokenizers.path("word_bpe_49k.json")) is T.encoder(public_tokenizers.path("word_bpe_49k.json"))
    for bound in (1 << 16, 8):
        monkeypatch.setattr(T, "KEPT_PIECES", bound)
        enc.kept.clear()
        calls.clear()
        got = []
        for i in range(0, len(texts), 5):
            ids, counts = enc(pa.array(texts[i:i + 5], pa.string()))
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
            assert len(enc.kept) <= bound
        assert got == want
        if bound > 8:       # a piece is encoded once, not once a slice
            short = [p for p in calls if len(p) <= 64]
            assert len(short) == len(set(short))
