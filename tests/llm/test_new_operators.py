"""Packing, hard negatives and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# --- packing ---------------------------------------------------------------------------------

def fill_one_by_one(lengths, capacity):
    """The procedure itself, one sequence after the other, over the pieces' lengths."""
    left, out = Counter(lengths), []
    while left:
        mine, gap = [], capacity
        for x in sorted(left, reverse=True):
            while left[x] and x <= gap:
                mine.append(x)
                left[x] -= 1
                gap -= x
        if gap:
            small = min(mine)
            have = sorted(x for x in left if left[x] and x <= gap + small)
            best = (small, None)
            for a in have:
                fits = [b for b in have if a + b <= gap + small and (a != b or left[a] > 1)]
                if fits and a + max(fits) > best[0]:
                    best = a + max(fits), (a, max(fits))
            if best[1]:
                mine.remove(small)
                left[small] += 1
                mine += best[1]
                left -= Counter(best[1])
        left = +left
        out.append(tuple(sorted(mine)))
    return Counter(out)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_the_procedure(seed):
    from dimsmith.llm.best_fit_packing import best_two_fit
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [min(capacity, int(rng.choice([1, 1, rng.uniform(1, capacity), rng.expovariate(0.1) + 1]))) for _ in range(rng.choice([0, 1, 300, 3000]))]
    plan = best_two_fit(np.bincount(lengths, minlength=capacity + 1), capacity)
    got, seen = defaultdict(list), defaultdict(list)
    for length, first, copies, times, sequence, offset in plan.tolist():
        seen[length] += range(first, first + copies * times)
        for s in range(sequence, sequence + times):
            got[s] += [(offset + i * length, length) for i in range(copies)]
    assert {x: sorted(v) for x, v in seen.items()} == {x: list(range(n)) for x, n in Counter(lengths).items()}
    for parts in got.values():          # gapless from 0
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert Counter(tuple(sorted(x for _, x in p)) for p in got.values()) == fill_one_by_one(lengths, capacity)


def test_two_pieces_replace_the_smallest():
    from dimsmith.llm.best_fit_packing import best_two_fit
    plan = best_two_fit(np.bincount([60, 30, 22, 17], minlength=101), 100)      # 60 + 30 leaves 10: 22 + 17 fit better than 30
    assert sorted(plan[plan[:, 4] == 0][:, 0].tolist()) == [17, 22, 60]


def packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and 1 <= length <= capacity
            at += length
        assert at <= capacity
    return by


@pytest.mark.parametrize("bucket_rows", [50_000, 7])
def test_packing_places_every_piece(spark, odd_docs, odd_rows, no_docs, bucket_rows):
    from dimsmith.llm.best_fit_packing import default_tokenizer, pack, packed_sequences, token_pieces
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_tokenizer())
    want = Counter()
    docs = Counter()
    for doc, text, *_ in odd_rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        docs[doc, tuple(ids)] += 1
        for i, s in enumerate(range(0, len(ids), 512)):
            raw = np.array(ids[s:s + 512], "<u4").tobytes()
            want[doc, i, s, len(raw) // 4, zlib.crc32(raw)] += 1
    rows = pack(token_pieces(odd_docs, default_tokenizer(), 512), 512, bucket_rows).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = packed(rows, 512)
    assert Counter(tuple(sorted(x for _, x in p)) for p in by.values()) == fill_one_by_one([x[3] for x in want.elements()], 512)
    if bucket_rows == 7:
        return
    # the sequences themselves hold the documents
    got = Counter()
    parts = defaultdict(list)
    for r in packed_sequences(odd_docs, capacity=512).collect():
        ends = [d.offset for d in r.doc_starts[1:]] + [len(r.ids)]
        for d, e in zip(r.doc_starts, ends, strict=True):
            if d.start == 0 and e - d.offset < 512:
                got[d.doc_id, tuple(r.ids[d.offset:e])] += 1
            parts[d.doc_id].append((d.start, r.ids[d.offset:e]))
    assert got == Counter({k: n for k, n in docs.items() if len(k[1]) < 512})
    times = Counter(k[0] for k in docs.elements())
    long = {k[0]: k[1] for k in docs if len(k[1]) >= 512 and times[k[0]] == 1}
    assert len(long) > 5
    for doc, ids in long.items():
        assert [t for _, x in sorted(parts[doc]) for t in x] == list(ids)
    assert pack(token_pieces(no_docs, default_tokenizer())).count() == 0
    assert packed_sequences(no_docs).count() == 0


def test_packing_query_is_tight(spark):
    from dimsmith.llm.best_fit_packing import op11_best_fit_packing
    rows = op11_best_fit_packing(spark, SF_SMALL).collect()
    by = packed(rows, 4096)
    assert len(by) <= -(-sum(r.length for r in rows) // 4096) + 1
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


# --- hard negatives --------------------------------------------------------------------------

def brute_negatives(rows, anchor, n_positives=5, k=3, low=50, high=95):
    sound = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows
             if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
             and sum(math.floor(256 * x) ** 2 for x in v) < 2 ** 62}
    out = Counter()
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    for i, lab, q in sound:
        if not anchor(i):
            continue
        near = [(sum(a * b for a, b in zip(q, p, strict=True)), j, other) for j, other, p in sound if j != i and len(p) == len(q)]
        for s, j, _ in sorted([t for t in near if t[2] == lab], key=order)[:n_positives]:
            bad = sorted([t for t in near if t[2] != lab and low * s <= 100 * t[0] <= high * s], key=order)[:k]
            for rank, (n, m, _) in enumerate(bad, 1):
                out[i, j, rank, m, s, n] += 1
    return out


def negatives(df):
    cols = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("scale", [1.0, 2.0 ** 21])
@pytest.mark.parametrize("blocks", [(4096, 2048), (64, 2)])
def test_negatives_match_brute_force(spark, monkeypatch, scale, blocks):
    import dimsmith.llm.hard_negatives as hn
    monkeypatch.setattr(hn, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(hn, "ANCHOR_ROWS", blocks[1])
    if blocks[0] == 64:
        monkeypatch.setattr(hn, "CHUNK", 100)
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3, -4]), [scale * rng.choice([rng.gauss(0.1, 0.3), 0.25, 0.5]) for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, 1 + i % 2, [0.5 * scale, 0.25 * scale, 0.25 * scale, 0.5 * scale]) for i in range(100)]     # one vector many times
    rows += [rows[0], rows[10], (10, 2, [0.5 * scale] * 4), (None, 1, [0.5 * scale] * 4), (None, 0, [0.4 * scale] * 4),
             (500, None, [0.1] * 4), (600, 1, None), (610, 1, [0.1, None, 0.2, 0.3]), (620, 1, [0.1, float("nan"), 0.2, 0.3]),
             (630, 1, [0.1, float("inf"), 0.2, 0.3]), (640, 1, [1e300, 0.0, 0.0, 0.0]), (650, 1, []), (660, 2, []), (670, 1, [0.5 * scale] * 3),
             (680, 1, [0.3 * scale] * 3), (690, 2, [0.4 * scale] * 3), (700, 99, [-0.1 * scale] * 4), (720, 1, [0.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vec array<double>").repartition(5)
    for c in ("q", "dim", "cell", "slot", "m", "aid", "part", "is_anchor", "rank", "n"):
        df = df.withColumn(c, F.lit("extra"))
    got = negatives(hn.mine_negatives(df, F.col("vec_id") % 10 == 0))
    assert got == brute_negatives(rows, lambda i: i is not None and i % 10 == 0)
    assert len(got) > 200


def test_no_rows_no_negatives(spark):
    from dimsmith.llm.hard_negatives import mine_negatives
    df = spark.createDataFrame([], "vec_id long, label int, vec array<float>")
    assert mine_negatives(df, F.col("vec_id") % 10 == 0).count() == 0


# --- importance resampling -------------------------------------------------------------------

def brute_resample(docs, target, least, most, buckets, min_words, percent):
    def feats(t):
        w = WORD.findall(lower(t))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(least, most + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, x, *_ in docs:
        s.update(feats(x)[1])
    for x in target:
        t.update(feats(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc, x, *_ in docs:
        n, f = feats(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words))
    some = sorted([r for r in rows if r[4]], key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter((r[0], r[3], i) for i, r in enumerate(some[:percent * len(some) // 100], 1))
    return Counter(r[:4] for r in rows), ranks


@pytest.mark.parametrize("options", [(1, 1, 10000, 20, 10), (1, 3, 500, 1, 60), (2, 2, 97, 0, 100)])
def test_resampling_matches_brute_force(spark, odd_docs, odd_rows, no_docs, options):
    from dimsmith.llm.importance_sampling import drawn_documents, resample
    target = [odd_rows[3][1], "Übung macht   den Meister", None, "one ONE one"]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    rows = resample(odd_docs, t, *options).collect()
    want, ranks = brute_resample(odd_rows, target, *options)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in rows) == want
    assert Counter((r.doc_id, r.score, r.rank) for r in rows if r.rank is not None) == ranks
    drawn = drawn_documents(odd_docs, t, least=options[0], most=options[1], buckets=options[2], min_words=options[3], percent=options[4])
    assert drawn.columns == [*odd_docs.columns, "draw_rank"]
    assert {r.doc_id for r in drawn.select("doc_id").collect()} == {k[0] for k in ranks}
    assert resample(no_docs, t).count() == 0
    assert resample(odd_docs, t.limit(0)).count() == len(odd_rows)


@pytest.mark.parametrize("bits", [(12, 17), (3, 4)])
def test_radix_ranks_sort(spark, monkeypatch, bits):
    import dimsmith.llm.importance_sampling as isr
    monkeypatch.setattr(isr, "DIGIT_BITS", bits[0])
    rng = random.Random(5)
    rows = [(rng.choice([7, 7, rng.randint(-300, 300)]), rng.choice([None, rng.randint(-9, 9), rng.choice([-1, 1]) * 2 ** 62])) for _ in range(700)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, score long, doc_id long").repartition(6)
    got = isr.radix_ranks(df, [("score", True), ("doc_id", False)], bits[1]).orderBy("place").collect()
    assert [r.place for r in got] == list(range(700))
    assert [(r.score, r.doc_id) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    same = isr.radix_ranks(df.withColumn("score", F.lit(1).cast("long")), [("score", True)], bits[1])
    assert sorted(r.place for r in same.collect()) == list(range(700))
