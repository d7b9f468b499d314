"""The text operators against plain Python versions on a small table of odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def by_row(df):
    return Counter(tuple(r) for r in df.collect())


# --- near duplicates -------------------------------------------------------------------------

def shingles(text):
    w = SPACE.findall(lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = Counter()
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        first = min(ids) if ids else None
        for i in g:
            out[rows[i][0], len(sets[i]), first, rows[i][0] == first] += 1
    return out


def test_near_duplicates(odd_docs, odd_rows, no_docs):
    from dimsmith.llm.near_dedup import near_duplicates
    assert by_row(near_duplicates(odd_docs).drop("tk")) == brute_components(odd_rows)
    assert near_duplicates(no_docs).count() == 0


def test_chain_of_near_duplicates_is_one_component(spark):
    from dimsmith.llm.near_dedup import near_duplicates
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):     # each differs from the next by a few words, the ends share nothing much
        w = list(words)
        for k in range(i):
            w[k * 9] = f"other{k}"
        rows.append((100 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_row(near_duplicates(df).drop("tk")) == brute_components(rows)


def test_half_keys_find_pairs_at_the_threshold():
    """Share of pairs at similarity 0.75 to 0.8 that meet in a table."""
    from dimsmith.llm.near_dedup import ROWS, half_keys
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 50, 75, dtype=np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 50, k, dtype=np.uint64)]) for k in (12, 13))
        x, y = half_keys(np.concatenate([a, b]), np.array([len(a), len(b)]))
        met += bool((x[:ROWS] == y[:ROWS]).any() and (x[ROWS:] == y[ROWS:]).any())
    assert met >= 298


# --- decontamination -------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(rows, items, width=10):
    out = Counter()
    wins = []
    for item, text in items:
        w = WORD.findall(lower(text))
        wins += [(item, w[i:i + width]) for i in range(max(len(w) - width + 1, 1))] if w else []
    for doc, text, *_ in rows:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, x in wins:
            for i in range(len(w) - len(x) + 1):
                if w[i:i + len(x)] == x:
                    hit |= set(range(i, i + len(x)))
                    found.add(item)
        ids = ",".join(sorted(str(f) for f in found if f is not None))
        out[doc, len(w), len(hit), ids] += 1
    return out


def test_contamination(spark, odd_docs, odd_rows, no_docs):
    from dimsmith.llm.decontaminate import contamination
    passage = odd_rows[44][1].split("\n")[1]
    items = [(1, passage), (2, "nothing of this kind occurs anywhere in these texts for sure"), (3, "C, d!"), (4, None), (5, ""),
             (None, odd_rows[0][1]), (10, passage.upper()), (10, passage), (7, " ".join(["ab"] * 12))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (100_000, 7):
        got = contamination(odd_docs, bench, block_terms=block)
        assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in got.collect()) == brute_hits(odd_rows, items)
    assert contamination(no_docs, bench).count() == 0
    none = contamination(odd_docs, bench.limit(0))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(odd_rows)


def test_proximity_matches(spark):
    from dimsmith.llm.decontaminate import contamination
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    other = phrase[:4] + ["word"] + phrase[4:]
    docs = spark.createDataFrame([(1, " ".join(phrase)), (2, " ".join(other)), (3, "alpha beta gamma")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(phrase))], "item_id long, text string")
    got = {r.doc_id: (r.item_ids, r.near_items) for r in contamination(docs, bench).collect()}
    assert got == {1: (["9"], ["9"]), 2: ([], ["9"]), 3: ([], [])}


# --- line templates --------------------------------------------------------------------------

def brute_lines(rows, min_docs):
    def line_templates(line):
        w = SPACE.findall(line)
        if len(w) < 8:
            return {(len(w), tuple(w), 0)} if w else set()
        w = ["<*>" if re.search("[0-9]", x) else x for x in w]
        rest = len(w) - 3
        out = {(len(w), tuple(w), 0)}
        for p in range(4):
            out.add((len(w), tuple("..." if i >= 3 and (i - 3) * 4 // rest == p else x for i, x in enumerate(w)), p + 1))
        return out
    count = Counter()
    for _, text, *_ in rows:
        count.update(set().union(*[line_templates(x) for x in (text or "").split("\n")]))
    out = Counter()
    for doc, text, *_ in rows:
        lines = (text or "").split("\n") if text else []
        kept = [x for x in lines if not any(count[t] >= min_docs for t in line_templates(x))]
        out[doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def test_line_templates(odd_docs, odd_rows, no_docs):
    from dimsmith.llm.line_templates import drop_lines
    got = drop_lines(odd_docs, min_docs=8)
    assert set(odd_docs.columns) <= set(got.columns)
    want = brute_lines(odd_rows, 8)
    assert by_row(got.select("doc_id", "text", "n_lines", "n_dropped")) == want
    assert sum(k[3] for k in want) >= 40
    assert drop_lines(no_docs).count() == 0


# --- quality rules ---------------------------------------------------------------------------

def brute_stats(text):
    w = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            rep |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(rep))


def test_quality_counts_and_base_rules(odd_docs, odd_rows, no_docs):
    from dimsmith.llm.quality_rules import quality_filter
    got = quality_filter(odd_docs)
    want = Counter()
    for doc, text, *_ in odd_rows:
        s = brute_stats(text)
        want[doc, *s, s[0] < 50 or 100 * s[5] > 50 * s[0]] += 1
    assert by_row(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                             "base_failed")) == want
    assert got.where("kept AND base_failed").count() == 0
    assert quality_filter(no_docs).count() == 0


def test_thresholds_adapt_to_the_group(spark):
    """1 % symbols are usual in one source and far out in another; small groups follow their language."""
    from dimsmith.llm.quality_rules import quality_filter
    rows, word = [], [f"word{i}" for i in range(997)]
    for i in range(600):
        n = 100
        w = [word[(i * 31 + k * (7 + i % 5)) % 997] for k in range(n)]
        src = "code" if i < 300 else "prose"
        marks = 40 + i % 20 if src == "code" else (60 if i == 599 else i % 3)
        rows.append((i, " ".join(w) + " " + "#" * marks, "en", src))
    rows.append((1000, " ".join(word[:100]) + " " + "#" * 30, "en", "tiny"))
    got = quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert all(kept[i] for i in range(300)) and all(kept[i] for i in range(300, 599)) and not kept[599]
    assert kept[1000]


# --- repeated spans --------------------------------------------------------------------------

def brute_spans(rows, length=100):
    docs = sorted({(-(1 << 63) if d is None else d, d is None, t or "") for d, t, *_ in rows})
    seen, out = {}, {}
    for d, null, t in docs:
        raw = t.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = True
            else:
                seen[raw[i:i + length]] = 1
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out[None if null else d, t] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return Counter((d, *out[d, t or ""]) for d, t, *_ in rows)


@pytest.mark.parametrize("bucket_bytes", [24 << 20, 3000])
def test_repeat_spans(odd_docs, odd_rows, no_docs, bucket_bytes):
    """The shared passage is in 8 documents, the home-page line in 20: below and above many contexts."""
    from dimsmith.llm.repeat_spans import remove_repeats
    # rows with one doc_id and different texts are ordered by a hash, so the plain version leaves them out
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 59]
    docs = odd_docs.where("doc_id IS NOT NULL AND doc_id <> 59")
    want = brute_spans(rows)
    assert by_row(remove_repeats(docs, bucket_bytes)) == want
    assert sum(k[2] for k in want) > 10_000
    assert remove_repeats(no_docs).count() == 0
    assert remove_repeats(odd_docs).count() == len(odd_rows)


def test_partial_overlaps(spark):
    """Edits at every distance: which bytes go is exact to the byte."""
    from dimsmith.llm.repeat_spans import remove_repeats
    rng = np.random.default_rng(5)
    text = "".join(chr(97 + c) for c in rng.integers(0, 26, 1500))
    rows = [(0, text)]
    for i in range(1, 40):
        t = list(text)
        for p in rng.integers(0, 1500, i % 12):
            t[p] = "#"
        rows.append((i, "".join(t[int(rng.integers(0, 300)):])))
    rows += [(50, "é" * 200), (51, "xé" + "é" * 160), (52, "ab" * 90 + "c" + "ab" * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_row(remove_repeats(df)) == brute_spans(rows)


@pytest.mark.parametrize("many", [1, 8])
def test_repeat_spans_however_dealt(many, monkeypatch):
    """The tasks' functions on random texts, batches and bucket counts, without Spark."""
    import random

    import pyarrow as pa

    import dimsmith.llm.repeat_spans as R
    monkeypatch.setattr(R, "MANY_CONTEXTS", many)
    rng = random.Random(3)
    for trial in range(20):
        letters = "ab" if trial % 3 == 0 else "abcdefghijklmnop "
        base = ["".join(rng.choice(letters) for _ in range(rng.randint(50, 900))) for _ in range(6)]
        rows = []
        for i in range(40):
            t = ""
            for _ in range(rng.randint(1, 4)):
                b = rng.choice(base)
                at = rng.randint(0, max(0, len(b) - 100))
                t += b[at:at + rng.randint(60, 400)] + "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 40])))
            rows.append((i, t))
        rng.shuffle(rows)
        n, buckets = rng.choice([1, 3, 7]), rng.choice([1, 3, 8])

        def batch(rows, **more):
            cols = {"id": pa.array([r[0] for r in rows], pa.int64()), "top": pa.array([0] * len(rows), pa.int64()), "dk": pa.array([0] * len(rows), pa.int64()),
                    "text": pa.array([r[1] for r in rows], pa.string()), **more}
            return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

        def sort(blobs, resolve):
            groups, removed, opened = defaultdict(list), defaultdict(list), defaultdict(list)
            for b in blobs:
                groups[b.column("bucket")[0].as_py()].append(b)
            for g in groups.values():
                for r in R._sort_bucket(buckets, resolve)(pa.Table.from_batches(g)).to_pylist():
                    removed[r["id"]] += r["removed"]
                    opened[r["id"]] += r["open"]
            return removed, opened
        removed, opened = sort([x for i in range(n) for x in R._sample_blobs(buckets)(iter([batch(rows[i::n])]))], True)
        more = []
        for i in range(n):
            some = [r for r in rows[i::n] if opened[r[0]]]
            if some:
                runs = pa.array([opened[r[0]] for r in some], pa.list_(pa.int64()))
                more += list(R._window_blobs(buckets)(iter([batch(some, open=runs)])))
        rest, _ = sort(more, False)
        got = Counter((d, *R._cut(t.encode(), np.array(removed[d] + rest[d], np.int64))) for d, t in rows)
        assert got == brute_spans(rows)


# --- tokens ----------------------------------------------------------------------------------

def test_token_store_round_trip(spark, odd_docs, odd_rows, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    from dimsmith.llm.token_store import read_token_index, token_index, write_token_store
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, at = [], 0
    for d, t, *_ in order:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in token_index(odd_docs).collect()), key=lambda r: r[1])
    assert got == want
    from dimsmith.llm.registry import shared_path
    small = write_token_store(odd_docs, public_tokenizers.path("word_bpe_49k.json"), shared_path(spark, "t"), shard_tokens=64)
    assert sorted((tuple(r) for r in read_token_index(spark, small).collect()), key=lambda r: r[1]) == want
    assert token_index(no_docs).count() == 0


def test_dac_random_access():
    from dimsmith.llm.token_store import DacShard, encode_dac
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 5), (5000, 49408), (3000, 200), (2100, 1 << 32), (513, 1 << 20)):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        shard = DacShard(encode_dac(ids))
        assert (shard.slice(0, n) == ids).all()
        for i in rng.integers(0, max(n, 1), 40):
            if n:
                assert shard[int(i)] == ids[i]
                k = int(rng.integers(0, n - i + 1))
                assert (shard.slice(int(i), k) == ids[i:i + k]).all()


# --- language --------------------------------------------------------------------------------

def test_language_id(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    from dimsmith.llm.language_id import op6_language_id, predict, train, train_on
    from tests.conftest import SF_ORACLE
    got = op6_language_id(spark, SF_ORACLE).join(spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("ok")).first()
    assert r.n > 100 and r.ok >= 0.9 * r.n
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    model = train_on(odd_docs)
    odd = {(x.doc_id, x.text): (x.lang_pred, x.score) for x in predict(odd_docs, model, ("doc_id", "lang")).join(
        odd_docs.select("doc_id", "text").distinct(), "doc_id").collect()}
    assert odd[50, ""] == odd[51, None] == odd[52, " \n\t "] == odd[65, "1234 5678 9"] == ("und", 0.0)
    assert odd[54, "a b c d"][0] in ("en", "de") and odd[63, "日本語" * 60][0] in ("en", "de")
    none = train(no_docs.select("doc_id", "text", "lang"))
    assert {x.lang_pred for x in predict(odd_docs, none).collect()} == {"und"}
    assert predict(no_docs, model).count() == 0


def brute_languages(rows, texts):
    """{text: share of its n-grams in each language}, from plain sets of byte strings."""
    def grams(text):
        folded = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in f" {text.lower()} ".encode())
        found = [folded[i:i + n] for n in (3, 5) for i in range(len(folded) - n + 1)]
        return [g for g in found if b"  " not in g]
    count = {}
    for _, text, lang in rows:
        count.setdefault(lang, Counter()).update(grams(text))
    rate = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in count.items()}
    best = Counter()
    for r in rate.values():
        best |= Counter(r)
    own = {k: {g for g, x in r.items() if x >= 0.1 * best[g] and count[k][g] >= 3} for k, r in rate.items()}
    return {t: {k: sum(g in s for g in grams(t)) / max(len(grams(t)), 1) for k, s in own.items()} for t in texts}


def test_filter_equals_plain_sets(spark):
    from dimsmith.llm.language_id import predict, train
    rng = random.Random(9)
    letters = {"aa": "abcdeghil", "bb": "abdmnoprs", "cc": "éñßabcdst", "dd": "日本語文字"}
    vocab = {k: ["".join(rng.choices(v, k=rng.randint(1, 6))) for _ in range(150)] for k, v in letters.items()}

    def text(k, n):
        return "".join(w + rng.choice([" ", " ", ", ", "\n", " 12 ", "-"]) for w in rng.choices(vocab[k], k=n))
    rows = [(i, text(k, rng.randint(1, 80)), k) for i, k in enumerate(rng.choices(list(letters), [4, 3, 2, 1], k=300))]
    texts = sorted({text(k, n) for k in letters for n in (1, 5, 30)} | {text("aa", 20) + text("dd", 20), "q", "xyz xyz", "A B C"})
    model = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=10 ** 6, max_ngrams=10 ** 6, slot_bits=20)
    plain = brute_languages(rows, texts)
    got = predict(spark.createDataFrame([(t,) for t in texts], "text string"), model, ("text",)).collect()
    assert len(got) == len(texts)
    for r in got:
        first, second = sorted(plain[r.text].values(), reverse=True)[:2]
        assert abs(r.score - first) < 1e-3, r
        assert first - second < 1e-3 or plain[r.text][r.lang_pred] == first, r


def test_too_many_languages_are_refused(spark):
    from dimsmith.llm.language_id import train
    with pytest.raises(ValueError, match="max_langs"):
        train(spark.createDataFrame([(i, "some text", f"l{i}") for i in range(5)], "doc_id long, text string, lang string"), max_langs=4)


def test_filter_corrects_false_positives():
    from dimsmith.llm.language_id import LanguageFilter
    rng = np.random.default_rng(0)
    grams = {k: rng.integers(0, 1 << 63, 3000, dtype=np.uint64) for k in [f"l{i}" for i in range(70)]}
    f = LanguageFilter.build(grams, list(grams), 12)        # well filled: many false hits
    assert f.slots.shape == (1 << 12, 2) and f.false_hits.min() > 0.3
    unknown = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)
    for i in (0, 69):
        bit = (f.masks(unknown)[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        assert abs(bit.mean() - f.false_hits[i]) < 0.02
        own = (f.masks(grams[f"l{i}"])[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        assert own.all()
