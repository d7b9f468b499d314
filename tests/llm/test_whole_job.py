"""Cases in which an operator once did less than the whole job."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_text_operators import SPACE, WORD, brute_components, by_row, lower


# --- near duplicates -------------------------------------------------------------------------

def test_rounds_without_links_do_not_end_the_search(spark, odd_docs, odd_rows, monkeypatch):
    """Every representative misses: the last pass alone finds the links."""
    import dimsmith.llm.near_dedup as near_dedup
    some = near_dedup._candidates
    monkeypatch.setattr(near_dedup, "_candidates", lambda keys, salt: some(keys, salt).limit(0))
    assert by_row(near_dedup.near_duplicates(odd_docs).drop("tk")) == brute_components(odd_rows)


def test_pairs_of_the_last_pass_hold_every_link(spark):
    from dimsmith.llm.near_dedup import _verified, rest_pairs
    rng = random.Random(4)
    sets = {}
    for i in range(150):
        base = rng.sample(range(60), rng.randint(1, 30)) if i % 3 else list(rng.choice(list(sets.values()) or [[1, 2]]))
        sets[i] = sorted({*base[rng.randint(0, 3) % len(base):], *rng.sample(range(60), rng.randint(0, 3))})
    comp = {i: i // 2 for i in sets}
    df = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>")
    nodes = spark.createDataFrame([(i, len(x), comp[i]) for i, x in sets.items()], "node long, n long, comp long")
    want = {(i, j) for i in sets for j in range(i + 1, len(sets)) if comp[i] != comp[j]
            and 100 * len({*sets[i]} & {*sets[j]}) >= 75 * len({*sets[i], *sets[j]})}
    assert len(want) > 20
    for block in (500, 3):
        assert {tuple(r) for r in _verified(rest_pairs(nodes, df, block), df).collect()} == want


def test_texts_of_the_same_passages_make_few_pairs(spark):
    """Sets of 30 out of 60 shared passages: the last pass keeps the near ones among them only."""
    from dimsmith.llm.near_dedup import _verified, rest_pairs
    rng = random.Random(9)
    sets = {i: sorted(rng.sample(range(60), 30)) for i in range(4000)}
    for i in range(4000, 4040):         # near copies: two passages exchanged
        x = sets[i - 4000]
        sets[i] = sorted({*x[2:], *rng.sample(sorted({*range(60)} - {*x}), 2)})
    df = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>").repartition(8)
    nodes = spark.createDataFrame([(i, 30, i) for i in sets], "node long, n long, comp long")
    pairs = rest_pairs(nodes, df).persist()
    assert pairs.count() < 0.05 * len(sets) ** 2 / 2
    found = {tuple(r) for r in _verified(pairs, df).collect()}
    assert {(i - 4000, i) for i in range(4000, 4040)} <= found


# --- line templates --------------------------------------------------------------------------

def brute_default_lines(rows):
    """Templates with their number of fixed tokens; 8 of them recur from 2 documents on, others from 10."""
    def line_templates(line):
        w = ["<*>" if re.search("[0-9]", x) else x for x in SPACE.findall(line)]
        out = {(len(w), tuple(w))} if w else set()
        for p in range(4 if len(w) >= 8 else 0):
            out.add((len(w), tuple("..." if i >= 3 and (i - 3) * 4 // (len(w) - 3) == p else x for i, x in enumerate(w))))
        return {(t, sum(x not in ("<*>", "...") for x in t[1]) >= 8) for t in out}
    count = Counter()
    for _, text, *_ in rows:
        count.update(set().union(*[line_templates(x) for x in (text or "").split("\n")]))
    out = Counter()
    for doc, text, *_ in rows:
        lines = text.split("\n") if text else []
        kept = [x for x in lines if not any(count[t] >= (2 if t[1] else 10) for t in line_templates(x))]
        out[doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def test_long_lines_recur_in_two_documents_and_short_fields_are_variable(spark, odd_docs, odd_rows):
    from dimsmith.llm.line_templates import drop_lines
    long = "a passage of more than eight words that two documents share"
    rows = [(i, f"own{'abcdefghijkl'[i]} line\nPage {i} of {i * 7}\n" + (long if i < 2 else "few words") + f"\nshort {i % 2} x" * (i < 9))
            for i in range(12)]
    got = {r.doc_id: r.text for r in drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: f"own{'abcdefghijkl'[i]} line" + f"\nshort {i % 2} x" * (i < 9) for i in range(12)}
    want = brute_default_lines(odd_rows)
    assert by_row(drop_lines(odd_docs).select("doc_id", "text", "n_lines", "n_dropped")) == want
    assert sum(k[3] for k in want) >= 40

# --- proximity -------------------------------------------------------------------------------

def brute_near(docs, items, width=10, share=0.8):
    """Matches within ``width`` words as (doc, item)."""
    out = set()
    for item, text in items:
        w = WORD.findall(lower(text))
        for x in [w[i:i + width] for i in range(max(len(w) - width + 1, 1))]:
            need = math.ceil(len(set(x)) * share)
            for doc, t in docs:
                d = WORD.findall(lower(t))
                if x and any(len(set(d[i:i + width]) & set(x)) >= need for i in range(len(d))):
                    out.add((doc, str(item)))
    return out


@pytest.mark.parametrize("neighbours, row", [(64, 500), (20, 3), (0, 1)])
def test_proximity_without_the_rarest_terms(spark, monkeypatch, neighbours, row):
    from dimsmith.llm import decontaminate
    monkeypatch.setattr(decontaminate, "MAX_NEIGHBOURS", neighbours)
    monkeypatch.setattr(decontaminate, "WINDOWS_A_ROW", row)
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in "abcdefgh" for b in "uvwxyz"]
    items = [(i, " ".join(rng.choices(vocab, weights=range(1, 49), k=n))) for i, n in enumerate([3, 5, 8, 10, 14, 30])]
    items.append((9, "alpha beta gamma delta epsilon zeta eta theta iota kappa"))
    items.append((10, "É é Ö ö one two Ü ü ß İ"))        # two words a letter, one lowered term
    docs = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kapa"),     # the rarest word misspelt: in no text
            (1, "alpha beta gama delta epsilon zeta eta theta iota kapa"),
            (2, "alpha beta gama delta epsilon zeta eta teta iota kapa"), (3, "kappa")]
    docs += [(4, "É é Ö ö one two Ü ü other"), (5, "é é ö ö ONE TWO ü ü ß i̇"), (6, "é Ö ö one two Ü ü\tß"), (7, None), (8, "")]
    docs += [(9, "alpha beta gamma delta x x x x x x epsilon zeta eta theta")]          # around a word, in no ten words
    for i in range(60):
        w = items[i % 6][1].split(" ")
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = rng.choice(["other", "words", *vocab])
        docs.append((10 + i, " ".join(rng.choices(vocab, k=20) + w + rng.choices(vocab, k=20))))
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, i) for r in got.collect() for i in r.near_items}
    assert got == brute_near([(i, t or "") for i, t in docs], items)
    assert {(0, "9"), (1, "9"), (4, "10")} <= got and not {(2, "9"), (5, "10"), (9, "9")} & got

# --- pipeline --------------------------------------------------------------------------------

def test_stages_judge_rows_by_id_and_text(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(2)
    vocab = [f"{a}{b}{c}" for a in "abcdefgh" for b in "uvwxyz" for c in "mnopq"]
    text = [" ".join(rng.choices(vocab, k=60)) for _ in range(8)]
    spark.createDataFrame([(1, " ".join(text[0].split()[20:40]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def left(stage, rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return Counter((r.doc_id, r.text) for r in stage(spark, df, str(tmp_path)).collect())
    rows = [(None, text[0], "en", "a"), (None, text[1], "en", "a"), (None, None, "en", "a"), (5, text[0], "en", "a"),
            (5, text[2], "en", "a"), (6, text[3], "en", "a")]
    assert left(corpus_pipeline.decontaminate_stage, rows) == Counter(
        [(None, text[1]), (None, None), (5, text[2]), (6, text[3])])

    near = [text[0], text[0].upper(), text[0] + " tail"]
    rows = [(None, t, "en", "a") for t in near] + [(7, t + " x", "en", "a") for t in (text[4], text[4].upper())]
    rows += [(None, text[4], "en", "a"), (8, text[5], "en", "a"), (8, text[5], "en", "a"), (8, text[6], "en", "a"), (9, None, "en", "a")]
    got = left(corpus_pipeline.near_dedup_stage, rows)
    assert sum(got[None, t] for t in near) == 1 and got[None, text[4]] == 0
    assert sum(n for (d, _), n in got.items() if d == 7) == 1
    assert got[8, text[5]] == got[8, text[6]] == got[9, None] == 1 and sum(got.values()) == 5


def test_language_stage_uses_the_prediction(spark):
    """A text in an unknown script goes, a null lang is filled in."""
    import corpus_pipeline
    rng = random.Random(4)
    de = [f"{a}{b}{c}" for a in ("ver", "ge", "be", "schl") for b in ("ach", "ung", "eit") for c in ("en", "er", "lich")]
    es = [f"{a}{b}{c}" for a in ("que", "des", "par", "no") for b in ("ci", "ami", "osa") for c in ("on", "ar", "ado")]
    rows = [(i, " ".join(rng.choices(v, k=40)), lang) for i, (v, lang) in enumerate([(de, "de"), (es, "es")] * 40)]
    rows += [(1000, " ".join(rng.choices(es, k=40)), None), (1001, "щука жужжит где угодно " * 20, None), (1002, "12 34", "de"), (1003, None, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_stage(spark, df, "").collect()}
    assert got == {**{r[0]: r[2] for r in rows[:80]}, 1000: "es"}


# --- repeated spans --------------------------------------------------------------------------

def test_documents_without_id_are_told_apart(spark, odd_rows):
    """Two texts whose 32-bit hashes are equal, one with a repeat of its own: the other loses nothing."""
    import hashlib

    import xxhash
    from dimsmith.llm.repeat_spans import remove_repeats
    seen, pairs = {}, []
    for i in range(200_000):
        s = hashlib.sha512(str(i).encode()).hexdigest()
        t = s + s if i % 2 else s + hashlib.sha512(b"z" + str(i).encode()).hexdigest()
        j = seen.setdefault(xxhash.xxh64(t, seed=42).intdigest() & 0xFFFFFFFF, (i, t))
        if j[0] != i and (j[0] + i) % 2:
            pairs.append((j[1], t))
    assert pairs
    df = spark.createDataFrame([(None, t) for p in pairs for t in p] + [(-(1 << 63), "x" * 300)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.n_removed) for r in remove_repeats(df).collect())
    assert got == [(False, 0)] * len(pairs) + [(False, 128)] * len(pairs) + [(True, 299)]


def test_rows_that_share_an_id_are_ordered_as_documents(spark, odd_rows):
    """Repeated spans against a plain scan that takes rows of one id, or none, in the order of the hash."""
    from dimsmith.llm.repeat_spans import NO_ID, remove_repeats
    from tests.llm.test_text_operators import brute_spans
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string")
    keyed = df.select("doc_id", "text", F.xxhash64(F.lit(9), "text").bitwiseAND(F.lit(NO_ID - 1)).alias("top"), F.xxhash64("text").alias("dk"))
    rows = sorted(keyed.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.top, r.dk))
    number = {}
    for r in rows:
        number.setdefault((r.doc_id, r.text or ""), len(number))
    back = {n: k[0] for k, n in number.items()}
    want = brute_spans([(number[r.doc_id, r.text or ""], r.text) for r in rows])
    got = Counter(tuple(r) for r in remove_repeats(df).collect())
    assert got == Counter({}) + sum((Counter({(back[k[0]], *k[1:]): n}) for k, n in want.items()), Counter())


# --- token files -----------------------------------------------------------------------------

def test_encoder_follows_the_tokenizer_file(spark, odd_docs, odd_rows):
    """Both public JSON files give the library's own ids; rows without an id are spread over shards."""
    import zlib

    import numpy as np
    import public_tokenizers
    from dimsmith.llm.token_store import token_index
    from tokenizers import Tokenizer
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        tok = Tokenizer.from_file(public_tokenizers.path(name))
        want = Counter()
        for doc, text, *_ in odd_rows:
            ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            want[doc, len(ids), zlib.crc32(ids.tobytes())] += 1
        rows = token_index(odd_docs, public_tokenizers.path(name)).collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
        assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_rows_without_an_id_are_many_ranges(spark):
    from dimsmith.llm.registry import shared_path
    from dimsmith.llm.token_store import write_token_store
    import public_tokenizers
    df = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(
        F.lit("text "), F.col("id").cast("string")).alias("text")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_token_store(df, public_tokenizers.path("word_bpe_49k.json"), shared_path(spark, "many"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r.n for r in spark.read.parquet(path).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 20_000 / 3


# --- line templates in long texts ------------------------------------------------------------

def test_many_lines_take_linear_time(spark):
    import time

    from dimsmith.llm.line_templates import drop_lines
    took = {}
    for n in (20_000, 20_000, 80_000):
        text = "\n".join(f"line {chr(97 + i % 26)} of a long text that two documents share word {i}" for i in range(n)) + "\nown"
        df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
        at = time.time()
        rows = drop_lines(df).collect()
        took[n] = time.time() - at
        assert [(r.n_lines, r.n_dropped, r.text) for r in rows] == [(n + 1, n, "own")] * 2 or all(r.n_dropped >= n for r in rows)
    assert took[80_000] < 12 * max(took[20_000], 1.0)


# --- quality fences --------------------------------------------------------------------------

def test_groups_differ_in_their_verdicts(spark):
    """The same text is ordinary in one language's documents and an outlier in the other's."""
    from dimsmith.llm.quality_rules import quality_filter
    rng = random.Random(11)

    def words(n, sizes):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice(sizes))) for _ in range(n))
    rows = [(i, words(80, [8, 9, 10, 11]), "long", "a") for i in range(250)] + [(300 + i, words(80, [3, 4, 5]), "short", "a") for i in range(250)]
    probe = words(80, [8, 9, 10])
    rows += [(1000, probe, "long", "a"), (1001, probe, "short", "a")]
    noisy = " ".join(w + "#" if i % 10 == 0 else w for i, w in enumerate(words(80, [3, 4, 5]).split()))
    rows += [(2000 + i, noisy.replace("a", chr(97 + i % 7)), "noisy", "a") for i in range(250)] + [(1002, noisy, "short", "a"), (1003, noisy, "noisy", "a")]
    kept = {r.doc_id: r.kept for r in quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept[1000] and not kept[1001]
    assert kept[1003] and not kept[1002]
    assert sum(kept[i] for i in range(250)) == 250 and sum(kept[300 + i] for i in range(250)) == 250


# --- url filters -----------------------------------------------------------------------------

def test_a_bad_host_is_blocked(spark):
    from dimsmith.llm.url_filters import filter_urls
    rng = random.Random(12)
    pages, labels = [], []
    for i in range(3000):
        host = "spam.bad.net" if i % 30 == 0 else f"h{i % 40}.fine{i % 7}.org"
        pages.append((i, f"https://{host}/p/{i}", "x", "x", 0.5, 0.5, 0.5))
        labels.append((i, int(rng.random() < (0.9 if i % 30 == 0 else 0.2))))
    df = spark.createDataFrame(pages, "page_id long, url string, host string, path string, mean double, bound double, overall double")
    out = filter_urls(df, spark.createDataFrame(labels, "page_id long, bad int"), [])
    assert {(r.host == "spam.bad.net", r.verdict) for r in out.select("host", "verdict").distinct().collect()} == {(True, "block"), (False, "allow")}
    allowed = filter_urls(df, spark.createDataFrame(labels, "page_id long, bad int"), [("allow", "bad.net/p")])
    assert {r.verdict for r in allowed.collect()} == {"allow"}
    assert {r.verdict for r in filter_urls(df, spark.createDataFrame([], "page_id long, bad int"), []).collect()} == {"allow"}


# --- mixing ----------------------------------------------------------------------------------

@pytest.mark.parametrize("budget", [0, 1, 700, 12_345, 10 ** 9])
def test_queue_is_cut_at_the_budget(spark, budget):
    from dimsmith.llm.mix_sources import cut_queue
    rng = random.Random(budget)
    rows = [(i, rng.random(), rng.randint(0, 60)) for i in range(1000)]
    df = spark.createDataFrame(rows, "row int, finish double, words long").withColumn("budget", F.lit(budget).cast("long")).repartition(5)
    got = {r.row: r.sent for r in cut_queue(df, ["finish", "row"]).collect()}
    left, want = budget, {}
    for i, _, n in sorted(rows, key=lambda r: (r[1], r[0])):
        want[i] = min(n, max(left, 0))
        left -= n
    assert got == want


def test_rows_without_an_id_are_many_buckets(spark):
    import dimsmith.llm.mix_sources as ms
    df = spark.range(12_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"),
                                    (F.col("id") % 50 + 1).alias("size"), F.md5(F.col("id").cast("string")).alias("key"))
    targets = ms.water_fill(ms.weigh_in_order(df.groupBy("source").agg(F.sum("size").alias("source_size"))))
    sent = sorted((r.sent, r["size"]) for r in ms.queue_times(df, targets, bucket_rows=200, key="key").collect())
    at = 0
    for end, size in sent:          # one queue without gaps
        assert end == at + size
        at = end
    h = F.md5(F.concat(F.lit(ms.SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string"), F.lit(":"), F.col("key")))
    sizes = sorted(r["count"] for r in df.groupBy(F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("long") * 60 / (1 << 32))).count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
