"""Chat formatting, mixing, url filters, components and the pipeline."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import brute_components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


# --- chat ------------------------------------------------------------------------------------

HARD = ["", None, "\\", "\\\\h", "###", "####", "#######", "</turn>", "\\</turn>", "\\l/turn>", "a\n### user: x</turn>\n",
        "\\b\\h\\l\\c", "é " * 3000, "</turn></turn>\n", "\n", " ", "### assistant: </turn>"]


def chat_digest(turns):
    """turns: (role, text) -> what the query returns."""
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), h(text), len(loss), h(loss)


def test_chat_round_trip(spark):
    from dimsmith.llm.chat_format import chain_messages, format_reply_trees, loss_text, parse_turns
    convs = defaultdict(list)
    for i, t in enumerate(HARD):
        convs[1].append((i, ["user", "assistant"][i % 2], t))
        convs[2].append((3 * i - 7, ["assistant", None, "sys: tem", "a\\:b"][i % 4], t))
    convs[3] = [(0, "user", "x"), (0, "user", "x"), (0, "assistant", "y"), (None, "user", None)]    # ties, repeats
    convs[None] = [(1, "assistant", "no id")]
    rows = [(c, *r) for c, rs in convs.items() for r in rs]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("msg_id", F.lit("x"))
    out = format_reply_trees(chain_messages(df))
    got = {}
    for r in out.withColumn("turns", parse_turns(F.col("formatted"))).withColumn(
            "loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect():
        got[r.tree_id] = ([(t.role, t.text) for t in r.turns], r.loss, r.n_turns)
    low = lambda v: (v is not None, v if v is not None else 0)
    for c, rs in convs.items():
        rs = sorted(rs, key=lambda r: (low(r[0]), r[1] is not None, r[1] or "", r[2] is not None, (r[2] or "").encode()))
        assert got[c][0] == [(r or "", t or "") for _, r, t in rs]
        assert got[c][1] == "".join(t or "" for _, r, t in rs if r == "assistant")
        assert got[c][2] == len(rs)
    assert len(got) == 4
    assert format_reply_trees(chain_messages(df.limit(0))).count() == 0


def test_reply_trees_rank_branches(spark):
    from dimsmith.llm.chat_format import format_reply_trees
    rows = [("t", 1, None, "user", "q", None), ("t", 2, 1, "assistant", "a", 4.0), ("t", 3, 1, "assistant", "b", 1.0),
            ("t", 4, 2, "user", "c", -9.0), ("t", 5, 3, "user", "d", 5.0), ("t", 6, 3, "user", "e", 5.0),
            ("t", 7, 99, "user", "lost parent", 0.5),
            ("cycle", 1, 2, "user", "x", 1.0), ("cycle", 2, 1, "user", "y", 1.0), ("cycle", 3, 2, "user", "tail", 1.0)]
    rows += [("deep", i, i - 1 if i else None, "user", f"m{i}", 0.0) for i in range(150)]
    df = spark.createDataFrame(rows, "tree_id string, msg_id long, parent_id long, role string, text string, score double")
    got = {(r.tree_id, r.path_rank): (r.leaf_id, r.n_turns) for r in format_reply_trees(df, n_best=3).collect()}
    # means: 4 -> -5/3; 5, 6 -> 2; 7 -> 0.5
    assert got == {("t", 1): (5, 3), ("t", 2): (6, 3), ("t", 3): (7, 1), ("deep", 1): (149, 150)}
    deep = format_reply_trees(df).where("tree_id = 'deep'").first().formatted
    assert deep == "".join(f"### user: m{i}</turn>\n" for i in range(150))


def test_chat_query_matches_plain(spark):
    from dimsmith.llm.chat_format import op1_chat_format
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    convs = defaultdict(list)
    for r in rows:
        convs[r.conv_id].append((r.turn, r.role, r.text))
    hard = "\\### Assistant: </turn> ok"
    convs[-7] = [(0, "user", hard), (1, "assistant", hard)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op1_chat_format(spark, SF_SMALL).collect()}
    assert got == {c: chat_digest([x[1:] for x in sorted(t)]) for c, t in convs.items()}


# --- mixing ----------------------------------------------------------------------------------

def test_mix(spark, odd_docs, odd_rows, no_docs):
    from dimsmith.llm.mix_sources import mix, mixed_texts, word_list
    docs = odd_docs.select("doc_id", "source", F.size(word_list(F.col("text"))).cast("long").alias("size"))
    got = mix(docs).collect()
    size = Counter()
    for r in got:
        size[r.source] += r.size
        assert 0 <= r.taken <= 2 * r.size
    assert sum(size.values()) == sum(len(SPACE.findall(t or "")) for _, t, *_ in odd_rows)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size == size[r.source]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    free = {s: target[s] for s in target if target[s] < 2 * size[s] - 1e-9}
    weight = dict(zip(sorted([s for s in target if s is not None]) + [None], (5, 2, 1, 5), strict=True))
    assert len({round(free[s] / weight[s], 6) for s in free}) <= 1      # uncapped ones share by weight
    again = mix(docs.repartition(7)).collect()
    key = lambda rows: Counter((r.doc_id, r.source, r.size, r.taken) for r in rows)
    assert key(got) == key(again)
    assert mix(docs.limit(0)).count() == 0

    out = mixed_texts(odd_docs)
    assert out.columns == odd_docs.columns
    words = Counter()
    for r in out.collect():
        words[r.source] += len(SPACE.findall(r.text or ""))
    assert +words == +taken
    assert mixed_texts(no_docs).count() == 0


def test_mix_buckets_do_not_change_the_result(spark):
    from dimsmith.llm.mix_sources import queue_times
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 9).alias("size"))
    targets = spark.createDataFrame([("s", 1996, 1.0, 1996.0)], "source string, source_size long, weight double, target double")
    one = queue_times(docs, targets).collect()
    many = queue_times(docs, targets, bucket_rows=3).collect()
    assert {(r.doc_id, r.sent) for r in one} == {(r.doc_id, r.sent) for r in many}


# --- urls ------------------------------------------------------------------------------------

@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("HTTP://Sub.Example.ORG/es/1?x#y", "sub.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
    ("http://a.com?/de/x", "a.com", "", None, "allow"),
    ("http://É.com/fr/://b", "É.com", "/fr/://b", "com/fr/", "allow"),
    ("x.com/de/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("://", "", "", None, "allow"), ("http://com/de/", "com", "/de/", "com/de/", "block")])
def test_url_rules(spark, url, host, path, rule, verdict):
    from dimsmith.llm.url_filters import RULES, matched_rule, url_host, url_path
    df = spark.createDataFrame([(url,)], "url string").select(url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"))
    r = df.withColumn("m", matched_rule(F.col("h"), F.col("p"), RULES)).first()
    assert (r.h, r.p, r.m.rule if r.m else None, r.m.verdict if r.m else "allow") == (host, path, rule, verdict)


def test_host_reputation_shrinks(spark):
    from dimsmith.llm.url_filters import filter_urls
    pages, labels = [], []
    def add(host, n, bad):  # noqa: E306
        for i in range(n):
            pages.append((len(pages), f"http://{host}/p{i}"))
            labels.append((len(pages) - 1, int(i < bad)))
    for k in range(30):
        add(f"h{k}.good.net", 20, k % 2)
        add(f"h{k}.farm.net", 20, 18)
    add("one.good.net", 1, 1)           # a single bad page of a good domain
    pages += [(9000, "http://new.farm.net/"), (9001, "http://new.good.net/"), (9002, None), (None, "http://h1.farm.net/x"),
              (9003, "http://h1.farm.net/x"), (9003, "http://h1.farm.net/x")]
    labels += [(0, None), (None, 1), (12345, 1)]
    p = spark.createDataFrame(pages, "page_id long, url string").withColumn("n", F.lit(0)).withColumn("bad", F.lit(0))
    lab = spark.createDataFrame(labels, "page_id long, bad int")
    out = filter_urls(p, lab, []).collect()
    assert len(out) == len(pages)
    v = defaultdict(set)
    for r in out:
        v[r.host].add(r.verdict)
    assert v["h3.farm.net"] == {"block"} and v["h3.good.net"] == {"allow"} and v["one.good.net"] == {"allow"}
    assert v["new.good.net"] == {"allow"} and v[""] == {"allow"}
    none = filter_urls(p, lab.limit(0), [])
    assert none.where("verdict <> 'allow'").count() == 0 and none.count() == len(pages)
    assert filter_urls(p.limit(0), lab, []).count() == 0


# --- components ------------------------------------------------------------------------------

def test_components(spark):
    from dimsmith.llm.components import components
    links = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(10, 40)] + [(7, 7), (9, 8), (8, 9), (8, 9)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, **{k: 5 for k in range(10, 40)}, 8: 8, 9: 8}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline --------------------------------------------------------------------------------

def test_pipeline_stages(spark, odd_docs, odd_rows):
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_store"]
    docs = odd_docs
    from dimsmith.llm.registry import materialise
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF_SMALL), "test-stage")
        if name != "token_store":
            assert out.columns == odd_docs.columns, name
            seen[name] = Counter(r.doc_id for r in out.select("doc_id").collect())
        docs = out
    assert not set(seen["language_id"]) & {50, 51, 52, 65}      # no letters
    near = seen["near_dedup"]
    rows = [r for r in odd_rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter(seen["language_id"]) == Counter(r[0] for r in rows)
    assert set(near) == {k[0] for k in brute_components(rows) if k[3]}
    assert near[58] == 0 and near[59] <= 1 and max(n for d, n in near.items() if d is not None) == 1
    assert docs.agg(F.sum("n_tokens")).first()[0] > 0


def test_pipeline_runs_on_no_documents(spark, no_docs):
    import corpus_pipeline
    docs = no_docs.withColumn("n_chars", F.lit(1).cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0, name
