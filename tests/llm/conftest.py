import random

import pytest


def _prose(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """doc_id, text, lang, source: nulls, empties, ties, repeats, a long text, near copies, shared passages."""
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdeghilmnoprstuéßñ") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    base = [_prose(rng, rng.randint(60, 200), vocab) for _ in range(30)]
    passage = _prose(rng, 40, vocab)
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "ä", None])) for i, t in enumerate(base)]
    for i in range(30, 42):         # copies with one word changed, in other cases and spacing
        w = base[i % 4].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w).upper() if i % 3 == 0 else "\n".join(w), "en", "a"))
    for i in range(42, 50):         # one passage in many documents
        rows.append((i, f"{_prose(rng, 80, vocab)}\n{passage}\n{_prose(rng, 60, vocab)}", "de", "b"))
    rows += [(50, "", "en", "a"), (51, None, "en", "a"), (52, " \n\t ", None, None), (53, "one", "en", "a"),
             (54, "a b c d", "en", "a"), (55, "A b C d", "en", "b"), (56, "x" * 5000, "en", "a"), (57, "ab " * 4000, "de", "a"),
             (58, base[3], "en", "a"), (58, base[3], "en", "a"), (59, base[4], "de", "b"), (59, base[5], "de", "b"),
             (None, base[6], "en", None), (None, None, None, None), (None, "no id here at all today", "en", "a"),
             (-5, base[7] + " tail", "en", "ä"), (60, "\n".join([base[0], base[0], base[1]]), "en", "a"),
             (61, "<|endoftext|> and <|startoftext|>  it's 12 é́ İI ẞ\r\nÜber x", "en", "a"),
             (62, " ".join(base) + " " + " ".join(base), "en", "a"), (63, "日本語" * 60, "en", "a"),
             (64, "% $ # <b> | &amp; *** 1234 5678", "en", "a"), (65, "1234 5678 9", "de", "a")]
    for i in range(70, 90):         # lines that differ in a field
        rows.append((i, f"{_prose(rng, 30, vocab)}\nCopyright {1990 + i} by the holders of some rights item{i}\n"
                        f"read more about the {vocab[i]} topic on our home page today\n{_prose(rng, 20, vocab)}", "en", "b"))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string").repartition(3)
    for c in ("n_chars", "node", "comp", "key", "n", "size", "w", "words", "term", "pos", "bucket", "dk", "removed", "kept",
              "n_words", "line", "template", "host", "score", "_h", "_b", "part", "at", "d", "x", "copies", "rank", "shingles"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
