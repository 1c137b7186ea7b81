import random

import pytest

WORDS = "the of river stone and light with under morning paper green walks slow over bright".split()


def prose(rng, words):
    """Made-up sentences of about ten words."""
    out = []
    for i in range(words):
        word = rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", "ness"])
        out.append(word.capitalize() if i % 10 == 0 else word + ("." if i % 10 == 9 else ""))
    return " ".join(out)


@pytest.fixture()
def documents(spark, tmp_path):
    """A folder with a documents table that holds every odd row: nulls, empty, repeated, very long, copies."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(60, 140)) for _ in range(40)]
    passage = prose(rng, 70)
    texts[10:14] = [texts[10]] * 4
    texts[20] = texts[21] + "\n" + passage
    texts[22] = passage + "\n" + texts[23] + "\nshort"
    texts += [None, "", " \n\t ", "x", "word " * 30_000, "é中\x1c a\u2028b  c \n d", "A" * 100_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "no id at all"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    # names that operators use inside, as columns of the caller
    clash = "'en' as lang, 'src' as source, cast(length(text) as long) as n_chars, 1 as length, 'k' as key, 2 as _bucket, 'b' as block, 3 as stats"
    frame.selectExpr("*", *clash.split(", ")).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


@pytest.fixture()
def no_documents(spark, tmp_path):
    path = tmp_path / "none"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)
