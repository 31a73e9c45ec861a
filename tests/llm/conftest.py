import random

import pytest

SYL = "an be co di el fo gu ha in jo ka lu me no or pa qui ro su ta un ve wi xo ya zu".split()


def words(rng, n):
    return ["".join(rng.choices(SYL, k=rng.randint(1, 3))) for _ in range(n)]


def corpus():
    """Documents with exact and near copies, shared passages, odd rows and extra columns."""
    rng = random.Random(11)
    out = [words(rng, rng.choice((3, 20, 120, 300, 900))) for _ in range(60)]
    shared = words(rng, 70)
    for i in (2, 9, 17):
        out[i][5:5] = shared
    copied = words(rng, 400)
    for i in range(12):  # near copies of one text, and exact ones
        base = list(copied)
        for _ in range(i):
            base[rng.randrange(len(base))] = "edit"
        out.append(base)
    out += [out[5], out[5]]
    rows = [(i, " ".join(w), "en", "s0" if i % 3 else "s1", 0) for i, w in enumerate(out)]
    n = len(rows)
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s2", 0), (n + 2, " \t\n ", "en", "s2", 0), (n + 3, "One.", "en", "s2", 0)]
    rows += [rows[4], (None, "no id here at all, really none", "en", "s1", 3), (None, None, "en", "s1", 3), (n + 4, "x" * 30000, "en", "s0", 1), (n + 5, "la la " * 4000, "en", "s0", 1)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame(corpus(), SCHEMA).withColumnsRenamed({}).selectExpr("*", "1 as length", "'x' as grp", "2 as copy", "'k' as uid", "3 as bucket", "4 as score", "5 as row").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("doc_id < -1")
