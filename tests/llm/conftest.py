import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that clash with names the operators use or return.
CLASH = "kept string, keep_id string, score string, ids string, rid string, size string, target string, copies string, fp string, part string"


def awkward_rows(seed=3, n=60):
    """Documents with nulls in any column, empty and very long texts, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    words = "the of And to re-entry café Über naïve x1 99 it's ok. SO".split()

    def text(k):
        return " ".join(rng.choice(words) for _ in range(k))

    rows = [(i, text(rng.randint(0, 60)), rng.choice(["en", None]), rng.choice(["a", "b", "é", None]), i) for i in range(n)]
    long = text(30_000)
    rows += [(n, long, "en", "a", 1), (n + 1, long.upper().replace("É", "é").replace("Ü", "ü").replace("Ï", "ï"), "en", "b", 1)]
    rows += [(n + 2, None, None, None, None), (n + 3, "", None, None, None), (n + 4, "   \t\n ", None, "a", 0), (None, "no id", None, "a", 0), (None, None, None, None, None)]
    rows += [(n + 5 + i, rows[3][1], "en", "a", 1) for i in range(12)]
    rows += [rows[5], rows[5], (rows[6][0], "same id, other text", "en", "b", 1)]
    rows += [(n + 40 + i, rows[7][1] + f" {i}", "en", "c", 1) for i in range(4)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows as a table of several files, with extra columns whose names clash."""
    rows = awkward_rows()
    names = [c.split()[0] for c in CLASH.split(", ")]
    df = spark.createDataFrame([(*r, *names) for r in rows], f"{DOC}, {CLASH}").repartition(3)
    return df.cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"{DOC}, {CLASH}")


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.01"
    from pathlib import Path

    if not Path(path).exists():
        pytest.skip("no test data")
    return path
